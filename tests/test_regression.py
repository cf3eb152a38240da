from fractions import Fraction

import numpy as np
import pytest

from tallygraph.operators import fit_ols, normal_equations, normal_matrix
from tallygraph.operators.regression import Factor, Products, coefficients
from tallygraph.plans import fit_csv


def table(spark, y, X):
    names = ["y"] + [f"x{i + 1}" for i in range(X.shape[1])]
    data = np.column_stack([y, X]).tolist()
    schema = ", ".join(f"{name} double" for name in names)
    return spark.createDataFrame(data, schema).repartition(3), names[1:]


def sample(k, n=400, offset=0.0, seed=3):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, k)) * np.arange(1, k + 1) + offset
    y = 0.5 + X @ np.linspace(-2, 2, k) + rng.normal(size=n) * 0.1
    return y, X


def betas_of(df):
    return {row.term: row.beta for row in df.collect()}


def least_squares(y, X):
    return np.linalg.lstsq(np.column_stack([np.ones(len(y)), X]), y, rcond=None)[0]


@pytest.mark.parametrize("k", [0, 1, 2, 5, 11, 12, 25])
def test_fit_matches_numpy(spark, k):
    y, X = sample(k)
    df, xs = table(spark, y, X)
    found = fit_ols(df, "y", xs)
    assert [r.term for r in found.collect()] == ["intercept", *xs]
    assert list(betas_of(found).values()) == pytest.approx(least_squares(y, X).tolist(), rel=1e-8, abs=1e-10)


def test_exact_line(spark):
    X = np.arange(50.0).reshape(-1, 1)
    df, xs = table(spark, 3.0 - 2.0 * X[:, 0], X)
    assert betas_of(fit_ols(df, "y", xs)) == pytest.approx({"intercept": 3.0, "x1": -2.0})


@pytest.mark.parametrize("k", [2, 14])
def test_far_from_zero(spark, k):
    """Means of 1e7 with a spread of 1: raw sums would lose the slopes."""
    y, X = sample(k, offset=1e7)
    df, xs = table(spark, y, X)
    slopes = list(betas_of(fit_ols(df, "y", xs)).values())[1:]
    centred = least_squares(y - y.mean(), X - X.mean(axis=0))[1:]
    assert slopes == pytest.approx(centred.tolist(), rel=1e-6, abs=1e-7)


@pytest.mark.parametrize("k", [2, 14])
def test_order_of_the_rows_does_not_matter(spark, k):
    """The first 1,500 rows are far from all others."""
    y, X = sample(k)
    y, X = np.concatenate([y[:1500] + 30, y]), np.concatenate([X[:1500] - 20 * np.arange(1, k + 1), X])
    adverse, xs = table(spark, y, X)
    order = np.random.default_rng(4).permutation(len(y))
    mixed, _ = table(spark, y[order], X[order])
    found = betas_of(fit_ols(mixed, "y", xs))
    assert betas_of(fit_ols(adverse, "y", xs)) == pytest.approx(found, rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("k", [3, 15])
def test_normal_equations(spark, k):
    y, X = sample(k)
    df, xs = table(spark, y, X)
    design = np.column_stack([np.ones(len(y)), X])
    equations = normal_equations(df, "y", xs)
    assert equations.terms == ["intercept", *xs]
    assert equations.rows == len(y)
    np.testing.assert_allclose(equations.A, design.T @ design, rtol=1e-9, atol=1e-9)
    np.testing.assert_allclose(equations.b, design.T @ y, rtol=1e-9, atol=1e-9)


def test_normal_matrix(spark):
    y, X = sample(2)
    df, xs = table(spark, y, X)
    cells = {(r.row_term, r.col_term): r.value for r in normal_matrix(df, "y", xs).collect()}
    design = np.column_stack([np.ones(len(y)), X])
    names = ["intercept", *xs]
    full = np.column_stack([design.T @ design, design.T @ y])
    expected = {(a, b): full[i, j] for i, a in enumerate(names) for j, b in enumerate([*names, "y"])}
    assert cells == pytest.approx(expected, rel=1e-9)


@pytest.mark.parametrize("k", [1, 13])
def test_dependent_features(spark, k):
    y, X = sample(k)
    X = np.column_stack([X, X[:, 0] * 2 + 1])
    df, xs = table(spark, y, X)
    with pytest.raises(ValueError, match="dependent"):
        fit_ols(df, "y", xs)


@pytest.mark.parametrize("k", [1, 13])
def test_empty_values_and_tables(spark, k):
    y, X = sample(k, n=50)
    df, xs = table(spark, y, X)
    gaps = df.selectExpr("y", *xs[:-1], f"nullif(x{k}, {float(X[7, k - 1])!r}D) AS x{k}")
    with pytest.raises(ValueError, match="1 rows have an empty value"):
        fit_ols(gaps, "y", xs)
    with pytest.raises(ValueError, match="no rows"):
        fit_ols(df.limit(0), "y", xs)
    with pytest.raises(ValueError, match="not finite"):
        fit_ols(df.selectExpr("double('NaN') AS y", *xs), "y", xs)


def test_too_few_rows(spark):
    y, X = sample(3, n=3)
    df, xs = table(spark, y, X)
    with pytest.raises(ValueError, match="dependent"):
        fit_ols(df, "y", xs)


def test_columns_must_differ(spark):
    y, X = sample(1, n=5)
    df, _ = table(spark, y, X)
    with pytest.raises(ValueError):
        fit_ols(df, "y", ["y"])
    with pytest.raises(ValueError):
        fit_ols(df, "y", ["x1", "x1"])


def test_fit_csv(spark, tmp_path):
    y, X = sample(2, n=200)
    half = len(y) // 2
    for name, part in (("a.csv", slice(0, half)), ("b.csv", slice(half, None))):
        rows = zip(y[part], X[part, 0], X[part, 1], strict=True)
        (tmp_path / name).write_text("".join(f"{a!s}, {b!s},{c!s}\n" for a, b, c in rows))
    found = betas_of(fit_csv(spark, f"{tmp_path}/a.csv,{tmp_path}/b.csv"))
    assert list(found) == ["intercept", "x1", "x2"]
    assert list(found.values()) == pytest.approx(least_squares(y, X).tolist(), rel=1e-8)


@pytest.mark.parametrize("bad", ["1.0", "1.0,2.0,3.0", "1.0,abc"])
def test_bad_rows_fail(spark, tmp_path, bad):
    (tmp_path / "rows.csv").write_text(f"1.0,2.0\n2.0,3.5\n3.0,1.0\n{bad}\n")
    with pytest.raises(Exception, match="FAILFAST|Malformed"):
        fit_csv(spark, str(tmp_path / "rows.csv"))


def test_nearly_dependent_features(spark):
    """Two features that differ by a few millionths, one far from zero: squares lose the difference."""
    rng = np.random.default_rng(8)
    first, apart = rng.integers(1, 51, 4000).astype(float), rng.normal(size=4000)
    X = np.column_stack([first + 1e6, first + apart * 2**-18])
    y = 5.0 + 3.0 * first + 2.0 * (X[:, 1] - first) * 2**18
    df, xs = table(spark, y, X)
    slopes = [3.0 - 2.0 * 2**18, 2.0 * 2**18]
    found = coefficients(df, "y", xs)
    error = np.abs(np.array([found[x] for x in xs]) - slopes).max()
    means = dict(zip(["y", *xs], [y.mean(), *X.mean(axis=0)], strict=True))
    equations = normal_equations(df, "y", xs, means)
    squared = np.abs(np.linalg.solve(equations.A, equations.b)[1:] - slopes).max()
    assert error < 1e-4 < squared / 100


def test_sums_keep_what_additions_round_off():
    """Large values that cancel leave the small ones."""
    rng = np.random.default_rng(5)
    batches = [np.array([[1.0, 1e9]]), *rng.integers(1, 9, (500, 1, 2)) / 8, np.array([[1.0, -1e9]])]
    whole, halves = Products(2), [Products(2), Products(2)]
    for i, batch in enumerate(batches):
        whole.add_rows(batch)
        halves[i % 2].add_rows(batch)
    merged = Products(2)
    for half in halves:
        merged.add_cells(half.cells())
    exact = sum(Fraction(a) * Fraction(b) for a, b in np.vstack(batches)), sum(
        Fraction(b) ** 2 for _, b in np.vstack(batches)
    )
    for state in (whole, merged):
        sums, lost = state.cells().reshape(2, 2, 2)
        # What the large squares push out of the sum is in the second matrix, to its last digit.
        assert (Fraction(sums[0, 1]) + Fraction(lost[0, 1]), Fraction(sums[1, 1]) + Fraction(lost[1, 1])) == exact


def test_factors_merge():
    """Parts of any size, those with fewer rows than columns too, give the factor of all rows."""
    rows = np.random.default_rng(6).normal(size=(100, 4))
    merged = Factor(4)
    for part in np.split(rows, [2, 3, 50]):
        factor = Factor(4)
        factor.add_rows(part)
        merged.add_cells(factor.cells())
    factor = merged.cells().reshape(4, 4)
    np.testing.assert_allclose(factor.T @ factor, rows.T @ rows, rtol=1e-12, atol=1e-12)


def test_normal_matrix_of_gaps_and_of_nothing(spark):
    y, X = sample(2, n=30)
    df, xs = table(spark, y, X)
    assert normal_matrix(df.limit(0), "y", xs).collect() == []
    gaps = df.selectExpr("y", "x1", f"nullif(x2, {float(X[7, 1])!r}D) AS x2")
    with pytest.raises(Exception, match="1 rows have an empty value"):
        normal_matrix(gaps, "y", xs).collect()
