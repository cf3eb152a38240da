"""Ordinary least squares from QR factors, and the sums of the normal equations.

Both go over the table in Arrow batches. A task keeps one small matrix, the size of which
depends on the number of features only; the matrices of the tasks are merged in a tree.
"""

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygraph.operators.skew import shuffle_partitions

INTERCEPT = "intercept"

PART_SCHEMA = "rows long, incomplete long, cells array<double>"


class NormalEquations(NamedTuple):
    """``A beta = b`` over ``rows`` rows; ``terms`` names rows and columns of ``A``."""

    terms: list[str]
    A: np.ndarray
    b: np.ndarray
    rows: int


def _centred(name: str, centres: dict[str, float] | None) -> Column:
    value = F.col(name).cast("double")
    return value - F.lit(centres[name]) if centres else value


def _check(y: str, xs: Sequence[str]) -> None:
    if len({y, *xs}) != len(xs) + 1:
        raise ValueError("the response and the features must be different columns")
    if INTERCEPT in xs:
        raise ValueError(f"{INTERCEPT!r} is the name of the constant term")


class Factor:
    """The triangular factor of all rows seen: their cross products, without being squared."""

    def __init__(self, width: int):
        self._width = width
        self._factor = np.zeros((0, width))

    def add_rows(self, rows: np.ndarray) -> None:
        self._factor = np.linalg.qr(np.vstack([self._factor, rows]), mode="r")

    def add_cells(self, cells: np.ndarray) -> None:
        self.add_rows(cells.reshape(-1, self._width))

    def cells(self) -> np.ndarray:
        return self._factor.ravel()


class Products:
    """Summed products of the columns, with what each addition has rounded off in a second matrix."""

    def __init__(self, width: int):
        self._sums = np.zeros((width, width))
        self._lost = np.zeros((width, width))

    def _add(self, values: np.ndarray) -> None:
        total = self._sums + values
        came = total - self._sums
        self._lost += (self._sums - (total - came)) + (values - came)
        self._sums = total

    def add_rows(self, rows: np.ndarray) -> None:
        self._add(rows.T @ rows)

    def add_cells(self, cells: np.ndarray) -> None:
        sums, lost = cells.reshape(2, *self._sums.shape)
        self._add(sums)
        self._lost += lost

    def cells(self) -> np.ndarray:
        return np.concatenate([self._sums.ravel(), self._lost.ravel()])


def _part(state: Factor | Products, rows: int, incomplete: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([rows], pa.int64()),
            pa.array([incomplete], pa.int64()),
            pa.array([state.cells()], pa.list_(pa.float64())),
        ],
        ["rows", "incomplete", "cells"],
    )


def _incomplete(batch: pa.RecordBatch) -> int:
    if not any(column.null_count for column in batch.columns):
        return 0
    empty = batch.columns[0].is_null()
    for column in batch.columns[1:]:
        empty = pc.or_(empty, column.is_null())
    return pc.sum(empty).as_py()


Batches = Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _of_rows(kind: type, width: int) -> Batches:
    """The part of one partition of the table, over the constant 1 and all its columns."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, rows, incomplete = kind(width), 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rows += batch.num_rows
            incomplete += _incomplete(batch)
            columns = [column.to_numpy(zero_copy_only=False) for column in batch.columns]
            state.add_rows(np.column_stack([np.ones(batch.num_rows), *columns]))
        if rows:
            yield _part(state, rows, incomplete)

    return run


def _of_parts(kind: type, width: int) -> Batches:
    """Several parts as one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, rows, incomplete = kind(width), 0, 0
        for batch in batches:
            for part in batch.to_pylist():
                rows += part["rows"]
                incomplete += part["incomplete"]
                state.add_cells(np.array(part["cells"], dtype=float))
        if rows:
            yield _part(state, rows, incomplete)

    return run


def _merged(
    df: DataFrame, kind: type, y: str, xs: Sequence[str], centres: dict[str, float] | None = None
) -> DataFrame:
    """``(rows, incomplete, cells)``, one row, none for an empty table.

    A part per task of the scan, then one per shuffle partition, then their square root: no
    task merges more than it would with as many rows, whatever the number of scan tasks.
    """
    width = len(xs) + 2
    columns = df.select(*(_centred(name, centres).alias(f"c{i}") for i, name in enumerate([*xs, y])))
    parts = columns.mapInArrow(_of_rows(kind, width), PART_SCHEMA)
    many = shuffle_partitions(df.sparkSession)
    for number in dict.fromkeys([many, math.isqrt(many), 1]):
        parts = parts.repartition(number).mapInArrow(_of_parts(kind, width), PART_SCHEMA)
    return parts


def _complete(parts: DataFrame) -> tuple[int, np.ndarray]:
    part = parts.first()
    if part is None:
        raise ValueError("no rows to fit")
    if part["incomplete"]:
        raise ValueError(f"{part['incomplete']} rows have an empty value")
    return part["rows"], np.array(part["cells"], dtype=float)


def normal_equations(
    df: DataFrame, y: str, xs: Sequence[str], centres: dict[str, float] | None = None
) -> NormalEquations:
    """Collect the p x p sums, p being the number of features plus one."""
    _check(y, xs)
    rows, cells = _complete(_merged(df, Products, y, xs, centres))
    sums = cells.reshape(2, len(xs) + 2, len(xs) + 2).sum(axis=0)
    return NormalEquations([INTERCEPT, *xs], sums[:-1, :-1], sums[:-1, -1], rows)


def normal_matrix(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """``(row_term, col_term, value)``: ``A`` in full, and ``b`` under the name of ``y``.

    An empty table gives no rows; empty values are an error when the result is read.
    """
    _check(y, xs)
    terms = [INTERCEPT, *xs, y]
    size = len(terms) ** 2

    def cell(i: int, j: int) -> Column:
        at = i * len(terms) + j
        value = F.get("cells", F.lit(at)) + F.get("cells", F.lit(size + at))
        return F.struct(F.lit(terms[i]).alias("row_term"), F.lit(terms[j]).alias("col_term"), value.alias("value"))

    cells = [cell(i, j) for i in range(len(terms) - 1) for j in range(len(terms))]
    gaps = F.raise_error(F.concat(F.col("incomplete").cast("string"), F.lit(" rows have an empty value")))
    sums = F.when(F.col("incomplete") > 0, gaps.cast("array<double>")).otherwise(F.col("cells"))
    return _merged(df, Products, y, xs).select(sums.alias("cells")).select(F.inline(F.array(*cells)))


def _solve(factor: np.ndarray, rows: int, centres: Sequence[float]) -> np.ndarray:
    """Least squares from the factor of ``[1, features, response]``.

    Features count as dependent if what tells them apart is no more than the rounding of their
    values, which is coarse for a feature that is far from zero for its spread.
    """
    width = factor.shape[1] - 1
    features, response = factor[:width, :width], factor[:width, width]
    scale = np.linalg.norm(features, axis=0)
    scale[scale == 0.0] = 1.0
    far = np.abs(np.array([1.0, *centres])) * math.sqrt(rows) / scale
    rounding = 8 * width * np.finfo(float).eps * max(1.0, far.max())
    sizes = np.linalg.svd(features / scale, compute_uv=False)
    if len(features) < width or sizes[-1] <= rounding * sizes[0]:
        raise ValueError("the features are linearly dependent (or there are too few rows)")
    return np.linalg.solve(features / scale, response) / scale


def _means(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Means over all rows. What is taken around them keeps the digits that values far from
    zero lose."""
    averages = [F.avg(F.col(name).cast("double")).alias(name) for name in columns]
    row = df.agg(*averages).first()
    return {name: row[name] if row[name] is not None and np.isfinite(row[name]) else 0.0 for name in columns}


def coefficients(df: DataFrame, y: str, xs: Sequence[str]) -> dict[str, float]:
    """Intercept and slopes by term, in two passes over the table: the means of its columns,
    then the QR factor of the rows around them. Nearly dependent features keep the digits that
    the squares of normal equations lose. The order of the rows does not matter."""
    _check(y, xs)
    centres = _means(df, [y, *xs])
    rows, cells = _complete(_merged(df, Factor, y, xs, centres))
    if not np.isfinite(cells).all():
        raise ValueError("the columns hold values that are not finite")
    beta = _solve(cells.reshape(-1, len(xs) + 2), rows, [centres[x] for x in xs])
    slopes = dict(zip(xs, beta[1:].tolist(), strict=True))
    intercept = centres[y] + beta[0] - sum(slopes[x] * centres[x] for x in xs)
    return {INTERCEPT: float(intercept), **slopes}


def fit_ols(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """``(term, beta)``, the intercept first, then the features in their order."""
    betas = coefficients(df, y, xs)
    return df.sparkSession.createDataFrame(list(betas.items()), "term string, beta double")
