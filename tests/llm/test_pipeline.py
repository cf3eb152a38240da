import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tallygraph.llm.crf import ChainCRF
from tallygraph.llm.language import held_out
from tallygraph.llm.personal import _Finder, fit_field, labelled_examples, redact
from tallygraph.llm.simhash import fingerprint

from .test_line_dedup import brute as brute_lines
from .test_simhash import brute_roots

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_language_stage_keeps_documents_with_a_language(spark, docs):
    junk = spark.createDataFrame(
        [(-1, None, "en", "x", 0), (-2, "", "en", "x", 0), (-3, "12 %%", "en", "x", 5)], docs.schema
    )
    kept = cp.identify_language(spark, docs.unionAll(junk), SMALL)
    assert kept.columns == COLUMNS and texts(kept) == texts(docs)


def test_line_stage(spark, docs):
    table = [(r.doc_id, r.text) for r in docs.collect()]
    kept = cp.drop_shared_lines(spark, docs, SMALL)
    assert kept.columns == COLUMNS
    assert texts(kept) == {i: t for i, _, _, t in brute_lines(table)}
    assert kept.where(F.col("n_chars") != F.length("text")).count() == 0


def test_near_duplicate_stage(spark, docs):
    copy = docs.where("doc_id = 5").withColumn("doc_id", F.lit(10_000).cast("long"))
    both = docs.unionAll(copy)
    prints = {i: fingerprint(t) for i, t in texts(both).items()}
    root = brute_roots(sorted(set(prints.values())))
    first = {}
    for i in sorted(prints):
        first.setdefault(root[prints[i]], i)
    kept = cp.keep_one_of_each_group(spark, both, SMALL)
    assert kept.columns == COLUMNS and set(texts(kept)) == set(first.values())


def test_personal_stage(spark, docs):
    finder = _Finder(fit_field(labelled_examples(spark)))
    kept = cp.redact_personal_data(spark, docs, SMALL)
    assert kept.columns == COLUMNS
    want = {i: redact(t, [s[:3] for s in finder([t])[0]]) for i, t in texts(docs).items()}
    assert texts(kept) == want and any("[EMAIL]" in t for t in want.values())
    assert isinstance(finder.field, ChainCRF)


def test_whole_run(spark, docs):
    """The rows of ``run`` are those of the stages one after the other, in memory."""
    area = docs
    for _, stage in cp.STAGES:
        rows = stage(spark, area, SMALL)
        if "text" in rows.columns:
            area = spark.createDataFrame(rows.collect(), rows.schema)
    key = ["doc_id", "piece"]
    got, want = cp.run(spark, SMALL).toPandas(), rows.toPandas()
    pd.testing.assert_frame_equal(
        got.sort_values(key).reset_index(drop=True), want.sort_values(key).reset_index(drop=True)
    )
    assert set(got["doc_id"]) <= set(texts(docs)) and len(got) > 100


ODD = [
    (None, None, None, None, None, "a", [1], None),
    (None, "the same text", "en", None, 5, None, None, True),
    (None, "the same text", "en", None, 5, None, None, True),
    (1, "", None, "s", 0, "b", [], False),
    (1, "", None, "s", 0, "b", [], False),
    (1, "other words entirely for this row", "en", "s", 0, "c", [], False),
    (2, "x" * 100_000, "en", "s", 0, "c", [], False),
    (3, "write to a@b.org", "en", "s", 0, "c", [], False),
]


@pytest.mark.parametrize("stage", [s for s in cp.STAGES[:-1]], ids=lambda s: s[0])
def test_odd_rows_and_clashing_columns(spark, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long, stays string, spans array<int>, row boolean"
    docs = spark.createDataFrame(ODD, schema)
    got = stage[1](spark, docs, SMALL)
    assert got.columns == docs.columns and [f.dataType for f in got.schema] == [f.dataType for f in docs.schema]
    rows = got.collect()
    assert {r.doc_id for r in rows} >= {2, 3} and all(r.stays in ("a", "b", "c", None) for r in rows)
    assert stage[1](spark, docs.limit(0), SMALL).collect() == []


def test_packing_stage_on_odd_rows(spark):
    docs = spark.createDataFrame([r[:5] for r in ODD], "doc_id long, text string, lang string, source string, n_chars long")
    rows = cp.pack_documents(spark, docs, SMALL).collect()
    assert sum(r.length for r in rows) == sum(len(r[1] or "") for r in ODD)
    assert cp.pack_documents(spark, docs.limit(0), SMALL).collect() == []


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "words", None, "s", 5), (4, "12", None, "s", 2)], "doc_id long, text string, lang string, source string, n_chars long")
    assert texts(cp.identify_language(spark, docs, SMALL)) == {1: "words"}
    assert docs.where(held_out()).count() >= 0


def test_stages_are_registered():
    import __spark_entry__ as entry

    assert "pipeline" in entry.queries() and [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in entry.queries())] == []
