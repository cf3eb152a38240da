import hashlib

from pyspark.sql import functions as F

from tallygraph.llm.exact_dedup import exact_duplicates

TEXTS = [
    (5, "a b"),
    (3, "ab"),
    (4, "a  b"),
    (7, "a \tb"),
    (1, "A b"),
    (2, None),
    (9, ""),
    (8, " \n\x0b\x0c\r\t "),
    (6, "a\u00a0b"),
    (10, "x" * 300_000),
    (11, "x" * 150_000 + "\n" + "x" * 150_000),
]


def brute(rows):
    def bare(text):
        return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")

    out = []
    for doc_id, text in rows:
        group = [(-len(t or ""), i is None, i) for i, t in rows if bare(t) == bare(text)]
        best = min(group, key=lambda g: (g[0], g[1], g[2] or 0))
        own = (-len(text or ""), doc_id is None, doc_id)
        out.append((doc_id, best[2], len(group), own == best, hashlib.sha256(bare(text).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_groups(spark, rows):
    docs = spark.createDataFrame([(*t, "z") for t in TEXTS], "doc_id long, text string, keep_id string")
    assert rows(exact_duplicates(docs)) == brute(TEXTS)


def test_colliding_hashes_are_told_apart(spark, rows):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    same = exact_duplicates(docs, content_hash=lambda text: F.lit("0"))
    assert rows(same) == brute(TEXTS)


def test_null_ids_and_repeated_rows(spark, rows):
    table = [(None, "same"), (2, "same"), (2, "same"), (None, "only"), (3, "sa me"), (3, "same")]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    assert rows(exact_duplicates(docs)) == brute(table)


def test_empty_table(spark):
    assert exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
