"""Exact duplicates by a 128-bit content hash, with the bytes compared inside each group."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygraph.llm.text import without_white


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    content_hash: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are identical without white space. Rows are grouped by
    ``content_hash`` (128 bits) and, inside a group, by the bytes of the text, so that a
    collision of the hash splits the group. Of equal texts the longest original stays, then
    the smallest id; a null id loses to any other.

    A group of copies may hold most rows: it is summed in the tasks before the shuffle, one
    row per task and text, and the sums are joined back by hashes only; that join has one
    row per text on its right, so Spark may split a hot key on its left.

    A null text is an empty one. Rows that repeat both id and text are the same document and
    share the flag. Other columns are ignored; an empty table gives an empty result.
    """
    bare = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.length(text_col), F.lit(0)).alias("chars"),
        without_white(F.col(text_col)).alias("bare"),
    )
    hashed = bare.select("doc_id", "chars", "bare", content_hash(F.col("bare")).alias("content_hash"))
    # Longest first, then a known id before a null one, then the smallest.
    rank = F.struct(-F.col("chars"), F.col("doc_id").isNull(), F.col("doc_id"))
    groups = (
        hashed.groupBy("content_hash", "bare")
        .agg(F.count("*").alias("group_size"), F.min(rank).alias("best"))
        .select("content_hash", F.sha2("bare", 256).alias("text_sha256"), "group_size", "best")
    )
    rows = hashed.select(
        "doc_id", rank.alias("own"), "content_hash", F.sha2("bare", 256).alias("text_sha256")
    )
    return rows.join(groups, ["content_hash", "text_sha256"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        F.col("own").eqNullSafe(F.col("best")).alias("kept"),
        "text_sha256",
    )
