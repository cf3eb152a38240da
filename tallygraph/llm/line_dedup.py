"""Lines that many documents share: hashed, counted per document, dropped, put together again."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallygraph.llm.joins import join_sums
from tallygraph.llm.text import WHITE, fold_case, packed, split_lines


@F.pandas_udf(StringType())
def _without(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for texts, dropped in parts:
        out = []
        for text, positions in zip(texts, dropped, strict=True):
            if text is None or positions is None:
                out.append(None)
                continue
            gone = set(positions.tolist())
            out.append("\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone))
        yield pd.Series(out, dtype=object)


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
) -> DataFrame:
    """One row per input row: ``row`` (its columns), ``n_lines, n_dropped, kept_text``.

    A line's key is the line without white space at its ends and with A-Z lower-cased. Keys of
    ``min_chars`` code points or more that occur in ``min_docs`` documents or more lose all
    their lines, except in the document with the largest id; a null id counts as one more
    document and is the smallest. Rows that share an id are one document.

    Only 128-bit hashes, ids and positions are shuffled to find the lines. Pairs of line and
    document are made unique before lines are counted, both with sums in the tasks, so a line
    of most documents is no hot key there; the join that marks its lines has one row per line on
    its right, and Spark splits a hot line on its left. A null text has one empty line. A document whose
    lines all go keeps an empty text. An empty table gives an empty result.
    """
    whole = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        packed(docs),
    )
    # Rows of the same id and text have the same lines, so this key is fine for positions.
    keyed = whole.withColumn("text_key", F.md5("text"))
    lines = keyed.select(
        "doc_id", "text_key", F.posexplode(split_lines(F.col("text"))).alias("position", "line")
    )
    # White space shortens no line below the length of its key, so short lines need no trimming.
    found = (
        lines.where(F.length("line") >= min_chars)
        .withColumn("line", F.trim(F.col("line"), F.lit(WHITE)))
        .where(F.length("line") >= min_chars)
        .select("doc_id", "text_key", "position", F.md5(fold_case(F.col("line"))).alias("line_hash"))
    )
    shared = (
        found.groupBy("line_hash", "doc_id")
        .agg(F.lit(1).alias("once"))
        .groupBy("line_hash")
        .agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_id"))
        .where(F.col("n_docs") >= min_docs)
    )
    dropped = (
        join_sums(found, shared, "line_hash")
        .where(~F.col("doc_id").eqNullSafe(F.col("last_id")))
        .groupBy(F.col("doc_id").alias("drop_id"), F.col("text_key").alias("drop_key"))
        .agg(F.collect_set("position").alias("positions"))
    )
    marked = keyed.join(
        dropped,
        F.col("doc_id").eqNullSafe(F.col("drop_id")) & (F.col("text_key") == F.col("drop_key")),
        "left",
    )
    # Only texts that lose lines go through Python.
    shortened = _without(F.when(F.col("positions").isNotNull(), F.col("text")), F.col("positions"))
    return marked.select(
        "doc_id",
        "row",
        F.size(split_lines(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce(F.array_size("positions"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce(shortened, F.col("text")).alias("kept_text"),
    )
