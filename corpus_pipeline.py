"""A corpus pipeline: language ID, line dedup, near duplicates, personal data, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. All but the
last return the columns of ``docs``, whatever they are; only the text and its length change.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph.llm.language import UNKNOWN, LanguageParams, fit_languages, held_out, language_column
from tallygraph.llm.line_dedup import dedup_lines
from tallygraph.llm.packing import pack_sequences
from tallygraph.llm.personal import fit_field, labelled_examples, redacted
from tallygraph.llm.simhash import near_duplicates
from tallygraph.llm.text import packed, unpacked
from tallygraph.staging import Staging


def _with_text(rows: DataFrame, docs: DataFrame, text: Column) -> DataFrame:
    """The columns of ``docs`` out of a packed row, with another text and its length."""
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return unpacked(rows, docs.columns, new)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents of no language: null texts and those without a letter.

    The score is a probability among the learned languages, high for nearly any text, and low for a
    clean one of few words that they share; so it rejects nothing.
    """
    params = LanguageParams()
    languages, probs = fit_languages(docs.where(~held_out()), params=params)
    if not languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language_column(docs, F.col("text"), languages, probs, params)
    judged = docs.select(packed(docs), found.alias("found"))
    return unpacked(judged.where(F.col("found.lang_pred") != UNKNOWN), docs.columns, {})


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that several documents share. Documents without such lines stay as they are; one
    that loses all its lines stays with an empty text."""
    rows = dedup_lines(docs)
    return _with_text(rows, docs, F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("row.text")))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near duplicates."""
    staying = near_duplicates(docs).where("stays").select(
        F.col("doc_id").alias("stay_id"), F.col("text_key").alias("stay_key")
    )
    rows = docs.select(
        packed(docs), F.col("doc_id").alias("own_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("own_key")
    )
    stays = F.col("own_id").eqNullSafe(F.col("stay_id")) & (F.col("own_key") == F.col("stay_key"))
    return unpacked(rows.join(staying, stays, "left_semi"), docs.columns, {})


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces each span of personal data by its kind in brackets."""
    field = fit_field(labelled_examples(spark))
    rows = docs.select(packed(docs), redacted(docs, F.col("text"), field).alias("clean"))
    return _with_text(rows, docs, F.col("clean"))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents, as sequences of bytes, in bins of the permitted sizes."""
    return pack_sequences(docs, F.octet_length("text"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_shared_lines),
    ("simhash_near_dedup", keep_one_of_each_group),
    ("personal_data", redact_personal_data),
    ("best_fit_packing", pack_documents),
]

# SQL can't express the fingerprints, the models or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Each but the last is written to the shared folder and read
    again; a stage's table goes once the next one is there. The last one's input stays for the
    reader of the result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        area = Staging(spark)
        docs = area.table(stage(spark, docs, sf_dir), name)
        if before is not None:
            before.drop()
        before = area
    return STAGES[-1][1](spark, docs, sf_dir)
