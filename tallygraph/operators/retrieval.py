"""Word counts, log term frequency, TF-IDF and keyword search over a document table."""

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallygraph.functions import inverse_document_frequency, log_term_frequency, plain_words
from tallygraph.operators.skew import HEAVY_ROWS, join_salted, join_spread, key_salts

# Term lists up to this length travel as literals or a broadcast; longer ones are shuffled.
SMALL_TERM_LIST = 10_000

# One document of so many is looked at to find the words that need several tasks.
SAMPLED = 64

# The slot of a word that stays in one task.
WHOLE = -1


class Corpus(NamedTuple):
    n_docs: int
    one_row_per_doc: bool


def describe_corpus(docs: DataFrame, id_col: str = "doc_id") -> Corpus:
    """Number of documents, those without words included, and whether each is one row."""
    row = docs.agg(F.count(id_col).alias("rows"), F.count_distinct(id_col).alias("docs")).first()
    return Corpus(row["docs"], row["docs"] == row["rows"])


def corpus_size(docs: DataFrame, id_col: str = "doc_id") -> int:
    return describe_corpus(docs, id_col).n_docs


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")
    )


def tokenize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, word)``, one row per kept occurrence.

    A document may span many input rows (the lines of a file, the turns of a
    conversation); rows with equal ids are one document.
    """
    return _documents(docs, id_col, text_col).select("doc_id", F.explode(plain_words(F.col("text"))).alias("word"))


def word_count(tokens: DataFrame) -> DataFrame:
    """``(word, doc_id, n)``. Counting starts before the shuffle, so a hot word or a
    document with most of the text reaches it as one row per map task."""
    return tokens.groupBy("word", "doc_id").agg(F.count("*").alias("n"))


def word_count_of_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word_count`` for tables with one row per document: no shuffle.

    The words of a row are sorted, and the distances between the places where a new
    word starts are the counts.
    """
    word_list = _documents(docs, id_col, text_col).select(
        "doc_id", F.sort_array(plain_words(F.col("text"))).alias("words")
    )
    placed = F.transform("words", lambda word, at: F.struct(word.alias("word"), at.alias("at")))
    new_word = F.filter(placed, lambda entry: (entry.at == 0) | (F.get("words", entry.at - 1) != entry.word))
    starts = word_list.select("doc_id", F.size("words").alias("size"), new_word.alias("starts"))

    def run_length(entry, i):
        end = F.coalesce(F.get("starts", i + 1).at, F.col("size"))
        return F.struct(entry.word.alias("word"), (end - entry.at).cast("long").alias("n"))

    runs = starts.select("doc_id", F.explode(F.transform("starts", run_length)).alias("run"))
    return runs.select("run.word", "doc_id", "run.n")


def term_frequency(counts: DataFrame) -> DataFrame:
    """``(word, doc_id, tf)`` with ``tf = log10(n) + 1``."""
    return counts.select("word", "doc_id", log_term_frequency(F.col("n")).alias("tf"))


def document_frequency(counts: DataFrame) -> DataFrame:
    """``(word, df)``: the number of documents a word occurs in.

    ``n`` is read so that a plan which joins the frequencies to their own counts
    needs the same columns twice and reuses one shuffle.
    """
    return counts.groupBy("word").agg(F.count_if(F.col("n") > 0).alias("df"))


def inverse_frequency(frequencies: DataFrame, n_docs: int) -> DataFrame:
    """``(word, df, idf)`` with ``idf = log10(1 + N / df)``."""
    return frequencies.withColumn("idf", inverse_document_frequency(n_docs, F.col("df")))


def tfidf(counts: DataFrame, n_docs: int, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """``(word, doc_id, tfidf)``.

    Document frequencies are combined before their shuffle, one row per word and task. They
    tell which words have so many postings that one task could not take them; only those are
    salted, all others join on the word as it is. The postings move once at most.
    """
    # The join's own null check, made for all branches, so that they share one shuffle.
    counts = counts.where(F.col("word").isNotNull())
    frequency = key_salts(document_frequency(counts), "df", heavy_rows)
    scored = join_salted(counts, frequency, frequency, "word", "doc_id")
    score = log_term_frequency(F.col("n")) * inverse_document_frequency(n_docs, F.col("df"))
    return scored.select("word", "doc_id", score.alias("tfidf"))


def tfidf_of_rows(counts: DataFrame, n_docs: int, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """``tfidf`` for counts that have not been shuffled, as those of ``word_count_of_rows``.

    The postings move once, to the task of their word, and are counted there. Words that would
    outweigh a partition are dealt over several by document; one document of ``SAMPLED`` tells
    which these are. The sample decides where a posting goes, never what is counted: the parts
    of a dealt word are added up in a table of such words, fewer than there are partitions.
    """
    counts = counts.where(F.col("word").isNotNull() & (F.col("n") > 0))
    seen = counts.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLED)) == 0)
    sizes = seen.groupBy("word").agg((F.count("*") * SAMPLED).alias("size"))
    heavy = key_salts(sizes, "size", heavy_rows).where(F.col("salts") > 1).select("word", "salts")
    slot = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int"), F.lit(WHOLE))
    # Both readers below need every column, so that one shuffle serves them; hence a posting
    # that could be null as far as the planner knows.
    posting = F.when(F.col("n") > 0, F.struct("doc_id", "n"))
    moved = (
        counts.join(F.broadcast(heavy), "word", "left")
        .select("word", slot.alias("slot"), posting.alias("posting"))
        .repartition("word", "slot")
    )
    dealt = F.col("slot") != WHOLE
    # All words that stay whole are one row of this table, which no posting meets.
    dealt_word = F.when(dealt, F.coalesce("word", F.lit(""))).otherwise("")
    parts = moved.groupBy(dealt.alias("dealt"), dealt_word.alias("word"))
    sums = parts.agg(F.count("posting").alias("all_parts"))
    here = F.count("posting").over(Window.partitionBy("word", "slot"))
    counted = moved.select("word", dealt.alias("dealt"), "posting", here.alias("part"))
    joined = counted.join(F.broadcast(sums), ["dealt", "word"], "left")
    df = F.when(F.col("dealt"), F.col("all_parts")).otherwise(F.col("part"))
    score = log_term_frequency(F.col("posting.n")) * inverse_document_frequency(n_docs, df)
    return joined.select("word", "posting.doc_id", score.alias("tfidf"))


def query_terms(terms: Iterable[str]) -> list[str]:
    """Distinct lower-cased terms. They are matched whole, never tokenised."""
    if isinstance(terms, str):
        raise TypeError("terms must be a list of strings, not one string")
    keys = sorted({term.lower() for term in terms})
    if not keys:
        raise ValueError("search needs at least one term")
    return keys


def matching_terms(table: DataFrame, terms: Iterable[str] | DataFrame, term_col: str = "term") -> DataFrame:
    """Rows of ``table`` whose ``word`` is one of ``terms``.

    A list becomes an ``IN`` filter that reaches the scan. A DataFrame of terms is
    counted first: a short one is broadcast, a long one is joined by shuffle with
    hot words set apart.
    """
    if not isinstance(terms, DataFrame):
        return table.where(F.col("word").isin(query_terms(terms)))
    keys = terms.select(F.lower(F.col(term_col)).alias("word")).where(F.col("word").isNotNull()).distinct()
    found = keys.limit(SMALL_TERM_LIST + 1).count()
    if not found:
        raise ValueError("search needs at least one term")
    if found <= SMALL_TERM_LIST:
        return table.join(F.broadcast(keys), "word", "left_semi")
    return join_spread(table, keys, "word", "left_semi")


def _score_documents(scores: DataFrame, top: int | None) -> DataFrame:
    hits = scores.groupBy("doc_id").agg(F.sum("tfidf").alias("score"))
    if top is None:
        return hits
    return hits.orderBy(F.col("score").desc(), F.col("doc_id")).limit(top)


def search(scores: DataFrame, terms: Iterable[str] | DataFrame, top: int | None = None) -> DataFrame:
    """``(doc_id, score)`` over a TF-IDF table: the summed scores of the terms found.

    Documents with any of the terms are hits; others are absent. ``top`` keeps the
    best hits, ties broken by ``doc_id``.
    """
    return _score_documents(matching_terms(scores, terms), top)


def search_counts(counts: DataFrame, terms: Iterable[str], n_docs: int, top: int | None = None) -> DataFrame:
    """``search`` straight from word counts, for one-off queries without a score table.

    The term filter sits under both the counting and the document frequencies, so
    only the terms' own occurrences are shuffled. ``n_docs`` is the size of the
    whole corpus, not of the hits.
    """
    keys = query_terms(terms)
    found = counts.where(F.col("word").isin(keys))
    if len(keys) > SMALL_TERM_LIST:
        return _score_documents(tfidf(found, n_docs), top)
    score = log_term_frequency(F.col("n")) * inverse_document_frequency(n_docs, F.col("df"))
    # One row per term: bounded by the length of the term list.
    scored = found.join(F.broadcast(document_frequency(found)), "word")
    return _score_documents(scored.select("doc_id", score.alias("tfidf")), top)
