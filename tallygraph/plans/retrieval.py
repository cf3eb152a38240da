from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygraph.operators import (
    corpus_size,
    search_counts,
    tfidf,
    tfidf_of_rows,
    tokenize,
    word_count,
    word_count_of_rows,
)
from tallygraph.operators.retrieval import query_terms

# With more terms than this the substring test would cost more than it saves.
MAX_SUBSTRING_TERMS = 50


def count_words(
    docs: DataFrame, one_row_per_doc: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(word, doc_id, n)``, without a shuffle if the caller knows that ids are unique."""
    if one_row_per_doc:
        return word_count_of_rows(docs, id_col, text_col)
    return word_count(tokenize(docs, id_col, text_col))


def score_documents(
    docs: DataFrame,
    n_docs: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    one_row_per_doc: bool = False,
) -> DataFrame:
    """``(word, doc_id, tfidf)`` of a corpus.

    ``n_docs`` saves the pass that counts the documents, or sets another number, such
    as the files of a folder with empty ones among them. ``one_row_per_doc`` saves a shuffle
    where ids are known to be unique.
    """
    if n_docs is None:
        n_docs = corpus_size(docs, id_col)
    counts = count_words(docs, one_row_per_doc, id_col, text_col)
    return tfidf_of_rows(counts, n_docs) if one_row_per_doc else tfidf(counts, n_docs)


def search_documents(
    docs: DataFrame,
    terms: Iterable[str],
    top: int | None = None,
    n_docs: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, score)`` for one query over a corpus that has no stored scores.

    A text that holds a word also contains it as a substring, which is far cheaper
    to see than its words: only the texts that pass this test are tokenised.
    """
    if n_docs is None:
        n_docs = corpus_size(docs, id_col)
    keys = query_terms(terms)
    if len(keys) <= MAX_SUBSTRING_TERMS:
        lowered = F.lower(F.col(text_col))
        docs = docs.where(reduce(or_, (F.contains(lowered, F.lit(key)) for key in keys)))
    counts = word_count(tokenize(docs, id_col, text_col))
    return search_counts(counts, keys, n_docs, top)
