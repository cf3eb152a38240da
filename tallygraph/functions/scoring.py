from pyspark.sql import Column
from pyspark.sql import functions as F


def log_term_frequency(count: Column) -> Column:
    """``log10(count) + 1``: 1 for a single occurrence."""
    return F.log10(count) + F.lit(1.0)


def inverse_document_frequency(n_docs: int | Column, df: Column) -> Column:
    """``log10(1 + N / df)``: never 0, ``log10(2)`` for a word in every document."""
    n = n_docs if isinstance(n_docs, Column) else F.lit(n_docs)
    return F.log10(F.lit(1.0) + n.cast("double") / df)
