from pyspark.sql import DataFrame, SparkSession

from tallygraph.operators import fit_ols
from tallygraph.sources import read_numeric_csv


def fit_csv(spark: SparkSession, paths: str | list[str], columns: list[str] | None = None) -> DataFrame:
    """``(term, beta)`` for headerless rows ``y,x1,...,xk``."""
    table = read_numeric_csv(spark, paths, columns)
    y, *xs = table.columns
    return fit_ols(table, y, xs)
