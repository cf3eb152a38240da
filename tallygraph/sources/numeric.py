from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygraph.sources.files import read_lines, split_paths


def numeric_columns(width: int) -> list[str]:
    """``y, x1, x2, ...``"""
    if width < 1:
        raise ValueError("a numeric file needs at least one column")
    return ["y"] + [f"x{i}" for i in range(1, width)]


# The column of a bad row's text. No numeric column may have this name.
RECORD = "_record"


def bad_csv_rows(spark: SparkSession, paths: str | list[str], columns: list[str]) -> DataFrame:
    """``(file, block_start, record)`` of the rows that ``read_numeric_csv`` would fail on: those with
    another number of fields, or a field that is no number.

    ``file`` is the path and ``block_start`` the offset of the piece of the file that holds the row. Nothing is
    collected, however many rows are bad. Blank lines are no rows, and empty fields are empty values.
    """
    if RECORD in columns:
        raise ValueError(f"{RECORD!r} is the name of the record column")
    schema = T.StructType([T.StructField(name, T.DoubleType()) for name in columns]).add(RECORD, T.StringType())
    options = {"columnNameOfCorruptRecord": RECORD, "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    lines = read_lines(spark, paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block_start"), "value"
    )
    # Line by line, as Spark refuses to read nothing of a file but its bad records.
    parsed = F.from_csv("value", schema.toDDL(), {"mode": "PERMISSIVE", **options})
    found = lines.where(F.length("value") > 0).withColumn("parsed", parsed).where(F.col("parsed")[RECORD].isNotNull())
    return found.select("file", "block_start", F.col("value").alias("record"))


def read_numeric_csv(
    spark: SparkSession, paths: str | list[str], columns: list[str] | None = None
) -> DataFrame:
    """Headerless comma-separated doubles, the response first.

    Without ``columns`` the width is taken from the first line. A ragged or
    non-numeric row fails the read.
    """
    if columns is None:
        first = read_lines(spark, paths).where(F.length("value") > 0).first()
        if first is None:
            raise ValueError("no data rows")
        columns = numeric_columns(len(first.value.split(",")))
    schema = T.StructType([T.StructField(name, T.DoubleType()) for name in columns])
    # A pruned read would not notice that a row is ragged.
    reader = spark.read.schema(schema).option("columnPruning", False)
    return reader.csv(
        split_paths(paths),
        mode="FAILFAST",
        ignoreLeadingWhiteSpace=True,
        ignoreTrailingWhiteSpace=True,
    )
