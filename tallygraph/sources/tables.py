from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The named columns of a Parquet table, so that no other column is scanned."""
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


# A table of fewer pieces is small, as a piece has ``spark.sql.files.maxPartitionBytes`` at most.
MAX_PIECES = 8


def spread_small(df: DataFrame) -> DataFrame:
    """Spread a table whose files split into fewer pieces than there are cores.

    Worth it before costly work per row, such as tokenising. A table of many files
    or row groups passes unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < min(cores, MAX_PIECES) else df
