"""Joins and graph steps that several operators share."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygraph.staging import Staging, staging


def join_sums(rows: DataFrame, sums: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join rows that have hot keys to sums with one row per key, grouped by the same key.

    A second key, a hash of the first, makes Spark shuffle both sides for the join itself. It
    can split a hot key then, which it can't while ``sums`` keeps the partitions of its grouping.
    """
    second = F.crc32(F.col(key).cast("string").cast("binary")).alias("second_key")
    return rows.select("*", second).join(sums.select("*", second), [key, "second_key"], how).drop("second_key")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of an undirected graph with integer nodes that is not the
    smallest of its component; ``root`` is the smallest.

    Alternates large and small stars: each node hangs its neighbours on the smallest one it
    knows. Every round writes the edges as a table in the shared folder and drops the one before,
    so the plan stays short and a lost executor costs one round. The rounds grow with the
    logarithm of the size of the largest component. The last table stays for the reader.
    """
    spark = edges.sparkSession
    kept = Staging(spark)
    with staging(spark) as area:
        pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        state, seen = area.table(pairs.where("u <> v").distinct(), "round0"), None
        n = 0
        while (now := _digest(state)) != seen:
            seen, n = now, n + 1
            state = area.table(_small_star(_large_star(state)), f"round{n}")
        return kept.table(state.select(F.col("u").alias("node"), F.col("v").alias("root")), "components")


def _digest(edges: DataFrame) -> tuple:
    """Two equal digests in a row mean that a round changed nothing."""
    mixed = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mixed)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    hung = join_sums(both.where("v > u"), lowest, "u")
    return hung.select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("u").agg(F.min("v").alias("low"))
    hung = join_sums(edges, lowest, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v")
    return hung.unionAll(lowest.select("u", F.col("low").alias("v"))).distinct()
