"""Spreading hot keys.

A key is heavy when it alone outweighs an average shuffle partition, so there are
always fewer heavy keys than shuffle partitions and a table of them can be broadcast.
Two exact ways, neither drops nor caps a row:

* ``key_salts`` + ``join_salted`` when the small side knows the number of rows of each
  key: one lazy plan in which only the rows of heavy keys get a salt.
* ``heavy_keys`` + ``join_split`` when the big side is a stored table: the heavy keys
  are joined by broadcast, what is left takes an ordinary shuffled join.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Below this many rows one task copes with a key, whatever its share.
HEAVY_ROWS = 1_000_000

# Groups by hash in which keys are counted first: a few numbers of each task, whatever the keys.
KEY_GROUPS = 1 << 14


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def key_salts(sizes: DataFrame, rows: str, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """``sizes`` (one row per key) with ``salts``, the number of parts its key is split into.

    A part has the average number of rows of a shuffle partition, but at least ``heavy_rows``.
    The sum over all keys is a subquery, so nothing runs here.
    """
    total = sizes.agg(F.sum(rows)).scalar()
    limit = F.greatest(F.lit(heavy_rows), total / F.lit(shuffle_partitions(sizes.sparkSession)))
    return sizes.withColumn("salts", F.greatest(F.lit(1), F.ceil(F.col(rows) / limit)).cast("int"))


def join_salted(big: DataFrame, small: DataFrame, sizes: DataFrame, key: str, spread_by: str) -> DataFrame:
    """Inner join on ``key`` in which heavy keys are split by a hash of ``spread_by``.

    ``sizes`` comes from ``key_salts``; ``small`` has unique keys and its ``salts``. The big side
    is shuffled once, and not at all where the planner finds the small one short enough to
    broadcast. A recomputed task gives the same salts.
    """
    heavy = sizes.where(F.col("salts") > 1).select(key, "salts")
    salt = F.coalesce(F.pmod(F.xxhash64(spread_by), F.col("salts")).cast("int"), F.lit(0))
    salted = big.join(F.broadcast(heavy), key, "left").withColumn("salt", salt).drop("salts")
    every_salt = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    return salted.join(small.select("*", every_salt).drop("salts"), [key, "salt"]).drop("salt")


def heavy_keys(
    sizes: DataFrame, rows: str, total: int, heavy_rows: int = HEAVY_ROWS
) -> tuple[DataFrame | None, int]:
    """The heavy rows of ``sizes`` (one row per key) and the limit they exceed.

    ``total`` is the number of rows over all keys. The limit is the average size of
    a shuffle partition, but at least ``heavy_rows``, so fewer keys than shuffle
    partitions can exceed it. The first value is ``None`` if no key does.
    """
    limit = max(total // shuffle_partitions(sizes.sparkSession), heavy_rows)
    if total <= limit or sizes.agg(F.max(rows)).first()[0] <= limit:
        return None, limit
    return sizes.where(F.col(rows) > limit), limit


def join_split(
    big: DataFrame, small: DataFrame, key: str, how: str, heavy: DataFrame | None
) -> DataFrame:
    """``inner`` or ``left_semi`` join of a table with hot keys to one with unique keys.

    ``heavy`` is a column of the keys to keep out of the shuffle. It must be short:
    its slice of ``small`` is broadcast. A task holds its keys of ``small`` in memory, but does not
    sort its rows of ``big``.
    """
    hashed = small.hint("shuffle_hash")
    if heavy is None:
        return big.join(hashed, key, how)
    light_part = big.join(F.broadcast(heavy), key, "left_anti").join(hashed, key, how)
    heavy_part = big.join(F.broadcast(small.join(heavy, key, "left_semi")), key, how)
    return light_part.unionByName(heavy_part)


def join_spread(
    big: DataFrame,
    small: DataFrame,
    key: str,
    how: str = "inner",
    heavy_rows: int = HEAVY_ROWS,
    total: int | None = None,
) -> DataFrame:
    """``join_split`` that finds the heavy keys itself.

    ``big`` should be a stored table: it is counted if its size ``total`` is not given, read
    for the key sizes, and read once per branch.
    """
    total = big.count() if total is None else total
    limit = max(total // shuffle_partitions(big.sparkSession), heavy_rows)
    heavy = None
    if total > limit:
        # A heavy key makes its group heavy, so keys are counted in heavy groups only.
        group = F.pmod(F.xxhash64(key), F.lit(KEY_GROUPS))
        groups = [row["at"] for row in big.groupBy(group.alias("at")).count().where(F.col("count") > limit).collect()]
        if groups:
            sizes = big.where(group.isin(groups)).groupBy(key).agg(F.count("*").alias("rows_of_key"))
            heavy, _ = heavy_keys(sizes, "rows_of_key", total, heavy_rows)
    return join_split(big, small, key, how, None if heavy is None else heavy.select(key))
