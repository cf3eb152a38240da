"""Graphs as blocked sparse matrices.

Pages are numbered from 0 without gaps and cut into blocks of numbers; a vector over the pages is
a row per block with an array of doubles. Links become tiles: rows of arrays that hold some of the
links from one block of pages. A product of matrix and vector then is a join of few wide rows,
NumPy sums inside the tasks, and one shuffle of sums.
"""

from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph.operators.skew import shuffle_partitions
from tallygraph.staging import Staging

# Pages of a block: a row of a vector has 512 KB.
BLOCK = 1 << 16
# Links of a tile at most, which bounds a row whatever the graph. Full tiles have five times the
# bytes of the piece of the vector that meets them.
TILE_LINKS = 1 << 17

VECTOR = "block long, x array<double>"
TILE = "src_block long, part int, src array<int>, dst array<long>, weight array<double>"
SUMS = "block long, at array<int>, sums array<double>"


def number_pages(nodes: DataFrame, area: Staging) -> tuple[DataFrame, int]:
    """``(id, page)`` with ``page`` from 0 without gaps, and the number of pages.

    Each task numbers its own rows; the numbers move up by the sizes of the tasks before. They are
    fixed by storing them. Null ids are no pages.
    """
    distinct = nodes.where(F.col("id").isNotNull()).select("id").distinct()
    numbered = area.table(distinct.withColumn("at", F.monotonically_increasing_id()), "numbered")
    task = F.shiftright("at", 33)
    # One row per task.
    sizes = sorted(map(tuple, numbered.groupBy(task.alias("task")).count().collect()))
    ends = list(accumulate((n for _, n in sizes), initial=0))
    before = nodes.sparkSession.createDataFrame(
        [(t, end) for (t, _), end in zip(sizes, ends, strict=False)], "task long, before long"
    )
    placed = numbered.withColumn("task", task).join(F.broadcast(before), "task")
    page = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.select("id", page.alias("page")), ends[-1]


def _lists(ends: np.ndarray, values: np.ndarray | pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tiles out of links that come sorted by block and part."""
    names = ["src_block", "part", "src", "dst", "weight"]
    key, held, n = None, [], 0

    def tile() -> pa.RecordBatch:
        src, dst, weight = (np.concatenate(column) for column in zip(*held, strict=True))
        order = np.argsort(dst, kind="stable")
        whole = np.array([0, len(order)])
        columns = [_lists(whole, v[order]) for v in ((src % BLOCK).astype(np.int32), dst, weight)]
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int32()), *columns], names)

    for batch in batches:
        block, part = batch["src"].to_numpy() // BLOCK, batch["part"].to_numpy()
        columns = [batch[name].to_numpy() for name in ("src", "dst", "weight")]
        starts = np.flatnonzero(np.append(True, (np.diff(block) != 0) | (np.diff(part) != 0)))
        for a, b in zip(starts, [*starts[1:], len(block)], strict=True):
            now = (int(block[a]), int(part[a]))
            if held and (now != key or n + (b - a) > TILE_LINKS):
                yield tile()
                held, n = [], 0
            key = now
            held.append([column[a:b] for column in columns])
            n += b - a
    if held:
        yield tile()


def write_tiles(links: DataFrame, parts: DataFrame, buckets: int, path: str, table: str) -> None:
    """Store the tiles of ``(src, dst, weight)``, page numbers and a share, as a table bucketed by
    ``(src_block, part)``, which later joins read without moving it.

    ``parts(block, parts)`` says over how many parts the links of a block are dealt, so one with a
    third of all links lies in many buckets.
    """
    block = (F.col("src") / BLOCK).cast("long")
    placed = links.withColumn("src_block", block).join(F.broadcast(parts.withColumnRenamed("block", "src_block")), "src_block")
    part = F.pmod(F.xxhash64("dst"), F.col("parts")).cast("int").alias("part")
    keys = ["src_block", "part"]
    dealt = placed.select("src_block", part, "src", "dst", "weight").repartition(buckets, *keys).sortWithinPartitions(*keys)
    tiles = dealt.drop("src_block").mapInArrow(_packed, TILE)
    tiles.write.bucketBy(buckets, *keys).option("path", path).saveAsTable(table)


def constant_vector(spark: SparkSession, size: int, value: float) -> DataFrame:
    """``(block, x)`` with one value for every page. The last block may be shorter."""
    blocks = -(-size // BLOCK)
    length = F.least(F.lit(BLOCK), F.lit(size) - F.col("id") * BLOCK).cast("int")
    return spark.range(0, blocks, 1, max(1, min(blocks, shuffle_partitions(spark)))).select(F.col("id").alias("block"), F.array_repeat(F.lit(value), length).alias("x"))


def _rows(batch: pa.RecordBatch, name: str) -> Iterator[np.ndarray]:
    """The arrays of a list column, without copies."""
    column = batch.column(name)
    ends, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        yield flat[a:b]


def _multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each tile adds to its targets: one sum for each, cut by their blocks."""
    for batch in batches:
        blocks, sizes, ats, sums = [], [], [np.zeros(0, np.int32)], [np.zeros(0)]
        for src, dst, weight, x in zip(*(_rows(batch, name) for name in ("src", "dst", "weight", "x")), strict=True):
            # Targets are sorted in a tile.
            first = np.flatnonzero(np.append(True, dst[1:] != dst[:-1]))
            page = dst[first]
            cut = np.flatnonzero(np.append(True, np.diff(page // BLOCK) != 0))
            blocks.append(page[cut] // BLOCK)
            sizes.append(np.diff(np.append(cut, len(page))))
            ats.append((page % BLOCK).astype(np.int32))
            sums.append(np.add.reduceat(x[src] * weight, first))
        if blocks:
            ends = np.append(0, np.cumsum(np.concatenate(sizes)))
            lists = [_lists(ends, np.concatenate(v)) for v in (ats, sums)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(blocks)), *lists], ["block", "at", "sums"])


def _added(size: int, damping: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums up the parts of each block, which come one after the other, and moves to the next ranks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(0)

        def done() -> pa.RecordBatch:
            ranks = (1.0 - damping) + damping * total
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), _lists(np.array([0, len(ranks)]), ranks)], ["block", "x"])

        for batch in batches:
            for block, at, sums in zip(batch["block"].to_pylist(), _rows(batch, "at"), _rows(batch, "sums"), strict=True):
                if block != now:
                    if now is not None:
                        yield done()
                    now, total = block, np.zeros(min(BLOCK, size - block * BLOCK))
                total[at] += sums
        if now is not None:
            yield done()

    return run


def step(tiles: DataFrame, parts: DataFrame, vector: DataFrame, size: int, damping: float) -> DataFrame:
    """``(1 - d) + d * (tiles . vector)`` for every page, also those without links.

    The vector, eight bytes a page, goes to the tiles, which stay in their buckets. The sums then
    move once, by target block.
    """
    every_part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    sent = vector.join(F.broadcast(parts), "block").select(F.col("block").alias("src_block"), every_part, "x")
    joined = tiles.join(sent.hint("shuffle_hash"), ["src_block", "part"])
    sums = joined.select("src", "dst", "weight", "x").mapInArrow(_multiplied, SUMS)
    # A row without sums for every block, not taken from the vector, which would then be planned twice.
    session, blocks = vector.sparkSession, -(-size // BLOCK)
    none: list[Column] = [F.array().cast(kind).alias(name) for name, kind in (("at", "array<int>"), ("sums", "array<double>"))]
    every = session.range(0, blocks, 1, 1).select(F.col("id").alias("block"), *none)
    partitions = max(1, min(shuffle_partitions(session), blocks))
    together = sums.unionByName(every).repartition(partitions, "block").sortWithinPartitions("block")
    return together.mapInArrow(_added(size, damping), VECTOR)


def values_of(vector: DataFrame) -> DataFrame:
    """``(page, x)``, one row per page."""
    rows = vector.select("block", F.posexplode("x").alias("at", "x"))
    return rows.select((F.col("block") * BLOCK + F.col("at")).alias("page"), "x")
