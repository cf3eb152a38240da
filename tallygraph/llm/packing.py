"""Best-fit packing of sequences into bins of several permitted sizes.

Sequences are dealt over shards of bounded size by a hash, equal ones a few at a time; each shard
is packed in one task.
In a shard the longest sequence comes first and goes to the open bin that it fits best. If none
has room, the permitted size is opened that costs least for what it is expected to hold, so all
sizes are chosen together with the contents. At the end each bin is cut down to the smallest
size that holds its contents.
"""

from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from math import ceil

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PackingParams:
    """``capacities`` are the permitted lengths. A bin of ``c`` tokens costs ``c * (1 + c / dense)``:
    work that is linear in its length, and attention, which is as dear at ``dense`` tokens. Up to
    ``together`` equal sequences are dealt to a shard as one."""

    capacities: tuple[int, ...] = (2048, 4096, 8192, 16384)
    dense: int = 65_536
    shard_rows: int = 2_000
    together: int = 32

    def cost(self, capacity: int) -> float:
        return capacity * (1 + capacity / self.dense)


def expected_fill(first: int, capacity: int, waiting: list[int], end: int) -> int:
    """What a bin would hold after ``first`` if it took the longest of the first ``end`` of
    ``waiting`` (ascending) that fits, again and again."""
    fill = first
    while end > 0 and fill < capacity:
        end = bisect_right(waiting, capacity - fill, 0, end) - 1
        if end < 0:
            break
        fill += waiting[end]
    return fill


def pack(
    lengths: Sequence[int], capacities: Sequence[int], cost: Callable[[int], float]
) -> list[tuple[int, int, int]]:
    """For each length, in the order given: its bin, the bin's final size, and where it begins.

    Lengths must be in descending order and not above the largest capacity. Of equal costs the
    smaller size is opened; of equal rooms the bin opened first is filled.
    """
    sizes = sorted(set(capacities))
    waiting = list(reversed(lengths))
    rooms: list[tuple[int, int]] = []
    opened: list[int] = []
    filled: list[int] = []
    placed = []
    for n, length in enumerate(lengths):
        at = bisect_left(rooms, (length, -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            end = len(waiting) - n - 1
            fits = sizes[bisect_left(sizes, length) :]
            room = min(fits, key=lambda c: cost(c) / max(1, expected_fill(length, c, waiting, end)))
            b = len(opened)
            opened.append(room)
            filled.append(0)
        placed.append((b, filled[b]))
        filled[b] += length
        insort(rooms, (room - length, b))
    final = [sizes[bisect_left(sizes, f)] for f in filled]
    return [(b, final[b], at) for b, at in placed]


def pack_sequences(
    docs: DataFrame, length: Column, id_col: str = "doc_id", params: PackingParams = PackingParams()
) -> DataFrame:
    """One row per piece of a sequence: ``doc_id, piece, start, length, shard, bin, capacity, place``.

    ``length`` is the number of tokens of a row; null counts as 0. Sequences longer than the
    largest capacity are cut into pieces of it (``start`` is the first token of a piece). A bin is
    named by ``shard`` and ``bin``; ``place`` is where the piece begins in it. An empty sequence
    is one piece of length 0. The number of shards grows with the rows. Pieces of equal id, place
    and length, which can't be told apart, are counted, and every ``together`` of them are dealt by
    a hash of their own, so rows that repeat an id, or have none, spread like others; each is a
    sequence of its own. An empty table gives an empty result.
    """
    largest = max(params.capacities)
    lengths = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(length, F.lit(0)).cast("long").alias("whole")
    )
    pieces = F.greatest(F.ceil(F.col("whole") / largest), F.lit(1)).cast("long")
    total = lengths.agg(F.coalesce(F.sum(pieces), F.lit(0))).first()[0]
    shards = max(1, ceil(total / params.shard_rows))
    cut = lengths.select(
        "doc_id", "whole", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece")
    ).select(
        "doc_id",
        "piece",
        (F.col("piece") * largest).alias("start"),
        F.least(F.col("whole") - F.col("piece") * largest, F.lit(largest)).alias("length"),
    )
    equal = cut.groupBy("doc_id", "piece", "start", "length").agg(F.count("*").alias("rows"))
    deal = F.explode(F.sequence(F.lit(0), F.floor((F.col("rows") - 1) / params.together)))
    dealt = equal.select("*", deal.alias("deal")).select(
        "doc_id",
        "piece",
        "start",
        "length",
        F.least(F.col("rows") - F.col("deal") * params.together, F.lit(params.together)).alias("copies"),
        F.pmod(F.xxhash64("doc_id", "piece", "length", "deal"), F.lit(shards)).alias("shard"),
    )

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.loc[pdf.index.repeat(pdf["copies"])].drop(columns="copies")
        pdf = pdf.sort_values(["length", "key", "piece"], ascending=[False, True, True], kind="stable")
        placed = pack(pdf["length"].tolist(), params.capacities, params.cost)
        found = pd.DataFrame(placed, columns=["bin", "capacity", "place"])
        return pd.concat([pdf.reset_index(drop=True), found], axis=1)

    # An integer id with nulls would reach pandas as floats; as a string it stays whole.
    kind = docs.schema[id_col].dataType
    packed = (
        dealt.withColumn("key", F.col("doc_id").cast("string"))
        .drop("doc_id")
        .groupBy("shard")
        .applyInPandas(
            run,
            "key string, piece long, start long, length long, shard long, bin long, capacity long, place long",
        )
    )
    return packed.select(
        F.col("key").cast(kind).alias("doc_id"), "piece", "start", "length", "shard", "bin", "capacity", "place"
    )
