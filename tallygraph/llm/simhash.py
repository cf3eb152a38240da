"""Near duplicates by SimHash: fingerprints, links within a few bits, connected groups.

Equal fingerprints are merged first. The rest are linked by pigeonhole: cut into ``blocks``,
two fingerprints that differ in ``max_bits`` bits agree in all but ``max_bits`` blocks, so they
meet in a join on one of the combinations of the others, where the distance is verified.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tallygraph.llm.joins import connected_components, join_sums
from tallygraph.llm.lattice import values
from tallygraph.staging import Staging, staging

BITS = 64


@dataclass(frozen=True)
class SimHashParams:
    """``heavy_block``: above so many distinct fingerprints, those that agree in a combination of
    blocks are not joined with each other but meet at the points between them."""

    words: int = 3
    max_bits: int = 2
    blocks: int = 4
    heavy_block: int = 64
    seed: int = 42


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """The SimHash of a text's word shingles, repeats included, as an unsigned number.

    A-Z are lower-cased. A text with fewer words is one shingle; one without words gives 0.
    """
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w)] if len(w) < words else map(b" ".join, zip(*(w[i:] for i in range(words))))
    hashes = np.array([xxhash.xxh64_intdigest(s, seed) for s in shingles], "<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 100_000):
        bits = np.unpackbits(hashes[at : at + 100_000].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, params: SimHashParams = SimHashParams()) -> Column:
    """The fingerprint as a long with the same bits."""

    @F.arrow_udf(LongType())
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = (fingerprint(t, params.words, params.seed) for t in values(texts))
            yield pa.array(np.fromiter(found, np.uint64, len(texts)).view(np.int64))

    return run(text)


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def _masks(params: SimHashParams) -> list[int]:
    """The combinations of blocks that a close pair may agree in, as bit masks."""
    edges = [round(i * BITS / params.blocks) for i in range(params.blocks + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(blocks, params.blocks - params.max_bits)]


def links(fingerprints: DataFrame, params: SimHashParams = SimHashParams()) -> DataFrame:
    """Pairs ``a, b`` that connect all distinct fingerprints (column ``fp``) that are close.

    Two close ones are linked directly or by others that are close, one after the other. In most
    combinations of blocks few fingerprints agree; they are joined pair by pair. In heavy ones each
    is put at all points within half the distance in its free bits. Two close ones share such a
    point, and those at one point are all close and few, as they are within reach of it.
    """
    if not 0 < params.max_bits <= 4 or params.max_bits >= params.blocks:
        raise ValueError("max_bits must be 1 to 4 and below the number of blocks")
    masks = _masks(params)
    parts = F.array(
        *[
            F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("part"))
            for k, m in enumerate(masks)
        ]
    )
    rows = fingerprints.select("fp", F.explode(parts).alias("block"))
    keyed = rows.select("fp", "block.k", F.xxhash64("block.k", "block.part").alias("block_key"))
    heavy = keyed.groupBy("block_key").agg(F.count("*").alias("n")).where(F.col("n") > params.heavy_block)
    marked = join_sums(keyed, heavy, "block_key", "left")

    def near(x: Column, y: Column) -> Column:
        return F.bit_count(x.bitwiseXOR(y)) <= params.max_bits

    light = marked.where(F.col("n").isNull()).select("block_key", "fp")
    left, right = light.alias("left"), light.alias("right")
    pairs = left.join(
        right,
        (F.col("left.block_key") == F.col("right.block_key"))
        & (F.col("left.fp") < F.col("right.fp"))
        & near(F.col("left.fp"), F.col("right.fp")),
    ).select(F.col("left.fp").alias("a"), F.col("right.fp").alias("b"))

    # The points: at most a few hundred flips for each combination, whatever the data.
    reach = (params.max_bits + 1) // 2
    flips = [
        (k, _signed(sum(1 << bit for bit in chosen)))
        for k, mask in enumerate(masks)
        for n in range(reach + 1)
        for chosen in combinations([bit for bit in range(BITS) if not mask >> bit & 1], n)
    ]
    spark = fingerprints.sparkSession
    flip = F.broadcast(spark.createDataFrame(flips, "k int, flip long"))
    points = (
        marked.where(F.col("n").isNotNull())
        .join(flip, "k")
        .groupBy("k", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
        .agg(F.collect_set("fp").alias("members"))
        .where(F.array_size("members") > 1)
    )
    if params.max_bits % 2 == 0:
        met = points.select(F.array_min("members").alias("a"), F.explode("members").alias("b"))
    else:
        met = points.select(F.explode("members").alias("a"), "members").select(
            "a", F.explode("members").alias("b")
        )
    return pairs.unionAll(met.where((F.col("a") < F.col("b")) & near(F.col("a"), F.col("b")))).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: SimHashParams = SimHashParams()
) -> DataFrame:
    """One row per input row: ``doc_id, text_key, fingerprint, component_id, stays``.

    ``component_id`` is the smallest id that can be reached over links, ``stays`` marks the row
    that represents its group: the smallest id, a null one last, and among those the smallest
    hash of the text, ``text_key``. Rows that repeat both are one document. A null text is an
    empty one; texts without words have fingerprint 0 and are linked like any other. Other columns
    are ignored; an empty table gives an empty result.

    Fingerprints are written once to the shared folder, with the groups; these two small tables
    are read by the result and stay in ``spark.checkpoint.dir``. Copies, however many, are one
    fingerprint before anything is joined.
    """
    spark = docs.sparkSession
    area = Staging(spark)
    prints = area.table(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"),
            fingerprint_column(F.col(text_col), params).alias("fp"),
        ),
        "fingerprints",
    )
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    with staging(spark) as temporary:
        distinct = temporary.table(prints.groupBy("fp").agg(F.min(first).alias("first")), "distinct")
        roots = connected_components(links(distinct, params))
        rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
            "fp", "first", F.coalesce("root", "fp").alias("root")
        )
        firsts = rooted.groupBy("root").agg(F.min("first").alias("group_first"))
        groups = area.table(
            join_sums(rooted.select("fp", "root"), firsts, "root").select("fp", "group_first"), "groups"
        )
    return prints.join(groups, "fp").select(
        "doc_id",
        "text_key",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("group_first.doc_id").alias("component_id"),
        first.eqNullSafe(F.col("group_first")).alias("stays"),
    )
