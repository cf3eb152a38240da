"""Target-distribution importance resampling over hashed n-grams, with segment deduplication.

A line end separates words, so texts are cut into lines there. Each distinct line of the corpus is
turned into feature buckets once and counts as often as it occurs; the n-grams that reach across
line ends are added per document. Buckets that are more frequent in the target than in the
corpus gain, documents weigh the mean gain of their features, and a Gumbel key for each id turns
the highest scores into a draw without replacement.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygraph.llm.joins import join_sums
from tallygraph.llm.lattice import blocks, values
from tallygraph.llm.text import split_lines
from tallygraph.staging import Staging, staging

# Fixed value: a word is a run of digits, letters a-z (A-Z are lower-cased) and all characters
# beyond ASCII. In UTF-8 those have bytes from 0x80 up, and no others do.
IN_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"
BYTES = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isdigit() or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
TEXT_BYTES = bytes(b if b == 0x0A else BYTES[b] for b in range(256))


@dataclass(frozen=True)
class ResamplingParams:
    """``percent`` of the documents with ``min_words`` or more are drawn. Features are runs of up to
    ``max_n`` words in ``buckets`` buckets; ``seed`` makes another draw."""

    max_n: int = 2
    buckets: int = 10_000
    percent: int = 25
    min_words: int = 20
    seed: int = 7


def line_buckets(lines: list[str], params: ResamplingParams) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all n-grams inside each line, in one array, and how many each line has."""
    split = [line.encode().translate(BYTES).split() for line in lines]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    words = [w for ws in split for w in ws]
    spaced = [b" " + w for w in words[1:]]
    owner = np.repeat(np.arange(len(lines)), sizes)
    crcs = list(map(crc32, words))
    found, owners = [np.array(crcs, np.int64)], [owner]
    for n in range(2, params.max_n + 1):
        # The checksum of a run goes on with the next word; runs over two lines are left out.
        crcs = list(map(crc32, spaced[n - 2 :], crcs))
        inside = owner[: len(crcs)] == owner[n - 1 :]
        found.append(np.array(crcs, np.int64)[inside])
        owners.append(owner[: len(crcs)][inside])
    flat, owner = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return (flat[order] % params.buckets).astype(np.int32), np.bincount(owner, minlength=len(lines))


def crossing_buckets(text: str, params: ResamplingParams) -> tuple[int, list[int]]:
    """The number of words of a text, and the buckets of its n-grams that reach across line ends."""
    n_words, out = 0, []
    tail: list[bytes] = []
    reach = params.max_n - 1
    for line in text.encode().translate(TEXT_BYTES).split(b"\n"):
        words = line.split()
        if not words:
            continue
        n_words += len(words)
        joint = tail + words[:reach]
        for first in range(len(tail)):
            for end in range(len(tail) + 1, min(first + params.max_n, len(joint)) + 1):
                out.append(crc32(b" ".join(joint[first:end])) % params.buckets)
        tail = (tail + words[-reach:])[-reach:] if reach else []
    return n_words, out


def _list_array(flat: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))


def _distinct_lines(texts: DataFrame, params: ResamplingParams) -> DataFrame:
    """``line_key, n, buckets``: each distinct line with a word, and how often it occurs in the
    column ``text``. Lines are counted in the tasks before they are shuffled."""
    lines = texts.select(F.explode(split_lines(F.col("text"))).alias("line"))
    counted = lines.where(F.col("line").rlike(IN_WORD)).groupBy("line").agg(F.count("*").alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, block in blocks(values(batch["line"])):
                rest = [batch["line_key"].slice(first, len(block)), batch["n"].slice(first, len(block))]
                made = _list_array(*line_buckets(block, params))
                yield pa.RecordBatch.from_arrays([*rest, made], ["line_key", "n", "buckets"])

    keyed = counted.select("line", _line_key(F.col("line")).alias("line_key"), "n")
    return keyed.mapInArrow(run, "line_key binary, n long, buckets array<int>")


def _line_key(line: Column) -> Column:
    return F.unhex(F.md5(line))


def _crossing(docs: DataFrame, params: ResamplingParams) -> DataFrame:
    """Each row of ``doc_id, text`` under a number of its own, with its words counted, the keys of
    its lines that have a word, and the buckets across its line ends."""

    @F.arrow_udf("n_words long, buckets array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            sizes, flat, counts = [], [], []
            for text in values(texts):
                n_words, buckets = crossing_buckets(text or "", params)
                counts.append(n_words)
                sizes.append(len(buckets))
                flat.extend(buckets)
            made = _list_array(np.array(flat, np.int32), np.array(sizes, np.int64))
            yield pa.StructArray.from_arrays([pa.array(counts, pa.int64()), made], ["n_words", "buckets"])

    with_word = F.filter(split_lines(F.col("text")), lambda line: line.rlike(IN_WORD))
    keyed = docs.select("doc_id", F.transform(with_word, _line_key).alias("line_keys"), run("text").alias("across"))
    return keyed.select(F.monotonically_increasing_id().alias("row_no"), "doc_id", "line_keys", "across.*")


def _totals(counted: DataFrame, params: ResamplingParams) -> np.ndarray:
    """Occurrences of each bucket over rows of ``n, buckets``. A task hands on one row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(params.buckets, np.int64)
        for batch in batches:
            sizes = batch["buckets"].value_lengths().to_numpy(zero_copy_only=False)
            times = np.repeat(batch["n"].to_numpy(zero_copy_only=False), sizes)
            # Sums of a batch are below 2^53, so doubles hold them exactly.
            found = np.bincount(batch["buckets"].flatten().to_numpy(), times, params.buckets)
            total += found.astype(np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], ["bucket", "n"])

    sums = counted.select("n", "buckets").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(params.buckets, np.int64)
    # One row per bucket at most.
    for row in sums.collect():
        out[row["bucket"]] = row["n"]
    return out


def _gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    size = len(corpus)
    S, T = int(corpus.sum()), int(target.sum())
    both = zip(corpus.tolist(), target.tolist(), strict=True)
    ratios = ((float(t + 1) * (S + size)) / (float(s + 1) * (T + size)) for s, t in both)
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def _summed(rows: DataFrame, keys: list[str], gains: Broadcast) -> DataFrame:
    """``keys``, the number of buckets of each row, and the sum of their gains."""
    kinds = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch["buckets"].value_lengths().to_numpy(zero_copy_only=False)
            ends = np.append(0, np.cumsum(sizes))
            upto = np.append(0, np.cumsum(gains.value[batch["buckets"].flatten().to_numpy()]))
            own = [batch[k] for k in keys]
            sums = [pa.array(sizes, pa.int64()), pa.array(upto[ends[1:]] - upto[ends[:-1]], pa.int64())]
            yield pa.RecordBatch.from_arrays([*own, *sums], [*keys, "features", "gain"])

    return rows.select(*keys, "buckets").mapInArrow(run, f"{kinds}, features long, gain long")


def _corpus(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(F.col(text_col).alias("text"))


def _target_totals(target: DataFrame, text_col: str, params: ResamplingParams) -> np.ndarray:
    texts = _corpus(target, text_col)
    across = _crossing(texts.select(F.lit(0).alias("doc_id"), "text"), params)
    rows = _distinct_lines(texts, params).select("n", "buckets")
    return _totals(rows.unionByName(across.select(F.lit(1).cast("long").alias("n"), "buckets")), params)


def _in_order(scored: DataFrame, order: list[Column], area: Staging) -> DataFrame:
    """Rows with ``place``, from 1 in this order: sorted by ranges, numbered inside each, and moved
    by the sizes of the ranges before. No task sees more than its range."""
    ranges = scored.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = area.table(ranges.withColumn("at", F.monotonically_increasing_id()), "in_order")
    part, bits = F.shiftright("at", 33), (1 << 33) - 1
    sizes = numbered.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    # One row per partition of the sort.
    before = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    placed = numbered.withColumn("part", part).join(F.broadcast(before), "part")
    return placed.withColumn("place", F.col("before") + F.col("at").bitwiseAND(F.lit(bits)) + 1)


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    params: ResamplingParams = ResamplingParams(),
) -> DataFrame:
    """One row per input row: ``doc_id, n_features, weight, score, rank``.

    The gain of a bucket is 1000 times the logarithm of its share in the target over its share in
    the corpus, each with one occurrence added to every bucket, rounded down; ``weight`` is the
    mean gain of a text's features, rounded down, and 0 without features. ``score`` adds Gumbel noise
    that depends on the seed and the id only. ``rank`` numbers the drawn documents by score; ties
    go to the smaller id, a null id first, then to either row. Rows that repeat an id are documents
    of their own with the same noise. A null id counts as an empty one in the noise. A null or empty text
    has no words. Very long texts are read a block at a time; other columns are ignored. An
    empty table gives an empty result, an empty target gives every bucket a share of one.

    Distinct lines are shuffled once with their text; what documents are joined to is a key, a
    count and a sum for each line. Small working tables that the result reads stay in
    ``spark.checkpoint.dir``.
    """
    spark = docs.sparkSession
    kept = Staging(spark)
    with staging(spark) as area:
        plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        rows = area.table(_crossing(plain, params), "rows")
        lines = area.table(_distinct_lines(_corpus(docs, text_col), params), "lines")
        once = rows.select(F.lit(1).cast("long").alias("n"), "buckets")
        corpus = _totals(lines.select("n", "buckets").unionByName(once), params)
        gains = spark.sparkContext.broadcast(_gains(corpus, _target_totals(target, target_text_col, params)))

        of_line = _summed(lines, ["line_key"], gains)
        occurrences = rows.select("row_no", F.explode("line_keys").alias("line_key"))
        inside = join_sums(occurrences, of_line, "line_key").select("row_no", "features", "gain")
        across = _summed(rows, ["row_no"], gains)
        sums = inside.unionByName(across).groupBy("row_no").agg(F.sum("features").alias("n_features"), F.sum("gain").alias("gain"))

        # Whole numbers, rounded down: the remainder goes before the division.
        mean = F.when(F.col("n_features") > 0, F.expr("(gain - pmod(gain, n_features)) div n_features"))
        seeded = F.concat(F.lit(f"{params.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
        h = F.conv(F.substring(F.sha2(seeded, 256), 1, 8), 16, 10).cast("long")
        noise = F.floor(F.lit(-1000) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
        weight = F.coalesce(mean, F.lit(0)).cast("long")
        scored = rows.select("row_no", "doc_id", "n_words").join(sums, "row_no").select(
            "row_no", "doc_id", "n_features", weight.alias("weight"), (weight + noise).cast("long").alias("score"),
            (F.col("n_words") < params.min_words).alias("too_short"),
        )
        scored = area.table(scored, "scored")
        drawn = scored.where(~F.col("too_short")).count() * params.percent // 100
        order = [F.col("too_short"), F.col("score").desc(), F.col("doc_id"), F.col("row_no")]
        placed = _in_order(scored, order, kept)
        rank = F.when(~F.col("too_short") & (F.col("place") <= drawn), F.col("place"))
        return placed.select("doc_id", "n_features", "weight", "score", rank.cast("long").alias("rank"))
