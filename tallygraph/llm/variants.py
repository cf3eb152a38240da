"""Spelling variants: words that are one edit apart, found by finite-state composition.

The vocabulary's minimal acceptor is composed with a transducer that makes one edit, and with the
acceptor again; the pairs accepted are the words one edit apart. The composition is cut by
initial states: words of one partition share their first characters, so both sides of a pair with a
later edit read the same ones and stand in the same partition. The pairs with an edit among the
first characters share the last ones instead, and are accepted in partitions by those.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygraph.llm.automaton import Acceptor
from tallygraph.llm.joins import join_sums
from tallygraph.llm.text import fold_case
from tallygraph.staging import Staging, staging

# Fixed value: the letters that words consist of.
LETTERS = r"[A-Za-zÀ-ÿ]"


@dataclass(frozen=True)
class VariantParams:
    """Words have ``min_chars`` code points and ``min_count`` occurrences or more. A form has
    ``ratio`` times the occurrences. One run in ``typo_modulus`` loses a code point, which plants
    misspellings; 0 plants none. Partitions of more than ``partition_words`` words are cut further."""

    min_chars: int = 6
    min_count: int = 5
    ratio: int = 5
    typo_modulus: int = 199
    partition_words: int = 20_000


def count_words(docs: DataFrame, params: VariantParams = VariantParams()) -> DataFrame:
    """``word, n`` for the runs of letters in ``doc_id, text``, A-Z lower-cased, counted in the tasks
    before they are shuffled. Shorter runs never become words, so they are not even taken."""
    runs = F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{params.min_chars},}}"), F.lit(0))
    run = F.col("run")
    # Most runs have no capital, and folding is dear.
    folded = F.when(F.lower(run) == run, run).otherwise(fold_case(run))
    found = docs.select("doc_id", F.explode(runs).alias("run")).select("doc_id", folded.alias("run"))
    if params.typo_modulus:
        named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
        hashed = found.select("run", F.crc32(named.cast("binary")).alias("h"))
        at = (F.col("h") % F.length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        found = hashed.select(F.when(F.col("h") % params.typo_modulus == 0, cut).otherwise(F.col("run")).alias("run"))
    words = found.select(F.col("run").alias("word")).where(F.length("word") >= params.min_chars)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= params.min_count)


# A partition's words share their first ``a`` and last ``b`` characters. It accepts the pairs whose
# longest common prefix has ``a`` to ``end - 1`` characters and whose longer word has more than
# ``a + b``; if it is ``short``, exactly one more.
PARTITION = ["a", "b", "end", "short", "head", "tail"]
NO_END = 1 << 30


def _partition(a: Column, b: Column, end: Column, short: Column) -> Column:
    head, tail = F.substring("word", F.lit(1), a), F.when(b > 0, F.substring("word", F.length("word") - b + 1, b)).otherwise("")
    return F.struct(
        a.alias("a"), b.alias("b"), end.alias("end"), short.alias("short"), head.alias("head"), tail.alias("tail")
    )


def _partitions(words: DataFrame, params: VariantParams) -> DataFrame:
    """Each word under both its first and its last characters. One edit leaves the first half or
    the last half of the longer word alone, and words have ``min_chars`` or more."""
    part = params.min_chars // 2
    half, none, no_end = F.lit(part), F.lit(0), F.lit(NO_END)
    both = F.array(_partition(half, none, no_end, F.lit(False)), _partition(none, half, half, F.lit(False)))
    return words.select("word", "n", F.explode(both).alias("part")).select("word", "n", "part.*")


def _refined(rows: DataFrame) -> DataFrame:
    """The rows of a partition dealt to finer ones, so that each pair is still accepted once.

    A longer word of ``a + b + 1`` characters leaves room for one letter only: such pairs stay
    together, no more words than there are letters. In a longer pair the edit is behind the next
    character, which then belongs to the shared first ones, or before the next one from the end.
    """
    a, b, end, length = F.col("a"), F.col("b"), F.col("end"), F.length("word")
    finer = F.array(
        F.when(length <= a + b + 1, _partition(a, b, end, F.lit(True))),
        F.when((length >= a + b + 1) & (a + 1 < end), _partition(a + 1, b, end, F.lit(False))),
        F.when(length >= a + b + 1, _partition(a, b + 1, F.least(end, a + 1), F.lit(False))),
    )
    dealt = rows.select("word", "n", F.explode(F.filter(finer, F.isnotnull)).alias("part"))
    return dealt.select("word", "n", "part.*")


def _bounded(rows: DataFrame, area: Staging, limit: int) -> DataFrame:
    """Refine partitions until none has more than ``limit`` words. Sizes are counted in the tasks
    first; fewer than one row in ``limit`` is a heavy partition, so their list is broadcast."""
    done, n = [], 0
    while True:
        rows, n = area.table(rows, f"partitions{n}"), n + 1
        sizes = rows.where(~F.col("short")).groupBy(*PARTITION).agg(F.count("*").alias("size"))
        heavy = area.table(sizes.where(F.col("size") > limit).select(*PARTITION), f"heavy{n}")
        if heavy.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(F.broadcast(heavy), PARTITION, "left_anti").select(*rows.columns))
        rows = _refined(rows.join(F.broadcast(heavy), PARTITION, "left_semi"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _accepted(words: list[str], counts: list[int], a: int, b: int, end: int, short: bool) -> Iterator[tuple]:
    """Both directions of the pairs that one partition accepts."""
    number = {w[a : len(w) - b]: i for i, w in enumerate(words)}
    for left, right in Acceptor(number).near_pairs(0, end - a):
        i, j = number[left], number[right]
        if short and max(len(left), len(right)) > 1:
            continue
        # What two words share at the start may reach into the last characters, which are cut off here.
        if end == NO_END or len(commonprefix([words[i], words[j]])) < end:
            yield words[i], words[j], counts[j]
            yield words[j], words[i], counts[i]


def near_words(words: DataFrame, params: VariantParams = VariantParams()) -> DataFrame:
    """``word, near, near_n`` for each ordered pair of words of ``word, n`` that are one edit apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["word", "near", "near_n"]

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.string(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array([row[k] for row in found], kind) for k, kind in enumerate(kinds)], names
            )

        def parts() -> Iterator[tuple]:
            """A partition's rows come one after the other, maybe over several batches."""
            now, words, counts = None, [], []
            for batch in batches:
                columns = [batch[name].to_pylist() for name in ["word", "n", *PARTITION]]
                for word, n, *key in zip(*columns, strict=True):
                    if key != now:
                        if len(words) > 1:
                            yield words, counts, now
                        now, words, counts = key, [], []
                    words.append(word)
                    counts.append(n)
            if len(words) > 1:
                yield words, counts, now

        found: list[tuple] = []
        for words, counts, (a, b, end, short, _, _) in parts():
            for row in _accepted(words, counts, a, b, end, short):
                found.append(row)
                if len(found) >= 10_000:
                    yield batch_of(found)
                    found = []
        yield batch_of(found)

    spark = words.sparkSession
    kept = Staging(spark)
    with staging(spark) as area:
        rows = _bounded(_partitions(words, params), area, params.partition_words)
        together = rows.repartition(*PARTITION).sortWithinPartitions(*PARTITION)
        pairs = together.mapInArrow(run, "word string, near string, near_n long")
        return kept.table(pairs, "near")


def _roots(forms: DataFrame, kept: Staging) -> DataFrame:
    """``word, root`` for the words of ``word, form``: the last word that the forms lead to.

    A form has several times the occurrences of its word, so the way is short and never comes
    back. Each round doubles the steps taken.
    """
    spark = forms.sparkSession
    with staging(spark) as area:
        state = area.table(forms.select("word", F.col("form").alias("root")), "round0")
        n = 0
        while True:
            n += 1
            onward = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
            led = join_sums(state, onward, "root", "left")
            after = area.table(led.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"round{n}")
            if after.where("moved").isEmpty():
                return kept.table(after.select("word", "root"), "roots")
            state = after.select("word", "root")


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: VariantParams = VariantParams()
) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``.

    ``n`` counts the word over all rows, ``n_near`` the words one edit away. ``form`` is the most frequent of
    those, the first in code-point order if several are, provided that it has ``ratio`` times the
    occurrences; else it is null, and so is ``form_n``. ``root`` is where following the forms ends. A null text
    has no words, and an empty one neither; texts and runs of letters of any length are taken whole. A null id counts as
    an empty one; rows that repeat an id count like any others; other columns are ignored; an empty
    table gives an empty result.

    Words are counted before they are shuffled, so a very frequent one is a row per task. The
    vocabulary, which grows with the corpus, stays in tables: one task holds the acceptor of one
    partition, which is bounded. The tables that the result reads stay in ``spark.checkpoint.dir``.
    """
    kept = Staging(docs.sparkSession)
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    words = kept.table(count_words(plain, params), "words")
    near = near_words(words, params)
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near").alias("form"))).alias("best")
    by_word = near.groupBy("word").agg(F.count("*").alias("n_near"), best)
    enough = -F.col("best.minus_n") >= F.col("n") * params.ratio
    judged = words.join(by_word, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.form")).alias("form"),
        F.when(enough, -F.col("best.minus_n")).alias("form_n"),
    )
    judged = kept.table(judged, "judged")
    roots = _roots(judged.where(F.col("form").isNotNull()), kept)
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
