"""Language identification by unigram piece models, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. A word's
probability in a language is the sum over all its segmentations into pieces, by the forward
algorithm; a text's is the product over its words. Nothing but the text enters a prediction.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from tallygraph.llm.lattice import PieceTable, WordNumbers, blocks, by_length, values

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN = "und"
START = "▁"
LETTERS = re.compile(r"[^\W\d_]+")
# Below this, forward sums of long words are scaled up.
TINY, SCALE = 1e-100, 1e100


@dataclass(frozen=True)
class LanguageParams:
    """``docs_per_language`` bounds the sample of distinct texts that a language is learned from.
    More than ``max_languages`` labels are an error, as the model has a row of numbers for each."""

    vocabulary: str = VOCABULARY
    docs_per_language: int = 300
    max_languages: int = 1000
    rounds: int = 4
    smoothing: float = 0.5
    unknown: float = 1e-7


def letter_pieces(path: str = VOCABULARY) -> list[str]:
    """The pieces of a vocabulary that are lower-case letters, with or without a word start."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.vocab_size()))
    return sorted({p for p in pieces if re.fullmatch(f"{START}?[^\\W\\d_]+|{START}", p) and p == p.lower()})


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased, each with a word start. Other characters do not count.

    The pattern also takes signs that stand for numbers, such as a half or a raised two. Runs that
    have one, which are few, are cut there.
    """
    out = []
    for run in LETTERS.findall(text.lower()):
        if run.isalpha():
            out.append(START + run)
        else:
            out += [START + w for w in "".join(c if c.isalpha() else " " for c in run).split()]
    return out


@F.arrow_udf(ArrayType(StringType()))
def _words(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield pa.array([words_of(t or "") for t in values(texts)], pa.list_(pa.string()))


def forward(ids: np.ndarray, probs: np.ndarray, unknown: float) -> tuple[np.ndarray, np.ndarray]:
    """Forward sums of words of one length: ``alpha[j, w, k]`` over prefixes of ``j`` characters
    in model ``k``, and the logarithm of what each word's sums were scaled by."""
    n, length, longest = ids.shape
    alpha = np.zeros((length + 1, n, probs.shape[1]))
    alpha[0] = 1.0
    scaled = np.zeros((n, probs.shape[1]))
    for j in range(1, length + 1):
        for m in range(1, min(j, longest) + 1):
            some = ids[:, j - 1, m - 1]
            rows = np.flatnonzero(some >= 0)
            if len(rows) == n:
                alpha[j] += alpha[j - m] * probs[some]
            elif len(rows):
                alpha[j][rows] += alpha[j - m][rows] * probs[some[rows]]
        alone = np.flatnonzero(ids[:, j - 1, 0] < 0)
        if len(alone):
            alpha[j][alone] += alpha[j - 1][alone] * unknown
        if length > 12:
            low = alpha[j] < TINY
            if low.any():
                window = alpha[max(0, j - longest) : j + 1]
                window[:, low] *= SCALE
                scaled[low] += np.log(SCALE)
    return alpha, scaled


def log_probabilities(
    words: list[str], table: PieceTable, probs: np.ndarray, unknown: float
) -> np.ndarray:
    """``log p(word | model)`` for each word (rows) and model (columns)."""
    out = np.zeros((len(words), probs.shape[1]))
    for some, codes in by_length(words, table.max_len):
        alpha, scaled = forward(table.edges(codes), probs, unknown)
        out[some] = np.log(alpha[-1]) - scaled
    return out


def expected_pieces(
    words: list[str], counts: np.ndarray, table: PieceTable, probs: np.ndarray, unknown: float
) -> np.ndarray:
    """How often each piece is expected in the words under one model (forward and backward sums)."""
    total = np.zeros(len(probs))
    for some, codes in by_length(words, table.max_len):
        ids = table.edges(codes)
        n, length, longest = ids.shape
        padded = np.append(probs, 0.0)
        edge = padded[ids]
        edge[:, :, 0] = np.where(ids[:, :, 0] < 0, unknown, edge[:, :, 0])
        # Logarithms of the sums, each taken relative to the one next to it: the sums of long words
        # are too small for a number, what one character changes is not.
        alpha = np.zeros((n, length + 1))
        beta = np.zeros((n, length + 1))
        for j in range(1, length + 1):
            m = min(j, longest)
            before = alpha[:, j - m : j][:, ::-1]
            step = np.exp(before - before[:, :1]) * edge[:, j - 1, :m]
            alpha[:, j] = before[:, 0] + np.log(step.sum(axis=1))
        for i in range(length - 1, -1, -1):
            m = min(length - i, longest)
            after = beta[:, i + 1 : i + m + 1]
            step = np.exp(after - after[:, :1]) * edge[:, np.arange(i, i + m), np.arange(m)]
            beta[:, i] = after[:, 0] + np.log(step.sum(axis=1))
        whole = alpha[:, length, None]
        for m in range(1, longest + 1):
            ends = slice(m - 1, length)
            around = np.exp(alpha[:, : length + 1 - m] + beta[:, m:] - whole)
            share = around * edge[:, ends, m - 1] * counts[some][:, None]
            hit = ids[:, ends, m - 1] >= 0
            total += np.bincount(ids[:, ends, m - 1][hit], share[hit], len(total))
    return total


def fit_languages(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", params: LanguageParams = LanguageParams()
) -> tuple[list[str], np.ndarray]:
    """The learned languages, in order, and the probability of each piece (row) in each of them.

    Learns from a sample of about ``docs_per_language`` distinct texts of each label, those with a
    low hash, or all if there are no more, by expectation maximisation over all segmentations; each language is
    fitted in a task of its own. What reaches the driver has a row per piece and language, a size
    set by the vocabulary. Rows without a label or a letter teach nothing, and copies no more than
    one of them; without any rows, there are no languages.
    """
    pieces = letter_pieces(params.vocabulary)
    labelled = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    texts = labelled.select("lang", F.xxhash64("text").alias("text_key")).distinct()
    sizes = texts.groupBy("lang").count().limit(params.max_languages + 1).collect()
    if len(sizes) > params.max_languages:
        raise ValueError(f"more than {params.max_languages} languages")
    shares = {r["lang"]: min(1.0, params.docs_per_language / r["count"]) for r in sizes}
    if not shares:
        return [], np.zeros((len(pieces), 0))
    share = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])[F.col("lang")]
    steps = 1 << 20
    sample = labelled.where(F.pmod(F.xxhash64("text"), F.lit(steps)) < share * steps).distinct()
    words = (
        sample.select("lang", F.explode(_words("text")).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n"))
    )

    shared = docs.sparkSession.sparkContext.broadcast(vars(PieceTable(pieces)))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        table = PieceTable.of(shared.value)
        pdf = pdf.sort_values("word")
        words, counts = pdf["word"].tolist(), pdf["n"].to_numpy(float)
        probs = np.full(len(pieces), 1 / len(pieces))
        for _ in range(params.rounds):
            probs = expected_pieces(words, counts, table, probs, params.unknown) + params.smoothing
            probs /= probs.sum()
        if not np.isfinite(probs).all():
            raise ArithmeticError("the piece probabilities are not finite")
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "piece": np.arange(len(pieces)), "p": probs})

    fitted = words.groupBy("lang").applyInPandas(fit, "lang string, piece int, p double").toPandas()
    languages = sorted(fitted["lang"].unique())
    probs = np.zeros((len(pieces), len(languages)))
    for k, lang in enumerate(languages):
        own = fitted[fitted["lang"] == lang]
        probs[own["piece"], k] = own["p"]
    return languages, probs


class _Scorer:
    """Sums of the log probabilities of texts, with each distinct word computed once."""

    def __init__(self, table: PieceTable, probs: np.ndarray, unknown: float):
        self.table, self.probs, self.unknown = table, probs, unknown
        self.numbers = WordNumbers(self._compute, self._clear)
        self._clear()

    def _clear(self) -> None:
        self.scores = np.zeros((0, self.probs.shape[1]))

    def _compute(self, words: list[str]) -> None:
        new = log_probabilities(words, self.table, self.probs, self.unknown)
        self.scores = np.concatenate([self.scores, new])

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words = [words_of(t) for t in texts]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = self.numbers([w for ws in words for w in ws])
        out = np.zeros((len(texts), self.probs.shape[1]))
        if len(flat):
            some = np.flatnonzero(sizes)
            starts = (np.cumsum(sizes) - sizes)[some]
            out[some] = np.add.reduceat(self.scores[flat], starts, axis=0)
        return out, sizes


def language_column(
    docs: DataFrame,
    text: Column,
    languages: list[str],
    probs: np.ndarray,
    params: LanguageParams = LanguageParams(),
) -> Column:
    """``struct(lang_pred, score)`` of a text, by a fitted model.

    ``score`` is the probability of the predicted language given the text, all languages being
    equally likely before. ``und`` with score 0 if the text is null or has no letter, or if
    there are no languages; equal probabilities go to the first language in order.
    """
    table = PieceTable(letter_pieces(params.vocabulary))
    model = docs.sparkSession.sparkContext.broadcast((vars(table), probs))

    @F.arrow_udf("lang_pred string, score double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        state, probs = model.value
        scorer = _Scorer(PieceTable.of(state), probs, params.unknown) if languages else None
        for texts in batches:
            pred = np.full(len(texts), UNKNOWN, object)
            score = np.zeros(len(texts))
            for first, block in blocks(values(texts)) if languages else ():
                logs, sizes = scorer(block)
                known = np.flatnonzero(sizes)
                best = logs[known].argmax(axis=1)
                at = first + known
                pred[at] = np.array(languages, object)[best]
                score[at] = 1 / np.exp(logs[known] - logs[known].max(axis=1, keepdims=True)).sum(axis=1)
            yield pa.StructArray.from_arrays([pa.array(pred, pa.string()), pa.array(score)], ["lang_pred", "score"])

    return predict(text)


def held_out(id_col: str = "doc_id") -> Column:
    """Documents kept for measuring accuracy: a third, by the CRC-32 of the id as text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def identify_languages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    params: LanguageParams = LanguageParams(),
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row, learned from those not held out.

    Rows that repeat an id are judged one by one; other columns are ignored; an empty table gives
    an empty result.
    """
    languages, probs = fit_languages(docs.where(~held_out(id_col)), text_col, lang_col, params)
    found = language_column(docs, F.col(text_col), languages, probs, params)
    return docs.select(
        F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), found.alias("found")
    ).select("doc_id", "held_out", "found.*")
