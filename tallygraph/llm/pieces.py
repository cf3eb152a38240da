"""Encoding into vocabulary pieces with the N best segmentations, and decoding.

The vocabulary is a public SentencePiece model. It is read as a unigram model whose pieces
have Zipf probabilities by their rank, since merge ranks are no probabilities. Spaces become word
starts, one is put before the text, and characters without a piece become byte pieces, so
that decoding gives back every text.

No piece reaches across a word start, a line end or from a letter to an ASCII mark, which is checked,
so a text's lattice falls apart into those of its words. Words are segmented once per task by a forward Viterbi pass. A text's alternatives
differ from its best segmentation in the words whose second best is nearest; only these are
searched, backwards by A* with the forward scores as exact heuristics.
"""

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallygraph.llm.lattice import PieceTable, WordNumbers, blocks, by_length, values

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
START = "▁"
# Stands for a literal word start in a text: a character without a piece, which no text can hold.
LITERAL = "\ud800"
# Parts of a text that no piece reaches across: letters up to a space or an ASCII mark, and what
# follows up to the next space; spaces; line ends. The spaces before a part belong to it.
MARKS = r"!-@\[-`{-~"
LETTER = r"[^\W\d_¹²³]"
WORDS = re.compile(rf"{START}*{LETTER}++(?=[{START}\n{MARKS}]|\Z)|{START}*[^{START}\n]+|{START}+|\n")
MIXED = re.compile(rf"{LETTER}[{MARKS}]")
UNKNOWN_PENALTY = 10.0
REPLACEMENT = "\ufffd".encode()
# Scores are whole multiples of this, so that sums of them are exact and equal scores are equal.
UNIT = 2.0**-24
# Longer words are segmented one by one.
LONG = 1_000


@dataclass
class PieceModel:
    ids: np.ndarray
    scores: np.ndarray
    unknown: float
    byte_ids: np.ndarray
    texts: list[bytes]
    table: PieceTable
    index: dict[str, int]
    score_list: list[float]


def load_model(path: str = VOCABULARY) -> PieceModel:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.vocab_size()
    special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
    names = [model.id_to_piece(i) for i in range(size)]
    is_byte = [model.is_byte(i) for i in range(size)]
    ids = np.array([i for i in range(size) if not special[i] and not is_byte[i]], np.int32)
    byte_ids = np.array([i for i in range(size) if is_byte[i]], np.int32)
    if len(byte_ids) != 256:
        raise ValueError("the vocabulary has no byte pieces, so it can't encode every text")
    pieces = [names[i] for i in ids]
    bare = [p.lstrip(START) for p in pieces]
    if any(LITERAL in p or "\n" in p or START in p or MIXED.search(p) for p in bare):
        raise ValueError("a piece reaches across a word start, a line end or from a letter to a mark")
    texts = [b"" if special[i] else names[i].replace(START, " ").encode() for i in range(size)]
    for value, i in enumerate(byte_ids):
        texts[i] = bytes([value])
    ranks = np.arange(1, len(pieces) + 1)
    scores = -np.log(ranks) - np.log((1 / ranks).sum())
    scores = np.round(scores / UNIT) * UNIT
    unknown = float(scores.min()) - UNKNOWN_PENALTY
    index = {p: k for k, p in enumerate(pieces)}
    return PieceModel(ids, scores, unknown, byte_ids, texts, PieceTable(pieces), index, scores.tolist())


def lattice_form(text: str) -> str:
    """A text as the lattice reads it, with word starts for spaces."""
    if START in text:
        text = text.replace(START, LITERAL)
    return text.replace(" ", START)


def _bytes_of(c: str) -> bytes:
    """The UTF-8 of a character of the lattice form that has no piece."""
    return (START if c == LITERAL else c).encode()


def n_best(form: str, model: PieceModel, n: int) -> list[tuple[float, list[tuple[int, int]]]]:
    """The ``n`` best segmentations of a word in lattice form, best first: score and pieces, each as
    its end and length. Of equal scores, the one whose last piece is longest comes first, and so on
    to the left.

    The forward pass leaves the best score of each prefix. The search goes backwards from the end;
    what is ahead costs exactly that, so the first path to arrive is the best. A path is extended by
    its best piece, and the next best one joins once that has been taken. The ``n`` best paths need
    no position more than ``n`` times, so the work is bounded by ``n`` times the length.
    """
    length, longest = len(form), model.table.max_len
    find, scores = model.index.get, model.score_list
    best = [0.0] * (length + 1)

    for j in range(1, length + 1):
        k = find(form[j - 1 : j])
        most = best[j - 1] + (model.unknown if k is None else scores[k])
        for m in range(2, min(j, longest) + 1):
            k = find(form[j - m : j])
            if k is not None and best[j - m] + scores[k] > most:
                most = best[j - m] + scores[k]
        best[j] = most

    def ways_to(j: int) -> list[tuple[float, int, float]]:
        """The last pieces of a prefix: the best score with each, its length and own score."""
        found = []
        for m in range(1, min(j, longest) + 1):
            k = find(form[j - m : j])
            if k is not None or m == 1:
                score = model.unknown if k is None else scores[k]
                found.append((best[j - m] + score, m, score))
        return sorted(found, reverse=True)

    if not length:
        return [(0.0, [])]
    heap: list[tuple] = []
    taken: dict[int, int] = {}
    out: list = []

    def push(done: float, j: int, path: tuple | None, ways: list, k: int) -> None:
        if k < len(ways):
            total, m, score = ways[k]
            heapq.heappush(heap, (-(done + total), j - m, len(heap), k, done + score, (j, m), path, ways, done))

    push(0.0, length, None, ways_to(length), 0)
    while heap and len(out) < n:
        _, i, _, k, done, step, path, ways, before = heapq.heappop(heap)
        push(before, step[0], path, ways, k + 1)
        if taken.get(i, 0) >= n:
            continue
        taken[i] = taken.get(i, 0) + 1
        path = (step, path)
        if i:
            push(done, i, path, ways_to(i), 0)
            continue
        steps = []
        while path:
            step, path = path
            steps.append(step)
        out.append((done, steps))
    return out


def piece_ids(form: str, steps: list[tuple[int, int]], model: PieceModel) -> list[int]:
    """Vocabulary ids of a segmentation; a character without a piece gives its bytes."""
    out: list[int] = []
    for j, m in steps:
        piece = model.index.get(form[j - m : j])
        if piece is None:
            out.extend(model.byte_ids[list(_bytes_of(form[j - 1]))].tolist())
        else:
            out.append(int(model.ids[piece]))
    return out


class _Segmenter:
    """Best segmentations of distinct words, and how far their second best is behind."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.numbers = WordNumbers(self._compute, self._clear)
        self._clear()

    def _clear(self) -> None:
        self.score, self.gap = np.zeros(0), np.zeros(0)
        self.chars, self.size, self.start = (np.zeros(0, np.int64) for _ in range(3))
        self.flat = np.zeros(0, np.int32)

    def _compute(self, words: list[str]) -> None:
        score, gap = np.zeros(len(words)), np.zeros(len(words))
        size, start = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        parts, at = [], len(self.flat)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        short = np.flatnonzero(lengths <= LONG)
        for i in np.flatnonzero(lengths > LONG).tolist():
            found = n_best(words[i], self.model, 2)
            score[i], gap[i] = found[0][0], found[0][0] - found[1][0] if len(found) > 1 else np.inf
            own = np.array(piece_ids(words[i], found[0][1], self.model), np.int32)
            size[i], start[i] = len(own), at
            at += len(own)
            parts.append(own)
        for some, codes in by_length([words[i] for i in short], self.model.table.max_len):
            some = short[some]
            score[some], gap[some], flat, size[some] = self._block(codes, [words[i] for i in some])
            start[some] = at + np.cumsum(size[some]) - size[some]
            at += len(flat)
            parts.append(flat)
        self.score = np.concatenate([self.score, score])
        self.gap = np.concatenate([self.gap, gap])
        self.size = np.concatenate([self.size, size])
        self.start = np.concatenate([self.start, start])
        self.chars = np.concatenate([self.chars, lengths])
        self.flat = np.concatenate([self.flat, *parts])

    def _block(self, codes: np.ndarray, words: list[str]) -> tuple:
        model = self.model
        ids = model.table.edges(codes)
        n, length, longest = ids.shape
        edge = np.append(model.scores, -np.inf)[ids]
        edge[:, :, 0] = np.where(ids[:, :, 0] < 0, model.unknown, edge[:, :, 0])
        # The best and the second best score of each prefix, and the last piece of the best.
        best, second = np.zeros((n, length + 1)), np.full((n, length + 1), -np.inf)
        taken = np.zeros((n, length + 1), np.int64)
        every = np.arange(n)
        for j in range(1, length + 1):
            m = min(j, longest)
            ways = best[:, j - m : j][:, ::-1] + edge[:, j - 1, :m]
            last = taken[:, j] = ways.argmax(axis=1)
            best[:, j] = ways[every, last]
            # Second is the best other way, or the second best way to the same piece.
            ways[every, last] = second[every, j - 1 - last] + edge[every, j - 1, last]
            second[:, j] = ways.max(axis=1)
        taken[:, 1:] += 1
        # The best path, backwards in all words at once.
        on_path = np.zeros((n, length + 1), np.int64)
        rows, at = np.arange(n), np.full(n, length)
        while len(rows):
            on_path[rows, at] = taken[rows, at]
            at = at - taken[rows, at]
            rows, at = rows[at > 0], at[at > 0]
        rows, ends = np.nonzero(on_path)
        found = ids[rows, ends - 1, on_path[rows, ends] - 1]
        flat = np.where(found >= 0, model.ids[found], -1)
        if (lost := np.flatnonzero(found < 0)).size:
            raw = [_bytes_of(words[rows[k]][ends[k] - 1]) for k in lost]
            times = np.ones(len(found), np.int64)
            times[lost] = [len(b) for b in raw]
            flat, rows = np.repeat(flat, times), np.repeat(rows, times)
            flat[flat < 0] = model.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        gap = best[:, length] - second[:, length]
        return best[:, length], gap, flat.astype(np.int32), np.bincount(rows, minlength=n)


class _Encoder:
    def __init__(self, model: PieceModel, n: int):
        self.model, self.n = model, n
        self.words = _Segmenter(model)
        self.alternatives: dict[str, list] = {}

    def _word_list(self, word: str) -> list[tuple[float, list[int]]]:
        if word not in self.alternatives:
            if len(self.alternatives) > 50_000:
                self.alternatives.clear()
            found = n_best(word, self.model, self.n)
            self.alternatives[word] = [(s - found[0][0], piece_ids(word, p, self.model)) for s, p in found]
        return self.alternatives[word]

    def _near(self, gaps: np.ndarray) -> list[int]:
        """The ``n - 1`` words whose second best is nearest, the first ones of equally near."""
        few = self.n - 1
        if len(gaps) > few > 0:
            limit = np.partition(gaps, few - 1)[few - 1]
            nearer = np.flatnonzero(gaps < limit)
            near = np.concatenate([nearer, np.flatnonzero(gaps == limit)[: few - len(nearer)]])
        else:
            near = np.arange(len(gaps))[: max(few, 0)]
        return sorted(near[np.isfinite(gaps[near])].tolist())

    def _ranked(self, words: list[str], numbers: np.ndarray, score: float, pieces: int) -> list[tuple]:
        near = self._near(self.words.gap[numbers])
        ends = np.cumsum(self.words.chars[numbers])
        ways: list[tuple[float, tuple]] = [(0.0, ())]
        for i in near:
            options = self._word_list(words[i])
            more = [
                (-(loss + options[r][0]), (*made, (i, r)) if r else made)
                for loss, made in ways
                for r in range(len(options))
            ]
            ways = [(-cost, made) for cost, made in heapq.nsmallest(self.n, more)]
        out = []
        for loss, made in ways:
            changes = []
            extra = 0
            for i, r in made:
                own = self._word_list(words[i])[r][1]
                extra += len(own) - int(self.words.size[numbers[i]])
                end = int(ends[i]) - 1
                changes.append((max(0, end - len(words[i])), end, own))
            out.append((score + loss, pieces + extra, changes))
        return out

    def __call__(self, texts: list[str]) -> "Encoded":
        split = [WORDS.findall(lattice_form(" " + t)) if t else [] for t in texts]
        flat = self.words.numbers([w for ws in split for w in ws])
        sizes = self.words.size[flat]
        ends = np.cumsum([len(ws) for ws in split])
        ids = self.words.flat[np.repeat(self.words.start[flat] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
        made = np.append(0, np.cumsum(sizes))[np.append(0, ends)]
        scores, nbest = [], []
        for t, (ws, end) in enumerate(zip(split, ends.tolist(), strict=True)):
            numbers = flat[end - len(ws) : end]
            scores.append(float(self.words.score[numbers].sum()))
            nbest.append(self._ranked(ws, numbers, scores[-1], int(made[t + 1] - made[t])))
        return Encoded(ids, made, scores, nbest)


class Encoded(NamedTuple):
    """``ids`` of all texts, one after the other, and where each text's end; the best scores, and
    the segmentations as ``(score, n_pieces, changes)`` with changes ``(start, end, ids)``."""

    ids: np.ndarray
    ends: np.ndarray
    scores: list[float]
    nbest: list[list[tuple]]

    def arrays(self) -> list[pa.Array]:
        def listed(sizes: list[int], inner: pa.Array) -> pa.ListArray:
            return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), inner)

        def struct(**columns: pa.Array) -> pa.StructArray:
            return pa.StructArray.from_arrays(list(columns.values()), list(columns))

        ways = [way for text in self.nbest for way in text]
        changes = [change for way in ways for change in way[2]]
        changed = struct(
            start=pa.array([c[0] for c in changes], pa.int32()),
            end=pa.array([c[1] for c in changes], pa.int32()),
            ids=listed([len(c[2]) for c in changes], pa.array([i for c in changes for i in c[2]], pa.int32())),
        )
        best = struct(
            score=pa.array([w[0] for w in ways], pa.float64()),
            n_pieces=pa.array([w[1] for w in ways], pa.int64()),
            changes=listed([len(w[2]) for w in ways], changed),
        )
        return [
            pa.ListArray.from_arrays(pa.array(self.ends.astype(np.int32)), pa.array(self.ids, pa.int32())),
            pa.array(np.diff(self.ends), pa.int64()),
            pa.array(self.scores, pa.float64()),
            listed([len(text) for text in self.nbest], best),
        ]


ENCODED = (
    "ids array<int>, n_pieces long, score double, "
    "nbest array<struct<score: double, n_pieces: bigint, changes: array<struct<start: int, `end`: int, ids: array<int>>>>>"
)


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY, n: int = 4
) -> DataFrame:
    """One row per input row: ``doc_id, ids, n_pieces, score, nbest``.

    ``ids`` is the best segmentation. ``nbest`` has the ``n`` best ones (fewer if there are
    fewer), best first: the score, the number of pieces, and the words in which it differs from
    the best, as the start and end of their characters and their ids (with the space before
    them; that of the first word is not in the text). Equal scores are ordered by the place of
    the change. A null text is an empty one: no ids, and one segmentation of score 0. Texts of any
    length are encoded whole, about a million characters at a time in a task, and so are words without a space in
    them. Rows that repeat an id are encoded one by one. Other columns are ignored; an empty table gives an empty result.
    """
    session = docs.sparkSession
    model = load_model(path)
    state = session.sparkContext.broadcast(vars(model) | {"table": vars(model.table)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PieceTable.of(state.value["table"])
        encoder = _Encoder(PieceModel(**state.value | {"table": table}), n)
        names = ["doc_id", "ids", "n_pieces", "score", "nbest"]
        for batch in batches:
            for first, block in blocks(values(batch["text"]), 1_000_000):
                own = batch["doc_id"].slice(first, len(block))
                yield pa.RecordBatch.from_arrays([own, *encoder(block).arrays()], names)

    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = StructType([plain.schema["doc_id"], *StructType.fromDDL(ENCODED).fields])
    return plain.mapInArrow(run, schema)


def decoded(docs: DataFrame, ids: Column, path: str = VOCABULARY) -> Column:
    """The text of an array of ids. Null gives null, an id that is not in the vocabulary or a
    null one the replacement character; so do bytes that are no UTF-8."""
    texts = docs.sparkSession.sparkContext.broadcast(load_model(path).texts)

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # The last entry stands for ids that are not in the vocabulary.
        known = np.array([*texts.value, REPLACEMENT], object)
        for batch in batches:
            flat = batch.values.fill_null(-1).to_numpy(zero_copy_only=False)
            flat = np.where((flat < 0) | (flat >= len(known)), -1, flat)
            ends, empty = batch.offsets.to_numpy(), batch.is_null().to_numpy(zero_copy_only=False)
            out = []
            for i in range(len(batch)):
                raw = b"".join(known[flat[ends[i] : ends[i + 1]]])
                out.append(None if empty[i] else raw[raw.startswith(b" ") :].decode(errors="replace"))
            yield pa.array(out, pa.string())

    return run(ids)
