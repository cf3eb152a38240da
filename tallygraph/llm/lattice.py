"""Piece lattices of many words at once.

A word's lattice has an edge for each piece of a vocabulary that occurs in it. Words of one
length are handled together: all their substrings of one length are looked up with a few NumPy
operations, so the cost per word does not include Python's.
"""

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
# Pairs of a word and one of its substrings handled at once: 4 bytes for the piece of each.
EDGES = 1_000_000


def code_points(word: str) -> np.ndarray:
    return np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32)


class PieceTable:
    """Numbers of the pieces, found by their text. Pieces must be distinct and not empty."""

    def __init__(self, pieces: list[str]):
        self.max_len = max(map(len, pieces), default=1)
        self.powers = np.cumprod(np.append(np.uint64(1), np.full(self.max_len, _BASE)))
        # One more entry, which the empty slots point to.
        self.hashes = np.zeros(len(pieces) + 1, np.uint64)
        for some, codes in by_length(pieces, 1):
            self.hashes[some] = self._prefix_hashes(codes)[:, -1]
        bits = max(10, int(np.ceil(np.log2(len(pieces) + 1))) + 4)
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int32)
        self.probes = 1
        taken: set[int] = set()
        for i, slot in enumerate(((self.hashes[:-1] * _MIX) >> self.shift).tolist()):
            at, probes = slot, 1
            while at in taken:
                at, probes = (at + 1) % len(self.slots), probes + 1
            taken.add(at)
            self.slots[at] = i
            self.probes = max(self.probes, probes)

    @classmethod
    def of(cls, state: dict) -> "PieceTable":
        """A table from its ``vars``, which can be broadcast to tasks without this module."""
        table = cls.__new__(cls)
        vars(table).update(state)
        return table

    @staticmethod
    def _prefix_hashes(codes: np.ndarray) -> np.ndarray:
        hashes = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
        for j in range(codes.shape[1]):
            hashes[:, j + 1] = hashes[:, j] * _BASE + (codes[:, j].astype(np.uint64) + np.uint64(1))
        return hashes

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        at = ((hashes * _MIX) >> self.shift).astype(np.int64)
        found = self.slots[at]
        missed = np.flatnonzero((self.hashes[found] != hashes) & (found >= 0))
        found[missed] = -1
        for probe in range(1, self.probes):
            if not len(missed):
                break
            other = self.slots[(at[missed] + probe) % len(self.slots)]
            hit = (other >= 0) & (self.hashes[other] == hashes[missed])
            found[missed[hit]] = other[hit]
            missed = missed[~hit & (other >= 0)]
        return found

    def edges(self, codes: np.ndarray) -> np.ndarray:
        """For words of one length, a row of code points each: ``ids[w, j, m]`` is the piece that
        ends with the character ``j`` and has ``m + 1`` characters, or -1."""
        n, length = codes.shape
        longest = min(self.max_len, length)
        ids = np.full((n, length, longest), -1, np.int32)
        hashes = self._prefix_hashes(codes)
        for m in range(1, longest + 1):
            part = hashes[:, m:] - hashes[:, : length + 1 - m] * self.powers[m]
            ids[:, m - 1 :, m - 1] = self._find(part.ravel()).reshape(part.shape)
        return ids


def by_length(words: list[str], max_len: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions in ``words`` and code points of words of one length, in blocks of bounded size."""
    if not words:
        return
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    bounds = np.flatnonzero(np.diff(lengths[order], prepend=-1))
    for start, end in zip(bounds, [*bounds[1:], len(words)], strict=True):
        length = int(lengths[order[start]])
        step = max(1, EDGES // max(1, length * min(length, max_len)))
        for at in range(start, end, step):
            some = order[at : min(at + step, end)]
            codes = code_points("".join([words[i] for i in some])).reshape(len(some), length)
            yield some, codes


class _Numbers(dict):
    """Gives each new key the next number."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        self.new.append(key)
        return n


class WordNumbers:
    """Numbers distinct words within a task, so that each is computed once and not per occurrence.

    ``compute`` gets a list of new words. After ``limit`` words the numbering starts anew, which
    bounds the memory; results do not depend on it.
    """

    def __init__(self, compute: Callable[[list[str]], None], reset: Callable[[], None], limit: int = 100_000):
        self._compute, self._reset, self._limit = compute, reset, limit
        self._numbers = _Numbers()

    def __call__(self, words: list[str]) -> np.ndarray:
        if len(self._numbers) > self._limit:
            self._numbers = _Numbers()
            self._reset()
        found = np.fromiter(map(self._numbers.__getitem__, words), np.int64, len(words))
        if self._numbers.new:
            self._compute(self._numbers.new)
            self._numbers.new = []
        return found


def values(texts: pa.Array, step: int = 32) -> Iterator[str | None]:
    """The values of an Arrow array, a few as Python strings at a time."""
    for at in range(0, len(texts), step):
        yield from texts.slice(at, step).to_pylist()


def blocks(texts: Iterable[str | None], chars: int = 1_000_000) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of about so many characters together; null is empty. With each block,
    the position of its first text."""
    block: list[str] = []
    first = size = n = 0
    for text in texts:
        block.append(text or "")
        n += 1
        size += len(block[-1])
        if size >= chars:
            yield first, block
            block, first, size = [], n, 0
    if block:
        yield first, block
