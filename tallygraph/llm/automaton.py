"""Minimal acyclic acceptors, and their composition with a one-edit transducer."""

from collections.abc import Iterable, Iterator


class Acceptor:
    """The smallest deterministic automaton for a finite set of words. State 0 is the first one."""

    def __init__(self, words: Iterable[str]):
        """``words`` may repeat and come in any order."""
        self.arcs: list[dict[str, int]] = [{}]
        self.final: list[bool] = [False]
        self._register: dict[tuple, int] = {}
        self._free: list[int] = []
        path, before = [0], ""
        for word in sorted(set(words)):
            shared = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                shared += 1
            self._settle(path, before, shared)
            for c in word[shared:]:
                state = self._new()
                self.arcs[path[-1]][c] = state
                path.append(state)
            self.final[path[-1]] = True
            before = word
        self._settle(path, before, 0)
        del self._register, self._free

    def _new(self) -> int:
        if self._free:
            return self._free.pop()
        self.arcs.append({})
        self.final.append(False)
        return len(self.arcs) - 1

    def _settle(self, path: list[int], word: str, depth: int) -> None:
        """Replace the states of the last word beyond ``depth`` by equal ones, the deepest first."""
        while len(path) > depth + 1:
            state = path.pop()
            form = (self.final[state], *self.arcs[state].items())
            known = self._register.setdefault(form, state)
            if known != state:
                self.arcs[path[-1]][word[len(path) - 1]] = known
                self.arcs[state], self.final[state] = {}, False
                self._free.append(state)

    def near_pairs(self, first: int = 0, end: int | None = None) -> Iterator[tuple[str, str]]:
        """Pairs of accepted words that differ by one inserted, deleted or replaced character,
        each pair once, whose longest common prefix has ``first`` up to ``end - 1`` characters.

        This walks the composition of the acceptor, the transducer and the acceptor. Before the edit
        both sides are in the same state; the edit takes them to two; after it only what both
        accept goes on. What follows a state does not depend on how it was reached, so its edits are
        found once, however many prefixes lead there.
        """
        edits: dict[int, list[tuple[str, str]]] = {}
        walk = [(0, "")]
        while walk:
            state, read = walk.pop()
            if len(read) >= first:
                if state not in edits:
                    edits[state] = list(self._edits(state))
                for left, right in edits[state]:
                    yield read + left, read + right
            if end is None or len(read) + 1 < end:
                walk.extend((after, read + c) for c, after in self.arcs[state].items())

    def _edits(self, state: int) -> Iterator[tuple[str, str]]:
        """What both sides read from here on if the edit comes next."""
        arcs = list(self.arcs[state].items())
        for i, (c, left) in enumerate(arcs):
            for d, right in arcs[i + 1 :]:
                for rest in self._common(left, right):
                    yield c + rest, d + rest
        for d, right in arcs:
            # Where the other side goes on with the same character, the prefix is longer than this.
            for rest in self._common(state, right, d):
                yield rest, d + rest

    def _common(self, left: int, right: int, not_first: str = "") -> Iterator[str]:
        """All words that both states accept, without those that start with ``not_first``."""
        walk = [(left, right, "")]
        while walk:
            a, b, read = walk.pop()
            if self.final[a] and self.final[b]:
                yield read
            few, many = self.arcs[a], self.arcs[b]
            if len(few) > len(many):
                few, many = many, few
            for c, after in few.items():
                other = many.get(c)
                if other is not None and (read or c != not_first):
                    walk.append((after, other, read + c))
