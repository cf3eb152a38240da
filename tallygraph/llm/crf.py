"""A small linear-chain conditional random field, trained and decoded with NumPy."""

from collections.abc import Callable, Sequence

import numpy as np


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


class ChainCRF:
    """Labels of the tokens of a sequence, given binary features of each token and its neighbours.

    ``features`` maps a token to its features; there are few distinct ones, so they are numbered
    and scored once. The first label is the background.
    """

    def __init__(self, labels: Sequence[str], features: Callable[[str], tuple[int, ...]], n_features: int):
        self.labels, self.features, self.n_features = list(labels), features, n_features
        k = len(self.labels)
        # For the token itself, the one before and the one after.
        self.weights = np.zeros((3, n_features, k))
        self.moves = np.zeros((k, k))
        self.first = np.zeros(k)

    def _design(self, rows: Sequence[Sequence[str]], length: int) -> np.ndarray:
        x = np.zeros((3, len(rows), length, self.n_features))
        for r, tokens in enumerate(rows):
            for t, token in enumerate(tokens):
                found = list(self.features(token))
                x[0, r, t, found] = 1
                if t + 1 < len(tokens):
                    x[1, r, t + 1, found] = 1
                if t:
                    x[2, r, t - 1, found] = 1
        return x

    def fit(
        self,
        rows: Sequence[Sequence[str]],
        labels: Sequence[Sequence[str]],
        steps: int = 150,
        rate: float = 0.1,
        shrink: float = 0.002,
    ) -> "ChainCRF":
        """Maximises the penalised likelihood by gradient steps (Adam). The same rows give the
        same weights."""
        if not rows:
            return self
        number = {name: i for i, name in enumerate(self.labels)}
        n, length, k = len(rows), max(map(len, rows)), len(self.labels)
        x = self._design(rows, length)
        y = np.zeros((n, length), np.int64)
        on = np.zeros((n, length), bool)
        for r, names in enumerate(labels):
            y[r, : len(names)] = [number[name] for name in names]
            on[r, : len(names)] = True
        flat = np.ascontiguousarray(x.transpose(1, 2, 0, 3)).reshape(n * length, -1)
        truth = np.eye(k)[y] * on[..., None]
        true_moves = np.einsum("rti,rtj->ij", truth[:, :-1], truth[:, 1:])
        params = [self.weights, self.moves, self.first]
        mean, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for step in range(1, steps + 1):
            emission = (flat @ self.weights.reshape(-1, k)).reshape(n, length, k)
            alpha, beta = np.zeros((n, length, k)), np.zeros((n, length, k))
            alpha[:, 0] = self.first + emission[:, 0]
            for t in range(1, length):
                along = _log_sum(alpha[:, t - 1, :, None] + self.moves, 1) + emission[:, t]
                # Beyond its end a sequence stands still, so its last sums are at the end.
                alpha[:, t] = np.where(on[:, t, None], along, alpha[:, t - 1])
            for t in range(length - 2, -1, -1):
                along = _log_sum(self.moves + (emission[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
                beta[:, t] = np.where(on[:, t + 1, None], along, 0)
            total = _log_sum(alpha[:, -1], 1)
            here = np.exp(alpha + beta - total[:, None, None]) * on[..., None]
            pair = (
                alpha[:, :-1, :, None]
                + self.moves
                + (emission[:, 1:] + beta[:, 1:])[:, :, None, :]
                - total[:, None, None, None]
            )
            moved = (np.exp(np.where(on[:, 1:, None, None], pair, -np.inf))).sum(axis=(0, 1))
            gap = (truth - here).reshape(n * length, k)
            slopes = [
                (flat.T @ gap).reshape(self.weights.shape),
                true_moves - moved,
                (truth - here)[:, 0].sum(axis=0),
            ]
            for p, slope, m, v in zip(params, slopes, mean, square, strict=True):
                slope = slope / n - shrink * p
                m += 0.1 * (slope - m)
                v += 0.001 * (slope**2 - v)
                p += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return self

    def decoder(self) -> Callable[[Sequence[Sequence[str]]], list[np.ndarray]]:
        """A function from sequences to their most likely label numbers."""
        numbers: dict[tuple[int, ...], int] = {(-1,): 0}
        of_token: dict[str, int] = {}
        scores = [np.zeros((1, 3, len(self.labels)))]

        def number(token: str) -> int:
            if (i := of_token.get(token)) is None:
                found = tuple(self.features(token))
                if found not in numbers:
                    numbers[found] = len(numbers)
                    scores.append(self.weights[:, list(found)].sum(axis=1)[None])
                if len(of_token) > 100_000:
                    of_token.clear()
                i = of_token[token] = numbers[found]
            return i

        def decode(rows: Sequence[Sequence[str]]) -> list[np.ndarray]:
            sizes = np.fromiter(map(len, rows), np.int64, len(rows))
            ids = np.fromiter((number(w) for row in rows for w in row), np.int64, int(sizes.sum()))
            table = np.concatenate(scores)
            scores[:] = [table]
            starts = np.cumsum(sizes) - sizes
            emission = table[ids, 0]
            inside = np.ones(len(ids), bool)
            inside[starts[sizes > 0]] = False
            after = np.flatnonzero(inside)
            emission[after] += table[ids[after - 1], 1]
            emission[after - 1] += table[ids[after], 2]
            return self._best(emission, starts, sizes)

        return decode

    def _best(self, emission: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        """Viterbi over all sequences side by side, the longest first, so that those that have
        ended drop out at the end of the arrays."""
        order = np.argsort(-sizes, kind="stable")
        at, left = starts[order], sizes[order]
        back = np.zeros(emission.shape, np.int8)
        labels = np.zeros(len(emission), np.int64)
        longest = int(left[0]) if len(left) else 0
        active = np.searchsorted(-left, -np.arange(longest), side="left")
        if not longest:
            return [labels[:0] for _ in sizes]
        score = self.first + emission[at[: active[0]]]
        done = np.zeros(len(order), np.int64)
        for t in range(1, longest):
            n = active[t]
            done[n : len(score)] = score[n:].argmax(axis=1)
            ways = score[:n, :, None] + self.moves
            back[at[:n] + t] = ways.argmax(axis=1)
            score = ways.max(axis=1) + emission[at[:n] + t]
        done[: len(score)] = score.argmax(axis=1)
        for t in range(longest - 1, -1, -1):
            n = active[t]
            labels[at[:n] + t] = done[:n]
            done[:n] = back[at[:n] + t, done[:n]]
        return [labels[s : s + n] for s, n in zip(starts, sizes, strict=True)]
