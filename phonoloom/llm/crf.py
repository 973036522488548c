"""A linear-chain conditional random field over hashed word features, in numpy.

Words are numbered as they come; what a word contributes is computed once for each number, so that a batch costs a few
array look-ups per token. Sequences of like length are decoded together, each whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np
import xxhash

BITS = 18
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Tokens that are decoded together; one longer sequence goes alone, whole.
TOGETHER = 100_000


def _slot(h: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (h ^ np.uint64(salt * 0x2545F4914F6CDD1D & 0xFFFFFFFFFFFFFFFF)) * _MIX
        x ^= x >> np.uint64(29)
        x *= _MIX
    return (x >> np.uint64(64 - BITS)).astype(np.int64)


class Words:
    """Numbers of words and the hashes of their attributes. ``attributes`` gives a fixed number of strings."""

    def __init__(self, attributes: Callable[[str], list[str]]):
        self.attributes = attributes
        self.width = len(attributes("x"))
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.hashes: list[list[int]] = []
        self._table = np.zeros((0, self.width), dtype=np.uint64)
        self["\x00"]  # stands between sequences

    def __getitem__(self, word: str) -> int:
        n = self.number.get(word)
        if n is None:
            n = self.number[word] = len(self.hashes)
            self.hashes.append([xxhash.xxh3_64_intdigest(f"{k}{a}") if a else 0 for k, a in enumerate(self.attributes(word))])
        return n

    def numbers(self, words: Iterable[str]) -> list[int]:
        known = self.number
        return [known[w] if w in known else self[w] for w in words]

    @property
    def table(self) -> np.ndarray:
        """The hashes of all words, a row each."""
        if len(self._table) < len(self.hashes):
            new = np.array(self.hashes[len(self._table) :], dtype=np.uint64)
            self._table = np.concatenate([self._table, new])
        return self._table


class Chunks:
    """Word numbers of texts, by the stretches between white space: each is cut into tokens when it is first met."""

    def __init__(self, words: Words, cut: Callable[[str], list[str]], most: int = 300_000):
        self.words, self.cut, self.most = words, cut, most
        self._clear()

    def _clear(self) -> None:
        self.words.clear()
        self.number: dict[str, int] = {}
        self.flat, self.begin, self.length = (np.zeros(0, np.int64) for _ in range(3))

    def sequences(self, texts: list[str]) -> list[np.ndarray]:
        """The word numbers of every text."""
        if len(self.number) > self.most:
            self._clear()
        split = [x.split() for x in texts]
        parts = list(chain.from_iterable(split))
        new = list(set(parts).difference(self.number))
        if new:
            lists = [self.words.numbers(self.cut(c)) for c in new]
            length = np.fromiter(map(len, lists), np.int64, len(lists))
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
            self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(length) - length])
            self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(lists), np.int64, int(length.sum()))])
            self.length = np.concatenate([self.length, length])
        codes = np.fromiter(map(self.number.__getitem__, parts), np.int64, len(parts))
        length = self.length[codes]
        ends = np.concatenate([[0], np.cumsum(length)])
        every = self.flat[np.repeat(self.begin[codes] - ends[:-1], length) + np.arange(int(ends[-1]))]
        return np.split(every, ends[np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))][:-1]) if texts else []


class Crf:
    """Labels of tokens. ``offsets``: neighbours whose attributes count; ``joint``: (offsets, attribute) tuples of words
    that count together."""

    def __init__(self, labels: list[str], offsets: tuple[int, ...] = (-2, -1, 0, 1, 2), joint: tuple[tuple[tuple[int, ...], int], ...] = (((-1, 0), 1), ((0, 1), 1), ((-1, 0, 1), 1)), forbidden: Callable[[str, str], bool] | None = None):
        self.labels, self.offsets, self.joint = labels, offsets, joint
        n = len(labels)
        self.weights = np.zeros((1 << BITS, n), dtype=np.float32)
        self.moves = np.zeros((n, n), dtype=np.float64)
        self.first = np.zeros(n, dtype=np.float64)
        self.banned = np.array([[bool(forbidden and forbidden(a, b)) for b in labels] for a in labels])
        self.banned_first = np.array([bool(forbidden and forbidden("O", b)) for b in labels])

    # features -------------------------------------------------------------------------------------------------

    def _joint_slots(self, own: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
        offsets, attribute = self.joint[k]
        h = np.zeros(len(at), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for o in offsets:
                h = h * np.uint64(0x100000001B3) + own[at + o, attribute]
                h ^= h >> np.uint64(32)
        return _slot(h, 1000 + k)

    def slots(self, table: np.ndarray, stream: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Feature slots (tokens x features); ``stream`` holds word numbers with padding around sequences."""
        own = table[stream]
        cols = [_slot(own[at + o, k], 10 * k + o + 5) for o in self.offsets for k in range(own.shape[1])]
        cols += [self._joint_slots(own, at, k) for k in range(len(self.joint))]
        return np.stack(cols, axis=1)

    def emissions(self, words: Words, stream: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Scores (tokens x labels). What a word adds at each offset is looked up once a word, not once a token."""
        table = words.table
        used, compact = np.unique(stream, return_inverse=True)
        own = table[used]
        out = np.zeros((len(at), len(self.labels)), dtype=np.float32)
        for o in self.offsets:
            per_word = np.zeros((len(used), len(self.labels)), dtype=np.float32)
            for k in range(own.shape[1]):
                per_word += self.weights[_slot(own[:, k], 10 * k + o + 5)]
            out += per_word[compact[at + o]]
        by_token = own[compact]
        for k in range(len(self.joint)):
            out += self.weights[self._joint_slots(by_token, at, k)]
        return out

    @staticmethod
    def lay(sequences: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(stream, places of tokens, lengths): sequences one after another, two padding words between them."""
        lengths = np.array([len(s) for s in sequences], dtype=np.int64)
        total = int(lengths.sum())
        starts = 2 + np.concatenate([[0], np.cumsum(lengths + 2)[:-1]]).astype(np.int64) if len(lengths) else np.zeros(0, dtype=np.int64)
        stream = np.zeros(total + 2 * len(sequences) + 4, dtype=np.int64)
        at = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(total) if total else np.zeros(0, dtype=np.int64)
        if total:
            stream[at] = np.concatenate([np.asarray(s, dtype=np.int64) for s in sequences])
        return stream, at, lengths

    # training -------------------------------------------------------------------------------------------------

    def fit(self, words: Words, sequences: list[list[int]], tags: list[list[int]], epochs: int = 12, rate: float = 0.25, decay: float = 1e-6, batch: int = 48, seed: int = 1) -> "Crf":
        """Maximum conditional likelihood by AdaGrad over batches of sequences."""
        rng = np.random.default_rng(seed)
        n = len(self.labels)
        g2 = np.full((1 << BITS, n), 1e-8, dtype=np.float32)
        m2, f2 = np.full((n, n), 1e-8), np.full(n, 1e-8)
        table = words.table
        order = np.argsort([len(s) for s in sequences], kind="stable")
        groups = [order[k : k + batch] for k in range(0, len(order), batch)]
        ready = []
        for group in groups:
            group = [g for g in group if sequences[g]]
            if not group:
                continue
            stream, at, lengths = self.lay([sequences[g] for g in group])
            ready.append((self.slots(table, stream, at), lengths, np.concatenate([np.array(tags[g]) for g in group])))
        for _ in range(epochs):
            for b in rng.permutation(len(ready)):
                slots, lengths, gold = ready[b]
                scores = self.weights[slots].sum(axis=1).astype(np.float64)
                gamma, xi, start = self._expected(scores, lengths)
                gamma[np.arange(len(gold)), gold] -= 1.0
                ends = np.cumsum(lengths)
                begins = ends - lengths
                np.add.at(start, gold[begins], -1.0)
                inner = np.ones(len(gold), dtype=bool)
                inner[begins] = False
                b_at = np.flatnonzero(inner)
                np.add.at(xi, (gold[b_at - 1], gold[b_at]), -1.0)
                flat, where = np.unique(slots.ravel(), return_inverse=True)
                owner = np.repeat(np.arange(len(gold)), slots.shape[1])
                grad = np.stack([np.bincount(where, weights=gamma[owner, l], minlength=len(flat)) for l in range(n)], axis=1)
                grad = (grad / len(lengths) + decay * self.weights[flat]).astype(np.float32)
                g2[flat] += grad * grad
                self.weights[flat] -= rate * grad / np.sqrt(g2[flat])
                xi, start = xi / len(lengths), start / len(lengths)
                m2 += xi * xi
                f2 += start * start
                self.moves -= rate * xi / np.sqrt(m2)
                self.first -= rate * start / np.sqrt(f2)
        return self

    def _chain(self) -> tuple[np.ndarray, np.ndarray]:
        return np.where(self.banned, -1e4, self.moves), np.where(self.banned_first, -1e4, self.first)

    def _padded(self, scores: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        longest = int(lengths.max())
        ends = np.cumsum(lengths)
        cell = np.repeat(np.arange(len(lengths)) * longest - (ends - lengths), lengths) + np.arange(len(scores))
        full = np.zeros((len(lengths) * longest, scores.shape[1]), dtype=scores.dtype)
        full[cell] = scores
        return full.reshape(len(lengths), longest, -1), cell

    def _expected(self, scores: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Marginals of tokens, summed marginals of moves and of first labels, by forward-backward with scaling."""
        moves, first = self._chain()
        full, cell = self._padded(scores, lengths)
        n, longest, k = full.shape
        e = np.exp(full - full.max(axis=2, keepdims=True))
        m, f = np.exp(moves - moves.max()), np.exp(first - first.max())
        live = np.arange(longest)[None, :] < lengths[:, None]
        alpha = np.zeros_like(e)
        alpha[:, 0] = f * e[:, 0]
        alpha[:, 0] /= alpha[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, longest):
            a = (alpha[:, t - 1] @ m) * e[:, t]
            a /= np.maximum(a.sum(axis=1, keepdims=True), 1e-300)
            alpha[:, t] = np.where(live[:, t, None], a, alpha[:, t - 1])
        beta = np.ones((n, k))
        gamma = np.empty_like(alpha)
        xi = np.zeros((k, k))
        for t in range(longest - 1, -1, -1):
            g = alpha[:, t] * beta
            gamma[:, t] = g / np.maximum(g.sum(axis=1, keepdims=True), 1e-300)
            if t:
                back = e[:, t] * beta
                go = live[:, t]
                pair = alpha[go, t - 1][:, :, None] * m[None] * back[go][:, None, :]
                xi += (pair / np.maximum(pair.sum(axis=(1, 2), keepdims=True), 1e-300)).sum(axis=0)
                b = back @ m.T
                b /= np.maximum(b.max(axis=1, keepdims=True), 1e-300)
                beta = np.where(live[:, t, None], b, 1.0)
        flat = gamma.reshape(-1, k)[cell]
        return flat.copy(), xi, gamma[:, 0].sum(axis=0)

    # decoding -------------------------------------------------------------------------------------------------

    def marginals(self, words: Words, sequences: list[list[int]]) -> list[np.ndarray]:
        """Label probabilities (tokens x labels) of every sequence, by forward-backward."""
        return self._by_length(words, sequences, self._forward_backward)

    def viterbi(self, words: Words, sequences: list[list[int]]) -> list[np.ndarray]:
        """The best labels of every sequence."""
        return self._by_length(words, sequences, self._best)

    def _by_length(self, words: Words, sequences: list, run) -> list[np.ndarray]:
        """``run`` over groups of sequences of like length; every sequence is decoded whole."""
        lengths = np.array([len(s) for s in sequences], dtype=np.int64)
        nothing = np.zeros((0, len(self.labels))) if run == self._forward_backward else np.zeros(0, dtype=np.int64)
        out: list = [nothing] * len(sequences)
        order = np.argsort(lengths, kind="stable")
        order = order[lengths[order] > 0]
        k = 0
        while k < len(order):
            # as many as fit, padded to the longest
            room = lengths[order[k:]] * np.arange(1, len(order) - k + 1)
            end = k + max(1, int(np.searchsorted(room, TOGETHER, side="right")))
            group = order[k:end]
            stream, at, own = self.lay([sequences[i] for i in group])
            flat = run(self.emissions(words, stream, at), own)
            for i, part in zip(group.tolist(), np.split(flat, np.cumsum(own)[:-1])):
                out[i] = part
            k = end
        return out

    def _forward_backward(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        moves, first = self._chain()
        full, cell = self._padded(scores, lengths)
        full = full.transpose(1, 0, 2)  # time first: each step works on one block
        e = np.exp(full - full.max(axis=2, keepdims=True)).astype(np.float32)
        longest, n, k = e.shape
        m = np.exp(moves - moves.max()).astype(np.float32)
        alpha = np.empty_like(e)
        a = np.exp(first - first.max()).astype(np.float32) * e[0]
        alpha[0] = a / a.sum(axis=1, keepdims=True)
        for t in range(1, longest):
            a = (alpha[t - 1] @ m) * e[t]
            alpha[t] = a / np.maximum(a.sum(axis=1, keepdims=True), 1e-30)
        beta = np.ones((n, k), dtype=np.float32)
        for t in range(longest - 1, -1, -1):
            g = alpha[t] * beta
            here = beta
            alpha[t] = g / np.maximum(g.sum(axis=1, keepdims=True), 1e-30)
            if t:
                b = (e[t] * here) @ m.T
                b /= np.maximum(b.max(axis=1, keepdims=True), 1e-30)
                beta = np.where((t < lengths)[:, None], b, np.float32(1.0))
        return alpha.transpose(1, 0, 2).reshape(-1, k)[cell]

    def _best(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        moves, first = self._chain()
        full, cell = self._padded(scores, lengths)
        full = np.ascontiguousarray(full.transpose(1, 2, 0))  # time, label, sequence
        longest, k, n = full.shape
        m = moves.astype(np.float32)
        score, shortest = np.empty_like(full), int(lengths.min())
        score[0] = full[0] + first.astype(np.float32)[:, None]
        for t in range(1, longest):
            np.add((score[t - 1][:, None, :] + m[:, :, None]).max(axis=0), full[t], out=score[t])
            if t >= shortest:
                np.copyto(score[t], score[t - 1], where=t >= lengths)
        path = np.zeros((longest, n), dtype=np.int64)
        last = score[-1].argmax(axis=0)
        for t in range(longest - 1, -1, -1):
            path[t] = last
            if t:
                # the way that was best into this label
                back = (score[t - 1] + m[:, last]).argmax(axis=0)
                last = back if t < shortest else np.where(t < lengths, back, last)
        return path.T.reshape(-1)[cell]
