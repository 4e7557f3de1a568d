"""Elias-Fano sequences and n-gram tries made of them, in files that are memory-mapped."""

from __future__ import annotations

import json
import os

import numpy as np

#: Logarithms are stored as whole steps below zero, rounded away from it; 0 stands for nothing.
STEPS_PER_DECADE = 2048


def quantised(p: np.ndarray) -> np.ndarray:
    """Codes of probabilities: 1 for one, more for less, 0 for zero."""
    with np.errstate(divide="ignore"):
        steps = np.ceil(-np.log10(p) * STEPS_PER_DECADE - 1e-9)
    return np.where(p > 0, np.clip(steps, 0, 65_534) + 1, 0).astype(np.uint16)


def probabilities(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, 10.0 ** ((1.0 - codes.astype(float)) / STEPS_PER_DECADE), 0.0)


class EliasFano:
    """Non-decreasing numbers: low bits packed side by side, high parts in unary."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        self._buckets: np.ndarray | None = None

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        parts = values & np.uint64((1 << low_bits) - 1)
        bits = ((parts[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(
            np.uint8)
        low = np.concatenate((np.packbits(bits.ravel(), bitorder="little"),
                              np.zeros(8, np.uint8)))
        marks = np.zeros(n + (top >> low_bits) + 1, np.uint8)
        marks[(values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)] = 1
        return cls(n, low_bits, low, np.packbits(marks, bitorder="little"))

    def buckets(self) -> np.ndarray:
        """How many numbers have a high part below h, for every h; from the zeros of the unary."""
        if self._buckets is None:
            marks = np.unpackbits(self.high, bitorder="little")
            zeros = np.flatnonzero(marks == 0)
            before = np.minimum(zeros - np.arange(len(zeros)), self.n)
            self._buckets = np.concatenate(([0], before)).astype(np.int32)
        return self._buckets

    def lows(self, at: np.ndarray) -> np.ndarray:
        bit = at * self.low_bits
        byte = bit >> 3
        window = np.zeros(len(at), np.uint64)
        for k in range((self.low_bits + 14) // 8):
            window |= self.low[byte + k].astype(np.uint64) << np.uint64(8 * k)
        return (window >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.low_bits) - 1)

    def access(self, at: np.ndarray) -> np.ndarray:
        """The numbers at some positions."""
        if not len(at):
            return np.zeros(0, np.int64)
        high = np.searchsorted(self.buckets(), at, "right") - 1
        return (high.astype(np.int64) << self.low_bits) | self.lows(at).astype(np.int64)

    def everything(self) -> np.ndarray:
        """All numbers."""
        marks = np.unpackbits(self.high, bitorder="little")
        at = np.arange(self.n)
        high = np.flatnonzero(marks)[:self.n] - at
        return (high << self.low_bits) | self.lows(at).astype(np.int64)

    def _search(self, wanted: np.ndarray, begin: np.ndarray, end: np.ndarray):
        """First position in a range whose number is at least the wanted one, and where the numbers
        that share its high part end."""
        buckets = self.buckets()
        high = wanted >> self.low_bits
        high[high > len(buckets) - 2] = len(buckets) - 1
        lo = np.clip(buckets[high], begin, end).astype(np.int64)
        stop = np.clip(buckets[np.minimum(high + 1, len(buckets) - 1)], begin, end).astype(np.int64)
        part = wanted.astype(np.uint64) & np.uint64((1 << self.low_bits) - 1)
        hi = stop.copy()
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            middle = (lo[open_] + hi[open_]) >> 1
            less = self.lows(middle) < part[open_]
            lo[open_[less]] = middle[less] + 1
            hi[open_[~less]] = middle[~less]
            open_ = open_[lo[open_] < hi[open_]]
        return lo, stop, part

    def successor(self, wanted: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """First position in ``begin`` to ``end`` whose number is at least the wanted one."""
        return self._search(wanted, begin, end)[0]

    def find(self, wanted: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Position of the wanted number between ``begin`` and ``end``, or -1."""
        at, stop, part = self._search(wanted, begin, end)
        inside = np.flatnonzero(at < stop)
        same = self.lows(at[inside]) == part[inside]
        out = np.full(len(at), -1)
        out[inside[same]] = at[inside[same]]
        return out


class Level:
    """Words of one level, context by context, and where each context's words begin.

    Words ascend within a context. Each context's words are stored on top of the last number of the
    context before, so the whole level is one ascending sequence.
    """

    def __init__(self, words: EliasFano, pointers: EliasFano, values: dict[str, np.ndarray]):
        self.words, self.pointers, self.values = words, pointers, values
        self._contexts: tuple[np.ndarray, np.ndarray] | None = None

    def contexts(self) -> tuple[np.ndarray, np.ndarray]:
        """Where each context's words begin, and the number they stand on; decoded once."""
        if self._contexts is None:
            begins = self.pointers.everything()
            bases = np.zeros(len(begins), np.int64)
            later = begins > 0
            bases[later] = self.words.access(begins[later] - 1)
            self._contexts = begins, bases
        return self._contexts

    @classmethod
    def of(cls, words: np.ndarray, begins: np.ndarray, values: dict[str, np.ndarray]) -> Level:
        """``begins`` has the first word of each context and the number of all words."""
        last = words[np.maximum(begins[1:] - 1, 0)] * (np.diff(begins) > 0) if len(words) else \
            np.zeros(len(begins) - 1, np.int64)
        bases = np.concatenate(([0], np.cumsum(last)[:-1])) if len(last) else last
        raised = words + np.repeat(bases, np.diff(begins))
        return cls(EliasFano.of(raised), EliasFano.of(begins), values)

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Position of each word below its context (-1: no context), or -1."""
        at = np.full(len(context), -1)
        known = np.flatnonzero(context >= 0)
        if len(known) and self.words.n:
            begins, bases = self.contexts()
            own = context[known]
            at[known] = self.words.find(bases[own] + word[known], begins[own], begins[own + 1])
        return at


def distinct_rows(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows' first distinct ones, sorted by column, and each row's number in it."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    if len(order):
        new[0] = True
    for c in columns:
        ordered = c[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


class Trie:
    """Words, their followers and the followers of those, with interpolation weights.

    A pair has the code of its discounted share of its context, and of the weight that its own
    followers leave to the pair model; a triple has the code of its share.
    """

    def __init__(self, roots: EliasFano, pairs: Level, triples: Level):
        self.roots, self.pairs, self.triples = roots, pairs, triples

    @classmethod
    def of(cls, first: np.ndarray, second: np.ndarray, third: np.ndarray, counts: np.ndarray,
           context_counts: np.ndarray, pair_weight) -> Trie:
        """From distinct triples and their counts; ``third`` 0 closes a pair without follower.

        ``context_counts`` is how often ``first`` occurs; ``pair_weight`` gives the pseudo-count
        that a context of some count leaves to single words.
        """
        rows, pair = distinct_rows(first, second)
        order = np.argsort(np.unique(pair << 32 | third, return_inverse=True)[1], kind="stable")
        third, counts, pair = third[order], counts[order], pair[order]
        return cls.of_pairs(first[rows], second[rows], context_counts[rows], pair, third, counts,
                            pair_weight)

    @classmethod
    def of_pairs(cls, first: np.ndarray, second: np.ndarray, context_counts: np.ndarray,
                 pair: np.ndarray, third: np.ndarray, counts: np.ndarray, pair_weight) -> Trie:
        """From distinct pairs in order, and triples in order that name their pair by position."""
        n = len(first)
        new = np.ones(n, bool)
        new[1:] = first[1:] != first[:-1]
        root = np.cumsum(new) - 1
        pair_counts = np.bincount(pair, counts, n)
        own = context_counts.astype(float)
        share = pair_counts / (own + pair_weight(own)) if n else pair_counts
        real = third > 0
        kinds = np.bincount(pair[real], minlength=n).astype(float)
        left = np.where(kinds > 0, kinds / np.maximum(pair_counts + kinds, 1), 1.0)
        triple_share = counts[real] / (pair_counts + kinds)[pair[real]]
        pairs = Level.of(second, np.searchsorted(root, np.arange(int(new.sum()) + 1)),
                         {"share": quantised(share), "left": quantised(left)})
        triples = Level.of(third[real], np.searchsorted(pair[real], np.arange(n + 1)),
                           {"share": quantised(triple_share)})
        return cls(EliasFano.of(first[new]), pairs, triples)

    def pair(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Position of each pair, or -1. Quick if equal first words stand together."""
        new = np.ones(len(first), bool)
        new[1:] = first[1:] != first[:-1]
        words = first[new].astype(np.int64)
        nowhere = np.zeros(len(words), np.int64)
        root = self.roots.find(words, nowhere, nowhere + self.roots.n)
        return self.pairs.find(root[np.cumsum(new) - 1], second)

    def save(self, folder: str) -> None:
        parts: dict[str, np.ndarray] = {}
        sizes: dict[str, list[int]] = {}
        for name, sequence in self._sequences().items():
            parts[f"{name}.low"], parts[f"{name}.high"] = sequence.low, sequence.high
            sizes[name] = [sequence.n, sequence.low_bits]
        for name, level in (("pairs", self.pairs), ("triples", self.triples)):
            parts |= {f"{name}.{k}": v for k, v in level.values.items()}
        for name, values in parts.items():
            values.tofile(os.path.join(folder, name))
        with open(os.path.join(folder, "sizes.json"), "w", encoding="utf-8") as out:
            json.dump(sizes, out)

    def _sequences(self) -> dict[str, EliasFano]:
        return {"roots": self.roots, "pairs.words": self.pairs.words,
                "pairs.pointers": self.pairs.pointers, "triples.words": self.triples.words,
                "triples.pointers": self.triples.pointers}

    @classmethod
    def load(cls, folder: str) -> Trie:
        """Levels as memory maps of the files."""
        def mapped(name: str, kind: type) -> np.ndarray:
            path = os.path.join(folder, name)
            if not os.path.getsize(path):
                return np.zeros(0, kind)
            return np.memmap(path, kind, "r")

        with open(os.path.join(folder, "sizes.json"), encoding="utf-8") as sizes:
            made = {name: EliasFano(n, bits, mapped(f"{name}.low", np.uint8),
                                    mapped(f"{name}.high", np.uint8))
                    for name, (n, bits) in json.load(sizes).items()}
        return cls(made["roots"],
                   Level(made["pairs.words"], made["pairs.pointers"],
                         {k: mapped(f"pairs.{k}", np.uint16) for k in ("share", "left")}),
                   Level(made["triples.words"], made["triples.pointers"],
                         {"share": mapped("triples.share", np.uint16)}))
