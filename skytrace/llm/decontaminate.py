"""Benchmark decontamination: BM25 over an inverted index of test items with block-max WAND.

Items are cut into units of at most ``UNIT_WORDS`` words and indexed; a unit's scores are divided by
its score for itself. Every document is cut into overlapping passages, and each passage is a query:

* terms whose largest scores together stay below the threshold cannot make a unit pass alone, so
  only units in the posting lists of the remaining, essential terms are looked at;
* units are kept in blocks; a block is skipped when the sum of the passage's largest scores in
  that block stays below the threshold;
* in the blocks left every unit is scored exactly, and all above the threshold are retrieved.

Retrieved items are verified on the whole document: the share of the five-word shingles of the
item's question, and of its answer, that the document holds. The answer is what follows the last
question mark, else the last sentence, else the last quarter of the words.

The index is built in parts of bounded size; documents pass each part, in the same scan if there is
one. Document frequencies and lengths are those of all items.

Nulls and edges: null and empty documents and items without a word never match. Items of fewer than
five words match where their whole word sequence stands. Equal items are reported each, repeated
documents too. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytrace.llm import text as T

K1, B = 1.2, 0.75
UNIT_WORDS = 64
PASSAGE_WORDS = 64
STRIDE = PASSAGE_WORDS // 2
SHINGLE_WORDS = 5
THRESHOLD = 0.3
QUESTION_OVERLAP = 0.5
ANSWER_OVERLAP = 0.8
ANSWER_SHINGLES = 4
BLOCK_UNITS = 16
#: Texts searched at once, and numbers in a table of passages' terms and blocks: what a task holds
#: beside its rows is some thirty times the first and four times the second.
BLOCK_BYTES = 1 << 20
BOUND_CELLS = 1 << 19
#: Bounds one part of the index; a larger benchmark is searched part by part.
PART_BYTES = 4 << 20

LEAKS = ("doc_id bigint, item_id bigint, bm25 double, question_overlap double, "
         "answer_overlap double")


def shingle_hashes(words: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of runs of ``size`` words; of all words if there are fewer."""
    size = min(size, len(words))
    out = np.zeros(len(words) - size + 1 if size else 0, np.uint64)
    for i in range(size):
        out = T.mixed(out + words[i:i + len(out)])
    return out


def question_words(words: list[bytes]) -> int:
    """How many of an item's words are its question."""
    asked = [i for i, w in enumerate(words[:-1]) if w.endswith(b"?")]
    ended = asked or [i for i, w in enumerate(words[:-1]) if w[-1:] in b".!"]
    return ended[-1] + 1 if ended else max(1, len(words) * 3 // 4)


class Index:
    """An inverted index of units with the largest score of each term in each block of units."""

    def __init__(self, items: list[tuple[int, bytes]], n_items: int, mean_words: float,
                 frequencies: dict[bytes, int]):
        self.item_ids, self.questions, self.answers, self.lengths = [], [], [], []
        postings: list[tuple[int, int, float]] = []  # term, unit, score
        vocabulary = {w: i for i, w in enumerate(sorted(frequencies))}
        idf = {w: np.log1p((n_items - df + 0.5) / (df + 0.5)) for w, df in frequencies.items()}
        unit_items = []
        for item_id, text in items:
            words = text.translate(T.LOWER).split()
            if not words:
                continue
            hashed = _hashes(words)
            cut = question_words(words)
            self.lengths.append((cut, len(words) - cut))
            self.questions.append(np.unique(shingle_hashes(hashed[:cut])))
            self.answers.append(np.unique(shingle_hashes(hashed[cut:])))
            for begin in range(0, len(words), UNIT_WORDS):
                part = words[begin:begin + UNIT_WORDS]
                found, counts = np.unique([vocabulary[w] for w in part], return_counts=True)
                weights = np.array([idf[w] for w in sorted(set(part))])
                norm = K1 * (1 - B + B * len(part) / max(mean_words, 1.0))
                scores = weights * counts * (K1 + 1) / (counts + norm)
                postings += zip(found.tolist(), [len(unit_items)] * len(found),
                                (scores / scores.sum()).tolist())
                unit_items.append(len(self.item_ids))
            self.item_ids.append(item_id)
        self.unit_items = np.array(unit_items, np.int64)
        words = sorted(vocabulary)
        hashes = _hashes(words)
        order = np.argsort(hashes)
        self.keys, self.terms = hashes[order], order
        self.blocks = max(1, -(-len(unit_items) // BLOCK_UNITS))
        table = np.array(sorted((t, u // BLOCK_UNITS, u, s) for t, u, s in postings)
                         or np.zeros((0, 4)), float)
        term, block = table[:, 0].astype(np.int64), table[:, 1].astype(np.int64)
        self.units, self.scores = table[:, 2].astype(np.int64), table[:, 3]
        self.lists = np.searchsorted(term * self.blocks + block,
                                     np.arange(len(words) * self.blocks + 1))
        self.block_max = np.zeros((len(words), self.blocks))
        np.maximum.at(self.block_max, (term, block), self.scores)
        self.largest = self.block_max.max(axis=1, initial=0.0)

    def terms_of(self, hashes: np.ndarray) -> np.ndarray:
        """Term numbers, -1 for words of no item."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, self.terms[at], -1)

    def search(self, passages: np.ndarray, terms: np.ndarray,
               threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Passage, unit and score of all pairs at or above the threshold.

        ``passages`` and ``terms`` are distinct pairs, in order of passage.
        """
        # Essential terms: those behind which the largest scores, ascending, reach the threshold.
        order = np.lexsort((self.largest[terms], passages))
        passages, terms = passages[order], terms[order]
        sums = np.cumsum(self.largest[terms])
        starts = np.flatnonzero(np.diff(passages, prepend=-1))
        base = np.repeat(np.concatenate(([0.0], sums))[starts],
                         np.diff(np.append(starts, len(passages))))
        essential = sums - base >= threshold - 1e-9
        if not essential.any():
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
        hopeful = np.flatnonzero(np.logical_or.reduceat(essential, starts))
        lengths = np.diff(np.append(starts, len(passages)))
        at_once = max(1, BOUND_CELLS // self.blocks)
        cuts = np.flatnonzero(np.diff((np.cumsum(lengths[hopeful]) - 1) // at_once)) + 1
        found = [self._scored(passages, terms, essential, starts[some], lengths[some], threshold)
                 for some in np.split(hopeful, cuts)]
        return tuple(map(np.concatenate, zip(*found)))

    def _scored(self, passages: np.ndarray, terms: np.ndarray, essential: np.ndarray,
                starts: np.ndarray, lengths: np.ndarray,
                threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``search`` for the passages whose terms begin at ``starts``."""
        rows = _expand(starts, lengths)
        firsts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        most = self.block_max[terms[rows]]
        bounds = np.add.reduceat(most, firsts, axis=0)
        touched = np.logical_or.reduceat((most > 0) & essential[rows][:, None], firsts, axis=0)
        which, block = np.nonzero(touched & (bounds >= threshold - 1e-9))
        if not len(which):
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
        begin, count = starts[which], lengths[which]
        rows = _expand(begin, count)
        pair = np.repeat(np.arange(len(which)), count)
        key = terms[rows] * self.blocks + block[pair]
        entries = _expand(self.lists[key], self.lists[key + 1] - self.lists[key])
        owner = np.repeat(pair, self.lists[key + 1] - self.lists[key])
        target = owner * BLOCK_UNITS + self.units[entries] % BLOCK_UNITS
        scores = np.bincount(target, self.scores[entries], len(which) * BLOCK_UNITS)
        good = np.flatnonzero(scores >= threshold - 1e-9)
        return (passages[starts[which[good // BLOCK_UNITS]]],
                block[good // BLOCK_UNITS] * BLOCK_UNITS + good % BLOCK_UNITS, scores[good])


def _hashes(words: list[bytes]) -> np.ndarray:
    joined = pa.array([b" ".join(words)], pa.binary())
    return T.word_hashes(*T.buffer_of(joined))[0]


def _expand(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All positions of runs that begin at ``begins`` and have ``counts`` members."""
    total = int(counts.sum())
    before = np.concatenate(([0], np.cumsum(counts)[:-1]))
    return np.arange(total) + np.repeat(begins - before, counts)


def passages_of(hashes: np.ndarray, firsts: np.ndarray, index: Index,
                threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (passage, term) pairs of all texts, and the text of each passage."""
    lengths = np.diff(firsts)
    strides = -(-lengths // STRIDE)
    offsets = np.concatenate(([0], np.cumsum(strides)))
    terms = index.terms_of(hashes)
    known = np.flatnonzero(terms >= 0)
    terms = terms[known]
    text = np.searchsorted(firsts, known, "right") - 1
    within = (known - firsts[text]) // STRIDE
    passage = offsets[text] + within
    earlier = within > 0
    passage = np.concatenate((passage, passage[earlier] - 1))
    terms = np.concatenate((terms, terms[earlier]))
    # A passage whose terms cannot reach the threshold even if all differ needs no sorting.
    reach = np.bincount(passage, index.largest[terms], offsets[-1])
    keep = reach[passage] >= threshold - 1e-9
    width = max(1, len(index.terms))
    pairs = np.unique(passage[keep] * width + terms[keep])
    owner = np.repeat(np.arange(len(lengths)), strides)
    return pairs // width, pairs % width, owner


def leaks_in(batch: pa.RecordBatch, index: Index, threshold: float, question: float,
             answer: float) -> Iterator[tuple[int, int, float, float, float]]:
    """``(row, item, score, question overlap, answer overlap)`` of the verified items."""
    hashes, firsts = T.word_hashes(*T.buffer_of(T.column(batch, "text")))
    passages, terms, owner = passages_of(hashes, firsts, index, threshold)
    if not len(passages):
        return
    passage, unit, score = index.search(passages, terms, threshold)
    found: dict[int, dict[int, float]] = {}
    for row, item, s in zip(owner[passage].tolist(), index.unit_items[unit].tolist(),
                            score.tolist()):
        mine = found.setdefault(row, {})
        mine[item] = max(mine.get(item, 0.0), s)
    for row, items in found.items():
        words = hashes[firsts[row]:firsts[row + 1]]
        # Parts shorter than a shingle are compared by runs of their own length.
        runs: dict[int, np.ndarray] = {}

        def overlap(wanted: np.ndarray, length: int) -> float:
            size = min(SHINGLE_WORDS, length)
            if not size or size > len(words):
                return 0.0
            if size not in runs:
                runs[size] = np.unique(shingle_hashes(words, size))
            return float(np.isin(wanted, runs[size], assume_unique=True).mean())

        for item, s in sorted(items.items()):
            q, a = index.questions[item], index.answers[item]
            q_length, a_length = index.lengths[item]
            q_share, a_share = overlap(q, q_length), overlap(a, a_length)
            if q_share >= question or (a_share >= answer and len(a) >= ANSWER_SHINGLES):
                yield row, item, s, q_share, a_share


def _leaks(batches: Iterable[pa.RecordBatch], indexes: list[Index],
           **limits: float) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in LEAKS.split(", ")]
    for batch in T.blocks(batches, size=BLOCK_BYTES):
        ids = T.column(batch, "doc_id").to_pylist()
        rows = [(ids[row], index.item_ids[item], *rest) for index in indexes
                for row, item, *rest in leaks_in(batch, index, **limits)]
        columns = list(zip(*rows)) or [[]] * len(names)
        types = [pa.int64()] * 2 + [pa.float64()] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names)


def _clean(batches: Iterable[pa.RecordBatch], indexes: list[Index],
           **limits: float) -> Iterator[pa.RecordBatch]:
    for batch in T.blocks(batches, size=BLOCK_BYTES):
        good = np.ones(batch.num_rows, bool)
        for index in indexes:
            good[[row for row, *_ in leaks_in(batch, index, **limits)]] = False
        yield batch.filter(pa.array(good))


def indexes(benchmark: DataFrame, part_bytes: int = PART_BYTES) -> Iterator[Index]:
    """The index in parts of at most about ``part_bytes`` of item text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    n, size = benchmark.select(F.count(F.lit(1)), F.sum(F.octet_length(text))).first()
    parts = max(1, -(-(size or 0) // part_bytes))
    key = F.xxhash64(F.col("item_id").cast("bigint"), text)
    items = benchmark.select(F.col("item_id").cast("bigint"), text.cast("binary").alias("text"),
                             key.alias("key"), F.pmod(key, F.lit(parts)).alias("part"))
    terms = items.select("key", "part", "text").mapInArrow(
        _terms, "key bigint, part bigint, word binary, uses bigint")
    total = terms.agg(F.sum("uses")).first()[0] or 0
    frequencies = terms.groupBy("word").agg(F.count_distinct("key").alias("items"))
    for number in range(parts):
        own = terms.where(F.col("part") == number).select("word").distinct()
        counted = own.join(frequencies, "word").collect()
        rows = sorted((r.item_id is not None, r.item_id or 0, bytes(r.text))
                      for r in items.where(F.col("part") == number).collect())
        yield Index([(i if has else None, t) for has, i, t in rows], n, total / max(n, 1),
                    {bytes(r.word): r["items"] for r in counted})


def _terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of every item and how often it uses them."""
    for batch in T.blocks(batches):
        for key, part, text in zip(*(c.to_pylist() for c in batch.columns)):
            uses = Counter(text.translate(T.LOWER).split())
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * len(uses), pa.int64()), pa.array([part] * len(uses), pa.int64()),
                 pa.array(list(uses), pa.binary()), pa.array(list(uses.values()), pa.int64())],
                ["key", "part", "word", "uses"])


def _limits(threshold: float, question: float, answer: float) -> dict[str, float]:
    return {"threshold": threshold, "question": question, "answer": answer}


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
          question: float = QUESTION_OVERLAP, answer: float = ANSWER_OVERLAP) -> DataFrame:
    """Every document and item whose question or answer it holds."""
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    out = None
    for index in indexes(benchmark):
        found = texts.mapInArrow(
            partial(_leaks, indexes=[index], **_limits(threshold, question, answer)), LEAKS)
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
          question: float = QUESTION_OVERLAP, answer: float = ANSWER_OVERLAP) -> DataFrame:
    """The rows of ``docs`` that hold no item."""
    for index in indexes(benchmark):
        docs = docs.mapInArrow(
            partial(_clean, indexes=[index], **_limits(threshold, question, answer)), docs.schema)
    return docs
