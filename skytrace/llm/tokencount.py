"""Token counts of a unigram tokenizer without producing its tokens.

An Aho-Corasick automaton enumerates all vocabulary pieces that end at each character; dynamic
programming carries the best score so far and the number of pieces of the best segmentation. Tie
rule of unigram tokenizers: of equally good segmentations the one whose last piece begins first
wins, at every character. A character that is no piece by itself may be unknown, at a penalty below
the worst piece, and counts as its UTF-8 bytes (byte fallback).

The vocabulary is that of a public SentencePiece file; scores are integers, so sums are exact and
a text may be cut wherever no piece can reach across: before every run of spaces, and around
characters that occur in no piece. Each distinct part of a block is segmented once and remembered.

Nulls and edges: null and empty texts have no tokens and score 0. Rows with a null ``doc_id`` and
repeated rows are counted each. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache, partial

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytrace.llm import text as T

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "\u2581"
UNKNOWN_PENALTY = 10
REMEMBERED = 2_000_000

RESULT = "doc_id bigint, n_tokens bigint, log_score double"


def load(vocabulary: str = VOCABULARY) -> tuple[tuple[str, int], ...]:
    """Ordinary pieces of a SentencePiece file and their scores as whole numbers."""
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    return tuple(
        (model.id_to_piece(i), int(model.get_score(i))) for i in range(model.get_piece_size())
        if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i)
                or model.is_unused(i)))


class Segmenter:
    """Best score and piece count of texts, each cut into independent parts first."""

    def __init__(self, pieces: Iterable[tuple[str, int]], remembered: int = REMEMBERED):
        pieces = dict(pieces)
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece reaches across a space: texts cannot be cut there")
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p in pieces if len(p) == 1}
        self.longest = max(map(len, pieces))
        self.unknown = min(pieces.values()) - UNKNOWN_PENALTY
        used = set("".join(pieces))
        # Byte values of characters that stand alone.
        self.alone = np.zeros(256, bool)
        self.alone[[b for b in range(128) if chr(b) not in used and b != 32]] = True
        self.remembered = remembered
        self.keys = np.zeros(0, np.uint64)
        self.values = np.zeros((0, 2), np.int64)

    def segment(self, part: str) -> tuple[int, int]:
        """Score and number of pieces of a part whose spaces are already replaced."""
        size = self.longest + 1
        best, count = [0] * size, [0] * size
        reached = 0  # characters whose best segmentation is final

        def close(upto: int) -> None:
            nonlocal reached
            while reached < upto:
                char, at, before = part[reached], (reached + 1) % size, reached % size
                if char not in self.single:
                    score = best[before] + self.unknown
                    if best[at] is None or score > best[at]:
                        best[at] = score
                        count[at] = count[before] + len(char.encode())
                reached += 1
                best[(reached + 1) % size] = None

        best[1 % size] = None
        # Matches come by their end, the longest first: a later one must be strictly better.
        for end, (length, score) in self.automaton.iter(part):
            if reached < end:
                close(end)
            at, before = (end + 1) % size, (end + 1 - length) % size
            score += best[before]
            if best[at] is None or score > best[at]:
                best[at] = score
                count[at] = count[before] + 1
        close(len(part))
        return best[len(part) % size], count[len(part) % size]

    def parts(self, data: np.ndarray,
              offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Texts with the leading space, and begin, end and first number of their parts."""
        filled = np.flatnonzero(np.diff(offsets))
        data = np.insert(data, offsets[filled], 32)
        offsets = offsets + np.searchsorted(filled, np.arange(len(offsets)))
        space = data == 32
        alone = self.alone[data]
        begins = alone | space
        begins[1:] &= ~space[:-1] | alone[1:]
        begins[1:] |= alone[:-1]
        begins[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        return data, starts, ends, np.searchsorted(starts, offsets)

    def totals(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Score and piece count of each text."""
        data, starts, ends, firsts = self.parts(data, offsets)
        keys, at, which = np.unique(T.span_hashes(data, starts, ends), return_index=True,
                                    return_inverse=True)
        if len(self.keys) > self.remembered:
            self.keys, self.values = self.keys[:0], self.values[:0]
        new = ~np.isin(keys, self.keys, assume_unique=True)
        found = [self.segment(bytes(data[starts[i]:ends[i]]).decode("utf-8", "replace")
                              .replace(" ", SPACE)) for i in at[new]]
        if found:
            merged = np.concatenate((self.keys, keys[new]))
            order = np.argsort(merged, kind="stable")
            self.keys = merged[order]
            self.values = np.concatenate((self.values, np.array(found, np.int64)))[order]
        known = self.values[np.searchsorted(self.keys, keys)][which]
        return np.stack([T.per_text(known[:, i], firsts) for i in (0, 1)])


@lru_cache(maxsize=2)
def _segmenter(pieces: tuple[tuple[str, int], ...]) -> Segmenter:
    return Segmenter(pieces)


def _counted(batches: Iterable[pa.RecordBatch],
             pieces: tuple[tuple[str, int], ...]) -> Iterator[pa.RecordBatch]:
    segmenter = _segmenter(pieces)
    for batch in T.blocks(batches):
        score, n = segmenter.totals(*T.buffer_of(T.column(batch, "text")))
        yield pa.RecordBatch.from_arrays(
            [T.column(batch, "doc_id"), pa.array(n), pa.array(score.astype(float))],
            ["doc_id", "n_tokens", "log_score"])


def counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id``, ``n_tokens`` and the best segmentation's ``log_score`` of every row."""
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        partial(_counted, pieces=load(vocabulary)), RESULT)
