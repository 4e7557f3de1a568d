"""Best-two-fit packing of tokenised documents into sequences.

1. Texts are tokenised in one scan. The tokenizer treats every run of non-space characters by
   itself, so each distinct run of a block is encoded once. Documents are cut into pieces of at
   most ``capacity`` ids.
2. Only how often each length occurs matters for a plan: at most ``capacity`` counters, whatever
   the number of documents. A bin is filled greedily with the longest lengths that fit; then its
   smallest piece is replaced by the two unused pieces that fill the widened gap best, if they
   fill it better. The same filling is repeated while the counters allow, so a plan has at most a
   few fillings per length.
3. Pieces of one length are numbered without gaps, by counts of small buckets, so no length is
   ever gathered in one task. The number selects the place in the plan by binary search.

Nulls and edges: a null text is empty and has the closing id only; rows with a null ``doc_id`` are
packed with that null. Repeated rows are packed each. An empty table gives no rows. Ties between
pieces of equal length are settled by ``doc_id``, ``piece`` and content. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skytrace.llm import text as T
from skytrace.session import written

CAPACITY = 2048
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
CLOSING_ID = 0
CACHED_RUNS = 800_000
LONGEST_CACHED = 64
BUCKET_ROWS = 20_000

PIECES = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
          "ids array<int>")

#: Cut only at white space that every pattern of the tokenizer drops.
_RUN = re.compile(r"[^ \t\n\r]+")
#: Runs whose normal form is their lower case.
_PLAIN = re.compile("[!-~\u00a1-\u00ac\u00ae-\u02ff]+")
# The tokenizer file's own pattern for words.
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def _byte_signs() -> dict[int, str]:
    """The sign that stands for each byte: printable ones for themselves, the rest from 256 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """Ids of whole texts as little-endian bytes; every distinct run is encoded once.

    Plain runs are cut into words here and only the words go through the tokenizer's model; all
    others go through the whole tokenizer.
    """

    def __init__(self, vocabulary: str, cached: int = CACHED_RUNS):
        self.tokenizer = Tokenizer.from_str(vocabulary)
        # Strings of control tokens, found in texts as they stand or after lower-casing.
        self.control = tuple(
            t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values())
        self.model = self.tokenizer.model
        self.signs = _byte_signs()
        self.cached = cached
        self.runs: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            signs = word if word.isascii() else word.encode().decode("latin-1").translate(
                self.signs)
            tokens = self.model.tokenize(signs)
            found = self.words[word] = b"".join(t.id.to_bytes(4, "little") for t in tokens)
        return found

    def _run(self, run: str) -> bytes:
        small = run.lower()
        if _PLAIN.fullmatch(run) and not any(c in small for c in self.control):
            return b"".join([self._word(w) for w in _WORD.findall(small)])
        ids = self.tokenizer.encode(run, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if len(self.runs) + len(self.words) > self.cached:
            self.runs.clear()
            self.words.clear()
        known, out = self.runs, []
        for run in _RUN.findall(text):
            ids = known.get(run)
            if ids is None:
                ids = self._run(run)
                if len(run) <= LONGEST_CACHED:
                    known[run] = ids
            out.append(ids)
        return b"".join(out)


@lru_cache(maxsize=2)
def _encoder(vocabulary: str) -> Encoder:
    """One encoder for all tasks of a worker."""
    return Encoder(vocabulary)


def _pieces(batches: Iterable[pa.RecordBatch], vocabulary: str, capacity: int, closing: int,
            with_ids: bool) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(vocabulary)
    last = closing.to_bytes(4, "little")
    for batch in T.blocks(batches):
        doc_ids, numbers, starts, lengths, sums, ids = [], [], [], [], [], []
        for doc_id, text in zip(T.column(batch, "doc_id").to_pylist(),
                                T.column(batch, "text").to_pylist()):
            found = encoder.encode(text or "") + last
            for number, start in enumerate(range(0, len(found) // 4, capacity)):
                part = found[4 * start:4 * (start + capacity)]
                doc_ids.append(doc_id)
                numbers.append(number)
                starts.append(start)
                lengths.append(len(part) // 4)
                sums.append(zlib.crc32(part))
                ids.append(np.frombuffer(part, "<i4") if with_ids else None)
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()), pa.array(numbers, pa.int32()),
             pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
             pa.array(sums, pa.int64()), pa.array(ids, pa.list_(pa.int32()))],
            ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY,
           closing: int = CLOSING_ID, with_ids: bool = True) -> DataFrame:
    """Every document's pieces of at most ``capacity`` ids, the closing id included.

    ``vocabulary`` is a file that the driver reads; its content goes to the tasks.
    """
    content = Path(vocabulary).read_text(encoding="utf-8")
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        partial(_pieces, vocabulary=content, capacity=capacity, closing=closing,
                with_ids=with_ids), PIECES)


# The plan


def _fill(counts: np.ndarray, capacity: int) -> list[int]:
    """Lengths of one bin: greedy, then the smallest replaced by the two that fit best."""
    left = counts.copy()
    room, chosen = capacity, []
    while room > 0:
        fitting = np.flatnonzero(left[:room + 1])
        if not len(fitting):
            break
        length = int(fitting[-1])
        times = min(int(left[length]), room // length)
        chosen += [length] * times
        left[length] -= times
        room -= length * times
    if len(chosen) > 1 and room:
        smallest = chosen[-1]
        gap = room + smallest
        free = np.flatnonzero(left[:gap + 1])
        # For each first length the longest second one that still fits.
        second = np.searchsorted(free, gap - free, "right") - 1
        ok = (second >= 0) & (free <= gap // 2)
        first, second = free[ok], free[second[ok]]
        alone = (first == second) & (left[first] < 2)
        if alone.any():
            at = np.searchsorted(free, first[alone])
            second[alone] = np.where(at > 0, free[at - 1], 0)
        sums = np.where(second > 0, first + second, 0)
        if len(sums) and sums.max() > smallest:
            best = int(np.argmax(sums))
            chosen[-1:] = sorted((int(first[best]), int(second[best])), reverse=True)
    return chosen


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rows ``(length, rank, pieces, sequence, per_sequence, offset)``.

    ``counts[n]`` is how many pieces have ``n`` ids. ``pieces`` pieces of ``length``, beginning
    with the one numbered ``rank``, go to the sequences from ``sequence`` on, ``per_sequence`` in
    each, side by side from ``offset``.
    """
    counts = counts.astype(np.int64).copy()
    taken = np.zeros_like(counts)
    rows, sequence = [], 0
    while counts[1:].any():
        lengths, uses = np.unique(_fill(counts, capacity), return_counts=True)
        times = int((counts[lengths] // uses).min())
        offset = 0
        for length, use in zip(lengths[::-1].tolist(), uses[::-1].tolist()):
            rows.append((length, int(taken[length]), use * times, sequence, use, offset))
            taken[length] += use * times
            counts[length] -= use * times
            offset += length * use
        sequence += times
    return rows


class Places:
    """The place of piece number ``rank`` of a length, by binary search in a plan."""

    def __init__(self, rows: list[tuple[int, int, int, int, int, int]]):
        table = np.array(sorted(rows), np.int64).reshape(-1, 6)
        self.lengths, self.first_rank, _, self.sequence, self.per, self.offset = table.T

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.empty(len(length), np.int64)
        for value in np.unique(length):
            begin, end = np.searchsorted(self.lengths, [value, value + 1])
            mine = length == value
            row[mine] = begin - 1 + np.searchsorted(self.first_rank[begin:end], rank[mine], "right")
        within = rank - self.first_rank[row]
        return (self.sequence[row] + within // self.per[row],
                self.offset[row] + within % self.per[row] * length)


def _placed(batches: Iterable[pa.RecordBatch], rows: list) -> Iterator[pa.RecordBatch]:
    places = Places(rows)
    for batch in batches:
        if batch.num_rows:
            sequence, offset = places.find(T.column(batch, "length").to_numpy(),
                                           T.column(batch, "rank").to_numpy())
            kept = batch.select([n for n in batch.schema.names if n != "rank"])
            yield kept.append_column("sequence_id", pa.array(sequence)).append_column(
                "offset", pa.array(offset))


def pack(cut: DataFrame, capacity: int = CAPACITY, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Give every row of ``cut`` its ``sequence_id`` and ``offset``.

    ``cut`` has ``doc_id``, ``piece`` and ``length`` (1 to ``capacity``) and must give the same
    rows each time it is read.
    """
    spark: SparkSession = cut.sparkSession
    counted = cut.groupBy("length").count().collect()  # at most one row per possible length
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in counted:
        counts[length] = n
    buckets = max(1, int(counts.sum()) // bucket_rows)
    own = [c for c in cut.columns if c in ("doc_id", "piece", "start", "ids_crc32")]
    rows = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    # Rows before a bucket, by length: the sums run over one row per length and bucket.
    sizes = rows.groupBy("length", "bucket").count()
    before = W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("length", "bucket",
                         F.coalesce(F.sum("count").over(before), F.lit(0)).alias("earlier"))
    within = W.partitionBy("bucket", "length").orderBy(*own)
    ranked = rows.withColumn("place", F.row_number().over(within)).join(
        sizes, ["length", "bucket"]).withColumn(
        "rank", F.col("earlier") + F.col("place") - 1).select(*cut.columns, "rank")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
    return ranked.mapInArrow(partial(_placed, rows=plan(counts, capacity)),
                             f"{fields}, sequence_id bigint, offset bigint")


def packed(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY,
           closing: int = CLOSING_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places; the ids themselves if asked for."""
    cut = written(pieces(docs, vocabulary, capacity, closing, with_ids)
                  .select("doc_id", "piece", "start", "length", "ids_crc32",
                          *["ids"] * with_ids), "pieces")
    return pack(cut, capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """The ids of every sequence, from pieces that carry their ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # capacity pieces at most
    return placed.groupBy("sequence_id").agg(
        F.flatten(F.transform(parts, lambda p: p.ids)).alias("ids"))
