"""Alignment of two tokenizers' tokens by byte offsets, and how often ids stand for each other.

1. A text is encoded by both tokenizers, A (byte-level BPE, behind a space) and B (a SentencePiece
   model that adds the space itself). A space between two printable ASCII characters separates
   tokens of both, so every distinct stretch of a task is encoded once and remembered.
2. Ends of tokens are sorted byte offsets. The shorter of a text's two end lists drives a galloping
   search (steps that double, then bisection) into the longer one. Ends in both lists cut the
   tokens into groups; the difference of ranks of neighbouring ends is the range of tokens that
   overlap one token, so all links follow without comparing pairs. The search runs for all segments
   of ``SEGMENT`` ends at once.
3. How many documents hold an id pair linked: a block of some ``BLOCK_BYTES`` of texts numbers its
   distinct pairs and counts its documents for each; only those counts are shuffled and summed, one
   row for a pair and a block. The most frequent B of every A id is a table no longer than A's
   vocabulary and is broadcast. The answers return to their blocks, whose documents keep their links
   as numbers of pairs, about a byte each.

Nulls and edges: a text that is null or empty, or that either tokenizer does not give back byte by
byte (signs like U+2581, which B takes for a space), has no tokens. Special tokens' strings are plain
text. Rows with a null ``doc_id`` and repeated rows count each. Ties for the most frequent B all
count. A very long text is a block of its own. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache, partial
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skytrace.llm import text as T
from skytrace.session import written

FIRST = public_tokenizers.path("byte_bpe_50k.json")
SECOND = public_tokenizers.path("piece_bpe_32k.model")
SEGMENT = 64
BLOCK_BYTES = 4 << 20
PART_BYTES = 1 << 20
PAIRS_A_ROW = 4096
#: Distinct stretches, and their bytes, beyond which a task begins to remember anew.
REMEMBERED = 400_000
REMEMBERED_BYTES = 16 << 20
#: Stretches that are encoded at once.
TOGETHER = 20

ALIGNED = "doc_id bigint, a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>"
BLOCKS = ("block bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
          "groups_sha256 string, links binary, first int, pairs array<bigint>, held array<int>")
COUNTED = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
           "count_sum bigint, groups_sha256 string")


# Encoding


def _byte_of_sign() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others from 256 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def _offsets(lengths) -> np.ndarray:
    return np.concatenate((np.zeros(1, np.int64), np.cumsum(np.asarray(lengths, np.int64))))


class Stretches:
    """Ids of distinct stretches, flat, in the order in which they were met."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {}
        self.bytes = 0
        self.ids = [np.zeros(0, np.int32)] * 2
        self.ends = [np.zeros(1, np.int64)] * 2
        self.sound = np.zeros(0, bool)


def stretches(data: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Stretches of all texts, each with the space before it, and the text of each."""
    filled = np.flatnonzero(np.diff(offsets))
    data = np.insert(data, offsets[filled], 32)
    begins = offsets[filled] + np.arange(len(filled))
    plain = (data > 32) & (data < 127)
    cut = np.zeros(len(data), bool)
    cut[1:-1] = (data[1:-1] == 32) & plain[:-2] & plain[2:]
    # The spaces put in front of texts are cuts, and nothing reaches from one text to the next.
    cut[begins] = True
    at = np.flatnonzero(cut)
    raw, ends = data.tobytes(), np.append(at[1:], len(data)).tolist()
    owner = filled[np.searchsorted(begins, at, "right") - 1]
    return [raw[a:b] for a, b in zip(at.tolist(), ends)], owner


class Encoders:
    """Both tokenizers, and the bytes of each of their tokens."""

    def __init__(self, first: str, second: bytes):
        self.first = Tokenizer.from_str(first)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_proto=second)
        signs = _byte_of_sign()
        size = self.first.get_vocab_size()
        names = [self.first.id_to_token(i) for i in range(size)]
        model = self.second
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        if any("\u2581" in p.lstrip("\u2581") for p in pieces):
            raise ValueError("a piece reaches across a space: texts cannot be cut there")
        self.bytes = [
            [bytes(signs[s] for s in n) if set(n) <= signs.keys() else n.encode() for n in names],
            [bytes([int(p[1:-1], 16)]) if model.is_byte(i) else p.replace("\u2581", " ").encode()
             for i, p in enumerate(pieces)]]
        self.lengths = [np.array(list(map(len, table)), np.int64) for table in self.bytes]
        self.kept = Stretches()

    def _encoded(self, texts: list[str]) -> list[list[list[int]]]:
        """Ids of A and of B for texts that begin with the space that B adds by itself."""
        return [[e.ids for e in self.first.encode_batch(texts, add_special_tokens=False)],
                self.second.encode([t[1:] for t in texts], num_threads=1)]

    def _whole(self, side: int, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes[side].__getitem__, ids))

    def _add(self, new: list[bytes]) -> None:
        """Encode stretches. Those with printable signs at both edges go through the tokenizers
        together, as no token reaches from one to the next; the others, and any that do not come
        back whole, are encoded one by one."""
        edged = [len(s) > 1 and 32 < s[1] < 127 and 32 < s[-1] < 127 for s in new]
        alone = [s for s, e in zip(new, edged) if not e]
        new = [s for s, e in zip(new, edged) if e]
        together = [new[i:i + TOGETHER] for i in range(0, len(new), TOGETHER)]
        joined = [b"".join(own) for own in together]
        found = self._encoded([j.decode() for j in joined])
        whole = [self._whole(0, a) == self._whole(1, b) == j for j, a, b in zip(joined, *found)]
        self._keep([s for own, w in zip(together, whole) if w for s in own],
                   [[i for ids, w in zip(side, whole) if w for i in ids] for side in found])
        for stretch in [*alone, *[s for own, w in zip(together, whole) if not w for s in own]]:
            found = [side[0] for side in self._encoded([stretch.decode()])]
            sound = self._whole(0, found[0]) == self._whole(1, found[1]) == stretch
            # Ids of a text that does not come back are of no use.
            self._keep([stretch], found if sound else [[], []], sound)

    def _keep(self, new: list[bytes], ids: list[list[int]], sound: bool = True) -> None:
        """Remember stretches and their ids, which follow each other without a gap."""
        kept = self.kept
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        for side in (0, 1):
            flat = np.array(ids[side], np.int32)
            ends = np.cumsum(self.lengths[side][flat])
            at = np.searchsorted(ends, np.cumsum(sizes), "right") if sound else np.zeros(1, np.int64)
            kept.ids[side] = np.concatenate((kept.ids[side], flat))
            kept.ends[side] = np.concatenate((kept.ends[side], kept.ends[side][-1] + at))
        kept.number.update(zip(new, range(len(kept.sound), len(kept.sound) + len(new))))
        kept.sound = np.concatenate((kept.sound, np.full(len(new), sound)))
        kept.bytes += int(sizes.sum())

    def encode(self, data: np.ndarray,
               offsets: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Flat ids of A and B, and where each text begins in them (one offset more)."""
        if len(self.kept.number) > REMEMBERED or self.kept.bytes > REMEMBERED_BYTES:
            self.kept = Stretches()
        n = len(offsets) - 1
        found, owner = stretches(data, offsets)
        number = self.kept.number
        new = [s for s in dict.fromkeys(found) if s not in number]
        if new:
            self._add(new)
        at = np.fromiter(map(number.__getitem__, found), np.int64, len(found))
        whole = np.bincount(owner, ~self.kept.sound[at], n) == 0
        at, owner = at[whole[owner]], owner[whole[owner]]
        ids, begins = [], []
        for side in (0, 1):
            starts, ends = self.kept.ends[side][at], self.kept.ends[side][at + 1]
            ids.append(self.kept.ids[side][_ranges(starts, ends - starts)])
            begins.append(_offsets(np.bincount(owner, ends - starts, n)))
        return ids, begins


@lru_cache(maxsize=2)
def _encoders(first: str, second: bytes) -> Encoders:
    """One pair of tokenizers for all tasks of a worker."""
    return Encoders(first, second)


def load(first: str = FIRST, second: str = SECOND) -> tuple[str, bytes]:
    """Contents of both tokenizer files."""
    return Path(first).read_text(encoding="utf-8"), Path(second).read_bytes()


# Galloping intersection


def gallop(values: np.ndarray, longer: np.ndarray, low: np.ndarray,
           last: np.ndarray) -> np.ndarray:
    """For each value the first position from ``low`` on whose entry is not smaller.

    The entry at ``last`` is not smaller than the value. Steps double from ``low`` on until they
    pass the value; the last step is then bisected.
    """
    low, high = low.copy(), low.copy()
    step = 1
    going = np.flatnonzero(longer[high] < values)
    while len(going):
        low[going] = high[going] + 1
        high[going] = np.minimum(high[going] + step, last[going])
        step *= 2
        going = going[longer[high[going]] < values[going]]
    going = np.flatnonzero(low < high)
    while len(going):
        middle = (low[going] + high[going]) >> 1
        small = longer[middle] < values[going]
        low[going[small]] = middle[small] + 1
        high[going[~small]] = middle[~small]
        going = going[low[going] < high[going]]
    return high


def positions(shorter: np.ndarray, begins: np.ndarray, longer: np.ndarray,
              longer_begins: np.ndarray) -> np.ndarray:
    """For each end of the shorter lists the position of the first end in its text's longer list
    that is not smaller. Both lists of a text have the same last end."""
    sizes = np.diff(begins)
    pieces = -(-sizes // SEGMENT)
    text = np.repeat(np.arange(len(sizes)), pieces)
    number = _ranges(np.zeros(len(sizes), np.int64), pieces)
    at = begins[:-1][text] + number * SEGMENT
    ends = np.minimum(at + SEGMENT, begins[1:][text])
    low, last = longer_begins[:-1][text], longer_begins[1:][text] - 1
    out = np.empty(len(shorter), np.int64)
    # The first end of a segment gallops from the text's begin, every other one from its neighbour.
    while len(at):
        low = gallop(shorter[at], longer, low, last)
        out[at] = low
        at = at + 1
        left = at < ends
        at, ends, low, last = at[left], ends[left], low[left], last[left]
    return out


@dataclass
class Alignment:
    """Aligned texts of one block; all arrays are flat, positions are those in the block."""

    ids: list[np.ndarray]  # of A and B
    begins: list[np.ndarray]  # where each text's tokens begin, one offset more
    cuts: list[np.ndarray]  # last token of every group, in A and in B
    groups: np.ndarray  # where each text's groups begin, one offset more
    a_at: np.ndarray  # the tokens of every link
    b_at: np.ndarray

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Id pairs of all links as numbers, text by text, and how many each text has."""
        pairs = self.ids[0][self.a_at].astype(np.int64) << 32 | self.ids[1][self.b_at]
        owner = np.searchsorted(self.begins[0], self.a_at, "right") - 1
        return pairs, np.bincount(owner, minlength=len(self.groups) - 1)


def aligned(texts: pa.Array, encoders: Encoders) -> Alignment:
    """Groups and links of whole texts."""
    ids, begins = encoders.encode(*T.buffer_of(texts))
    # Texts follow each other at their byte offsets, so one rising list serves all of them.
    ends = [np.cumsum(encoders.lengths[side][ids[side]]) for side in (0, 1)]
    sizes = [np.diff(b) for b in begins]
    cuts: list[list[np.ndarray]] = [[], []]
    linked: list[list[np.ndarray]] = [[], []]
    for short in (0, 1):
        long = 1 - short
        chosen = (sizes[0] <= sizes[1]) == (short == 0)
        own = np.flatnonzero(np.repeat(chosen, sizes[short]))
        other = np.flatnonzero(np.repeat(chosen, sizes[long]))
        of, longer = ends[short][own], ends[long][other]
        first = _offsets(sizes[short] * chosen)
        at = positions(of, first, longer, _offsets(sizes[long] * chosen))
        common = longer[at] == of if len(at) else np.zeros(0, bool)
        cuts[short].append(own[common])
        cuts[long].append(other[at[common]])
        # A token overlaps what lies from its neighbour's rank, or the one behind if that end is
        # common, up to its own rank.
        if len(at):
            begin = np.concatenate(([0], at[:-1] + common[:-1]))
            lengths = at - begin + 1
            linked[short].append(np.repeat(own, lengths))
            linked[long].append(other[_ranges(begin, lengths)])
    cut = [np.sort(np.concatenate(c)) for c in cuts]
    groups = np.searchsorted(cut[0], begins[0])
    pairs = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in linked]
    # Both sides' links are in order already, so this only merges them.
    order = np.argsort(pairs[0], kind="stable")
    return Alignment(ids, begins, cut, groups, pairs[0][order], pairs[1][order])


def alignments(docs: DataFrame, first: str = FIRST, second: str = SECOND) -> DataFrame:
    """Ids of both tokenizers and the last token of every group in either list (``a_cuts`` and
    ``b_cuts``, counted from the text's begin), for every row of ``docs``."""
    def lists(values: np.ndarray, begins: np.ndarray) -> pa.Array:
        return pa.LargeListArray.from_arrays(begins, pa.array(values.astype(np.int32))).cast(
            pa.list_(pa.int32()))

    def rows(batches: Iterable[pa.RecordBatch], files: tuple[str, bytes]) -> Iterator[pa.RecordBatch]:
        encoders = _encoders(*files)
        for batch in T.blocks(batches, size=PART_BYTES):
            found = aligned(T.column(batch, "text"), encoders)
            n = np.diff(found.groups)
            yield pa.RecordBatch.from_arrays(
                [T.column(batch, "doc_id"),
                 *[lists(found.ids[s], found.begins[s]) for s in (0, 1)],
                 *[lists(found.cuts[s] - np.repeat(found.begins[s][:-1], n), found.groups)
                   for s in (0, 1)]],
                ["doc_id", "a_ids", "b_ids", "a_cuts", "b_cuts"])

    return _texts(docs).mapInArrow(partial(rows, files=load(first, second)), ALIGNED)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


# Digests and counts


class Digests:
    """SHA-256 of ``a1,a2|b1;a3|b2,b3`` for the texts of an alignment."""

    def __init__(self, encoders: Encoders):
        sizes = [len(table) for table in encoders.bytes]
        # Each id with the sign behind it: inside a group, at a group's end.
        self.signs = [f"{i}{sign}".encode() for size, marks in zip(sizes, (",|", ",;"))
                      for i in range(size) for sign in marks]
        self.base = [0, 2 * sizes[0]]

    def of(self, found: Alignment) -> list[str]:
        number = [np.zeros(0, np.int64)] * 2
        marked = []
        for side in (0, 1):
            last = np.zeros(len(found.ids[side]), np.int64)
            last[found.cuts[side]] = 1
            number[side] = np.cumsum(last) - last  # the token's group
            marked.append(self.base[side] + 2 * found.ids[side].astype(np.int64) + last)
        before = [np.concatenate(([-1], cut)) + 1 for cut in found.cuts]
        out = np.empty(len(marked[0]) + len(marked[1]), np.int64)
        out[np.arange(len(marked[0])) + before[1][number[0]]] = marked[0]
        out[np.arange(len(marked[1])) + before[0][number[1] + 1]] = marked[1]
        begins = (found.begins[0] + found.begins[1]).tolist()
        return [hashlib.sha256(b"".join(map(self.signs.__getitem__, out[a:b].tolist()))[:-1])
                .hexdigest() if b > a else "" for a, b in zip(begins[:-1], begins[1:])]


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers as bytes of seven bits, lowest first, and where each begins (one offset more)."""
    sizes = np.ones(len(values), np.int64)
    for bits in (7, 14, 21, 28):
        sizes += values >> bits > 0
    begins = _offsets(sizes)
    out = np.zeros(begins[-1], np.uint8)
    for i in range(int(sizes.max()) if len(sizes) else 0):
        own = np.flatnonzero(sizes > i)
        out[begins[own] + i] = (values[own] >> 7 * i & 127) | np.where(sizes[own] > i + 1, 128, 0)
    return out, begins


def unpacked(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of ``packed`` bytes, and the byte at which each ends."""
    ends = np.flatnonzero(data < 128)
    begins = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    out = (data[begins] & 127).astype(np.int64)
    for i in range(1, int((ends - begins).max()) + 1 if len(ends) else 0):
        own = np.flatnonzero(ends - begins >= i)
        out[own] |= (data[begins[own] + i] & 127).astype(np.int64) << 7 * i
    return out, ends


class Block:
    """Rows of neighbouring texts, and the pairs they link."""

    def __init__(self) -> None:
        self.bytes = 0
        self.rows: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.links: list[np.ndarray] = []

    def add(self, ids: list, found: Alignment, digests: list[str]) -> None:
        pairs, links = found.links()
        self.pairs.append(pairs)
        self.links.append(links)
        self.rows += zip(ids, *(np.diff(b).tolist() for b in (*found.begins, found.groups)),
                         links.tolist(), digests)

    def batches(self, block: int) -> Iterator[pa.RecordBatch]:
        """A row per document, then rows of pairs with the number of the block's documents."""
        distinct, number = np.unique(np.concatenate(self.pairs), return_inverse=True)
        counts = np.concatenate(self.links)
        owner = np.repeat(np.arange(len(counts)), counts)
        keys = np.sort(owner * max(len(distinct), 1) + number)
        once = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, bool)
        held = np.bincount(keys[once] % max(len(distinct), 1), minlength=len(distinct))
        # Frequent pairs get small numbers, so that most steps between them take one byte.
        order = np.argsort(-held, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        keys = np.sort(owner * max(len(distinct), 1) + place[number])
        number = keys - owner * max(len(distinct), 1)
        steps = np.diff(number, prepend=0)
        begins = _offsets(counts)
        filled = begins[:-1][counts > 0]
        steps[filled] = number[filled]
        data, at = packed(steps)
        links = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(counts), [None, pa.py_buffer(at[begins]), pa.py_buffer(data)])
        yield _rows(block, len(counts), [
            *(pa.array(c, t) for c, t in zip(
                zip(*self.rows), (pa.int64(),) * 5 + (pa.string(),))), links.cast(pa.binary())], {})
        distinct, held = distinct[order], held[order].astype(np.int32)
        for begin in range(0, len(distinct), PAIRS_A_ROW):
            part = slice(begin, begin + PAIRS_A_ROW)
            yield _rows(block, 1, [], {"first": [begin], "pairs": [distinct[part]],
                                       "held": [held[part]]})


_TYPES = {"block": pa.int64(), "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(),
          "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(),
          "links": pa.binary(), "first": pa.int32(), "pairs": pa.list_(pa.int64()),
          "held": pa.list_(pa.int32())}


def _rows(block: int, n: int, document: list[pa.Array], others: dict) -> pa.RecordBatch:
    names = list(_TYPES)
    given = dict(zip(names[1:], document)) | {k: pa.array(v, _TYPES[k]) for k, v in others.items()}
    given["block"] = pa.array(np.full(n, block))
    return pa.RecordBatch.from_arrays(
        [given[k] if k in given else pa.nulls(n, t) for k, t in _TYPES.items()], names)


def _blocks(batches: Iterable[pa.RecordBatch], files: tuple[str, bytes],
            size: int) -> Iterator[pa.RecordBatch]:
    encoders = _encoders(*files)
    digests = Digests(encoders)
    task, number, block = TaskContext.get().partitionId(), 0, Block()
    for batch in T.blocks(batches, size=PART_BYTES):
        texts = T.column(batch, "text")
        found = aligned(texts, encoders)
        block.add(T.column(batch, "doc_id").to_pylist(), found, digests.of(found))
        block.bytes += pc.sum(pc.binary_length(texts)).as_py() or 0
        if block.bytes >= size:
            yield from block.batches(task << 32 | number)
            number, block = number + 1, Block()
    if block.rows:
        yield from block.batches(task << 32 | number)


def _looked_up(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """Counts of one block's documents from the answers to its pairs."""
    size = answers.num_rows
    number = answers.column("number").to_numpy()
    counts, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    counts[number] = answers.column("docs").to_numpy()
    best[number] = answers.column("best").to_numpy().astype(np.int64)
    data, at = T.buffer_of(docs.column("links").combine_chunks())
    steps, ends = unpacked(data)
    firsts = np.searchsorted(ends, at)
    running = np.cumsum(steps)
    base = np.concatenate(([0], running))[firsts[:-1]]
    links = running - np.repeat(base, np.diff(firsts))
    return docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"]).append_column(
        "n_best", pa.array(T.per_text(best[links], firsts))).append_column(
        "count_sum", pa.array(T.per_text(counts[links], firsts))).append_column(
        "groups_sha256", docs.column("groups_sha256"))


def counted(docs: DataFrame, first: str = FIRST, second: str = SECOND,
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Sizes and digest of every row's alignment, and how common its links are in all rows."""
    found = written(_texts(docs).mapInArrow(
        partial(_blocks, files=load(first, second), size=block_bytes), BLOCKS), "aligned")
    pairs = found.where(F.col("pairs").isNotNull()).select(
        "block", "first", F.posexplode(F.arrays_zip("pairs", "held")).alias("at", "own")).select(
        "block", (F.col("first") + F.col("at")).alias("number"),
        F.col("own.pairs").alias("pair"), F.col("own.held").alias("held"))
    totals = written(pairs.groupBy("pair").agg(F.sum("held").alias("docs")), "pairs").withColumn(
        "a", F.shiftrightunsigned("pair", 32))
    # One row for each id of A at most.
    highest = totals.groupBy("a").agg(F.max("docs").alias("highest"))
    totals = totals.join(F.broadcast(highest), "a").select(
        "pair", "docs", (F.col("docs") == F.col("highest")).alias("best"))
    # Pairs and their blocks grow with the documents: both sides are shuffled.
    answers = pairs.drop("held").join(totals.hint("merge"), "pair").select(
        F.col("block").alias("asked"), "number", "docs", "best")
    texts = found.where(F.col("links").isNotNull()).select(
        "block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links")
    return texts.groupBy("block").cogroup(answers.groupBy("asked")).applyInArrow(
        _looked_up, COUNTED)
