"""Scoring texts by an interpolated word trigram model kept in Elias-Fano tries.

Tokens are lower-cased words and one end per text. The model is spread over as many tries as its
size asks for; each holds some contexts with all that follows them.

1. One scan turns the documents into blocks: local word numbers of all tokens, and the words.
2. Words meet by hash: they are counted over the training documents and numbered by frequency. Each
   block gets the numbers and counts of its own words back.
3. Each block sends its distinct triples, with training counts, to the tries of their first words. A
   frequent first word is spread over several tries by the second one, in proportion to its count.
4. A trie is built from all blocks' counts, written, memory-mapped, and queried with the triples of
   the same blocks; the codes found go back to the blocks, which add up their documents' scores.

The sizes of blocks and tries are fixed, their numbers grow with the corpus; no table of all words or
triples is ever in one place. Blocks are written once, so a lost executor repeats its tasks only.

Probability of a word: (its count + 0.1) / (all + 0.1 (words + 1)). After another word: the pair's
count over the context's count plus ``PAIR_WEIGHT`` x count ** ``PAIR_POWER``, and the rest of the
weight times the word's own probability. After two words: Witten-Bell, with the number of different
followers as pseudo-count. Shares are stored rounded down, so probabilities never sum above one.

Nulls and edges: a null text is empty and has the end only. A null ``doc_id`` is not held out.
Repeated rows count and are scored each. Without training documents every score is that of unseen
words. Equal words are told by 64-bit hashes. Other columns are ignored.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from functools import partial
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytrace.llm import text as T
from skytrace.llm.eliasfano import Trie, distinct_rows, probabilities, quantised
from skytrace.session import written

ADDED = 0.1
PAIR_WEIGHT, PAIR_POWER = 2.0, 0.8
BLOCK_TOKENS = 1_500_000
WORD_PART_BYTES = 32 << 20
TRIE_TOKENS = 1_000_000

#: Stands for the end of a text.
END = np.uint64(0x656E64)

BLOCKS = ("block string, doc_ids array<bigint>, held array<boolean>, sizes array<bigint>, "
          "trained bigint, tokens binary, homes binary, words binary, counts binary")
ASKED = "shard bigint, block string, words binary, counts binary"
NAMED = "block string, shard bigint, kind int, known bigint, content binary"
SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, "
          "score double")


def held_out(doc_id: Column) -> Column:
    """Rows that are not learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0, F.lit(False))


# Columns of whole numbers as bytes


def pack(*columns: np.ndarray) -> bytes:
    """Non-negative numbers, byte by byte of their width, compressed."""
    out = []
    for c in columns:
        c = np.ascontiguousarray(c, dtype="<u8")
        width = max(1, (int(c.max(initial=0)).bit_length() + 7) // 8)
        planes = np.ascontiguousarray(c.view(np.uint8).reshape(-1, 8)[:, :width].T)
        body = zstandard.ZstdCompressor(level=1).compress(planes.tobytes())
        out.append(np.array([len(c), width, len(body)], "<u8").tobytes() + body)
    return b"".join(out)


def unpack(content: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(content):
        n, width, size = np.frombuffer(content, "<u8", 3, at).tolist()
        body = zstandard.ZstdDecompressor().decompress(
            content[at + 24:at + 24 + size], max_output_size=max(1, n * width))
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :width] = np.frombuffer(body, np.uint8).reshape(width, n).T
        out.append(wide.view("<u8").ravel().astype(np.int64))
        at += 24 + size
    return out


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(),
             "boolean": pa.bool_(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()),
             "array<boolean>": pa.list_(pa.bool_())}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


# Blocks and words


def _block(parts: list[tuple], shards: int) -> tuple:
    doc_ids, held, sizes, hashes = (sum((p[i] for p in parts), []) for i in range(4))
    sizes = np.concatenate(sizes)
    words, tokens, counts = np.unique(np.concatenate(hashes), return_inverse=True,
                                      return_counts=True)
    # Frequent words get small numbers, which take little space.
    order = np.argsort(-counts, kind="stable")
    number = np.empty(len(words), np.int64)
    number[order] = np.arange(len(words))
    words, tokens = words[order], number[tokens]
    learned = np.repeat(~np.array(held, bool), sizes)
    counts = np.bincount(tokens[learned], minlength=len(words))
    return (uuid.uuid4().hex, doc_ids, held, sizes.tolist(), int(learned.sum()), pack(tokens),
            pack(words % np.uint64(shards)), words.astype("<u8").tobytes(), pack(counts))


def _blocks(batches: Iterable[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    parts, n = [], 0
    for batch in T.blocks(batches):
        hashes, firsts = T.word_hashes(*T.buffer_of(T.column(batch, "text")))
        hashes = np.insert(hashes, firsts[1:], END)
        parts.append((T.column(batch, "doc_id").to_pylist(), T.column(batch, "held").to_pylist(),
                      [np.diff(firsts) + 1], [hashes]))
        n += len(hashes)
        if n >= BLOCK_TOKENS:
            yield _rows(BLOCKS, [_block(parts, shards)])
            parts, n = [], 0
    if parts:
        yield _rows(BLOCKS, [_block(parts, shards)])


def _asked(batches: Iterable[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """Each block's words and counts, by the shard that has the word."""
    for batch in batches:
        for block, content, counted in zip(*(c.to_pylist() for c in batch.columns)):
            words, (counts,) = np.frombuffer(content, "<u8"), unpack(counted)
            home = words % np.uint64(shards)
            for shard in range(shards):
                own = home == shard
                if own.any():
                    yield _rows(ASKED, [(shard, block, words[own].tobytes(), pack(counts[own]))])


def _named(key: tuple, table: pa.Table, shards: int) -> pa.Table:
    """Number and count of every word of a shard, for each block that has it."""
    shard = key[0].as_py()
    blocks = table.column("block").to_pylist()
    asked = [np.frombuffer(c, "<u8") for c in table.column("words").to_pylist()]
    counts = np.concatenate([unpack(c)[0] for c in table.column("counts").to_pylist()])
    words, which = np.unique(np.concatenate(asked), return_inverse=True)
    totals = np.bincount(which, counts, len(words)).astype(np.int64)
    order = np.lexsort((words, -totals))
    numbers = np.empty(len(words), np.int64)
    numbers[order] = np.arange(len(words)) * shards + shard + 1
    ends = np.cumsum([len(a) for a in asked])
    rows = [(block, shard, 0, int((totals > 0).sum()),
             pack(numbers[which[end - len(a):end]], totals[which[end - len(a):end]]))
            for block, a, end in zip(blocks, asked, ends)]
    return pa.Table.from_batches([_rows(NAMED, rows)])


# Triples and tries


def pair_weight(counts: np.ndarray) -> np.ndarray:
    """Pseudo-count that contexts of some counts leave to single words."""
    return np.where(counts > 0, PAIR_WEIGHT * np.maximum(counts, 1.0) ** PAIR_POWER, 1.0)


class Block:
    """The tokens of a block, its distinct pairs and triples, and which trie has each of them."""

    def __init__(self, left: pa.Table, names: list[dict], tries: int, quota: int):
        (tokens,) = unpack(left.column("tokens")[0].as_py())
        (homes,) = unpack(left.column("homes")[0].as_py())
        self.sizes = np.array(left.column("sizes")[0].as_py(), np.int64)
        held = np.array(left.column("held")[0].as_py(), bool)
        numbers, counts = np.zeros(len(homes), np.int64), np.zeros(len(homes), np.int64)
        for row in names:
            own = homes == row["shard"]
            numbers[own], counts[own] = unpack(row["content"])
        self.starts = np.cumsum(self.sizes) - self.sizes
        last = self.starts + self.sizes - 1
        # Local numbers in order of the global ones, so that distinct rows are sorted by these.
        order = np.argsort(numbers, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        numbers, counts = numbers[order], counts[order]
        tokens = rank[tokens]
        self.second = tokens.astype(np.int32)
        self.counts = counts
        first = np.roll(tokens, 1)
        first[self.starts] = tokens[last]
        pair_keys, pair = np.unique(first << 32 | tokens, return_inverse=True)
        self.pair = pair.astype(np.int32)
        third = np.roll(tokens, -1) + 1
        third[last] = 0
        keys, triple = np.unique(pair << 32 | third, return_inverse=True)
        self.triple = triple.astype(np.int32)
        del first, pair, triple, tokens, third
        learned = np.repeat(~held, self.sizes)
        self.triple_counts = np.bincount(self.triple[learned], minlength=len(keys))
        self.pair_of = keys >> 32
        third = keys & 0xFFFFFFFF
        self.thirds = np.where(third > 0, numbers[np.maximum(third, 1) - 1], 0)
        first, second = pair_keys >> 32, pair_keys & 0xFFFFFFFF
        self.firsts, self.seconds = numbers[first], numbers[second]
        self.first_counts = counts[first]
        spread = 1 + self.first_counts // quota
        slot = (T.mixed(self.seconds) % spread.astype(np.uint64)).astype(np.int64)
        shard = ((T.mixed(self.firsts + (1 << 40)) % np.uint64(tries)).astype(np.int64)
                 + slot) % tries
        # Pairs, and triples, of each trie in order.
        self.pair_order = np.argsort(shard, kind="stable")
        self.pair_ends = np.cumsum(np.bincount(shard, minlength=tries))
        of_triple = shard[self.pair_of]
        self.triple_order = np.argsort(of_triple, kind="stable")
        self.triple_ends = np.cumsum(np.bincount(of_triple, minlength=tries))

    def share(self, shard: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs and triples of a trie."""
        begins = [ends[shard - 1] if shard else 0 for ends in (self.pair_ends, self.triple_ends)]
        return (self.pair_order[begins[0]:self.pair_ends[shard]],
                self.triple_order[begins[1]:self.triple_ends[shard]])


def _request(block: Block, shard: int) -> bytes:
    pairs, triples = block.share(shard)
    roots, root = distinct_rows(block.firsts[pairs])
    per_pair = np.bincount(np.searchsorted(pairs, block.pair_of[triples]), minlength=len(pairs))
    first = block.firsts[pairs][roots]
    return pack(np.diff(first, prepend=0), block.first_counts[pairs][roots],
                np.bincount(root, minlength=len(roots)), block.seconds[pairs], per_pair,
                block.thirds[triples], block.triple_counts[triples])


def _requests(left: pa.Table, right: pa.Table, tries: int, quota: int) -> pa.Table:
    block = Block(left, right.to_pylist(), tries, quota)
    name = left.column("block")[0].as_py()
    rows = [(shard, name, _request(block, shard), b"") for shard in range(tries)
            if len(block.share(shard)[0])]
    return pa.Table.from_batches([_rows(ASKED, rows)])


def _expanded(content: bytes) -> tuple[np.ndarray, ...]:
    """First, second and its context's count of each pair; pair, third and count of each triple."""
    steps, root_counts, per_root, second, per_pair, third, counts = unpack(content)
    return (np.repeat(np.cumsum(steps), per_root), second, np.repeat(root_counts, per_root),
            np.repeat(np.arange(len(second)), per_pair), third, counts)


def keyed(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """One number for each pair of numbers, in the same order."""
    if max(high.max(initial=0), low.max(initial=0)) >> 31:
        high, low = (np.unique(x, return_inverse=True)[1] for x in (high, low))
    return high << 32 | low


def build(requests: list[bytes]) -> Trie:
    """The trie of everything that some blocks count."""
    first, second, roots, pairs, third, counts, before = [], [], [], [], [], [], 0
    for content in requests:
        a, b, r, pair, c, n = _expanded(content)
        seen = np.flatnonzero(n)
        for column, values in ((first, a), (second, b), (roots, r), (pairs, pair[seen] + before),
                               (third, c[seen]), (counts, n[seen])):
            column.append(values)
        before += len(a)
    first, second, roots, pairs, third, counts = (
        np.concatenate(x) for x in (first, second, roots, pairs, third, counts))
    used = np.zeros(before, bool)
    used[pairs] = True
    _, at, number = np.unique(keyed(first[used], second[used]), return_index=True,
                              return_inverse=True)
    place = np.empty(before, np.int64)
    place[used] = number
    keys, number = np.unique(place[pairs] << 32 | third if not third.max(initial=0) >> 32 else
                             keyed(place[pairs], third), return_inverse=True)
    rows = np.empty(len(keys), np.int64)
    rows[number] = np.arange(len(number))
    return Trie.of_pairs(first[used][at], second[used][at], roots[used][at], place[pairs[rows]],
                         third[rows], np.bincount(number, counts, len(keys)), pair_weight)


def _once(root_counts: np.ndarray) -> np.ndarray:
    """Code of the share of a pair that occurs once, which many do."""
    own = root_counts.astype(float)
    return quantised(1.0 / (own + pair_weight(own))).astype(np.int64)


def _answer(trie: Trie, content: bytes) -> bytes:
    first, second, root_counts, pair, third, _ = _expanded(content)
    at = trie.pair(first, second)
    known = at >= 0
    share, left = np.zeros(len(at), np.int64), np.ones(len(at), np.int64)
    # As the difference from the code of a single occurrence, which compresses to next to nothing.
    share[known] = _once(root_counts[known]) - trie.pairs.values["share"][at[known]] + 1
    left[known] = trie.pairs.values["left"][at[known]]
    real = np.flatnonzero(third)
    below = trie.triples.find(at[pair[real]], third[real])
    found = np.zeros(len(third), np.int64)
    real, below = real[below >= 0], below[below >= 0]
    found[real] = trie.triples.values["share"][below]
    return pack(share, left, found)


def _answers(key: tuple, table: pa.Table) -> pa.Table:
    shard = key[0].as_py()
    requests = table.column("words").to_pylist()
    with tempfile.TemporaryDirectory() as folder:
        build(requests).save(folder)
        trie = Trie.load(folder)
        rows = [(block, shard, 1, 0, _answer(trie, content))
                for block, content in zip(table.column("block").to_pylist(), requests)]
    return pa.Table.from_batches([_rows(NAMED, rows)])


def _scored(left: pa.Table, right: pa.Table, tries: int, quota: int, total: int,
            known: int) -> pa.Table:
    rows = right.to_pylist()
    block = Block(left, [r for r in rows if r["kind"] == 0], tries, quota)
    share, rest = np.zeros(len(block.firsts), np.int64), np.ones(len(block.firsts), np.int64)
    triple_share = np.zeros(len(block.thirds), np.int64)
    for row in rows:
        if row["kind"] == 1:
            pairs, triples = block.share(row["shard"])
            share[pairs], rest[pairs], triple_share[triples] = unpack(row["content"])
    share = np.where(share > 0, _once(block.first_counts) - share + 1, 0)
    single = (block.counts + ADDED) / (total + ADDED * (known + 1))
    weight = pair_weight(block.first_counts.astype(float))
    back = weight / (block.first_counts + weight)
    own = single[block.second]
    p = probabilities(share)[block.pair] + back[block.pair] * own
    inner = np.ones(len(p), bool)
    inner[block.starts] = False
    before = np.flatnonzero(inner) - 1
    p[inner] = (probabilities(triple_share)[block.triple[before]]
                + probabilities(rest)[block.pair[before]] * p[inner])
    sums = [np.add.reduceat(x, block.starts) for x in (
        (block.counts[block.second] > 0).astype(np.int64), np.log10(own), np.log10(p))]
    return pa.Table.from_batches([pa.RecordBatch.from_arrays(
        [pa.array(left.column("doc_ids")[0].as_py(), pa.int64()),
         pa.array(left.column("held")[0].as_py(), pa.bool_()), pa.array(block.sizes),
         *map(pa.array, sums)],
        ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])])


def _prepared(docs: DataFrame) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Blocks, names of their words, and the sizes that follow from the corpus."""
    own = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = int(size // WORD_PART_BYTES) + 1
    blocks = written(own.withColumn("held", held_out(F.col("doc_id"))).mapInArrow(
        partial(_blocks, shards=shards), BLOCKS), "blocks")
    names = written(
        blocks.select("block", "words", "counts").mapInArrow(partial(_asked, shards=shards), ASKED)
        .groupBy("shard").applyInArrow(
            lambda key, table: _named(key, table, shards), NAMED), "names")
    total = blocks.agg(F.sum("trained")).first()[0] or 0
    known = names.groupBy("shard").agg(F.max("known").alias("n")).agg(F.sum("n")).first()[0] or 0
    tries = int(total // TRIE_TOKENS) + 1
    return blocks, names, {"tries": tries, "quota": int(total // tries) + 1, "total": int(total),
                           "known": int(known)}


def _asks(blocks: DataFrame, names: DataFrame, sizes: dict[str, int]) -> DataFrame:
    tries, quota = sizes["tries"], sizes["quota"]
    return blocks.select("block", "sizes", "held", "tokens", "homes").groupBy("block").cogroup(
        names.groupBy("block")).applyInArrow(
        lambda left, right: _requests(left, right, tries, quota), ASKED)


def scores(docs: DataFrame) -> DataFrame:
    """Token counts, unigram score and model score of every row's whole text."""
    blocks, names, sizes = _prepared(docs)
    answers = _asks(blocks, names, sizes).groupBy("shard").applyInArrow(
        lambda key, table: _answers(key, table), NAMED)
    return blocks.drop("words", "counts", "trained").groupBy("block").cogroup(
        names.unionByName(answers).groupBy("block")).applyInArrow(
        lambda left, right: _scored(left, right, **sizes), SCORES).withColumn(
        "train_tokens", F.lit(sizes["total"]).cast("bigint"))


def _files(key: tuple, table: pa.Table) -> pa.Table:
    with tempfile.TemporaryDirectory() as folder:
        build(table.column("words").to_pylist()).save(folder)
        rows = [(key[0].as_py(), name, Path(folder, name).read_bytes())
                for name in sorted(os.listdir(folder))]
    return pa.Table.from_batches([_rows("shard bigint, name string, content binary", rows)])


def trie_files(docs: DataFrame) -> DataFrame:
    """The files of every trie of the model, to be stored and mapped elsewhere."""
    return _asks(*_prepared(docs)).groupBy("shard").applyInArrow(
        lambda key, table: _files(key, table), "shard bigint, name string, content binary")
