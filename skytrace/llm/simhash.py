"""Near duplicates by SimHash and a Gray-order hierarchical index.

1. Every text gets a 64-bit fingerprint in one scan; equal fingerprints become one row.
2. Candidates: 64 bits are cut into blocks, and fingerprints that differ in at most ``distance``
   bits agree on ``blocks - distance`` of the blocks. Each choice of such blocks is a band, and
   rows of one band with equal block values meet in a bucket. With more fingerprints more blocks
   are used, so buckets stay small; the links found are the same for any number.
3. A bucket is searched by an index: fingerprints sorted by Gray rank, runs of them factored into
   the bit pattern they share, runs of runs into upper nodes. Two nodes whose shared bits differ
   too often are pruned with all they hold. Differences found in an upper node are carried down,
   and only bits that are shared further below are counted there.
4. A bucket returns each of its components as a star, never all pairs. Oversized buckets are cut
   into pieces, and each pair of pieces is a task of its own.
5. Components: alternating large and small stars, each round written to the shared folder.

Nulls and edges: null and empty texts have fingerprint zero and are linked like any other. A null
``doc_id`` keeps its row; a component's id is its smallest non-null ``doc_id``. Repeated rows are
kept, one output row each. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from itertools import accumulate, combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytrace.llm import text as T
from skytrace.session import written

SHINGLE_WORDS = 4
SEED = 42
DISTANCE = 4
BUCKET_ROWS = 1024
PIECE_ROWS = 32_768
LEAF = 64
FANOUT = 16


# Fingerprints


def fingerprint(text: bytes, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Bits set in over half of the hashes of all shingles; zero without words."""
    votes, total, carried = np.zeros(64, np.int64), 0, []
    for chunk in T.word_chunks(text):
        carried += chunk
        if len(carried) >= words:
            votes, total = _add(votes, total, carried, words, seed)
            carried = carried[len(carried) - words + 1:]
    if not total and carried:
        votes, total = _add(votes, total, carried, len(carried), seed)
    bits = np.packbits(votes * 2 > total, bitorder="little")
    return int(bits.view(np.uint64)[0])


def _add(votes, total, tokens, words, seed):
    joined = b" ".join(tokens)
    ends = list(accumulate(len(w) + 1 for w in tokens))
    begins = [0, *ends[:len(tokens) - words]]
    shingles = (joined[a:b - 1] for a, b in zip(begins, ends[words - 1:]))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64,
                         len(begins))
    for part in np.array_split(hashes, len(hashes) // 65_536 + 1):
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes = votes + bits.sum(axis=0, dtype=np.int64)
    return votes, total + len(hashes)


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _fingerprints(batches: Iterable[pa.RecordBatch], words: int,
                  seed: int) -> Iterator[pa.RecordBatch]:
    for batch in T.blocks(batches):
        texts = T.column(batch, "text").cast(pa.binary()).to_pylist()
        found = np.array([fingerprint(t or b"", words, seed) for t in texts], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [T.column(batch, "doc_id"), T.column(batch, "text_hash"),
             pa.array(found.view(np.int64))], ["doc_id", "text_hash", "fp"])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """``doc_id``, a hash of the text and the fingerprint ``fp`` as a signed number, for every row."""
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"),
                       text_hash(F.col("text")).alias("text_hash")).mapInArrow(
        partial(_fingerprints, words=words, seed=seed),
        "doc_id bigint, text_hash bigint, fp bigint")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# The index


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the order in which neighbours differ by one bit."""
    rank = codes.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(shift))
    return rank


def _nodes(low: np.ndarray, high: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """And, or of runs of ``size`` children; bits on which they agree are the node's pattern."""
    at = np.arange(0, len(low), size)
    return np.bitwise_and.reduceat(low, at), np.bitwise_or.reduceat(high, at)


def _shared_difference(low, high, left, right) -> tuple[np.ndarray, np.ndarray]:
    """Bits both nodes fix, and those of them on which they differ."""
    both = ~(low[left] ^ high[left]) & ~(low[right] ^ high[right])
    return both, (low[left] ^ low[right]) & both


def components(codes: np.ndarray, distance: int = DISTANCE) -> np.ndarray:
    """For distinct codes, the position of one member of each code's component."""
    order = np.argsort(gray_rank(codes), kind="stable")
    codes = codes[order]
    label = np.arange(len(codes))

    def join(left: np.ndarray, right: np.ndarray) -> None:
        near = np.bitwise_count(codes[left][:, None] ^ codes[right][None, :]) <= distance
        a, b = np.nonzero(near)
        pairs = np.stack((label[left[a]], label[right[b]]))
        pairs = np.unique(pairs[:, pairs[0] != pairs[1]], axis=1)
        for x, y in pairs.T:
            x, y = into.get(x, x), into.get(y, y)
            while x in into:
                x = into[x]
            while y in into:
                y = into[y]
            if x != y:
                label[label == max(x, y)] = min(x, y)
                into[max(x, y)] = min(x, y)
        into.clear()

    into: dict[int, int] = {}
    if len(codes) <= LEAF:
        everything = np.arange(len(codes))
        join(everything, everything)
    else:
        low, high = _nodes(codes, codes, LEAF)
        upper_low, upper_high = _nodes(low, high, FANOUT)
        uppers = len(upper_low)
        for gap in range(uppers):
            left = np.arange(uppers - gap)
            both, differ = _shared_difference(upper_low, upper_high, left, left + gap)
            carried = np.bitwise_count(differ)
            for i in left[carried <= distance]:
                _descend(i, i + gap, both[i], carried[i], low, high, label, join, distance,
                         len(codes))
    out = np.empty(len(codes), np.int64)
    out[order] = order[label]
    return out


def _descend(i, j, seen, carried, low, high, label, join, distance, n) -> None:
    """Leaves below two upper nodes, nearest in Gray order first."""
    a = np.arange(i * FANOUT, min((i + 1) * FANOUT, len(low)))
    b = np.arange(j * FANOUT, min((j + 1) * FANOUT, len(low)))
    left, right = (x.ravel() for x in np.meshgrid(a, b, indexing="ij"))
    keep = left <= right
    left, right = left[keep], right[keep]
    both, differ = _shared_difference(low, high, left, right)
    total = carried + np.bitwise_count(differ & ~seen)
    near = np.flatnonzero(total <= distance)
    for k in near[np.argsort(right[near] - left[near], kind="stable")]:
        rows_a = np.arange(left[k] * LEAF, min((left[k] + 1) * LEAF, n))
        rows_b = np.arange(right[k] * LEAF, min((right[k] + 1) * LEAF, n))
        first = label[rows_a[0]]
        # Codes that are in one component already have nothing left to link.
        if not ((label[rows_a] == first).all() and (label[rows_b] == first).all()):
            join(rows_a, rows_b)


def _stars(batches: Iterable[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Whole buckets in, ``(fp, hub)`` of every code that is linked to a smaller one out."""
    tables = [b for b in batches if b.num_rows]
    if not tables:
        return
    table = pa.Table.from_batches(tables)
    bucket = table.column("bucket").to_numpy()
    codes = table.column("fp").to_numpy().view(np.uint64)
    order = np.argsort(bucket, kind="stable")
    bucket, codes = bucket[order], codes[order]
    edges = np.flatnonzero(np.diff(bucket)) + 1
    sizes = np.diff(np.concatenate(([0], edges, [len(bucket)])))
    members, hubs = [], []
    for begin, size in zip(np.concatenate(([0], edges)), sizes):
        if size > 1:
            own = codes[begin:begin + size]
            hub = own[components(own, distance)]
            members.append(own[hub != own])
            hubs.append(hub[hub != own])
    if members:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x).view(np.int64)) for x in (members, hubs)], ["fp", "hub"])


# Candidates and components


def blocks_for(n: int, distance: int = DISTANCE, bucket_rows: int = BUCKET_ROWS) -> int:
    """Blocks that leave about ``bucket_rows`` of ``n`` evenly spread fingerprints in a bucket."""
    blocks = distance + 1
    while blocks < distance + 4 and n / 2 ** (64 * (blocks - distance) / blocks) > bucket_rows:
        blocks += 1
    return blocks


def bands(blocks: int, distance: int = DISTANCE) -> list[int]:
    """Bit masks of every choice of ``blocks - distance`` of the blocks, as signed numbers."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:])]
    masks = [sum(choice) for choice in combinations(parts, blocks - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(distinct: DataFrame, distance: int = DISTANCE, bucket_rows: int = BUCKET_ROWS,
          piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Stars ``(fp, hub)`` that connect whatever a chain of links connects within a bucket."""
    n = distinct.count()
    masks = bands(blocks_for(n, distance, bucket_rows), distance)
    # The mask is part of the hashed key: values of different bands do not meet.
    rows = distinct.select("fp", F.explode(F.array(*[
        F.xxhash64(F.lit(m), F.col("fp").bitwiseAND(F.lit(m))) for m in masks])).alias("bucket"))
    large = (rows.groupBy("bucket").count().where(F.col("count") > 1)
             .select("bucket", F.ceil(F.col("count") / F.lit(piece_rows)).alias("pieces")))
    own = F.pmod(F.xxhash64("fp"), "pieces")
    placed = rows.join(large, "bucket").withColumn("own", own)
    # With several pieces a row goes to every pair of pieces that has its own.
    other = F.filter(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1),
                     lambda i: (F.col("pieces") == 1) | (i != F.col("own")))
    placed = placed.select("fp", "bucket", "own", F.explode(other).alias("other")).select(
        "fp", F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other"))
        .alias("bucket"))
    return (placed.repartition("bucket").mapInArrow(
        partial(_stars, distance=distance), "fp bigint, hub bigint").distinct())


def smallest_reachable(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and the smallest node it is connected with, for all nodes that have an edge.

    Large stars connect each node's greater neighbours with its smallest one, small stars its
    smaller neighbours; the rounds end when an edge leads from every node to its component's
    smallest. Edges never outnumber those given.
    """
    pairs = edges.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("to"))
    pairs = written(pairs.where(F.col("node") != F.col("to")).distinct(), "links")
    state = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("to").alias("node"), F.col("node").alias("to")))
        least = both.groupBy("node").agg(F.min("to").alias("low"))
        large = (both.where(F.col("to") > F.col("node"))
                 .join(least.withColumn("low", F.least("low", "node")).hint("merge"), "node")
                 .select(F.col("to").alias("node"), F.col("low").alias("to")).distinct())
        low = large.groupBy("node").agg(F.min("to").alias("low"))
        small = large.join(low.hint("merge"), "node")
        small = small.select("node", F.col("low").alias("to")).unionByName(
            small.where(F.col("to") != F.col("low"))
            .select(F.col("to").alias("node"), F.col("low").alias("to")))
        pairs = written(small.distinct(), "links")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("node", "to").cast("decimal(38,0)"))).first()
        if now == state:
            return pairs.select("node", F.col("to").alias("root"))
        state = now


def _rooted(docs: DataFrame, words: int, seed: int, distance: int) -> DataFrame:
    """``doc_id``, ``text_hash``, ``fp``, ``component_id`` and the component's ``root`` of each row."""
    prints = written(fingerprints(docs, words, seed), "prints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = smallest_reachable(links(distinct, distance), "fp", "hub")
    rooted = distinct.join(roots.withColumnRenamed("node", "fp").hint("merge"), "fp",
                           "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(lowest.hint("merge"), "root").select("fp", "root", "component_id")
    return prints.join(named.hint("merge"), "fp")


def groups(docs: DataFrame, words: int = SHINGLE_WORDS, seed: int = SEED,
           distance: int = DISTANCE) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id`` of every row of ``docs``."""
    return _rooted(docs, words, seed, distance).select(
        "doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS, seed: int = SEED,
             distance: int = DISTANCE) -> DataFrame:
    """One row of each group of near duplicates: its smallest ``doc_id``, with all columns.

    Of several rows with that id in one group one stays, the one with the smallest hash of its text;
    rows with one id in different groups are judged apart. Rows without an id stay, as nothing names
    them.
    """
    found = _rooted(docs, words, seed, distance)
    chosen = written(found.where(F.col("doc_id") == F.col("component_id")).groupBy(
        "component_id", "root").agg(F.min("text_hash").alias("first_hash")), "kept")
    own = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("id"),
                      text_hash(F.col("text")).alias("hash"))
    # The ids grow with the documents, so both sides are shuffled, however few they are today.
    kept = own.join(chosen.hint("merge"), (F.col("id") == F.col("component_id"))
                    & (F.col("hash") == F.col("first_hash")), "left_semi")
    # Repeated rows of one id and text: only where there are any are rows compared.
    again = found.groupBy("doc_id", "text_hash").count().where(
        (F.col("count") > 1) & F.col("doc_id").isNotNull())
    if not again.isEmpty():
        kept = kept.dropDuplicates(["id", "hash"])
    return kept.select("row.*").unionByName(docs.where(F.col("doc_id").isNull()))
