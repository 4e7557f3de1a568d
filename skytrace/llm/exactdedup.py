"""Exact duplicates with a split of heavy hitters.

1. Every text is normalised (each run of white space becomes one space) and reduced to its SHA-256
   in one scan; the digests are written once, so all later steps read some 50 bytes a row.
2. Misra-Gries: every task keeps ``COUNTERS`` counters over its digests, the counters of tasks are
   merged in rounds. Whatever digest more than one in ``COUNTERS + 1`` rows has is among them.
3. The candidates are verified by a second pass: exact number of rows and first row of each, by
   aggregation before any shuffle. Candidates that are not frequent go.
4. The frequent digests' winners, at most ``COUNTERS`` rows, are broadcast: their rows, which may be
   most of the table, are settled where they lie. All other digests are shuffled as usual; none
   of them has more than one in ``COUNTERS + 1`` of the rows.

Nulls and edges: a null text counts as empty; leading and trailing white space counts, as one space.
Of equal texts the row with the smallest ``doc_id`` stays; a null id comes after all others, and of
repeated rows with one id exactly one stays. A group without any id has a null ``keep_id``. An empty
table gives no rows. Long texts are hashed whole. Other columns, whatever their names, are ignored
by ``groups`` and kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skytrace.llm.merging import merged
from skytrace.llm.text import column
from skytrace.session import written

COUNTERS = 4096
WHITE_SPACE = r"[\x20\x09-\x0D]+"
#: Ids and row numbers have 19 digits at most, so both fit into one decimal, in order.
_ROWS = Decimal(10 ** 19)
_NO_ID = Decimal(93 * 10 ** 17)


def digest_of(text: Column) -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    plain = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), WHITE_SPACE, " ")
    return F.unhex(F.sha2(plain, 256))


def prints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``digest``, its short ``key`` and the place ``rank`` in the order of preference."""
    found = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                        digest_of(F.col("text")).alias("digest"))
    number = F.monotonically_increasing_id().cast("decimal(19,0)")
    first = F.coalesce(F.col("doc_id").cast("decimal(19,0)"), F.lit(_NO_ID))
    rank = first * F.lit(_ROWS) + number
    # Row numbers are fixed by writing them.
    return written(found.withColumns({"key": F.xxhash64("digest"),
                                      "rank": rank.cast("decimal(38,0)")}), "digests")


def reduced(keys: np.ndarray, counts: np.ndarray,
            counters: int) -> tuple[np.ndarray, np.ndarray]:
    """Misra-Gries: at most ``counters`` keys; each count sinks by the first count left out."""
    keys, which = np.unique(keys, return_inverse=True)
    counts = np.bincount(which, counts, len(keys)).astype(np.int64)
    if len(keys) > counters:
        counts = counts - np.partition(counts, len(counts) - counters - 1)[-counters - 1]
        keys, counts = keys[counts > 0], counts[counts > 0]
    return keys, counts


def candidates(found: DataFrame, counters: int = COUNTERS) -> list[int]:
    """Keys that include those of more than one in ``counters + 1`` rows; at most ``counters``."""
    def batch(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "count"])

    def summarise(batches: Iterable[pa.RecordBatch]) -> pa.RecordBatch:
        keys = counts = np.zeros(0, np.int64)
        for part in batches:
            own = column(part, "key").to_numpy()
            keys, counts = reduced(np.concatenate((keys, own)),
                                   np.concatenate((counts, np.ones(len(own), np.int64))), counters)
        return batch(keys, counts)

    def combine(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([batch(*reduced(
            table.column("key").to_numpy(), table.column("count").to_numpy(), counters))])

    table = merged(found.select("key"), summarise, combine, "key bigint, count bigint")
    return table.column("key").to_pylist()


def _best(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(
        F.min("doc_id").alias("keep_id"), F.min("rank").alias("best"),
        F.count(F.lit(1)).alias("group_size"))


def frequent(found: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Verified winners of digests that more than one in ``counters + 1`` rows have: ``digest``,
    ``keep_id``, ``best`` and ``group_size``; at most ``counters`` rows."""
    rows = found.count()
    spark = found.sparkSession
    keys = spark.createDataFrame(
        pa.table({"key": pa.array(candidates(found, counters), pa.int64())}))
    exact = _best(found.join(F.broadcast(keys), "key"))
    return written(exact.where((F.col("group_size") > 1)
                               & (F.col("group_size") * (counters + 1) > rows)), "frequent")


def groups(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``digest`` of every row of ``docs``."""
    found = prints(docs)
    winners = frequent(found, counters)
    settled = found.join(F.broadcast(winners), "digest")
    rest = found.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    # Winners of all other digests grow with the documents: both sides are shuffled.
    shuffled = rest.join(_best(rest).hint("merge"), "digest")
    return settled.unionByName(shuffled).select(
        "doc_id", "keep_id", "group_size", (F.col("rank") == F.col("best")).alias("kept"), "digest")


def keep_one(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The row with the smallest ``doc_id`` of each group of equal texts, with all its columns."""
    winners = frequent(prints(docs), counters)
    packed = docs.select(F.struct(F.col("doc_id").cast("bigint").alias("id")).alias("own"),
                         F.struct("*").alias("row"), digest_of(F.col("text")).alias("digest"))
    marked = packed.join(F.broadcast(winners.select("digest", "keep_id")), "digest", "left")
    # Rows of frequent digests go where they lie, but for those with the winner's id.
    left = marked.where(F.col("digest").isNotNull() & (
        F.col("keep_id").isNull() | (F.col("own.id") == F.col("keep_id"))))
    place = W.partitionBy("digest").orderBy(F.col("own.id").asc_nulls_last())
    return left.withColumn("place", F.row_number().over(place)).where(
        F.col("place") == 1).select("row.*")
