"""Summaries that tasks make of their rows, merged in rounds of a bounded number at a time.

A task's summary has a size that does not depend on its rows. The summaries of ``FAN`` neighbouring
tasks meet in one task of the next round, so none receives more than ``FAN`` of them, and a hundred
thousand tasks need three rounds. An empty table has no summary, unless its tasks make one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN = 64


def merged(rows: DataFrame, summarise: Callable[[Iterable[pa.RecordBatch]], pa.RecordBatch | None],
           combine: Callable[[pa.Table], pa.Table], schema: str, fan: int = FAN) -> pa.Table:
    """One summary of all ``rows``, as a table.

    ``summarise`` makes a batch of the columns in ``schema`` from a task's batches, or None;
    ``combine`` makes one summary of several that lie in one table.
    """
    def summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = summarise(batches)
        if made is not None and made.num_rows:
            at = pa.array([TaskContext.get().partitionId()] * made.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([at, *made.columns], ["at", *made.schema.names])

    def combined(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        made = combine(table.drop_columns(["at", "next"]))
        at = pa.array([key[0].as_py()] * made.num_rows, pa.int64())
        return made.add_column(0, "at", at)

    tasks = rows.rdd.getNumPartitions()
    found = rows.mapInArrow(summaries, f"at bigint, {schema}")
    while tasks > 1:
        found = found.withColumn("next", F.floor(F.col("at") / fan)).groupBy("next").applyInArrow(
            combined, f"at bigint, {schema}")
        tasks = -(-tasks // fan)
    return found.drop("at").toArrow()
