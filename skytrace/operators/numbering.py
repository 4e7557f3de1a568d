"""Positions of rows in a global order, without gathering the rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skytrace.session import written


def numbered(df: DataFrame, order: Sequence[Column], name: str = "place",
             total: str | None = None) -> DataFrame:
    """Add the zero-based position of every row in ``order``, and optionally the number of rows.

    The rows are range-partitioned and sorted once and written; each partition counts its rows, and
    what comes before a partition is a sum over those counts. Only one small row per partition
    ever meets the others, so they are broadcast: their number is that of the partitions. Rows that
    ``order`` does not tell apart come in any order.
    """
    own, part = f"{name}__own", f"{name}__part"
    placed = written(df.orderBy(*order).withColumn(own, F.monotonically_increasing_id())
                     .withColumn(part, F.shiftright(own, 33)), "numbered")
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias(f"{name}__rows"))
    before = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    whole = W.orderBy(part).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    starts = sizes.select(
        part, F.coalesce(F.sum(f"{name}__rows").over(before), F.lit(0)).alias(f"{name}__start"),
        F.sum(f"{name}__rows").over(whole).alias(f"{name}__total"))
    at = F.col(f"{name}__start") + F.col(own).bitwiseAND(F.lit((1 << 33) - 1))
    added = {name: at} | ({total: F.col(f"{name}__total")} if total else {})
    return placed.join(F.broadcast(starts), part).withColumns(added).select(*df.columns, *added)
