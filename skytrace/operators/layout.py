"""Ordered computations on series that may be far larger than one task can hold.

A series is the rows of one key (a flight, a beacon of a flight, a phase) in time order. The
operators need five things from it: the previous row, the position, totals of the whole series,
sums over the next rows and running sums. ``scan`` adds any of these in one pass. There are two
arrangements.

* ``Layout`` (``WHOLE``): one window per series. Right for series of a bounded size, and the
  cheapest plan: all scans run on one shuffle by key, each as a single window operator.
* ``Sliced``: a series is cut into time slices, each a partition of its own. Every slice is
  reduced to one summary row, a window over the (few) summaries finds what enters the slice from
  outside, and that is joined back by ``(key, slice)``. No task ever holds a whole series.

``balanced`` counts rows per key first and sends only the oversized keys through ``Sliced``.
Null keys are keys like others and rows without a time form the first slice, as windows have it. A
slice that still has too many rows (equal times) is cut again by time and by the ordering key behind
it. Sums of whole numbers and decimals are exact, so both arrangements give identical results; sums
of doubles ahead add few numbers in row order.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skytrace.session import stage

SLICE = "slice_no"
DEFAULT_SERIES_ROWS = 500_000
DEFAULT_SLICE_MS = 60_000
# Rows of one slice before it is cut again, and keys that may be broadcast.
DEFAULT_SLICE_ROWS = 200_000
BROADCAST_KEYS = 100_000
# Stands for no time: before every slice, as nulls sort first.
NO_TIME = -(1 << 62)

_AGGREGATES = {"min": F.min, "max": F.max, "sum": F.sum}


class Layout:
    """One window per series."""

    sliced = False

    def place(self, df: DataFrame, keys: Sequence[str], time_ms: Column | None = None,
              tie: tuple[str, Column] | None = None) -> DataFrame:
        """Partition the rows once; all later scans of the series reuse this partitioning.

        ``tie`` is for series in which many rows may have the same time: the exact ordering time
        (a column name) and the number that orders rows of equal times.
        """
        return df.repartition(*keys)

    def scan(
        self,
        df: DataFrame,
        part: Sequence[str],
        order: Sequence[str],
        *,
        lag: Mapping[str, str] | None = None,
        index: str | None = None,
        size: str | None = None,
        totals: Mapping[str, tuple[str, Column]] | None = None,
        ahead: tuple[Column, Mapping[str, int]] | None = None,
        running: Mapping[str, Column] | None = None,
    ) -> DataFrame:
        """Add columns taken from the series a row belongs to.

        ``lag`` maps a new column to the one whose value in the previous row it gets. ``index`` is
        the zero-based position, ``size`` the number of rows. ``totals`` are min, max or sum of an
        expression over the series. ``ahead`` sums a value over a row and its ``k - 1`` successors,
        null if there are fewer, as doubles. ``running`` sums up to and including the row; a decimal
        sum that does not fit is null.
        """
        series = W.partitionBy(*part).orderBy(*order)
        everything = series.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        so_far = series.rowsBetween(W.unboundedPreceding, 0)
        added = {new: F.lag(source).over(series) for new, source in (lag or {}).items()}
        if index:
            added[index] = (F.row_number().over(series) - 1).cast("bigint")
        if size:
            added[size] = F.count(F.lit(1)).over(everything)
        for name, (how, value) in (totals or {}).items():
            added[name] = _AGGREGATES[how](value).over(everything)
        if ahead:
            value, sizes = ahead
            amount = value.cast("double")
            for name, k in sizes.items():
                frame = series.rowsBetween(0, k - 1)
                added[name] = F.when(F.count(F.lit(1)).over(frame) == k, F.sum(amount).over(frame))
        for name, value in (running or {}).items():
            added[name] = F.try_sum(value).over(so_far)
        return df.withColumns(added)


class Sliced(Layout):
    """One window per time slice, plus carries between slices."""

    sliced = True

    def __init__(self, slice_ms: int = DEFAULT_SLICE_MS, slice_rows: int = DEFAULT_SLICE_ROWS):
        self.slice_ms, self.slice_rows = slice_ms, slice_rows

    def place(self, df, keys, time_ms=None, tie=None):
        time = F.floor(time_ms / F.lit(self.slice_ms)).cast("bigint")
        time = F.coalesce(time, F.lit(NO_TIME))
        none = F.lit(0).cast("bigint")
        if tie is not None:
            exact, order = tie
            crowded = (df.groupBy(*[F.col(k).alias(f"h_{k}") for k in keys], time.alias("h_time"))
                       .agg(F.count(F.lit(1)).alias("h_rows"), F.min(order).alias("h_low"),
                            F.max(order).alias("h_high"))
                       .where(F.col("h_rows") > self.slice_rows))
            if not crowded.isEmpty():
                same = (time == F.col("h_time"))
                for k in keys:
                    same = same & F.col(k).eqNullSafe(F.col(f"h_{k}"))
                crowded = stage(crowded)
                df = df.join(hinted(crowded), same, "left")
                hot = F.col("h_rows").isNotNull()
                # Equal steps of the ordering number; it needs no more than to ascend.
                width = (F.col("h_high") - F.col("h_low") + 1) * self.slice_rows / F.col("h_rows")
                step = F.floor((order - F.col("h_low")) / width).cast("bigint")
                micros = F.coalesce(F.unix_micros(F.col(exact).cast("timestamp")), F.lit(NO_TIME))
                return df.withColumn(SLICE, F.struct(
                    time.alias("time"), F.when(hot, micros).otherwise(none).alias("exact"),
                    F.when(hot, F.coalesce(step, none)).otherwise(none).alias("step"),
                )).drop("h_time", "h_rows", "h_low", "h_high", *[f"h_{k}" for k in keys]
                        ).repartition(*keys, SLICE)
        df = df.withColumn(SLICE, F.struct(time.alias("time"), none.alias("exact"),
                                           none.alias("step")))
        return df.repartition(*keys, SLICE)

    def scan(self, df, part, order, *, lag=None, index=None, size=None, totals=None, ahead=None,
             running=None):
        lag, totals, running = lag or {}, totals or {}, running or {}
        value, sizes = ahead or (F.lit(None), {})
        value = value.cast("double")
        widest = max(sizes.values(), default=1)

        inside = W.partitionBy(*part, SLICE).orderBy(*order)
        series = W.partitionBy(*part)
        slices = series.orderBy(SLICE)
        earlier = slices.rowsBetween(W.unboundedPreceding, -1)
        # Every slice has a row, so the next ``widest - 1`` slices always suffice.
        later = slices.rowsBetween(1, max(widest - 1, 1))

        # The rows are read twice, by the summaries and by the join: cut the lineage first.
        rows = stage(df.withColumns({"s_value": value, "s_row": F.row_number().over(inside)}))
        head = F.collect_list(F.when(F.col("s_row") < widest, F.struct("s_row", "s_value")))
        summaries = rows.groupBy(*part, SLICE).agg(
            F.count(F.lit(1)).alias("s_rows"),
            F.transform(F.sort_array(head), lambda r: r.s_value).alias("s_head"),
            F.max_by(F.struct(F.lit(0), *sorted(set(lag.values()))),
                     F.struct(*order)).alias("s_last"),
            *[_AGGREGATES[how](v).alias(f"t_{name}") for name, (how, v) in totals.items()],
            *[F.try_sum(v).alias(f"r_{name}") for name, v in running.items()],
        )
        carried = summaries.select(
            *part, SLICE,
            F.coalesce(F.sum("s_rows").over(earlier), F.lit(0)).alias("s_before"),
            F.sum("s_rows").over(series).alias("s_size"),
            F.flatten(F.collect_list("s_head").over(later)).alias("s_ahead"),
            F.lag("s_last").over(slices).alias("s_prev"),
            *[_AGGREGATES[how](f"t_{name}").over(series).alias(f"t_{name}")
              for name, (how, _) in totals.items()],
            *[F.try_sum(f"r_{name}").over(earlier).alias(f"r_{name}") for name in running],
        )
        added = {
            new: F.when(F.col("s_row") == 1, F.col("s_prev").getField(source)).otherwise(
                F.lag(source).over(inside))
            for new, source in lag.items()
        }
        if index:
            added[index] = (F.col("s_row") - 1 + F.col("s_before")).cast("bigint")
        if size:
            added[size] = F.col("s_size")
        for name in totals:
            added[name] = F.col(f"t_{name}")
        for name, k in sizes.items():
            frame = inside.rowsBetween(0, k - 1)
            missing = (F.lit(k) - F.count(F.lit(1)).over(frame)).cast("int")
            outside = F.aggregate(
                F.slice("s_ahead", F.lit(1), missing), F.lit(0.0),
                lambda a, x: a + F.coalesce(x, F.lit(0.0)))
            added[name] = F.when(
                F.size("s_ahead") >= missing,
                F.coalesce(F.sum("s_value").over(frame), F.lit(0.0)) + outside)
        for name, v in running.items():
            local = F.try_sum(v).over(inside.rowsBetween(W.unboundedPreceding, 0))
            before = F.col(f"r_{name}")
            added[name] = F.when(
                local.isNotNull() | before.isNotNull(),
                F.try_add(F.coalesce(local, F.lit(0)), F.coalesce(before, F.lit(0))))
        own = [*part, SLICE]
        for k in own:
            carried = carried.withColumnRenamed(k, f"s_{k}")
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"s_{k}")) for k in own])
        joined = rows.join(carried, same).withColumns(added)
        return joined.select(*[c for c in df.columns if c not in added], *added)


WHOLE = Layout()


def hinted(df: DataFrame, rows: int = BROADCAST_KEYS) -> DataFrame:
    """``df``, to be broadcast if it has been counted to be small."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def oversized_keys(df: DataFrame, key: str, series_rows: int) -> DataFrame | None:
    """Keys with more than ``series_rows`` rows, or None."""
    heavy = df.groupBy(key).count().where(F.col("count") > series_rows).select(key)
    return None if heavy.isEmpty() else stage(heavy)


def spread(
    df: DataFrame,
    key: str,
    heavy: DataFrame | None,
    run: Callable[[DataFrame, Layout], DataFrame],
    slice_ms: int = DEFAULT_SLICE_MS,
) -> DataFrame:
    """Run ``run`` with one window per series, and time-sliced for the keys in ``heavy``."""
    if heavy is None:
        return run(df, WHOLE)
    keys = hinted(heavy.withColumnRenamed(key, "h_key"))
    same = F.col(key).eqNullSafe(F.col("h_key"))
    usual = df.join(keys, same, "left_anti")
    large = df.join(keys, same, "left_semi")
    return run(usual, WHOLE).unionByName(run(large, Sliced(slice_ms)).drop(SLICE))


def balanced(
    df: DataFrame,
    key: str,
    run: Callable[[DataFrame, Layout], DataFrame],
    series_rows: int = DEFAULT_SERIES_ROWS,
    slice_ms: int = DEFAULT_SLICE_MS,
) -> DataFrame:
    """``spread`` after looking for oversized keys."""
    return spread(df, key, oversized_keys(df, key, series_rows), run, slice_ms)
