"""The sliced arrangement must give exactly what one window per series gives."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skytrace.operators import metadata, phases, polyfit, trim
from skytrace.operators.layout import WHOLE, Sliced, balanced, oversized_keys
from skytrace.plans import flight as plan
from skytrace.plans import queries
from skytrace.sources import events as source


def rows(df):
    names = sorted(df.columns)
    return sorted(tuple(str(r[c]) for c in names) for r in df.select(*names).collect())


@pytest.fixture(scope="module")
def series(spark):
    """Three keys, uneven gaps, nulls, and slices with a single row."""
    data = [(k, i, 1000 * (i * i + 7 * (i % 5)), None if i % 11 == 3 else ((i * 37) % 101) / 4.0)
            for k in ("a", "b", "c") for i in range({"a": 40, "b": 1, "c": 13}[k])]
    return spark.createDataFrame(data, "k string, i long, ms long, v double")


@pytest.mark.parametrize("slice_ms", [1, 20_000, 300_000, 10**12])
def test_primitives_agree(series, slice_ms):
    def run(layout):
        df = layout.place(series, ["k"], F.col("ms"))
        order = ["ms", "i"]
        amount = (F.coalesce("v", F.lit(0.0)) * 4).cast("bigint")
        df = layout.scan(
            df, ["k"], order, lag={"prev_v": "v", "prev_i": "i"}, index="at", size="n",
            totals={"low": ("min", F.struct("v", "i")), "high": ("max", F.col("v")),
                    "known": ("sum", F.when(F.col("v").isNotNull(), 1))},
            ahead=(amount, {"next_3": 3, "next_10": 10}),
            running={"so_far": (F.col("v") * 4).cast("bigint")})
        # A scan may replace columns of an earlier one.
        return layout.scan(df, ["k"], order, index="at", lag={"before": "at"}).drop("slice_no")

    assert rows(run(Sliced(slice_ms))) == rows(run(WHOLE))


@pytest.mark.parametrize("slice_rows", [2, 10**6])
@pytest.mark.parametrize("slice_ms", [1, 300_000])
def test_null_keys_null_times_and_equal_times(spark, slice_ms, slice_rows):
    data = [(None if i % 4 == 0 else "a" if i % 4 < 3 else "b", i,
             None if i % 7 == 0 else "2024-01-01 10:%02d:00" % (0 if i % 3 else i % 10), i % 5 / 4.0)
            for i in range(90)]
    frame = spark.createDataFrame(data, "k string, i long, t string, v double").withColumn(
        "ts", F.col("t").cast("timestamp_ntz"))

    def run(df, layout):
        millis = F.unix_millis(F.col("ts").cast("timestamp"))
        df = layout.place(df, ["k"], millis, ("ts", F.col("i")))
        return layout.scan(
            df, ["k"], ["ts", "i"], lag={"prev": "i"}, index="at", size="n",
            totals={"low": ("min", F.col("v"))}, ahead=(F.col("v"), {"next_4": 4}),
            running={"so_far": (F.col("v") * 4).cast("bigint")}).drop("slice_no")

    whole = rows(run(frame, WHOLE))
    assert len(whole) == 90
    assert rows(run(frame, Sliced(slice_ms, slice_rows))) == whole
    split = balanced(frame, "k", lambda d, layout: run(
        d, Sliced(slice_ms, slice_rows) if layout.sliced else layout), 20, slice_ms)
    assert rows(split) == whole


@pytest.mark.parametrize("scale, n, extra", [
    (1e11, 300, None), (1e9, 20_000, None), (3e-9, 300, None), (1.0, 50, float("nan")),
    (1e300, 40, None), (0.25, 300, None)])
def test_sums_neither_abort_nor_vanish(spark, scale, n, extra):
    draw = np.random.default_rng(1)
    values = (scale * (1 + draw.integers(0, 100, n) / 64)).tolist()
    if extra is not None:
        values[20] = extra
    frame = spark.createDataFrame([(1, i, 1000 * i, v) for i, v in enumerate(values)],
                                  "k long, i long, ms long, v double")

    def run(layout):
        df = layout.place(frame, ["k"], F.col("ms"))
        df = phases.expanding_stats(df, layout, ["k"], ["ms", "i"], {"v": ("m", "s", "z", 8)},
                                    places=15 if scale < 1e-3 else 9 if scale < 1 else 6)
        df = trim.forward_averages(df, layout, ["k"], ["ms", "i"], "v", {"f": 10}, places=15)
        return sorted(df.select("i", "m", "s", "f").collect())

    expected = pd.Series(values).expanding()
    for layout in (WHOLE, Sliced(17_000)):
        got = run(layout)
        for i, m, s, f in got[:: max(1, n // 150)]:
            if np.isnan(values[:i + 1]).any():
                assert np.isnan(m) and np.isnan(s)
                continue
            if scale < 1e200:  # squares of greater values are infinite in any arithmetic of doubles
                assert s is None if i == 0 else s == pytest.approx(
                    expected.std()[i], rel=1e-6, abs=1e-6 * scale)
            assert m == pytest.approx(expected.mean()[i], rel=1e-9, abs=min(1e-6, 1e-6 * scale))
            if i + 10 <= n and scale < 1e200 and not np.isnan(values[i:i + 10]).any():
                assert f == pytest.approx(np.mean(values[i:i + 10]), rel=1e-6)


@pytest.fixture(scope="module")
def extracted(events):
    some = events.where("user_id < 5")
    return plan.extract_packets(source.packets(some), source.flights(some)).cache()


@pytest.mark.parametrize("slice_ms", [180_000, 2_400_000])
def test_tracked_rows_agree(extracted, slice_ms):
    whole = plan.tracked_rows(extracted)
    sliced = plan.tracked_rows(extracted, Sliced(slice_ms)).drop("slice_no")
    assert rows(sliced) == rows(whole)


def test_fits_agree(extracted):
    tracked = plan.tracked_rows(extracted).cache()
    layouts = (WHOLE, Sliced(600_000))
    whole, sliced = (
        sorted(polyfit.with_curves(tracked, plan.fitted(tracked, layout)).select(
            "flight", "row_no", "velocity_curvefit_fts", "velocity_curvefit_ms").collect())
        for layout in layouts)
    assert len(whole) == len(sliced) > 0
    for a, b in zip(whole, sliced):
        assert a[:2] == b[:2]
        for x, y in zip(a[2:], b[2:]):
            assert (x is None) == (y is None)
            assert x is None or abs(x - y) < 1e-5


def test_adapter_agrees(events):
    some = events.where("user_id < 4")
    assert rows(source.packets(some, Sliced(86_400_000))) == rows(source.packets(some))


def test_split_by_size(events):
    some = events.where("user_id < 4")
    sizes = dict(some.groupBy("user_id").count().collect())
    limit = sorted(sizes.values())[1]
    heavy = {r.user_id for r in oversized_keys(some, "user_id", limit).collect()}
    assert heavy == {u for u, n in sizes.items() if n > limit} and heavy
    assert oversized_keys(some, "user_id", 10**6) is None

    def averages(df, layout):
        placed = layout.place(df, ["user_id"], F.unix_millis(F.col("ts").cast("timestamp")))
        return trim.forward_averages(placed, layout, ["user_id"], ["ts", "event_id"], "value",
                                     {"m": 10}).select("event_id", "m")

    assert rows(balanced(some, "user_id", averages, limit, 10**8)) == rows(averages(some, WHOLE))


def test_status_agrees(events):
    def run(series_rows, slice_ms):
        return rows(balanced(events, "user_id", queries.flight_status, series_rows, slice_ms))

    assert run(70, 3_600_000) == run(10**6, 3_600_000)


def test_process_agrees(events):
    some = events.where("user_id < 3")
    packets, flights = source.packets(some), source.flights(some)
    whole = plan.process(packets, flights)
    split = plan.process(packets, flights, series_rows=60, slice_ms=900_000)
    assert rows(split.metadata) == rows(whole.metadata)
    assert rows(split.status) == rows(whole.status)
    curves = [c for c in whole.packets.columns if "curvefit" in c]
    assert rows(split.packets.drop(*curves)) == rows(whole.packets.drop(*curves))
    assert metadata.outcome_counts(whole.status).count() >= 1
