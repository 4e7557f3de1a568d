"""Trimming, phases, regimes, fits and features on hand-made flights."""

import datetime as dt
import decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from skytrace.operators import (
    columns, extract, features, kinematics, metadata, phases, polyfit, regimes, trim,
)
from skytrace.operators.layout import WHOLE, Sliced

START = dt.datetime(2024, 1, 1, 13, 0)


def frame(spark, rows, **defaults):
    """Rows of dicts with ``t`` seconds; callsign, flight and packettime are filled in."""
    full = [{"flight": "F", "callsign": "A", **defaults, **r} for r in rows]
    names = [k for k in full[0] if k != "t"]
    kinds = {"flight": "string", "callsign": "string", "ascending": "boolean", "fate": "string",
             "flight_phase": "string", "info": "string", "reynolds_transition": "string",
             "row_no": "bigint", "flight_rows": "bigint", "ascent_rows": "bigint",
             "phase_row": "bigint", "phase_rows": "bigint", "last_row": "bigint"}
    schema = ", ".join(f"{n} {kinds.get(n, 'double')}" for n in names) + ", packettime timestamp_ntz"
    return spark.createDataFrame(
        [tuple(r[n] for n in names) + (START + dt.timedelta(seconds=r["t"]),) for r in full],
        schema)


def values(df, *names):
    return [tuple(r) for r in df.orderBy("flight", "packettime", "callsign").select(*names).collect()]


def positions(spark, rows):
    return frame(spark, rows, latitude=39.0, longitude=-104.0, altitude_m=0.0)


def test_position_packets(spark):
    rows = [{"t": 0, "altitude_ft": a, "latitude": la, "longitude": 0.0} for a, la in
            [(1.0, 0.0), (0.0, 1.0), (None, 1.0), (1.0, None), (-1.0, 1.0)]]
    df = frame(spark, rows)
    assert sorted(kinematics.flag_positions(df).select("position_packet").collect()) == [
        (False,), (False,), (False,), (False,), (True,)]
    # A position of 0, 0 is a position.
    assert kinematics.position_rows(df).count() == 1


def test_one_beacon_with_most_packets(spark):
    """A list too long to broadcast, 90 % of the packets from one beacon and day, no adaptive plan."""
    start = "timestamp '2024-03-01 18:00:00'"
    packets = spark.range(4000).selectExpr(
        f"{start} + make_interval(0, 0, 0, 0, 0, 0, id) as tm",
        "if(id % 10 < 9, 'HOT', concat('B', id % 50)) as callsign", "concat('p', id) as raw",
        "0.0 as bearing", "0.0 as speed_mph", "100 as altitude", "1.0 as latitude",
        "2.0 as longitude")
    rows = [("F1", ["HOT", "B9"], "2024-03-01"), ("F2", ["HOT"], "2024-03-01"),
            ("F3", ["B19"], "2024-03-01"), ("F4", ["HOT"], "2024-03-02")]
    flights = spark.createDataFrame(rows, "flight string, beacons array<string>, day string")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        dealt = extract.match_packets(packets, flights, broadcast_rows=0, salt_rows=200)
        sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
        found = sorted(dealt.select("flight", "raw").collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    expected = sorted(extract.match_packets(packets, flights).select("flight", "raw").collect())
    assert found == expected and len(found) > 7000
    # Two flights share the beacon: a task joins a few salts of some 200 packets each.
    assert max(sizes) < len(found) / 4


def test_lone_beacons_and_time_order(spark):
    df = positions(spark, [
        {"t": 0, "altitude_ft": 10.0}, {"t": 10, "altitude_ft": 20.0},
        {"t": 5, "altitude_ft": 99.0, "callsign": "B"},
        {"t": 0, "altitude_ft": 30.0, "callsign": "C"},
        {"t": 4, "altitude_ft": 10.0, "callsign": "C"},
    ])
    out = kinematics.beacon_deltas(df)
    assert values(out, "callsign", "timedelta_s", "velocity_z_fts", "vert_rate_ftmin") == [
        ("A", None, None, None), ("C", None, None, None), ("C", 4.0, -5.0, -300.0),
        ("A", 10.0, 1.0, 60.0)]


def test_first_highest_row_is_the_apex(spark):
    df = positions(spark, [{"t": i, "altitude_ft": a, "altitude_m": float(i)}
                           for i, a in enumerate([1.0, 9.0, 9.0, 3.0])])
    assert values(trim.apex(df), "row_no", "apex_ft", "apex_m", "ascending") == [
        (0, 9.0, 1.0, True), (1, 9.0, 1.0, True), (2, 9.0, 1.0, False), (3, 9.0, 1.0, False)]


def test_straggler_stays_and_the_rest_goes(spark):
    rows = [{"t": i, "row_no": i, "timedelta_s": td, "altitude_ft": a, "ascending": i < 2}
            for i, (td, a) in enumerate([(900.0, 100.0), (900.0, 9000.0), (501.0, 8000.0),
                                         (500.0, 7000.0), (501.0, 7999.0), (1.0, 5000.0)])]
    out = trim.cut_stragglers(frame(spark, rows, fate="kept"))
    assert [r[0] for r in values(out, "row_no")] == [0, 1, 2, 3, 4]


def test_outlier_bounds_are_strict(spark):
    speeds = [(-5.0, True), (-4.9, True), (50.0, True), (49.9, True), (None, True), (5.0, False),
              (4.9, False), (-500.0, False), (None, False)]
    df = frame(spark, [{"t": i, "velocity_z_fts": v, "ascending": up}
                       for i, (v, up) in enumerate(speeds)], fate="kept")
    assert [r[0] for r in values(trim.eject_outliers(df), "velocity_z_fts")] == [
        -4.9, 49.9, None, 4.9, -500.0, None]


def bounds(spark, rows, n):
    df = frame(spark, [{"t": i, "row_no": i, "flight_rows": n, **r} for i, r in enumerate(rows)],
               fate="kept")
    return trim.launch_and_landing(df)


RISE = {"velocity_z_fts": 10.0, "forward_avg": 10.0, "long_forward_avg": 10.0, "ascending": True,
        "altitude_ft": 6000.0}
IDLE = {**RISE, "velocity_z_fts": 0.0}
FALL = {"velocity_z_fts": -30.0, "forward_avg": -30.0, "long_forward_avg": -30.0,
        "ascending": False, "altitude_ft": 6000.0}
DOWN = {**FALL, "velocity_z_fts": 0.0, "forward_avg": None, "long_forward_avg": None}


@pytest.mark.parametrize("rows, kept", [
    # launch in row 3: it starts one row earlier; landing in row 5: kept up to that row
    ([IDLE, IDLE, IDLE, RISE, FALL, DOWN, DOWN, DOWN], [2, 3, 4, 5]),
    # no landing, but a launch to cut: the last row goes too
    ([IDLE, IDLE, IDLE, RISE, FALL, FALL], [2, 3, 4]),
    # landing in the last row with a launch to cut: that row goes
    ([IDLE, IDLE, IDLE, RISE, FALL, DOWN], [2, 3, 4]),
    # nothing to cut at either end
    ([RISE, RISE, FALL, FALL], [0, 1, 2, 3]),
    ([RISE, RISE, FALL, DOWN], [0, 1, 2, 3]),
])
def test_trim(spark, rows, kept):
    out = trim.trim(bounds(spark, rows, len(rows)))
    shifted = values(out, "packettime", "row_no", "flight_rows")
    assert [int((t - START).total_seconds()) for t, _, _ in shifted] == kept
    assert [(r, n) for _, r, n in shifted] == [(i, len(kept)) for i in range(len(kept))]


def test_forward_means(spark):
    rows = [{"t": i, "v": v} for i, v in enumerate([1.0, None, 3.5, 4.0])]
    out = trim.forward_averages(frame(spark, rows), WHOLE, ["flight"], ["packettime"], "v",
                                {"three": 3})
    assert [r[0] for r in values(out, "three")] == [1.5, 2.5, None, None]


def climb(spark, altitudes, descent=(), **more):
    """Trimmed rows 60 s apart, first climbing through ``altitudes``."""
    everything = [*altitudes, *descent]
    rows = [{"t": 60 * i, "row_no": i, "flight_rows": len(everything), "altitude_ft": float(a),
             "altitude_m": round(a * 0.3048, 2), "timedelta_s": 60.0, "latitude": 39.0 + i / 100,
             "longitude": -104.0, "apex_ft": float(max(everything)), "apex_m": 1.0,
             "velocity_z_fts": None if i == 0 else (a - everything[i - 1]) / 60.0,
             "velocity_z_ms": None if i == 0 else round((a - everything[i - 1]) / 200.0, 8)}
            for i, a in enumerate(everything)]
    return frame(spark, rows, fate="kept", **more)


def test_short_phases_have_no_statistics(spark):
    df = phases.split_phases(climb(spark, [1000, 2000, 3000], [500, 400]))
    out = phases.phase_expanding_stats(phases.phase_motion(phases.usable_flights(df)))
    assert values(out, "flight_phase", "elapsed_secs", "acceleration_fts2", "velocity_mean_fts") == [
        ("ascending", 0.0, None, None), ("ascending", 60.0, None, 16.666667),
        ("ascending", 120.0, 0.0, 16.666667), ("descending", None, None, None),
        ("descending", None, None, None)]
    assert phases.usable_flights(phases.split_phases(climb(spark, [1000, 2000], [500]))).count() == 0


@pytest.mark.parametrize("altitudes, labels", [
    # never above 10,000 ft
    ([1000, 2500, 5200, 9000], ["n/a"] * 4),
    # a line: nothing is clear of it
    ([10000, 20000, 30000, 40000], ["n/a"] * 4),
    # below the line in the middle: low before the turning point, high from there
    ([0, 11000, 12000, 60000], ["low Re", "low Re", "high Re", "high Re"]),
    # above the line in the middle
    ([0, 40000, 41000, 60000], ["high Re", "low Re", "low Re", "low Re"]),
    # first above, then below
    ([0, 30000, 31000, 32000, 60000], ["high Re", "low Re", "low Re", "high Re", "high Re"]),
])
def test_regimes(spark, altitudes, labels):
    df = phases.usable_flights(phases.split_phases(climb(spark, altitudes, [500, 400, 300])))
    out = regimes.regimes(phases.phase_line(df))
    assert [r[0] for r in values(out, "airflow")] == labels + ["n/a"] * 3
    changes = [f"{a.split()[0]}_to_{b.split()[0]}" for a, b in zip(labels, labels[1:]) if a != b]
    listed = regimes.transition_lists(out).first().reynolds_transitions
    assert [t.transition for t in listed] == changes
    assert regimes.transition_rows(out).count() == len(changes)


def test_fit_matches_direct_least_squares(spark):
    rng = np.random.default_rng(7)
    altitudes = np.round(np.linspace(5000, 95000, 80) + rng.normal(0, 50, 80), 1)
    speeds = np.round(15 + 3 * np.sin(altitudes / 9000) + rng.normal(0, 0.3, 80), 8)
    rows = [{"t": i, "altitude_ft": float(a), "velocity_z_fts": float(v), "altitude_m": float(a),
             "velocity_z_ms": float(v) if i else None, "row_no": i}
            for i, (a, v) in enumerate(zip(altitudes, speeds))]
    df = frame(spark, rows, flight_phase="ascending")
    fitted = polyfit.fits(df)
    out = values(polyfit.with_curves(df, fitted), "velocity_curvefit_fts", "velocity_curvefit_ms")
    vmr = speeds.var(ddof=1) / speeds.mean()
    assert fitted.first().fts_fit_degree == (13 if vmr < 1 else None)
    expected = np.polynomial.Polynomial.fit(altitudes, speeds, 13)(altitudes)
    assert np.allclose([r[0] for r in out], expected, atol=2e-6)
    # one unknown velocity: no fit for the phase
    assert all(r[1] is None for r in out)


def test_fit_of_few_or_equal_altitudes(spark):
    rows = [{"t": i, "flight": f, "altitude_ft": a, "velocity_z_fts": v, "altitude_m": a,
             "velocity_z_ms": v}
            for f, points in {"few": [(1.0, 1.0), (2.0, 4.0), (3.0, 9.0)],
                              "flat": [(5.0, 1.0), (5.0, 2.0), (5.0, 3.0)],
                              "two": [(1.0, 1.0), (2.0, 2.0)]}.items()
            for i, (a, v) in enumerate(points)]
    df = frame(spark, rows, flight_phase="descending")
    out = values(polyfit.with_curves(df, polyfit.fits(df)), "flight", "velocity_curvefit_fts")
    assert out == [("few", 1.0), ("few", 4.0), ("few", 9.0), ("flat", 2.0), ("flat", 2.0),
                   ("flat", 2.0), ("two", None), ("two", None)]


@pytest.mark.parametrize("spread", ["even", "crowded", "random", "repeated"])
@pytest.mark.parametrize("layout", [WHOLE, Sliced(3000)], ids=["whole", "sliced"])
def test_fits_against_exact_arithmetic(spark, layout, spread):
    draw = np.random.default_rng(11)
    sizes = {"F14": 14, "F15": 15, "F40": 40, "F200": 200}
    points = {}
    for flight, n in sizes.items():
        x = {"even": np.linspace(0, 1, n), "crowded": np.exp(-np.linspace(0, 3, n)),
             "random": draw.uniform(0, 1, n),
             "repeated": draw.integers(0, 9, n) / 8}[spread] * 1e5
        points[flight] = x, np.round(draw.normal(20, 4, n), 8)
    rows = [{"t": i, "flight": f, "altitude_ft": float(a), "velocity_z_fts": float(v),
             "altitude_m": float(a), "velocity_z_ms": float(v)}
            for f, (xs, ys) in points.items() for i, (a, v) in enumerate(zip(xs, ys))]
    df = frame(spark, rows, flight_phase="descending").cache()
    fitted = polyfit.fits(layout.place(df, ["flight"], F.unix_millis(
        F.col("packettime").cast("timestamp"))), layout)
    found = {}
    for r in polyfit.with_curves(df, fitted).orderBy("flight", "packettime").collect():
        found.setdefault(r.flight, []).append(r.velocity_curvefit_fts)
    degrees = {r.flight: r.fts_fit_degree for r in fitted.collect()}
    for flight, (xs, ys) in points.items():
        expected = exact_fit(xs, ys, degrees[flight])
        assert np.abs(np.array(found[flight]) - expected).max() < 5.1e-7


def exact_fit(xs, ys, degree):
    """Fitted values in 60-digit arithmetic, by orthogonalisation of powers."""
    with decimal.localcontext() as context:
        context.prec = 60
        low, high = (decimal.Decimal(float(v)) for v in (min(xs), max(xs)))
        u = [(2 * decimal.Decimal(float(x)) - low - high) / (high - low) for x in xs]
        rest, out, basis = [decimal.Decimal(float(y)) for y in ys], [decimal.Decimal(0)] * len(u), []
        for k in range(degree + 1):
            p = [v ** k if k else decimal.Decimal(1) for v in u]
            for q, size in basis:
                share = sum(a * b for a, b in zip(p, q)) / size
                p = [a - share * b for a, b in zip(p, q)]
            size = sum(a * a for a in p)
            if size > decimal.Decimal("1e-40"):
                basis.append((p, size))
                share = sum(a * b for a, b in zip(rest, p)) / size
                out = [o + share * a for o, a in zip(out, p)]
        return np.array([float(o) for o in out])


def test_fits_use_neither_python_nor_arrays_of_points(spark):
    rows = [{"t": i, "altitude_ft": 100.0 * i, "velocity_z_fts": 1.0 + i % 3, "altitude_m": 30.0 * i,
             "velocity_z_ms": 0.3} for i in range(20)]
    text = polyfit.fits(frame(spark, rows, flight_phase="ascending"))._jdf.queryExecution().toString()
    assert "ArrowEval" not in text and "BatchEvalPython" not in text and "collect_list" not in text


def mapped(spark, altitudes, descent):
    return phases.split_phases(climb(spark, altitudes, descent, reynolds_transition=""))


def test_waypoints(spark):
    up = [9000, 9990, 10010, 40500]
    out = features.waypoints(mapped(spark, up, [40100, 20000, 5000]))
    got = {(r.flight_phase, r.target_ft): r.row_no for r in out.collect()}
    # equal distance: the earlier row; one row may be nearest to several targets
    assert got == {
        ("ascending", 10000): 1, ("ascending", 20000): 2, ("ascending", 30000): 3,
        ("ascending", 40000): 3,
        ("descending", 10000): 6, ("descending", 20000): 5, ("descending", 30000): 5,
        ("descending", 40000): 4,
    }
    assert features.waypoints(mapped(spark, [10001, 10002, 10003], [9, 8, 7])).count() == 0


def test_waypoints_against_brute_force(spark):
    rng = np.random.default_rng(3)
    up = sorted(rng.integers(1, 120_000, 40).tolist())
    down = sorted(rng.integers(1, 110_000, 25).tolist(), reverse=True)
    got = {(r.flight_phase, r.target_ft): r.row_no
           for r in features.waypoints(mapped(spark, up, down)).collect()}
    expected, base = {}, {"ascending": (0, up), "descending": (len(up), down)}
    for phase, (start, rows) in base.items():
        for target in range(-(-min(rows) // 10_000) * 10_000, max(rows), 10_000):
            best = min(range(len(rows)), key=lambda i: (abs(rows[i] - target), i))
            expected[phase, target] = start + best
    assert got == expected


def test_paths_and_points(spark):
    df = mapped(spark, [1000, 2000, 3000.5], [500, 400, 300])
    vertices = features.path_vertices(df).orderBy("flight_phase", "vertex").collect()
    assert [(v.flight_phase, v.vertex, v.altitude_m) for v in vertices] == [
        ("ascending", 0, 304.8), ("ascending", 1, 609.6), ("ascending", 2, 914.55),
        ("descending", 0, 914.55), ("descending", 1, 152.4), ("descending", 2, 121.92),
        ("descending", 3, 91.44)]
    whole = {r.flight_phase: r for r in features.paths(df).collect()}
    assert whole["ascending"].coordinates == "-104,39,304.8 -104,39.01,609.6 -104,39.02,914.55"
    # parts share the vertex at which they meet
    parts = features.paths(df, part_vertices=2).where("flight_phase = 'descending'")
    assert [(p.part, p.vertices) for p in parts.orderBy("part").collect()] == [(0, 3), (1, 2)]
    points = features.points_of_interest(df).orderBy("row_no").collect()
    assert [(p.kind, p.name) for p in points] == [
        ("launch", "Launch"), ("burst", "Burst 3000ft"), ("landing", "Landing")]
    # without a descent there are no features
    assert features.path_vertices(mapped(spark, [1000, 2000, 3000], [])).count() == 0


def test_plain_numbers(spark):
    given = [-104.0, 39.608200000000004, 0.00005, 12345678.5, 0.0, -0.25]
    df = spark.createDataFrame([(v,) for v in given], "v double")
    assert [r[0] for r in df.select(features.plain_number(F.col("v"))).collect()] == [
        "-104", "39.608200000000004", "0.00005", "12345678.5", "0", "-0.25"]


def test_summary_takes_the_apex_before_trimming(spark):
    df = mapped(spark, [1000, 2000, 3000], [500, 400, 300]).withColumn("apex_ft", F.lit(9999.0))
    row = metadata.flight_summary(df).first()
    assert row.maxaltitude_ft == 9999.0 and row.numpoints == 6
    assert row.flighttime == "0hrs 5mins 0secs" and row.launch_location.altitude_ft == 1000.0
    assert row.landing_location.altitude_ft == 300.0


def test_reported_burst_of_zero_feet_counts(spark):
    df = spark.createDataFrame([(0,), (None,), (96668,)], "feet bigint")
    rows = [tuple(r[0]) for r in df.select(metadata.detected_burst(F.col("feet"))).collect()]
    assert rows == [(True, 0.0, 0.0), (False, 0.0, 0.0), (True, 96668.0, 29464.41)]


def test_columns(spark):
    df = spark.createDataFrame([(1, 2.0, "c")], "zz int, altitude_ft double, flightid string")
    assert columns.reorder(df).columns == ["flightid", "altitude_ft", "zz"]
    union = columns.diagonal_union([df, df.select("zz", F.lit("n").alias("new"))])
    assert union.columns == ["zz", "altitude_ft", "flightid", "new"]
    assert {tuple(r) for r in union.collect()} == {(1, 2.0, "c", None), (1, None, None, "n")}
    nested = spark.createDataFrame(
        [(1, (2, (3,)), [("x", 4)], {"k": 5.0})],
        "b int, s struct<y:int,x:struct<z:int>>, a array<struct<m:string,n:int>>, w map<string,double>")
    flat = columns.flatten(nested)
    assert flat.columns == ["a", "b", "s.x.z", "s.y", "w.k"]
    assert tuple(flat.first()) == ('[{"m":"x","n":4}]', 1, 3, 2, 5.0)
