"""Parsing, clocks, units and arithmetic on hand-made values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skytrace.functions import clock, numeric, units
from skytrace.operators import extract

UTC = dt.timezone.utc


def packet(raw, tm=dt.datetime(2024, 7, 1, 16, 0, tzinfo=UTC), **more):
    return {"tm": tm, "callsign": "A", "raw": raw, "bearing": 10.04, "speed_mph": 10.0,
            "altitude": 1000.0, "latitude": 39.0, "longitude": -104.0, **more}


SCHEMA = ("tm timestamp, callsign string, raw string, bearing double, speed_mph double, "
          "altitude double, latitude double, longitude double")


def parse(spark, rows, **options):
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    return extract.parse_packets(df, **options).collect()


def test_payload(spark):
    rows = parse(spark, [packet("no colon"), packet("A>B:x:y"), packet("A>B:")])
    assert [r.info for r in rows] == ["no colon", "x:y", ""]


def test_packet_time(spark):
    received = dt.datetime(2024, 7, 1, 10, 0)
    rows = parse(spark, [
        packet("A>B:/133015h"), packet("A>B:/250000h"), packet("A>B:/126000h"),
        packet("A>B:/120060h"), packet("A>B:plain"), packet("A>B:/235959h 010203h"),
        packet("A>B:/013000h", dt.datetime(2024, 7, 2, 1, 30, tzinfo=UTC)),
        packet("A>B:/070000h", dt.datetime(2024, 1, 1, 16, 0, 0, 123999, tzinfo=UTC)),
    ])
    assert [r.packettime for r in rows] == [
        dt.datetime(2024, 7, 1, 13, 30, 15), received, received, received, received,
        dt.datetime(2024, 7, 1, 23, 59, 59),
        dt.datetime(2024, 7, 1, 1, 30),  # the date is the local one and is not rolled over
        dt.datetime(2024, 1, 1, 7, 0),
    ]
    assert rows[7].receivetime == dt.datetime(2024, 1, 1, 9, 0, 0, 123000)


def test_temperature_and_pressure(spark):
    rows = parse(spark, [
        packet("A>B: 45T9000P"), packet("A>B: -456T-12P"), packet("KD0PRH-1>B: 45T9000P"),
        packet("A>B:45T9000P"), packet("A>B: 1234567T1P"),
    ])
    got = [(r.temperature_c, r.temperature_f, r.temperature_k, r.pressure_pa, r.pressure_atm)
           for r in rows]
    assert got == [
        (4.5, 40.1, 277.65, 90000.0, 0.89), (-45.6, -50.08, 227.55, 120.0, 0.0),
        (4.5, 40.1, 277.65, 0.0, 0.0), (None,) * 5, (None,) * 5,
    ]
    anchored = parse(spark, [packet("KD0PRH-1>B: 45T9000P")], anchored_pressure=True)
    assert anchored[0].pressure_pa == 90000.0


def test_units_of_a_packet(spark):
    row = parse(spark, [packet("x", altitude=1000.05, bearing=359.95, speed_mph=12.34)])[0]
    assert (row.bearing, row.speed_mph, row.speed_kph) == (360.0, 12.3, 19.9)
    assert (row.altitude_ft, row.altitude_m) == (1000.1, 304.82)


@pytest.mark.parametrize("raw, feet", [
    ("A>B:DETECTED BURST at 98765ft", 98765), ("A>B:detected x burst 12 FT", 12),
    ("A>B:Detected commanded release 5ft 9ft", 5), ("A>B:DETECTED BURST", None),
    ("A>B:DETECTED BURST at 0ft", 0), ("A>B:97000ft", None),
    ("A>B:DETECTED BURST 99999999999999999999ft", None),
])
def test_burst_report(spark, raw, feet):
    df = spark.createDataFrame([("f", raw)], "flight string, raw string")
    assert extract.burst_altitudes(df).first().burst_ft == feet


def test_rounding(spark):
    values = [0.125, -0.125, 2.675, 0.5, -0.0004, 1e-20, 0.49999999999999994, None, 12345.675]
    df = spark.createDataFrame([(v,) for v in values], "v double")

    def expected(v, places):
        if v is None:
            return None
        scaled = abs(v) * 10.0**places
        whole = int(scaled)
        whole += (scaled - whole) >= 0.5
        return (whole if v >= 0 else -whole) / 10.0**places + 0.0

    for places in (0, 2, 8):
        got = [r[0] for r in df.select(numeric.round_half_away(F.col("v"), places)).collect()]
        assert got == [expected(v, places) for v in values]
        assert all(str(g) != "-0.0" for g in got)


@pytest.mark.parametrize("vmr, degree", [
    (0.5, 13), (1.0, 13), (1.75, 7), (1.76, 8), (-3.0, 13), (100.0, 1), (float("nan"), 13),
    (None, 13),
])
def test_fit_degree(spark, vmr, degree):
    df = spark.createDataFrame([(vmr,)], "v double")
    assert df.select(numeric.fit_degree(F.col("v"))).first()[0] == degree


def test_variance_is_exact(spark):
    df = spark.createDataFrame([(3, "1e15"), (2, "5")], "n long, x string")
    total = F.col("x").cast("double").cast("decimal(38,0)")
    # n equal values: the variance is 0, not the noise of cancelling sums
    wide_n = F.col("n").cast("decimal(38,0)")
    rows = df.select(numeric.variance_from_sums(
        F.col("n"), (wide_n * total).cast("decimal(38,0)"),
        (wide_n * total * total).cast("decimal(38,0)"), 8)).collect()
    assert [r[0] for r in rows] == [0.0, 0.0]


def test_distances(spark):
    row = spark.range(1).select(
        numeric.haversine_miles(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)).alias("half"),
        numeric.line_distance(F.lit(0.0), F.lit(-1.0), F.lit(0.0), F.lit(0.0)).alias("below"),
        numeric.air_density_kgm3(F.lit(100.0), F.lit(0.0)).alias("none"),
    ).first()
    assert row.half == pytest.approx(3956 * 3.141592653589793)
    assert row.below == 1.0 and row.none is None


def test_clocks(spark):
    days = ["2024-3-9", "2024-03-10", "2024-11-2", "2024-11-03", "2025-11-2"]
    df = spark.createDataFrame([(d,) for d in days], "day string")
    date = clock.flight_date(F.col("day"))
    rows = df.select(clock.is_daylight_time(date).alias("dst"),
                     clock.local_instant(date, "03:00:00").cast("string").alias("at")).collect()
    assert [r.dst for r in rows] == [False, True, True, False, False]
    assert rows[0]["at"] == "2024-03-09 10:00:00" and rows[1]["at"] == "2024-03-10 09:00:00"
    texts = spark.range(1).select(
        clock.duration_text(F.lit(8370.0)).alias("a"), clock.duration_text(F.lit(59.9)).alias("b"),
    ).first()
    assert (texts.a, texts.b) == ("2hrs 19mins 30secs", "0hrs 0mins 59secs")


def test_weights(spark):
    df = spark.createDataFrame(
        [({"parachute": "1.81", "client": "x", "b": " 2", "c": "1d", "d": "1e1"},
          ("Dome", "12")), ({"client": "1"}, ("Dome", "?"))],
        "w map<string,string>, p struct<description:string,size:string>")
    rows = df.select(units.weight_pairs(F.col("w")).alias("w"),
                     units.parachute(F.col("p"), F.col("w")).alias("p")).collect()
    assert rows[0].w["parachute_kg"] == 0.82 and rows[0].w["client_lb"] == 0.0
    assert rows[0].w["b_lb"] == 0.0 and rows[0].w["c_lb"] == 0.0 and rows[0].w["d_lb"] == 10.0
    assert tuple(rows[0].p) == ("Dome", 12.0, 3.66, 1.81, 0.82)
    assert tuple(rows[1].p) == ("Dome", 0.0, 0.0, None, None)


def flights(spark, *rows):
    return spark.createDataFrame(list(rows), "flight string, beacons array<string>, day string")


@pytest.mark.parametrize("broadcast_rows", [0, 100])
def test_day_window(spark, broadcast_rows):
    listed = flights(spark, ("F1", ["A", "B", "A"], "2024-7-1"), ("F2", ["A"], "2024-07-01"))
    times = [dt.datetime(2024, 7, 1, 9, 0), dt.datetime(2024, 7, 1, 9, 0, 0, 1000),
             dt.datetime(2024, 7, 2, 5, 59, 58), dt.datetime(2024, 7, 2, 5, 59, 59)]
    rows = [packet(f"A>B:{i}", t.replace(tzinfo=UTC)) for i, t in enumerate(times)]
    rows += [packet("A>WA0GEH-10:9", times[1].replace(tzinfo=UTC)),
             packet(None, times[1].replace(tzinfo=UTC))]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    got = extract.match_packets(df, listed, broadcast_rows=broadcast_rows)
    assert sorted((r.flight, r.raw) for r in got.collect()) == [
        (f, f"A>B:{i}") for f in ("F1", "F2") for i in (1, 2)]


def test_earliest_copy_spans_beacons(spark):
    t = dt.datetime(2024, 7, 1, 16, 0, tzinfo=UTC)
    rows = [packet("Z>X:same", t + dt.timedelta(seconds=2)), packet("A>B:same", t, callsign="B"),
            packet("A>C:other", t)]
    df = spark.createDataFrame([("F", *r.values()) for r in rows], "flight string, " + SCHEMA)
    got = sorted((r.info, r.callsign, r.raw) for r in extract.earliest_payloads(df).collect())
    assert got == [("other", "A", "A>C:other"), ("same", "B", "A>B:same")]


def test_flight_by_name(spark):
    listed = flights(spark, ("Fl-1", ["A"], "2024-07-01"))
    assert extract.flight_named(listed, "fL-1").count() == 1
    with pytest.raises(ValueError):
        extract.flight_named(listed, "fl-2")
