"""Packets and a flight list derived from the ``events`` table: one flight per user.

Gives every operator irregular two-beacon series with copies, status texts, excluded relays,
stragglers and outliers; packets outside the day window, on its bounds, of another day, of unlisted
beacons, without text; a beacon in two flights; and flights that fail each guard (``FAILING``). All
formulas are integer arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytrace.functions.clock import WINDOW_CLOSES, WINDOW_OPENS, epoch_millis, local_instant
from skytrace.functions.telemetry import RELAY_EXCLUDED
from skytrace.operators.layout import WHOLE, Layout

# Feet gained per row in the three parts of the climb, by user_id % 4.
CLIMB_RATES = [(1500, 1500, 2100), (2100, 2100, 1500), (1500, 2400, 1500), (2100, 1200, 2100)]
WEIGHTS = ["client", "vehicle", "parachute", "neckload", "balloon", "gross", "necklift"]
BALLOONS = ["1500gm", "2000gm", "3000gm"]
FIELD = 5200
#: What is special about users by user_id % 50; every event becomes a packet all the same.
FAILING = {
    "other_day": 49, "no_place": 48, "on_the_ground": 47, "two_positions": 46, "all_too_fast": 45,
    "sinks_slowly": 44, "starts_high": 43, "never_falls": 42,
}


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _div(a: Column, b) -> Column:
    return F.floor(a / b).cast("bigint")


def _day(user: Column) -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), (user % 300).cast("int"))


def flight_name(user: Column) -> Column:
    return F.concat(F.lit("FL-"), user.cast("string"))


def _beacon(user: Column, number: Column) -> Column:
    return F.concat(F.lit("B"), user.cast("string"), F.lit("-"), number.cast("string"))


def numbered_events(events: DataFrame, layout: Layout = WHOLE) -> DataFrame:
    """Events with their position and the number of events of the user."""
    placed = layout.place(
        events.select("user_id", "event_id", "event_type", "ts"), ["user_id"],
        epoch_millis(F.col("ts")), ("ts", F.col("event_id")),
    )
    return layout.scan(placed, ["user_id"], ["ts", "event_id"], index="at", size="n")


def _pick(user: Column, part: int) -> Column:
    value = F.lit(CLIMB_RATES[3][part])
    for group in (2, 1, 0):
        value = F.when(user % 4 == group, F.lit(CLIMB_RATES[group][part])).otherwise(value)
    return value


def packets(events: DataFrame, layout: Layout = WHOLE) -> DataFrame:
    """Packets as a receiver network would store them, copies included."""
    u, e, rn, n, up = (F.col(c) for c in ("user_id", "event_id", "rn", "n", "up"))
    df = numbered_events(events, layout).withColumn("rn", F.col("at") + 1)

    def special(kind: str) -> Column:
        return u % 50 == FAILING[kind]

    df = df.withColumns({
        "up": _div(n * 6, 10), "g1": _pick(u, 0), "g2": _pick(u, 1), "g3": _pick(u, 2),
    })

    def climb(row: Column) -> Column:
        def beyond(start: int) -> Column:
            return F.greatest(row - start, F.lit(0))
        return (
            F.lit(FIELD) + F.col("g1") * F.least(beyond(8), F.lit(7))
            + F.col("g2") * F.least(beyond(15), F.lit(8)) + F.col("g3") * beyond(23)
        )

    df = df.withColumn("top", climb(up))
    spike = F.when((e % 53 == 0) & (rn > 10), F.lit(9000)).otherwise(F.lit(0))
    steps = F.greatest(n - 5 - up, F.lit(1))
    sink = _div((F.col("top") - FIELD) * (rn - up), steps)
    late = F.when((u % 4 == 0) & (rn >= n - 2), F.lit(1500)).otherwise(F.lit(0))
    df = df.withColumns({
        "alt": F.when(special("on_the_ground"), F.lit(0))
        .when(special("all_too_fast"), F.lit(FIELD) + rn * 20_000)
        .when(special("sinks_slowly"), F.lit(6000) - rn * 5)
        .when(special("starts_high"), F.lit(60_000) - rn * 500)
        .when(special("never_falls"), F.lit(FIELD) + rn * 1500)
        .when(rn <= up, climb(rn) + (e % 11) * 10 + spike)
        .when(rn <= n - 6, F.col("top") - sink + (e % 11) * 5)
        .otherwise(F.lit(FIELD) + e % 3),
        "sec": rn * 120 + (e % 7) * 2 + late,
        "status": F.col("event_type") == "error",
    })
    shift = F.when(special("other_day"), F.lit(86_400)).otherwise(F.lit(0))
    start = F.unix_seconds(_day(u).cast("timestamp")) + F.lit(13 * 3600) + shift
    sent = start + F.col("sec")
    temperature = (F.lit(150) - _div(F.col("alt"), 100)).cast("string")
    pressure = F.greatest(F.lit(8400) - rn * 100, F.lit(50)).cast("string")
    position_text = F.concat(
        F.lit(",WIDE2-1:/"), F.date_format(F.timestamp_seconds(sent), "HHmmss"), F.lit("h /A="),
        F.lpad(F.col("alt").cast("string"), 6, "0"), F.lit(" "), temperature, F.lit("T"), pressure,
        F.lit("P"),
    )
    status_text = F.when(
        (rn > up) & (u % 5 != 0),
        F.concat(F.lit(":>DETECTED BURST at "), F.col("top").cast("string"), F.lit("ft")),
    ).otherwise(F.concat(F.lit(":>STATUS OK "), e.cast("string")))
    df = df.withColumns({
        "callsign": _beacon(u, F.when(special("two_positions"), F.lit(0)).otherwise(e % 2)),
        "body": F.when(F.col("status"), status_text).otherwise(position_text),
        "received": sent + e % 5,
    })

    def copy(delay: int, path: str = "", suffix: str = "", at: str = "", sender: str = "",
             silent: bool = False) -> Column:
        return F.struct(F.lit(delay).alias("delay"), F.lit(path).alias("path"),
                        F.lit(suffix).alias("suffix"), F.lit(at).alias("at"),
                        F.lit(sender).alias("sender"), F.lit(silent).alias("silent"))

    copies = F.array_compact(F.array(
        copy(0),
        F.when(e % 9 == 0, copy(3)),
        F.when(e % 13 == 0, copy(4, suffix=" r")),
        F.when(e % 37 == 0, copy(5, path="," + RELAY_EXCLUDED)),
        F.when(e % 29 == 0, copy(0, at="02:59:59")),
        F.when(e % 31 == 0, copy(0, at=WINDOW_OPENS)),
        F.when(e % 41 == 0, copy(0, suffix=" z", at=WINDOW_CLOSES)),
        F.when(e % 43 == 0, copy(6, suffix=" x", sender="X")),
        F.when(e % 47 == 0, copy(7, silent=True)),
    ))

    placed = ~F.col("status") & ~special("no_place")
    high = ~F.col("status") & ~(special("two_positions") & (rn > 2))
    received = F.when(F.col("at") == "", F.timestamp_seconds(F.col("received") + F.col("delay")))
    # Digits before a P in the address are taken for a pressure.
    address = F.when(e % 17 == 0, F.lit(">AP12P1")).otherwise(F.lit(">APZ001"))
    return df.select(
        "callsign", "received", "body", _day(u).alias("sent_on"), address.alias("address"),
        (F.lit(20) + e % 40).alias("speed_mph"),
        (e % 360).alias("bearing"),
        F.when(high, F.col("alt")).alias("altitude"),
        F.when(placed, (F.lit(39600) + rn * 4) / F.lit(1000.0)).alias("latitude"),
        F.when(placed, (F.lit(-104000) + rn * 9) / F.lit(1000.0)).alias("longitude"),
        F.inline(copies),
    ).select(
        F.coalesce(received, local_instant(F.col("sent_on"), F.nullif("at", F.lit("")))).alias("tm"),
        F.concat("sender", "callsign").alias("callsign"),
        "speed_mph", "bearing", "altitude", "latitude", "longitude",
        F.when(~F.col("silent"), F.concat("callsign", "address", "path", "body", "suffix"))
        .alias("raw"),
    )


def flights(events: DataFrame) -> DataFrame:
    """Flight list with one entry per user, every scalar a text."""
    u = F.col("user_id")
    day = _day(u)
    day_text = F.when(u % 7 == 0, F.date_format(day, "yyyy-M-d")).otherwise(
        F.date_format(day, "yyyy-MM-dd"))

    def weight(number: int) -> Column:
        text = F.concat(
            (u % 20 + number).cast("string"), F.lit("."),
            F.lpad((u % 100).cast("string"), 2, "0"),
        )
        return F.when(u % 6 == 0, F.lit("x")).otherwise(text) if number == 0 else text

    names = F.array(*[F.lit(name) for name in WEIGHTS])
    amounts = F.array(*[weight(i) for i in range(len(WEIGHTS))])
    # Some list a beacon that flew with another flight the day before.
    own = F.array(_beacon(u, F.lit(0)), _beacon(u, F.lit(1)))
    balloon = F.element_at(F.array(*[F.lit(b) for b in BALLOONS]), (u % 3 + 1).cast("int"))
    return events.select("user_id").distinct().select(
        flight_name(u).alias("flight"),
        F.when(u % 10 == 3, F.concat(own, F.array(_beacon(u - 1, F.lit(0))))).otherwise(own)
        .alias("beacons"),
        day_text.alias("day"),
        balloon.alias("balloonsize"),
        F.struct(F.lit("Dome").alias("description"),
                 (u % 5 + 8).cast("string").alias("size")).alias("parachute"),
        F.map_from_arrays(names, amounts).alias("weights"),
        F.concat(F.lit("1."), F.lpad((u % 60).cast("string"), 2, "0")).alias("liftfactor"),
        (u % 300 + 100).cast("string").alias("h2fill"),
    )
