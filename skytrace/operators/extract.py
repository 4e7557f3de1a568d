"""From the packet table to the parsed packets of each flight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytrace.functions import clock, telemetry
from skytrace.operators.layout import hinted
from skytrace.schemas import EXTRACTED_COLUMNS, PACKET_COLUMNS
from skytrace.session import written

BROADCAST_ROWS = 200_000
# Packets of one beacon and day that one task joins.
SALT_ROWS = 500_000
BEACON_DAY = ["callsign", "flight_day"]


def flight_named(flights: DataFrame, name: str) -> DataFrame:
    """The flight of that name, whatever its case. Fails if the list does not hold it."""
    found = flights.where(F.lower("flight") == F.lower(F.lit(name)))
    if found.isEmpty():
        raise ValueError(f"flight {name!r} is not in the flight list")
    return found


def beacon_windows(flights: DataFrame) -> DataFrame:
    """One row per flight and beacon, with the flight day and its exclusive time bounds."""
    date = clock.flight_date(F.col("day"))
    return flights.select(
        "flight",
        F.explode(F.array_distinct("beacons")).alias("callsign"),
        date.alias("flight_day"),
        clock.local_instant(date, clock.WINDOW_OPENS).alias("opens"),
        clock.local_instant(date, clock.WINDOW_CLOSES).alias("closes"),
    )


def _bounds(windows: DataFrame, rows: int) -> tuple[bool, int | None, int | None]:
    """Whether there are at most ``rows`` windows, and between which instants they all lie."""
    def over(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.unix_micros(F.min("opens")),
                      F.unix_micros(F.max("closes"))).first()

    found = over(windows.limit(rows + 1))
    few = found[0] <= rows
    return few, *(found if few else over(windows))[1:]


def match_packets(
    packets: DataFrame,
    flights: DataFrame,
    excluded_text: str = telemetry.RELAY_EXCLUDED,
    broadcast_rows: int = BROADCAST_ROWS,
    salt_rows: int = SALT_ROWS,
) -> DataFrame:
    """Packets of the beacons of each flight, received inside its day window.

    Equality on callsign and local day makes this a hash join; the day also prunes a packet table
    partitioned by ``day``. A flight list within ``broadcast_rows`` is broadcast, so the packets
    stay where they are; a longer one is joined by shuffle, in which a beacon of more than
    ``salt_rows`` packets a day is dealt to several tasks.
    """
    windows = beacon_windows(flights)
    if "day" in packets.columns:
        received_day = F.col("day").cast("date")
    else:
        received_day = F.to_date(F.from_utc_timestamp("tm", clock.HOME_ZONE))
    few, opens, closes = _bounds(windows, broadcast_rows)
    # What the whole list allows is known before the scan: it skips days, files and row groups.
    heard = packets.where(
        (F.col("tm") > F.timestamp_micros(F.lit(opens)))
        & (F.col("tm") < F.timestamp_micros(F.lit(closes)))
        & ~F.col("raw").contains(excluded_text)
    ).select(*PACKET_COLUMNS, received_day.alias("flight_day"))
    if "day" in packets.columns and opens is not None:
        heard = heard.where(F.col("flight_day").between(
            *[F.to_date(F.from_utc_timestamp(F.timestamp_micros(F.lit(t)), clock.HOME_ZONE))
              for t in (opens, closes)]))
    if few:
        joined = heard.join(F.broadcast(windows), BEACON_DAY)
    else:
        joined = _salted(heard, windows, salt_rows)
    inside = (F.col("tm") > F.col("opens")) & (F.col("tm") < F.col("closes"))
    return joined.where(inside).select("flight", *PACKET_COLUMNS)


def _salted(heard: DataFrame, windows: DataFrame, salt_rows: int) -> DataFrame:
    """Join by shuffle on beacon, day and salt.

    Packets are counted per beacon and day, with aggregation before the shuffle. The packets of a
    chatty one are dealt by their hash to as many salts as keep each within ``salt_rows``; its
    windows, a few rows, go to every salt. There is one chatty key for ``salt_rows`` packets at most.
    """
    salts = F.ceil(F.col("rows") / salt_rows).alias("salts")
    chatty = written(heard.groupBy(*BEACON_DAY).agg(F.count(F.lit(1)).alias("rows")).where(
        F.col("rows") > salt_rows).select(*BEACON_DAY, salts), "chatty")
    own = F.coalesce(F.col("salts"), F.lit(1).cast("bigint"))
    dealt = heard.join(hinted(chatty), BEACON_DAY, "left").withColumn(
        "salt", F.pmod(F.xxhash64("tm", "raw"), own)).drop("salts")
    everywhere = windows.join(hinted(chatty), BEACON_DAY, "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("bigint"), own - 1))).drop("salts")
    return dealt.hint("merge").join(everywhere, [*BEACON_DAY, "salt"])


def earliest_payloads(matched: DataFrame) -> DataFrame:
    """The earliest received copy of each payload text of a flight, across all its beacons.

    An aggregate, so copies collapse before the shuffle. The payload is the grouping key and only
    the text before it travels beside it; ``raw`` is put together again afterwards. A first row of
    texts has no fixed width, so Spark aggregates sorted rows; the leading hash makes that a radix
    sort of numbers instead of a comparison of texts.
    """
    rest = [c for c in PACKET_COLUMNS if c not in ("tm", "callsign", "raw")]
    first = F.min(F.struct("tm", "callsign", "header", *rest)).alias("first")
    return (
        matched.select(
            "flight", telemetry.payload(F.col("raw")).alias("info"),
            telemetry.header(F.col("raw")).alias("header"),
            *[c for c in PACKET_COLUMNS if c != "raw"],
        )
        .groupBy(F.xxhash64("flight", "info").alias("slot"), "flight", "info")
        .agg(first)
        .select("flight", "info", "first.*")
        .withColumn("raw", F.concat("header", "info"))
        .drop("header")
    )


def parse_packets(packets: DataFrame, anchored_pressure: bool = False) -> DataFrame:
    """The 17 published columns of a packet, in front of them any key columns."""
    raw, received = F.col("raw"), F.col("receivetime")
    keys = [c for c in packets.columns if c not in PACKET_COLUMNS and c != "info"]
    # Each pattern is matched once; everything else is taken from these pieces.
    pieces = packets.withColumns({
        "receivetime": clock.local_time(F.col("tm")),
        "temperature": telemetry.temperature_digits(raw),
        "pressure": telemetry.pressure_digits(raw, anchored_pressure),
    })
    tenths = telemetry.whole_number(F.col("temperature"))
    units = F.when(F.col("temperature") != "", telemetry.whole_number(F.col("pressure")))
    parsed: dict[str, Column] = {
        "info": telemetry.payload(raw),
        "receivetime": received,
        "packettime": telemetry.packet_time(raw, received),
        "callsign": F.col("callsign"),
        "raw": raw,
        "bearing": telemetry.rounded(F.col("bearing"), 1),
        "speed_mph": telemetry.rounded(F.col("speed_mph"), 1),
        "speed_kph": telemetry.kilometres(F.col("speed_mph")),
        "altitude_ft": telemetry.rounded(F.col("altitude"), 1),
        "altitude_m": telemetry.metres(F.col("altitude")),
        "latitude": F.col("latitude").cast("double"),
        "longitude": F.col("longitude").cast("double"),
        "temperature_f": telemetry.fahrenheit(tenths),
        "temperature_c": telemetry.celsius(tenths),
        "temperature_k": telemetry.kelvin(tenths),
        "pressure_atm": telemetry.atmospheres(units),
        "pressure_pa": telemetry.pascals(units),
    }
    return pieces.select(*keys, *[parsed[name].alias(name) for name in EXTRACTED_COLUMNS])


def burst_altitudes(extracted: DataFrame) -> DataFrame:
    """Highest reported burst altitude per flight, over all packets, also those without position."""
    feet = telemetry.burst_feet(F.col("raw"))
    return extracted.groupBy("flight").agg(F.max(feet).alias("burst_ft"))
