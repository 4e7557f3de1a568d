"""Position packets of a beacon and the changes from one to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytrace.functions import numeric
from skytrace.functions.clock import epoch_millis
from skytrace.operators.layout import WHOLE, Layout

ESSENTIAL = ["altitude_ft", "latitude", "longitude", "packettime"]
KEPT = "kept"

BEACON = ["flight", "callsign"]
# After ``first_per_time`` a beacon has one packet per time, so this order has no ties.
FLIGHT_ORDER = ["packettime", "callsign"]


def lose(df: DataFrame, lost, reason: str) -> DataFrame:
    """Mark the kept rows for which ``lost`` is true with the reason they are left out."""
    fate = F.col("fate")
    return df.withColumn("fate", F.when((fate == KEPT) & lost, F.lit(reason)).otherwise(fate))


def survivors(df: DataFrame, keep_lost: bool) -> DataFrame:
    """Rows still kept. With ``keep_lost`` a lost row stays as well if it was its flight's first: one
    for each step at most, in a window of its own, to tell how far a flight came that lost all."""
    kept = F.col("fate") == KEPT
    return df.where(kept | (F.col("row_no") == 0) if keep_lost else kept)


def counted(df: DataFrame, name: str, keep_lost: bool) -> DataFrame:
    """With ``keep_lost``, note how many rows of the flight have come this far."""
    rows = F.when(F.col("fate") == KEPT, F.col("flight_rows"))
    return df.withColumn(name, F.coalesce(name, rows) if name in df.columns else rows) \
        if keep_lost else df


def series_of(keep_lost: bool, *keys: str) -> list[str]:
    """Window keys under which lost rows never meet kept ones."""
    return [*keys, "fate"] if keep_lost else list(keys)


def complete_rows(extracted: DataFrame) -> DataFrame:
    """Packets that have a time, an altitude and a position."""
    return extracted.dropna(subset=ESSENTIAL)


def flag_positions(df: DataFrame) -> DataFrame:
    """Add ``position_packet``: above zero altitude with a position. Never null."""
    above = F.coalesce(F.col("altitude_ft") > 0, F.lit(False))
    located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    return df.withColumn("position_packet", above & located)


def position_rows(extracted: DataFrame) -> DataFrame:
    """Complete packets above zero altitude."""
    return flag_positions(complete_rows(extracted)).where("position_packet")


def first_per_time(df: DataFrame, keys=tuple(BEACON), time: str = "packettime",
                   prefer=("receivetime", "info")) -> DataFrame:
    """One row per key and time, the first by ``prefer``.

    Copies collapse before a shuffle; rows that are placed by a part of ``keys`` already are not
    shuffled, and come out in the order that scans by key and time need.
    """
    grouping = [*keys, time]
    rest = [c for c in df.columns if c not in grouping and c not in prefer]
    first = F.min(F.struct(*prefer, *rest)).alias("first")
    return df.groupBy(*grouping).agg(first).select(*grouping, "first.*").select(*df.columns)


def flight_callsigns(df: DataFrame) -> DataFrame:
    """Distinct callsigns heard of each flight."""
    return df.select("flight", "callsign").where(F.col("callsign").isNotNull()).distinct()


def placed_positions(extracted: DataFrame, layout: Layout = WHOLE) -> DataFrame:
    """Deduplicated position packets, partitioned the way all later windows need them."""
    rows = position_rows(extracted)
    time_ms = epoch_millis(F.col("packettime"))
    if layout.sliced:
        # A slice is bounded only once a beacon has one packet per millisecond.
        return layout.place(first_per_time(rows), ["flight"], time_ms)
    return first_per_time(layout.place(rows, ["flight"], time_ms))


def beacon_deltas(positions: DataFrame, layout: Layout = WHOLE) -> DataFrame:
    """Time steps and velocities between consecutive packets of a beacon.

    Beacons with a single packet take no part in the flight.
    """
    previous = {
        "prev_time": "packettime", "prev_lon": "longitude", "prev_lat": "latitude",
        "prev_ft": "altitude_ft", "prev_m": "altitude_m",
    }
    df = positions.withColumn("fate", F.lit(KEPT))
    df = layout.scan(df, BEACON, ["packettime"], lag=previous, size="beacon_rows")
    df = df.where(F.col("beacon_rows") > 1)
    df = df.withColumn(
        "timedelta_s",
        (epoch_millis(F.col("packettime")) - epoch_millis(F.col("prev_time"))) / F.lit(1000.0),
    )

    def rate(now: str, before: str):
        change = (F.col(now) - F.col(before)) / F.col("timedelta_s")
        return numeric.round_half_away(F.when(F.col("timedelta_s") > 0, change), 8)

    df = df.withColumns({
        "velocity_x_degs": rate("longitude", "prev_lon"),
        "velocity_y_degs": rate("latitude", "prev_lat"),
        "velocity_z_fts": rate("altitude_ft", "prev_ft"),
        "velocity_z_ms": rate("altitude_m", "prev_m"),
    })
    per_minute = numeric.round_half_away(F.col("velocity_z_fts") * F.lit(60.0), 1)
    return df.withColumn("vert_rate_ftmin", per_minute).drop(*previous, "beacon_rows")


# Columns no later scan looks at.
CARGO = ["info", "receivetime", "raw", "bearing", "speed_mph", "speed_kph", "temperature_f",
         "temperature_c", "temperature_k", "pressure_atm", "pressure_pa", "position_packet"]


def stow(df: DataFrame) -> DataFrame:
    """Put the columns no scan looks at into one struct: windows copy rows column by column."""
    return df.withColumn("cargo", F.struct(*CARGO)).drop(*CARGO)


def unload(df: DataFrame) -> DataFrame:
    """Undo ``stow``."""
    return df.select("*", "cargo.*").drop("cargo")


def air_density(df: DataFrame) -> DataFrame:
    """Add dry-air density from pressure and temperature."""
    pressure, temperature = F.col("pressure_pa"), F.col("temperature_k")
    return df.withColumns({
        "airdensity_slugs": numeric.round_half_away(
            numeric.air_density_slugs(pressure, temperature), 8
        ),
        "airdensity_kgm3": numeric.round_half_away(
            numeric.air_density_kgm3(pressure, temperature), 8
        ),
    })
