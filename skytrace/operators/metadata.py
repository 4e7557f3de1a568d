"""One record per flight."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytrace.functions import units
from skytrace.functions.clock import duration_text, epoch_millis
from skytrace.functions.numeric import FEET_TO_METRES, round_half_away
from skytrace.operators.extract import burst_altitudes
from skytrace.operators.kinematics import ESSENTIAL, KEPT
from skytrace.operators.phases import FEWEST_ROWS
from skytrace.operators.regimes import transitions

# Fixed order of the record.
RECORD = [
    "flight", "beacons", "day", "balloonsize", "parachute", "weights", "liftfactor", "h2fill",
    "maxaltitude_ft", "maxaltitude_m", "detected_burst", "numpoints", "flighttime",
    "flighttime_secs", "range_distance_traveled_mi", "range_distance_traveled_km",
    "launch_location", "landing_location", "reynolds_transitions",
]


def flight_summary(tracked: DataFrame, *also: Column) -> DataFrame:
    """Per flight: highest altitude before trimming, first and last row, duration, range, rows, and
    the named aggregates in ``also``.

    One aggregate with map-side combining; no flight is gathered in one place.
    """
    where = ["latitude", "longitude", "altitude_ft", "altitude_m"]
    away = ["distance_from_launch_mi", "distance_from_launch_km"]
    time = epoch_millis(F.col("packettime")).alias("time_ms")
    end = F.struct("row_no", time, *where, *away)
    totals = tracked.groupBy("flight").agg(
        F.max("apex_ft").alias("maxaltitude_ft"),
        F.max("apex_m").alias("maxaltitude_m"),
        F.count(F.lit(1)).alias("numpoints"),
        F.min(end).alias("first"),
        F.max(end).alias("last"),
        *also,
    )
    known = ("flight", "maxaltitude_ft", "maxaltitude_m", "numpoints", "first", "last")
    seconds = (F.col("last.time_ms") - F.col("first.time_ms")) / F.lit(1000.0)
    return totals.select(
        "flight", "maxaltitude_ft", "maxaltitude_m", "numpoints",
        duration_text(seconds).alias("flighttime"),
        seconds.alias("flighttime_secs"),
        F.col("last.distance_from_launch_mi").alias("range_distance_traveled_mi"),
        F.col("last.distance_from_launch_km").alias("range_distance_traveled_km"),
        F.struct(*[F.col(f"first.{c}").alias(c) for c in where]).alias("launch_location"),
        F.struct(*[F.col(f"last.{c}").alias(c) for c in (*where, *away)]).alias(
            "landing_location"),
        *[c for c in totals.columns if c not in known],
    )


def detected_burst(feet):
    """Reported burst; a report of 0 ft still counts as detected."""
    amount = F.coalesce(feet.cast("double"), F.lit(0.0))
    return F.struct(
        feet.isNotNull().alias("detected"),
        amount.alias("burst_ft"),
        round_half_away(amount * F.lit(FEET_TO_METRES), 2).alias("burst_m"),
    )


def converted_flights(flights: DataFrame) -> DataFrame:
    """Flight list with weights and parachute in both unit systems."""
    return flights.withColumns({
        "parachute": units.parachute(F.col("parachute"), F.col("weights")),
        "weights": units.weight_pairs(F.col("weights")),
    })


def flight_metadata(flights: DataFrame, extracted: DataFrame, tracked: DataFrame) -> DataFrame:
    """Full record of each flight that came through; the others have none."""
    bursts = burst_altitudes(extracted)
    return (
        converted_flights(flights)
        .join(flight_summary(tracked, transitions().alias("reynolds_transitions")), "flight")
        .join(bursts, "flight", "left")
        .withColumn("detected_burst", detected_burst(F.col("burst_ft")))
        .select(*RECORD)
    )


def flight_status(flights: DataFrame, extracted: DataFrame, followed: DataFrame) -> DataFrame:
    """Outcome of every listed flight: ``ok``, or the first guard it failed.

    ``followed`` are the tracked rows with those that tell what became of the others (``keep_lost``).
    """
    whole = reduce(and_, [F.col(c).isNotNull() for c in ESSENTIAL])
    heard = extracted.groupBy("flight").agg(
        F.count(F.lit(1)).alias("extracted_rows"), F.count_if(whole).alias("complete_rows"),
    )
    fate = F.col("fate")
    kept = followed.groupBy("flight").agg(
        F.max("position_rows").alias("position_rows"),
        F.max("filtered_rows").alias("filtered_rows"),
        F.count_if(fate == KEPT).alias("trimmed_rows"),
        F.max(F.when(fate == KEPT, F.col("ascent_rows"))).alias("ascent_rows"),
    )
    counts = ["extracted_rows", "complete_rows", "position_rows", "filtered_rows",
              "trimmed_rows", "ascent_rows"]
    joined = flights.select("flight").join(heard, "flight", "left").join(kept, "flight", "left")
    joined = joined.na.fill(0, counts)
    few = F.lit(FEWEST_ROWS)
    status = (
        F.when(F.col("extracted_rows") == 0, "no_rows")
        .when(F.col("complete_rows") == 0, "no_complete_rows")
        .when(F.col("position_rows") == 0, "no_positions")
        .when(F.col("position_rows") < few, "too_few_rows")
        .when(F.col("filtered_rows") < few, "too_few_after_filter")
        .when(F.col("trimmed_rows") < few, "too_few_after_trim")
        .when(F.col("ascent_rows") < few, "short_ascent")
        .otherwise("ok")
    )
    descent = F.when(status == "ok", F.col("trimmed_rows") - F.col("ascent_rows"))
    return joined.select("flight", *counts, status.alias("status"),
                         (descent < few).alias("short_descent"))


def outcome_counts(status: DataFrame) -> DataFrame:
    """Number of flights per outcome."""
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("flights"))

