"""Map features: flight paths, altitude waypoints and points of interest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skytrace.functions.clock import date_time_text, duration_text, epoch_millis, time_text
from skytrace.functions.numeric import round_half_away
from skytrace.operators.phases import ASCENDING, DESCENDING, PHASE

# Waypoint spacing in feet, colours and names of the features.
WAYPOINT_STEP = 10_000
PHASE_COLOURS = {ASCENDING: "ff0000ff", DESCENDING: "ffff0000"}
END_COLOUR, BURST_COLOUR, REGIME_COLOUR = "ff00aaff", "ff00ffff", "ff006400"
PATH_NAMES = {ASCENDING: "Ascent", DESCENDING: "Descent"}
HIGH_TO_LOW_NAME, LOW_TO_HIGH_NAME = "Turbulent-to-Laminar", "Laminar-to-Turbulent"

# Longest path text held in one record; longer paths continue in further parts.
PART_VERTICES = 100_000


def two_phases(tracked: DataFrame) -> DataFrame:
    """Rows of flights that have both an ascent and a descent; others get no features."""
    return tracked.where(F.col("flight_rows") > F.col("ascent_rows"))


def _by_phase(values: dict[str, str]) -> Column:
    up = F.col("flight_phase") == ASCENDING
    return F.when(up, values[ASCENDING]).otherwise(values[DESCENDING])


def path_vertices(tracked: DataFrame) -> DataFrame:
    """Numbered vertices of both paths; the descent begins with the last ascent row.

    Row numbers are already known, so this neither shuffles nor gathers anything.
    """
    row, ascent = F.col("row_no"), F.col("ascent_rows")

    def vertex(phase: str, number: Column) -> Column:
        return F.struct(F.lit(phase).alias("flight_phase"), number.alias("vertex"))

    own = F.when(row < ascent, vertex(ASCENDING, row)).otherwise(
        vertex(DESCENDING, row - ascent + 1))
    both = F.array(own, vertex(DESCENDING, F.lit(0).cast("bigint")))
    spots = F.when(row == ascent - 1, both).otherwise(F.array(own))
    coordinates = ["longitude", "latitude", "altitude_m"]
    return two_phases(tracked).dropna(subset=coordinates).select(
        "flight", F.explode(spots).alias("spot"), *coordinates
    ).select("flight", "spot.*", *coordinates)


def plain_number(value: Column) -> Column:
    """Shortest decimal text without exponent, whole numbers without a fraction."""
    text = value.cast("string")
    spelled = text.try_cast("decimal(38,20)").cast("string")
    plain = F.when(text.contains("E"), F.regexp_replace(spelled, "0+$", "")).otherwise(text)
    return F.regexp_replace(plain, r"\.0?$", "")


def paths(tracked: DataFrame, part_vertices: int = PART_VERTICES) -> DataFrame:
    """Path text per flight and phase: ``lon,lat,alt`` triples separated by blanks.

    A path longer than ``part_vertices`` continues in further parts, each beginning with the last
    vertex of the one before, so a record is always of bounded size and no vertex is left out.
    """
    number = F.col("vertex")
    part = F.floor(number / part_vertices)
    joint = (number > 0) & (number % part_vertices == 0)
    parts = F.when(joint, F.array(part, part - 1)).otherwise(F.array(part))
    triple = F.concat_ws(",", *[plain_number(F.col(c))
                                for c in ("longitude", "latitude", "altitude_m")])
    ordered = F.array_sort(F.collect_list(F.struct("vertex", "triple")))
    name = F.concat_ws(" ", F.upper("flight"), _by_phase(PATH_NAMES))
    return (
        path_vertices(tracked)
        .select(*PHASE, "vertex", triple.alias("triple"), F.explode(parts).alias("part"))
        .groupBy(*PHASE, "part")
        .agg(ordered.alias("points"))
        .select(
            *PHASE, "part", name.alias("name"), _by_phase(PHASE_COLOURS).alias("colour"),
            F.size("points").alias("vertices"),
            F.array_join(F.transform("points", lambda p: p.triple), " ").alias("coordinates"),
        )
    )


def waypoints(tracked: DataFrame, step: int = WAYPOINT_STEP) -> DataFrame:
    """For every multiple of ``step`` between the lowest and highest altitude of a phase, the row
    nearest to it (the earliest of equals).

    The nearest row is the highest one below the target or the lowest one at or above it. So each
    band between two targets keeps just these two rows, and the few bands of a phase are searched
    with running extremes: no row is ever paired with a target.
    """
    point = ["latitude", "longitude", "altitude_ft", "altitude_m", "packettime"]
    altitude, row = F.col("altitude_ft"), F.col("row_no")
    lowest = F.struct(altitude.alias("by"), row.alias("row"), *point)
    highest = F.struct((-altitude).alias("by"), row.alias("row"), *point)
    bands = two_phases(tracked).groupBy(
        *PHASE, F.floor(altitude / step).cast("bigint").alias("band")
    ).agg(F.min(lowest).alias("low"), F.min(highest).alias("high"))

    phase = W.partitionBy(*PHASE)
    below = phase.orderBy("band").rowsBetween(W.unboundedPreceding, -1)
    above = phase.orderBy("band").rowsBetween(0, W.unboundedFollowing)
    # Bands as far as the next one in use, so that targets inside a gap are found too.
    following = F.coalesce(F.lead("band").over(phase.orderBy("band")), F.col("band") + 1)
    bottom = F.min("low.altitude_ft").over(phase)
    peak = F.max("high.altitude_ft").over(phase)
    bands = bands.withColumns({
        "next_band": following, "bottom": bottom, "peak": peak,
        "under": F.min("high").over(below), "over": F.min("low").over(above),
        "under_next": F.min("high").over(phase.orderBy("band").rowsBetween(W.unboundedPreceding, 0)),
        "over_next": F.min("low").over(phase.orderBy("band").rowsBetween(1, W.unboundedFollowing)),
    })
    # A target at the floor of a band looks down past it; one inside the gap behind a band looks
    # down into the band itself.
    bands = bands.withColumn("number", F.explode(F.sequence("band", F.col("next_band") - 1)))
    at_floor = F.col("number") == F.col("band")
    target = (F.col("number") * step).cast("double")
    first = F.ceil(F.col("bottom") / step) * step
    bands = bands.withColumns({
        "target": target,
        "down": F.when(at_floor, F.col("under")).otherwise(F.col("under_next")),
        "upward": F.when(at_floor, F.col("over")).otherwise(F.col("over_next")),
    }).where((target >= first) & (target < F.col("peak").cast("bigint")))

    def candidate(side: str) -> Column:
        away = F.abs(F.col(f"{side}.altitude_ft") - F.col("target"))
        return F.when(F.col(side).isNotNull(), F.struct(
            away.alias("away"), F.col(f"{side}.row").alias("row"),
            *[F.col(f"{side}.{c}").alias(c) for c in point]))

    nearest = F.least(candidate("down"), candidate("upward"))
    return bands.withColumn("nearest", nearest).select(
        *PHASE,
        F.concat((F.col("number") * step / 1000).cast("bigint").cast("string"), F.lit("k"))
        .alias("name"),
        (F.col("number") * step).alias("target_ft"),
        F.col("nearest.row").alias("row_no"),
        *[F.col(f"nearest.{c}").alias(c) for c in point[:4]],
        time_text(F.col("nearest.packettime")).alias("time"),
        _by_phase(PHASE_COLOURS).alias("colour"),
    )


def points_of_interest(tracked: DataFrame) -> DataFrame:
    """Launch, landing, burst (the last ascent row) and regime transitions, a plain filter."""
    row, feet = F.col("row_no"), F.col("altitude_ft")
    regime = F.when(
        F.col("reynolds_transition") == "high_to_low", HIGH_TO_LOW_NAME
    ).otherwise(LOW_TO_HIGH_NAME)
    thousands = round_half_away(feet / 1000.0, 0).cast("bigint").cast("string")

    def point(kind: str, name: Column, colour: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), name.alias("name"),
                        F.lit(colour).alias("colour"))

    # Half-even, as fixed-point printing of the exact value does.
    whole_feet = F.rint(feet).cast("bigint").cast("string")
    kinds = F.array(
        F.when(row == 0, point("launch", F.lit("Launch"), END_COLOUR)),
        F.when(row == F.col("flight_rows") - 1, point("landing", F.lit("Landing"), END_COLOUR)),
        F.when(row == F.col("ascent_rows") - 1, point(
            "burst", F.concat(F.lit("Burst "), whole_feet, F.lit("ft")), BURST_COLOUR)),
        F.when(F.col("reynolds_transition") != "", point(
            "transition", F.concat(thousands, F.lit("k, "), regime), REGIME_COLOUR)),
    )
    return two_phases(tracked).select(
        "flight", F.explode(F.filter(kinds, lambda k: k.isNotNull())).alias("point"), "row_no",
        "latitude", "longitude", "altitude_ft", "altitude_m",
        time_text(F.col("packettime")).alias("time"),
    ).select("flight", "point.*", "row_no", "latitude", "longitude", "altitude_ft", "altitude_m",
             "time")


def captions(tracked: DataFrame) -> DataFrame:
    """Heading of a flight: launch time, duration, distance down range, burst altitude."""
    row = F.col("row_no")
    end = F.struct("row_no", "packettime", "distance_from_launch_mi", "distance_from_launch_km")
    top = F.when(row == F.col("ascent_rows") - 1, F.struct("altitude_ft", "altitude_m"))
    ends = two_phases(tracked).groupBy("flight").agg(
        F.min(end).alias("first"), F.max(end).alias("last"), F.max(top).alias("top"))
    seconds = (epoch_millis(F.col("last.packettime")) - epoch_millis(F.col("first.packettime")))
    return ends.select(
        "flight", F.upper("flight").alias("name"),
        date_time_text(F.col("first.packettime")).alias("launch_time"),
        duration_text(seconds / F.lit(1000.0)).alias("duration"),
        F.col("last.distance_from_launch_mi").alias("range_mi"),
        F.col("last.distance_from_launch_km").alias("range_km"),
        F.col("top.altitude_ft").alias("burst_ft"), F.col("top.altitude_m").alias("burst_m"),
    )
