"""Ascent and descent, and the statistics of each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytrace.functions import numeric
from skytrace.functions.clock import epoch_millis
from skytrace.functions.numeric import round_half_away, ticks
from skytrace.operators.kinematics import FLIGHT_ORDER, series_of
from skytrace.operators.layout import WHOLE, Layout

ASCENDING, DESCENDING = "ascending", "descending"
PHASE = ["flight", "flight_phase"]
# A phase of fewer rows gets no statistics; an ascent of fewer fails the flight.
FEWEST_ROWS = 3

VELOCITY_PLACES = 8
ACCELERATION_PLACES = 6


def split_phases(df: DataFrame, layout: Layout = WHOLE, keep_lost: bool = False) -> DataFrame:
    """Ascent up to the first highest row left after trimming, descent behind it.

    Also adds the distance from the first row. ``row_no`` must count from 0 without gaps.
    """
    df = layout.scan(df, series_of(keep_lost, "flight"), FLIGHT_ORDER, totals={
        "top": ("min", F.struct((-F.col("altitude_ft")).alias("depth"), "row_no")),
        "origin": ("min", F.struct("row_no", "latitude", "longitude")),
    })
    ascent_rows = F.col("top.row_no") + 1
    up = F.col("row_no") < ascent_rows
    miles = round_half_away(
        numeric.haversine_miles(
            F.col("origin.latitude"), F.col("origin.longitude"),
            F.col("latitude"), F.col("longitude"),
        ), 2,
    )
    return df.withColumns({
        "ascending": up,
        "ascent_rows": ascent_rows,
        "flight_phase": F.when(up, F.lit(ASCENDING)).otherwise(F.lit(DESCENDING)),
        "phase_row": F.when(up, F.col("row_no")).otherwise(F.col("row_no") - ascent_rows),
        "phase_rows": F.when(up, ascent_rows).otherwise(F.col("flight_rows") - ascent_rows),
        "distance_from_launch_mi": miles,
    }).withColumn(
        "distance_from_launch_km",
        round_half_away(F.col("distance_from_launch_mi") * F.lit(numeric.MILES_TO_KM), 2),
    ).drop("top", "origin")


def usable_flights(df: DataFrame) -> DataFrame:
    """Rows of flights whose ascent is long enough; no other flight has an output."""
    return df.where(F.col("ascent_rows") >= FEWEST_ROWS)


def _for_phases(value):
    return F.when(F.col("phase_rows") >= FEWEST_ROWS, value)


def _ends():
    point = F.struct("phase_row", "packettime", "altitude_ft")
    return {"begin": ("min", point), "finish": ("max", point)}


_BEFORE = {"prev_fts": "velocity_z_fts", "prev_ms": "velocity_z_ms"}


def phase_line(df: DataFrame, layout: Layout = WHOLE) -> DataFrame:
    """Seconds since the phase began and the distance to the line from its first to last row."""
    return _line(layout.scan(df, PHASE, FLIGHT_ORDER, totals=_ends()))


def acceleration(df: DataFrame, layout: Layout = WHOLE) -> DataFrame:
    """Change of vertical velocity against the row before in the phase, whichever beacon sent it,
    over the time step of the row's own beacon."""
    return _changes(layout.scan(df, PHASE, FLIGHT_ORDER, lag=_BEFORE))


def phase_motion(df: DataFrame, layout: Layout = WHOLE) -> DataFrame:
    """``phase_line`` and ``acceleration`` from one scan."""
    return _changes(_line(layout.scan(df, PHASE, FLIGHT_ORDER, lag=_BEFORE, totals=_ends())))


def _line(df: DataFrame) -> DataFrame:
    start, seconds = epoch_millis(F.col("begin.packettime")), F.lit(1000.0)
    span = (epoch_millis(F.col("finish.packettime")) - start) / seconds
    rise = F.col("finish.altitude_ft") - F.col("begin.altitude_ft")
    slope = F.when(F.abs(span) > numeric.NEAR_ZERO, rise / span).otherwise(F.lit(0.0))
    elapsed = (epoch_millis(F.col("packettime")) - start) / seconds
    distance = numeric.line_distance(
        elapsed, F.col("altitude_ft"), slope, F.col("begin.altitude_ft")
    )
    return df.withColumns({
        "elapsed_secs": _for_phases(elapsed),
        "distance_to_line": round_half_away(_for_phases(distance), 6),
    }).drop("begin", "finish")


def _changes(df: DataFrame) -> DataFrame:
    def change(now: str, before: str):
        step = F.col("timedelta_s")
        timed = (step > 0) & (F.col("phase_rows") >= FEWEST_ROWS)
        return round_half_away(F.when(timed, (F.col(now) - F.col(before)) / step), 6)

    return df.withColumns({
        "acceleration_fts2": change("velocity_z_fts", "prev_fts"),
        "acceleration_ms2": change("velocity_z_ms", "prev_ms"),
    }).drop("prev_fts", "prev_ms")


def expanding_stats(df: DataFrame, layout: Layout, part, order,
                    values: dict[str, tuple[str, str, str, int]], places: int = 6,
                    **also) -> DataFrame:
    """Mean, sample deviation and normalised value over all rows so far.

    ``values`` maps a column to the names of the three results and the number of decimals it
    usually carries. Rows without a value get none; the deviation needs two values, the normalised
    value a deviation above 0 (both taken after rounding). ``also`` adds further results of the same
    scan. A series whose values all have that many decimals is summed exactly; any other series is
    summed in doubles around its first finite value. A NaN makes all later results of its series NaN.
    """
    kinds = {}
    for name, (*_, decimals) in values.items():
        value = F.col(name)
        finite = ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
        kinds[f"{name}__whole"] = ("min", F.when(
            value.isNotNull(), numeric.has_places(value, decimals).cast("int")))
        kinds[f"{name}__largest"] = ("max", F.abs(numeric.scaled(value, decimals)))
        kinds[f"{name}__known"] = ("sum", value.isNotNull().cast("bigint"))
        kinds[f"{name}__first"] = ("min", F.when(finite, F.struct(*order, value.alias("origin"))))
    df = layout.scan(df, part, order, totals=kinds)
    sums = {}
    for name, (*_, decimals) in values.items():
        value, whole = F.col(name), f"{name}__exact"
        df = df.withColumn(whole, numeric.exactly_summed(
            F.col(f"{name}__known"), F.col(f"{name}__whole") == 1, F.col(f"{name}__largest")))
        exact = F.when(F.col(whole), ticks(value, decimals))
        apart = F.when(~F.col(whole), value - F.coalesce(
            F.col(f"{name}__first.origin"), F.lit(0.0)))
        sums[f"{name}__n"] = value.isNotNull().cast("bigint")
        sums[f"{name}__sum"], sums[f"{name}__squares"] = exact, F.try_multiply(exact, exact)
        sums[f"{name}__apart"], sums[f"{name}__apart2"] = apart, apart * apart
    df = layout.scan(df, part, order, running=sums, **also)
    stats, normed = {}, {}
    for name, (mean, deviation, norm, decimals) in values.items():
        n, total, squares, apart, apart2 = (
            F.col(f"{name}__{s}") for s in ("n", "sum", "squares", "apart", "apart2"))
        known, exact = F.col(name).isNotNull(), F.col(f"{name}__exact")
        count = n.cast("double")
        origin = F.coalesce(F.col(f"{name}__first.origin"), F.lit(0.0))
        average = F.when(exact, numeric.mean_from_sums(n, total, decimals)).otherwise(
            origin + apart / count)
        rough = F.greatest(apart2 - apart * apart / count, F.lit(0.0)) / (count - 1)
        variance = F.when(exact, numeric.variance_from_sums(
            n, total, squares, decimals)).otherwise(F.when(n > 1, rough))
        stats[mean] = round_half_away(F.when(known, average), places)
        stats[deviation] = round_half_away(F.when(known, F.sqrt(variance)), places)
        normed[norm] = round_half_away(F.when(
            F.col(deviation) > 0, (F.col(name) - F.col(mean)) / F.col(deviation)
        ), places)
    used = [*sums, *kinds, *[f"{name}__exact" for name in values]]
    return df.withColumns(stats).withColumns(normed).drop(*used)


def phase_expanding_stats(df: DataFrame, layout: Layout = WHOLE, **also) -> DataFrame:
    """Expanding statistics of vertical velocity and acceleration, in feet and metres."""
    added = {
        "velocity_z_fts": ("velocity_mean_fts", "velocity_std_fts", "velocity_norm_fts",
                           VELOCITY_PLACES),
        "velocity_z_ms": ("velocity_mean_ms", "velocity_std_ms", "velocity_norm_ms",
                          VELOCITY_PLACES),
        "acceleration_fts2": ("acceleration_mean_fts2", "acceleration_std_fts2",
                              "acceleration_norm_fts2", ACCELERATION_PLACES),
        "acceleration_ms2": ("acceleration_mean_ms2", "acceleration_std_ms2",
                             "acceleration_norm_ms2", ACCELERATION_PLACES),
    }
    df = expanding_stats(df, layout, PHASE, FLIGHT_ORDER, added, **also)
    results = [c for *names, _ in added.values() for c in names]
    return df.withColumns({c: _for_phases(F.col(c)) for c in results})

