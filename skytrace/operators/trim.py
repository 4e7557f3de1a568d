"""From the merged packets of a flight to the part between launch and landing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytrace.functions.numeric import round_half_away, scaled
from skytrace.operators.kinematics import FLIGHT_ORDER, counted, lose, series_of, survivors
from skytrace.operators.layout import WHOLE, Layout

# Thresholds of the trimming rules (feet, seconds, feet per second).
LOW_ALTITUDE = 8000.0
STRAGGLER_GAP = 500.0
FASTEST_ASCENT = 50.0
SINKING_ASCENT = -5.0
RISING_DESCENT = 5.0
CLIMBING = 5.0
SETTLED = -5.0
SHORT_AVERAGE = 3
LONG_AVERAGE = 10


def apex(df: DataFrame, layout: Layout = WHOLE, keep_lost: bool = False) -> DataFrame:
    """Add the row number, the first highest row of the flight and ``ascending`` up to it."""
    highest = F.struct((-F.col("altitude_ft")).alias("depth"), *FLIGHT_ORDER, "altitude_m")
    df = layout.scan(df, series_of(keep_lost, "flight"), FLIGHT_ORDER, index="row_no",
                     size="flight_rows", totals={"apex": ("min", highest)})
    time, top = F.col("packettime"), F.col("apex.packettime")
    return counted(df, "position_rows", keep_lost).withColumns({
        "apex_ft": -F.col("apex.depth"),
        "apex_m": F.col("apex.altitude_m"),
        "ascending": (time < top)
        | ((time == top) & (F.col("callsign") <= F.col("apex.callsign"))),
    }).drop("apex")


def cut_stragglers(df: DataFrame, layout: Layout = WHOLE, keep_lost: bool = False) -> DataFrame:
    """Drop what follows the first low packet after a long gap on the way down.

    That packet itself stays.
    """
    late = (
        (F.col("timedelta_s") > STRAGGLER_GAP)
        & (F.col("altitude_ft") < LOW_ALTITUDE)
        & ~F.col("ascending")
    )
    df = layout.scan(df, series_of(keep_lost, "flight"), FLIGHT_ORDER,
                     totals={"last_row": ("min", F.when(late, F.col("row_no")))})
    df = lose(df, F.col("row_no") > F.col("last_row"), "straggler")
    return survivors(df, keep_lost).drop("last_row")


def eject_outliers(df: DataFrame, keep_lost: bool = False) -> DataFrame:
    """Drop packets with an impossible vertical velocity; unknown velocities stay."""
    speed = F.col("velocity_z_fts")
    possible = F.when(
        F.col("ascending"), (speed < FASTEST_ASCENT) & (speed > SINKING_ASCENT)
    ).otherwise(speed < RISING_DESCENT)
    return survivors(lose(df, ~possible, "outlier"), keep_lost)


def forward_averages(df: DataFrame, layout: Layout, part, order, value: str,
                     sizes: dict[str, int], places: int = 2, value_places: int = 8,
                     **also) -> DataFrame:
    """Means over a row and those after it; unknown values count as 0, short frames give null.

    Values of ``value_places`` decimals are added as whole numbers, others as they are.

    ``also`` adds further results of the same scan.
    """
    amount = F.coalesce(scaled(F.col(value), value_places), F.lit(0.0))
    df = layout.scan(df, part, order, ahead=(amount, sizes), **also)
    unit = float(10**value_places)
    return df.withColumns({
        name: round_half_away(F.col(name) / F.lit(k * unit), places) for name, k in sizes.items()
    })


def flight_averages(df: DataFrame, layout: Layout = WHOLE, keep_lost: bool = False) -> DataFrame:
    """Renumber the rows left and add the short and long forward mean of vertical velocity."""
    return counted(forward_averages(
        df, layout, series_of(keep_lost, "flight"), FLIGHT_ORDER, "velocity_z_fts",
        {"forward_avg": SHORT_AVERAGE, "long_forward_avg": LONG_AVERAGE},
        index="row_no", size="flight_rows",
    ), "filtered_rows", keep_lost)


def launch_and_landing(df: DataFrame, layout: Layout = WHOLE,
                       keep_lost: bool = False) -> DataFrame:
    """Add ``first_row`` (inclusive) and ``end_row`` (exclusive when anything is cut).

    Landing rows are not ascending, so they lie behind any launch row and need no second pass.
    """
    speed, short, long = (
        F.coalesce(F.col(c), F.lit(0.0))
        for c in ("velocity_z_fts", "forward_avg", "long_forward_avg")
    )
    low, row = F.col("altitude_ft") < LOW_ALTITUDE, F.col("row_no")
    leaving = (speed > 0) & (short > CLIMBING) & (long > CLIMBING) & F.col("ascending") & low
    down = (speed > SETTLED) & (short > SETTLED) & (long > SETTLED) & ~F.col("ascending") & low
    df = layout.scan(df, series_of(keep_lost, "flight"), FLIGHT_ORDER, totals={
        "launch_row": ("min", F.when(leaving, row)),
        "landing_row": ("min", F.when(down & (row > 0), row)),
    })
    last = F.col("flight_rows") - 1
    return df.withColumns({
        "first_row": F.coalesce(F.greatest(F.col("launch_row") - 1, F.lit(0)), F.lit(0)),
        "end_row": F.coalesce(F.least(F.col("landing_row") + 1, last), last),
    }).drop("launch_row", "landing_row")


def trim(df: DataFrame, keep_lost: bool = False) -> DataFrame:
    """Keep ``first_row`` up to before ``end_row``, or everything if neither end is cut."""
    row, first, end = F.col("row_no"), F.col("first_row"), F.col("end_row")
    cut = (first > 0) | (end < F.col("flight_rows") - 1)
    df = lose(df, cut & (row < first), "before_launch")
    df = survivors(lose(df, cut & (row >= end), "after_landing"), keep_lost)
    return df.withColumns({
        "row_no": row - first,
        "flight_rows": F.when(cut, end - first).otherwise(F.col("flight_rows")),
    }).drop("first_row", "end_row")
