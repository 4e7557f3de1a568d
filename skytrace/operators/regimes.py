"""Airflow regimes of the ascent, found from its distance to a straight climb."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytrace.operators.kinematics import FLIGHT_ORDER
from skytrace.operators.layout import WHOLE, Layout
from skytrace.operators.phases import ASCENDING, PHASE

# Labels and thresholds of the regime rules (feet).
HIGH, LOW, UNKNOWN = "high Re", "low Re", "n/a"
CLEAR_DISTANCE = 30.0
LOWEST_ALTITUDE = 10000.0


def extremes() -> dict[str, tuple[str, Column]]:
    """Totals of a scan by phase: the ascent rows farthest below and above the straight climb, if
    clear of it, the first of equal distances."""
    distance, row = F.col("distance_to_line"), F.col("phase_row")
    eligible = (F.col("flight_phase") == ASCENDING) & (F.col("altitude_ft") > LOWEST_ALTITUDE)
    below = F.struct((-distance).alias("size"), row.alias("row"))
    above = F.struct(distance.alias("size"), row.alias("row"))
    return {
        "max_point": ("min", F.when(eligible & (distance > CLEAR_DISTANCE), below)),
        "min_point": ("min", F.when(eligible & (distance < -CLEAR_DISTANCE), above)),
    }


def _label(row: Column) -> Column:
    """Regime at a phase row: it changes at each turning point, and a lone or later maximum opens
    a high regime, a lone or later minimum a low one."""
    hi, lo = F.col("max_point.row"), F.col("min_point.row")
    latest = F.greatest(F.when(row >= hi, hi), F.when(row >= lo, lo))
    return (
        F.when(hi.isNull() & lo.isNull(), F.lit(UNKNOWN))
        .when(latest.isNotNull(), F.when(latest == hi, F.lit(HIGH)).otherwise(F.lit(LOW)))
        .when(hi.isNotNull() & (lo.isNull() | (hi < lo)), F.lit(LOW))
        .otherwise(F.lit(HIGH))
    )


def _word(label: Column) -> Column:
    return F.split_part(label, F.lit(" "), F.lit(1))


def label_regimes(df: DataFrame) -> DataFrame:
    """From the ``extremes`` of a scan add ``airflow`` and, on the first row of a new regime,
    ``reynolds_transition``.

    The label of the row before follows from its row number, so no window is needed.
    """
    row, up = F.col("phase_row"), F.col("flight_phase") == ASCENDING
    here, before = _label(row), _label(row - 1)
    changed = (row > 0) & (here != before) & (here != UNKNOWN) & (before != UNKNOWN)
    return df.withColumns({
        "airflow": F.when(up, here).otherwise(F.lit(UNKNOWN)),
        "reynolds_transition": F.when(
            up & changed, F.concat_ws("_to_", _word(before), _word(here))
        ).otherwise(F.lit("")),
    }).drop("max_point", "min_point")


def regimes(df: DataFrame, layout: Layout = WHOLE) -> DataFrame:
    """Airflow labels and transitions, for rows that have their distance to the straight climb."""
    return label_regimes(layout.scan(df, PHASE, FLIGHT_ORDER, totals=extremes()))


def transition_rows(df: DataFrame) -> DataFrame:
    """The rows on which a new regime begins."""
    return df.where(F.col("reynolds_transition") != "")


def transitions() -> Column:
    """Aggregate: the transitions of a flight in time order, an empty array if there are none.

    A flight has at most two, so the arrays stay short.
    """
    point = F.struct("row_no", F.col("reynolds_transition").alias("transition"),
                     "altitude_ft", "altitude_m")
    found = F.collect_list(F.when(F.col("reynolds_transition") != "", point))
    return F.transform(
        F.array_sort(found),
        lambda p: F.struct(p.altitude_ft.alias("altitude_ft"), p.altitude_m.alias("altitude_m"),
                           p.transition.alias("transition")),
    )


def transition_lists(df: DataFrame) -> DataFrame:
    """The transitions of each flight."""
    return df.groupBy("flight").agg(transitions().alias("reynolds_transitions"))
