"""The complete processing of flights, step by step and as one job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytrace.functions.clock import epoch_millis
from skytrace.operators import extract, kinematics, metadata, phases, polyfit, regimes, trim
from skytrace.operators.columns import published
from skytrace.operators.layout import (
    DEFAULT_SERIES_ROWS, DEFAULT_SLICE_MS, WHOLE, Layout, oversized_keys, spread,
)
from skytrace.session import configure, written


def extract_packets(packets: DataFrame, flights: DataFrame) -> DataFrame:
    """Parsed packets of the listed flights, one copy of each payload."""
    return extract.parse_packets(
        extract.earliest_payloads(extract.match_packets(packets, flights)))


def trimmed_rows(extracted: DataFrame, layout: Layout = WHOLE,
                 keep_lost: bool = False) -> DataFrame:
    """Merged position packets with velocities, cut to the time between launch and landing."""
    df = kinematics.stow(kinematics.placed_positions(extracted, layout))
    df = kinematics.beacon_deltas(df, layout)
    df = trim.apex(df, layout, keep_lost)
    df = trim.cut_stragglers(df, layout, keep_lost)
    df = trim.eject_outliers(df, keep_lost)
    df = trim.flight_averages(df, layout, keep_lost)
    df = trim.launch_and_landing(df, layout, keep_lost)
    return trim.trim(df, keep_lost)


def phase_rows(extracted: DataFrame, layout: Layout = WHOLE) -> DataFrame:
    """Trimmed rows of usable flights, split into ascent and descent."""
    return phases.usable_flights(phases.split_phases(trimmed_rows(extracted, layout), layout))


def followed_rows(extracted: DataFrame, layout: Layout = WHOLE) -> DataFrame:
    """Rows left after trimming, with the numbers of rows before, and of every flight that lost all
    its rows in a step the first one with the reason."""
    return phases.split_phases(trimmed_rows(extracted, layout, True), layout, True)


def tracked_rows(extracted: DataFrame, layout: Layout = WHOLE) -> DataFrame:
    """All per-packet results but the fitted curves. One shuffle for flights of usual size."""
    return _tracked(phase_rows(extracted, layout), layout)


def tracked_again(followed: DataFrame, layout: Layout = WHOLE) -> DataFrame:
    """``tracked_rows`` from followed rows that have been written."""
    kept = phases.usable_flights(followed.where(F.col("fate") == kinematics.KEPT)).drop(
        "position_rows", "filtered_rows")
    return _tracked(layout.place(kept, ["flight"], epoch_millis(F.col("packettime"))), layout)


def _tracked(rows: DataFrame, layout: Layout) -> DataFrame:
    df = phases.phase_motion(rows, layout)
    df = phases.phase_expanding_stats(df, layout, totals=regimes.extremes())
    return kinematics.air_density(kinematics.unload(regimes.label_regimes(df)))


def fitted(tracked: DataFrame, layout: Layout = WHOLE) -> DataFrame:
    """Velocity fits of tracked rows that have been written; only the columns needed move."""
    columns = {c for pair in polyfit.PAIRS.values() for c in pair}
    narrow = tracked.select(*phases.PHASE, "packettime", *sorted(columns))
    placed = layout.place(narrow, ["flight"], epoch_millis(F.col("packettime")))
    return polyfit.fits(placed, layout)


@dataclass(frozen=True)
class Results:
    """What a run produced; the extracted and the tracked rows below it are written tables."""

    extracted: DataFrame
    tracked: DataFrame
    packets: DataFrame
    metadata: DataFrame
    status: DataFrame


def process(packets: DataFrame, flights: DataFrame, series_rows: int = DEFAULT_SERIES_ROWS,
            slice_ms: int = DEFAULT_SLICE_MS) -> Results:
    """Process all flights in one job.

    The extracted and the tracked packets, the fits and the flight records are written to the
    shared folder once, because several results and every sink read them: a lost executor costs the
    current stage only.
    """
    configure(packets.sparkSession)
    extracted = written(extract_packets(packets, flights), "extracted")

    heavy = oversized_keys(extracted, "flight", series_rows)
    # Trimming runs once: the status counts all rows, everything else has those kept.
    followed = written(spread(extracted, "flight", heavy, followed_rows, slice_ms), "followed")
    rows = written(spread(followed, "flight", heavy, tracked_again, slice_ms), "tracked")
    fits = written(spread(rows, "flight", heavy, fitted, slice_ms), "fits")
    tracked = polyfit.with_curves(rows, fits)
    records = written(metadata.flight_metadata(flights, extracted, rows), "metadata")
    return Results(
        extracted=extracted,
        tracked=tracked,
        packets=published(tracked),
        metadata=records,
        status=metadata.flight_status(flights, extracted, followed),
    )
