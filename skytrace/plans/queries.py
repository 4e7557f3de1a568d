"""Registered queries: every operator over the whole tables of a data folder.

Flights are derived from ``events`` (``skytrace.sources.events``). Users are counted first, and
those with too many events for one task go through the time-sliced arrangement.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytrace.functions import clock
from skytrace.functions.numeric import round_half_away
from skytrace.operators import (
    columns, extract, features, kinematics, metadata, phases, polyfit, regimes, trim,
)
from skytrace.operators.numbering import numbered
from skytrace.operators.layout import (
    DEFAULT_SERIES_ROWS, DEFAULT_SLICE_MS, Layout, balanced,
)
from skytrace.plans import flight as plan
from skytrace.schemas import OUTPUT_COLUMNS, TRAILING_COLUMNS
from skytrace.session import configure, packed, scratch_path, written
from skytrace.sources import events as source
from skytrace.sources import readers, writers

Step = Callable[[DataFrame, Layout], DataFrame]
ROW = ["flight", "callsign", "packettime"]
CURVES = ["velocity_curvefit_fts", "velocity_curvefit_ms"]
#: Width of a slice in the queries that slice every user.
SLICED_MS = 6 * 3_600_000


def over_events(spark: SparkSession, sf_dir: str, step: Step,
                series_rows: int = DEFAULT_SERIES_ROWS,
                slice_ms: int = DEFAULT_SLICE_MS) -> DataFrame:
    """Run a step over all events, oversized users apart."""
    configure(spark)
    return balanced(source.read_events(spark, sf_dir), "user_id", step, series_rows, slice_ms)


# Steps -----------------------------------------------------------------------------------------

def _matched(events: DataFrame, layout: Layout) -> DataFrame:
    return extract.match_packets(source.packets(events, layout), source.flights(events))


def _extracted(events: DataFrame, layout: Layout) -> DataFrame:
    return extract.parse_packets(extract.earliest_payloads(_matched(events, layout)))


def _deltas(events: DataFrame, layout: Layout) -> DataFrame:
    return kinematics.beacon_deltas(
        kinematics.placed_positions(_extracted(events, layout), layout), layout)


def _apex(events: DataFrame, layout: Layout) -> DataFrame:
    return trim.apex(_deltas(events, layout), layout)


def _no_stragglers(events: DataFrame, layout: Layout) -> DataFrame:
    return trim.cut_stragglers(_apex(events, layout), layout)


def _no_outliers(events: DataFrame, layout: Layout) -> DataFrame:
    return trim.eject_outliers(_no_stragglers(events, layout))


def _averages(events: DataFrame, layout: Layout) -> DataFrame:
    return trim.flight_averages(_no_outliers(events, layout), layout)


def _phases(events: DataFrame, layout: Layout) -> DataFrame:
    return plan.phase_rows(_extracted(events, layout), layout)


def _tracked(events: DataFrame, layout: Layout) -> DataFrame:
    return plan.tracked_rows(_extracted(events, layout), layout)


def _metadata(events: DataFrame, layout: Layout) -> DataFrame:
    extracted = _extracted(events, layout)
    return metadata.flight_metadata(
        source.flights(events), extracted, plan.tracked_rows(extracted, layout))


def _status(events: DataFrame, layout: Layout) -> DataFrame:
    extracted = _extracted(events, layout)
    return metadata.flight_status(
        source.flights(events), extracted, plan.followed_rows(extracted, layout))


def _numbered(events: DataFrame, layout: Layout) -> DataFrame:
    return layout.place(
        events.select("user_id", "event_id", "ts", "value"), ["user_id"],
        clock.epoch_millis(F.col("ts")), ("ts", F.col("event_id")))


def _curved(events: DataFrame, layout: Layout) -> DataFrame:
    """Tracked rows with their fitted curves."""
    # Fits and rows meet again, so the rows are written once rather than computed twice.
    rows = packed(_tracked(events, layout), "tracked")
    return polyfit.with_curves(rows, plan.fitted(rows, layout))


# Queries ---------------------------------------------------------------------------------------

def telemetry_extract(events, layout):
    return extract.parse_packets(source.packets(events, layout))


def beacon_window_join(events, layout):
    return _matched(events, layout).withColumn("tm", F.col("tm").cast("timestamp_ntz"))


def distinct_on_earliest(events, layout):
    return extract.earliest_payloads(_matched(events, layout)).select(
        "flight", "info", F.col("tm").cast("timestamp_ntz").alias("tm"), "callsign", "raw")


def position_filter(events, layout):
    rows = kinematics.flag_positions(kinematics.complete_rows(_extracted(events, layout)))
    return rows.select(*ROW, "info", "altitude_ft", "latitude", "longitude", "position_packet")


def dedupe_packettime(events, layout):
    return kinematics.placed_positions(_extracted(events, layout), layout).select(
        *ROW, "receivetime", "info")


def flight_callsigns(events, layout):
    return kinematics.flight_callsigns(kinematics.complete_rows(_extracted(events, layout)))


def beacon_velocity(events, layout):
    return _deltas(events, layout).select(
        *ROW, "timedelta_s", "velocity_x_degs", "velocity_y_degs", "velocity_z_fts",
        "velocity_z_ms", "vert_rate_ftmin")


def air_density(events, layout):
    return kinematics.air_density(_extracted(events, layout)).select(
        "flight", "info", "pressure_pa", "temperature_k", "airdensity_slugs", "airdensity_kgm3")


def apex_flag(events, layout):
    return _apex(events, layout).select(*ROW, "row_no", "apex_ft", "apex_m", "ascending")


def straggler_trim(events, layout):
    return _no_stragglers(events, layout).select(*ROW, "row_no", "timedelta_s", "altitude_ft")


def outlier_eject(events, layout):
    return _no_outliers(events, layout).select(*ROW, "row_no", "velocity_z_fts", "ascending")


def forward_avg(events, layout):
    return _averages(events, layout).select(*ROW, "row_no", "forward_avg", "long_forward_avg")


def forward_avg_events(events, layout):
    return trim.forward_averages(
        _numbered(events, layout), layout, ["user_id"], ["ts", "event_id"], "value",
        {"mean_3": 3, "mean_10": 10},
    ).select("user_id", "event_id", "mean_3", "mean_10")


def launch_landing(events, layout):
    rows = trim.trim(trim.launch_and_landing(_averages(events, layout), layout))
    return rows.select(*ROW, "row_no", "flight_rows", "altitude_ft")


def flight_status(events, layout):
    return _status(events, layout)


def outcome_counts(events, layout):
    return _status(events, layout).select("flight", "status")


def phase_elapsed_distance(events, layout):
    return phases.phase_line(_phases(events, layout), layout).select(
        *ROW, "flight_phase", "phase_row", "elapsed_secs", "distance_to_line",
        "distance_from_launch_mi", "distance_from_launch_km")


def acceleration(events, layout):
    return phases.acceleration(_phases(events, layout), layout).select(
        *ROW, "flight_phase", "acceleration_fts2", "acceleration_ms2")


def expanding_stats(events, layout):
    rows = phases.phase_expanding_stats(
        phases.acceleration(_phases(events, layout), layout), layout)
    return rows.select(*ROW, *[
        f"{what}_{stat}_{unit}" for what, units in
        (("velocity", ("fts", "ms")), ("acceleration", ("fts2", "ms2")))
        for unit in units for stat in ("mean", "std", "norm")
    ])


def expanding_stats_events(events, layout):
    return phases.expanding_stats(
        _numbered(events, layout), layout, ["user_id"], ["ts", "event_id"],
        {"value": ("running_mean", "running_std", "running_norm", 8)},
    ).select("user_id", "event_id", "running_mean", "running_std", "running_norm")


def reynolds_regimes(events, layout):
    return regimes.regimes(phases.phase_line(_phases(events, layout), layout), layout).select(
        *ROW, "flight_phase", "phase_row", "airflow", "reynolds_transition")


def transition_list(events, layout):
    rows = regimes.regimes(phases.phase_line(_phases(events, layout), layout), layout)
    lists = regimes.transition_lists(rows)
    return lists.select("flight", F.posexplode_outer("reynolds_transitions")).select(
        "flight", F.col("pos").cast("bigint").alias("pos"), "col.transition",
        "col.altitude_ft", "col.altitude_m")


def vmr_degree(events, layout):
    spread = polyfit.velocity_spread(_phases(events, layout))
    return spread.select("flight", "flight_phase", *[
        round_half_away(F.col(f"{unit}_{c}"), 9).alias(f"{unit}_{c}")
        for unit in ("fts", "ms") for c in ("mean", "variance", "vmr")
    ], "fts_n", "fts_degree", "ms_degree")


def polyfit_curve(events, layout):
    pairs = sorted({c for pair in polyfit.PAIRS.values() for c in pair})
    # Fits and rows meet again, so the rows are written once rather than computed twice.
    rows = written(_phases(events, layout).select(*ROW, "flight_phase", *pairs), "phases")
    curved = polyfit.with_curves(rows, plan.fitted(rows, layout))
    return curved.select(*ROW, "flight_phase", *CURVES)


def polyfit_line(events, layout):
    fitted = polyfit.fits(_phases(events, layout), layout, max_degree=1)
    level, rise = F.get("fts_terms", F.lit(0)), F.get("fts_terms", F.lit(1))
    slope = rise["weight"] / F.col("fts_half")
    start = level["weight"] - rise["weight"] * level["shift"] - slope * F.col("fts_middle")
    return fitted.select(
        "flight", "flight_phase", round_half_away(slope, 9).alias("slope"),
        round_half_away(start, 6).alias("intercept"))


def burst_altitude(events, layout):
    bursts = extract.burst_altitudes(_extracted(events, layout))
    return bursts.select("flight", metadata.detected_burst(F.col("burst_ft")).alias("b")).select(
        "flight", "b.*")


def flight_summary(events, layout):
    summary = metadata.flight_summary(_tracked(events, layout))
    return columns.flatten(summary, {})


def metadata_flatten(events, layout):
    return columns.flatten(_metadata(events, layout), {"weights": [
        f"{name}_{unit}" for name in source.WEIGHTS for unit in ("lb", "kg")]})


def unit_weights(events, layout):
    lists = metadata.converted_flights(source.flights(events))
    return lists.select("flight", "parachute.*", F.explode("weights").alias("weight", "amount"))


def flight_list_flat(events, layout):
    return writers.flat_flight_list(source.flights(events), source.WEIGHTS)


def diagonal_union(events, layout):
    return columns.diagonal_union([
        events.where("event_type = 'purchase'").select("event_id", "user_id", "value"),
        events.where("event_type = 'click'").select("event_id", "ts", "user_id"),
        events.where("event_type is null or event_type not in ('purchase', 'click')").select(
            "event_id", "event_type"),
    ])


def waypoints_nearest(events, layout):
    return features.waypoints(_tracked(events, layout))


def flight_paths(events, layout):
    return features.path_vertices(_tracked(events, layout))


def path_texts(events, layout):
    return features.paths(_tracked(events, layout)).select(
        "flight", "flight_phase", "part", "name", "colour", "vertices", "coordinates")


def points_of_interest(events, layout):
    return features.points_of_interest(_tracked(events, layout))


def flight_captions(events, layout):
    return features.captions(_tracked(events, layout))


def column_order(events, layout):
    return columns.published(_curved(events, layout))


def dst_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daylight-saving test for every order date."""
    configure(spark)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    days = orders.select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.select(
        F.date_format("day", "yyyy-MM-dd").alias("day"),
        clock.is_daylight_time(F.col("day")).alias("daylight_time"))


STEPS: dict[str, Step] = {
    step.__name__: step for step in (
        telemetry_extract, beacon_window_join, distinct_on_earliest, position_filter,
        dedupe_packettime, flight_callsigns, beacon_velocity, air_density, apex_flag,
        straggler_trim, outlier_eject, forward_avg, forward_avg_events, launch_landing,
        flight_status, phase_elapsed_distance, acceleration, expanding_stats,
        expanding_stats_events, reynolds_regimes, transition_list, vmr_degree, polyfit_curve,
        polyfit_line, burst_altitude, flight_summary, metadata_flatten, unit_weights,
        flight_list_flat, diagonal_union, waypoints_nearest, flight_paths, path_texts,
        points_of_interest, flight_captions, column_order,
    )
}


# Sinks: written to the shared folder and read back ---------------------------------------------

def _standard(stored: DataFrame, like: DataFrame) -> DataFrame:
    """All published columns of packets read back, in their own types."""
    types = dict(like.dtypes)
    return stored.select(*[F.col(c).cast(types[c]).alias(c)
                           for c in (*OUTPUT_COLUMNS, *TRAILING_COLUMNS)])


def _split(spark: SparkSession, sf_dir: str) -> str:
    """How a new table of packets is split into folders: by the number of listed flights."""
    listed = source.flights(source.read_events(spark, sf_dir))
    return "group" if writers.more_flights(listed, writers.FOLDER_FLIGHTS) else "flight"


def sink_roundtrip_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "parquet")
    packets = over_events(spark, sf_dir, column_order)
    writers.write_packets_parquet(packets, path, _split(spark, sf_dir))
    return _standard(spark.read.parquet(path), packets)


def sink_roundtrip_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    packets = over_events(spark, sf_dir, column_order)
    writers.write_packets_csv(packets, path, _split(spark, sf_dir))
    # The flight names a folder, or is the last field.
    schema = packets.select(*packets.drop("flight").columns, "flight").schema
    reader = spark.read.schema(schema).option("header", True).option("escape", '"')
    stored = reader.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSS").csv(path)
    # An empty text comes back from CSV as null.
    return _standard(stored.na.fill("", TRAILING_COLUMNS), packets)


def sink_roundtrip_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json")
    published = []

    def documents(events, layout):
        # Packets and records read both, so both are written once rather than computed twice.
        extracted = packed(_extracted(events, layout), "extracted")
        rows = packed(plan.tracked_rows(extracted, layout), "tracked")
        add_curves = polyfit.with_curves if layout.sliced else polyfit.with_curves_by_flight
        packets = columns.published(add_curves(rows, plan.fitted(rows, layout)), "row_no")
        published.append(packets.drop("flight", "row_no"))
        return writers.flight_records(
            metadata.flight_metadata(source.flights(events), extracted, rows), packets)

    writers.write_records(over_events(spark, sf_dir, documents), path, _split(spark, sf_dir))
    # Types are known, so texts are read once; times are texts in a document.
    fields = ", ".join(f"{c} {'string' if kind == 'timestamp_ntz' else kind}"
                       for c, kind in published[0].dtypes)
    stored = spark.read.schema(f"packets array<struct<{fields}>>").options(
        recursiveFileLookup=True, mode="FAILFAST").json(path)
    packets = stored.select(F.explode("packets").alias("p")).select("p.*")
    return _standard(packets, published[0])


def metadata_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consolidated metadata: all fields of documents read back without their packets."""
    path = scratch_path(spark, "metadata")
    writers.write_metadata_json(over_events(spark, sf_dir, _metadata), path)
    return columns.flatten(readers.read_flight_documents(spark, path))


# From declared inputs to outputs ---------------------------------------------------------------

def _declared(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A packet table by day and a flight list in JSON, written from the events and read."""
    configure(spark)
    events = source.read_events(spark, sf_dir)
    packets, flights = scratch_path(spark, "packet_table"), scratch_path(spark, "flight_list")
    readers.write_packet_table(source.packets(events), packets)
    records = source.flights(events)
    writers.write_json_array(
        records.select(F.to_json(F.struct("*")).alias("value"), "flight"), flights,
        [F.col("flight")])
    return readers.read_packets(spark, packets), readers.read_flights(spark, flights)


def declared_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packet table and flight list through the complete job."""
    return plan.process(*_declared(spark, sf_dir)).packets


def packet_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packets of listed flights from a table that is pruned by day."""
    found = extract.match_packets(*_declared(spark, sf_dir))
    return found.withColumn("tm", F.col("tm").cast("timestamp_ntz"))


def flight_list_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flight list as flat columns, with the weight names found in it."""
    return writers.flat_flight_list(_declared(spark, sf_dir)[1])


def named_flight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packets of one flight, asked for by its name in lower case."""
    packets, flights = _declared(spark, sf_dir)
    first = flights.select(F.lower(F.min("flight")).alias("name")).first().name
    found = extract.match_packets(packets, extract.flight_named(flights, first))
    return found.withColumn("tm", F.col("tm").cast("timestamp_ntz"))


def sink_metadata_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened records written as CSV and read back in their types."""
    path = scratch_path(spark, "csv")
    records = written(over_events(spark, sf_dir, _metadata), "metadata")
    writers.write_metadata_csv(records, path)
    flat = columns.flatten(records)
    reader = spark.read.schema(flat.schema).option("header", True).option("escape", '"')
    return reader.csv(path)


def sink_workbook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first sheet of every flight's workbook: names and texts."""
    path = scratch_path(spark, "xlsx")
    results = plan.process(*_declared(spark, sf_dir))
    writers.write_workbook_tables(results.metadata, results.packets, path)
    return spark.read.parquet(f"{path}/metadata").select("name", "value", "flight")


def sink_workbook_phases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packets on the ascent and descent sheets."""
    path = scratch_path(spark, "xlsx")
    results = plan.process(*_declared(spark, sf_dir))
    writers.write_workbook_tables(results.metadata, results.packets, path)
    return _standard(spark.read.parquet(f"{path}/phases"), results.packets)


def consolidated_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consolidated JSON array after a run over half of the flights and one over them all, in
    several files, with the place of each record."""
    path = scratch_path(spark, "array")
    records = written(over_events(spark, sf_dir, _metadata), "metadata")
    even = F.pmod(F.regexp_extract("flight", "([0-9]+)", 1).cast("bigint"), F.lit(2)) == 0
    writers.consolidate(records.where(even), path)
    merged = columns.flatten(writers.consolidate(records, path))
    # Lines of an ordered array come in the order of its files.
    lines = spark.read.text(path).select(
        F.get_json_object(F.regexp_extract("value", r"(\{.*\})", 1), "$.flight").alias("flight"),
        F.monotonically_increasing_id().alias("line"))
    places = numbered(lines, [F.col("line")], "place").drop("line")
    return merged.join(places, "flight")


#: Every table that a run leaves.
OUTPUT_TABLES = ["csv/packets", "csv/metadata", "json/flights", "parquet", "xlsx/metadata",
                 "xlsx/phases", "kml/captions", "kml/paths", "kml/waypoints", "kml/points",
                 "json/flights_metadata", "csv/flights_metadata", "xlsx/flights_metadata"]


def output_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table that the kind of output ``all`` holds."""
    path = scratch_path(spark, "outputs")
    writers.write_outputs(plan.process(*_declared(spark, sf_dir)), path, "all")
    sizes = []
    for table in OUTPUT_TABLES:
        reader = {"csv": spark.read.option("header", True).option("multiLine", True).option(
            "escape", '"').csv, "json": spark.read.text}.get(
            table.split("/")[0], spark.read.parquet)
        sizes.append(reader(f"{path}/{table}").agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit("all").alias("kind"), F.lit(table).alias("table"), "rows"))
    return columns.diagonal_union(sizes)


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights per outcome."""
    return metadata.outcome_counts(over_events(spark, sf_dir, outcome_counts))


TABLES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dst_offset": dst_offset,
    "outcome_counts": outcomes,
    "sink_roundtrip_parquet": sink_roundtrip_parquet,
    "sink_roundtrip_csv": sink_roundtrip_csv,
    "sink_roundtrip_json": sink_roundtrip_json,
    "metadata_documents": metadata_documents,
    **{query.__name__: query for query in (
        declared_inputs, packet_table_scan, flight_list_read, named_flight, sink_metadata_csv,
        sink_workbook, sink_workbook_phases, consolidated_array, output_tables,
    )},
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name to query."""
    def bind(step: Step):
        return lambda spark, sf_dir: over_events(spark, sf_dir, step)

    def bind_sliced(step: Step):
        # Every user goes through the time-sliced arrangement.
        return lambda spark, sf_dir: over_events(spark, sf_dir, step, 0, SLICED_MS)

    sliced = {f"{step.__name__}_sliced": bind_sliced(step) for step in (
        forward_avg_events, expanding_stats_events, flight_status, column_order)}
    return {**{name: bind(step) for name, step in STEPS.items()}, **sliced, **TABLES}
