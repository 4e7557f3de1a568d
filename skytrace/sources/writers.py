"""Results as CSV, JSON, Parquet, workbook tables and map features."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytrace.operators import features
from skytrace.operators.columns import flat_columns, flatten, map_key_names, published
from skytrace.operators.kinematics import FLIGHT_ORDER
from skytrace.operators.numbering import numbered
from skytrace.schemas import FLIGHTS
from skytrace.session import shuffles_dropped, written
from skytrace.sources import readers

# Formats and the time format of JSON documents.
KINDS = ("csv", "json", "parquet", "xlsx", "kml", "all")
CONSOLIDATED_KINDS = ("csv", "json", "xlsx", "all")
JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSS"
JSON_OPTIONS = {"ignoreNullFields": "false", "timestampNTZFormat": JSON_TIME}

# Most packets in one JSON document; a longer flight continues in further documents.
PART_PACKETS = 50_000

# Most records in one file of a JSON array; a longer array continues in further files.
ARRAY_ROWS = 100_000

# A run replaces the folders of its own flights only.
RERUN = {"partitionOverwriteMode": "dynamic"}

# Most flights with a folder each; the tables of a run with more hold many flights in one folder,
# because a file and its commit cost far more than the rows of a flight.
FOLDER_FLIGHTS = 1_000

# Folders of such a table. Fixed: a later run must find its flights in the same ones.
GROUP = "flight_group"
GROUPS = 64

CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"'}


def _per_day(packets: DataFrame, *order: str) -> DataFrame:
    """Packets with the day they were sent."""
    return packets.withColumn("day", F.to_date("packettime")).sortWithinPartitions(
        "day", "flight", *order)


def _per_flight(df: DataFrame, *order: str) -> DataFrame:
    """Lower-case flight names as folder names, rows of a file in order."""
    return df.withColumn("flight", F.lower("flight")).sortWithinPartitions("flight", *order)


def more_flights(df: DataFrame, than: int = FOLDER_FLIGHTS) -> bool:
    """Whether ``df`` holds more than so many flights."""
    return df.select(F.lower("flight")).distinct().limit(than + 1).count() > than


def folders(spark: SparkSession, path: str, many: bool) -> str:
    """How the table at ``path`` is split: as an earlier run has, else by the number of flights."""
    if readers.exists(spark, f"{path}/{GROUP}=*"):
        return "group"
    return "group" if many and not readers.exists(spark, f"{path}/*=*") else "flight"


def _named(name: str) -> Column:
    """A column by its whole name, dots and backticks in it too."""
    return F.col("`" + name.replace("`", "``") + "`")


def _with_earlier(rows: DataFrame, earlier: DataFrame, key: str) -> DataFrame:
    """``rows`` and what earlier runs have left of other flights in the folders to be replaced.

    These are the folders of the flights of ``rows``, or all if the columns are not the same.
    """
    own = rows.select(F.col(key).alias("own"), F.col(GROUP).alias("own_group")).distinct()
    if set(earlier.columns) == set(rows.columns):
        earlier = earlier.join(own.select("own_group").distinct(),
                               F.col(GROUP) == F.col("own_group"), "left_semi")
    others = earlier.join(own, F.col(key).eqNullSafe(F.col("own")), "left_anti")
    # What is read is about to be replaced.
    return written(rows.unionByName(others, allowMissingColumns=True), "regrouped")


def _per_group(df: DataFrame, path: str, earlier: Callable[[str], DataFrame], order: Sequence[str],
               inner: Sequence[str] = (), key: str = "flight") -> DataFrame:
    """Rows with the lower-case name of their flight, ``key``, and its hash, which is their folder;
    each folder in order of flight. AQE splits what is too large for one task."""
    name = F.lower("flight")
    rows = df.select(
        *[_named(c) for c in df.columns if c != key], name.alias(key),
        F.pmod(F.xxhash64(name), F.lit(GROUPS)).cast("int").alias(GROUP))
    if readers.exists(df.sparkSession, f"{path}/{GROUP}=*"):
        rows = _with_earlier(rows, earlier(path), key)
    return rows.hint("rebalance", GROUP).sortWithinPartitions(GROUP, *inner, key, *order)


def _write_parquet(df: DataFrame, path: str, by: str, order: Sequence[str] = (),
                   inner: Sequence[str] = ()) -> None:
    """A table in folders of one flight each, or with ``by="group"`` of many."""
    if by == "group":
        rows = _per_group(df, path, df.sparkSession.read.parquet, order, inner)
    else:
        rows = _per_flight(df, *inner, *order)
    with shuffles_dropped(df.sparkSession):
        rows.write.mode("overwrite").options(**RERUN).partitionBy(
            GROUP if by == "group" else "flight", *inner).parquet(path)


def _write_grouped_csv(df: DataFrame, path: str, order: Sequence[str], key: str,
                       time_format: str, **options) -> None:
    """A CSV table in folders of many flights; the lower-case name of its flight, ``key``, is a
    row's last field."""
    def texts(rows: DataFrame) -> DataFrame:
        return rows.select(*[
            _named(c) if c == GROUP
            else (F.date_format(_named(c), time_format) if kind == "timestamp_ntz"
                  else _named(c).cast("string")).alias(c) for c, kind in rows.dtypes])

    spark = df.sparkSession
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", True)
    # Rows are smaller than their texts in a shuffle; what an earlier run has left is texts.
    if readers.exists(spark, f"{path}/{GROUP}=*"):
        rows = _per_group(texts(df), path, reader.csv, order, key=key)
    else:
        rows = texts(_per_group(df, path, reader.csv, order, key=key))
    with shuffles_dropped(spark):
        rows.write.mode("overwrite").options(**RERUN, **CSV_OPTIONS, **options).partitionBy(
            GROUP).csv(path)


def write_packets_csv(packets: DataFrame, path: str, by: str = "flight") -> None:
    """Packets of each flight in its own folder, standard columns, with a header; with
    ``by="group"`` of many flights in each folder."""
    if by == "group":
        _write_grouped_csv(packets, path, FLIGHT_ORDER, "flight", "yyyy-MM-dd HH:mm:ss.SSS")
        return
    _per_flight(packets, *FLIGHT_ORDER).write.mode("overwrite").options(**RERUN).partitionBy(
        "flight").option(
        "header", True).option("quote", '"').option("escape", '"').option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSS").csv(path)


def write_packets_parquet(packets: DataFrame, path: str, by: str = "flight") -> None:
    """Packets of each flight in its own folder, or of each day with ``by="day"`` or of many flights
    with ``by="group"``, which keep the number of folders small when there are very many flights."""
    if by == "day":
        _per_day(packets, *FLIGHT_ORDER).write.mode("overwrite").partitionBy(by).parquet(path)
    else:
        _write_parquet(packets, path, by, FLIGHT_ORDER)


def write_metadata_csv(metadata: DataFrame, path: str, per_flight: bool = False,
                       by: str = "flight") -> None:
    """Flattened records with dotted column names; quotes doubled, nulls empty.

    In folders of one flight each if ``per_flight``, of many flights if also ``by="group"``.
    """
    flat = flatten(metadata)
    if per_flight and by == "group":
        _write_grouped_csv(flat, path, (), "folder", JSON_TIME, emptyValue="")
        return
    writer = (
        _per_flight(flat.withColumn("flight_id", F.col("flight")))
        .withColumnRenamed("flight", "folder").withColumnRenamed("flight_id", "flight")
        .write.partitionBy("folder").options(**RERUN) if per_flight else flat.orderBy(F.lower("flight")).write
    )
    writer.mode("overwrite").option("header", True).option("quote", '"').option(
        "escape", '"').option("emptyValue", "").csv(path)


def json_records(df: DataFrame) -> Column:
    """A whole row as JSON text, nulls written out."""
    return F.to_json(F.struct(*df.columns), JSON_OPTIONS)


def write_metadata_json(metadata: DataFrame, path: str) -> None:
    """One JSON record per line, in order of flight name."""
    ordered = metadata.orderBy(F.lower("flight"))
    ordered.select(json_records(metadata).alias("value")).write.mode("overwrite").text(path)


def write_json_array(texts: DataFrame, path: str, order: Sequence[Column],
                     file_rows: int = ARRAY_ROWS) -> None:
    """Rows with a JSON text ``value`` as one JSON array, a record a line, in ``order``.

    The position of a record says what stands around it: the opening bracket before the first, a
    comma behind each, the closing bracket behind the last. So files are written in parallel; up to
    ``file_rows`` records make one file, more of them several that are the array one after the other.
    """
    spark = texts.sparkSession
    rows = numbered(texts.select("value", *[c.alias(f"o{i}") for i, c in enumerate(order)]),
                    [F.col(f"o{i}") for i in range(len(order))], "place", "records")
    first = rows.select("records").first()
    if first is None:
        spark.createDataFrame([("[]",)], "value string").coalesce(1).write.mode(
            "overwrite").text(path)
        return
    files = -(-first.records // file_rows)
    opened = F.when(F.col("place") == 0, "[").otherwise("")
    closed = F.when(F.col("place") == F.col("records") - 1, "]").otherwise(",")
    lines = rows.select("place", F.concat(opened, "value", closed).alias("value"))
    placed = lines.repartitionByRange(files, "place") if files > 1 else lines.coalesce(1)
    placed.sortWithinPartitions("place").select("value").write.mode("overwrite").text(path)


def consolidate(metadata: DataFrame, path: str) -> DataFrame:
    """Merge records into the JSON array at ``path``: flights of earlier runs stay, those of this
    run are replaced. Returns all records read back, with the union of their fields."""
    spark = metadata.sparkSession
    texts = metadata.select("flight", json_records(metadata).alias("value"))
    if readers.exists(spark, path):
        earlier = readers.array_texts(spark, path).select(
            F.get_json_object("value", "$.flight").alias("flight"), "value")
        own = texts.select(F.lower("flight").alias("own")).distinct()
        texts = earlier.join(own, F.lower("flight") == F.col("own"), "left_anti").unionByName(texts)
    # What is read is about to be replaced.
    write_json_array(written(texts, "consolidated"), path, [F.lower("flight"), F.col("flight"),
                                                            F.col("value")])
    return readers.read_json_array(spark, path)


def flight_documents(metadata: DataFrame, packets: DataFrame,
                     part_packets: int = PART_PACKETS) -> DataFrame:
    """Metadata with an array of packets, per flight, as JSON texts.

    Each flight has document 0. A flight of more than ``part_packets`` rows continues in further
    documents that repeat the metadata, so no record grows without bound and no packet is left out.
    Rows must carry ``row_no``.
    """
    return document_texts(flight_records(metadata, packets, part_packets))


def document_texts(records: DataFrame) -> DataFrame:
    """Documents with their text as ``value`` in place of the record."""
    return records.withColumn("value", F.to_json("value", JSON_OPTIONS))


def flight_records(metadata: DataFrame, packets: DataFrame,
                   part_packets: int = PART_PACKETS) -> DataFrame:
    """The records that ``flight_documents`` makes texts of."""
    columns = [c for c in packets.columns if c not in ("flight", "row_no")]
    parts = packets.groupBy(
        "flight", F.floor(F.col("row_no") / part_packets).cast("bigint").alias("part")
    ).agg(F.array_sort(F.collect_list(F.struct("row_no", *columns))).alias("rows"))
    bare = F.transform("rows", lambda r: F.struct(*[r[c].alias(c) for c in columns]))
    record = [F.col(c) for c in metadata.columns]
    whole = F.struct(*record, F.col("part"), bare.alias("packets"))
    return metadata.join(parts, "flight").select("flight", "part", whole.alias("value"))


def _document_rows(spark: SparkSession, path: str) -> DataFrame:
    """Documents in folders of many flights, with the flight and part that they are of."""
    return spark.read.text(path).select(
        F.get_json_object("value", "$.part").cast("bigint").alias("part"), "value",
        F.lower(F.get_json_object("value", "$.flight")).alias("flight"), GROUP)


def write_records(records: DataFrame, path: str, by: str = "flight") -> None:
    """Texts of the records, one folder per flight, or with ``by="group"`` for many flights, packed
    by gzip: the names of the fields in every packet are most of a text."""
    if by == "group":
        spark = records.sparkSession
        earlier = partial(_document_rows, spark)
        # Records are smaller than their texts in a shuffle; what an earlier run has left is texts.
        if readers.exists(spark, f"{path}/{GROUP}=*"):
            rows = _per_group(document_texts(records), path, earlier, ["part"])
        else:
            rows = document_texts(_per_group(records, path, earlier, ["part"]))
        with shuffles_dropped(spark):
            rows.select("value", GROUP).write.mode("overwrite").options(**RERUN).partitionBy(
                GROUP).text(path, compression="gzip")
        return
    _per_flight(document_texts(records), "part").select("flight", "value").write.mode("overwrite").options(
        **RERUN).partitionBy("flight").text(path)


def write_documents(metadata: DataFrame, packets: DataFrame, path: str, by: str = "flight") -> None:
    """JSON documents of all flights."""
    write_records(flight_records(metadata, packets), path, by)


def key_value_rows(metadata: DataFrame) -> DataFrame:
    """The flattened record of each flight as rows of name and text."""
    maps = {
        f.name: map_key_names(metadata, f.name) for f in metadata.schema.fields
        if isinstance(f.dataType, T.MapType)
    }
    flat = flat_columns(metadata, maps)
    pairs = F.array(*[
        F.struct(F.lit(name).alias("name"), flat[name].cast("string").alias("value"))
        for name in sorted(flat)
    ])
    return metadata.select("flight", F.explode(pairs).alias("pair")).select("flight", "pair.*")


def write_workbook_tables(metadata: DataFrame, packets: DataFrame, path: str,
                          folder_flights: int = FOLDER_FLIGHTS) -> None:
    """The three sheets of a flight workbook as tables: metadata, ascent, descent.

    A phase without rows has no table. More than ``folder_flights`` flights share folders.
    """
    spark, many = metadata.sparkSession, more_flights(metadata, folder_flights)
    sheet, phases = f"{path}/metadata", f"{path}/phases"
    _write_parquet(key_value_rows(metadata), sheet, folders(spark, sheet, many), ["name"])
    _write_parquet(packets, phases, folders(spark, phases, many), FLIGHT_ORDER, ["flight_phase"])


def write_features(tracked: DataFrame, path: str, many: bool = False) -> None:
    """Map features: headings, paths, waypoints and points of interest; ``many`` flights share
    folders."""
    tables = {
        "captions": features.captions(tracked),
        "paths": features.paths(tracked),
        "waypoints": features.waypoints(tracked),
        "points": features.points_of_interest(tracked),
    }
    for name, table in tables.items():
        _write_parquet(table, f"{path}/{name}", folders(
            tracked.sparkSession, f"{path}/{name}", many))


def flat_flight_list(flights: DataFrame, weight_names: Sequence[str] | None = None) -> DataFrame:
    """Flight list as flat columns: beacons as JSON text, dotted parachute and weight names.

    Without ``weight_names`` every name in use gets a column.
    """
    names = map_key_names(flights, "weights") if weight_names is None else weight_names
    chute = FLIGHTS["parachute"].dataType.fieldNames()
    return flights.select(
        "flight", F.to_json("beacons").alias("beacons"), "day", "balloonsize", "liftfactor",
        "h2fill",
        *[F.col(f"parachute.{c}").alias(f"parachute.{c}") for c in chute],
        *[F.try_element_at("weights", F.lit(n)).alias(f"weights.{n}") for n in names],
    )


def write_flight_list_csv(flights: DataFrame, path: str,
                          weight_names: Sequence[str] | None = None) -> None:
    """Flat flight list, every text quoted."""
    flat_flight_list(flights, weight_names).write.mode("overwrite").option("header", True).option(
        "quoteAll", True).option("escape", '"').csv(path)


def write_outputs(results, path: str, kind: str = "all", flight_count: int | None = None,
                  folder_flights: int = FOLDER_FLIGHTS) -> None:
    """Write the results of a run in one of ``KINDS``.

    Consolidated metadata comes with several flights, and with every kind that holds metadata; it
    takes along the flights that earlier runs have left at ``path``. Per-flight outputs of other
    flights stay as they are. More than ``folder_flights`` flights share folders, each table's rows
    in order of flight; a table is split as the run that began it has split it.
    """
    if kind not in KINDS:
        raise ValueError(f"unknown kind of output {kind!r}, expected one of {KINDS}")

    def wanted(name: str) -> bool:
        return kind in (name, "all")

    spark, many = results.metadata.sparkSession, more_flights(results.metadata, folder_flights)

    def by(table: str) -> str:
        return folders(spark, f"{path}/{table}", many)

    if wanted("csv"):
        write_packets_csv(results.packets, f"{path}/csv/packets", by("csv/packets"))
        write_metadata_csv(results.metadata, f"{path}/csv/metadata", True, by("csv/metadata"))
    if wanted("json"):
        numbered = published(results.tracked, "row_no")
        write_documents(results.metadata, numbered, f"{path}/json/flights", by("json/flights"))
    if wanted("parquet"):
        write_packets_parquet(results.packets, f"{path}/parquet", by("parquet"))
    if wanted("xlsx"):
        write_workbook_tables(results.metadata, results.packets, f"{path}/xlsx", folder_flights)
    if wanted("kml"):
        write_features(results.tracked, f"{path}/kml", many)

    several = flight_count is None or flight_count > 1
    if (several or kind in CONSOLIDATED_KINDS) and not results.metadata.isEmpty():
        merged = consolidate(results.metadata, f"{path}/json/flights_metadata")
        write_metadata_csv(merged, f"{path}/csv/flights_metadata")
        flatten(merged).orderBy(F.lower("flight")).write.mode("overwrite").parquet(
            f"{path}/xlsx/flights_metadata")
