"""Packet tables, flight lists and documents written earlier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytrace.functions import clock
from skytrace.functions.telemetry import RELAY_EXCLUDED
from skytrace.schemas import FLIGHTS, PACKET_COLUMNS
from skytrace.session import scratch_path

# The packet columns in a PostGIS database, the point split into two numbers.
DATABASE_PACKETS = (
    "select tm, callsign, raw, bearing, speed_mph, altitude, "
    "st_y(location2d) as latitude, st_x(location2d) as longitude from {table}"
)


def read_packets(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet packet table; one written by ``write_packet_table`` prunes by day."""
    return spark.read.parquet(path)


def database_packets(spark: SparkSession, url: str, days: Sequence[str], table: str = "packets",
                     properties: dict[str, str] | None = None,
                     fetch_rows: int = 10_000) -> DataFrame:
    """Packets of the given days read by JDBC, one query and task per day.

    Only the columns in use and the hours of the day window leave the database, which finds them
    by the leading ``tm`` of its primary key. Rows arrive ``fetch_rows`` at a time.
    """
    query = f"({DATABASE_PACKETS.format(table=table)}) as p"
    settings = {"fetchsize": str(fetch_rows)} | (properties or {})
    return spark.read.jdbc(url, query, predicates=day_predicates(days), properties=settings)


def day_predicates(days: Sequence[str], excluded_text: str = RELAY_EXCLUDED) -> list[str]:
    """One SQL condition per day: its window, without excluded texts."""
    opens, closes, zone = clock.WINDOW_OPENS, clock.WINDOW_CLOSES, clock.HOME_ZONE
    return [
        f"tm > timestamp '{day} {opens}' at time zone '{zone}' and "
        f"tm < timestamp '{day} {closes}' at time zone '{zone}' and "
        f"raw not like '%{excluded_text}%'"
        for day in days
    ]


def read_flights(spark: SparkSession, path: str) -> DataFrame:
    """A flight list: a JSON array of records, every scalar a text."""
    return spark.read.schema(FLIGHTS).option("multiLine", True).json(path)


def read_flight_documents(spark: SparkSession, path: str) -> DataFrame:
    """Metadata of all flights written as JSON documents, without their packets, by name."""
    documents = spark.read.option("recursiveFileLookup", True).json(path)
    extra = [c for c in ("packets", "part") if c in documents.columns]
    first = documents.where(F.col("part") == 0) if "part" in documents.columns else documents
    return first.drop(*extra).orderBy(F.lower("flight"))


def array_texts(spark: SparkSession, path: str) -> DataFrame:
    """The records, one text each, of a JSON array written by ``write_json_array``."""
    lines = spark.read.text(path)
    return lines.select(F.regexp_extract("value", r"(?s)^\[?(\{.*\})[,\]]$", 1).alias("value")).where(
        F.col("value") != "")


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    """The records of a JSON array as columns: the union of their fields, nested ones too.

    The texts are written as lines, whose schema Spark merges from those of its tasks.
    """
    folder = scratch_path(spark, "records")
    array_texts(spark, path).write.text(folder)
    return spark.read.json(folder)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder; ``path`` may be a pattern."""
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).limit(
            0).collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def with_day(packets: DataFrame) -> DataFrame:
    """Add the local day of receipt, the partition column of a packet table."""
    return packets.withColumn("day", F.to_date(F.from_utc_timestamp("tm", clock.HOME_ZONE)))


def write_packet_table(packets: DataFrame, path: str) -> None:
    """Packets partitioned by local day and sorted by callsign, so that both keys of the flight
    join skip files and row groups."""
    (
        with_day(packets).select(*PACKET_COLUMNS, "day")
        .repartition("day", "callsign").sortWithinPartitions("day", "callsign", "tm")
        .write.mode("overwrite").partitionBy("day").parquet(path)
    )
