"""Packets written for many flights and read back, over rows made here."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from skytrace.plans import queries
from skytrace.sources import writers


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Events of six flights, with equal times, statuses and copies."""
    path = str(tmp_path_factory.mktemp("tables"))
    rows = spark.range(6 * 60).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.floor(F.col("id") / 12) * 60).cast(
            "timestamp_ntz").alias("ts"),
        (F.col("id") % 6).alias("user_id"),
        F.when(F.col("id") % 14 == 3, "error").otherwise("click").alias("event_type"),
        F.col("id").cast("double").alias("value"), F.lit("{}").alias("props"))
    rows.write.parquet(f"{path}/events.parquet")
    return path


def written_by(monkeypatch, spark, folder, name, most):
    """Sorted rows of a query with at most ``most`` folders of one flight, its files, and the labels
    of the tables that it has written."""
    tables = []

    def noted(path):
        def scratch(session, label):
            tables.append((label, path(session, label)))
            return tables[-1][1]
        return scratch

    from skytrace import session
    monkeypatch.setattr(writers, "FOLDER_FLIGHTS", most)
    monkeypatch.setattr(queries, "scratch_path", noted(queries.scratch_path))
    monkeypatch.setattr(session, "scratch_path", noted(session.scratch_path))
    result = queries.registered()[name](spark, folder)
    rows = sorted(map(str, result.collect()))
    path = dict(tables)[name.rsplit("_", 1)[1]]
    monkeypatch.undo()
    files = [os.path.relpath(f, path) for f in glob.glob(f"{path}/*/part-*")]
    return result.dtypes, rows, files, [label for label, _ in tables]


@pytest.fixture(scope="module")
def expected(spark, folder):
    frame = queries.registered()["column_order"](spark, folder).drop("flight")
    return frame.dtypes, sorted(map(str, frame.collect()))


def check_folders(monkeypatch, spark, folder, expected, name):
    """The files and tables of a query for many flights; every row is that of the packets
    themselves."""
    *found, files, tables = written_by(monkeypatch, spark, folder, name, 2)
    assert len(expected[1]) > 100
    assert tuple(found) == expected
    assert {f.split("=")[0] for f in files} == {"flight_group"}
    return files, tables


def test_many_flights_share_parquet_folders(monkeypatch, spark, folder, expected):
    check_folders(monkeypatch, spark, folder, expected, "sink_roundtrip_parquet")


def test_many_documents_are_packed_and_made_once(monkeypatch, spark, folder, expected):
    files, tables = check_folders(monkeypatch, spark, folder, expected, "sink_roundtrip_json")
    assert all(f.endswith(".txt.gz") for f in files)
    assert sorted(tables) == ["extracted", "json", "tracked"]


def test_many_flights_share_csv_folders(monkeypatch, spark, folder, expected):
    check_folders(monkeypatch, spark, folder, expected, "sink_roundtrip_csv")
