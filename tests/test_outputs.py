"""Everything a run writes, read back."""

import dataclasses
import json
import os
import re

import pytest
from pyspark.sql import functions as F

from skytrace.operators import columns, extract
from skytrace.operators.numbering import numbered
from skytrace.plans import flight as plan
from skytrace.session import scratch_path
from skytrace.sources import events as source
from skytrace.sources import readers, writers


@pytest.fixture(scope="module")
def results(events):
    some = events.where("user_id < 4")
    return plan.process(source.packets(some), source.flights(some))


def test_all_outputs(spark, results):
    path = scratch_path(spark, "all")
    writers.write_outputs(results, path, "all")
    packets = results.packets.orderBy("flight", "packettime", "callsign").collect()

    stored = spark.read.parquet(f"{path}/parquet")
    assert set(stored.columns) == set(results.packets.columns)
    assert stored.count() == len(packets)
    assert {r.flight for r in stored.select("flight").distinct().collect()} == {
        r.flight.lower() for r in packets}

    writers.write_packets_parquet(results.packets, f"{path}/days", by="day")
    days = spark.read.parquet(f"{path}/days")
    assert days.count() == len(packets)
    assert {str(r.day) for r in days.select("day").distinct().collect()} == {
        str(r.packettime.date()) for r in packets}

    csv = spark.read.schema(columns.published(results.tracked).drop("flight").schema).option(
        "header", True).option("escape", '"').csv(f"{path}/csv/packets")
    same = csv.orderBy("flightid", "packettime", "callsign").select("raw", "velocity_z_fts", "info")
    assert [tuple(r) for r in same.collect()] == [(r.raw, r.velocity_z_fts, r.info) for r in packets]

    documents = spark.read.option("recursiveFileLookup", True).text(f"{path}/json/flights").collect()
    assert len(documents) == results.metadata.count()
    for text in documents:
        document = json.loads(text.value)
        mine = [p for p in packets if p.flight == document["flight"]]
        assert document["numpoints"] == len(document["packets"]) == len(mine)
        assert [p["raw"] for p in document["packets"]] == [p.raw for p in mine]
        first = document["packets"][0]
        assert first["packettime"] == mine[0].packettime.strftime("%Y-%m-%dT%H:%M:%S.000")
        assert first["acceleration_fts2"] is None and "velocity_std_ms" in first
        assert "distance_from_launch_mi" not in document["launch_location"]
        assert "distance_from_launch_mi" in document["landing_location"]

    flat = spark.read.option("header", True).option("escape", '"').csv(f"{path}/csv/flights_metadata")
    assert flat.columns == sorted(flat.columns) and "weights.client_kg" in flat.columns
    assert flat.count() == results.metadata.count()
    one = spark.read.option("header", True).option("escape", '"').csv(
        f"{path}/csv/metadata/folder=fl-1")
    assert one.count() == 1 and json.loads(one.first()["beacons"]) == ["B1-0", "B1-1"]

    merged = readers.read_flight_documents(spark, f"{path}/json/flights")
    assert "packets" not in merged.columns
    assert [r.flight for r in merged.collect()] == sorted(
        (r.flight for r in results.metadata.collect()), key=str.lower)

    sheet = spark.read.parquet(f"{path}/xlsx/phases")
    assert {r.flight_phase for r in sheet.select("flight_phase").distinct().collect()} == {
        "ascending", "descending"}
    pairs = spark.read.parquet(f"{path}/xlsx/metadata").where("flight = 'fl-2'")
    assert dict(pairs.select("name", "value").collect())["parachute.description"] == "Dome"
    for table in ("captions", "paths", "waypoints", "points"):
        assert spark.read.parquet(f"{path}/kml/{table}").count() > 0


def test_long_documents_continue(results):
    packets = columns.published(results.tracked, "row_no")
    parts = writers.flight_documents(results.metadata, packets, part_packets=20)
    seen = {}
    for r in parts.orderBy("flight", "part").collect():
        document = json.loads(r.value)
        assert document["part"] == r.part and len(document["packets"]) <= 20
        seen.setdefault(r.flight, []).extend(p["info"] for p in document["packets"])
    for flight, infos in seen.items():
        expected = packets.where(F.col("flight") == flight).orderBy("row_no").select("info")
        assert infos == [r.info for r in expected.collect()]


def test_unknown_kind(results):
    with pytest.raises(ValueError):
        writers.write_outputs(results, "/nowhere", "pdf")


def test_packet_table_prunes_by_day(spark, events):
    some = events.where("user_id < 3")
    packets, flights = source.packets(some), source.flights(some)
    path = scratch_path(spark, "packets")
    readers.write_packet_table(packets, path)
    table = readers.read_packets(spark, path)
    assert table.count() == packets.count()
    stored = plan.extract_packets(table, flights)
    assert stored.count() == plan.extract_packets(packets, flights).count()
    text = stored._jdf.queryExecution().toString()
    assert "dynamicpruning" in text.lower()


def test_scan_skips_days_no_flight_flew(spark, events, tmp_path):
    some = events.where("user_id < 3")
    packets, flights = source.packets(some), source.flights(some)
    path = str(tmp_path / "packets")
    readers.write_packet_table(packets.unionByName(packets.withColumn(
        "tm", F.col("tm") + F.expr("interval 400 days"))), path)
    table, one = readers.read_packets(spark, path), flights.where("flight = 'FL-1'")
    found = extract.match_packets(table, one)
    plan_text = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan_text and "GreaterThan(tm," in plan_text
    filters = re.findall(r"PartitionFilters: (.*?) PushedFilters", plan_text)
    assert any("day" in f and ">=" in f and "<=" in f for f in filters)
    # Files of other days may be gone: no scan looks into them.
    days = {str(r.day) for r in found.select(F.to_date(F.from_utc_timestamp(
        "tm", "America/Denver")).alias("day")).distinct().collect()}
    expected = found.count()
    for folder in os.listdir(path):
        if folder.startswith("day=") and folder[4:] not in days:
            for name in os.listdir(f"{path}/{folder}"):
                open(f"{path}/{folder}/{name}", "w").close()
    again = spark.read.schema(table.schema).parquet(path)
    assert extract.match_packets(again, one).count() == expected > 0


def test_flight_list(spark, events, tmp_path):
    flights = source.flights(events.where("user_id < 9"))
    path = tmp_path / "flights.json"
    records = [json.loads(r) for r in flights.toJSON().collect()]
    path.write_text(json.dumps(records))
    read = readers.read_flights(spark, str(path))
    assert sorted(map(str, read.collect())) == sorted(map(str, flights.collect()))
    out = str(tmp_path / "list")
    writers.write_flight_list_csv(read, out, source.WEIGHTS)
    back = spark.read.option("header", True).option("escape", '"').csv(out)
    assert back.columns[:8] == ["flight", "beacons", "day", "balloonsize", "liftfactor", "h2fill",
                                "parachute.description", "parachute.size"]
    assert len(back.columns) == 15 and back.count() == 9


def array_of(path):
    """The JSON array that the files of a folder make, one after the other."""
    files = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    return files, json.loads("".join(open(os.path.join(path, f)).read() for f in files))


@pytest.mark.parametrize("rows, file_rows", [(0, 10), (1, 10), (57, 100), (57, 10), (57, 1)])
def test_json_array_in_files(spark, tmp_path, rows, file_rows):
    path = str(tmp_path / "array")
    texts = spark.createDataFrame([((i * 7) % 57, json.dumps({"n": (i * 7) % 57, "t": "[x],\n{"}))
                                   for i in range(rows)], "n int, value string").repartition(5)
    writers.write_json_array(texts, path, [F.col("n")], file_rows)
    files, records = array_of(path)
    assert [r["n"] for r in records] == list(range(rows))
    assert len(files) >= min(rows // file_rows, 20) and (rows > file_rows or len(files) == 1)
    if rows:
        back = readers.read_json_array(spark, path)
        assert sorted(r.n for r in back.collect()) == list(range(rows))
    assert readers.array_texts(spark, path).count() == rows


def test_rerun_of_some_flights(spark, results):
    """Two halves one after the other, the second with a flight of the first, against one run."""
    one, two = scratch_path(spark, "one"), scratch_path(spark, "two")
    writers.write_outputs(results, one, "all")

    def part(names):
        keep = F.lower("flight").isin(names)
        return dataclasses.replace(results, **{
            name: getattr(results, name).where(keep)
            for name in ("extracted", "tracked", "packets", "metadata", "status")})

    names = sorted({r.flight.lower() for r in results.metadata.collect()})
    stale = part(names[:2])
    stale = dataclasses.replace(stale, metadata=stale.metadata.withColumn("h2fill", F.lit("old")))
    writers.write_outputs(stale, two, "all")
    writers.write_outputs(part(names[1:]), two, "all")

    merged = array_of(f"{two}/json/flights_metadata")[1]
    expected = array_of(f"{one}/json/flights_metadata")[1]
    assert [r["flight"] for r in merged] == [r["flight"] for r in expected]
    assert merged[0]["h2fill"] == "old" and merged[1:] == expected[1:]
    for table in ("parquet", "xlsx/phases", "xlsx/metadata", "kml/points"):
        assert spark.read.parquet(f"{two}/{table}").count() == spark.read.parquet(
            f"{one}/{table}").count()
    stored = spark.read.parquet(f"{two}/xlsx/flights_metadata")
    assert {r.flight: r.h2fill == "old" for r in stored.collect()}[merged[0]["flight"]]


def test_records_with_different_fields_are_merged(spark, results):
    path = scratch_path(spark, "fields")
    names = sorted(r.flight for r in results.metadata.collect())
    first = results.metadata.where(F.col("flight") == names[0])
    writers.consolidate(first.withColumn("weights", F.create_map(
        F.lit("a b_lb"), F.lit(1.5))).withColumn("extra", F.lit(7)), path)
    merged = writers.consolidate(results.metadata.where(F.col("flight") != names[0]), path)
    flat = columns.flatten(merged)
    assert {"extra", "weights.a b_lb", "weights.client_kg"} <= set(flat.columns)
    rows = {r.flight: r for r in flat.collect()}
    assert set(rows) == set(names)
    assert rows[names[0]]["extra"] == 7 and rows[names[1]]["extra"] is None
    assert rows[names[0]]["weights.client_kg"] is None


def test_numbers_without_one_task(spark):
    frame = spark.range(1000).selectExpr("(id * 37) % 1000 as v", "id as place__other").repartition(9)
    out = numbered(frame, [F.col("v").desc()], "place", "total").collect()
    assert all(r.place == 999 - r.v and r.total == 1000 for r in out)
    assert numbered(frame.where("false"), [F.col("v")]).count() == 0


def test_map_keys_are_a_union(spark):
    maps = [({"a`b": "1", "c d": None},), ({"OBJECT<x": "2"},), ({},), (None,)]
    frame = spark.createDataFrame(maps, "`m.n` map<string,string>").repartition(3)
    assert columns.map_key_names(frame, "m.n") == ["OBJECT<x", "a`b", "c d"]
    assert columns.map_key_names(frame.where("false"), "m.n") == []


def table(spark, path):
    if "/csv/" in path:
        return spark.read.option("header", True).option("escape", '"').option(
            "multiLine", True).csv(path)
    return spark.read.text(path) if "/json/" in path else spark.read.parquet(path)


PER_FLIGHT = ["csv/packets", "csv/metadata", "json/flights", "parquet", "xlsx/metadata",
              "xlsx/phases", "kml/captions", "kml/paths", "kml/waypoints", "kml/points"]


def contents(spark, path, name):
    """All rows of a table, without the columns that name folders."""
    read = table(spark, f"{path}/{name}")
    columns = sorted(set(read.columns) - {"flight_group", "folder"} - (
        {"flight"} if name == "json/flights" else set()))
    rows = read.select(*[F.col(f"`{c}`").cast("string") for c in columns]).collect()
    return columns, sorted(map(str, rows))


def test_many_flights_share_folders(spark, results):
    """Rows of all tables are those of a folder for each flight, in folders of a bounded number."""
    one, many = scratch_path(spark, "one"), scratch_path(spark, "many")
    writers.write_outputs(results, one, "all")
    writers.write_outputs(results, many, "all", folder_flights=1)
    for name in PER_FLIGHT:
        assert {f.split("=")[0] for f in os.listdir(f"{many}/{name}") if "=" in f} == {
            "flight_group"}, name
        assert contents(spark, many, name) == contents(spark, one, name), name

    # A second run of some flights replaces these only, and keeps to the folders of the first.
    def part(keep, **more):
        return dataclasses.replace(results, **{
            name: getattr(results, name).where(keep)
            for name in ("extracted", "tracked", "packets", "metadata", "status")} | more)

    first = results.metadata.agg(F.min("flight")).first()[0]
    again = scratch_path(spark, "again")
    writers.write_outputs(part(F.lit(True), packets=results.packets.withColumn(
        "raw", F.lit("old, \"text\"\nof two lines")),
        metadata=results.metadata.drop("h2fill")), again, "all", folder_flights=1)
    writers.write_outputs(part(F.col("flight") == first), again, "all")
    for name in PER_FLIGHT:
        columns, rows = contents(spark, again, name)
        expected_columns, expected = contents(spark, one, name)
        if name == "xlsx/metadata":  # the first run has no such field
            expected = [r for r in expected if "name='h2fill'" not in r or first.lower() in r]
        assert columns == expected_columns and len(rows) == len(expected), name
    stored = table(spark, f"{again}/csv/packets")
    assert {r.flightid for r in stored.where("raw not like 'old%'").select("flightid").distinct()
            .collect()} == {first}
    fill = table(spark, f"{again}/csv/metadata").where("h2fill is not null")
    assert [r.flight for r in fill.collect()] == [first]
