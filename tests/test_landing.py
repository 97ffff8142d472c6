"""The landing area as a data source: windows, slices, streams and the inventory that follows one."""

import json
import os
from datetime import datetime
from pathlib import Path

import pytest

from tideline.context import RunContext
from tideline.operators.inventory import FILE_COUNTS, file_rollup
from tideline.sources import landing as source
from tideline.sources.landing import LandingStreamReader, TableSlice, landing, landing_stream
from tideline.sources.objects import object_listing, object_listing_by_folder
from tideline.sources.stores import arrow_uri, uri_prefix
from tideline.sources.versions import VersionedTable
from tideline.streaming.inventory import inventory_stream

CTX = RunContext(1, datetime(2024, 2, 1))
PARTS = ["table_name", "cda_schema_id", "cda_timestamp"]


def put(root, table, schema_id, folder, files):
    path = Path(root, table, schema_id, str(folder))
    path.mkdir(parents=True, exist_ok=True)
    for number in range(files):
        (path / f"part-{number}.snappy.parquet").write_bytes(b"x" * (number + 1))
    (path / "_SUCCESS").write_bytes(b"")


def publish(root, **marks):
    entries = {name.upper(): {"cda_folder": mark and str(mark)} for name, mark in marks.items()}
    Path(root, "manifest.json").write_text(json.dumps(entries))


@pytest.fixture
def area(tmp_path):
    root = str(tmp_path / "drop")
    for folder in (1, 2, 3):
        put(root, "pc_a", "s1", folder, 2)
    put(root, "pc_a", "s2", 3, 1)
    put(root, "pc_b", "s1", 10, 3)
    put(root, "pc_b", "s1", "not_a_time", 3)
    put(root, "pc_empty", "s1", 4, 0)
    publish(root, pc_a=3, pc_b=10, pc_c=None)
    return root


def rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*(columns or frame.columns)).collect())


def test_files_are_those_of_the_plain_listing(spark, area):
    plain = object_listing(spark, area).collect()
    known = {(r["object_key"].removeprefix("file:"), r["size_bytes"]) for r in plain if "not_a_time" not in r["object_key"]}
    found = landing(spark, area)
    assert {(r["object_key"], r["size_bytes"]) for r in found.collect()} == known
    assert found.columns == ["object_key", "size_bytes", "last_modified", *PARTS]
    assert rows(file_rollup(found, CTX, "s", "pc"), *PARTS, "file_count") == [
        ("pc_a", "s1", "1", 2), ("pc_a", "s1", "2", 2), ("pc_a", "s1", "3", 2), ("pc_a", "s2", "3", 1), ("pc_b", "s1", "10", 3),
    ]
    tables = spark.createDataFrame([(f"{area}/{t}",) for t in ("pc_a", "pc_b")], "folder string")
    times = {r["object_key"]: r["last_modified"] for r in object_listing_by_folder(tables).collect()}
    assert all(times[r["object_key"]] == r["last_modified"] for r in found.collect())


def test_window_by_table(spark, area):
    found = landing(spark, area, {"pc_a": 1}, {"pc_a": 2, "pc_b": 9, "missing": 5}, level="folders")
    assert rows(found) == [("pc_a", "s1", "2")]
    assert rows(landing(spark, area, {"pc_a": 2, "pc_b": 10}, level="folders")) == [
        ("pc_a", "s1", "3"), ("pc_a", "s2", "3"), ("pc_empty", "s1", "4"),
    ]
    assert rows(landing(spark, area, {"pc_a": None}, {"pc_a": 1, "pc_b": None}, level="folders")) == [("pc_a", "s1", "1")]


@pytest.mark.parametrize("slices", [1, 2, 7])
def test_slices_part_the_folders(spark, area, slices):
    found = landing(spark, area, slices=slices)
    assert rows(found) == rows(landing(spark, area))
    assert found.rdd.getNumPartitions() == 3 * slices


def test_folders_outside_the_window_are_not_opened(spark, area):
    closed = Path(area, "pc_a", "s1", "1")
    share = TableSlice("pc_a", 1, 3, 0, 1)
    opened = []

    def spy(store, path):
        opened.append(path)
        return keep(store, path)

    keep, source.data_file_infos = source.data_file_infos, spy
    try:
        batches = list(source.rows_of(area, "files", share))
        assert opened and str(closed) not in opened
        assert sum(b.num_rows for b in batches) == 5
        opened.clear()
        assert sum(b.num_rows for b in source.rows_of(area, "folders", share)) == 3
        assert not opened
    finally:
        source.data_file_infos = keep


def test_large_folders_are_sent_on_in_batches(area, monkeypatch):
    monkeypatch.setattr(source, "FILES_PER_BATCH", 4)
    put(area, "pc_big", "s1", 1, 10)
    batches = list(source.rows_of(area, "files", TableSlice("pc_big", 0, None, 0, 1)))
    assert [b.num_rows for b in batches] == [4, 4, 2]
    for folder in range(2, 8):
        put(area, "pc_big", "s1", folder, 0)
    assert [b.num_rows for b in source.rows_of(area, "folders", TableSlice("pc_big", 0, None, 0, 1))] == [4, 3]


def test_an_area_without_tables_and_wrong_options(spark, tmp_path, area):
    (tmp_path / "none").mkdir()
    assert landing(spark, str(tmp_path / "none")).collect() == []
    assert landing(spark, area, high={}).collect() == []
    for options, text in (({"level": "rows"}, "files or folders"), ({"slices": 0}, "one at least")):
        with pytest.raises(Exception, match=text):
            landing(spark, area, **options).collect()


def run_stream(spark, root, state, sink):
    def keep(batch, number):
        batch.write.mode("append").parquet(sink)

    query = (
        landing_stream(spark, root).writeStream.foreachBatch(keep).option("checkpointLocation", state).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def test_stream_reads_every_complete_folder_once(spark, area, tmp_path):
    state, sink = str(tmp_path / "state"), str(tmp_path / "sink")
    publish(area, pc_a=2, pc_b=None)
    run_stream(spark, area, state, sink)
    assert rows(spark.read.parquet(sink), *PARTS) == [("pc_a", "s1", "1")] * 2 + [("pc_a", "s1", "2")] * 2
    put(area, "pc_a", "s9", 2, 1)  # below the mark by now
    publish(area, pc_a=3, pc_b=10)
    run_stream(spark, area, state, sink)
    run_stream(spark, area, state, sink)
    batch = landing(spark, area, high={"pc_a": 3, "pc_b": 10}).where("cda_schema_id != 's9'")
    assert rows(spark.read.parquet(sink)) == rows(batch)


def test_a_manifest_that_goes_back_fails_the_stream(spark, area, tmp_path):
    state, sink = str(tmp_path / "state"), str(tmp_path / "sink")
    run_stream(spark, area, state, sink)
    for marks in ({"pc_a": 2, "pc_b": 10}, {"pc_a": 3}):
        publish(area, **marks)
        with pytest.raises(Exception, match="is behind what was read"):
            run_stream(spark, area, state, sink)
    assert spark.read.parquet(sink).count() == 10


def test_stream_partitions_are_the_tables_that_moved(area):
    reader = LandingStreamReader(area, "files", 2)
    assert reader.initialOffset() == {} and reader.latestOffset() == {"pc_a": 3, "pc_b": 10}
    moved = reader.partitions({"pc_a": 2, "pc_b": 10}, reader.latestOffset())
    assert [(s.table, s.low, s.high, s.part) for s in moved] == [("pc_a", 2, 3, 0), ("pc_a", 2, 3, 1)]
    os.remove(Path(area, "manifest.json"))
    assert reader.latestOffset() == {}


def test_inventory_stream_gives_the_rollup_of_the_batch_read(spark, area, tmp_path):
    counts = VersionedTable(spark, str(tmp_path / "counts"))
    publish(area, pc_a=2, pc_b=10)
    for marks in ({"pc_a": 2, "pc_b": 10}, {"pc_a": 3, "pc_b": 10}):
        publish(area, **marks)
        inventory_stream(spark, area, counts, "s", "pc", str(tmp_path / "state"), CTX).awaitTermination()
    whole = file_rollup(landing(spark, area), CTX, "s", "pc")
    names = [f.split()[0] for f in FILE_COUNTS.split(", ")]
    assert rows(counts.read(), *names) == rows(whole, *names)


def test_schemes_of_spark_connectors():
    assert arrow_uri("s3a://bucket/x") == "s3://bucket/x" and arrow_uri("/data/x") == "/data/x"
    assert arrow_uri("hdfs://host/x") == "hdfs://host/x"
    assert uri_prefix("s3a://bucket/x/", "bucket/x") == "s3a://" and uri_prefix("/data/x", "/data/x") == ""
