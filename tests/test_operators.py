"""Upserts, merges, paging, delivery, listings: rules, properties and plans."""

import random
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tideline.context import RunContext
from tideline.functions.arrays import or_empty
from tideline.jobs import archive_job, inventory_job, outbox_job, quota_job
from tideline.operators import inventory
from tideline.operators.history import latest_per_key
from tideline.operators.paging import page_rows
from tideline.operators.upsert import action_counts, merge_into, src, tgt, truncate, update_from, update_where, upsert
from tideline.plans import layers, load_plan
from tideline.plans.outbox import OutboxSource
from tideline.sources.manifest import read_manifest
from tideline.sources.objects import archive_candidates, object_listing, object_listing_by_folder, read_changes
from tideline.sources.replica import catalog_tables, column_metadata, read_tagged, union_tagged
from tideline.sources.versions import VersionedTable
from validation.check import plan_of

CTX = RunContext(2, datetime(2024, 2, 1))
KV = "k string, v int, w string"


def rows(frame, *names):
    return sorted((tuple(r) for r in frame.select(*names).collect()), key=repr)


# Upsert


def test_upsert_updates_inserts_and_counts(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], KV)
    source = spark.createDataFrame([("b", 9, "n"), ("c", 3, "z")], KV)
    merged = upsert(target, source, ["k"], update={"v": src("v")}, with_action=True)
    assert rows(merged, "k", "v", "w", "_action") == [("a", 1, "x", "keep"), ("b", 9, "y", "update"), ("c", 3, "z", "insert")]
    assert action_counts(merged).first().asDict() == {"rows_inserted": 1, "rows_updated": 1, "row_count": 2}


def test_upsert_condition_null_is_no_update(spark):
    target = spark.createDataFrame([("a", None, "x"), ("b", 5, "y"), ("c", 1, "z")], KV)
    source = spark.createDataFrame([("a", 9, "n"), ("b", 4, "n"), ("c", 4, "n")], KV)
    merged = upsert(target, source, ["k"], update={"v": src("v"), "w": src("w")}, update_when=tgt("v") < src("v"), with_action=True)
    assert rows(merged, "k", "v", "w", "_action") == [("a", None, "x", "match"), ("b", 5, "y", "match"), ("c", 4, "n", "update")]


def test_upsert_matches_names_in_any_case_and_fills_missing_columns(spark):
    target = spark.createDataFrame([("A", 1, "x")], KV)
    source = spark.createDataFrame([("a", 2), ("B", 3)], "k string, v int")
    merged = upsert(target, source, ["k"], update={"v": src("v")}, match=F.lower)
    assert rows(merged, "k", "v", "w") == [("A", 2, "x"), ("B", 3, None)]


def test_upsert_appends_to_an_array(spark):
    target = spark.createDataFrame([("a", None), ("b", ["x"])], "k string, r array<string>")
    source = spark.createDataFrame([("a", ["n"]), ("b", ["n"])], "k string, r array<string>")
    merged = upsert(target, source, ["k"], update={"r": F.concat(or_empty(tgt("r")), src("r"))})
    assert rows(merged, "k", "r") == [("a", ["n"]), ("b", ["x", "n"])]


@pytest.mark.parametrize(("extra", "message"), [(("b", 1, "q"), "repeated key"), ((None, 1, "q"), "null key")])
def test_upsert_refuses_unsound_sources(spark, extra, message):
    target = spark.createDataFrame([("a", 1, "x")], KV)
    source = spark.createDataFrame([("b", 9, "n"), extra], KV)
    with pytest.raises(Exception, match=message):
        upsert(target, source, ["k"], update={"v": src("v")}).collect()


def test_upsert_check_is_not_pruned_with_its_columns(spark):
    target = spark.createDataFrame([("a", 1, "x")], KV)
    source = spark.createDataFrame([("b", 9, "n"), ("b", 1, "q")], KV)
    with pytest.raises(Exception, match="repeated key"):
        upsert(target, source, ["k"], update={}).select(F.lit(1)).count()


def test_upsert_twice_is_once(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], KV)
    source = spark.createDataFrame([("b", 9, "n"), ("c", 3, "z")], KV)
    once = upsert(target, source, ["k"], update={"v": src("v")})
    assert rows(upsert(once, source, ["k"], update={"v": src("v")}), "k", "v", "w") == rows(once, "k", "v", "w")


def test_update_where_and_from_and_truncate(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", None, "y")], KV)
    assert rows(update_where(target, F.col("v") == 1, {"w": F.lit("new")}), "k", "w") == [("a", "new"), ("b", "y")]
    counts = spark.createDataFrame([("b", 7)], "k string, n int")
    assert rows(update_from(target, counts, ["k"], {"v": src("n")}), "k", "v") == [("a", 1), ("b", 7)]
    assert truncate(target).count() == 0 and truncate(target).schema == target.schema


def test_catalog_merge_reaches_the_table_format(spark):
    """Parquet tables refuse row-level writes; the statement itself must be sound up to there."""
    spark.createDataFrame([("a", 1, "x")], KV).write.mode("overwrite").saveAsTable("plain_target")
    source = spark.createDataFrame([("a", 2, "y")], KV)
    with pytest.raises(Exception, match="UNSUPPORTED_FEATURE.TABLE_OPERATION|does not support MERGE"):
        merge_into("plain_target", source, ["k"], update={"v": src("v")}, update_when=F.col("plain_target.v") < src("v"))


def test_upsert_source_check_costs_no_extra_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = spark.range(1000).selectExpr("cast(id as string) k", "cast(id as int) v", "'x' w")
        source = spark.range(1000).selectExpr("cast(id as string) k", "cast(id as int) v", "'x' w")
        assert plan_of(upsert(target, source, ["k"], update={"v": src("v")})).count("Exchange (") <= 4  # tree and details
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# Merge

CDC = "id bigint, seqval bigint, operation string, payload string"


def changes(spark, count=300, seed=1):
    draw = random.Random(seed)
    data = [(draw.choice([1, 1, 1] + list(range(2, 40))), i, draw.choice("IUUD"), f"p{i}") for i in range(count)]
    return data, spark.createDataFrame(data, CDC)


def newest(data):
    best = {}
    for row in data:
        if row[0] not in best or best[row[0]][1] < row[1]:
            best[row[0]] = row
    return best


def test_latest_per_key_with_a_hot_key(spark):
    data, frame = changes(spark)
    found = latest_per_key(frame, ["id"], ["seqval"])
    assert rows(found, *frame.columns) == sorted(newest(data).values(), key=repr)
    above, below = plan_of(found).split("\n\n\n")[0].split("Exchange", 1)
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below


@pytest.mark.parametrize("seed", range(3))
def test_merge_over_any_split_equals_one_batch(spark, seed):
    data, frame = changes(spark, seed=seed)
    draw = random.Random(seed)
    shuffled = draw.sample(data, len(data))
    cuts = [0, *sorted(draw.sample(range(len(data)), 2)), len(data)]
    merged = layers.empty_merged(frame)
    for low, high in zip(cuts, cuts[1:]):
        merged = layers.merge_load(merged, spark.createDataFrame(shuffled[low:high], CDC), CTX)
    wanted = sorted(((*r, "Y" if r[2] == "D" else "N") for r in newest(data).values()), key=repr)
    assert rows(merged, "id", "seqval", "operation", "payload", "gw_delete_flag") == wanted


def test_bucketed_versions_shuffle_only_the_changes(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        data, frame = changes(spark)
        table = VersionedTable(spark, str(tmp_path / "merged"), key=("id",), buckets=8)
        table.write(layers.merge_load(layers.empty_merged(frame), frame.where("seqval < 200"), CTX))
        merged = layers.merge_load(table.read(), frame, CTX)
        assert plan_of(merged).split("\n\n\n")[0].count("Exchange") == 1
        assert table.write(merged) == 2
        again = layers.merge_load(table.read(), frame, CTX)
        assert plan_of(again).split("\n\n\n")[0].count("Exchange") == 1
        assert rows(again, "id", "seqval") == sorted(((r[0], r[1]) for r in newest(data).values()), key=repr)
        assert len(list((tmp_path / "merged" / "version=2").glob("*.parquet"))) <= 8
        spark.sql(f"DROP TABLE {table._name(2)}")
        assert rows(table.read(), "id", "seqval") == rows(again, "id", "seqval")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stage_aligns_versions_and_keeps_rows(spark):
    old = spark.createDataFrame([(1, 2)], "id bigint, batchid bigint")
    new = spark.createDataFrame([("x", 2, 5), ("y", 2, 1)], "extra string, id bigint, batchid bigint")
    schema = spark.createDataFrame([], "id bigint, extra string, other int, batchid bigint").schema
    staged = layers.stage_load([old, new.where("batchid <> 1")], 2, schema)
    assert staged.columns == schema.names and staged.collect() == [(1, None, None, 2)]


def test_audit_treats_unknown_counts_as_failures(spark):
    manifest = spark.createDataFrame([("T", 3, "5")], "table_name string, total_records_count bigint, cda_folder string")
    counts = spark.createDataFrame([("t", "raw", 3, "5")], "table_name string, layer string, row_count bigint, cda_folder string")
    found = layers.audit_failures(layers.audit_counts(manifest, counts, CTX), {"raw": "R", "stg": "S", "mrg": "M"})
    assert rows(found, "layer", "error_message") == [
        ("mrg", "M.t | MRG count: None, Expected MRG count: None"),
        ("stg", "S.t | RAW count: 3, STG count: None"),
    ]


def test_layer_outcomes(spark):
    plan = spark.createDataFrame(
        [("a", True, True, True), ("b", False, True, True), ("c", None, False, True)],
        "table_name string, load_raw boolean, load_stg boolean, load_mrg boolean",
    )
    failures = spark.createDataFrame([("a", "stg", "x"), ("b", "raw", "x")], "table_name string, layer string, error_message string")
    found = {(r[0], r[1]): r[2] for r in layers.layer_outcomes(plan, failures).select("table_name", "layer", "outcome").collect()}
    assert [found["a", x] for x in load_plan.LAYERS] == ["completed", "failed", "blocked"]
    assert [found["b", x] for x in load_plan.LAYERS] == ["skipped", "completed", "completed"]
    assert [found["c", x] for x in load_plan.LAYERS] == ["skipped", "skipped", "completed"]


def test_plan_follows_three_valued_logic(spark):
    names = "table_name string, cda_schema_id string, cda_folder string, cda_folder_tms timestamp_ntz, total_records_count bigint"
    day = datetime(2024, 1, 1)
    new = spark.createDataFrame([("A", "s", "1", None, 1), ("B", "s", "1", None, 1), ("HeartBeat", "s", "1", day, 1)], names)
    old = spark.createDataFrame([("A", "s", "1", day, 1), ("B", "s", "1", day, 1)], names)
    status = spark.createDataFrame(
        [(x, "b", "completed") for x in load_plan.LAYERS] + [("raw", "a", "completed"), ("stg", "a", "failed")],
        "layer string, table_name string, status string",
    )
    found = load_plan.load_plan(new, old, status, s3_on=True, mrg_on=True).collect()
    assert [(r["table_name"], r["load_s3"], r["load_raw"], r["load_stg"], r["load_mrg"]) for r in found] == [
        ("a", None, None, True, True)
    ]
    assert load_plan.load_plan(new, old, status, s3_on=True, mrg_on=False).count() == 0


# Paging and delivery


@pytest.mark.parametrize(("count", "page", "slices"), [(0, 3, 4), (1, 3, 4), (10, 3, 4), (1000, 100, 7), (50, 1000, 3)])
def test_pages_number_every_row_once_in_order(spark, count, page, slices):
    ids = random.Random(count).sample(range(10 * count + 1), count)
    frame = spark.createDataFrame([(i, f"x{i}") for i in ids], "identity bigint, x string").repartition(5)
    found = page_rows(frame, "identity", page, slices)
    assert rows(found, "position", "identity", "batch_no") == sorted(
        [(p, i, p // page) for p, i in enumerate(sorted(ids))], key=repr
    )


def test_pages_of_one_repeated_value_are_spread(spark):
    frame = spark.range(1000).select(F.lit(7).cast("bigint").alias("identity"), F.col("id").alias("x"))
    found = page_rows(frame, "identity", 100, 4)
    assert sorted(r["position"] for r in found.collect()) == list(range(1000))
    assert max(r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()) < 600


OUTBOX = (
    "identity bigint, name string, submission_status string, submission_attempt_count int, max_submission_attempt_count int"
)


def test_outbox_job_sends_each_pending_row_once(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "outbox"))
    data = [(i, f"n{i}", ["NEW", "FAILURE", "SUCCESS", None][i % 4], i % 5, 3) for i in range(200)]
    table.write(spark.createDataFrame(data, OUTBOX))
    log = tmp_path / "sent"
    log.mkdir()

    def send(chunks):
        batch = [row for chunk in chunks for row in chunk]
        assert set(batch[0]) == {"name"}
        first = batch[0]["name"]
        with open(log / f"{first}-{len(batch)}", "a") as out:
            out.write("sent ")
        if first == "n0":
            raise ConnectionError("no answer")
        return first != "n21"

    waiting = sorted(r[0] for r in data if r[2] in ("NEW", "FAILURE") and r[3] < 3)
    errors = str(tmp_path / "errors")
    outcomes = outbox_job(table, send, page_size=10, source=OutboxSource(columns=("name",)), errors=errors)
    assert rows(spark.read.parquet(errors), "batch_no", "rows", "error") == [(0, 10, "ConnectionError: no answer")]
    pages = [waiting[i : i + 10] for i in range(0, len(waiting), 10)]
    assert sorted(p.name for p in log.iterdir()) == sorted(f"n{p[0]}-{len(p)}" for p in pages)
    assert {p.read_text() for p in log.iterdir()} == {"sent "}
    answer = {i: None if p[0] == 0 else "FAILURE" if p[0] == 21 else "SUCCESS" for p in pages for i in p}
    wanted = [(r[0], answer.get(r[0]) or r[2], r[3] + (answer.get(r[0]) is not None)) for r in data]
    assert rows(table.read(), "identity", "submission_status", "submission_attempt_count") == sorted(wanted, key=repr)
    assert sum(outcomes.values()) == len(pages)


# Sources and jobs


@pytest.fixture
def drop(spark, tmp_path):
    root = tmp_path / "drop"
    for table, schema_id, folder in [("pc_a", "s1", 3), ("pc_a", "s1", 5), ("pc_a", "s2", 6), ("pc_b", "s1", 4)]:
        path = root / table / schema_id / str(folder)
        spark.range(folder).withColumn("v", F.lit(folder)).coalesce(2).write.parquet(str(path))
        (path / "note.txt").write_text("not data")
    return str(root)


def test_both_listings_see_the_same_data_files(spark, drop):
    tables = spark.createDataFrame([(f"{drop}/pc_a",), (f"{drop}/pc_b",), (f"{drop}/missing",)], "folder string")
    spread = object_listing_by_folder(tables)
    planned = object_listing(spark, drop)

    def known(frame):
        return sorted((r["object_key"].removeprefix("file:"), r["size_bytes"]) for r in frame.collect())

    assert known(spread) == known(planned)
    assert all(k.endswith(".snappy.parquet") for k, _ in known(spread))
    assert "content" not in plan_of(planned).split("ReadSchema")[1].split("\n")[0]


def test_read_changes_prunes_files_outside_the_window(spark, drop):
    window = read_changes(spark, drop, "pc_a", "s1", 3, 5, ["3", "5"])
    assert {r["v"] for r in window.collect()} == {5} and {r["cda_folder"] for r in window.collect()} == {5}
    assert read_changes(spark, drop, "pc_a", "s1", None, 5, ["3", "5"]).count() == 8
    window.write.format("noop").mode("overwrite").save()
    scans = window._jdf.queryExecution().executedPlan().collectLeaves()
    files = [scans.apply(i).metrics().get("numFiles") for i in range(scans.size())]
    assert sum(f.get().value() for f in files if f.isDefined()) <= len(list(Path(drop, "pc_a/s1/5").glob("*.snappy.parquet")))


def test_read_changes_from_named_folders(spark, drop):
    assert read_changes(spark, drop, "pc_a", "s1", 3, 5, ["5"]).count() == 5
    assert read_changes(spark, drop, "pc_a", "s1", 3, 5, ["3", "5"]).count() == 5


def test_tables_in_one_scan(spark, drop):
    schema = spark.createDataFrame([], "id bigint").schema
    found = read_tagged(spark, drop, ["pc_a", "pc_b"], schema)
    assert {r["table_name"]: r["count"] for r in found.groupBy("table_name").count().collect()} == {"pc_a": 14, "pc_b": 4}
    assert plan_of(found).split("\n\n\n")[0].count("Scan parquet") == 1
    many = union_tagged({f"t{i}": spark.range(i) for i in range(20)})
    assert many.groupBy("table_name").count().count() == 19


def test_misplaced_data_file_is_an_error(spark):
    listing = spark.createDataFrame(
        [("f.snappy.parquet", 1, datetime(2024, 1, 1))], "object_key string, size_bytes bigint, last_modified timestamp"
    )
    with pytest.raises(Exception, match="outside a table folder"):
        inventory.file_rollup(listing, CTX, "source", "pc").collect()


def test_inventory_job_twice(spark, drop, tmp_path):
    counts = VersionedTable(spark, str(tmp_path / "counts"))
    first = inventory_job(spark, drop, counts, "source", "pc", CTX)
    assert (first["rows_inserted"], first["rows_updated"]) == (4, 0)
    later = RunContext(3, datetime(2024, 3, 1))
    second = inventory_job(spark, drop, counts, "source", "pc", later)
    assert (second["rows_inserted"], second["rows_updated"]) == (0, 4)
    stamps = rows(counts.read(), "table_name", "row_insert_tms", "row_update_tms")
    assert {s[1:] for s in stamps} == {(CTX.run_ts, later.run_ts)}


def test_archive_candidates(spark, tmp_path):
    frame = spark.createDataFrame(
        [
            ("p/a", "DEEP_ARCHIVE", None),
            ("p/b", "DEEP_ARCHIVE", "ongoing-request"),
            ("p/c", "STANDARD", None),
            ("q/d", "DEEP_ARCHIVE", "done"),
            ("p/e", None, None),
        ],
        "object_key string, storage_class string, restore_state string",
    )
    assert rows(archive_candidates(frame), "object_key") == [("p/a",), ("q/d",)]
    archive_job(frame, "p/", str(tmp_path / "keys"))
    assert rows(spark.read.text(str(tmp_path / "keys")), "value") == [("p/a",)]


def test_quota_job_writes_a_text_report(spark, tmp_path):
    monitors = spark.createDataFrame(
        [(n, Decimal(10), Decimal(1), "DAILY", datetime(2024, 1, 1), None, None) for n in ("b", "a")],
        "name string, credit_quota decimal(18,2), used_credits decimal(18,2), frequency string,"
        " start_time timestamp_ntz, suspend_at string, suspend_immediately_at string",
    )
    quota_job(monitors, datetime(2024, 2, 1), "dev", str(tmp_path / "report"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "report").glob("part-*")))
    assert text.startswith("dev Environment Resource Monitor Status Report:\n\nResource Monitor Name: a\n")
    assert text.count("Resource Monitor Name: ") == 2 and text.endswith("-" * 50 + "\n\n")


def test_manifest_file(spark, tmp_path):
    path = tmp_path / "manifest.json"
    entry = '"cda_schema_id": "s1",\n "cda_folder": "5", "cda_folder_tms": "2024-01-05T00:00:00", "total_records_count": 8'
    path.write_text('{"PC_A": {' + entry + "}}")
    assert [tuple(r) for r in read_manifest(spark, str(path)).collect()] == [("PC_A", "s1", "5", datetime(2024, 1, 5), 8)]


def test_metadata_from_the_catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS meta")
    spark.range(3).withColumn("Name", F.lit("x")).write.mode("overwrite").saveAsTable("meta.t1")
    found = column_metadata(spark, catalog_tables(spark, "meta"))
    assert rows(found, "table_name", "column_name") == [("T1", "ID"), ("T1", "NAME")]


def test_unfinished_version_is_not_read(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.write(spark.range(3))
    table.write(spark.range(5))
    Path(tmp_path, "t", "version=2", "_SUCCESS").unlink()
    assert table.read().count() == 3
