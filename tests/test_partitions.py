"""Merges by touched partitions, counts from footers and writers, retention, digests of key ranges."""

from dataclasses import replace
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from test_incremental import V1, V2, Source, center, ctx, merged, run_incremental_load, source  # noqa: F401
from tideline.context import RunContext
from tideline.plans import layers, reconciliation
from tideline.sources import footers
from tideline.sources.partitions import PartitionedTable, part_of
from tideline.sources.versions import VersionedTable

CTX = RunContext(1, datetime(2024, 2, 1))
SHAPE = "id bigint, seqval bigint, operation string, payload string"


def changes_of(spark, rows, shape=SHAPE):
    return spark.createDataFrame(rows, shape)


def step(before, changes):
    return layers.merge_load(before, changes, CTX, with_action=True)


def files_of(root):
    return {str(p): p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}


def merge(table, known, changes):
    done = table.merge(known, changes, layers.empty_merged(changes), step)
    table.publish(done.version)
    return done


@pytest.fixture
def table(spark, tmp_path):
    return PartitionedTable(spark, str(tmp_path / "t"), ("id",), 16)


def test_a_batch_of_one_key_reads_and_writes_one_partition(spark, table):
    first = merge(table, None, changes_of(spark, [(i, 1, "I", "a") for i in range(1000)]))
    assert (first.rows, first.rows_before, first.inserted, first.updated) == (1000, 0, 1000, 0)
    before = files_of(table.path)
    second = merge(table, first.version, changes_of(spark, [(7, 2, "U", "b")]))
    assert (second.rows, second.rows_before, second.inserted, second.updated) == (1000, 1000, 0, 1)
    after = files_of(table.path)
    new = [p for p in after if p not in before and "/control/" not in p]
    assert len(new) == 1 and all(after[p] == before[p] for p in before)

    part = spark.createDataFrame([(7,)], "id bigint").select(part_of(["id"], 16)).first()[0]
    assert f"/load=2/_part={part}/" in new[0]
    opened = table.read(second.version, [part]).inputFiles()
    assert len(opened) == 1 and opened[0].endswith(new[0].rsplit("/", 1)[1])
    lies = {r["part"]: (r["load"], r["row_count"]) for r in table.control.read().collect()}
    assert len(lies) == 16 and {p for p, (load, _) in lies.items() if load == 2} == {part}
    assert sum(n for _, n in lies.values()) == 1000
    # Readers of the older version still see it.
    assert table.read(first.version).where("id = 7").first()["payload"] == "a"
    assert table.read().where("id = 7").first()["payload"] == "b"


def test_each_partition_is_one_file_when_it_leaves_the_join(spark, table):
    merge(table, None, changes_of(spark, [(i, 1, "I", "a") for i in range(1000)]))
    assert len([p for p in files_of(table.path) if "/load=1/" in p]) == 16


def test_partitioned_and_whole_merges_agree(spark, tmp_path, table):
    whole = VersionedTable(spark, str(tmp_path / "w"), key=("id",), marker="_PUBLISHED")
    batches = [
        changes_of(spark, [(i % 50, i, "D" if i % 7 == 0 else "U", f"p{i}") for i in range(300)]),
        changes_of(spark, [(i % 60, i - 100, "U", f"q{i}") for i in range(0, 500, 9)]),
        changes_of(spark, []),
        changes_of(spark, [(3, 10**6, "U", "new", 1.5)], SHAPE + ", added double"),
        changes_of(spark, [(2**40, 10**6, "U", "new", 2.5)], SHAPE + ", added double"),
    ]
    at, other = None, None
    for batch in batches:
        done, same = merge(table, at, batch), merge(whole, other, batch)
        at, other = done.version, same.version
        assert (done.rows, done.rows_before, done.inserted, done.updated) == (same.rows, same.rows_before, same.inserted, same.updated)
        assert sorted(map(tuple, table.read().select(*sorted(whole.read().columns)).collect()), key=repr) == sorted(
            map(tuple, whole.read().select(*sorted(whole.read().columns)).collect()), key=repr
        )


def test_retention_keeps_what_the_kept_versions_need(spark, tmp_path, table):
    at = None
    for batch in ([(i, 1, "I", "a") for i in range(100)], [(5, 2, "U", "b")], [(5, 3, "U", "c")], [(6, 4, "U", "d")]):
        at = merge(table, at, changes_of(spark, batch)).version
    rows = sorted(map(tuple, table.read().select("id", "payload").collect()))
    gone = table.retain(1)
    assert any("/load=2" in g for g in gone) and not any("/load=1" in g for g in gone)  # load 1 holds the untouched partitions
    assert sorted(map(tuple, table.read().select("id", "payload").collect())) == rows and table.retain(1) == []

    plain = VersionedTable(spark, str(tmp_path / "plain"))
    for n in range(4):
        plain.write(spark.range(n + 1))
    assert [g.rsplit("=", 1)[1] for g in plain.retain(2)] == ["1", "2"] and plain.read().count() == 4
    with pytest.raises(ValueError):
        plain.retain(0)


@pytest.mark.parametrize("options", [{"parts": 8}, {"buckets": 4}, {}])
def test_loads_scan_no_output_again(source, center, options):  # noqa: F811
    """Two batches with a new schema version, under each kind of merged table; audits hold."""
    center = replace(center, **options)
    source.drop("pc_a", "s1", 20240101, [(1, 1, "I", 0), (2, 2, "I", 0)], V1)
    source.publish()
    assert run_incremental_load(center, ctx(1))["state"] == "success"
    source.drop("pc_a", "s2", 20240102, [(2, 5, "D", 1, "x"), (9, 6, "I", 0, "y")], V2)
    source.publish()
    assert run_incremental_load(center, ctx(2))["state"] == "success"
    assert merged(center, "pc_a") == [(1, 1, 0, "N"), (2, 5, 1, "Y"), (9, 6, 0, "N")]
    assert {r["extra"] for r in center.merged("pc_a").read().collect()} == {None, "x", "y"}


# Footers and counts of the writers


def test_footers_answer_counts_without_data_pages(spark):
    path = "/root/testdata/sf0.001/lineitem.parquet"
    counts = footers.footer_counts(spark, {"lineitem": (path, "l_orderkey")})
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(l_orderkey), MAX(l_orderkey)]" in plan
    files = footers.file_rows(spark.read.parquet(path))
    assert "ReadSchema: struct<>" in files._jdf.queryExecution().executedPlan().toString()
    assert files.agg(F.sum("rows")).first()[0] == spark.read.parquet(path).count() == counts.first()["row_count"]
    with pytest.raises(ValueError):
        footers.footer_counts(spark, {})


def test_writers_count_what_they_write(spark, tmp_path):
    def observe(frame, name, times=1):
        path = str(tmp_path / name)
        frames = [frame] * times

        def write(rows):
            for part in [rows, *frames[1:]]:
                part.write.mode("append").parquet(path)

        return footers.write_observed(frame, write, lambda: spark.read.schema(frame.schema).parquet(path), [F.max("id").alias("top")])

    assert observe(spark.range(100), "all") == {"rows": 100, "top": 99}
    assert observe(spark.range(100).where("id < 0"), "none") == {"rows": 0, "top": None}
    assert observe(spark.createDataFrame([], "id bigint"), "empty") == {"rows": 0, "top": None}
    # Where the writers' count is not what lies there, the rows are counted.
    assert observe(spark.range(10), "twice", 2) == {"rows": 20, "top": 9}


# Digests of key ranges


def sides(spark):
    merged_rows = [("pc_a", i, i, "N") for i in range(2000)] + [("pc_b", i, 0, "N") for i in range(500)]
    replica_rows = [("PC_A", i, str(i)) for i in range(2000)] + [("pc_b", i, "0") for i in range(500)]
    merged_rows += [("pc_a", None, 1, "N"), ("pc_a", 9000, 1, "Y"), ("pc_b", 7000, None, "N")]
    replica_rows += [("pc_c", 1, "1"), ("pc_b", 7000, "")]
    merged_rows[130] = ("pc_a", 130, -1, "N")
    replica_rows.remove(("pc_b", 64, "0"))
    m = spark.createDataFrame(merged_rows, "table_name string, id bigint, beanversion int, gw_delete_flag string")
    return m, spark.createDataFrame(replica_rows, "table_name string, id bigint, beanversion string")


def test_only_differing_ranges_are_compared_by_record(spark):
    m, r = sides(spark)
    digests = reconciliation.record_range_digests(m, r, 100)
    found = {(d["table_name"], d["key_range"]) for d in digests.where("differs").collect()}
    assert found == {("PC_A", 1), ("PC_B", 0), ("PC_B", 70), ("PC_C", 0)}
    left, right = reconciliation.records_that_may_differ(m, r, digests, 100)
    # A hundred rows for a differing range, not 2,500; the row without an id stays.
    assert (left.count(), right.count()) == (100 + 100 + 1 + 1, 100 + 99 + 1 + 1)


@pytest.mark.parametrize("width", [1, 100, 10**6])
def test_mismatches_by_digest_equal_those_of_the_whole_join(spark, width):
    m, r = sides(spark)
    want = reconciliation.record_mismatch_counts(reconciliation.record_comparison(m, r, CTX, "MRG_PC")).collect()
    assert sorted(reconciliation.record_mismatches(m, r, CTX, "MRG_PC", width=width).collect()) == sorted(want)
    texts = [f.withColumn("id", F.concat(F.lit("pc:"), "id")) for f in (m, r)]
    assert sorted(reconciliation.record_mismatches(*texts, CTX, "MRG_PC", width=width).collect()) == sorted(want)
    chosen = spark.createDataFrame([("PC_B",)], "table_name string")
    some = reconciliation.record_mismatches(m, r, CTX, "MRG_PC", chosen, width).collect()
    assert sorted(some) == sorted(w for w in want if w["table_name"] == "PC_B")
    assert reconciliation.record_mismatches(m, r.limit(0), CTX, "MRG_PC", chosen.limit(0), width).count() == 0
