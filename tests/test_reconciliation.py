"""The hand-made comparison case, its block list, and record comparison edges."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tideline.context import RunContext
from tideline.jobs import reconciliation_job
from tideline.plans import reconciliation as rec

CTX = RunContext(4567, datetime(2024, 2, 1))

COLUMNS = [
    ("mrg", "PC_1", "ID"), ("mrg", "PC_1", "BEANVERSION"), ("mrg", "PC_1", "GW_DELETE_FLAG"), ("mrg", "PC_1", "BATCHID"),
    ("rep", "PC_1", "id"), ("rep", "PC_1", "beanversion"),
    ("mrg", "PC_2", "ID"), ("mrg", "PC_2", "BEANVERSION"), ("mrg", "PC_2", "EXTRA_M"),
    ("rep", "PC_2", "ID"), ("rep", "PC_2", "BEANVERSION"), ("rep", "PC_2", "EXTRA_R"),
    ("mrg", "PC_3", "ID"), ("rep", "PC_3", "ID"),
    ("mrg", "PC_4", "ID"), ("mrg", "PC_4", "BEANVERSION"),
    ("rep", "PC_5", "ID"), ("rep", "PC_5", "BEANVERSION"),
    ("rep", "PC_EMPTY", "ID"),
    ("rep", "PC_MESSAGE", "ID"), ("rep", "pct_scratch", "ID"), ("rep", "pctax", "ID"),
]
COUNTS = [
    ("mrg", "PC_1", 10), ("rep", "PC_1", 10), ("mrg", "PC_2", 5), ("rep", "PC_2", 7),
    ("mrg", "PC_3", 3), ("rep", "PC_3", 3), ("mrg", "PC_4", 4), ("rep", "PC_5", 6),
    ("rep", "PC_EMPTY", 0), ("rep", "PC_MESSAGE", 9), ("rep", "pct_scratch", 2), ("rep", "pctax", 1),
]
EXPECTED = {
    "PC_1": ([], 0, []),
    "PC_2": (["EXTRA_M", "EXTRA_R"], 2, ["ROW_COUNT_VARIANCE", "COLUMN_VARIANCE"]),
    "PC_3": ([], 0, []),
    "PC_4": (["BEANVERSION", "ID"], -4, ["TABLE_MISSING_IN_REPLICA", "ROW_COUNT_VARIANCE", "COLUMN_VARIANCE"]),
    "PC_5": (["BEANVERSION", "ID"], 6, ["TABLE_MISSING_IN_MRG", "ROW_COUNT_VARIANCE", "COLUMN_VARIANCE"]),
    "PC_EMPTY": ([], 0, ["REPLICA_ROW_COUNT_IS_ZERO"]),
    "PCTAX": (["ID"], 1, ["TABLE_MISSING_IN_MRG", "ROW_COUNT_VARIANCE", "COLUMN_VARIANCE"]),
}


@pytest.fixture(scope="module")
def comparison(spark):
    columns = spark.createDataFrame(COLUMNS, "side string, table_name string, column_name string")
    counts = spark.createDataFrame(COUNTS, "side string, table_name string, row_count bigint")
    listed = spark.createDataFrame([("pc_message",)], "table_name string")
    manifest = spark.createDataFrame(
        [("pc_1", "s0", "20240101", datetime(2024, 1, 1))],
        "table_name string, cda_schema_id string, cda_folder string, cda_folder_tms timestamp_ntz",
    )

    def side(frame, name):
        return frame.where(F.col("side") == name).drop("side")

    replica = rec.counts_with_columns(rec.drop_blocked(side(counts, "rep"), listed), side(columns, "rep"))
    mrg_columns = rec.columns_with_manifest(side(columns, "mrg"), manifest)
    return rec.table_comparison(mrg_columns, side(counts, "mrg"), replica, listed, CTX, "mrg_pc").checkpoint()


def test_variances_and_reasons(comparison):
    found = {
        r["table_name"]: (sorted(r["columns_variance"]), r["row_count_variance"], r["exclusion_reason"])
        for r in comparison.collect()
    }
    assert found == EXPECTED
    assert {r["schema_name"] for r in comparison.collect()} == {"MRG_PC"}
    assert comparison.where("table_name = 'PC_1'").first()["cda_folder"] == "20240101"


def test_candidates(comparison):
    assert sorted(r["table_name"] for r in rec.comparison_candidates(comparison).collect()) == ["PC_1", "PC_2"]


def test_report_hides_empty_replica_tables(comparison):
    rows = rec.variance_report(comparison).collect()
    assert sorted(r["table_name"] for r in rows) == ["PCTAX", "PC_2", "PC_4", "PC_5"]
    assert {r["text"] for r in rows if r["table_name"] == "PC_2"} == {
        "Schema Name: MRG_PC\nTable Name: PC_2\nVariance: ROW_COUNT_VARIANCE, COLUMN_VARIANCE\n"
    }


def test_zero_count_blocked_and_missing_lists(spark):
    """A replica-only table with no rows, or on the list, has no column variance."""
    listed = spark.createDataFrame([("PC_L",)], "table_name string")
    empty = spark.createDataFrame(
        [], "table_name string, columns array<string>, cda_folder string, cda_folder_tms timestamp_ntz, cda_schema_id string"
    )
    counts = spark.createDataFrame([], "table_name string, row_count bigint")
    replica = spark.createDataFrame(
        [("PC_Z", 0, ["ID"]), ("PC_L", 4, ["ID"])], "table_name string, row_count bigint, columns array<string>"
    )
    rows = rec.table_comparison(empty, counts, replica, listed, CTX, "MRG_PC").collect()
    assert {r["table_name"]: (r["columns_variance"], r["exclusion_reason"]) for r in rows} == {
        "PC_Z": ([], ["REPLICA_ROW_COUNT_IS_ZERO"]),
        "PC_L": ([], ["ROW_COUNT_VARIANCE"]),
    }


def test_mismatches_append_a_reason_and_leave_others_null(spark, comparison):
    counts = spark.createDataFrame(
        [(4567, "MRG_PC", "PC_1", 3)], "batch_id bigint, schema_name string, table_name string, id_beanversion_mismatches bigint"
    )
    rows = {r["table_name"]: r for r in rec.with_mismatches(comparison, counts).collect()}
    assert rows["PC_1"]["exclusion_reason"] == ["ID_BEANVERSION_MISMATCHES"]
    assert rows["PC_2"]["id_beanversion_mismatches"] is None
    assert rows["PC_2"]["exclusion_reason"] == EXPECTED["PC_2"][2]


MERGED = "table_name string, id bigint, beanversion string, gw_delete_flag string"
REPLICA = "table_name string, id bigint, beanversion string"


def test_null_ids_never_match_and_null_flags_drop(spark):
    merged = spark.createDataFrame(
        [("PC_1", None, "1", "N"), ("PC_1", 1, "1", "N"), ("PC_1", 2, "1", None), ("PC_1", 3, "1", "Y"), ("PC_1", 4, None, "N")],
        MERGED,
    )
    replica = spark.createDataFrame([("pc_1", None, "1"), ("pc_1", 1, "1"), ("pc_1", 2, "1"), ("pc_1", 4, None)], REPLICA)
    records = rec.record_comparison(merged, replica, CTX, "MRG_PC")
    found = sorted(((r["mrg_id"], r["replica_id"]) for r in records.collect()), key=repr)
    assert found == sorted([(None, None), (None, None), (1, 1), (None, 2), (4, 4)], key=repr)
    # Two null ids on either side are equal to each other as ids; only their versions tell them from nothing.
    assert rec.record_mismatch_counts(records).first()["id_beanversion_mismatches"] == 3


def test_mismatch_counts_are_symmetric(spark):
    merged = spark.createDataFrame([("PC_1", i, str(i % 5), "N") for i in range(50) if i % 7], MERGED)
    replica = spark.createDataFrame([("PC_1", i, str(i % 4)) for i in range(50) if i % 6], REPLICA)
    one = rec.record_mismatch_counts(rec.record_comparison(merged, replica, CTX, "S"))
    other = rec.record_mismatch_counts(
        rec.record_comparison(replica.withColumn("gw_delete_flag", F.lit("N")), merged.drop("gw_delete_flag"), CTX, "S")
    )
    assert one.first() == other.first()


def test_candidates_restrict_records(spark):
    merged = spark.createDataFrame([("PC_1", 1, "1", "N"), ("PC_2", 1, "1", "N")], MERGED)
    replica = spark.createDataFrame([("PC_1", 1, "2"), ("PC_2", 1, "2")], REPLICA)
    wanted = spark.createDataFrame([("PC_2",)], "table_name string")
    rows = rec.record_comparison(merged, replica, CTX, "S", wanted).collect()
    assert [r["table_name"] for r in rows] == ["PC_2"]


def test_job_over_many_tables(spark):
    def table(rows, flag=True):
        frame = spark.createDataFrame(rows, "ID bigint, BeanVersion int")
        return frame.withColumn("gw_delete_flag", F.lit("N")) if flag else frame

    merged = {"pc_1": table([(1, 0), (2, 0)]), "PC_2": table([(1, 0)]), "bc_9": table([(1, 0)])}
    replica = {"PC_1": table([(1, 0), (2, 1)], False), "pc_2": table([(1, 0)], False), "pct_x": table([(1, 0)], False)}
    manifest = spark.createDataFrame(
        [], "table_name string, cda_schema_id string, cda_folder string, cda_folder_tms timestamp_ntz"
    )
    listed = spark.createDataFrame([], "table_name string")
    comparison, report = reconciliation_job(spark, merged, replica, manifest, listed, CTX, "MRG_PC")
    assert {r["table_name"]: r["id_beanversion_mismatches"] for r in comparison.collect()} == {"PC_1": 1, "PC_2": None}
    assert [(r["table_name"], r["exclusion_reason"]) for r in report.collect()] == [("PC_1", "ID_BEANVERSION_MISMATCHES")]


@pytest.mark.parametrize("ranged_rows, ranged", [(1000, set()), (20, {"PC_1"}), (1, {"PC_1", "PC_2"})])
def test_only_large_tables_are_compared_by_ranges(spark, monkeypatch, ranged_rows, ranged):
    merged = [("PC_1", i, str(i % 5), "N") for i in range(30)] + [("pc_2", i * 10**6, "1", "N") for i in range(9)] + [("PC_2", None, "1", "N")]
    replica = [("PC_1", i, str(i % 4)) for i in range(25)] + [("PC_2", i * 10**6, "1") for i in range(1, 9)] + [("PC_2", None, "2")]
    merged, replica = spark.createDataFrame(merged, MERGED), spark.createDataFrame(replica, REPLICA)
    columns = spark.createDataFrame(
        [(t, c) for t in ("PC_1", "PC_2") for c in ("ID", "BEANVERSION")], "table_name string, column_name string"
    )
    manifest = spark.createDataFrame([], "table_name string, cda_schema_id string, cda_folder string, cda_folder_tms timestamp_ntz")
    listed = spark.createDataFrame([], "table_name string")

    def counts(rows):
        return rows.groupBy(F.upper("table_name").alias("table_name")).count().withColumnRenamed("count", "row_count")

    seen, digests = set(), rec.record_range_digests

    def watched(left, right, width):
        seen.update(r["table_name"].upper() for r in left.select("table_name").collect())
        return digests(left, right, width)

    monkeypatch.setattr(rec, "record_range_digests", watched)
    monkeypatch.setattr(rec, "RANGED_ROWS", ranged_rows, raising=False)
    final = rec.reconcile(
        rec.columns_with_manifest(columns, manifest), counts(merged), rec.counts_with_columns(counts(replica), columns), listed,
        merged, replica, CTX, "MRG_PC",
    )
    want = {"PC_1": sum(i >= 25 or i % 5 != i % 4 for i in range(30)), "PC_2": 3}
    assert {r["table_name"]: r["id_beanversion_mismatches"] for r in final.collect()} == want
    assert seen == ranged
