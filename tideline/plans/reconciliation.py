"""Merged tables against the system of record: columns, row counts and record versions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.context import RunContext, ensure_checkpoint_dir
from tideline.functions.arrays import append_when, no_strings, or_empty, symmetric_difference
from tideline.functions.names import BLOCKED_PATTERNS, matches_any
from tideline.operators.upsert import src, tgt, update_from
from tideline.plans.reports import notices

COMPARISON_KEY = ["batch_id", "schema_name", "table_name"]

#: Whole-number ids in a range of the record digests.
RANGE = 4096
#: Rows of a table from which its records are compared by ranges.
RANGED_ROWS = 16 * RANGE

# Columns the load adds to a merged table.
METADATA_COLUMNS = (
    "BATCHID",
    "GWCBI___CONNECTOR_TS_MS",
    "GWCBI___LSN",
    "GWCBI___OPERATION",
    "GWCBI___PAYLOAD_TS_MS",
    "GWCBI___SEQVAL",
    "GWCBI___SEQVAL_HEX",
    "GWCBI___TX_ID",
    "GW_DELETE_FLAG",
    "ROW_INSERT_TMS",
    "ROW_UPDATE_TMS",
)

# Reasons in a table comparison.
ZERO_ROWS = "REPLICA_ROW_COUNT_IS_ZERO"
NOT_MERGED = "TABLE_MISSING_IN_MRG"
NOT_IN_REPLICA = "TABLE_MISSING_IN_REPLICA"
ROW_VARIANCE = "ROW_COUNT_VARIANCE"
COLUMN_VARIANCE = "COLUMN_VARIANCE"
RECORD_MISMATCH = "ID_BEANVERSION_MISMATCHES"


def live_rows(merged: DataFrame) -> DataFrame:
    """Rows not deleted; an unknown flag drops out."""
    return merged.where(F.col("gw_delete_flag") == "N")


def row_counts(tables: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows per listed table, tables without rows included."""
    counted = rows.groupBy("table_name").agg(F.count(F.lit(1)).alias("row_count"))
    return tables.select("table_name").join(counted, "table_name", "left").select(
        "table_name", F.coalesce("row_count", F.lit(0)).alias("row_count")
    )


def column_lists(columns: DataFrame) -> DataFrame:
    """Upper-case column names per table in a stable order. Names are distinct before they are
    listed, so a list is never longer than the table is wide."""
    name = F.upper("table_name").alias("table_name")
    return columns.groupBy(name).agg(F.array_sort(F.collect_set(F.upper("column_name"))).alias("columns"))


def columns_with_manifest(columns: DataFrame, manifest: DataFrame) -> DataFrame:
    """Column list per merged table with the manifest entry of the table, where there is one."""
    entry = manifest.select(
        F.upper("table_name").alias("table_name"), "cda_folder", "cda_folder_tms", "cda_schema_id"
    )
    return column_lists(columns).join(entry, "table_name", "left")


def counts_with_columns(counts: DataFrame, columns: DataFrame) -> DataFrame:
    """Row count and column list of replica tables that have both."""
    named = counts.select(F.upper("table_name").alias("table_name"), "row_count")
    return named.join(column_lists(columns), "table_name", "inner")


def flag_blocked(tables: DataFrame, listed: DataFrame, patterns=BLOCKED_PATTERNS) -> DataFrame:
    """Adds `is_blocked`: the name matches a pattern or is on the list, case aside."""
    names = listed.select(F.upper("table_name").alias("_listed")).distinct()
    return (
        tables.join(names, F.upper("table_name") == F.col("_listed"), "left")
        .withColumn("is_blocked", matches_any(F.col("table_name"), patterns) | F.col("_listed").isNotNull())
        .drop("_listed")
    )


def drop_blocked(tables: DataFrame, listed: DataFrame, patterns=BLOCKED_PATTERNS) -> DataFrame:
    """Tables that are neither listed nor match a pattern."""
    names = listed.select(F.upper("table_name").alias("_listed"))
    return tables.where(~matches_any(F.col("table_name"), patterns)).join(
        names, F.upper("table_name") == F.col("_listed"), "left_anti"
    )


def table_comparison(
    mrg_columns: DataFrame,
    mrg_counts: DataFrame,
    replica: DataFrame,
    listed: DataFrame,
    ctx: RunContext,
    schema_name: str,
) -> DataFrame:
    """One row per table of either side, with variances and reasons.

    Inputs: `mrg_columns` (columns_with_manifest), `mrg_counts` (table_name, row_count),
    `replica` (counts_with_columns). The three are stacked and grouped once, which is the
    full outer join of all of them. Everything is computed anew for the batch, so a
    repeated run gives the same reasons.
    """
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [
            mrg_columns.withColumnRenamed("columns", "mrg_columns"),
            mrg_counts.select(F.upper("table_name").alias("table_name"), F.col("row_count").alias("mrg_row_count")),
            replica.select(
                "table_name", F.col("row_count").alias("replica_row_count"), F.col("columns").alias("replica_columns")
            ),
        ],
    )
    values = [c for c in stacked.columns if c != "table_name"]
    sides = stacked.groupBy("table_name").agg(*[F.first(c, ignorenulls=True).alias(c) for c in values])
    flagged = flag_blocked(sides, listed)

    mrg, replica_list = F.col("mrg_columns"), F.col("replica_columns")
    metadata = F.array(*map(F.lit, METADATA_COLUMNS))
    columns_variance = (
        F.when(replica_list.isNull(), mrg)
        .when(
            mrg.isNull(),
            F.when((F.col("replica_row_count") == 0) | F.col("is_blocked"), no_strings()).otherwise(replica_list),
        )
        .otherwise(F.array_except(symmetric_difference(replica_list, mrg), metadata))
    )
    row_variance = F.coalesce("replica_row_count", F.lit(0)) - F.coalesce("mrg_row_count", F.lit(0))

    has_mrg, has_replica = F.col("mrg_row_count").isNotNull(), F.col("replica_row_count").isNotNull()
    not_merged = ~has_mrg & has_replica & (F.col("replica_row_count") != 0) & ~F.col("is_blocked")
    not_in_replica = ~not_merged & ~has_replica & has_mrg
    reasons = append_when(no_strings(), F.col("replica_row_count") == 0, ZERO_ROWS)
    reasons = append_when(reasons, not_merged, NOT_MERGED)
    reasons = append_when(reasons, not_in_replica, NOT_IN_REPLICA)
    reasons = append_when(reasons, F.col("row_count_variance") != 0, ROW_VARIANCE)
    reasons = append_when(reasons, F.size("columns_variance") > 0, COLUMN_VARIANCE)

    return (
        flagged.withColumns({"columns_variance": columns_variance, "row_count_variance": row_variance})
        .withColumn("exclusion_reason", reasons)
        .select(
            ctx.batch.alias("batch_id"),
            F.lit(schema_name.upper()).alias("schema_name"),
            "table_name",
            "cda_folder",
            "cda_folder_tms",
            "cda_schema_id",
            "mrg_columns",
            "replica_columns",
            "columns_variance",
            "mrg_row_count",
            "replica_row_count",
            "row_count_variance",
            F.lit(None).cast("bigint").alias("id_beanversion_mismatches"),
            "exclusion_reason",
        )
    )


def comparison_candidates(comparison: DataFrame) -> DataFrame:
    """Tables whose records can be compared: rows on both sides and a version column on both."""
    excluded = F.arrays_overlap(or_empty(F.col("exclusion_reason")), F.array(F.lit(ZERO_ROWS), F.lit(NOT_MERGED)))

    def versioned(columns: str) -> Column:
        return F.array_contains(columns, "BEANVERSION")

    return comparison.where(~excluded & versioned("mrg_columns") & versioned("replica_columns")).select(COMPARISON_KEY)


def record_comparison(
    merged: DataFrame, replica: DataFrame, ctx: RunContext, schema_name: str, candidates: DataFrame | None = None
) -> DataFrame:
    """Live merged rows and replica rows side by side by table and id; unmatched rows stay.

    `merged` and `replica` hold table_name, id, beanversion. A null id matches nothing, so
    rows without one pass by the join, where all of them would meet in one partition. Parquet
    statistics answer the null test, so the extra scans skip files that have none.
    """
    left = live_rows(merged).select(
        F.upper("table_name").alias("table_name"),
        F.col("id").alias("mrg_id"),
        F.col("beanversion").cast("string").alias("mrg_beanversion"),
    )
    right = replica.select(
        F.upper("table_name").alias("table_name"),
        F.col("id").alias("replica_id"),
        F.col("beanversion").cast("string").alias("replica_beanversion"),
    )
    if candidates is not None:
        wanted = candidates.select("table_name").distinct()
        left = left.join(wanted, "table_name", "left_semi")
        right = right.join(wanted, "table_name", "left_semi")

    m, r = left.where("mrg_id IS NOT NULL").alias("m"), right.where("replica_id IS NOT NULL").alias("r")
    same = (F.col("m.table_name") == F.col("r.table_name")) & (F.col("mrg_id") == F.col("replica_id"))
    sides = ["mrg_id", "mrg_beanversion", "replica_id", "replica_beanversion"]
    paired = m.join(r, same, "full_outer").select(
        F.coalesce("m.table_name", "r.table_name").alias("table_name"), *sides
    )
    records = (
        paired.unionByName(left.where("mrg_id IS NULL"), allowMissingColumns=True)
        .unionByName(right.where("replica_id IS NULL"), allowMissingColumns=True)
    )
    return records.select(
        ctx.batch.alias("batch_id"), F.lit(schema_name.upper()).alias("schema_name"), "table_name", *sides
    )


def record_mismatch_counts(records: DataFrame) -> DataFrame:
    """Records per table whose id or version differs between the sides."""
    differs = ~F.col("mrg_id").eqNullSafe(F.col("replica_id")) | ~F.col("mrg_beanversion").eqNullSafe(
        F.col("replica_beanversion")
    )
    return records.where(differs).groupBy(*COMPARISON_KEY).agg(F.count(F.lit(1)).alias("id_beanversion_mismatches"))


def digest_of(*values: Column) -> Column:
    """60 bits of a row's md5: a digest that the system of record can work out too, in its own SQL."""
    told = F.concat_ws(":", *[F.coalesce(F.concat(F.lit("="), v.cast("string")), F.lit("-")) for v in values])
    return F.conv(F.substring(F.md5(told.cast("binary")), 1, 15), 16, 10).cast("bigint")


def key_range(key: Column, width: int) -> Column:
    """The range of a key: `width` whole numbers; other keys fall into 65,536 ranges below 0 by their digest."""
    number = key.try_cast("bigint")
    return F.coalesce(F.floor(number / F.lit(width)).cast("bigint"), -1 - F.pmod(digest_of(key), F.lit(65536)))


def record_range_digests(merged: DataFrame, replica: DataFrame, width: int = RANGE) -> DataFrame:
    """Digests of both sides' records per table and key range, and whether they differ.

    A side's digest is the number of its rows with the sum and the exclusive or of their hashes, so it does not depend on
    the order of rows and is combined in the map tasks: one row per range is shuffled, whatever the number of records.
    Live merged rows count. Rows without an id are left out; they match nothing.
    """
    sides = {"mrg": live_rows(merged), "replica": replica}
    rows = [
        frame.where("id IS NOT NULL").select(
            F.upper("table_name").alias("table_name"), key_range(F.col("id"), width).alias("key_range"),
            F.lit(side).alias("side"), digest_of(F.col("id"), F.col("beanversion")).alias("h"),
        )
        for side, frame in sides.items()
    ]

    def of(side: str, value: Column) -> Column:
        return F.when(F.col("side") == side, value)

    figures = {}
    for side in sides:
        figures[f"{side}_rows"] = F.count(of(side, F.lit(1)))
        figures[f"{side}_sum"] = F.coalesce(F.sum(of(side, F.col("h").cast("decimal(28,0)"))), F.lit(0)).cast("string")
        figures[f"{side}_xor"] = F.coalesce(F.bit_xor(of(side, F.col("h"))), F.lit(0))
    counted = rows[0].unionByName(rows[1]).groupBy("table_name", "key_range").agg(*[f.alias(n) for n, f in figures.items()])
    differs = F.struct("mrg_rows", "mrg_sum", "mrg_xor") != F.struct("replica_rows", "replica_sum", "replica_xor")
    return counted.withColumn("differs", differs)


def records_that_may_differ(merged: DataFrame, replica: DataFrame, digests: DataFrame, width: int = RANGE) -> tuple[DataFrame, DataFrame]:
    """Both sides without the records of ranges whose digests agree. Rows without an id stay."""
    at = F.struct(F.upper("table_name"), F.coalesce(key_range(F.col("id"), width), F.lit(0)))
    ranges = digests.where("differs").select(F.struct("table_name", "key_range").alias("_range"))

    def side(frame: DataFrame) -> DataFrame:
        known = frame.where("id IS NOT NULL").withColumn("_at", at)
        return known.join(ranges, F.col("_at") == F.col("_range"), "left_semi").drop("_at").unionByName(frame.where("id IS NULL"))

    return side(merged), side(replica)


def record_mismatches(
    merged: DataFrame, replica: DataFrame, ctx: RunContext, schema_name: str, candidates: DataFrame | None = None, width: int = RANGE
) -> DataFrame:
    """`record_mismatch_counts` of `record_comparison`, with only the key ranges compared record by record whose digests differ.

    Ids are unique on each side. The digests, one row a range, are checkpointed: they decide what both sides read again.
    """
    if candidates is not None:
        wanted = candidates.select("table_name").distinct()
        merged, replica = (f.withColumn("table_name", F.upper("table_name")).join(wanted, "table_name", "left_semi") for f in (merged, replica))
    ensure_checkpoint_dir(merged.sparkSession)
    digests = record_range_digests(merged, replica, width).checkpoint()
    merged, replica = records_that_may_differ(merged, replica, digests, width)
    return record_mismatch_counts(record_comparison(merged, replica, ctx, schema_name))


def with_mismatches(comparison: DataFrame, mismatches: DataFrame) -> DataFrame:
    """The comparison with mismatch counts and their reason; tables without one keep a null count."""
    reasons = append_when(tgt("exclusion_reason"), src("id_beanversion_mismatches") != 0, RECORD_MISMATCH)
    values = {"id_beanversion_mismatches": src("id_beanversion_mismatches"), "exclusion_reason": reasons}
    return update_from(comparison, mismatches, COMPARISON_KEY, values)


def reconcile(
    mrg_columns: DataFrame,
    mrg_counts: DataFrame,
    replica: DataFrame,
    listed: DataFrame,
    merged_rows: DataFrame,
    replica_rows: DataFrame,
    ctx: RunContext,
    schema_name: str,
) -> DataFrame:
    """The finished table comparison: tables, then records of the comparable ones, then reasons.

    The comparison, one row per table, decides which records are read and takes their
    counts, so it is checkpointed between the two rather than worked out again for each.

    Records of tables with fewer than `RANGED_ROWS` rows are joined at once: their ids may lie so far apart that every
    record has a range to itself, and digests of many such tables would cost more than the join they save.
    """
    ensure_checkpoint_dir(mrg_counts.sparkSession)
    comparison = table_comparison(mrg_columns, mrg_counts, replica, listed, ctx, schema_name).checkpoint()
    is_small = F.greatest(*[F.coalesce(c, F.lit(0)) for c in ("mrg_row_count", "replica_row_count")]) < RANGED_ROWS
    small, large = (comparison_candidates(comparison.where(c)) for c in (is_small, ~is_small))
    mismatches = record_mismatch_counts(record_comparison(merged_rows, replica_rows, ctx, schema_name, small))
    if not large.isEmpty():
        mismatches = mismatches.unionByName(record_mismatches(merged_rows, replica_rows, ctx, schema_name, large))
    return with_mismatches(comparison, mismatches)


def variance_report(comparison: DataFrame) -> DataFrame:
    """Tables with a reason other than an empty replica, which hides a table from the report."""
    reasons = or_empty(F.col("exclusion_reason"))
    shown = ~F.array_contains(reasons, ZERO_ROWS) & (F.size(F.array_except(reasons, F.array(F.lit(ZERO_ROWS)))) > 0)
    variance = F.array_join("exclusion_reason", ", ")
    text = F.concat(
        F.lit("Schema Name: "), F.col("schema_name"), F.lit("\nTable Name: "), F.col("table_name"),
        F.lit("\nVariance: "), variance, F.lit("\n"),
    )
    return comparison.where(shown).select("schema_name", "table_name", variance.alias("exclusion_reason"), text.alias("text"))


def variance_notice(report: DataFrame, limit: int | None = None, parts: bool = False) -> DataFrame:
    """One notification text per schema (or its parts)."""
    return notices(report, "schema_name", ["table_name"], F.col("text"), limit, parts)
