"""Whole jobs over stored tables: inventory, reconciliation, outbox, quota and archive.

The incremental load is `tideline.plans.incremental.run_incremental_load`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideline.context import RunContext, ensure_checkpoint_dir
from tideline.functions.names import TENANT_PATTERNS
from tideline.operators.inventory import FILE_COUNTS, file_rollup, upsert_file_counts
from tideline.operators.upsert import action_counts
from tideline.plans import outbox, quota, reconciliation
from tideline.sources.objects import archive_candidates, object_listing_by_folder, subfolder_listing
from tideline.sources.replica import column_metadata, union_tagged
from tideline.sources.versions import VersionedTable


def inventory_job(
    spark: SparkSession, root: str, file_counts: VersionedTable, system: str, core_center: str, ctx: RunContext
) -> dict:
    """List the tables below a root, roll the files up by folder and merge the figures."""
    ensure_checkpoint_dir(spark)
    tables = subfolder_listing(spark.createDataFrame([(root,)], "folder string"), depth=1)
    schema = StructType.fromDDL(FILE_COUNTS)
    rollup = file_rollup(object_listing_by_folder(tables), ctx, system, core_center).to(schema)
    target = file_counts.read() if file_counts.latest() else spark.createDataFrame([], schema)
    merged = upsert_file_counts(target, rollup, with_action=True).checkpoint()
    file_counts.write(merged.drop("_action"))
    return action_counts(merged).first().asDict()


def _wanted(tables: Mapping[str, DataFrame], pattern: str) -> dict[str, DataFrame]:
    """Tables of the tenant by upper-case name."""
    prefix = pattern.rstrip("%").upper()
    return {name.upper(): frame for name, frame in tables.items() if name.upper().startswith(prefix)}


def _tagged(tables: Mapping[str, DataFrame], *columns: str) -> DataFrame:
    """One long frame of the named columns as text; a column a table lacks is null."""

    def text(frame: DataFrame, name: str):
        present = name in map(str.lower, frame.columns)
        return (F.col(name) if present else F.lit(None)).cast("string").alias(name)

    return union_tagged({name: frame.select(*[text(frame, c) for c in columns]) for name, frame in tables.items()})


def reconciliation_job(
    spark: SparkSession,
    merged: Mapping[str, DataFrame],
    replica: Mapping[str, DataFrame],
    manifest: DataFrame,
    listed: DataFrame,
    ctx: RunContext,
    schema_name: str,
) -> tuple[DataFrame, DataFrame]:
    """Compare a tenant's merged tables with the replica: (table comparison, variance report).

    All tables of a side are read as one long frame, so their number does not multiply the
    Spark jobs; only tables whose records can be compared are read for records.
    """
    ensure_checkpoint_dir(spark)
    merged = _wanted(merged, TENANT_PATTERNS[schema_name.upper()])
    names = spark.createDataFrame([(name,) for name in replica], "table_name string")
    allowed = {r["table_name"] for r in reconciliation.drop_blocked(names, listed).collect()}
    replica = {name.upper(): frame for name, frame in replica.items() if name in allowed}

    def names_of(tables: Mapping[str, DataFrame]) -> DataFrame:
        return spark.createDataFrame([(name,) for name in tables], "table_name string")

    live = reconciliation.live_rows(_tagged(merged, "gw_delete_flag"))
    replica_counts = reconciliation.row_counts(names_of(replica), union_tagged({n: f.select() for n, f in replica.items()}))
    comparison = reconciliation.table_comparison(
        reconciliation.columns_with_manifest(column_metadata(spark, merged), manifest),
        reconciliation.row_counts(names_of(merged), live),
        reconciliation.counts_with_columns(replica_counts, column_metadata(spark, replica)),
        listed,
        ctx,
        schema_name,
    ).checkpoint()
    chosen = [r["table_name"] for r in reconciliation.comparison_candidates(comparison).collect()]
    if chosen:
        counts = reconciliation.record_mismatches(
            _tagged({n: merged[n] for n in chosen}, "id", "beanversion", "gw_delete_flag"),
            _tagged({n: replica[n] for n in chosen}, "id", "beanversion"),
            ctx,
            schema_name,
        )
        comparison = reconciliation.with_mismatches(comparison, counts).checkpoint()
    return comparison, reconciliation.variance_report(comparison)


def outbox_job(
    table: VersionedTable,
    send: Callable[[Iterator[list[dict]]], bool],
    page_size: int = outbox.PAGE_SIZE,
    source: outbox.OutboxSource = outbox.OutboxSource(),
    errors: str | None = None,
) -> dict:
    """Deliver the pending rows of a source's outbox table page by page and write the answers back.

    `errors` is a folder to which the batches without an answer are appended with their error text.
    """
    rows = table.read()
    paged = outbox.batches(rows, source.identity, page_size)
    outcomes = outbox.deliver(paged, send, source)
    table.write(outbox.write_back(rows, paged, outcomes, source.identity))
    if errors:
        outcomes.where(F.col("outcome") == outbox.BROKEN).write.mode("append").parquet(errors)
    return {r["outcome"]: r["count"] for r in outcomes.groupBy("outcome").count().collect()}


def quota_job(monitors: DataFrame, as_of: datetime, account_name: str, path: str) -> None:
    """Write the quota report as text parts in name order."""
    quota.quota_message(quota.quota_report(monitors, as_of), account_name).write.mode("overwrite").text(path)


def archive_job(inventory: DataFrame, prefix: str, path: str) -> None:
    """Write the keys to restore."""
    archive_candidates(inventory, prefix).write.mode("overwrite").text(path)
