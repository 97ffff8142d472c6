"""Registered queries: each takes (spark, sf_dir) and returns a frame."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.context import RunContext, ntz
from tideline.functions.keys import landing_key
from tideline.functions.names import in_tenant, matches_any
from tideline.operators import inventory
from tideline.operators.history import latest_per_key
from tideline.operators.upsert import action_counts
from tideline.plans import layers, load_plan, outbox, quota, reconciliation, reports
from tideline.sources import footers, manifest, objects, partitions, replica
from validation.inputs import TABLES, Inputs

CTX = RunContext(batch_id=4567, run_ts=datetime(2024, 2, 1))
EARLIER = RunContext(batch_id=4566, run_ts=datetime(2024, 1, 1))
AS_OF = datetime(2024, 2, 1, 13, 30)
SYSTEM, LANDED, CENTER, SCHEMA = "source", "landed", "pc", "MRG_PC"
LAYER_SCHEMAS = {"raw": "RAW_PC", "stg": "STG_PC", "mrg": "MRG_PC"}
PAGE, PARTS = 100, 16384

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def named(name: str):
    """Register a function of the inputs under a query key."""

    def register(function: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: function(Inputs(spark, sf_dir))
        return function

    return register


def query(function: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    return named(function.__name__)(function)


def joined(column: str):
    """An array as text, so that both engines print it alike."""
    return F.array_join(column, ",").alias(column)


# Sources


@query
def object_inventory(x: Inputs) -> DataFrame:
    return objects.data_files(x["fx_objects"])


@query
def path_decompose(x: Inputs) -> DataFrame:
    return inventory.with_path_parts(objects.data_files(x["fx_objects"])).select("object_key", *inventory.FOLDER)


@query
def folder_discovery(x: Inputs) -> DataFrame:
    return inventory.folders(x["fx_objects"])


@named("landing_key")
def landing_keys(x: Inputs) -> DataFrame:
    files = objects.data_files(x["fx_objects"])
    return files.select("object_key", landing_key(F.col("object_key"), "cda/pc").alias("landing_key"))


@query
def manifest_explode(x: Inputs) -> DataFrame:
    entry = ["cda_schema_id", "cda_folder", "cda_folder_tms", "total_records_count"]
    documents = x["fx_src_manifest"].select(manifest.manifest_text(entry, F.col("table_name")).alias("value"))
    return manifest.explode_manifests(documents)


@query
def replica_tagged(x: Inputs) -> DataFrame:
    return replica.tag_replica(x["fx_replica"], CTX, SCHEMA)


@query
def column_metadata(x: Inputs) -> DataFrame:
    """Columns of every given table beside its row count."""
    tables = {name: x[name] for name in TABLES}
    columns = replica.column_metadata(x.spark, tables)
    rows = replica.union_tagged({name: frame.select() for name, frame in tables.items()})
    counts = reconciliation.row_counts(columns.select(F.lower("table_name").alias("table_name")).distinct(), rows)
    return columns.join(counts.select(F.upper("table_name").alias("table_name"), "row_count"), "table_name")


@query
def archive_candidates(x: Inputs) -> DataFrame:
    return objects.archive_candidates(x["fx_archive"], "cda/")


# Inventory


@query
def file_rollup(x: Inputs) -> DataFrame:
    return inventory.file_rollup(x["fx_objects"], CTX, SYSTEM, CENTER)


def _file_counts(x: Inputs, **options) -> DataFrame:
    target = inventory.file_rollup(x["fx_objects_landed"], EARLIER, SYSTEM, CENTER)
    return inventory.upsert_file_counts(target, inventory.file_rollup(x["fx_objects"], CTX, SYSTEM, CENTER), **options)


@query
def upsert_file_counts(x: Inputs) -> DataFrame:
    return _file_counts(x)


@query
def inventory_compare(x: Inputs) -> DataFrame:
    counts = inventory.file_rollup(x["fx_objects"], CTX, SYSTEM, CENTER).unionByName(
        inventory.file_rollup(x["fx_objects_landed"], CTX, LANDED, CENTER)
    )
    return inventory.inventory_compare(counts, SYSTEM, LANDED)


# Load plan and control tables


def _plan(x: Inputs, s3_on: bool = True, mrg_on: bool = True) -> DataFrame:
    return load_plan.load_plan(
        x["fx_src_manifest"], x["fx_dest_manifest"], x["fx_load_status"], s3_on=s3_on, mrg_on=mrg_on
    )


@named("load_plan")
def load_plan_both(x: Inputs) -> DataFrame:
    return _plan(x)


@query
def load_plan_mrg_only(x: Inputs) -> DataFrame:
    return _plan(x, s3_on=False)


@query
def load_plan_s3_only(x: Inputs) -> DataFrame:
    return _plan(x, mrg_on=False)


@query
def load_plan_initial(x: Inputs) -> DataFrame:
    return load_plan.initial_load_plan(
        x["fx_src_manifest"], x["fx_dest_manifest"], x["fx_load_status"], s3_on=True, mrg_on=True
    )


@query
def mode_flags(x: Inputs) -> DataFrame:
    incremental = load_plan.mode_flags(x["fx_core_centers"], True).withColumn("is_incremental", F.lit(True))
    initial = load_plan.mode_flags(x["fx_core_centers"], False).withColumn("is_incremental", F.lit(False))
    return incremental.unionByName(initial)


@query
def folder_window(x: Inputs) -> DataFrame:
    # Files outside the window go before folders are made distinct.
    return load_plan.folder_window(inventory.folder_rows(x["fx_objects"]), _plan(x).checkpoint()).distinct()


def _loaded_manifest(x: Inputs) -> DataFrame:
    return x["fx_dest_manifest"].withColumns({"row_insert_tms": EARLIER.now, "row_update_tms": EARLIER.now})


@query
def upsert_manifest(x: Inputs) -> DataFrame:
    return load_plan.upsert_manifest(_loaded_manifest(x), x["fx_src_manifest"], CTX)


@query
def upsert_action_counts(x: Inputs) -> DataFrame:
    return action_counts(
        load_plan.upsert_manifest(_loaded_manifest(x), x["fx_src_manifest"], CTX, with_action=True)
    )


def _status(x: Inputs) -> DataFrame:
    return x["fx_load_status"].select(
        "layer", "table_name", EARLIER.batch.alias("batch_id"), "status",
        EARLIER.now.alias("row_insert_tms"), EARLIER.now.alias("row_update_tms"),
    )


@query
def status_after_load(x: Inputs) -> DataFrame:
    return load_plan.upsert_load_status(_status(x), load_plan.touched_layers(_plan(x)), CTX)


@query
def process_log(x: Inputs) -> DataFrame:
    statuses = load_plan.upsert_load_status(_status(x), load_plan.touched_layers(_plan(x)), CTX, with_action=True)
    entries = load_plan.arrived_entries(x["fx_src_manifest"], _plan(x))
    manifests = load_plan.upsert_manifest(_loaded_manifest(x), entries, CTX, with_action=True)
    return load_plan.arrival_log(statuses, manifests, LAYER_SCHEMAS, CTX)


# Layers


def _layer_counts(x: Inputs) -> DataFrame:
    long = x["fx_layer_counts"].unpivot(
        ["table_name", "raw_folder"], ["raw_count", "stg_count", "mrg_count", "expected_mrg_count"], "name", "row_count"
    )
    layer = F.substring_index("name", "_", 1)
    return long.select(
        "table_name", layer.alias("layer"), "row_count", F.when(layer == "raw", F.col("raw_folder")).alias("cda_folder")
    )


def _audit(x: Inputs) -> DataFrame:
    manifests = x["fx_layer_counts"].select(
        "table_name", F.col("manifest_count").alias("total_records_count"), F.col("manifest_folder").alias("cda_folder")
    )
    return layers.audit_counts(manifests, _layer_counts(x), CTX)


@query
def audit_counts(x: Inputs) -> DataFrame:
    return _audit(x)


@query
def audit_failures(x: Inputs) -> DataFrame:
    return layers.audit_failures(_audit(x), LAYER_SCHEMAS)


@query
def error_log(x: Inputs) -> DataFrame:
    return layers.error_log(layers.audit_failures(_audit(x), LAYER_SCHEMAS), CTX, LAYER_SCHEMAS)


@query
def status_transition(x: Inputs) -> DataFrame:
    outcomes = layers.layer_outcomes(_plan(x), layers.audit_failures(_audit(x), LAYER_SCHEMAS))
    return layers.apply_outcomes(_status(x), outcomes, CTX)


@query
def layer_outcomes(x: Inputs) -> DataFrame:
    return layers.layer_outcomes(_plan(x), layers.audit_failures(_audit(x), LAYER_SCHEMAS))


@query
def raw_load(x: Inputs) -> DataFrame:
    return layers.raw_load(layers.in_window(x["fx_cdc"], x["fx_cdc_plan"]), CTX)


@query
def stage_load(x: Inputs) -> DataFrame:
    """Two schema versions of the batch, the first without a payload, beside rows of an older batch."""
    changes = layers.in_window(x["fx_cdc"], x["fx_cdc_plan"])
    raw = layers.raw_load(changes, CTX)
    first = raw.where(F.col("cda_folder") < 20240116).drop("payload").withColumn("legacy", F.lit(1))
    second = raw.where(F.col("cda_folder") >= 20240116)
    older = layers.raw_load(x["fx_cdc"].where(F.col("cda_folder") <= 20240110), EARLIER)
    return layers.stage_load([first, second, older], CTX.batch_id, raw.schema)


CDC_COLUMNS = ["id", "seqval", "payload_ts", "operation", "payload"]


@named("latest_per_key")
def latest_per_id(x: Inputs) -> DataFrame:
    return latest_per_key(x["fx_cdc"].select(CDC_COLUMNS), ["id"], ["seqval"])


@query
def merge_load(x: Inputs) -> DataFrame:
    changes = x["fx_cdc"].select(CDC_COLUMNS)
    return layers.merge_load(layers.empty_merged(changes), changes, CTX)


@query
def merge_load_second_batch(x: Inputs) -> DataFrame:
    changes = x["fx_cdc"].select(CDC_COLUMNS)
    cutoff = ntz(datetime(2024, 1, 16))
    first = layers.merge_load(layers.empty_merged(changes), changes.where(F.col("payload_ts") < cutoff), EARLIER)
    return layers.merge_load(first, changes.where(F.col("payload_ts") >= cutoff), CTX)


@query
def merge_load_lines(x: Inputs) -> DataFrame:
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"]
    changes = x["fx_line_changes"]
    return layers.merge_load(layers.empty_merged(changes), changes, CTX, order=order)


@query
def merge_load_lines_second_batch(x: Inputs) -> DataFrame:
    """Two batches that interleave in time: the second holds older and newer changes of known keys."""
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"]
    changes = x["fx_line_changes"]
    in_first = F.col("operation") == "U"
    first = layers.merge_load(layers.empty_merged(changes), changes.where(in_first), EARLIER, order=order)
    return layers.merge_load(first, changes.where(~in_first), CTX, order=order)


@query
def merge_touched_partitions(x: Inputs) -> DataFrame:
    """The second batch of line changes merged into the partitions its keys fall into."""
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"]
    changes = x["fx_line_changes"]
    in_first = F.col("operation") == "U"
    first = layers.merge_load(layers.empty_merged(changes), changes.where(in_first), EARLIER, order=order)

    def step(before: DataFrame, batch: DataFrame) -> DataFrame:
        return layers.merge_load(before, batch, CTX, order=order, with_action=True)

    return partitions.touched_partitions(first, changes.where(~in_first), ["id"], PARTS, step)


def _sixteen_digits(number: str) -> Column:
    """A whole number as 16 hexadecimal digits that ascend with it, negative ones and nulls first."""
    shifted = F.col(number).cast("bigint").bitwiseXOR(F.lit(-(2**63)))
    return F.lpad(F.coalesce(F.hex(shifted), F.lit("0")), 16, "0")


@query
def merge_load_hex_order(x: Inputs) -> DataFrame:
    """The line changes ordered by a hexadecimal sequence, in two batches.

    The sequence is one number: the digits of the time of shipment, then the line, part and supplier at full width, so
    that no key runs into the digits before it.
    """
    shipped = F.rpad(F.translate(F.col("l_shipdate").cast("string"), "-: .", ""), 20, "0")
    rest = [_sixteen_digits(c) for c in ("l_linenumber", "l_partkey", "l_suppkey")]
    sequence = F.concat(F.lit("0x"), F.coalesce(shipped, F.lit("0")), *rest)
    changes = x["fx_line_changes"].withColumn("sequence", sequence)
    options = {"order": ["sequence"], "hexadecimal": ["sequence"]}
    in_first = F.col("operation") == "U"
    first = layers.merge_load(layers.empty_merged(changes), changes.where(in_first), EARLIER, **options)
    return layers.merge_load(first, changes.where(~in_first), CTX, **options).drop("sequence")


@query
def merge_load_widened(x: Inputs) -> DataFrame:
    """The first batch holds l_linenumber as int and lacks l_suppkey; the second brings both at full width."""
    order = ["l_shipdate", "l_linenumber", "l_partkey", "id"]
    changes = x["fx_line_changes"]
    old = changes.where(F.col("operation") == "U").withColumn("l_linenumber", F.col("l_linenumber").cast("smallint"))
    first = layers.merge_load(layers.empty_merged(old.drop("l_suppkey")), old.drop("l_suppkey"), EARLIER, order=order)
    merged = layers.merge_load(first, changes.withColumn("l_linenumber", F.col("l_linenumber").cast("bigint")), CTX, order=order)
    return merged.groupBy("operation").agg(F.count("id").alias("n"), F.sum("l_linenumber").alias("lines"), F.count("l_suppkey").alias("with_supplier"))


# Names


@query
def name_pattern(x: Inputs) -> DataFrame:
    return x["fx_tables"].select("table_name", matches_any(F.col("table_name")).alias("matches"))


@query
def blocklist_filter(x: Inputs) -> DataFrame:
    return reconciliation.drop_blocked(x["fx_tables"].select("table_name"), x["fx_listed"])


@query
def blocklist_flag(x: Inputs) -> DataFrame:
    return reconciliation.flag_blocked(x["fx_tables"].select("table_name"), x["fx_listed"])


@query
def tenant_prefix(x: Inputs) -> DataFrame:
    tables = x["fx_tables"]
    return tables.where(in_tenant(F.col("schema_name"), F.col("tenant_table_name"))).select(
        "schema_name", "tenant_table_name"
    )


# Reconciliation


def _mrg_tables(x: Inputs) -> DataFrame:
    return x["fx_tables"].where("in_mrg").select("table_name")


def _replica_tables(x: Inputs) -> DataFrame:
    """Replica tables that pass the block list."""
    return reconciliation.drop_blocked(x["fx_tables"].where("in_replica").select("table_name"), x["fx_listed"])


def _side(x: Inputs, name: str, side: str) -> DataFrame:
    return x[name].where(F.col("side") == side).drop("side")


def _mrg_columns(x: Inputs) -> DataFrame:
    return reconciliation.columns_with_manifest(_side(x, "fx_columns", "mrg"), x["fx_dest_manifest"])


def _mrg_counts(x: Inputs) -> DataFrame:
    return reconciliation.row_counts(_mrg_tables(x), reconciliation.live_rows(_side(x, "fx_table_rows", "mrg")))


def _replica_counts(x: Inputs) -> DataFrame:
    return reconciliation.row_counts(_replica_tables(x), _side(x, "fx_table_rows", "rep"))


def _replica(x: Inputs) -> DataFrame:
    return reconciliation.counts_with_columns(_replica_counts(x), _side(x, "fx_columns", "rep"))


def _comparison(x: Inputs) -> DataFrame:
    return reconciliation.table_comparison(
        _mrg_columns(x), _mrg_counts(x), _replica(x), x["fx_listed"], CTX, SCHEMA
    )


def _printable(comparison: DataFrame) -> DataFrame:
    """Column lists as text. A variance is a set, so it is shown sorted; reasons keep their order."""
    return comparison.select(
        "batch_id", "schema_name", "table_name", "cda_folder", "cda_folder_tms", "cda_schema_id",
        joined("mrg_columns"), joined("replica_columns"),
        F.array_join(F.array_sort("columns_variance"), ",").alias("columns_variance"),
        "mrg_row_count", "replica_row_count", "row_count_variance", "id_beanversion_mismatches",
        joined("exclusion_reason"),
    )


@query
def columns_with_manifest(x: Inputs) -> DataFrame:
    return _mrg_columns(x).withColumn("columns", joined("columns"))


@query
def replica_columns(x: Inputs) -> DataFrame:
    return _replica(x).withColumn("columns", joined("columns"))


@query
def live_rows(x: Inputs) -> DataFrame:
    return reconciliation.live_rows(x["fx_merged"])


@query
def live_row_counts(x: Inputs) -> DataFrame:
    return _mrg_counts(x)


@query
def replica_row_counts(x: Inputs) -> DataFrame:
    return _replica_counts(x)


@query
def column_variance(x: Inputs) -> DataFrame:
    return _printable(_comparison(x)).select("table_name", "columns_variance")


@query
def table_comparison(x: Inputs) -> DataFrame:
    return _printable(_comparison(x)).drop("id_beanversion_mismatches")


@query
def comparison_candidates(x: Inputs) -> DataFrame:
    return reconciliation.comparison_candidates(_comparison(x))


@query
def record_comparison(x: Inputs) -> DataFrame:
    return reconciliation.record_comparison(x["fx_merged"], x["fx_replica"], CTX, SCHEMA)


@query
def record_range_digests(x: Inputs) -> DataFrame:
    return reconciliation.record_range_digests(x["fx_merged"], x["fx_replica"], width=128)


@query
def footer_counts(x: Inputs) -> DataFrame:
    columns = {"customer": "c_custkey", "orders": "o_orderdate", "lineitem": "l_orderkey", "events": "event_id", "documents": "doc_id", "pages": "page_id"}
    return footers.footer_counts(x.spark, {name: (f"{x.sf_dir}/{name}.parquet", column) for name, column in columns.items()})


@query
def record_mismatch_counts(x: Inputs) -> DataFrame:
    records = reconciliation.record_comparison(x["fx_merged"], x["fx_replica"], CTX, SCHEMA)
    return reconciliation.record_mismatch_counts(records)


def _final(x: Inputs) -> DataFrame:
    return reconciliation.reconcile(
        _mrg_columns(x), _mrg_counts(x), _replica(x), x["fx_listed"],
        _side(x, "fx_table_rows", "mrg"), _side(x, "fx_table_rows", "rep"), CTX, SCHEMA,
    )


@query
def table_comparison_final(x: Inputs) -> DataFrame:
    return _printable(_final(x)).select(
        "batch_id", "schema_name", "table_name", "row_count_variance", "id_beanversion_mismatches", "exclusion_reason"
    )


@query
def variance_report(x: Inputs) -> DataFrame:
    return reconciliation.variance_report(_final(x))


@query
def variance_notice(x: Inputs) -> DataFrame:
    return reconciliation.variance_notice(reconciliation.variance_report(_final(x)))


# Outbox


@query
def outbox_pending(x: Inputs) -> DataFrame:
    return outbox.pending(x["fx_outbox"])


@query
def outbox_batches(x: Inputs) -> DataFrame:
    return outbox.batches(x["fx_outbox"], page_size=PAGE).select("identity", "position", "batch_no")


@query
def outbox_payload(x: Inputs) -> DataFrame:
    return outbox.payloads(outbox.pending(x["fx_outbox"])).select("identity", "payload")


@query
def outbox_payload_columns(x: Inputs) -> DataFrame:
    source = outbox.OutboxSource(columns=("segment", "identity"))
    return outbox.payloads(outbox.pending(x["fx_outbox"]), source).select("identity", "payload")


def receiver() -> Callable[[Iterator[list[dict]]], bool]:
    """Takes, refuses or fails on a batch by the number of its rows without a segment.

    Made inside a function so that it travels to the workers by value.
    """

    def send(chunks: Iterator[list[dict]]) -> bool:
        missing = sum(row["segment"] is None for chunk in chunks for row in chunk) % 3
        if missing == 2:
            raise ConnectionError("no answer")
        return missing == 0

    return send


@query
def outbox_writeback(x: Inputs) -> DataFrame:
    """Each source names its columns: one that sends the segment only."""
    paged = outbox.batches(x["fx_outbox"], page_size=PAGE)
    source = outbox.OutboxSource(columns=("segment",))
    return outbox.write_back(x["fx_outbox"], paged, outbox.deliver(paged, receiver(), source))


# Quota and reports


@query
def quota_report(x: Inputs) -> DataFrame:
    return quota.quota_report(x["fx_monitors"], AS_OF)


@query
def quota_bars(x: Inputs) -> DataFrame:
    return quota.quota_figures(x["fx_monitors"], AS_OF).select(
        "name", "time_cells", "credit_cells", "suspend_cell", "stop_cell", "time_bar", "credit_bar"
    )


@query
def failure_report(x: Inputs) -> DataFrame:
    return reports.failure_report(x["fx_errors"])


@query
def failure_report_parts(x: Inputs) -> DataFrame:
    """The whole report as bounded rows, however many errors a center has."""
    return reports.failure_report(x["fx_errors"], parts=True)


@query
def table_failure_notice_parts(x: Inputs) -> DataFrame:
    schema = F.concat(F.lit("MRG_"), F.upper("core_center"))
    return reports.table_failure_notice(x["fx_errors"].withColumn("schema_name", schema), parts=True)


@query
def failure_report_cut(x: Inputs) -> DataFrame:
    """As a channel gets it that takes 1500 characters."""
    return reports.failure_report(x["fx_errors"], limit=1500)


@query
def table_failure_notice(x: Inputs) -> DataFrame:
    schema = F.concat(F.lit("MRG_"), F.upper("core_center"))
    return reports.table_failure_notice(x["fx_errors"].withColumn("schema_name", schema))
