"""Which tables to load, through which layers, and from which folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.context import RunContext
from tideline.functions.names import HEARTBEAT
from tideline.operators.upsert import src, tgt, truncate, upsert

LAYERS = ("raw", "stg", "mrg")
MANIFEST_COLUMNS = ["cda_schema_id", "cda_folder", "cda_folder_tms", "total_records_count"]


def mode_flags(core_centers: DataFrame, is_incremental: bool) -> DataFrame:
    """Load flags of the run mode and upper-case schema names per core center."""

    def flag(layer: str) -> Column:
        incremental, initial = F.col(f"{layer}_incremental_load_flag"), F.col(f"{layer}_initial_load_flag")
        return F.when(F.lit(is_incremental), incremental == F.lit(True)).otherwise(initial == F.lit(True))

    return core_centers.select(
        F.upper("core_center").alias("core_center"),
        flag("s3").alias("s3_load_enabled"),
        flag("mrg").alias("mrg_load_enabled"),
        F.upper("raw_schema_name").alias("raw_schema_name"),
        F.upper("stg_schema_name").alias("stg_schema_name"),
        F.upper("merge_schema_name").alias("mrg_schema_name"),
    )


def status_by_table(load_status: DataFrame) -> DataFrame:
    """One row per table with its status in each layer: one shuffle in place of three joins."""
    return load_status.groupBy(F.lower("table_name").alias("table_name")).agg(
        *[F.max(F.when(F.col("layer") == layer, F.col("status"))).alias(f"{layer}_status") for layer in LAYERS]
    )


def load_plan(
    new_manifest: DataFrame, loaded_manifest: DataFrame, load_status: DataFrame, *, s3_on: bool, mrg_on: bool
) -> DataFrame:
    """Tables of the new manifest with work to do.

    A table is loaded from storage if it never was or if the manifest is newer. Each
    later layer runs if the one before it does or if its own status is not
    `completed`. Flags follow three-valued logic: an unknown write time leaves
    `load_s3` null.
    """
    new = new_manifest.where(F.lower("table_name") != HEARTBEAT).alias("new")
    loaded = loaded_manifest.alias("old")
    status = status_by_table(load_status).alias("st")

    def unfinished(layer: str) -> Column:
        return ~F.col(f"st.{layer}_status").eqNullSafe(F.lit("completed"))

    load_s3 = F.col("old.cda_folder_tms").isNull() | (F.col("new.cda_folder_tms") > F.col("old.cda_folder_tms"))
    planned = (
        new.join(loaded, F.col("new.table_name") == F.col("old.table_name"), "left")
        .join(status, F.lower("new.table_name") == F.col("st.table_name"), "left")
        .withColumn("load_s3", load_s3)
        .withColumn("load_raw", F.col("load_s3") | unfinished("raw"))
        .withColumn("load_stg", F.col("load_raw") | unfinished("stg"))
        .withColumn("load_mrg", F.col("load_stg") | unfinished("mrg"))
    )
    any_layer = F.col("load_raw") | F.col("load_stg") | F.col("load_mrg")
    return planned.where((F.lit(s3_on) & F.col("load_s3")) | (F.lit(mrg_on) & any_layer)).select(
        F.lower("new.table_name").alias("table_name"),
        F.col("new.cda_schema_id").alias("src_cda_schema_id"),
        F.col("new.cda_folder").cast("bigint").alias("src_cda_folder"),
        F.col("new.cda_folder_tms").alias("src_cda_folder_tms"),
        F.col("new.total_records_count").alias("src_total_records_count"),
        F.col("old.cda_folder").cast("bigint").alias("dest_cda_folder"),
        F.col("old.cda_folder_tms").alias("dest_cda_folder_tms"),
        "load_s3",
        F.coalesce("st.raw_status", F.lit("initial")).alias("raw_status"),
        "load_raw",
        F.coalesce("st.stg_status", F.lit("initial")).alias("stg_status"),
        "load_stg",
        F.coalesce("st.mrg_status", F.lit("initial")).alias("mrg_status"),
        "load_mrg",
    )


def initial_load_plan(
    new_manifest: DataFrame, loaded_manifest: DataFrame, load_status: DataFrame, *, s3_on: bool, mrg_on: bool
) -> DataFrame:
    """The plan of an initial load: control tables are cleared first."""
    return load_plan(new_manifest, truncate(loaded_manifest), truncate(load_status), s3_on=s3_on, mrg_on=mrg_on)


#: Bounds (one row a planned table, three short values) are broadcast up to so many, some 2 MB.
FEW_TABLES = 20_000


def folder_window(folders: DataFrame, plan: DataFrame) -> DataFrame:
    """Folders above the last loaded one and up to the manifest's, for tables to load from storage.

    Folders at or below the low mark are never picked up again. Pass a plan that is stored: its rows are
    counted here, and few of them are broadcast, so that no table's folders meet in one task.
    """
    bounds = plan.where("load_s3").select(
        F.col("table_name").alias("_table"), F.coalesce("dest_cda_folder", F.lit(0)).alias("_low"), F.col("src_cda_folder").alias("_high")
    )
    if bounds.limit(FEW_TABLES + 1).count() <= FEW_TABLES:
        bounds = F.broadcast(bounds)
    stamp = F.col("cda_timestamp").cast("bigint")
    # Both tests are written so that Spark derives no null checks from them: it would put those before the projection
    # and take each path apart several times. A planned table has a name.
    return (
        folders.join(bounds, F.col("table_name").eqNullSafe(F.col("_table")))
        .where(F.coalesce((stamp > F.col("_low")) & (stamp <= F.col("_high")), F.lit(False)))
        .drop("_table", "_low", "_high")
    )


def upsert_manifest(loaded: DataFrame, new: DataFrame, ctx: RunContext, **options) -> DataFrame:
    """Loaded manifest after a load: newer entries replace older ones, unknown tables are added."""
    update = {c: src(c) for c in MANIFEST_COLUMNS} | {"row_update_tms": ctx.now}
    insert = {c: src(c) for c in ["table_name", *MANIFEST_COLUMNS]} | {
        "row_insert_tms": ctx.now,
        "row_update_tms": ctx.now,
    }
    newer = tgt("cda_folder_tms") < src("cda_folder_tms")
    return upsert(loaded, new, ["table_name"], update=update, insert=insert, update_when=newer, **options)


def upsert_load_status(load_status: DataFrame, touched: DataFrame, ctx: RunContext, **options) -> DataFrame:
    """Status rows after files of the touched (layer, table) pairs arrived.

    A completed row becomes pending with this batch; other rows stay as they are. A
    new row starts as `initial`, without a batch.
    """
    update = {"batch_id": ctx.batch, "status": F.lit("pending"), "row_insert_tms": ctx.now, "row_update_tms": ctx.now}
    insert = {"layer": src("layer"), "table_name": src("table_name"), "status": F.lit("initial")}
    completed = F.lower(tgt("status")) == "completed"
    return upsert(
        load_status, touched, ["layer", "table_name"],
        update=update, insert=insert, update_when=completed, match=F.lower, **options,
    )


def touched_layers(plan: DataFrame) -> DataFrame:
    """Every layer of the tables loaded from storage."""
    return plan.where("load_s3").select(F.explode(F.array(*map(F.lit, LAYERS))).alias("layer"), "table_name")


def arrived_entries(new_manifest: DataFrame, plan: DataFrame) -> DataFrame:
    """Manifest entries of the tables loaded from storage."""
    arrived = plan.where("load_s3").select(F.col("table_name").alias("_arrived"))
    return new_manifest.join(arrived, F.lower("table_name") == F.col("_arrived"), "left_semi")


def name_of_layer(layer: Column, names: dict[str, str]) -> Column:
    """What a layer is called: its schema or its step."""
    chosen = F.lit(None).cast("string")
    for key, name in names.items():
        chosen = F.when(layer == key, F.lit(name)).otherwise(chosen)
    return chosen


def process_log(merged: DataFrame, process_name: str, schema_name: Column, ctx: RunContext) -> DataFrame:
    """One log row per source row of an upsert (its result with `_action`), with the rows it wrote: 0 or 1."""
    return merged.where(F.col("_action") != "keep").select(
        ctx.batch.alias("batchid"),
        schema_name.alias("schema_name"),
        "table_name",
        F.lit(ctx.job_name).alias("job_name"),
        F.lit(process_name).alias("process_name"),
        F.when(F.col("_action") == "match", 0).otherwise(1).cast("bigint").alias("row_count"),
    )


def arrival_log(statuses: DataFrame, manifests: DataFrame, schema_names: dict[str, str], ctx: RunContext) -> DataFrame:
    """The process log of registered files: a row per table and layer, and one per manifest entry
    under the raw schema."""
    by_layer = process_log(statuses, "merge into load status", name_of_layer(F.col("layer"), schema_names), ctx)
    return by_layer.unionByName(process_log(manifests, "merge into manifest details", F.lit(schema_names["raw"]), ctx))
