"""Raw, stage and merge layers: loads, audits, statuses."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideline.context import RunContext
from tideline.functions.texts import hex_order
from tideline.operators.history import latest_per_key
from tideline.operators.upsert import src, tgt, update_from, upsert
from tideline.plans.load_plan import LAYERS, name_of_layer

META_COLUMNS = ["batchid", "row_insert_tms", "row_update_tms"]

# The step names written to logs, by layer, where the caller gives none.
STEP_NAMES = {"raw": "load_raw", "stg": "load_stage", "mrg": "load_merge"}


def in_window(changes: DataFrame, plan: DataFrame) -> DataFrame:
    """Change rows of the planned tables from folders of their window."""
    bounds = plan.select(
        F.col("table_name"), F.coalesce("dest_cda_folder", F.lit(0)).alias("_low"), F.col("src_cda_folder").alias("_high")
    )
    return (
        changes.join(bounds, "table_name")
        .where((F.col("cda_folder") > F.col("_low")) & (F.col("cda_folder") <= F.col("_high")))
        .select(*changes.columns)
    )


def raw_load(changes: DataFrame, ctx: RunContext) -> DataFrame:
    """Change rows as they arrived, stamped with the batch."""
    return changes.withColumns({"batchid": ctx.batch, "row_insert_tms": ctx.now, "row_update_tms": ctx.now})


def stage_load(raw: Sequence[DataFrame] | DataFrame, batch_id: int, schema: StructType) -> DataFrame:
    """The batch's rows of every schema version, aligned to one schema.

    The columns of `schema` come first, others of any version after them; a column a version lacks is null,
    and a column whose type differs takes the wider one. No row is dropped here: the audit compares this
    count with the raw count.
    """
    versions = [raw] if isinstance(raw, DataFrame) else list(raw)
    rows = union_of(versions)
    rows = widened(rows.where(F.col("batchid") == F.lit(batch_id)), schema)
    return rows.select(*schema.names, *[c for c in rows.columns if c not in schema.names])


def union_of(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows, with every column of any frame; differing types take the wider one."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def widened(frame: DataFrame, schema: StructType) -> DataFrame:
    """The frame with the columns of `schema` it lacks as nulls, and shared columns in the wider type of both."""
    other = frame.sparkSession.createDataFrame([], schema)
    wide = {f.name: f.dataType for f in frame.limit(0).unionByName(other, allowMissingColumns=True).schema.fields}
    have = {f.name: f.dataType for f in frame.schema.fields}
    changes = {c: F.col(c).cast(kind) for c, kind in wide.items() if c in have and have[c] != kind}
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in have}
    return frame.withColumns(changes | missing)


def delete_flag(operation: Column) -> Column:
    return F.when(operation == "D", "Y").otherwise("N")


def merge_load(
    merged: DataFrame,
    changes: DataFrame,
    ctx: RunContext,
    *,
    key: Sequence[str] = ("id",),
    order: Sequence[str] = ("seqval",),
    operation: str = "operation",
    hexadecimal: Sequence[str] = (),
    **options,
) -> DataFrame:
    """The merged table after a batch: newest change per key, deletes kept with flag `Y`.

    A change is applied only if it is later than the row it meets, so the result does
    not depend on how changes are split into batches or on repeated batches. Equal
    `order` values of one key count as the same change: pass enough columns for a
    total order. `order` columns named in `hexadecimal` hold numbers as hexadecimal text and
    compare as numbers. A null key fails the job, since it would meet nothing and be added again by
    each repeat. Columns that only the changes have are added, and a column takes the wider type
    of both sides.
    """

    def rank(column: str, at: Callable[[str], Column]) -> Column:
        return hex_order(at(column)) if column in hexadecimal else at(column)

    newest = latest_per_key(changes.drop(*META_COLUMNS), list(key), [rank(c, F.col) for c in order])
    merged = widened(merged, newest.schema)
    has_null = F.array_contains(F.array(*[F.col(k).isNull() for k in key]), F.lit(True))
    sound = F.when(~has_null, F.lit(True)).otherwise(F.raise_error(F.lit("null key in changes")).cast("boolean"))
    stamped = newest.where(sound).withColumns(
        {
            "gw_delete_flag": delete_flag(F.col(operation)),
            "batchid": ctx.batch,
            "row_insert_tms": ctx.now,
            "row_update_tms": ctx.now,
        }
    )
    changing = [c for c in merged.columns if c in stamped.columns and c not in key and c != "row_insert_tms"]
    later = F.struct(*[rank(c, src) for c in order]) > F.struct(*[rank(c, tgt) for c in order])
    return upsert(
        merged, stamped, list(key),
        update={c: src(c) for c in changing}, update_when=later, unique_source=True, **options,
    )


def empty_merged(changes: DataFrame) -> DataFrame:
    """An empty merged table for change rows of this shape."""
    columns = [c for c in changes.columns if c not in META_COLUMNS]
    return changes.limit(0).select(
        *columns,
        F.lit(None).cast("string").alias("gw_delete_flag"),
        F.lit(None).cast("bigint").alias("batchid"),
        F.lit(None).cast("timestamp_ntz").alias("row_insert_tms"),
        F.lit(None).cast("timestamp_ntz").alias("row_update_tms"),
    )


def layer_counts(rows: DataFrame, layer: str) -> DataFrame:
    """Rows per table of one layer, with the newest folder where the rows carry one."""
    folder = F.max("cda_folder").cast("string") if "cda_folder" in rows.columns else F.lit(None).cast("string")
    return rows.groupBy("table_name").agg(
        F.lit(layer).alias("layer"), F.count(F.lit(1)).alias("row_count"), folder.alias("cda_folder")
    )


def audit_counts(manifest: DataFrame, counts: DataFrame, ctx: RunContext) -> DataFrame:
    """Counts of all layers per table and their differences.

    `counts` is long: table_name, layer (raw, stg, mrg, expected), row_count, cda_folder.
    A layer without a count leaves its difference null.
    """

    def count_of(layer: str) -> Column:
        return F.max(F.when(F.col("layer") == layer, F.col("row_count")))

    by_table = counts.groupBy(F.lower("table_name").alias("table_name")).agg(
        count_of("raw").alias("raw_count"),
        F.max(F.when(F.col("layer") == "raw", F.col("cda_folder"))).alias("raw_cda_folder"),
        count_of("stg").alias("stg_count"),
        count_of("mrg").alias("mrg_count"),
        count_of("expected").alias("expected_mrg_count"),
    )
    expected = manifest.select(
        F.lower("table_name").alias("table_name"),
        F.col("total_records_count").alias("manifest_total_records_count"),
        F.col("cda_folder").alias("manifest_cda_folder"),
    )
    return expected.join(by_table, "table_name", "left").select(
        "table_name",
        ctx.batch.alias("batch_id"),
        "manifest_total_records_count",
        "raw_count",
        (F.col("raw_count") - F.col("manifest_total_records_count")).alias("total_records_count_diff"),
        "manifest_cda_folder",
        "raw_cda_folder",
        (~F.col("raw_cda_folder").eqNullSafe(F.col("manifest_cda_folder"))).alias("cda_folder_diff"),
        "stg_count",
        (F.col("stg_count") - F.col("raw_count")).alias("stg_count_diff"),
        "mrg_count",
        "expected_mrg_count",
        (F.col("mrg_count") - F.col("expected_mrg_count")).alias("expected_mrg_count_diff"),
    )


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("None"))


def audit_failures(audit: DataFrame, schema_names: dict[str, str]) -> DataFrame:
    """Every failed check as (table_name, layer, error_message). An unknown difference fails too."""

    def failed(diff: str) -> Column:
        return ~F.col(diff).eqNullSafe(F.lit(0))

    def message(layer: str, *parts) -> Column:
        pieces = [_text(p[1:]) if p.startswith("$") else F.lit(p) for p in parts]
        return F.concat(F.lit(schema_names[layer] + "."), F.col("table_name"), F.lit(" | "), *pieces)

    checks = {
        "raw": (
            failed("total_records_count_diff") | F.coalesce("cda_folder_diff", F.lit(False)),
            message(
                "raw", "TOTAL_RECORDS_COUNT: table ", "$raw_count", ", manifest: ", "$manifest_total_records_count",
                " | CDA_FOLDER: table ", "$raw_cda_folder", ", manifest: ", "$manifest_cda_folder",
            ),
        ),
        "stg": (failed("stg_count_diff"), message("stg", "RAW count: ", "$raw_count", ", STG count: ", "$stg_count")),
        "mrg": (
            failed("expected_mrg_count_diff"),
            message("mrg", "MRG count: ", "$mrg_count", ", Expected MRG count: ", "$expected_mrg_count"),
        ),
    }
    found = [
        F.when(bad, F.struct(F.lit(layer).alias("layer"), text.alias("error_message")))
        for layer, (bad, text) in checks.items()
    ]
    return (
        audit.select("table_name", F.explode(F.array(*found)).alias("f"))
        .where(F.col("f").isNotNull())
        .select("table_name", "f.layer", "f.error_message")
    )


def error_log(
    failures: DataFrame, ctx: RunContext, schema_names: dict[str, str], step_names: dict[str, str] | None = None
) -> DataFrame:
    """Failed checks as rows of the error log."""
    return failures.select(
        ctx.batch.alias("batchid"),
        F.lit(ctx.day).alias("day_id"),
        "error_message",
        F.lit("N/A").alias("error_sql"),
        name_of_layer(F.col("layer"), step_names or STEP_NAMES).alias("job_name"),
        ctx.now.alias("row_insert_tms"),
        name_of_layer(F.col("layer"), schema_names).alias("schema_name"),
        "table_name",
    )


def layer_outcomes(plan: DataFrame, failures: DataFrame) -> DataFrame:
    """What each layer of each planned table comes to: (layer, table_name, outcome).

    A layer whose flag is off is `skipped`. A failed layer stops the later layers of
    that table only: they are `blocked`. Others are `completed`.
    """
    failed = failures.groupBy("table_name").agg(
        *[F.max(F.col("layer") == layer).alias(f"_{layer}_failed") for layer in LAYERS]
    )
    rows = plan.join(failed, "table_name", "left")
    stopped, outcomes = F.lit(False), []
    for layer in LAYERS:
        runs = F.coalesce(F.col(f"load_{layer}"), F.lit(False)) & ~stopped
        bad = runs & F.coalesce(F.col(f"_{layer}_failed"), F.lit(False))
        outcome = (
            F.when(stopped, "blocked").when(bad, "failed").when(runs, "completed").otherwise("skipped")
        )
        outcomes.append(F.struct(F.lit(layer).alias("layer"), outcome.alias("outcome")))
        stopped = stopped | bad
    return rows.select("table_name", F.inline(F.array(*outcomes)))


def apply_outcomes(load_status: DataFrame, outcomes: DataFrame, ctx: RunContext) -> DataFrame:
    """Load status with the outcome of the layers that ran; other rows are unchanged."""
    ran = outcomes.where(F.col("outcome").isin("started", "completed", "failed"))
    values = {"batch_id": ctx.batch, "status": src("outcome"), "row_update_tms": ctx.now}
    return update_from(load_status, ran, ["layer", "table_name"], values, match=F.lower)
