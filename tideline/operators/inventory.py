"""Object inventory: folders, their rollup and the comparison of two systems."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.context import RunContext
from tideline.functions.keys import path_parts
from tideline.operators.upsert import src, upsert
from tideline.sources.objects import data_files

FOLDER = ["table_name", "cda_schema_id", "cda_timestamp"]
FILE_COUNT_KEY = ["system", "core_center", *FOLDER]
FILE_COUNTS = (
    "system string, core_center string, table_name string, cda_schema_id string, cda_timestamp string,"
    " total_bytes bigint, file_count bigint, max_last_modified timestamp,"
    " row_insert_tms timestamp_ntz, row_update_tms timestamp_ntz"
)


def with_path_parts(listing: DataFrame) -> DataFrame:
    return listing.withColumns(path_parts(F.col("object_key")))


def folder_rows(listing: DataFrame) -> DataFrame:
    """The folder of every data file, a row for each file."""
    return with_path_parts(data_files(listing)).select(*FOLDER)


def folders(listing: DataFrame) -> DataFrame:
    """Every table, schema id and timestamp folder that holds a data file."""
    return folder_rows(listing).distinct()


def file_rollup(listing: DataFrame, ctx: RunContext, system: str, core_center: str) -> DataFrame:
    """Bytes, files and newest change per folder, in the layout of the file-count table.

    A data file outside a table, schema id and timestamp folder is an error.
    """
    placed = with_path_parts(data_files(listing))
    misplaced = F.raise_error(F.concat(F.lit("data file outside a table folder: "), F.col("object_key"))).cast("string")
    return (
        placed.withColumn("table_name", F.coalesce("table_name", misplaced))
        .groupBy(*FOLDER)
        .agg(
            F.sum("size_bytes").alias("total_bytes"),
            F.count(F.lit(1)).alias("file_count"),
            F.max("last_modified").alias("max_last_modified"),
        )
        .select(
            F.lit(system).alias("system"),
            F.lit(core_center).alias("core_center"),
            *FOLDER,
            "total_bytes",
            "file_count",
            "max_last_modified",
            ctx.now.alias("row_insert_tms"),
            ctx.now.alias("row_update_tms"),
        )
    )


def upsert_file_counts(target: DataFrame, rollup: DataFrame, **options) -> DataFrame:
    """New figures for known folders, new rows for others; the insert time of known folders stays."""
    changed = ["total_bytes", "file_count", "max_last_modified", "row_update_tms"]
    return upsert(
        target, rollup, FILE_COUNT_KEY, update={c: src(c) for c in changed}, unique_source=True, **options
    )


def inventory_compare(file_counts: DataFrame, system: str, other: str) -> DataFrame:
    """Folders of two systems side by side. Both are rows of the file-count table, so one
    grouping replaces the join."""

    def side(name: str, column: str):
        return F.max(F.when(F.col("system") == name, F.col(column)))

    compared = file_counts.groupBy("core_center", *FOLDER).agg(
        side(system, "total_bytes").alias("bytes"),
        side(other, "total_bytes").alias("other_bytes"),
        side(system, "file_count").alias("files"),
        side(other, "file_count").alias("other_files"),
    )
    bytes_diff = F.coalesce("bytes", F.lit(0)) - F.coalesce("other_bytes", F.lit(0))
    files_diff = F.coalesce("files", F.lit(0)) - F.coalesce("other_files", F.lit(0))
    finding = (
        F.when(F.col("other_files").isNull(), f"missing in {other}")
        .when(F.col("files").isNull(), f"missing in {system}")
        .when(files_diff != 0, "file count differs")
        .when(bytes_diff != 0, "bytes differ")
        .otherwise("equal")
    )
    return compared.withColumns({"bytes_diff": bytes_diff, "files_diff": files_diff, "finding": finding})
