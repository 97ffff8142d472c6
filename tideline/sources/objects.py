"""Object listings and change files."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.keys import DATA_SUFFIX, is_data_file
from tideline.sources.stores import open_store, uri_prefix

#: Folders opened by one scan.
FOLDERS_PER_SCAN = 10_000
#: Entries of a folder that are sent on at once.
ENTRIES_PER_BATCH = 10_000
LISTING_SCHEMA = "object_key string, size_bytes bigint, last_modified timestamp"


def object_listing(spark: SparkSession, root: str, pattern: str = "*" + DATA_SUFFIX) -> DataFrame:
    """Data files below a folder. Only file attributes are selected, so no content is read.

    The driver holds this listing while it plans the scan. Use
    `object_listing_by_folder` for a store with many millions of objects.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    return files.select(
        F.col("path").alias("object_key"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("last_modified"),
    )


def _children(batches: Iterator[pa.RecordBatch], want: pafs.FileType) -> Iterator[pa.RecordBatch]:
    """Files or folders directly below each folder of a task's share."""
    for batch in batches:
        for uri in batch.column("folder").to_pylist():
            store, path = open_store(uri)
            prefix = uri_prefix(uri, path)
            listed = store.get_file_info(pafs.FileSelector(path, allow_not_found=True))
            found = [i for i in listed if i.type == want]
            for at in range(0, len(found), ENTRIES_PER_BATCH):
                entries = found[at : at + ENTRIES_PER_BATCH]
                yield pa.record_batch(
                    {
                        "object_key": pa.array([prefix + i.path for i in entries], pa.string()),
                        "size_bytes": pa.array([i.size or 0 for i in entries], pa.int64()),
                        "last_modified": pa.array([i.mtime for i in entries], pa.timestamp("us", "UTC")),
                    }
                )


def _listed(folders: DataFrame, want: pafs.FileType) -> DataFrame:
    return folders.repartition(F.col("folder")).mapInArrow(lambda batches: _children(batches, want), LISTING_SCHEMA)


def subfolder_listing(folders: DataFrame, depth: int = 2) -> DataFrame:
    """Folders `depth` levels below the given ones (URIs in column `folder`), listed by the executors.

    Every level is spread over the tasks again, so one table with most of the folders does
    not sit in one task.
    """
    level = folders.select("folder")
    for _ in range(depth):
        level = _listed(level, pafs.FileType.Directory).select(F.col("object_key").alias("folder"))
    return level


def object_listing_by_folder(folders: DataFrame, depth: int = 2) -> DataFrame:
    """Data files in the schema id and timestamp folders below many table folders."""
    return data_files(_listed(subfolder_listing(folders, depth), pafs.FileType.File))


def data_files(listing: DataFrame) -> DataFrame:
    """The listing rows that are data files."""
    return listing.where(is_data_file(F.col("object_key")))


def archive_candidates(inventory: DataFrame, prefix: str = "") -> DataFrame:
    """Keys in deep archive that no restore is running for; an unknown state counts as none."""
    waiting = (F.col("storage_class") == "DEEP_ARCHIVE") & ~F.col("restore_state").eqNullSafe(F.lit("ongoing-request"))
    return inventory.where(waiting & F.col("object_key").startswith(prefix)).select("object_key")


def source_folder() -> Column:
    """The timestamp folder of the file a row was read from."""
    return F.try_element_at(F.split(F.col("_metadata.file_path"), "/"), F.lit(-2)).try_cast("bigint")


def read_changes(
    spark: SparkSession,
    root: str,
    table_name: str,
    cda_schema_id: str,
    low: int | None,
    high: int,
    folders: Sequence[str],
) -> DataFrame:
    """Change rows of one table and schema id from the named folders with `low < timestamp <= high`.

    The folders are opened by name, `FOLDERS_PER_SCAN` to a scan, so a window of any size lists its own
    folders only and takes its schema from them. A scan that lacks a column gives nulls.
    """
    base = f"{root.rstrip('/')}/{table_name}/{cda_schema_id}"
    folder = source_folder()
    scans = [
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*" + DATA_SUFFIX)
        .parquet(*[f"{base}/{name}" for name in folders[at : at + FOLDERS_PER_SCAN]])
        .where((folder > F.lit(low or 0)) & (folder <= F.lit(high)))
        .withColumn("cda_folder", folder)
        for at in range(0, len(folders), FOLDERS_PER_SCAN)
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
