"""Numbering rows in key order and cutting them into pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tideline.context import ensure_checkpoint_dir

_ROW_BITS = 33


def number_rows(frame: DataFrame, order: str, slices: int | None = None) -> DataFrame:
    """A snapshot of the frame with the 0-based `position` of each row in `order`.

    Rows are range-partitioned and sorted inside each slice, with no global sort into
    one task; a hash of the row as second key lets many rows of one `order` value fall
    into several slices (a hash, not a running number: a repeated task must send each row
    to the same slice). The slices are checkpointed: offsets and rows must come from the
    same partitioning, and callers that change the source later keep a stable snapshot.
    The driver sees one count per slice.
    """
    spark = frame.sparkSession
    ensure_checkpoint_dir(spark)
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    hashed = [f.name for f in frame.schema.fields if not isinstance(f.dataType, MapType)]
    sliced = (
        frame.withColumn("_tie", F.xxhash64(*hashed))
        .repartitionByRange(slices, order, "_tie")
        .sortWithinPartitions(order, "_tie")
        .drop("_tie")
        .withColumns({"_slice": F.spark_partition_id(), "_row": local})
        .checkpoint(eager=True)
    )
    sizes = {r["_slice"]: r["n"] for r in sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, total = [], 0
    for number in sorted(sizes):
        offsets.append((number, total))
        total += sizes[number]
    starts = spark.createDataFrame(offsets, "_slice int, _start bigint")
    return (
        sliced.join(F.broadcast(starts), "_slice")
        .withColumn("position", F.col("_start") + F.col("_row"))
        .drop("_slice", "_row", "_start")
    )


def page_rows(frame: DataFrame, order: str, page_size: int, slices: int | None = None) -> DataFrame:
    """Rows with `position` and `batch_no`, `page_size` rows to a batch."""
    numbered = number_rows(frame, order, slices)
    return numbered.withColumn("batch_no", F.floor(F.col("position") / F.lit(page_size)).cast("bigint"))
