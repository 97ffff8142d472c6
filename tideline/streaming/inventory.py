"""The inventory as a stream: figures of the folders that arrived since the last run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tideline.context import RunContext, ensure_checkpoint_dir
from tideline.operators.inventory import FILE_COUNTS, file_rollup, upsert_file_counts
from tideline.sources.landing import landing_stream
from tideline.sources.versions import VersionedTable


def inventory_stream(
    spark: SparkSession,
    root: str,
    file_counts: VersionedTable,
    system: str,
    core_center: str,
    checkpoint: str,
    ctx: RunContext,
    slices: int = 1,
) -> StreamingQuery:
    """Merge the figures of every folder above the marks of `checkpoint` and stop when it is done.

    A folder lies whole in one micro-batch, so its figures are final, and a repeated micro-batch sets the same ones again.
    """
    ensure_checkpoint_dir(spark)
    schema = StructType.fromDDL(FILE_COUNTS)

    def merge(batch: DataFrame, number: int) -> None:
        listing = batch.select("object_key", "size_bytes", "last_modified")
        rollup = file_rollup(listing, ctx, system, core_center).to(schema)
        known = file_counts.read() if file_counts.latest() else batch.sparkSession.createDataFrame([], schema)
        file_counts.write(upsert_file_counts(known, rollup))

    return (
        landing_stream(spark, root, slices=slices)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
