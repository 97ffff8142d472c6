"""Counts and bounds from Parquet footers: no data page is read."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def file_rows(files: DataFrame) -> DataFrame:
    """(file, rows) of the Parquet files of a read frame. No column is asked for, so tasks open footers only."""
    return files.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"))


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose Parquet scans answer count, min and max from the footers."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def footer_counts(spark: SparkSession, tables: Mapping[str, tuple[str, str]]) -> DataFrame:
    """(table_name, column_name, row_count, least, greatest) from name to (path, column of whole numbers or dates).

    Bounds are text, null for a table without rows or values. One branch per table, each over its footers.
    """
    session, out = footer_session(spark), None
    for name, (path, column) in tables.items():
        rows = session.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"), F.min(column).alias("least"), F.max(column).alias("greatest"))
        one = rows.select(
            F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), "row_count",
            F.col("least").cast("string").alias("least"), F.col("greatest").cast("string").alias("greatest"),
        )
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no tables named")
    return out


def write_observed(
    frame: DataFrame, write: Callable[[DataFrame], None], written: Callable[[], DataFrame], metrics: Sequence[Column] = ()
) -> dict:
    """Write a frame and return `rows` and the named metrics, as counted by the writing tasks themselves.

    Tasks that are repeated after an executor is lost may be counted twice, so `rows` is held against the footers of what was
    written; where they differ, or nothing was observed, the rows written are counted by a scan. Metrics must be of
    columns that are written.
    """
    asked = [F.count(F.lit(1)).alias("rows"), *metrics]
    seen = Observation()
    write(frame.observe(seen, *asked))
    found, there = observed(seen), written().count()
    if found.get("rows") != there:
        return written().agg(*asked).first().asDict()
    return found


def observed(seen: Observation) -> dict:
    """The metrics of a finished write; none where the optimizer found the frame empty."""
    metrics = dict(seen.get)
    return metrics if metrics.get("rows") is not None else {}
