"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.context import ensure_checkpoint_dir, name_local_checkpoint_dir

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame) -> DataFrame:
    """The frame, written as compressed Parquet below the shared checkpoint folder and read again.

    Cuts the lineage like checkpoint(), but columnar. The folder goes when the application ends.
    """
    spark = frame.sparkSession
    name_local_checkpoint_dir(spark)
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4()}"
    frame.write.option("compression", "zstd").parquet(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(frame.schema).parquet(path)


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """A column name for each given one that the frame does not have yet (Spark ignores case)."""
    taken = {c.lower() for c in frame.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model may learn from: crc32 of the id as text, divisible by 5. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_labels(documents: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """(doc_id, label) of at most `limit` labelled documents that are not held out.

    Labels of documents that are not given take no place. One row per document, the larger label where rows differ; null ids and labels are left
    out. Beyond `limit`, the documents with the smallest hash of their id are taken.
    """
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .join(documents.select("doc_id"), "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )


def training_texts(documents: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """(doc_id, text, label): the bounded sample a classifier is fitted on.

    The ids are chosen from the labels and the documents' ids, so no text moves but the sample's; `limit` rows are broadcast.
    """
    chosen = training_labels(documents, labels, label, limit)
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id")


def gram_hashes(codes: np.ndarray, n: int, bits: int) -> np.ndarray:
    """A hash of `bits` bits for each run of n codes (unsigned 32-bit)."""
    count = len(codes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint32)
    h = np.full(count, n * 2654435761 & 0xFFFFFFFF, np.uint32)
    for j in range(n):
        h = (h ^ codes[j : j + count]) * np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
    return (h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits)


def numbered(rows: DataFrame, groups: list[str], order: list[Column | str], name: str) -> DataFrame:
    """The rows with `name`, their 0-based place in their group by `order`, gapless.

    Rows are dealt by range of (groups, order) and sorted inside each range, so a group of any size is spread; what
    is joined on is the start of each group in each range, (groups + ranges) rows at most. Rows that tie in all of
    `order` are told apart by a running number fixed in a stored copy, so a repeated task deals each row alike.
    """
    tie, part, local = fresh(rows, "tie", "part", "local")
    base = stored(rows.withColumn(tie, F.monotonically_increasing_id()))
    running = F.monotonically_increasing_id()  # the range's number above 33 bits of the row's number in it
    ranged = stored(
        base.repartitionByRange(*groups, *order, tie)
        .sortWithinPartitions(*groups, *order, tie)
        .withColumn(local, running)
        .withColumn(part, F.shiftright(local, 33))
        .drop(tie)
    )
    first, size, before = fresh(ranged, "first", "size", "before")
    sizes = ranged.groupBy(part, *groups).agg(F.min(local).alias(first), F.count("*").alias(size))
    earlier = Window.partitionBy(*groups).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn(before, F.coalesce(F.sum(size).over(earlier), F.lit(0)))
    keys = fresh(ranged, *[f"of_{g}" for g in groups])
    starts = starts.select(F.col(part).alias(f"{part}_"), *[F.col(g).alias(k) for g, k in zip(groups, keys)], first, before)
    same = F.col(part) == F.col(f"{part}_")
    for group, key in zip(groups, keys):
        same &= F.col(group).eqNullSafe(F.col(key))
    place = (F.col(before) + F.col(local) - F.col(first)).cast("bigint")
    return ranged.join(starts, same).select(*rows.columns, place.alias(name))
