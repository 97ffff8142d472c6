"""Merged tables in hash partitions of their key: a merge reads and writes those its changes touch.

Below the table's folder lie `load=n/part=p`, the files of partition p as load n wrote them, and `control`, a
versioned table of one row per partition that says in which load it lies and how many rows it has. A version is a
control version: a merge writes the touched partitions to a new load and a control version in which only their
rows changed. Nothing that a reader may be using is written over.

For batches that touch most partitions, a bucketed `VersionedTable` shuffles less: here the touched
partitions are shuffled with the changes, there the changes alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideline.operators.upsert import ACTION
from tideline.sources.footers import observed
from tideline.sources.stores import open_store
from tideline.sources.versions import Merge, VersionedTable, subfolders

CONTROL = "part int, load bigint, row_count bigint"
PART = "_part"


def part_of(key: Sequence[str], parts: int) -> Column:
    """The partition of a key. Spark deals join keys by the same hash, so with a multiple of the shuffle
    partitions every partition leaves a merge from one task, as one file."""
    return F.pmod(F.hash(*key), F.lit(parts)).cast("int")


def touched_partitions(
    target: DataFrame, changes: DataFrame, key: Sequence[str], parts: int, step: Callable[[DataFrame, DataFrame], DataFrame]
) -> DataFrame:
    """(part, rows_read, rows_inserted, rows_updated) of the partitions that changes touch.

    `step(rows of those partitions, changes)` is an upsert with actions; other rows of the target do not reach it.
    """
    part = part_of(key, parts)
    touched = changes.select(part.alias("part")).distinct()
    read = target.withColumn("part", part).join(touched, "part", "left_semi").drop("part")

    def rows(*actions: str) -> Column:
        return F.count_if(F.col(ACTION).isin(*actions))

    return step(read, changes).groupBy(part.alias("part")).agg(
        rows("keep", "match", "update").alias("rows_read"), rows("insert").alias("rows_inserted"), rows("update").alias("rows_updated")
    )


@dataclass(frozen=True)
class PartitionedTable:
    """A table of hash partitions by `key`, `parts` of them. The key holds no nulls."""

    spark: SparkSession
    path: str
    key: tuple[str, ...]
    parts: int

    @property
    def control(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.path}/control", StructType.fromDDL(CONTROL), marker="_PUBLISHED")

    def latest(self) -> int | None:
        return self.control.latest()

    def publish(self, version: int) -> None:
        self.control.publish(version)

    def read(self, version: int | None = None, parts: Iterable[int] | None = None) -> DataFrame:
        """A version, by default the newest published, or some partitions of it; only their folders are opened."""
        version = version or self.latest()
        if version is None:
            raise FileNotFoundError(f"no published version below {self.path}")
        rows = self.control.read(version).collect()  # one row a partition
        newest = max((r["load"] for r in rows), default=None)
        if newest is None:
            raise FileNotFoundError(f"version {version} below {self.path} holds no rows")
        schema = self._schema(newest)
        wanted = None if parts is None else set(parts)
        folders = [self._folder(r["load"], r["part"]) for r in rows if r["row_count"] and (wanted is None or r["part"] in wanted)]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def _load(self, load: int) -> str:
        return f"{self.path.rstrip('/')}/load={load}"

    def _folder(self, load: int, part: int) -> str:
        return f"{self._load(load)}/{PART}={part}"

    def _schema(self, load: int) -> StructType:
        """The columns of the newest load: a merge keeps all earlier columns and only widens types."""
        folder = next(iter(subfolders(self._load(load), PART).values()))
        return self.spark.read.parquet(folder).schema

    def merge(self, known: int | None, changes: DataFrame, empty: DataFrame, step: Callable[[DataFrame, DataFrame], DataFrame]) -> Merge:
        """Apply `step(rows of the touched partitions, changes)`, an upsert with actions, and write a version, not published yet.

        `empty` has the columns of a first version. The numbers of the touched partitions come to the driver, `parts` at most.
        """
        part = part_of(self.key, self.parts).alias("part")
        touched = [r["part"] for r in changes.select(part).distinct().collect()]
        before = empty if known is None else self.read(known, touched)
        load = max(map(int, subfolders(self.path, "load")), default=0) + 1
        seen = Observation()
        counted = [F.count(F.lit(1)).alias("rows"), F.count_if(F.col(ACTION) == "insert").alias("inserted"), F.count_if(F.col(ACTION) == "update").alias("updated")]
        merged = step(before, changes).observe(seen, *counted)
        merged.drop(ACTION).withColumn(PART, part_of(self.key, self.parts)).write.partitionBy(PART).parquet(self._load(load))

        rows = [r for r in ([] if known is None else self.control.read(known).collect())]
        old = {r["part"]: (r["load"], r["row_count"]) for r in rows}
        written = self.spark.read.schema(before.schema).parquet(self._load(load)) if touched else None
        # Only footers are opened: the partition comes from the folder's name.
        sizes = {} if written is None else {int(r[PART]): r["n"] for r in written.groupBy(PART).agg(F.count(F.lit(1)).alias("n")).collect()}
        now = old | {p: (load, n) for p, n in sizes.items()}
        control = self.spark.createDataFrame([(p, at, n) for p, (at, n) in sorted(now.items())], CONTROL)
        version = self.control.write(control.coalesce(1))
        total = sum(n for _, n in now.values())
        earlier = sum(n for _, n in old.values())
        found = observed(seen)
        if found.get("rows") != sum(sizes.values()):  # repeated tasks were counted twice
            found = {"inserted": total - earlier, "updated": None}
        return Merge(version, total, earlier, found["inserted"], found["updated"])

    def retain(self, versions: int) -> list[str]:
        """Delete what the newest `versions` published versions do not need; returns the folders deleted. Unpublished
        versions newer than these are kept."""
        gone = self.control.retain(versions)
        kept = [int(v) for v in subfolders(f"{self.path}/control", "version")]
        if not kept:
            return gone
        control = reduce(DataFrame.union, [self.control.read(v) for v in kept])
        used = {r["load"] for r in control.select("load").distinct().collect()}
        for number, folder in subfolders(self.path, "load").items():
            if int(number) not in used and int(number) < max(used, default=0):
                store, at = open_store(folder)
                store.delete_dir(at)
                gone.append(folder)
        return gone
