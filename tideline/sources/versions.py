"""Tables kept as whole parquet versions: a rewrite goes to a new folder, never onto the one it reads."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from hashlib import sha256
from typing import NamedTuple

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideline.operators.upsert import ACTION
from tideline.sources.footers import observed
from tideline.sources.stores import open_store


class Merge(NamedTuple):
    """A written version: its rows, those of the version before, and what the merge did (None where it is not known)."""

    version: int
    rows: int
    rows_before: int
    inserted: int
    updated: int | None


def subfolders(path: str, name: str) -> dict[str, str]:
    """Folders `name=value` directly below a path, by value."""
    store, folder = open_store(path)
    listed = store.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    found = [i.base_name for i in listed if i.type == pafs.FileType.Directory and i.base_name.startswith(f"{name}=")]
    return {base.split("=", 1)[1]: f"{path.rstrip('/')}/{base}" for base in sorted(found)}


@dataclass(frozen=True)
class VersionedTable:
    """A folder of complete versions, `version=1`, `version=2`, ... The newest finished one counts.

    With `buckets`, versions are bucketed and sorted by `key`. A merge by that key then
    shuffles the changes alone: each task joins one bucket and writes it back, so the next
    version is bucketed without a shuffle of its own. Use at least as many buckets as
    `spark.sql.shuffle.partitions`; Spark ignores fewer in favour of that parallelism.
    """

    spark: SparkSession
    path: str
    schema: StructType | None = None
    key: tuple[str, ...] = ()
    buckets: int = 0
    #: The file that makes a version count. Spark writes `_SUCCESS`; `_PUBLISHED` waits for `publish`.
    marker: str = "_SUCCESS"

    def latest(self) -> int | None:
        """The newest version that counts."""
        numbers = sorted(map(int, subfolders(self.path, "version")), reverse=True)
        return next((n for n in numbers if self._finished(n)), None)

    def publish(self, version: int) -> None:
        """Let readers have a version, once it is known to be sound. Repeating it does no harm."""
        store, marker = open_store(f"{self._folder(version)}/{self.marker}")
        with store.open_output_stream(marker):
            pass

    def _folder(self, version: int) -> str:
        return f"{self.path.rstrip('/')}/version={version}"

    def read(self, version: int | None = None) -> DataFrame:
        """A version, by default the newest; an empty frame before the first one."""
        version = version or self.latest()
        if version is None:
            if self.schema is None:
                raise FileNotFoundError(f"no finished version below {self.path}")
            return self.spark.createDataFrame([], self.schema)
        if self.buckets:
            return self._bucketed(version)
        reader = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
        return reader.parquet(self._folder(version))

    def _name(self, version: int) -> str:
        return f"bucketed_{sha256(self._folder(version).encode()).hexdigest()[:24]}"

    def _bucketed(self, version: int) -> DataFrame:
        """The version as a table of the session's catalog, which is where Spark keeps bucketing."""
        name, columns = self._name(version), ", ".join(self.key)
        if not self.spark.catalog.tableExists(name):
            fields = self.spark.read.parquet(self._folder(version)).schema.fields
            listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({listed}) USING parquet CLUSTERED BY ({columns}) "
                f"SORTED BY ({columns}) INTO {self.buckets} BUCKETS LOCATION '{self._folder(version)}'"
            )
        return self.spark.table(name)

    def write(self, frame: DataFrame, version: int | None = None) -> int:
        """Write the next version, or redo a given one that no reader uses yet.

        The first bucketed version is shuffled by key; later ones come from a merge with a
        bucketed version and lie in their buckets already.
        """
        first = self.latest() is None
        # Beyond every folder there is, also those of writes that failed: no reader sees it change.
        version = version or max(map(int, subfolders(self.path, "version")), default=0) + 1
        if self.buckets:
            placed = frame.repartition(self.buckets, *self.key) if first else frame
            placed.write.mode("overwrite").option("path", self._folder(version)).bucketBy(
                self.buckets, *self.key
            ).sortBy(*self.key).saveAsTable(self._name(version))
        else:
            frame.write.mode("overwrite").parquet(self._folder(version))
        return version

    def merge(self, known: int | None, changes: DataFrame, empty: DataFrame, step: Callable[[DataFrame, DataFrame], DataFrame]) -> Merge:
        """Apply `step(rows before, changes)`, an upsert with actions, and write a version, not published yet.

        What the merge did is counted by the tasks that write; rows are counted from footers.
        """
        before = empty if known is None else self.read(known)
        seen = Observation()
        counted = [F.count(F.lit(1)).alias("rows"), F.count_if(F.col(ACTION) == "insert").alias("inserted"), F.count_if(F.col(ACTION) == "update").alias("updated")]
        version = self.write(step(before, changes).observe(seen, *counted).drop(ACTION))
        rows, earlier = self.read(version).count(), 0 if known is None else before.count()
        found = observed(seen)
        if found.get("rows") != rows:  # repeated tasks were counted twice
            found = {"inserted": rows - earlier, "updated": None}
        return Merge(version, rows, earlier, found["inserted"], found["updated"])

    def retain(self, versions: int) -> list[str]:
        """Delete all but the newest `versions` finished versions and anything newer; returns the folders deleted.

        Nothing calls this by itself: only the caller knows that no reader is left on an old version.
        """
        if versions < 1:
            raise ValueError("keep one version at least")
        finished = [n for n in sorted(map(int, subfolders(self.path, "version"))) if self._finished(n)]
        if len(finished) <= versions:
            return []
        oldest, gone = finished[-versions], []
        for number in sorted(map(int, subfolders(self.path, "version"))):
            if number < oldest:
                if self.buckets:
                    self.spark.sql(f"DROP TABLE IF EXISTS {self._name(number)}")
                store, folder = open_store(self._folder(number))
                store.delete_dir(folder)
                gone.append(self._folder(number))
        return gone

    def _finished(self, version: int) -> bool:
        store, marker = open_store(f"{self._folder(version)}/{self.marker}")
        return store.get_file_info(marker).type == pafs.FileType.File
