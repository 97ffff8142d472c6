"""The landing area as a data source, for batch reads and as a stream.

`spark.read.format("landing").load(root)` gives the data files below `{root}/{table}/{schema id}/{timestamp}/`
and the parts of their paths. Options:

* `low`, `high`: JSON objects of timestamps by table. Only folders with `low < timestamp <= high` are opened; a table
  without a low mark starts below all folders. With `high` only its tables are read and the driver lists
  nothing; without it the driver lists the root, one name a table.
* `slices`: tasks a table (1 unless given). Each opens the folders whose name falls to it.
* `level`: `files`, or `folders` for the folders of the window alone, which opens none of them.

As a stream (`spark.readStream.format("landing")`) the mark of a table is the newest folder that
`{root}/manifest.json` names, since a folder is complete once the manifest has it. A micro-batch holds every folder
above the marks of the one before, so each folder lies whole in one micro-batch, and a run opens nothing at or
below its marks. Folders that turn up below a mark are never read. A manifest that lowers a
mark or no longer names a table fails the stream.

A folder whose name is not a number is not a timestamp folder and is passed over. Files are sent on in batches of
`FILES_PER_BATCH`; a task holds the attributes of one folder's files.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from zlib import crc32

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tideline.functions.keys import DATA_SUFFIX
from tideline.sources.stores import open_store, uri_prefix

FILES_PER_BATCH = 10_000
FOLDER_SCHEMA = "table_name string, cda_schema_id string, cda_timestamp string"
FILE_SCHEMA = f"object_key string, size_bytes bigint, last_modified timestamp, {FOLDER_SCHEMA}"
PARTS = ("table_name", "cda_schema_id", "cda_timestamp")
MANIFEST = "manifest.json"


@dataclass
class TableSlice(InputPartition):
    """One task's share of a table: folders in (low, high] whose name falls to `part` of `parts`."""

    table: str
    low: int
    high: int | None
    part: int
    parts: int

    def has(self, name: str) -> bool:
        if not (name.isascii() and name.isdigit()):
            return False
        within = self.low < int(name) and (self.high is None or int(name) <= self.high)
        return within and crc32(name.encode()) % self.parts == self.part


def subfolder_names(store: pafs.FileSystem, path: str) -> list[str]:
    listed = store.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    return sorted(i.base_name for i in listed if i.type == pafs.FileType.Directory)


def data_file_infos(store: pafs.FileSystem, path: str) -> list[pafs.FileInfo]:
    """The data files directly in one timestamp folder."""
    listed = store.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    return [i for i in listed if i.type == pafs.FileType.File and i.base_name.endswith(DATA_SUFFIX)]


def folders_of(root: str, share: TableSlice) -> Iterator[tuple[str, str, str]]:
    """(table, schema id, timestamp) of the folders that fall to a task."""
    store, path = open_store(root)
    for schema_id in subfolder_names(store, f"{path}/{share.table}"):
        for name in subfolder_names(store, f"{path}/{share.table}/{schema_id}"):
            if share.has(name):
                yield share.table, schema_id, name


def folder_batches(folders: Iterator[tuple[str, str, str]]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple[str, str, str]] = []
    for row in folders:
        rows.append(row)
        if len(rows) == FILES_PER_BATCH:
            yield _columns(rows)
            rows = []
    if rows:
        yield _columns(rows)


def _columns(rows: list[tuple[str, str, str]]) -> pa.RecordBatch:
    return pa.record_batch({name: pa.array([row[i] for row in rows], pa.string()) for i, name in enumerate(PARTS)})


def file_batches(root: str, folders: Iterator[tuple[str, str, str]]) -> Iterator[pa.RecordBatch]:
    store, path = open_store(root)
    prefix = uri_prefix(root, path)
    for folder in folders:
        found = data_file_infos(store, "/".join([path, *folder]))
        for at in range(0, len(found), FILES_PER_BATCH):
            files = found[at : at + FILES_PER_BATCH]
            yield pa.record_batch(
                {
                    "object_key": pa.array([prefix + f.path for f in files], pa.string()),
                    "size_bytes": pa.array([f.size or 0 for f in files], pa.int64()),
                    "last_modified": pa.array([f.mtime for f in files], pa.timestamp("us", "UTC")),
                    **{name: pa.array([folder[i]] * len(files), pa.string()) for i, name in enumerate(PARTS)},
                }
            )


def rows_of(root: str, level: str, share: TableSlice | None) -> Iterator[pa.RecordBatch]:
    """A task's rows. Spark passes None to a single task where there are no partitions."""
    folders = iter(()) if share is None else folders_of(root, share)
    return folder_batches(folders) if level == "folders" else file_batches(root, folders)


def marks_of(text: str | None) -> dict[str, int] | None:
    if text is None:
        return None
    return {table: int(mark) for table, mark in json.loads(text).items() if mark is not None}


def manifest_marks(root: str) -> dict[str, int]:
    """The newest complete folder of each table; tables without one are left out."""
    store, path = open_store(f"{root}/{MANIFEST}")
    if store.get_file_info(path).type != pafs.FileType.File:
        return {}
    with store.open_input_stream(path) as stream:
        entries = json.loads(stream.read())
    return {table.lower(): int(e["cda_folder"]) for table, e in entries.items() if e.get("cda_folder") is not None}


class LandingReader(DataSourceReader):
    def __init__(self, root: str, level: str, low: Mapping[str, int], high: Mapping[str, int] | None, slices: int):
        self.root, self.level, self.low, self.high, self.slices = root, level, low, high, slices

    def partitions(self) -> list[TableSlice]:
        tables = subfolder_names(*open_store(self.root)) if self.high is None else list(self.high)
        high = self.high or {}
        return [
            TableSlice(table, self.low.get(table, -1), high.get(table), part, self.slices)
            for table in tables
            for part in range(self.slices)
        ]

    def read(self, partition: TableSlice) -> Iterator[pa.RecordBatch]:
        return rows_of(self.root, self.level, partition)


class LandingStreamReader(DataSourceStreamReader):
    """Offsets are the marks by table."""

    def __init__(self, root: str, level: str, slices: int):
        self.root, self.level, self.slices = root, level, slices

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return manifest_marks(self.root)

    def partitions(self, start: dict, end: dict) -> list[TableSlice]:
        lowered = sorted(table for table, mark in start.items() if end.get(table, -1) < mark)
        if lowered:
            raise ValueError(f"the manifest below {self.root} is behind what was read of: {', '.join(lowered)}")
        return [
            TableSlice(table, start.get(table, -1), mark, part, self.slices)
            for table, mark in sorted(end.items())
            if mark > start.get(table, -1)
            for part in range(self.slices)
        ]

    def read(self, partition: TableSlice) -> Iterator[pa.RecordBatch]:
        return rows_of(self.root, self.level, partition)

    def commit(self, end: dict) -> None:
        """Marks are kept by the stream's checkpoint."""


class LandingSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landing"

    def schema(self) -> str:
        return FOLDER_SCHEMA if self._level() == "folders" else FILE_SCHEMA

    def reader(self, schema) -> LandingReader:
        low, high = marks_of(self.options.get("low")), marks_of(self.options.get("high"))
        return LandingReader(self._root(), self._level(), low or {}, high, self._slices())

    def streamReader(self, schema) -> LandingStreamReader:
        if "low" in self.options or "high" in self.options:
            raise ValueError("a stream takes its marks from the manifest")
        return LandingStreamReader(self._root(), self._level(), self._slices())

    def _root(self) -> str:
        if not self.options.get("path"):
            raise ValueError("the landing source needs the path of a landing area")
        return self.options["path"].rstrip("/")

    def _level(self) -> str:
        level = self.options.get("level", "files")
        if level not in ("files", "folders"):
            raise ValueError(f"level is files or folders, not {level}")
        return level

    def _slices(self) -> int:
        slices = int(self.options.get("slices", "1"))
        if slices < 1:
            raise ValueError("slices is one at least")
        return slices


def landing(
    spark: SparkSession,
    root: str,
    low: Mapping[str, int | None] | None = None,
    high: Mapping[str, int | None] | None = None,
    *,
    level: str = "files",
    slices: int = 1,
) -> DataFrame:
    """Files or folders of a landing area above `low` and up to `high`, by table."""
    spark.dataSource.register(LandingSource)
    reader = spark.read.format("landing").option("level", level).option("slices", slices)
    for name, marks in (("low", low), ("high", high)):
        if marks is not None:
            reader = reader.option(name, json.dumps(dict(marks)))
    return reader.load(root)


def landing_stream(spark: SparkSession, root: str, *, level: str = "files", slices: int = 1) -> DataFrame:
    """Files or folders of a landing area as the manifest names them complete."""
    spark.dataSource.register(LandingSource)
    return spark.readStream.format("landing").option("level", level).option("slices", slices).load(root)
