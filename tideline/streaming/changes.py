"""Change files as a stream into a merged table.

The file source remembers the files it has read, so a run picks up every new file once,
late folders included. Each micro-batch becomes one version of the merged table, and every
version has a commit record, written before it: the stream (the id Spark keeps in the checkpoint) and
the number of the micro-batch. The record of the newest finished version is read before a write. A micro-batch that it names
already is done and changes nothing; one that was stopped in the middle is written again from the version
before it. A target whose newest version another stream or a plain load wrote is refused, since a stream with a
checkpoint of its own would count its files as read without knowing what lies there.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tideline.context import RunContext
from tideline.functions.keys import DATA_SUFFIX
from tideline.plans.layers import empty_merged, merge_load
from tideline.sources.stores import open_store
from tideline.sources.versions import VersionedTable


def change_stream(spark: SparkSession, root: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """Change rows of all data files below a folder, as they arrive."""
    reader = (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*" + DATA_SUFFIX)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(root)


def read_json(path: str) -> dict | None:
    store, at = open_store(path)
    if store.get_file_info(at).type != pafs.FileType.File:
        return None
    with store.open_input_stream(at) as stream:
        return json.loads(stream.read().decode().splitlines()[-1])


def record_path(target: VersionedTable, version: int) -> str:
    return f"{target.path.rstrip('/')}/_streams/version={version}.json"


def write_record(target: VersionedTable, version: int, record: dict) -> None:
    store, at = open_store(record_path(target, version))
    store.create_dir(at.rsplit("/", 1)[0])
    with store.open_output_stream(at) as stream:
        stream.write(json.dumps(record).encode())


def stream_id(checkpoint: str) -> str | None:
    """The id Spark gave the stream of a checkpoint, None before its first start."""
    found = read_json(f"{checkpoint.rstrip('/')}/metadata")
    return found and found["id"]


def next_version(target: VersionedTable, stream: str | None, number: int | None, onto: int | None) -> tuple[int | None, int | None]:
    """(version to build on, version to write) for micro-batch `number` of a stream; nothing to write if it is done.

    Fails where the newest version is not the stream's own, nor the one it was told to go on from (`onto`).
    """
    newest = target.latest()
    if newest is None:
        if number:
            raise ValueError(f"micro-batch {number} finds no version below {target.path}")
        return None, 1
    record = read_json(record_path(target, newest))
    if record is None or record["stream"] != stream:
        if newest != onto:
            raise ValueError(f"version {newest} below {target.path} was not written by this stream; pass onto={newest} to go on from it")
        return newest, newest + 1
    done = number is not None and record["batch"] >= number
    return newest, None if done else newest + 1


def merge_stream(
    changes: DataFrame,
    target: VersionedTable,
    checkpoint: str,
    ctx: RunContext,
    *,
    key: Sequence[str] = ("id",),
    order: Sequence[str] = ("seqval",),
    operation: str = "operation",
    onto: int | None = None,
) -> StreamingQuery:
    """Start merging what has arrived and stop when it is done (`availableNow`).

    `checkpoint` is a folder on shared storage. `onto` names the newest version of a target that something else wrote, to let
    a new stream go on from it; without it such a target is refused before anything is read.
    """
    next_version(target, stream_id(checkpoint), None, onto)

    def merge(batch: DataFrame, number: int) -> None:
        stream = stream_id(checkpoint)
        newest, version = next_version(target, stream, number, onto)
        if version is None:
            return
        before = empty_merged(batch) if newest is None else target.read(newest)
        merged = merge_load(before, batch, ctx, key=key, order=order, operation=operation)
        write_record(target, version, {"stream": stream, "batch": number})
        target.write(merged, version)

    return (
        changes.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
