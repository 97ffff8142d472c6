from datetime import datetime
from pathlib import Path

import pytest

from tideline.context import RunContext
from tideline.plans.layers import empty_merged, merge_load
from tideline.sources.versions import VersionedTable
from tideline.streaming.changes import change_stream, merge_stream, next_version, read_json, record_path
from validation.inputs import Inputs

CTX = RunContext(1, datetime(2024, 2, 1))
COLUMNS = ["id", "seqval", "payload_ts", "operation", "payload"]


def test_stream_gives_the_merge_of_one_batch(spark, tmp_path):
    changes = Inputs(spark, "/root/testdata/sf0.001")["fx_cdc"].select(*COLUMNS)
    drop, target = str(tmp_path / "drop"), VersionedTable(spark, str(tmp_path / "merged"))
    parts = changes.repartition(6, "seqval").persist()
    schema = parts.schema

    def run():
        query = merge_stream(change_stream(spark, drop, schema, 2), target, str(tmp_path / "state"), CTX)
        query.awaitTermination()

    parts.where("seqval % 2 = 0").write.parquet(f"{drop}/pc_a/s1/20240101")
    run()
    first = target.latest()
    assert first > 1
    parts.where("seqval % 2 = 1").write.parquet(f"{drop}/pc_a/s1/20240102")
    run()
    assert target.latest() > first

    whole = merge_load(empty_merged(changes), changes, CTX)
    ours, theirs = target.read().select(whole.columns).collect(), whole.collect()
    assert sorted(map(tuple, ours)) == sorted(map(tuple, theirs))
    assert len(list(Path(drop).rglob("*.snappy.parquet"))) > 6


def test_repeated_micro_batch_writes_the_same_version(spark, tmp_path):
    target = VersionedTable(spark, str(tmp_path / "merged"))
    rows = spark.createDataFrame([(1, 1, "I")], "id bigint, seqval bigint, operation string")
    for _ in range(2):
        assert target.write(merge_load(empty_merged(rows), rows, CTX), 1) == 1
    assert target.latest() == 1 and target.read().count() == 1


SMALL = "id bigint, seqval bigint, operation string"


def drop(spark, root, folder, rows):
    spark.createDataFrame(rows, SMALL).coalesce(1).write.parquet(f"{root}/pc_a/s1/{folder}")


def run(spark, root, target, state, **options):
    schema = spark.createDataFrame([], SMALL).schema
    merge_stream(change_stream(spark, root, schema), target, state, CTX, **options).awaitTermination()


def test_a_lost_checkpoint_is_refused_and_loses_no_rows(spark, tmp_path):
    root, target = str(tmp_path / "drop"), VersionedTable(spark, str(tmp_path / "merged"))
    for n in range(2):
        drop(spark, root, n, [(n, n, "I")])
        run(spark, root, target, str(tmp_path / "state"))
    assert target.latest() == 2
    drop(spark, root, 2, [(2, 2, "I")])
    with pytest.raises(ValueError, match="onto=2"):
        run(spark, root, target, str(tmp_path / "new_state"))
    assert target.latest() == 2
    run(spark, root, target, str(tmp_path / "new_state"), onto=2)
    assert sorted(r["id"] for r in target.read().collect()) == [0, 1, 2]
    # The first stream no longer owns the newest version.
    with pytest.raises(ValueError, match="not written by this stream"):
        run(spark, root, target, str(tmp_path / "state"))


def test_a_replayed_micro_batch_changes_nothing(spark, tmp_path):
    root, target, state = str(tmp_path / "drop"), VersionedTable(spark, str(tmp_path / "merged")), str(tmp_path / "state")
    drop(spark, root, 0, [(0, 0, "I")])
    run(spark, root, target, state)
    record = read_json(record_path(target, 1))
    assert record["batch"] == 0
    assert next_version(target, record["stream"], 0, None) == (1, None)
    assert next_version(target, record["stream"], 1, None) == (1, 2)
    # Stopped after the version was written and before Spark noted the micro-batch: it runs again.
    for note in Path(state, "commits").iterdir():
        note.unlink()
    run(spark, root, target, state)
    assert target.latest() == 1 and target.read().count() == 1
    # Stopped before the version was finished: it is written again.
    Path(target.path, "version=1", "_SUCCESS").unlink()
    for note in Path(state, "commits").iterdir():
        note.unlink()
    run(spark, root, target, state)
    assert target.latest() == 1 and target.read().count() == 1


def test_a_target_of_plain_loads_is_refused(spark, tmp_path):
    target = VersionedTable(spark, str(tmp_path / "merged"))
    target.write(spark.createDataFrame([(1, 1, "I")], SMALL))
    drop(spark, str(tmp_path / "drop"), 0, [(0, 0, "I")])
    with pytest.raises(ValueError, match="onto=1"):
        run(spark, str(tmp_path / "drop"), target, str(tmp_path / "state"))
    gone = VersionedTable(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError, match="finds no version"):
        next_version(gone, "s", 3, None)
