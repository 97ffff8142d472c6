"""End-to-end loads over real files: gating, restart, partial failure, schema versions."""

import json
from dataclasses import replace
from datetime import datetime
from pathlib import Path

import pytest

from tideline.context import RunContext
from tideline.plans import incremental
from tideline.plans.incremental import Center, TableRun, run_incremental_load, run_layer
from tideline.sources import objects

NAMES = {"raw": "RAW_PC", "stg": "STG_PC", "mrg": "MRG_PC"}


def ctx(batch):
    return RunContext(batch, datetime(2024, 2, batch % 28 + 1))


class Source:
    """A drop folder: writes change files and the manifest."""

    def __init__(self, spark, root):
        self.spark, self.root, self.entries = spark, root, {}

    def drop(self, table, schema_id, folder, rows, columns, total=None):
        path = Path(self.root, table, schema_id, str(folder))
        self.spark.createDataFrame(rows, columns).coalesce(1).write.parquet(str(path))
        for other in [f for f in path.iterdir() if not f.name.endswith(".snappy.parquet")]:
            other.unlink()
        entry = self.entries.setdefault(table, {"total_records_count": 0})
        entry.update(
            cda_schema_id=schema_id,
            cda_folder=str(folder),
            cda_folder_tms=f"2024-01-{folder % 100:02d}T00:00:00",
            total_records_count=total if total is not None else entry["total_records_count"] + len(rows),
        )

    def publish(self):
        entries = {name.upper(): entry for name, entry in self.entries.items()}
        Path(self.root, "manifest.json").write_text(json.dumps(entries))


V1 = "id bigint, seqval bigint, operation string, beanversion int"
V2 = V1 + ", extra string"


@pytest.fixture
def source(spark, tmp_path):
    return Source(spark, str(tmp_path / "drop"))


@pytest.fixture
def center(spark, source, tmp_path):
    return Center(spark, source.root, str(tmp_path / "wh"), NAMES)


def merged(center, table):
    rows = center.merged(table).read().select("id", "seqval", "beanversion", "gw_delete_flag").collect()
    return sorted(tuple(r) for r in rows)


def statuses(center):
    return {(r["layer"], r["table_name"]): r["status"] for r in center.control("load_status", incremental.STATUS).read().collect()}


@pytest.mark.parametrize("buckets", [0, 4])
def test_two_batches_with_a_new_schema_version(source, center, buckets):
    center = replace(center, buckets=buckets)
    source.drop("pc_a", "s1", 20240101, [(1, 1, "I", 0), (2, 2, "I", 0)], V1)
    source.drop("pc_b", "s1", 20240101, [(7, 1, "I", 0)], V1)
    source.publish()
    assert run_incremental_load(center, ctx(1))["state"] == "success"
    assert merged(center, "pc_a") == [(1, 1, 0, "N"), (2, 2, 0, "N")]

    assert run_incremental_load(center, ctx(2)) == {"state": "no_work", "failures": {}, "report": None}

    source.drop("pc_a", "s1", 20240102, [(1, 3, "U", 1)], V1)
    source.drop("pc_a", "s2", 20240103, [(2, 4, "D", 1, "x"), (3, 5, "I", 0, "y")], V2)
    source.publish()
    assert run_incremental_load(center, ctx(3))["state"] == "success"
    assert merged(center, "pc_a") == [(1, 3, 1, "N"), (2, 4, 1, "Y"), (3, 5, 0, "N")]
    extra = {r["id"]: r["extra"] for r in center.merged("pc_a").read().collect()}
    assert extra == {1: None, 2: "x", 3: "y"}
    assert merged(center, "pc_b") == [(7, 1, 0, "N")]
    assert set(statuses(center).values()) == {"completed"}


def test_late_folder_below_the_mark_is_not_loaded(source, center):
    source.drop("pc_a", "s1", 20240105, [(1, 5, "I", 0)], V1)
    source.publish()
    run_incremental_load(center, ctx(1))
    source.drop("pc_a", "s1", 20240103, [(9, 3, "I", 0)], V1)
    source.drop("pc_a", "s1", 20240106, [(2, 6, "I", 0)], V1, total=2)
    source.publish()
    assert run_incremental_load(center, ctx(2))["state"] == "success"
    assert [r[0] for r in merged(center, "pc_a")] == [1, 2]


def test_a_failed_audit_stops_only_its_table_and_is_repaired(source, center):
    source.drop("pc_a", "s1", 20240101, [(1, 1, "I", 0)], V1, total=5)
    source.drop("pc_b", "s1", 20240101, [(7, 1, "I", 0)], V1)
    source.publish()
    result = run_incremental_load(center, ctx(1))
    assert result["state"] == "failure"
    layer, text = result["failures"]["pc_a"]
    assert layer == "raw" and "TOTAL_RECORDS_COUNT: table 1, manifest: 5" in text
    assert result["report"].startswith("Table Name: pc_a\nProcedure Name: load_raw\nException: ")
    status = statuses(center)
    assert status[("raw", "pc_a")] == "failed" and status[("stg", "pc_a")] == "initial"
    assert status[("mrg", "pc_b")] == "completed"
    logged = center.spark.read.parquet(f"{center.root}/log/error").collect()
    assert [(r["table_name"], r["schema_name"], r["error_sql"]) for r in logged] == [("pc_a", "RAW_PC", "N/A")]

    source.entries["pc_a"]["total_records_count"] = 2
    source.drop("pc_a", "s1", 20240102, [(2, 2, "I", 0)], V1, total=2)
    source.publish()
    assert run_incremental_load(center, ctx(2))["state"] == "success"
    assert merged(center, "pc_a") == [(1, 1, 0, "N"), (2, 2, 0, "N")]


def test_restart_after_a_stage_failure_takes_in_both_batches(source, center, monkeypatch):
    source.drop("pc_a", "s1", 20240101, [(1, 1, "I", 0)], V1)
    source.publish()
    broken = {**incremental.LOADERS, "stg": lambda *_: 1 / 0}
    monkeypatch.setattr(incremental, "LOADERS", broken)
    assert run_incremental_load(center, ctx(1))["failures"]["pc_a"][0] == "stg"
    monkeypatch.undo()
    source.drop("pc_a", "s1", 20240102, [(2, 2, "I", 0)], V1)
    source.publish()
    assert run_incremental_load(center, ctx(2))["state"] == "success"
    assert merged(center, "pc_a") == [(1, 1, 0, "N"), (2, 2, 0, "N")]


def test_folders_are_read_in_groups(source, center, monkeypatch):
    monkeypatch.setattr(objects, "FOLDERS_PER_SCAN", 1)
    source.drop("pc_a", "s1", 20240100, [(1, 0, "I", 0)], V1)
    source.drop("pc_a", "s1", 20240101, [(1, 1, "I", 0)], V1)
    source.drop("pc_a", "s2", 20240102, [(2, 2, "I", 0, "x")], V2)
    source.publish()
    assert run_incremental_load(center, ctx(1))["state"] == "success"
    assert merged(center, "pc_a") == [(1, 1, 0, "N"), (2, 2, 0, "N")]


class Crash(BaseException):
    """Ends a run like a lost driver: no handler of the run sees it."""


def two_batches(source, center):
    """Batch 1 loaded, the files of batch 2 landed."""
    source.drop("pc_a", "s1", 20240101, [(1, 1, "I", 0), (2, 1, "I", 0)], V1)
    source.publish()
    assert run_incremental_load(center, ctx(1))["state"] == "success"
    source.drop("pc_a", "s1", 20240102, [(1, 2, "U", 1)], V1)
    source.drop("pc_a", "s2", 20240103, [(3, 3, "I", 0, "x")], V2)
    source.publish()


WHOLE = [(1, 2, 1, "N"), (2, 1, 0, "N"), (3, 3, 0, "N")]


@pytest.mark.parametrize("layer, again", [("raw", 2), ("stg", 3), ("mrg", 2)])
def test_a_failed_batch_is_repeated(source, center, monkeypatch, layer, again):
    two_batches(source, center)
    load = incremental.LOADERS[layer]

    def half(*args):
        load(*args)
        raise RuntimeError("after its writes")

    monkeypatch.setattr(incremental, "LOADERS", {**incremental.LOADERS, layer: half})
    assert run_incremental_load(center, ctx(2))["failures"]["pc_a"][0] == layer
    assert merged(center, "pc_a") == [(1, 1, 0, "N"), (2, 1, 0, "N")]
    monkeypatch.undo()
    assert run_incremental_load(center, ctx(again))["state"] == "success"
    assert merged(center, "pc_a") == WHOLE
    assert set(statuses(center).values()) == {"completed"}
    assert run_incremental_load(center, ctx(9))["state"] == "no_work"


@pytest.mark.parametrize("place", ["register", "raw", "write_progress", "publish"])
def test_a_crashed_run_is_repeated(source, center, monkeypatch, place):
    two_batches(source, center)

    def crash_after(function):
        def run(*args, **kwargs):
            function(*args, **kwargs)
            raise Crash

        return run

    if place in incremental.LOADERS:
        real = incremental.run_layer
        monkeypatch.setattr(incremental, "run_layer", lambda c, t, layer, x: crash_after(real)(c, t, layer, x) if layer == place else real(c, t, layer, x))
    elif place == "publish":
        monkeypatch.setattr(incremental.VersionedTable, "publish", lambda self, version: (_ for _ in ()).throw(Crash()))
    else:
        monkeypatch.setattr(incremental, place, crash_after(getattr(incremental, place)))
    with pytest.raises(Crash):
        run_incremental_load(center, ctx(2))
    assert merged(center, "pc_a") == [(1, 1, 0, "N"), (2, 1, 0, "N")]
    monkeypatch.undo()
    assert run_incremental_load(center, ctx(2))["state"] == "success"
    assert merged(center, "pc_a") == WHOLE
    assert set(statuses(center).values()) == {"completed"}


def test_readers_do_not_get_a_version_whose_audit_failed(source, center, monkeypatch):
    two_batches(source, center)
    real = incremental.audit
    bad = [{"table_name": "pc_a", "error_message": "counts differ"}]
    monkeypatch.setattr(incremental, "audit", lambda c, t, layer, x: bad if layer == "mrg" else real(c, t, layer, x))
    assert run_incremental_load(center, ctx(2))["state"] == "failure"
    assert merged(center, "pc_a") == [(1, 1, 0, "N"), (2, 1, 0, "N")]
    monkeypatch.undo()
    assert run_incremental_load(center, ctx(2))["state"] == "success"
    assert merged(center, "pc_a") == WHOLE


def test_a_type_that_widens_between_schema_ids(source, center):
    source.drop("pc_a", "s1", 20240101, [(1, 1, "I", 0)], V1)
    source.publish()
    assert run_incremental_load(center, ctx(1))["state"] == "success"
    source.drop("pc_a", "s2", 20240102, [(1, 2, "U", 2**40), (2, 2, "I", 0)], V1.replace("beanversion int", "beanversion bigint"))
    source.publish()
    assert run_incremental_load(center, ctx(2))["state"] == "success"
    assert merged(center, "pc_a") == [(1, 2, 2**40, "N"), (2, 2, 0, "N")]


def test_a_null_key_fails_its_table_each_time(source, center):
    source.drop("pc_a", "s1", 20240101, [(1, 1, "I", 0), (None, 1, "I", 0)], V1)
    source.publish()
    for batch in (1, 1):
        layer, text = run_incremental_load(center, ctx(batch))["failures"]["pc_a"]
        assert layer == "mrg" and "null key" in text
    assert center.merged("pc_a").latest() is None


def test_initial_mode_starts_anew(source, center):
    source.drop("pc_a", "s1", 20240101, [(1, 1, "I", 0)], V1)
    source.publish()
    run_incremental_load(center, ctx(1))
    assert run_incremental_load(center, ctx(2), is_initial=True)["state"] == "success"
    assert merged(center, "pc_a") == [(1, 1, 0, "N")]
    assert center.merged("pc_a").read().select("batchid").first()[0] == 2


def test_switched_off_parts(spark, source, center, tmp_path):
    source.drop("pc_a", "s1", 20240101, [(1, 1, "I", 0)], V1)
    source.publish()
    register_only = Center(spark, source.root, center.root, NAMES, mrg_on=False)
    assert run_incremental_load(register_only, ctx(1))["state"] == "success"
    assert center.merged("pc_a").latest() is None
    merge_only = Center(spark, source.root, center.root, NAMES, s3_on=False)
    assert run_incremental_load(merge_only, ctx(2))["state"] == "success"
    assert merged(center, "pc_a") == [(1, 1, 0, "N")]
    off = Center(spark, source.root, center.root, NAMES, s3_on=False, mrg_on=False)
    assert run_incremental_load(off, ctx(3))["state"] == "disabled"


@pytest.mark.parametrize("flags", [(r, s, m) for r in (True, False) for s in (True, False) for m in (True, False)])
def test_a_layer_runs_exactly_when_its_flag_is_on(center, monkeypatch, flags):
    calls = []
    fakes = {layer: (lambda c, t, x, name=layer: calls.append(name)) for layer in incremental.LAYERS}
    monkeypatch.setattr(incremental, "LOADERS", fakes)
    plan = dict(zip(("load_raw", "load_stg", "load_mrg"), flags), table_name="pc_a", raw_status="x")
    table = TableRun(plan, {})
    for layer in incremental.LAYERS:
        run_layer(center, [table], layer, ctx(1))
    assert calls == [name for name, flag in zip(incremental.LAYERS, flags) if flag]


def test_one_failure_among_many_tables_does_not_stop_the_run(center, monkeypatch):
    def load(c, table, x):
        if table.name == "pc_3":
            raise RuntimeError("bad!")

    monkeypatch.setattr(incremental, "LOADERS", {"raw": load})
    tables = [TableRun({"table_name": f"pc_{i}", "load_raw": True, "raw_status": "x"}, {}) for i in range(6)]
    run_layer(center, tables, "raw", ctx(1))
    assert [t.name for t in tables if t.failed] == ["pc_3"]
    assert all("raw" in t.done for t in tables if t.name != "pc_3")
