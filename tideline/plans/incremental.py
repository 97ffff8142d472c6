"""An incremental load from landed files to merged tables.

Control tables hold one row per table and stay frames. The driver sees the plan of the
run (one row per planned table) to open paths, and one count per table and layer.
Payload tables differ in their columns, so each has its own Spark jobs; a small pool of
threads submits them side by side. Each layer runs for all planned tables, then its
audit decides which tables go on.

Layout below the center's root: `raw/{table}/load={n}/attempt={n}/schema_id={id}`,
`stg/{table}/load={n}/attempt={n}`, `mrg/{table}/version={n}`, `control/{name}/version={n}`, `log/{name}`.
A new initial load of a layer starts a new `load` folder and every attempt a folder of its own, so
nothing is deleted or written twice.

A run may be repeated under the same or another batch id, whatever stopped the one before: a layer
takes in exactly the attempts that the progress table names, and an attempt is named there once its
audit has passed, before its status becomes `completed`. What a stopped run left behind is named
nowhere. A merged version is published to readers after its audit.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideline.context import RunContext, ensure_checkpoint_dir
from tideline.operators.upsert import src, truncate, upsert
from tideline.plans import layers, load_plan
from tideline.plans.load_plan import LAYERS
from tideline.plans.reports import failure_report, run_state
from tideline.sources.landing import landing
from tideline.sources.manifest import read_manifest
from tideline.sources.objects import read_changes
from tideline.sources.footers import write_observed
from tideline.sources.partitions import PartitionedTable
from tideline.sources.versions import VersionedTable, subfolders

MANIFEST = (
    "table_name string, cda_schema_id string, cda_folder string, cda_folder_tms timestamp_ntz,"
    " total_records_count bigint, row_insert_tms timestamp_ntz, row_update_tms timestamp_ntz"
)
STATUS = (
    "layer string, table_name string, batch_id bigint, status string,"
    " row_insert_tms timestamp_ntz, row_update_tms timestamp_ntz"
)
# How far each table is: the sound attempts of a layer that the next one has not taken in, the
# size and newest folder of the raw layer, and the merged version that counts.
PROGRESS = (
    "table_name string, raw_load bigint, raw_ready array<bigint>, raw_rows bigint, raw_folder bigint,"
    " stg_load bigint, stg_ready array<bigint>, mrg_version bigint"
)
COUNTS = "table_name string, layer string, row_count bigint, cda_folder string"


@dataclass(frozen=True)
class Center:
    """One core center: where its files arrive, where its layers live, what is switched on."""

    spark: SparkSession
    source_root: str
    root: str
    schema_names: dict[str, str]
    core_center: str = "pc"
    s3_on: bool = True
    mrg_on: bool = True
    key: tuple[str, ...] = ("id",)
    order: tuple[str, ...] = ("seqval",)
    operation: str = "operation"
    parallel_tables: int = 8
    hexadecimal: tuple[str, ...] = ()
    buckets: int = 0
    #: Hash partitions of the merged tables, of which a merge touches only those its changes fall into; 0 for whole versions.
    parts: int = 0
    step_names: dict[str, str] | None = None

    def control(self, name: str, schema: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/control/{name}", StructType.fromDDL(schema))

    def merged(self, table_name: str) -> VersionedTable | PartitionedTable:
        path = f"{self.root}/mrg/{table_name}"
        if self.parts:
            return PartitionedTable(self.spark, path, self.key, self.parts)
        return VersionedTable(self.spark, path, key=self.key, buckets=self.buckets, marker="_PUBLISHED")

    def append_log(self, name: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.root}/log/{name}")


@dataclass
class TableRun:
    """A planned table during a run."""

    plan: Row
    progress: dict
    folders: dict[str, list[str]] = field(default_factory=dict)
    counts: list[tuple] = field(default_factory=list)
    failed: dict[str, str] = field(default_factory=dict)
    done: set[str] = field(default_factory=set)

    @property
    def name(self) -> str:
        return self.plan["table_name"]

    def runs(self, layer: str) -> bool:
        return bool(self.plan[f"load_{layer}"]) and not self.failed

    def is_initial(self, layer: str) -> bool:
        return self.plan[f"{layer}_status"] == "initial"

    def count(self, layer: str, rows: int, folder: str | None = None) -> None:
        self.counts.append((self.name, layer, rows, folder))


def next_number(path: str, name: str) -> int:
    """A number for a new folder `name=n` that none below the path has."""
    return max(map(int, subfolders(path, name)), default=0) + 1


def load_raw(center: Center, table: TableRun, ctx: RunContext) -> None:
    """The new folders of every schema id as they are; each schema id keeps its own columns."""
    progress, root = table.progress, f"{center.root}/raw/{table.name}"
    if table.is_initial("raw") or progress["raw_load"] is None:
        progress.update(raw_load=next_number(root, "load"), raw_rows=0, raw_folder=None, raw_ready=[])
    load = f"{root}/load={progress['raw_load']}"
    attempt = next_number(load, "attempt")
    low, high = progress["raw_folder"], table.plan["src_cda_folder"]
    for schema_id, names in table.folders.items():
        changes = read_changes(center.spark, center.source_root, table.name, schema_id, low, high, names)
        path = f"{load}/attempt={attempt}/schema_id={schema_id}"
        raw = layers.raw_load(changes, ctx)
        found = write_observed(
            raw, lambda rows: rows.write.parquet(path), lambda: center.spark.read.schema(raw.schema).parquet(path), [F.max("cda_folder").alias("newest")]
        )
        progress["raw_rows"] += found["rows"]
        progress["raw_folder"] = max(progress["raw_folder"] or 0, found["newest"] or 0)
    if table.folders:
        progress["raw_ready"] = [*(progress["raw_ready"] or []), attempt]
    table.count("raw", progress["raw_rows"], str(progress["raw_folder"]))


def load_stage(center: Center, table: TableRun, ctx: RunContext) -> None:
    """Raw rows of all sound attempts not staged yet, with the columns of every schema version."""
    progress, spark, root = table.progress, center.spark, f"{center.root}/stg/{table.name}"
    if progress["raw_load"] is None:
        raise ValueError("the raw layer holds nothing to stage")
    if table.is_initial("stg") or progress["stg_load"] is None:
        progress.update(stg_load=next_number(root, "load"), stg_ready=[])
    versions: dict[str, list[str]] = {}
    for attempt in progress["raw_ready"] or []:
        raw = f"{center.root}/raw/{table.name}/load={progress['raw_load']}/attempt={attempt}"
        for schema_id, path in subfolders(raw, "schema_id").items():
            versions.setdefault(schema_id, []).append(path)
    if versions:
        frames = {i: layers.union_of([spark.read.parquet(p) for p in paths]) for i, paths in versions.items()}
        named = frames.get(table.plan["src_cda_schema_id"])
        newest = named if named is not None else layers.union_of(list(frames.values()))
        restamped = [frame.withColumn("batchid", ctx.batch) for frame in frames.values()]
        load = f"{root}/load={progress['stg_load']}"
        attempt = next_number(load, "attempt")
        layers.stage_load(restamped, ctx.batch_id, newest.schema).write.parquet(f"{load}/attempt={attempt}")
        table.count("raw", sum(frame.count() for frame in frames.values()))
        table.count("stg", spark.read.parquet(f"{load}/attempt={attempt}").count())
        progress["stg_ready"] = [*(progress["stg_ready"] or []), attempt]
    progress["raw_ready"] = []


def load_merge(center: Center, table: TableRun, ctx: RunContext) -> None:
    """Staged rows of all sound attempts not merged yet, into a new version that is not published yet."""
    progress, spark, key = table.progress, center.spark, list(center.key)
    if progress["stg_load"] is None:
        raise ValueError("the stage layer holds nothing to merge")
    if table.is_initial("mrg"):
        progress.update(mrg_version=None)
    load = f"{center.root}/stg/{table.name}/load={progress['stg_load']}"
    if progress["stg_ready"]:
        staged = layers.union_of([spark.read.parquet(f"{load}/attempt={n}") for n in progress["stg_ready"]])
        target = center.merged(table.name)
        options = {"key": key, "order": list(center.order), "operation": center.operation, "hexadecimal": center.hexadecimal}

        def step(before: DataFrame, changes: DataFrame) -> DataFrame:
            return layers.merge_load(before, changes, ctx, with_action=True, **options)

        done = target.merge(progress["mrg_version"], staged, layers.empty_merged(staged), step)
        progress["mrg_version"] = done.version
        table.count("mrg", done.rows)
        table.count("expected", done.rows_before + done.inserted)
    progress["stg_ready"] = []


LOADERS = {"raw": load_raw, "stg": load_stage, "mrg": load_merge}


def audit(center: Center, tables: list[TableRun], layer: str, ctx: RunContext) -> list[Row]:
    """Failed checks of one layer over the tables that just ran it."""
    spark = center.spark
    counted = [t for t in tables if t.counts]
    if not counted:
        return []
    manifest = spark.createDataFrame(
        [(t.name, t.plan["src_total_records_count"], str(t.plan["src_cda_folder"])) for t in counted],
        "table_name string, total_records_count bigint, cda_folder string",
    )
    counts = spark.createDataFrame([c for t in counted for c in t.counts], COUNTS)
    failures = layers.audit_failures(layers.audit_counts(manifest, counts, ctx), center.schema_names)
    return failures.where(F.col("layer") == layer).collect()


def run_layer(center: Center, tables: list[TableRun], layer: str, ctx: RunContext) -> None:
    """Load one layer of every table that has it to do, then audit it.

    A failure stops that table only. Its progress stays where it was, so the next run loads the same
    rows again, in an attempt of its own.
    """
    running = [t for t in tables if t.runs(layer)]
    before = {t.name: dict(t.progress) for t in running}

    def attempt(table: TableRun) -> None:
        table.counts = []
        try:
            LOADERS[layer](center, table, ctx)
        except Exception as error:  # every table reports; the run fails at the end
            table.failed[layer] = f"{type(error).__name__}: {error}"

    with ThreadPoolExecutor(center.parallel_tables) as pool:
        list(pool.map(attempt, running))
    loaded = {t.name: t for t in running if not t.failed}
    for failure in audit(center, list(loaded.values()), layer, ctx):
        loaded[failure["table_name"]].failed[layer] = failure["error_message"]
    for table in running:
        if table.failed:
            table.progress = before[table.name]
        else:
            table.done.add(layer)


def write_progress(center: Center, tables: list[TableRun], layer: str) -> None:
    """Commit how far the tables that finished a layer are, then publish their merged versions.

    A run that stops between the two publishes with the next one, which finds nothing to merge.
    """
    done = [t for t in tables if layer in t.done]
    if not done:
        return
    names = StructType.fromDDL(PROGRESS).names
    progress = center.control("progress", PROGRESS)
    reached = center.spark.createDataFrame([tuple(t.progress[n] for n in names) for t in done], PROGRESS)
    progress.write(
        upsert(progress.read(), reached, ["table_name"], update={n: src(n) for n in names[1:]}, unique_source=True)
    )
    if layer == "mrg":
        for table in done:
            if table.progress["mrg_version"] is not None:
                center.merged(table.name).publish(table.progress["mrg_version"])


def _write_status(center: Center, rows: list[tuple], ctx: RunContext) -> None:
    if rows:
        status = center.control("load_status", STATUS)
        outcomes = center.spark.createDataFrame(rows, "layer string, table_name string, outcome string")
        status.write(layers.apply_outcomes(status.read(), outcomes, ctx))


def raw_windows(center: Center, plan: DataFrame, progress: DataFrame) -> dict[str, dict[str, list[str]]]:
    """Folders to load per planned table and schema id: above what the raw layer holds, up to the manifest.

    The window starts at the raw layer's newest folder rather than at the loaded manifest, which
    has advanced already when a failed raw load is repeated. One row a planned table and the names of the window's
    folders come to the driver, which opens them by name: new folders, not those of all history, which do not leave the tasks.
    """
    held = progress.select("table_name", "raw_folder")
    bounds = (
        plan.where("load_raw")
        .join(held, "table_name", "left")
        .select(
            "table_name",
            F.when(F.col("raw_status") != "initial", F.col("raw_folder")).alias("low"),
            F.col("src_cda_folder").cast("bigint").alias("high"),
        )
        .where("high IS NOT NULL")
        .collect()
    )
    result: dict[str, dict[str, list[str]]] = {}
    if not bounds:
        return result
    low, high = {r["table_name"]: r["low"] or 0 for r in bounds}, {r["table_name"]: r["high"] for r in bounds}
    window = landing(center.spark, center.source_root, low, high, level="folders")
    for name, schema_id, folder in sorted(map(tuple, window.collect())):
        result.setdefault(name, {}).setdefault(schema_id, []).append(folder)
    return result


def register(center: Center, plan: DataFrame, new_manifest: DataFrame, ctx: RunContext) -> None:
    """Note the arrival of files: statuses become pending or initial, the loaded manifest advances."""
    manifest, status = center.control("manifest", MANIFEST), center.control("load_status", STATUS)
    entries = load_plan.arrived_entries(new_manifest, plan)
    statuses = load_plan.upsert_load_status(
        status.read(), load_plan.touched_layers(plan), ctx, with_action=True
    ).checkpoint()
    manifests = load_plan.upsert_manifest(manifest.read(), entries, ctx, with_action=True).checkpoint()
    status.write(statuses.drop("_action"))
    manifest.write(manifests.drop("_action"))
    center.append_log("process", load_plan.arrival_log(statuses, manifests, center.schema_names, ctx))


def run_incremental_load(center: Center, ctx: RunContext, *, is_initial: bool = False) -> dict:
    """Plan, register, load and audit. Returns the run state, the failures by table and their report.

    The loaded manifest advances when files are registered, before the layers run; a
    restart relies on the load status and on each table's progress. With storage loads
    off, only files registered by earlier runs are loaded.
    """
    spark = center.spark
    ensure_checkpoint_dir(spark)
    manifest, status = center.control("manifest", MANIFEST), center.control("load_status", STATUS)
    progress = center.control("progress", PROGRESS)
    if is_initial:
        for table in (manifest, status, progress):
            table.write(truncate(table.read()))

    new_manifest = read_manifest(spark, f"{center.source_root}/manifest.json") if center.s3_on else manifest.read()
    plan = load_plan.load_plan(
        new_manifest, manifest.read(), status.read(), s3_on=center.s3_on, mrg_on=center.mrg_on
    ).checkpoint()
    rows = plan.collect()
    if rows and center.s3_on:
        register(center, plan, new_manifest, ctx)
    if not rows or not center.mrg_on:
        return {"state": run_state(len(rows), center.s3_on, center.mrg_on, 0), "failures": {}, "report": None}

    names = StructType.fromDDL(PROGRESS).names
    known = {r["table_name"]: r.asDict() for r in progress.read().join(plan, "table_name", "left_semi").collect()}
    folders = raw_windows(center, plan, progress.read())
    tables = [
        TableRun(
            row,
            known.get(row["table_name"], dict.fromkeys(names) | {"table_name": row["table_name"]}),
            folders.get(row["table_name"], {}),
        )
        for row in rows
    ]
    def started(layer: str) -> list[tuple]:
        return [(layer, t.name, "started") for t in tables if t.runs(layer)]

    _write_status(center, started(LAYERS[0]), ctx)
    for layer, following in zip(LAYERS, [*LAYERS[1:], None]):
        run_layer(center, tables, layer, ctx)
        write_progress(center, tables, layer)
        outcomes = [(layer, t.name, "failed") for t in tables if layer in t.failed]
        outcomes += [(layer, t.name, "completed") for t in tables if layer in t.done]
        # One write for the end of a layer and the start of the next.
        _write_status(center, outcomes + (started(following) if following else []), ctx)

    failures = [(layer, t.name, text) for t in tables for layer, text in t.failed.items()]
    report = None
    if failures:
        frame = spark.createDataFrame(failures, "layer string, table_name string, error_message string")
        logged = layers.error_log(frame, ctx, center.schema_names, center.step_names).withColumn("core_center", F.lit(center.core_center))
        center.append_log("error", logged.drop("core_center"))
        report = failure_report(logged.withColumnRenamed("job_name", "procedure_name")).first()["notice"]
    return {
        "state": run_state(len(rows), center.s3_on, center.mrg_on, len(failures)),
        "failures": {name: (layer, text) for layer, name, text in failures},
        "report": report,
    }
