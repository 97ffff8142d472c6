"""Run parameters and session helpers. No operator reads the clock."""

from __future__ import annotations

import tempfile
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def ntz(value: datetime) -> Column:
    """A zone-free timestamp literal (a plain literal would be zoned)."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


@dataclass(frozen=True)
class RunContext:
    """What a run stamps on the rows it writes."""

    batch_id: int
    run_ts: datetime
    job_name: str = "incremental_load"

    @property
    def batch(self) -> Column:
        return F.lit(self.batch_id).cast("bigint")

    @property
    def now(self) -> Column:
        return ntz(self.run_ts)

    @property
    def day(self) -> date:
        return self.run_ts.date()


def build_session(app_name: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with adaptive execution and UTC; `conf` adds to or overrides that."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage: the one set already, else that of `spark.checkpoint.dir`."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(named)
    return named


def name_local_checkpoint_dir(spark: SparkSession) -> None:
    """For tests, benches and trials: a temporary folder for a session on one machine that names none.

    Operators never call this; on a cluster it does nothing.
    """
    unnamed = spark.sparkContext.getCheckpointDir() is None and spark.conf.get("spark.checkpoint.dir", None) is None
    if unnamed and spark.sparkContext.master.split("[")[0] == "local":
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tideline-checkpoint-"))
