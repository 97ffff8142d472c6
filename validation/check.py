"""Compare every registered query with its oracle: `python -m validation.check [sf_dir] [name ...]`."""

from __future__ import annotations

import math
import sys
import time
from datetime import datetime
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame, SparkSession

from tideline.context import name_local_checkpoint_dir
from validation.inputs import TABLES
from validation.oracles import ORACLES
from validation.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def plan_of(frame: DataFrame) -> str:
    """The formatted physical plan."""
    modes = frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode
    return frame._jdf.queryExecution().explainString(modes.fromString("formatted"))


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "InPandas", "InArrow")
IN_PYTHON = {"outbox_writeback"}


def plan_problem(name: str, frame: DataFrame) -> str | None:
    """Plan shapes no query may have: products, Python rows, work in one partition."""
    plan = plan_of(frame)
    if "CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan:
        return "joins every row with every row"
    if name not in IN_PYTHON and any(node in plan for node in PYTHON_NODES):
        return "runs Python"
    # One partition only to finish an aggregate without keys, never for a window or a sort.
    if any("HashAggregate" not in part.split("Input")[0] for part in plan.split("SinglePartition")[1:]):
        return "works in one partition"
    return None


def difference(spark: SparkSession, connection, sf_dir: str, name: str) -> str | None:
    """None where both agree, else what differs."""
    frame = QUERIES[name](spark, sf_dir)
    problem = plan_problem(name, frame)
    if problem:
        return problem
    cursor = connection.execute(ORACLES[name])
    oracle_names = [d[0] for d in cursor.description]
    if sorted(frame.columns) != sorted(oracle_names):
        return f"columns {sorted(frame.columns)} against {sorted(oracle_names)}"
    ours = rows_of(frame.columns, frame.collect())
    theirs = rows_of(oracle_names, cursor.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"\n  ours   {a}\n  oracle {b}"
    return None if ours else "no rows"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    name_local_checkpoint_dir(spark)
    connection, bad = connect(sf_dir), 0
    for name in names:
        started = time.time()
        try:
            problem = difference(spark, connection, sf_dir, name) if name in ORACLES else "no oracle"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'DIFF'} {name} {time.time() - started:.2f}s {problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
