"""Quota status per monitor."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.context import ntz
from tideline.functions import quotas as q


def quota_figures(monitors: DataFrame, as_of: datetime) -> DataFrame:
    """Thresholds, period phase and bars of every monitor."""
    phase = q.phase_micros(F.col("start_time"), ntz(as_of), F.col("frequency"))
    thresholds = monitors.withColumns(
        {
            "suspend_ratio": q.percent_ratio(F.col("suspend_at")),
            "stop_ratio": q.percent_ratio(F.col("suspend_immediately_at")),
            "phase_micros": phase,
            "period_micros": q.period_seconds(F.col("frequency")) * 1_000_000,
        }
    )
    cells = thresholds.withColumns(
        {
            "suspend_at_credits": q.two_places(F.col("credit_quota") * F.col("suspend_ratio")),
            "stop_at_credits": q.two_places(F.col("credit_quota") * F.col("stop_ratio")),
            "time_cells": q.filled_cells(F.col("phase_micros"), F.col("period_micros")),
            "credit_cells": q.filled_cells(F.col("used_credits"), F.col("credit_quota")),
            "suspend_cell": q.marker_cell(F.col("suspend_ratio")),
            "stop_cell": q.marker_cell(F.col("stop_ratio")),
        }
    )

    barred = q.with_bars(cells, {"time_bar": "time_cells", "credit_bar": "credit_cells"}, "suspend_cell", "stop_cell")
    return barred.withColumn("over_quota", F.col("used_credits") > F.col("credit_quota"))


def start_text(start: Column) -> Column:
    whole = F.date_trunc("second", start) == start
    return F.when(whole, F.date_format(start, "yyyy-MM-dd HH:mm:ss")).otherwise(
        F.date_format(start, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )


def quota_report(monitors: DataFrame, as_of: datetime) -> DataFrame:
    """The status block of every monitor; lines of missing thresholds are left out."""
    rows = quota_figures(monitors, as_of)

    def line(label: str, value: Column) -> Column:
        return F.concat(F.lit(f"{label}: "), value.cast("string"))

    status = F.concat_ws(
        "\n",
        line("Resource Monitor Name", F.col("name")),
        line("Monitor Frequency", F.col("frequency")),
        line("Frequency Start Time", start_text(F.col("start_time"))),
        line("Credit Limit", q.two_places(F.col("credit_quota"))),
        line("Credits Consumed", q.two_places(F.col("used_credits"))),
        line("Suspend At", F.col("suspend_at_credits")),
        line("Suspend Immediately At", F.col("stop_at_credits")),
        F.lit("Time:"),
        F.col("time_bar"),
        F.lit("Credits:"),
        F.col("credit_bar"),
        F.lit("-" * q.WIDTH),
    )
    return rows.select("name", "over_quota", status.alias("status"))


def quota_message(report: DataFrame, account_name: str) -> DataFrame:
    """The report text as lines in name order: a heading, then each status block and a blank
    line. Kept as sorted rows so that it can be written in parts."""
    spark = report.sparkSession
    head = spark.createDataFrame(
        [("", f"{account_name} Environment Resource Monitor Status Report:\n")], "name string, value string"
    )
    body = report.select("name", F.concat("status", F.lit("\n")).alias("value"))
    return head.unionByName(body).orderBy("name").select("value")
