"""Notification texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.context import ensure_checkpoint_dir
from tideline.functions.texts import cut, last_line

SEPARATOR = "\n\n\n"
#: Blocks to a part of a notice.
PART = 1000
#: Leading rows a group up to which Spark limits them in the map tasks (spark.sql.optimizer.windowGroupLimitThreshold).
LEADING = 1000


def numbered(blocks: DataFrame, group: str, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The blocks with their 0-based `position` in their group, from sorted range slices and one count per group and slice,
    and the number of entries per group. Null blocks, which come last in their group, are counted only."""
    spark = blocks.sparkSession
    ensure_checkpoint_dir(spark)
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(group), F.col("_b").isNull(), *map(F.col, keys)]
    # Checkpointed, as counts and rows must come from the same slices; the entries are worked out once.
    sliced = (
        blocks.repartitionByRange(slices, *order)
        .sortWithinPartitions(*order)
        .withColumns({"_slice": F.spark_partition_id(), "_row": F.monotonically_increasing_id()})
        .checkpoint(eager=True)
    )
    sizes = sliced.groupBy(F.col(group).alias("_group"), F.col("_slice").alias("_in")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first")
    )
    so_far = Window.partitionBy("_group").orderBy("_in")
    starts = sizes.withColumn("_start", F.sum("_n").over(so_far) - F.col("_n") - F.col("_first"))
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_slice") == F.col("_in"))
    shown = sliced.where(F.col("_b").isNotNull())
    placed = shown.join(starts, same).select(group, "_b", (F.col("_start") + F.col("_row")).alias("position"))
    return placed, sizes.groupBy(F.col("_group").alias(group)).agg(F.sum("_n").alias("entry_count"))


def joined(rows: DataFrame, by: Sequence[str], order: str, text: str) -> DataFrame:
    """Per group the number of rows and their texts joined in order."""
    made = F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.col(text).alias("text"))))
    out = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("entry_count"), made.alias("_all"))
    return out.select(*by, "entry_count", F.array_join(F.col("_all.text"), SEPARATOR).alias("notice"))


def notices(
    entries: DataFrame, group: str, order: Sequence[str], block: Column, limit: int | None = None, parts: bool = False
) -> DataFrame:
    """Per group the number of entries and all their blocks joined in order.

    `order` should be a total order, so that the text does not depend on the run. `limit` cuts the text to so many
    characters, for a channel that takes no more; only leading blocks that can show are gathered then.

    Without a limit every block is kept. With `parts` the result is (group, part_no, entry_count, notice), `PART` blocks
    to a part, which no group outgrows; parts joined by `SEPARATOR` are the whole text. Otherwise the parts are joined in
    one cell, so a group's text has to stay under Spark's 2 GB for one: larger reports need `parts`.
    """
    if parts and limit is not None:
        raise ValueError("a limit is for one text a group, parts are for all of it")
    named = {f"_o{i}": F.col(c) for i, c in enumerate(order)}
    keys = [*named, "_b"]
    # A null block shows nowhere, but counts as an entry.
    rows = entries.select(group, *[c.alias(n) for n, c in named.items()], block.alias("_b"))
    # Every block after the first has a separator before it, which bounds how many can show.
    leading = 0 if limit is None else max(limit, 0) // len(SEPARATOR) + 2
    if 0 < leading < LEADING:
        place = F.row_number().over(Window.partitionBy(group).orderBy(*keys))
        placed = rows.where(F.col("_b").isNotNull()).withColumn("position", place).where(F.col("position") <= leading)
        counts = rows.groupBy(group).agg(F.count(F.lit(1)).alias("entry_count"))
    else:
        placed, counts = numbered(rows, group, keys)
        placed = placed.where(F.col("position") < leading) if leading else placed
    placed = placed.withColumn("part_no", F.floor(F.col("position") / F.lit(PART)).cast("bigint"))
    by_part = joined(placed, [group, "part_no"], "position", "_b")
    if parts:
        return by_part
    whole = joined(by_part, [group], "part_no", "notice").select(F.col(group).alias("_group"), "notice")
    text = F.coalesce(cut(F.col("notice"), limit), F.lit(""))
    return counts.join(whole, F.col(group).eqNullSafe(F.col("_group")), "left").select(group, "entry_count", text.alias("notice"))


# Fixed value: the rule below an error block.
RULE = "*" * 56


def known(value: Column) -> Column:
    return F.coalesce(value, F.lit("None"))


def failure_report(errors: DataFrame, group: str = "core_center", limit: int | None = None, parts: bool = False) -> DataFrame:
    """One text per core center (or its parts) from failed steps (table_name, procedure_name, error_message)."""
    block = F.concat(
        F.lit("Table Name: "), known(F.col("table_name")),
        F.lit("\nProcedure Name: "), known(F.col("procedure_name")),
        F.lit("\nException: "), known(last_line(F.col("error_message"))),
        F.lit("\n\n" + RULE),
    )
    return notices(errors, group, ["table_name", "procedure_name", "error_message"], block, limit, parts)


def table_failure_notice(errors: DataFrame, limit: int | None = None, parts: bool = False) -> DataFrame:
    """One text per schema (or its parts) from tables that could not be compared (table_name, error_message)."""
    block = F.concat(
        F.lit("Schema Name: "), known(F.col("schema_name")),
        F.lit("\nTable Name: "), known(F.col("table_name")),
        F.lit("\nException: "), known(last_line(F.col("error_message"))), F.lit("\n"),
    )
    return notices(errors, "schema_name", ["table_name", "error_message"], block, limit, parts)


def run_state(plan_rows: int, s3_on: bool, mrg_on: bool, failures: int) -> str:
    """The single outcome a run reports."""
    if not s3_on and not mrg_on:
        return "disabled"
    if plan_rows == 0:
        return "no_work"
    return "failure" if failures else "success"
