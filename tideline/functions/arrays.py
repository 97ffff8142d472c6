"""Array expressions that treat a null array as empty where a log must not lose entries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def no_strings() -> Column:
    return F.array().cast("array<string>")


def or_empty(values: Column) -> Column:
    return F.coalesce(values, no_strings())


def append_when(values: Column, condition: Column, value: str) -> Column:
    """`values` with `value` added where the condition is true (null counts as false)."""
    return F.when(condition, F.array_append(or_empty(values), F.lit(value))).otherwise(or_empty(values))


def symmetric_difference(left: Column, right: Column) -> Column:
    """Entries found in exactly one of the two arrays."""
    return F.array_union(F.array_except(left, right), F.array_except(right, left))
