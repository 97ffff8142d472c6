"""Row-level writes without a table format: the target is joined and rewritten.

The result is a frame; write it to a new location, never onto the one being read.
Where the target is bucketed by the key, only the source side is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTION = "_action"
_IN_TARGET = "_in_target"
_IN_SOURCE = "_in_source"
_HIT = "_hit"


def src(name: str) -> Column:
    return F.col(f"src.{name}")


def tgt(name: str) -> Column:
    return F.col(f"tgt.{name}")


def _checked(source: DataFrame, keys: Sequence[str], match: Callable[[Column], Column]) -> DataFrame:
    """The source with one row per key; a repeated or null key fails the job.

    The rows are grouped by the join key, so the join reuses this shuffle, and a
    repeated key is combined in the map tasks.
    """
    named = source.withColumns({f"_k{i}": match(F.col(k)) for i, k in enumerate(keys)})
    key_names = [f"_k{i}" for i in range(len(keys))]
    grouped = named.groupBy(*key_names).agg(
        F.count(F.lit(1)).alias("_n"), F.first(F.struct(*source.columns)).alias("_row")
    )
    has_null = F.array_contains(F.array(*[F.col(k).isNull() for k in key_names]), True)
    problem = F.when(has_null, F.lit("null key in upsert source")).when(
        F.col("_n") > 1, F.concat(F.lit("repeated key in upsert source: "), F.to_json(F.struct(*key_names)))
    )
    sound = F.when(problem.isNull(), F.lit(True)).otherwise(F.raise_error(problem).cast("boolean"))
    return grouped.where(sound).select("_row.*", *key_names)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    update: Mapping[str, Column],
    insert: Mapping[str, Column] | None = None,
    update_when: Column | None = None,
    match: Callable[[Column], Column] = lambda c: c,
    unique_source: bool = False,
    with_action: bool = False,
) -> DataFrame:
    """Merge `source` into `target` on `keys`.

    A matched row takes the `update` values if `update_when` is true (false or null
    leaves it alone); an unmatched source row is inserted with the `insert` values
    (default: the source columns of the same name), other columns null. Expressions
    use `src(name)` and `tgt(name)`. `match` maps key columns before comparison.
    `unique_source` states that the source is grouped by the keys already and skips
    the check. `with_action` adds what happened to each row: `insert`, `update`, `match`
    (met a source row but was left alone) or `keep`.
    """
    if insert is None:
        insert = {c: src(c) for c in source.columns if c in target.columns}
    if unique_source:
        right = source.withColumns({f"_k{i}": match(F.col(k)) for i, k in enumerate(keys)})
    else:
        right = _checked(source, keys, match)
    right = right.withColumn(_IN_SOURCE, F.lit(True)).alias("src")
    left = target.withColumns(
        {_IN_TARGET: F.lit(True)} | {f"_k{i}": match(F.col(k)) for i, k in enumerate(keys)}
    ).alias("tgt")
    joined = left.join(right, [tgt(f"_k{i}") == src(f"_k{i}") for i in range(len(keys))], "full_outer")

    is_new = F.col(_IN_TARGET).isNull()
    hit = F.col(_IN_SOURCE).isNotNull()
    if update_when is not None:
        hit = hit & F.coalesce(update_when, F.lit(False))
    # A column of its own, as the condition would be worked out again for every updated column.
    joined, hit = joined.withColumn(_HIT, hit), F.col(_HIT)

    def value(field) -> Column:
        kept = F.when(hit, update[field.name]).otherwise(tgt(field.name)) if field.name in update else tgt(field.name)
        new = insert.get(field.name, F.lit(None))
        return F.when(is_new, new).otherwise(kept).cast(field.dataType).alias(field.name)

    columns = [value(field) for field in target.schema.fields]
    if with_action:
        met = F.col(_IN_SOURCE).isNotNull()
        columns.append(F.when(is_new, "insert").when(hit, "update").when(met, "match").otherwise("keep").alias(ACTION))
    return joined.select(*columns)


def merge_into(
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    *,
    update: Mapping[str, Column],
    insert: Mapping[str, Column] | None = None,
    update_when: Column | None = None,
) -> None:
    """The same merge done by the catalog, for tables of a format that supports row-level writes.

    Expressions use `src(name)`, and the table's own name for its columns.
    """
    on = reduce(and_, [F.col(f"{table}.{k}") == src(k) for k in keys])
    merge = source.alias("src").mergeInto(table, on).whenMatched(update_when).update(dict(update))
    if insert is None:
        merge.whenNotMatched().insertAll().merge()
    else:
        merge.whenNotMatched().insert(dict(insert)).merge()


def action_counts(merged: DataFrame) -> DataFrame:
    """Rows written by an upsert: inserted, updated and their sum."""
    inserted = F.count_if(F.col(ACTION) == "insert")
    updated = F.count_if(F.col(ACTION) == "update")
    return merged.agg(
        inserted.alias("rows_inserted"), updated.alias("rows_updated"), (inserted + updated).alias("row_count")
    )


def update_where(target: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns on the rows where the condition is true."""
    return target.select(
        *[
            F.when(condition, values[f.name]).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name)
            if f.name in values
            else F.col(f.name)
            for f in target.schema.fields
        ]
    )


def update_from(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    values: Mapping[str, Column],
    match: Callable[[Column], Column] = lambda c: c,
) -> DataFrame:
    """Set columns from the source row of the same key; rows without one keep their values.

    The source must hold a key at most once.
    """
    left = target.alias("tgt")
    right = source.withColumn(_IN_SOURCE, F.lit(True)).alias("src")
    joined = left.join(right, [match(tgt(k)) == match(src(k)) for k in keys], "left")
    return joined.select(
        *[
            F.when(F.col(_IN_SOURCE), values[f.name]).otherwise(tgt(f.name)).cast(f.dataType).alias(f.name)
            if f.name in values
            else tgt(f.name)
            for f in target.schema.fields
        ]
    )


def truncate(target: DataFrame) -> DataFrame:
    """No rows, same columns."""
    return target.limit(0)
