"""Quota figures: percent texts, period phase and progress bars."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cell count and symbols of a progress bar.
WIDTH = 50
FILLED = "▓"
EMPTY = "░"
SUSPEND_MARK = "⚠️"
STOP_MARK = "🛑"

# Period lengths in seconds.
PERIOD_SECONDS = {"WEEKLY": 604_800, "DAILY": 86_400}

BLANKS = " \t\r\n\f\x0b"


def percent_ratio(text: Column) -> Column:
    """`90%` as 0.9; null and empty text give null, other text is an error."""
    digits = F.replace(F.btrim(text, F.lit(BLANKS)), F.lit("%"), F.lit(""))
    value = digits.try_cast("decimal(20, 6)")
    failed = F.raise_error(F.concat(F.lit("not a percentage: "), text)).cast("decimal(20, 6)")
    ratio = (F.coalesce(value, failed) / F.lit(100)).cast("decimal(20, 8)")
    return F.when(text.isNull() | (text == ""), F.lit(None).cast("decimal(20, 8)")).otherwise(ratio)


def period_seconds(frequency: Column) -> Column:
    shown = F.coalesce(frequency, F.lit("null"))
    chosen = F.raise_error(F.concat(F.lit("unhandled frequency: "), shown)).cast("bigint")
    for name, seconds in PERIOD_SECONDS.items():
        chosen = F.when(frequency == name, F.lit(seconds).cast("bigint")).otherwise(chosen)
    return chosen


def zone_free_micros(moment: Column) -> Column:
    """Microseconds of a zone-free timestamp since 1970, whatever the session zone is."""
    minutes = F.unix_date(F.to_date(moment)) * F.lit(1440).cast("bigint") + F.hour(moment) * 60 + F.minute(moment)
    return minutes * 60_000_000 + (F.date_part(F.lit("SECOND"), moment) * 1_000_000).cast("bigint")


def phase_micros(start: Column, as_of: Column, frequency: Column) -> Column:
    """Time since the running period began."""
    elapsed = zone_free_micros(as_of) - zone_free_micros(start)
    return F.pmod(elapsed, period_seconds(frequency) * 1_000_000)


def two_places(amount: Column) -> Column:
    return F.bround(amount, 2).cast("decimal(18, 2)")


def filled_cells(part: Column, whole: Column) -> Column:
    """`round(part / whole * WIDTH)`, ties to the even cell, never below zero."""
    share = part.cast("decimal(20, 2)") * F.lit(WIDTH) / whole.cast("decimal(18, 2)")
    return F.greatest(F.bround(share, 0).cast("int"), F.lit(0))


def marker_cell(ratio: Column) -> Column:
    """The cell of a threshold; none for a missing or zero threshold."""
    return F.when(ratio != 0, F.floor(ratio * F.lit(WIDTH)).cast("int"))


def one_if(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def plain_bar(filled: Column) -> Column:
    """Filled cells, then empty ones up to WIDTH; longer than WIDTH above the quota."""
    return F.rpad(F.repeat(F.lit(FILLED), filled), F.greatest(filled, F.lit(WIDTH)), F.lit(EMPTY))


def place_mark(bar: Column, cells: Column, cell: Column, mark: str, shift: Column | int = 0) -> Column:
    """The bar with a marker in one cell, or behind the last of its `cells`; a cell further out
    shows none. `shift` is the number of code points before the cell beyond one per cell."""
    return (
        F.when(cell == cells, F.concat(bar, F.lit(mark)))
        .when(cell < cells, F.overlay(bar, F.lit(mark), cell + 1 + shift, F.lit(1)))
        .otherwise(bar)
    )


def with_bars(rows: DataFrame, bars: Mapping[str, str], suspend_cell: str, stop_cell: str) -> DataFrame:
    """Adds progress bars: `bars` names the column of filled cells for each new bar.

    The suspend marker is placed first and the stop marker takes its cell when both
    fall together, so a suspend marker in the same cell is not placed at all. It is two
    code points long, so a stop marker behind it moves by one. Each step is its own
    projection: nested in one expression, the steps would repeat each other.
    """
    suspend = F.when(~F.col(suspend_cell).eqNullSafe(F.col(stop_cell)), F.col(suspend_cell))
    stop = F.col(stop_cell)
    steps = rows.withColumns(
        {f"_{bar}_cells": F.greatest(F.col(filled), F.lit(WIDTH)) for bar, filled in bars.items()}
        | {f"_{bar}": plain_bar(F.col(filled)) for bar, filled in bars.items()}
        | {"_suspend": suspend}
    )
    steps = steps.withColumns(
        {f"_{bar}": place_mark(F.col(f"_{bar}"), F.col(f"_{bar}_cells"), F.col("_suspend"), SUSPEND_MARK) for bar in bars}
        | {f"_{bar}_shift": one_if((F.col("_suspend") <= F.col(f"_{bar}_cells")) & (F.col("_suspend") < stop)) for bar in bars}
        | {f"_{bar}_cells": F.col(f"_{bar}_cells") + one_if(F.col("_suspend") == F.col(f"_{bar}_cells")) for bar in bars}
    )
    return steps.withColumns(
        {
            bar: place_mark(F.col(f"_{bar}"), F.col(f"_{bar}_cells"), stop, STOP_MARK, F.col(f"_{bar}_shift"))
            for bar in bars
        }
    ).drop("_suspend", *[f"_{bar}{end}" for bar in bars for end in ("", "_cells", "_shift")])
