"""Text and JSON expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_line(text: Column) -> Column:
    """The last line, a closing line break aside."""
    unix = F.regexp_replace(text, r"\r\n?", "\n")
    body = F.when(unix.endswith("\n"), F.substr(unix, F.lit(1), F.length(unix) - 1)).otherwise(unix)
    return F.substring_index(body, "\n", -1)


def cut(text: Column, limit: int | None) -> Column:
    """The first `limit` characters; all of them without a limit."""
    return text if limit is None else F.substr(text, F.lit(1), F.lit(limit))


def json_payload(columns: Sequence[str]) -> Column:
    """The columns as one JSON object; nulls are written, not dropped."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def hex_order(value: Column) -> Column:
    """A sort value of hexadecimal text: numbers in order, whatever their width, case, `0x` or leading zeros."""
    text = F.upper(value)
    digits = F.ltrim(F.when(text.startswith("0X"), F.substr(text, F.lit(3))).otherwise(text), F.lit("0"))
    return F.struct(F.char_length(digits).alias("digits"), digits.alias("text"))
