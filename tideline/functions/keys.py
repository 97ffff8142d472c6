"""Object-key expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The suffix of a data file and the landing folder.
DATA_SUFFIX = ".snappy.parquet"
LANDING_PREFIX = "__copy_into__"


def is_data_file(key: Column) -> Column:
    return key.endswith(DATA_SUFFIX)


def stem(name: Column) -> Column:
    """The name without its last extension; a leading dot is not an extension."""
    return F.when(F.contains(name, F.lit(".")), F.regexp_replace(name, r"^(.+)\.[^.]+$", "$1")).otherwise(name)


def path_parts(key: Column) -> dict[str, Column]:
    """`{prefix}/{table}/{schema id}/{timestamp}/{file}` taken apart; short keys give nulls."""
    parts = F.split(key, "/")
    return {
        "table_name": stem(F.try_element_at(parts, F.lit(-4))),
        "cda_schema_id": stem(F.try_element_at(parts, F.lit(-3))),
        "cda_timestamp": stem(F.try_element_at(parts, F.lit(-2))),
    }


def strip_slashes(prefix: Column) -> Column:
    """Drop trailing slashes; the marker text `NOT AVAILABLE` means no prefix."""
    return F.when(prefix == "NOT AVAILABLE", F.lit("")).otherwise(F.regexp_replace(prefix, r"/+$", ""))


def join_prefix(prefix: Column, name: Column) -> Column:
    """`prefix/name`, or just `name` below an empty prefix."""
    return F.when(prefix == "", name).otherwise(F.concat(prefix, F.lit("/"), name))


def landing_key(key: Column, source_prefix: str, landing_prefix: str = LANDING_PREFIX) -> Column:
    """The key below the landing folder. The source prefix is removed at the front only,
    and exactly one slash follows the landing folder."""
    head = source_prefix.strip("/") + "/"
    if head == "/":
        tail = F.ltrim(key, F.lit("/"))
    else:
        tail = F.when(key.startswith(head), F.substr(key, F.lit(len(head) + 1))).otherwise(key)
    return F.concat(F.lit(landing_prefix + "/"), tail)
