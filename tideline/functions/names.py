"""Table-name patterns and tenant prefixes."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# LIKE patterns of temporary and staging tables. `\_` is a literal
# underscore, a bare `_` any single character.
BLOCKED_PATTERNS = (
    r"bc_tmp%",
    r"bcst\_%",
    r"bct\_%",
    r"bctt\_%",
    r"cc_TMP%",
    r"ccst_%",
    r"cct\_%",
    r"cctt\_%",
    r"cc\_%workitem",
    r"ab_tmp%",
    r"abst_%",
    r"abt\_%",
    r"abtt\_%",
    r"xx\_%",
    r"ab\_%workitem",
    r"pc_tmp%",
    r"pcst_%",
    r"pct\_%",
    r"pctt\_%",
    r"pc\_%workitem",
)

# The table-name pattern that belongs to each merged schema.
TENANT_PATTERNS = {"MRG_PC": "PC%", "MRG_BC": "BC%", "MRG_CC": "CC%", "MRG_CM": "AB%"}

HEARTBEAT = "heartbeat"


def like_expression(pattern: str) -> str:
    """A LIKE pattern as a regular expression; a backslash takes the next character as it is."""
    wild = {"%": ".*", "_": "."}
    tokens = re.findall(r"\\.|.", pattern, re.DOTALL)
    return "".join(re.escape(t[1]) if len(t) > 1 else wild.get(t) or re.escape(t) for t in tokens)


def matches_any(name: Column, patterns: Iterable[str] = BLOCKED_PATTERNS) -> Column:
    """True where the name matches one of the patterns, ignoring case: one expression, so that a name is read once."""
    choices = "|".join(like_expression(pattern.lower()) for pattern in patterns) or "(?!)"
    return F.lower(name).rlike(rf"(?s)\A(?:{choices})\z")


def tenant_pattern(schema_name: Column) -> Column:
    """The name pattern of a merged schema; an unknown schema is an error."""
    shown = F.coalesce(schema_name, F.lit("null"))
    chosen = F.raise_error(F.concat(F.lit("no table pattern for schema "), shown)).cast("string")
    for schema, pattern in TENANT_PATTERNS.items():
        chosen = F.when(schema_name == schema, F.lit(pattern)).otherwise(chosen)
    return chosen


def in_tenant(schema_name: Column, table_name: Column) -> Column:
    return F.ilike(table_name, tenant_pattern(schema_name))
