"""Identifier handling: quoting and file-format-safe field names."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quote(name: str) -> str:
    """Back-tick quoting, so that case, dots, dashes, spaces and unicode survive in SQL text."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """A column reference by exact name, never read as a nested path."""
    return F.col(quote(name))


def sanitize_name(name: str) -> str:
    """Letters, digits and underscores only; a leading digit is prefixed; nothing usable left gives ``record``."""
    safe = re.sub(r"[^A-Za-z0-9_]", "_", name)
    if not safe.strip("_"):
        return "record"
    return "_" + safe if safe[0].isdigit() else safe


def sanitized(name: Column) -> Column:
    """The same rule as :func:`sanitize_name` on a column of names."""
    safe = F.regexp_replace(name, "[^A-Za-z0-9_]", "_")
    return (
        F.when(safe.rlike("^_*$"), F.lit("record"))
        .when(safe.rlike("^[0-9]"), F.concat(F.lit("_"), safe))
        .otherwise(safe)
    )


def sanitize_names(df: DataFrame) -> DataFrame:
    """Rename every column to its safe form; two columns that would collide are an error."""
    renames = {name: sanitize_name(name) for name in df.columns}
    seen: dict[str, str] = {}
    for old, new in renames.items():
        if new in seen:
            raise ValueError(f"Columns '{seen[new]}' and '{old}' both become '{new}'")
        seen[new] = old
    return df.withColumnsRenamed(renames)
