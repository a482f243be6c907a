"""Plain sinks: appending to a catalog table and writing a batch as parquet."""

from __future__ import annotations

import re
from uuid import uuid4

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..functions.names import quote
from ..functions.types import TableSpec
from .decode import prune_null_columns


def append(rows: DataFrame, table: str, spec: TableSpec, prune: bool = True) -> list[str]:
    """Insert into an existing table and return the columns that were written.

    With ``prune`` columns without a single value are left out, so that the table's defaults apply; a batch with no
    usable column inserts nothing.
    """
    # The rows are looked at twice where columns are pruned; they are planned and parsed once.
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK) if prune else rows
    try:
        columns = prune_null_columns(rows, spec) if prune else spec.names
        return _insert(rows, table, columns)
    finally:
        if prune:
            rows.unpersist()


def table_name(name: str) -> str:
    """A table name, dotted or with quoted parts, with every part quoted."""
    parts = [part[1:-1].replace("``", "`") if part.startswith("`") else part for part in re.findall(r"`(?:[^`]|``)+`|[^.`]+", name)]
    return ".".join(quote(part) for part in parts)


def _insert(rows: DataFrame, table: str, columns: list[str]) -> list[str]:
    if columns:
        listed = ", ".join(quote(c) for c in columns)
        view = f"batch_{uuid4().hex}"
        rows.createOrReplaceTempView(view)
        try:
            rows.sparkSession.sql(f"INSERT INTO {table_name(table)} ({listed}) SELECT {listed} FROM {view}")
        finally:
            rows.sparkSession.catalog.dropTempView(view)
    return columns


def write_parquet_batch(rows: DataFrame, path: str, max_records_per_file: int = 0) -> None:
    """One batch as parquet, full table schema, replacing an earlier attempt at the same path."""
    rows.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file).parquet(path)
