"""Target tables: which exist, and what columns they have."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..functions.names import quote
from ..functions.types import SchemaError, TableSpec


def missing_tables(spark: SparkSession, names: list[str], database: str | None = None) -> list[str]:
    """Wanted tables that the catalog lacks, in the order given."""
    prefix = f"{quote(database)}." if database else ""
    return [n for n in dict.fromkeys(names) if not spark.catalog.tableExists(prefix + quote(n))]


def discover(spark: SparkSession, names: list[str], database: str | None = None) -> dict[str, TableSpec]:
    """The specification of every named table. Tables are never created: a missing one is an error naming it."""
    missing = missing_tables(spark, names, database)
    if missing:
        raise SchemaError(f"Tables do not exist: {', '.join(missing)}")
    prefix = f"{quote(database)}." if database else ""
    return {n: TableSpec.from_spark(n, spark.table(prefix + quote(n)).schema) for n in dict.fromkeys(names)}
