"""Shared helpers: the folder all machines see, tables that cut lineage, and reading a table of the test data."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, StringType

#: Characters that separate words, as a regular expression class body.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` where the cluster names one, else a folder beside the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named.rstrip("/") if named else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/llm-work"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps survive lost executors and do not recompute it."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str | Column) -> Column:
    """A text, null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


#: A staged table of at most so many rows and bytes of values is broadcast; larger ones are joined by shuffling.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 64_000_000


def _bytes(name: str, of: DataType) -> Column:
    """About how many bytes a value takes; elements of an array are counted as structs of numbers."""
    if isinstance(of, (StringType, BinaryType)):
        return 8 + F.coalesce(F.octet_length(name), F.lit(0))
    return 8 + 32 * F.greatest(F.size(name), F.lit(0)) if isinstance(of, ArrayType) else F.lit(8)


def bounded(staged: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """The same table, marked for broadcast where a count of its rows and bytes shows that it is small enough."""
    width = sum((_bytes(f"`{f.name}`", f.dataType) for f in staged.schema), F.lit(0)).cast("long")
    found = staged.agg(F.count("*").alias("n"), F.sum(width).alias("size")).first()
    return F.broadcast(staged) if found["n"] <= rows and (found["size"] or 0) <= size else staged
