"""Inputs shared by the queries: the event table as a topic log, and a folder to write to."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import to_envelope

PARTITIONS = 4
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared place the session names, or beside the warehouse where it names none."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{shared.rstrip('/')}/tidegate-{uuid4().hex}"


def event_fields() -> list[Column]:
    return [
        F.col("event_id"),
        F.date_format("ts", ISO).alias("ts"),
        F.col("user_id"),
        F.col("event_type"),
        F.col("value"),
    ]


def event_json(*extra: Column) -> Column:
    return F.to_json(F.struct(*event_fields(), *extra))


def as_log(events: DataFrame, value: Column) -> DataFrame:
    """Events as a topic log: topic = event type, partition = user, offset = event id (rising within a partition)."""
    return to_envelope(
        events,
        topic=F.col("event_type"),
        partition=F.col("user_id") % PARTITIONS,
        offset=F.col("event_id"),
        value=value,
        timestamp=F.col("ts"),
        key=F.col("user_id").cast("string"),
    )


def event_log(spark: SparkSession, sf: str, *extra: Column) -> DataFrame:
    return as_log(table(spark, sf, "events"), event_json(*extra))


def micros(c: str | Column) -> Column:
    """A timestamp of either kind as microseconds, for comparison across engines."""
    return F.unix_micros((F.col(c) if isinstance(c, str) else c).cast("timestamp"))


def bigint(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")
