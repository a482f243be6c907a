"""The topic-log source: records as ``topic, partition, offset, timestamp, key, value``.

The columns are exactly those of Spark's Kafka source, so a ``format("kafka")`` reader is a drop-in replacement
for the file-based ones here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.decode import ENVELOPE


def read_topic_log(spark: SparkSession, path: str, topics: list[str] | None = None) -> DataFrame:
    """A topic log at rest. Restricting topics here lets the scan skip files and row groups."""
    log = spark.read.schema(ENVELOPE).parquet(path)
    return log if topics is None else log.where(F.col("topic").isin(topics))


def stream_topic_log(spark: SparkSession, path: str, max_files_per_batch: int | None = None) -> DataFrame:
    """A topic log as a stream of the files that arrive under ``path``."""
    reader = spark.readStream.schema(ENVELOPE)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.parquet(path)


def to_envelope(
    df: DataFrame,
    topic: Column,
    partition: Column,
    offset: Column,
    value: Column,
    timestamp: Column | None = None,
    key: Column | None = None,
) -> DataFrame:
    """Any table as a topic log. A record without a timestamp counts as arriving now."""
    arrived = F.current_timestamp() if timestamp is None else F.coalesce(timestamp.cast("timestamp"), F.current_timestamp())
    return df.select(
        topic.cast("string").alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        arrived.alias("timestamp"),
        (F.lit(None) if key is None else key).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
    )
