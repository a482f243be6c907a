"""Per-partition progress: the replay filter and the high-water mark."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

LEDGER_SCHEMA = "topic string, topic_partition int, partition_offset bigint"
UNKNOWN_PARTITION = -1  # stands for a record without a partition
UNSEEN_OFFSET = -1  # a partition nothing has been ingested from yet


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER_SCHEMA)


def drop_processed(df: DataFrame, ledger: DataFrame) -> DataFrame:
    """Keep records of unseen partitions and records beyond their partition's last offset.

    The ledger has one row per topic partition. No broadcast is forced: a ledger read back from files has a known
    size, so Spark broadcasts it while it is small, and the join stays correct (and skew-splittable) when it is not.
    """
    last = ledger.select(
        F.col("topic").alias("_topic"),
        F.col("topic_partition").alias("_partition"),
        F.col("partition_offset").alias("_last"),
    )
    partition = F.coalesce(F.col("partition"), F.lit(UNKNOWN_PARTITION))
    joined = df.join(last, (F.col("topic") == F.col("_topic")) & (partition == F.col("_partition")), "left")
    fresh = joined.where(F.col("_last").isNull() | (F.col("offset") > F.col("_last")))
    return fresh.drop("_topic", "_partition", "_last")


def high_water(df: DataFrame) -> DataFrame:
    """Highest offset per topic partition. Combines map-side, so a hot partition costs one row per task."""
    partition = F.coalesce(F.col("partition"), F.lit(UNKNOWN_PARTITION))
    return df.groupBy("topic", partition.alias("topic_partition")).agg(F.max("offset").alias("partition_offset"))


def advance_offsets(df: DataFrame, ledger: DataFrame) -> DataFrame:
    """The ledger after ``df``: never lower than before, new partitions added, absent ones kept."""
    return (
        ledger.unionByName(high_water(df))
        .groupBy("topic", "topic_partition")
        .agg(F.max("partition_offset").alias("partition_offset"))
    )


def register_partitions(ledger: DataFrame, partitions: DataFrame) -> DataFrame:
    """Add assigned partitions (``topic, topic_partition``) that the ledger has not seen, at offset -1."""
    unseen = partitions.select("topic", "topic_partition").distinct()
    unseen = unseen.join(ledger, ["topic", "topic_partition"], "left_anti")
    return ledger.unionByName(unseen.withColumn("partition_offset", F.lit(UNSEEN_OFFSET).cast("bigint")))


def start_high_water(stream: DataFrame, path: str, checkpoint: str, *, available_now: bool = False, trigger_seconds: float | None = None) -> StreamingQuery:
    """Keep the high-water mark of a stream under ``path``, as a stateful aggregate.

    Spark's state store holds one row per topic partition and the checkpoint carries it from run to run, so no batch reads
    earlier records; a batch writes the partitions that it moved, into a folder of its number, which a rerun overwrites.
    New partitions join by themselves.
    """

    def write(moved: DataFrame, number: int) -> None:
        moved.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={number}")

    writer = high_water(stream).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger_seconds is not None:
        writer = writer.trigger(processingTime=f"{trigger_seconds} seconds")
    return writer.start()


def read_high_water(spark: SparkSession, path: str) -> DataFrame:
    """The ledger that :func:`start_high_water` keeps: of all that was written for a partition, the highest."""
    try:
        moved = spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_ledger(spark)
    return moved.groupBy("topic", "topic_partition").agg(F.max("partition_offset").alias("partition_offset"))
