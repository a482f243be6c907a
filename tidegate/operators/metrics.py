"""Ingest metrics over a table of batches (``started_at, ended_at, records, bytes, ok``)."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from threading import Semaphore

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

MIB = 1024 * 1024
GOOD_PERCENT, OK_PERCENT = 5.0, -5.0


def round1(value: Column) -> Column:
    """One decimal, halves up."""
    return F.floor(value * 10 + 0.5) / 10


def _micros(name: str) -> Column:
    return F.unix_micros(F.col(name).cast("timestamp"))


def throughput(batches: DataFrame, by: list[str], record_bytes: int | None = None) -> DataFrame:
    """Records, whole records per second and MiB per second of each group of batches.

    Bytes are ``record_bytes`` per record where given, else the ``bytes`` column.
    """
    seconds = F.sum(_micros("ended_at") - _micros("started_at")) / 1e6
    size = F.sum("records") * record_bytes if record_bytes is not None else F.sum("bytes")
    grouped = batches.groupBy(*by).agg(
        F.sum("records").alias("records"), seconds.alias("seconds"), size.cast("double").alias("_bytes")
    )
    timed = F.col("seconds") > 0
    return grouped.select(
        *by,
        "records",
        round1(F.col("seconds")).alias("duration_seconds"),
        F.when(timed, F.floor(F.col("records") / F.col("seconds"))).otherwise(0).alias("records_per_sec"),
        F.when(timed, round1(F.col("_bytes") / (MIB * F.col("seconds")))).otherwise(0.0).alias("mib_per_sec"),
    )


def ingest_rate(batches: DataFrame, by: list[str]) -> DataFrame:
    """First start to last end of the successful batches, and the rate over at least one second of it."""
    window = (
        batches.where("ok")
        .groupBy(*by)
        .agg(
            F.min("started_at").alias("first_start"),
            F.max("ended_at").alias("last_end"),
            F.sum("records").alias("records"),
        )
    )
    seconds = F.unix_seconds(F.col("last_end").cast("timestamp")) - F.unix_seconds(F.col("first_start").cast("timestamp"))
    timed = window.withColumn("seconds", F.greatest(F.lit(1).cast("bigint"), seconds))
    return timed.withColumn("records_per_sec", F.floor(F.col("records") / F.col("seconds")))


def compare_runs(current: DataFrame, baseline: DataFrame, by: list[str], metric: str) -> DataFrame:
    """Percent change of a metric against its baseline, and whether that is good, ok or a warning.

    A cell without a baseline, or with a baseline of zero, gets no verdict.
    """
    base = baseline.select(*by, F.col(metric).alias("baseline"))
    joined = current.select(*by, F.col(metric).alias("current")).join(base, by, "left")
    percent = F.when(F.col("baseline") != 0, (F.col("current") - F.col("baseline")) / F.col("baseline") * 100)
    judged = joined.withColumn("percent", percent)
    verdict = (
        F.when(F.col("percent") >= GOOD_PERCENT, "good")
        .when(F.col("percent") >= OK_PERCENT, "ok")
        .when(F.col("percent").isNotNull(), "warn")
    )
    return judged.withColumn("verdict", verdict)


BATCHES = "query string, run string, batch bigint, started_at timestamp, ended_at timestamp, records bigint, landed bigint, dead bigint, bytes bigint, ok boolean"
OBSERVED = "tidegate_batch"


def observed(records: DataFrame, failed: Column, value: Column) -> DataFrame:
    """The same records; on their way to a sink Spark counts them, the failed ones, and their bytes."""
    return records.observe(
        OBSERVED,
        F.count(F.lit(1)).alias("records"),
        F.count_if(failed).alias("dead"),
        F.coalesce(F.sum(F.octet_length(value)), F.lit(0)).cast("bigint").alias("bytes"),
    )


class IngestMetrics(StreamingQueryListener):
    """Batches of streaming ingests as a table, from what Spark observed while it wrote them: nothing is read again.

    ``spark.streams.addListener(IngestMetrics(spark, path))``. One short row per micro-batch is added to ``path``; a query
    that ends by an exception adds a row that is not ok. What cannot be written yet waits for the next batch.
    """

    def __init__(self, spark: SparkSession, path: str):
        super().__init__()
        self.spark, self.path = spark, path
        self.waiting: list[tuple] = []
        self.written = Semaphore(0)

    def wait(self, batches: int, seconds: float = 60.0) -> None:
        """Until so many batches are written; progress reaches a listener some time after a batch has ended."""
        for _ in range(batches):
            if not self.written.acquire(timeout=seconds):
                raise TimeoutError("no further batch was reported")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(OBSERVED)
        if seen is None or not seen["records"]:
            return
        started = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
        ended = started + timedelta(milliseconds=progress.batchDuration)
        self._add((str(progress.id), str(progress.runId), progress.batchId, started, ended, seen["records"], seen["records"] - seen["dead"], seen["dead"], seen["bytes"], True))

    def onQueryTerminated(self, event) -> None:
        if event.exception is not None:
            now = datetime.now(timezone.utc)
            self._add((str(event.id), str(event.runId), None, now, now, 0, 0, 0, 0, False))

    def _add(self, row: tuple) -> None:
        self.waiting.append(row)
        self.spark.createDataFrame(self.waiting, BATCHES).coalesce(1).write.mode("append").parquet(self.path)
        self.waiting = []
        self.written.release()


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """What :class:`IngestMetrics` has written: a table of batches for :func:`throughput` and :func:`ingest_rate`."""
    return spark.read.schema(BATCHES).parquet(path)
