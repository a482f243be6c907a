"""CSV files replayed as topic logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.names import col
from .envelope import to_envelope


def number_rows(df: DataFrame, name: str = "_seq") -> DataFrame:
    """Consecutive numbers from 0 in the current row order.

    Rows are counted per partition, and each row's place in its partition is added to where that partition starts;
    no row is sorted. The running sum is over one row per input split, which is all that its single task sees.
    """
    placed = df.withColumn("_at", F.monotonically_increasing_id())
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    starts = starts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(starts, "_part").withColumn(name, F.col("_start") + place).drop("_at", "_part", "_start")


def number_file_rows(df: DataFrame, name: str = "_seq") -> DataFrame:
    """Consecutive numbers from 0 in the order of the files' names and, in a file, of its rows.

    A split of a file is read in order, by one task; its rows are placed after the rows of all splits before it. The
    running sum is over one row per split, which is all that its single task sees.
    """
    placed = df.withColumns({"_at": F.monotonically_increasing_id(), "_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start")})
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    starts = starts.select("_file", "_block", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    numbered = placed.join(starts, ["_file", "_block"]).withColumn(name, F.col("_start") + F.col("_at") - F.col("_first"))
    return numbered.drop("_at", "_file", "_block", "_first", "_start")


def read_csv(spark: SparkSession, path: str, null_token: str = "", multi_line: bool = False) -> DataFrame:
    """A CSV file with a header, all columns text; ``null_token`` cells and missing trailing cells are NULL.

    With ``multi_line`` quoted cells may hold line breaks; a file is then read by one task.
    """
    return (
        spark.read.option("header", True)
        .option("nullValue", null_token)
        .option("emptyValue", "" if null_token else None)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", bool(null_token))
        .option("ignoreTrailingWhiteSpace", bool(null_token))
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def csv_to_topic_log(spark: SparkSession, path: str, topic: str, batch_size: int = 100, multi_line: bool = False) -> DataFrame:
    """Each CSV row as one JSON record, empty cells null, numbered in file order and cut into equal batches."""
    rows = read_csv(spark, path, multi_line=multi_line)
    numbered = number_file_rows(rows)
    payload = F.to_json(F.struct(*[col(c) for c in rows.columns]), {"ignoreNullFields": "false"})
    log = to_envelope(numbered.withColumn("_value", payload), F.lit(topic), F.lit(0), F.col("_seq"), F.col("_value"))
    return log.withColumn("batch_no", F.floor(F.col("offset") / batch_size))


def replay_rows(rows: DataFrame, seq: str, row_count: int, n: int) -> DataFrame:
    """``n`` records that repeat ``rows`` (numbered 0..row_count-1 by ``seq``) from the start whenever they run out."""
    if row_count == 0:
        return rows.limit(0).withColumn("message", F.lit(0).cast("bigint"))
    messages = rows.sparkSession.range(n).select(F.col("id").alias("message"), (F.col("id") % row_count).alias(seq))
    return messages.join(rows, seq)


def replay_csv(spark: SparkSession, path: str, topic: str, n: int, multi_line: bool = False) -> DataFrame:
    """A CSV file repeated until there are ``n`` records; ``NULL`` cells are null, cells are trimmed."""
    rows = read_csv(spark, path, "NULL", multi_line)
    numbered = number_file_rows(rows)
    payload = F.to_json(F.struct(*[col(c) for c in rows.columns]), {"ignoreNullFields": "false"})
    repeated = replay_rows(numbered.select("_seq", payload.alias("_value")), "_seq", rows.count(), n)
    return to_envelope(repeated, F.lit(topic), F.lit(0), F.col("message"), F.col("_value"))


def replay_csv_stream(spark: SparkSession, path: str, topic: str, rows_per_batch: int, work: str, multi_line: bool = False) -> DataFrame:
    """A CSV file as an endless stream, from the start again whenever it runs out: ``rows_per_batch`` records a trigger.

    Spark's rate source numbers the records, so the checkpoint knows where to go on, and a batch that runs again is the
    same; the rows, numbered once into the folder ``work``, are joined by number. Cells are read as by :func:`replay_csv`.
    """
    rows = read_csv(spark, path, "NULL", multi_line)
    payload = F.to_json(F.struct(*[col(c) for c in rows.columns]), {"ignoreNullFields": "false"})
    number_file_rows(rows).select("_seq", payload.alias("_value")).write.mode("overwrite").parquet(work)
    numbered = spark.read.schema("_seq bigint, _value string").parquet(work)
    count = numbered.count()
    paced = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch).load()
    paced = paced.where("false") if count == 0 else paced
    numbers = paced.select(F.col("value").alias("_number"), F.col("timestamp").alias("_at"), (F.col("value") % max(count, 1)).alias("_seq"))
    return to_envelope(numbers.join(numbered, "_seq"), F.lit(topic), F.lit(0), F.col("_number"), F.col("_value"), F.col("_at"))
