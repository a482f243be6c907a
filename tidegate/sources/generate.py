"""Repeatable generated records for throughput and delivery tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The sequence record rule.
EPOCH_SECONDS = 1704067200  # 2024-01-01T00:00:00Z
NAME_PREFIX = "record-"
VALUE_STEP = 1.1


def sequence_fields(seq: Column, pad: int = 0) -> list[Column]:
    """id, name, value and timestamp of the record with this sequence number; the name is padded, never cut."""
    base = F.concat(F.lit(NAME_PREFIX), seq.cast("string"))
    padding = F.repeat(F.lit("x"), F.greatest(F.lit(0), F.lit(pad) - F.length(base)))
    return [
        seq.cast("bigint").alias("id"),
        F.concat(base, padding).alias("name"),
        (seq * F.lit(VALUE_STEP)).alias("value"),
        F.timestamp_seconds(seq + EPOCH_SECONDS).alias("timestamp"),
    ]


def sequence_log(spark: SparkSession, n: int, pad: int = 0, partitions: int | None = None) -> DataFrame:
    """Records 1..n by rule, so that any subset can be checked without keeping what was produced."""
    return spark.range(1, n + 1, 1, partitions).select(*sequence_fields(F.col("id"), pad))


def _pick(seed: int, field: int, modulus: int, *ids: Column) -> Column:
    return F.pmod(F.xxhash64(*ids, F.lit(seed), F.lit(field)), F.lit(modulus))


def _digits(seed: int, field: int, count: int, record: Column) -> Column:
    """``count`` decimal digits, 9 from each hash."""
    blocks = [F.lpad(_pick(seed, field + i, 10**9, record).cast("string"), 9, "0") for i in range(-(-count // 9))]
    return F.substring(F.concat(*blocks), 1, count)


def random_fields(record: Column, seed: int = 0, text_bytes: int = 100) -> list[Column]:
    """Eight columns of varied values. Each is a hash of record id and seed, so that runs and retries repeat."""
    letters = F.transform(
        F.sequence(F.lit(1), F.lit(text_bytes)),
        lambda i: F.element_at(F.array(*[F.lit(c) for c in _LETTERS]), (_pick(seed, 100, 52, record, i) + 1).cast("int")),
    )
    lead = (_pick(seed, 1, 9, record) + 1).cast("string")
    return [
        record.cast("int").alias("colInteger"),
        (_pick(seed, 2, 9000, record) + 1000).alias("colBigint"),
        F.concat(lead, _digits(seed, 10, 28, record), F.lit("."), _digits(seed, 20, 9, record))
        .cast("decimal(38,9)")
        .alias("colNumeric"),
        ((_pick(seed, 3, 90, record) + 10) / 10).cast("float").alias("colReal"),
        (_pick(seed, 4, 9, record) + 1 + _pick(seed, 5, 10**8, record) / F.lit(1e8)).alias("colDoublePrecision"),
        F.lit(True).alias("colBoolean"),
        (F.array_join(letters, "") if text_bytes else F.lit("")).alias("colText"),
        F.timestamp_seconds(_pick(seed, 6, 86400, record) + EPOCH_SECONDS).alias("colTimestamp"),
    ]


def random_log(spark: SparkSession, n: int, seed: int = 0, text_bytes: int = 100) -> DataFrame:
    """Records 0..n-1 of :func:`random_fields`."""
    return spark.range(n).select(*random_fields(F.col("id"), seed, text_bytes))


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
