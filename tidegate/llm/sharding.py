"""Sharding by proportional stratified interleaving, under the law that row counts differ by at most one.

Rows are shuffled within their source by a seeded hash and ranked; rank over source size, shifted by a seeded phase per
source, is the fractional rank. Sorting all rows by it interleaves the sources in proportion at every scale, and cutting
that order into equal runs gives shards that all have the mixture of the whole. No ranking step holds a whole source
or the whole table: rows are dealt into ranges of the key, ranked within a range, and moved up by the ranges' counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage, text_of

SHARDS = 8
SEED = 42
#: Rows that one range of a ranking holds on average.
RANGE_ROWS = 4096
_BITS = 52


def _unit(*of: Column) -> Column:
    """A hash as a number in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*of), 64 - _BITS).cast("double") / F.lit(float(1 << _BITS))


def _rank(rows: DataFrame, by: list[str], key: str, ties: list[str], ranges: int) -> DataFrame:
    """``rank`` from 0 within ``by`` in the order of ``key`` (in [0, 1)), then ``ties``, and ``size`` of each ``by``."""
    rows = rows.withColumn("range", F.least(F.floor(F.col(key) * ranges), F.lit(ranges - 1)))
    counts = rows.groupBy(*by, "range").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy(*by).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*by, "range", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy(*by)).alias("size"))
    within = Window.partitionBy(*by, "range").orderBy(key, *ties)
    return rows.join(counts, [*by, "range"]).withColumn("rank", F.col("before") + F.row_number().over(within) - 1).drop("before", "range")


def shard(
    docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", range_rows: int = RANGE_ROWS
) -> DataFrame:
    """One row per input row: id, ``size`` (UTF-8 bytes and one), ``text_crc32``, ``law`` (``rows``), ``shard``, ``slot`` (gapless from 0 in its
    shard), ``grown_shard`` (null: this law moves rows when a shard is added).

    A null text has no bytes; null sources are a stratum of their own; null ids shuffle like any other value; repeated
    rows take neighbouring slots. Fewer rows than shards leave the last shards empty; an empty table gives no rows.
    """
    text = text_of(text_col)
    rows = stage(
        docs.select(
            F.col(id_col).alias("id"),
            F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("null")).alias("stratum"),
            (F.octet_length(text) + 1).cast("long").alias("size_bytes"),
            F.crc32(text.cast("binary")).alias("crc"),
        ).withColumn("key", _unit(F.lit(seed), "id", "crc", "size_bytes")),
        "shard-rows",
    )
    total = rows.count()
    ranges = max(1, -(-total // range_rows))
    ranked = _rank(rows, ["stratum"], "key", ["id", "crc", "size_bytes"], ranges)
    phase = _unit(F.lit(seed), "stratum")
    mixed = stage(
        ranked.select("id", "stratum", "size_bytes", "crc", "key", F.least((F.col("rank") + phase) / F.col("size"), F.lit(1 - 2.0**-53)).alias("fraction"), F.lit(0).alias("all")),
        "shard-fractions",
    )
    place = _rank(mixed, ["all"], "fraction", ["stratum", "key", "id", "crc", "size_bytes"], ranges)
    number = F.floor(F.col("rank") * shards / F.lit(max(total, 1))) if total * shards < 2**53 else F.expr(f"cast(rank as decimal(20,0)) * {shards} div {total}")
    first = F.ceil(F.col("shard") * F.lit(total) / shards)
    return place.withColumn("shard", number.cast("int")).select(
        F.col("id").alias(id_col),
        F.col("size_bytes").alias("size"),
        F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        (F.col("rank") - first).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
