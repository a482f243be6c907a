"""Checks on ingested tables. Each returns a small DataFrame; none brings table rows to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import col

DELIVERIES = ("at_least_once", "exactly_once")


def check_count(table: DataFrame, produced: int, delivery: str = "exactly_once") -> DataFrame:
    """Row count against what was produced: equal under exactly-once, at least that under at-least-once."""
    if delivery not in DELIVERIES:
        raise ValueError(f"Unknown delivery '{delivery}', expected one of {', '.join(DELIVERIES)}")
    actual, expected = F.col("actual"), F.lit(produced).cast("bigint")
    ok = actual == expected if delivery == "exactly_once" else actual >= expected
    return table.agg(F.count(F.lit(1)).alias("actual")).select(expected.alias("produced"), "actual", ok.alias("ok"))


def check_distinct(table: DataFrame, column: str, produced: int) -> DataFrame:
    """Number of distinct keys against what was produced."""
    counted = table.agg(F.count_distinct(col(column)).alias("distinct_keys"))
    expected = F.lit(produced).cast("bigint")
    return counted.select(
        expected.alias("produced"), "distinct_keys", (F.col("distinct_keys") == expected).alias("ok")
    )


def checksum(table: DataFrame, column: str) -> DataFrame:
    """Order-insensitive checksum of an integer column. Three sums, so that swapped, repeated and lost ids all show."""
    value = col(column).cast("bigint")
    return table.agg(
        F.coalesce(F.bit_xor(F.xxhash64(value)), F.lit(0)).alias("hash_xor"),
        F.sum(value.cast("decimal(38,0)")).alias("total"),
        F.count(value).alias("records"),
    )


def check_checksum(table: DataFrame, column: str, n: int) -> DataFrame:
    """Compare the checksum of ``column`` with that of the series 1..n, in a single aggregate over both."""
    series = table.sparkSession.range(1, n + 1).select(F.lit(False).alias("_actual"), F.col("id").alias("_v"))
    both = table.select(F.lit(True).alias("_actual"), col(column).cast("bigint").alias("_v")).unionAll(series)
    sides = {}
    for name, is_actual in (("actual", F.col("_actual")), ("expected", ~F.col("_actual"))):
        value = F.when(is_actual, F.col("_v"))
        sides[name] = [
            F.coalesce(F.bit_xor(F.when(value.isNotNull(), F.xxhash64(value))), F.lit(0)).alias(f"{name}_hash"),
            F.sum(value.cast("decimal(38,0)")).alias(f"{name}_total"),
            F.count(value).alias(f"{name}_records"),
        ]
    summed = both.agg(*sides["actual"], *sides["expected"])
    same = [F.col(f"actual_{m}").eqNullSafe(F.col(f"expected_{m}")) for m in ("hash", "total", "records")]
    return summed.withColumn("ok", same[0] & same[1] & same[2])


def missing_ids(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Expected keys that the table lacks; empty when all landed.

    The actual side is reduced to distinct keys first: that combines map-side, so repeated rows of one key do not
    pile up in one join task, and its partitioning serves the join.
    """
    present = actual.select(col(key)).distinct()
    return expected.join(present, key, "left_anti")


def spot_check(table: DataFrame, n: int, id_column: str = "id", name_column: str = "name") -> DataFrame:
    """The first, middle and last of n sequential records: found, and named as they should be."""
    ids = sorted({1, max(1, n // 2), n})
    wanted = table.sparkSession.createDataFrame([(i,) for i in ids], "id bigint")
    found = table.where(col(id_column).isin(ids)).select(
        col(id_column).cast("bigint").alias("id"),
        col(name_column).startswith(F.concat(F.lit("record-"), col(id_column).cast("string"))).alias("named"),
    )
    found = found.groupBy("id").agg(F.bool_and("named").alias("named"))
    return wanted.join(found, "id", "left").select("id", F.coalesce("named", F.lit(False)).alias("ok"))


# --- exact sets of ids as bitmaps -------------------------------------------------------------------------------

BITS = 8 * 4096  # of one bitmap: what Spark's bitmap functions take


def id_bitmaps(table: DataFrame, column: str) -> DataFrame:
    """The set of an integer column's values: ``bucket``, ``bitmap`` (4 kB for 32,768 ids) and ``records``.

    Made per batch and kept, such sets answer for distinct, repeated and missing ids later without the ids: they combine
    map-side and merge by bucket. They are small where ids lie close together, as numbers of a sequence do.
    """
    value = col(column).cast("bigint")
    known = table.where(value.isNotNull())
    grouped = known.groupBy(F.bitmap_bucket_number(value).alias("bucket"))
    return grouped.agg(F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bitmap"), F.count(F.lit(1)).alias("records"))


def merge_bitmaps(*sets: DataFrame) -> DataFrame:
    """The union of sets; records add up, so that an id in two batches counts as repeated."""
    both = sets[0]
    for more in sets[1:]:
        both = both.unionByName(more)
    return both.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"), F.sum("records").alias("records"))


def bitmap_counts(ids: DataFrame) -> DataFrame:
    """``records``, ``distinct_ids`` and ``repeated`` (records beyond the first of their id) of a merged set."""
    distinct, records = F.sum(F.bitmap_count("bitmap")), F.sum("records")
    counted = ids.agg(F.coalesce(records, F.lit(0)).alias("records"), F.coalesce(distinct, F.lit(0)).alias("distinct_ids"))
    return counted.withColumn("repeated", F.col("records") - F.col("distinct_ids"))


def missing_from_bitmaps(expected: DataFrame, actual: DataFrame, name: str = "id") -> DataFrame:
    """Ids in one merged set that the other lacks. Only buckets whose union is larger than the second set are opened."""
    have = actual.select("bucket", F.col("bitmap").alias("_have"))
    pairs = expected.select("bucket", F.col("bitmap").alias("_want")).join(have, "bucket", "left")
    both = F.explode(F.filter(F.array("_want", "_have"), lambda b: b.isNotNull()))
    union = pairs.select("bucket", "_want", "_have", both.alias("_one")).groupBy("bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("_one")).alias("_all"), F.any_value("_want").alias("_want"), F.any_value("_have").alias("_have")
    )
    open_ = union.where(F.col("_have").isNull() | (F.col("_all") > F.bitmap_count("_have")))

    def bit(bitmap: str) -> str:
        return f"(shiftright(conv(hex(substring({bitmap}, p DIV 8 + 1, 1)), 16, 10)::int, p % 8) & 1) = 1"

    places = f"filter(sequence(0, {BITS - 1}), p -> {bit('_want')} AND (_have IS NULL OR NOT {bit('_have')}))"
    opened = open_.select("bucket", F.explode(F.expr(places)).alias("_place"))
    # Buckets from 1 on hold the ids from 1 upwards, those below hold the others downwards.
    ids = F.when(F.col("bucket") > 0, (F.col("bucket") - 1) * BITS + F.col("_place") + 1).otherwise(F.col("bucket") * BITS - F.col("_place"))
    return opened.select(ids.cast("bigint").alias(name))
