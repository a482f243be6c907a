"""Verification of landed tables, ingest metrics, and generated or replayed logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from event_queries.common import bigint, event_log, micros, scratch, table
from tidegate import (
    TableSpec,
    check_checksum,
    check_count,
    check_distinct,
    compare_runs,
    csv_to_topic_log,
    ingest_rate,
    missing_ids,
    plan_rows,
    split_valid,
    spot_check,
    throughput,
)
from tidegate.sources.generate import sequence_fields
from tidegate.sources.replay import replay_rows

CLICKS = TableSpec.from_ddl("clicks", "event_id BIGINT NOT NULL, user_id BIGINT")


def _landed(spark: SparkSession, sf: str) -> DataFrame:
    valid, _ = split_valid(plan_rows(event_log(spark, sf), CLICKS), CLICKS)
    return valid


def _landed_once(spark: SparkSession, sf: str) -> DataFrame:
    """The landed rows as a table, so that several checks read two narrow columns and do not parse again."""
    path = scratch(spark)
    _landed(spark, sf).select("event_id", "user_id").write.parquet(path)
    return spark.read.parquet(path)


def missing_event_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Two thirds of the events landed, and those twice; which ids are missing?"""
    landed = _landed(spark, sf).where("event_id % 3 > 0")
    return missing_ids(table(spark, sf, "events").select("event_id"), landed.unionAll(landed), "event_id")


def count_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Every click landed once, and the view events twice: which deliveries does that satisfy?"""
    landed = _landed_once(spark, sf)
    views = landed.where("user_id % 2 = 0")
    produced = table(spark, sf, "events").count()
    cases = [("once", landed), ("repeated", landed.unionAll(views)), ("lost", views)]
    out = None
    for name, rows in cases:
        for delivery in ("exactly_once", "at_least_once"):
            one = check_count(rows, produced, delivery).select(
                F.lit(name).alias("landing"), F.lit(delivery).alias("delivery"), "produced", "actual", "ok"
            )
            out = one if out is None else out.unionAll(one)
    return out


def checksum_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Ids compared with the full series: as landed, with one id replaced by another, and with one lost."""
    ids = _landed_once(spark, sf).select((F.col("event_id") + 1).alias("id"))
    n = table(spark, sf, "events").count()
    swapped = ids.select(F.when(F.col("id") == 7, F.lit(8).cast("bigint")).otherwise(F.col("id")).alias("id"))
    cases = [("complete", ids), ("swapped", swapped), ("lost", ids.where("id <> 7"))]
    out = None
    for name, rows in cases:
        one = check_checksum(rows, "id", n).select(
            F.lit(name).alias("landing"),
            bigint("actual_total").alias("total"),
            bigint("expected_total").alias("expected_total"),
            F.col("actual_records").alias("records"),
            "ok",
        )
        out = one if out is None else out.unionAll(one)
    return out


def distinct_checks(spark: SparkSession, sf: str) -> DataFrame:
    landed = _landed_once(spark, sf)
    produced = table(spark, sf, "events").count()
    twice = check_distinct(landed.unionAll(landed), "event_id", produced).withColumn("key", F.lit("event_id"))
    return twice.unionByName(check_distinct(landed, "user_id", produced).withColumn("key", F.lit("user_id")))


def _batches(spark: SparkSession, sf: str) -> DataFrame:
    """The events of each type and hour as one ingested batch; hours that saw a high value count as failed."""
    events = table(spark, sf, "events")
    return events.groupBy("event_type", F.date_trunc("hour", "ts").alias("hour")).agg(
        F.min("ts").alias("started_at"),
        F.max("ts").alias("ended_at"),
        F.count(F.lit(1)).alias("records"),
        F.sum(F.octet_length("props").cast("bigint")).alias("bytes"),
        (F.max("value") < 100).alias("ok"),
    )


def throughput_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return throughput(_batches(spark, sf), ["event_type"], record_bytes=1_000_000_000)


def ingest_rate_by_type(spark: SparkSession, sf: str) -> DataFrame:
    rates = ingest_rate(_batches(spark, sf), ["event_type"])
    return rates.withColumns({"first_start": micros("first_start"), "last_end": micros("last_end")})


def compare_months(spark: SparkSession, sf: str) -> DataFrame:
    """Events per user in the second half of the month against the first half as baseline."""
    events = table(spark, sf, "events")
    per_user = [
        events.where(half).groupBy("user_id").agg(F.count(F.lit(1)).alias("records"))
        for half in ("day(ts) >= 16", "day(ts) < 16 and user_id % 10 > 0")
    ]
    judged = compare_runs(*per_user, by=["user_id"], metric="records")
    return judged.withColumn("percent", F.round(F.col("percent"), 6))


def sequence_records(spark: SparkSession, sf: str) -> DataFrame:
    """The generated record for every event's position in the sequence."""
    rows = table(spark, sf, "events").select(*sequence_fields(F.col("event_id") + 1, 12))
    return rows.withColumn("timestamp", micros("timestamp"))


def spot_checks(spark: SparkSession, sf: str) -> DataFrame:
    """First, middle and last record of the generated sequence: all there, and with the middle one misnamed."""
    events = table(spark, sf, "events")
    rows = events.select(*sequence_fields(F.col("event_id") + 1, 12))
    n = events.count()
    renamed = rows.withColumn("name", F.when(F.col("id") == n // 2, F.lit("other")).otherwise(F.col("name")))
    good, bad = (spot_check(r, n).select(F.lit(name).alias("landing"), "id", "ok") for name, r in (("good", rows), ("bad", renamed)))
    return good.unionAll(bad)


def replayed_customers(spark: SparkSession, sf: str) -> DataFrame:
    """The customer table replayed from the start whenever it runs out, for three and a bit rounds."""
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("seq"), "c_name")
    count = rows.count()
    return replay_rows(rows, "seq", count, 3 * count + 7).select("message", "c_name")


def csv_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers through CSV files to JSON records and back to typed columns; empty cells arrive as nulls."""
    path = scratch(spark)
    customers = table(spark, sf, "customer")
    blanked = customers.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 4 > 0, F.col("c_mktsegment")))
    blanked.write.option("header", True).csv(path)
    log = csv_to_topic_log(spark, path, "customers", batch_size=100)
    spec = TableSpec.from_ddl(
        "customers", "c_custkey BIGINT NOT NULL, c_name TEXT, c_nationkey INTEGER, c_acctbal DOUBLE, c_mktsegment TEXT"
    )
    valid, _ = split_valid(plan_rows(log, spec), spec)
    return valid.withColumn("c_nationkey", bigint("c_nationkey"))


def csv_batches(spark: SparkSession, sf: str) -> DataFrame:
    """CSV records are numbered without gaps and cut into equal batches."""
    path = scratch(spark)
    table(spark, sf, "customer").write.option("header", True).csv(path)
    log = csv_to_topic_log(spark, path, "customers", batch_size=100)
    return log.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("records"), F.min("offset").alias("first"), F.max("offset").alias("last")
    )


_BATCHES = """(select event_type, date_trunc('hour', ts) as h, min(ts) as s, max(ts) as e, count(*) as n,
    max(value) < 100 as ok from events group by 1, 2)"""

QUERIES = {
    "missing_ids": missing_event_ids,
    "check_counts": count_checks,
    "check_checksum": checksum_checks,
    "check_distinct": distinct_checks,
    "throughput": throughput_by_type,
    "ingest_rate": ingest_rate_by_type,
    "compare_runs": compare_months,
    "sequence_log": sequence_records,
    "spot_check": spot_checks,
    "csv_replay": replayed_customers,
    "csv_to_topic_log": csv_customers,
    "csv_batches": csv_batches,
}

ORACLES = {
    "missing_ids": "select event_id from events where event_id % 3 = 0",
    "check_counts": """with n as (select count(*) as p, count(*) filter (where user_id % 2 = 0) as v from events),
        l as (select 'once' as landing, p, p as a from n union all select 'repeated', p, p + v from n
              union all select 'lost', p, v from n)
        select landing, 'exactly_once' as delivery, p as produced, a as actual, p = a as ok from l
        union all select landing, 'at_least_once', p, a, a >= p from l""",
    "check_checksum": """with s as (select count(*) as n from events),
        x as (select 'complete' as landing, event_id + 1 as id from events
              union all select 'swapped', case when event_id + 1 = 7 then 8 else event_id + 1 end from events
              union all select 'lost', event_id + 1 from events where event_id + 1 <> 7)
        select landing, cast(sum(id) as bigint) as total,
            (select cast(sum(i) as bigint) from generate_series(1, (select n from s)) g(i)) as expected_total,
            count(*) as records,
            bit_xor(hash(id)) = (select bit_xor(hash(i)) from generate_series(1, (select n from s)) g(i))
                and count(*) = (select n from s) as ok
        from x group by 1""",
    "check_distinct": """select 'event_id' as key, count(*) as produced, count(distinct event_id) as distinct_keys,
        count(*) = count(distinct event_id) as ok from events
        union all select 'user_id', count(*), count(distinct user_id), count(*) = count(distinct user_id) from events""",
    "throughput": f"""select event_type, records, floor(seconds * 10 + 0.5) / 10 as duration_seconds,
        case when seconds > 0 then cast(floor(records / seconds) as bigint) else 0 end as records_per_sec,
        case when seconds > 0 then floor(b / (1048576 * seconds) * 10 + 0.5) / 10 else 0.0 end as mib_per_sec
        from (select event_type, cast(sum(n) as bigint) as records, sum(epoch_us(e) - epoch_us(s)) / 1e6 as seconds,
            cast(sum(n) * 1000000000 as double) as b from {_BATCHES} group by 1)""",
    "ingest_rate": f"""select event_type, f as first_start, l as last_end, records, secs as seconds,
        records // secs as records_per_sec
        from (select event_type, min(epoch_us(s)) as f, max(epoch_us(e)) as l, cast(sum(n) as bigint) as records,
            greatest(1, max(epoch_us(e)) // 1000000 - min(epoch_us(s)) // 1000000) as secs
            from {_BATCHES} where ok group by 1)""",
    "compare_runs": """select user_id, c as "current", b as baseline, round(pct, 6) as percent,
        case when pct >= 5 then 'good' when pct >= -5 then 'ok' when pct is not null then 'warn' end as verdict
        from (select c.user_id, c.n as c, b.n as b, (c.n - b.n) / b.n * 100 as pct
            from (select user_id, count(*) as n from events where day(ts) >= 16 group by 1) c
            left join (select user_id, count(*) as n from events where day(ts) < 16 and user_id % 10 > 0 group by 1) b
            on c.user_id = b.user_id)""",
    "sequence_log": """select id, rpad('record-' || id, cast(greatest(12, length('record-' || id)) as integer), 'x') as name,
        id * cast(1.1 as double) as value, (id + 1704067200) * 1000000 as "timestamp"
        from (select event_id + 1 as id from events)""",
    "spot_check": """with n as (select count(*) as n from events),
        i as (select 1 as id from n union select n // 2 from n union select n from n)
        select 'good' as landing, id, true as ok from i
        union all select 'bad', id, id <> (select n // 2 from n) from i""",
    "csv_replay": """select m as message, c_name from (select unnest(range(3 * count(*) + 7)) as m, count(*) as n
        from customer) join customer on c_custkey = m % n""",
    "csv_to_topic_log": """select c_custkey, c_name, c_nationkey::bigint as c_nationkey, c_acctbal,
        case when c_custkey % 4 > 0 then c_mktsegment end as c_mktsegment from customer""",
    "csv_batches": """select cast(floor((c_custkey) / 100) as bigint) as batch_no, count(*) as records,
        min(c_custkey) as "first", max(c_custkey) as "last" from customer group by 1""",
}
