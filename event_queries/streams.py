"""Streaming sinks and state, metrics of a run, id sets as bitmaps, mixed records, catalogs, and replayed CSV."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from event_queries.common import as_log, bigint, event_fields, event_log, micros, scratch, table
from tidegate import (
    IngestConfig,
    IngestMetrics,
    PostProcess,
    TableSpec,
    TableStore,
    append,
    bitmap_counts,
    discover,
    id_bitmaps,
    ingest_batch,
    ingest_rate,
    merge_bitmaps,
    missing_from_bitmaps,
    missing_tables,
    plan_mixed,
    plan_rows,
    read_high_water,
    read_metrics,
    replay_csv,
    replay_csv_stream,
    split_valid,
    start_high_water,
    start_ingest,
    stream_topic_log,
    throughput,
)
from tidegate.operators.decode import ERROR, SRC
from tidegate.sources.generate import random_fields

TYPES = ("click", "view", "purchase", "signup", "error")
CLICKS = TableSpec.from_ddl("clicks", "event_id BIGINT NOT NULL, user_id BIGINT, value DOUBLE")


def streamed_high_water(spark: SparkSession, sf: str) -> DataFrame:
    """The mark as streaming state: two runs of one checkpoint, the second over a log that has grown by new partitions and late offsets."""
    root = scratch(spark)
    log = event_log(spark, sf)
    early = (F.col("timestamp") < "2024-01-15") & (F.col("partition") < 3)
    for part in (early, ~early):
        log.where(part).write.mode("append").parquet(f"{root}/log")
        start_high_water(stream_topic_log(spark, f"{root}/log"), f"{root}/ledger", f"{root}/checkpoint", available_now=True).awaitTermination()
    return read_high_water(spark, f"{root}/ledger").withColumn("topic_partition", bigint("topic_partition"))


def _config(**kwargs) -> IngestConfig:
    return IngestConfig({"clicks": CLICKS}, mapping={t: "clicks" for t in TYPES}, **{"delivery": "exactly_once", "tolerance": "all", **kwargs})


def _streamed(spark: SparkSession, sf: str, root: str, config: IngestConfig) -> TableStore:
    """The events in two micro-batches, every tenth of them no record at all: a half comes with the log, one after the restart.

    A half is as many files as the events are read in, and a batch takes all that is new.
    """
    payload = F.to_json(F.struct("event_id", "user_id", "event_type"))
    log = as_log(table(spark, sf, "events"), payload).withColumn("value", F.when(F.col("offset") % 10 > 0, F.col("value")).otherwise(F.lit("none").cast("binary")))
    for part in ("offset % 2 = 0", "offset % 2 = 1"):
        log.where(part).write.mode("append").parquet(f"{root}/log")
        start_ingest(stream_topic_log(spark, f"{root}/log"), config, f"{root}/store", f"{root}/checkpoint", available_now=True).awaitTermination()
    return TableStore(spark, f"{root}/store")


def _metrics(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch(spark)
    listener = IngestMetrics(spark, f"{root}/metrics")
    spark.streams.addListener(listener)
    try:
        _streamed(spark, sf, root, _config())
        # The bus hands on progress in its own time; a query has ended once its last event is through.
        listener.wait(2)
    finally:
        spark.streams.removeListener(listener)
    return read_metrics(spark, f"{root}/metrics")


def observed_throughput(spark: SparkSession, sf: str) -> DataFrame:
    """Records and bytes of a streamed ingest as Spark observed them, and rates that must follow from them."""
    batches = _metrics(spark, sf)
    rates = throughput(batches, ["query"])
    window = ingest_rate(batches, ["query"]).select("query", F.col("records").alias("ok_records"), (F.col("records_per_sec") <= F.col("records")).alias("rated"))
    sums = batches.groupBy("query").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("landed").alias("landed"), F.sum("dead").alias("dead"), F.sum("bytes").alias("bytes"),
        F.sum(F.unix_micros("ended_at") - F.unix_micros("started_at")).alias("took"),
    )
    joined = rates.join(window, "query").join(sums, "query")
    expected = F.floor(F.col("bytes") / (1048576 * F.col("took") / 1e6) * 10 + 0.5) / 10
    return joined.select("batches", "records", "ok_records", "landed", "dead", "bytes", "rated", (F.col("mib_per_sec") == expected).alias("mib_agrees"))


def throughput_bytes(spark: SparkSession, sf: str) -> DataFrame:
    """Throughput of batches that carry their own sizes."""
    events = table(spark, sf, "events")
    batches = events.groupBy("event_type", F.date_trunc("hour", "ts").alias("hour")).agg(
        F.min("ts").alias("started_at"),
        F.max("ts").alias("ended_at"),
        F.count(F.lit(1)).alias("records"),
        (F.sum(F.octet_length("props").cast("bigint")) * 100_000_000).alias("bytes"),
    )
    return throughput(batches, ["event_type"])


def lost_driver_stream(spark: SparkSession, sf: str) -> DataFrame:
    """A streamed ingest whose checkpoint is lost, with other records in between: everything is there once, by two runs' sinks."""
    root = scratch(spark)
    _streamed(spark, sf, root, _config())
    stream = stream_topic_log(spark, f"{root}/log")
    start_ingest(stream, _config(), f"{root}/store", f"{root}/checkpoint-2", available_now=True).awaitTermination()
    store = TableStore(spark, f"{root}/store")
    landed = store.read_with_source(CLICKS).select(F.lit("landed").alias("outcome"), F.col("_topic").alias("topic"), "event_id")
    return landed.unionAll(store.read_dead_letters("clicks").select("reason", "topic", "offset"))


def changed_mapping(spark: SparkSession, sf: str) -> DataFrame:
    """One checkpoint, two runs: the second also takes views, to a table of their own, and sends clicks on to the old one."""
    root = scratch(spark)
    log = event_log(spark, sf)
    views = TableSpec.from_ddl("page_views", "event_id BIGINT, user_id BIGINT")
    configs = (
        IngestConfig({"clicks": CLICKS}, mapping="click:clicks", delivery="exactly_once"),
        IngestConfig({"clicks": CLICKS, "page_views": views}, mapping="click:clicks, view:page_views", delivery="exactly_once"),
    )
    for config, part in zip(configs, ("day(timestamp) < 15", "day(timestamp) >= 15")):
        log.where(part).write.mode("append").parquet(f"{root}/log")
        start_ingest(stream_topic_log(spark, f"{root}/log"), config, f"{root}/store", f"{root}/checkpoint", available_now=True).awaitTermination()
    store = TableStore(spark, f"{root}/store")
    return store.read(CLICKS).select(F.lit("clicks").alias("table"), "event_id").unionAll(store.read(views).select(F.lit("page_views"), "event_id"))


def script_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Scripts named by a JSON setting, one as text: the first mapping of a table counts, and other parameters stay as they are."""
    setting = {
        "mappings": [
            {"table": "clicks", "script": "SELECT event_id, '${batch_id}' AS batch, '${other}' AS kept FROM batch", "target": "seen"},
            {"table": "clicks", "script": "SELECT -1 AS event_id, 'second' AS batch, '' AS kept FROM batch", "target": "seen"},
            {"table": "unused", "script": "SELECT 1", "target": "seen"},
        ]
    }
    seen = TableSpec.from_ddl("seen", "event_id BIGINT, batch TEXT, kept TEXT")
    config = _config(targets={"seen": seen}, post_process=PostProcess.from_json(json.dumps(setting)))
    store = TableStore(spark, scratch(spark))
    log = event_log(spark, sf)
    for epoch, part in (("one", "partition < 2"), ("two", "partition >= 2")):
        ingest_batch(log.where(part), epoch, config, store)
    return store.read(seen)


def missing_by_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    """The ids that two batches of landed events lack, from the batches' id sets, ids below zero among them."""
    ids = table(spark, sf, "events").select((F.col("event_id") - 1000).alias("id"))
    batches = [id_bitmaps(ids.where(f"pmod(id, 3) > 0 and id % 2 = {k}"), "id") for k in (0, 1)]
    batches.append(id_bitmaps(ids.where("pmod(id, 3) > 0 and id % 2 = -1"), "id"))
    return missing_from_bitmaps(merge_bitmaps(id_bitmaps(ids, "id")), merge_bitmaps(*batches))


def distinct_by_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct and repeated ids of two batches, the second of which holds a third of the first again."""
    events = table(spark, sf, "events")
    counted = []
    for key in ("event_id", "user_id"):
        sets = [id_bitmaps(events, key), id_bitmaps(events.where("event_id % 3 = 0"), key)]
        counted.append(bitmap_counts(merge_bitmaps(*sets)).select(F.lit(key).alias("key"), "records", "distinct_ids", "repeated"))
    return counted[0].unionAll(counted[1])


def mixed_records(spark: SparkSession, sf: str) -> DataFrame:
    """Typed records of two schemas, schemaless ones, an unknown schema, and values that are no objects, in one batch."""
    kind = F.col("event_id") % 6
    first = F.struct("event_id", F.col("ts").cast("timestamp").alias("TS"), F.col("value").cast("decimal(12,2)").alias("value"))
    second = F.struct(F.col("event_id"), F.to_date("ts").alias("ts"), F.col("user_id").cast("string").alias("value"))
    value = (
        F.when(kind.isin(0, 5), F.to_variant_object(first))
        .when(kind == 1, F.to_variant_object(second))
        .when(kind == 2, F.parse_json(F.to_json(F.struct(*event_fields()))))
        .when(kind == 3, F.parse_json(F.lit("[1]")))
    )
    tag = F.when(kind == 0, "v1").when(kind == 1, "v2").when(kind == 5, "lost")
    log = as_log(table(spark, sf, "events"), F.lit("")).drop("value")
    mixed = table(spark, sf, "events").select("event_id", value.alias("value"), tag.alias("schema_tag"))
    path = scratch(spark)
    log.join(mixed, F.col("offset") == F.col("event_id")).drop("event_id").write.parquet(path)
    schemas = {
        "v1": T.StructType.fromDDL("event_id bigint, TS timestamp, value decimal(12,2)"),
        "v2": T.StructType.fromDDL("event_id bigint, ts date, value string"),
    }
    spec = TableSpec.from_ddl("t", "event_id BIGINT NOT NULL, ts TIMESTAMP, value NUMERIC(12,2)")
    rows = plan_mixed(spark.read.parquet(path), spec, schemas)
    return rows.select(
        F.col(f"{SRC}.offset").alias("id"), "event_id", micros("ts").alias("ts"), F.col("value").cast("string").alias("value"),
        F.col(f"{ERROR}.reason").alias("reason"),
    )


def typed_into_json(spark: SparkSession, sf: str) -> DataFrame:
    """Typed dates, times, bytes and nested values into JSON columns, under both profiles."""
    events = table(spark, sf, "events")
    nested = F.struct(F.to_date("ts").alias("day"), F.array(F.col("ts").cast("timestamp")).alias("times"), F.col("event_type").cast("binary").alias("raw"))
    record = F.struct(
        "event_id", F.to_date("ts").alias("day"), F.col("ts").cast("timestamp").alias("at"), F.col("ts").cast("timestamp_ntz").alias("local"),
        F.col("event_type").cast("binary").alias("raw"), F.when(F.col("event_id") % 2 == 0, nested).alias("nested"),
    )
    log = as_log(events, F.lit("")).drop("value").join(events.select("event_id", record.alias("value")), F.col("offset") == F.col("event_id")).drop("event_id")
    spec = TableSpec.from_ddl("t", "event_id BIGINT, day JSON, at JSON, local JSON, raw JSON, nested JSON")
    out = [plan_rows(log, spec, p).select(F.lit(p).alias("profile"), F.col(f"{ERROR}.reason").alias("reason"), *spec.names) for p in ("sql", "binary")]
    return out[0].unionAll(out[1])


def typed_under_sql(spark: SparkSession, sf: str) -> DataFrame:
    """Typed records in the stricter profile: numbers and times only where their type is that of the column."""
    events = table(spark, sf, "events")
    record = F.struct(
        F.col("event_id").alias("EVENT_ID"), F.col("user_id").cast("int").alias("user_id"), F.when(F.col("event_id") % 3 == 0, F.col("event_id")).alias("small"),
        F.col("value").cast("decimal(12,2)").alias("amount"), F.col("ts").cast("timestamp").alias("seen"), F.col("event_type").alias("kind"),
        F.when(F.col("event_id") % 2 == 0, F.col("ts").cast("timestamp")).alias("zoned"),
    )
    log = as_log(events, F.lit("")).drop("value").join(events.select("event_id", record.alias("value")), F.col("offset") == F.col("event_id")).drop("event_id")
    spec = TableSpec.from_ddl("t", "event_id BIGINT, user_id BIGINT, small INTEGER, amount NUMERIC(12,1), seen TIMESTAMP, kind TEXT, zoned TIMESTAMPTZ")
    rows = plan_rows(log, spec, "sql")
    return rows.select(
        "event_id", "user_id", F.col("amount").cast("string").alias("amount"), micros("seen").alias("seen"), "kind",
        F.col(f"{ERROR}.column").alias("failed"), F.col(f"{ERROR}.reason").alias("reason"),
    )


def absent_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Which of the tables that the event types would go to the catalog lacks: views of the others are made first."""
    wanted = [r[0] for r in table(spark, sf, "events").select("event_type").distinct().orderBy("event_type").collect()]
    made = [name for name in wanted if len(name) % 2 == 1]
    for name in made:
        table(spark, sf, "events").where(F.col("event_type") == name).createOrReplaceTempView(name)
    try:
        return spark.createDataFrame([(n,) for n in missing_tables(spark, [*wanted, *wanted])], "name string")
    finally:
        for name in made:
            spark.catalog.dropTempView(name)


def random_records(spark: SparkSession, sf: str) -> DataFrame:
    """The generated record of every event's number, twice: the same number and seed give the same record, in its documented ranges."""
    ids = table(spark, sf, "events").select(F.col("event_id").alias("id"))
    once, again = (ids.repartition(n).select("id", *random_fields(F.col("id"), 7, 20)) for n in (2, 5))
    same = once.join(again.select(F.col("id").alias("other"), F.xxhash64(*[c for c in again.columns if c != "id"]).alias("digest")), F.col("id") == F.col("other"))
    return same.select(
        F.col("colInteger").cast("bigint").alias("id"),
        (F.xxhash64(*[c for c in once.columns if c != "id"]) == F.col("digest")).alias("repeats"),
        F.col("colBigint").between(1000, 9999).alias("in_range"),
        bigint(F.length("colText")).alias("letters"),
        F.length(F.col("colNumeric").cast("string")).alias("digits").cast("bigint"),
        F.col("colBoolean").alias("flag"),
    )


def quoted_names(spark: SparkSession, sf: str) -> DataFrame:
    """Columns whose names need quoting, from record to catalog table and back."""
    path = scratch(spark)
    name = f"quoted_{path[-32:]}"
    spark.sql(f"CREATE TABLE {name} (`event id` BIGINT, `select` STRING, `a.b` DOUBLE, `tick``ed` BIGINT) USING parquet LOCATION '{path}'")
    try:
        spec = discover(spark, [name])[name]
        payload = F.to_json(F.struct(F.col("event_id").alias("event id"), F.col("event_type").alias("SELECT"), F.col("value").alias("a.b"), F.col("user_id").alias("tick`ed")))
        valid, _ = split_valid(plan_rows(as_log(table(spark, sf, "events"), payload), spec), spec)
        append(valid, f"default.`{name}`", spec)
        return spark.read.parquet(path)
    finally:
        spark.sql(f"DROP TABLE {name}")


def catalog_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """A table created with DEFAULTs: what the catalog declares is used where a batch has no value at all for a column."""
    path = scratch(spark)
    name = f"defaults_{path[-32:]}"
    spark.sql(
        f"CREATE TABLE {name} (event_id BIGINT, origin STRING DEFAULT 'log', grade STRING DEFAULT concat('no', 'ne'), "
        f"purchase DOUBLE DEFAULT 0) USING parquet LOCATION '{path}'"
    )
    try:
        spec = discover(spark, [name])[name]
    finally:
        spark.sql(f"DROP TABLE {name}")
    origin = F.when(F.col("event_id") % 3 == 0, F.lit("app")).alias("origin")
    purchase = F.when(F.col("event_type") == "purchase", F.col("value")).alias("purchase")
    store = TableStore(spark, scratch(spark))
    log = event_log(spark, sf, origin, purchase)
    config = IngestConfig({name: spec}, mapping={t: name for t in TYPES})
    ingest_batch(log.where("topic <> 'purchase'"), "without", config, store)
    ingest_batch(log.where("topic in ('purchase', 'error')"), "with", config, store)
    return store.read(spec)


def _customer_csv(spark: SparkSession, sf: str) -> str:
    """Customers as real CSV: some cells NULL, the last cell left off some rows, spaces around others."""
    path = f"{scratch(spark)}/customers"
    rows = table(spark, sf, "customer")
    segment = F.when(F.col("c_custkey") % 4 == 0, "NULL").otherwise(F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")))
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), segment, F.when(F.col("c_custkey") % 5 > 0, F.col("c_nationkey").cast("string")))
    head = spark.createDataFrame([(-1, "c_custkey,c_mktsegment,c_nationkey")], "at bigint, line string")
    lines = head.unionAll(rows.select("c_custkey", line))
    lines.repartition(1).sortWithinPartitions("at").select("line").write.text(path)
    return path


def replayed_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Two rounds and a bit of a CSV file as records, back in typed columns."""
    path = _customer_csv(spark, sf)
    n = 2 * table(spark, sf, "customer").count() + 5
    return _customers(replay_csv(spark, path, "customers", n))


def streamed_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The same file as a paced stream through the ingest: one batch a trigger, on from its checkpoint, round and round."""
    path = _customer_csv(spark, sf)
    root = scratch(spark)
    per_batch = table(spark, sf, "customer").count() * 2 // 3 + 1
    spec = _CUSTOMERS
    config = IngestConfig({"customers": spec}, delivery="exactly_once")
    for _ in range(3):
        start_ingest(replay_csv_stream(spark, path, "customers", per_batch, f"{root}/rows"), config, f"{root}/store", f"{root}/checkpoint", available_now=True).awaitTermination()
    rows = TableStore(spark, f"{root}/store").read_with_source(spec)
    return rows.select(F.col("_offset").alias("message"), "c_custkey", "c_mktsegment", bigint("c_nationkey").alias("c_nationkey"))


_CUSTOMERS = TableSpec.from_ddl("customers", "c_custkey BIGINT NOT NULL, c_mktsegment TEXT, c_nationkey INTEGER")


def _customers(log: DataFrame) -> DataFrame:
    rows = plan_rows(log, _CUSTOMERS)
    return rows.where(F.col(ERROR).isNull()).select(F.col(f"{SRC}.offset").alias("message"), "c_custkey", "c_mktsegment", bigint("c_nationkey").alias("c_nationkey"))


QUERIES = {
    "streamed_high_water": streamed_high_water,
    "observed_throughput": observed_throughput,
    "throughput_bytes": throughput_bytes,
    "lost_checkpoint_stream": lost_driver_stream,
    "changed_mapping": changed_mapping,
    "script_lookup": script_lookup,
    "missing_by_bitmap": missing_by_bitmap,
    "distinct_by_bitmap": distinct_by_bitmap,
    "mixed_records": mixed_records,
    "typed_into_json": typed_into_json,
    "typed_under_sql": typed_under_sql,
    "missing_tables": absent_tables,
    "random_log": random_records,
    "quoted_names": quoted_names,
    "catalog_defaults": catalog_defaults,
    "replay_csv": replayed_csv,
    "replay_csv_stream": streamed_csv,
}

_LAST = "case when event_id % 10 > 0 then 'landed' else 'no_converter' end"
_CSV = """select m as message, c_custkey, case when c_custkey % 4 > 0 then c_mktsegment end as c_mktsegment,
    case when c_custkey % 5 > 0 then cast(c_nationkey as bigint) end as c_nationkey
    from (select unnest(range({n})) as m, count(*) as n from customer) join
        (select *, row_number() over (order by c_custkey) - 1 as seq from customer) on seq = m % n"""
_JSON = """select '{p}' as profile, cast(null as varchar) as reason, event_id,
    cast((epoch_us(cast(cast(ts as date) as timestamp)) // 1000) as varchar) as "day", cast((epoch_us(ts) // 1000) as varchar) as "at",
    cast((epoch_us(ts) // 1000) as varchar) as "local", '"' || base64(encode(event_type)) || '"' as raw,
    case when event_id % 2 = 0 then '{{"day":' || (epoch_us(cast(cast(ts as date) as timestamp)) // 1000) || ',"times":[' || (epoch_us(ts) // 1000) || '],"raw":"'
        || base64(encode(event_type)) || '"}}' end as nested from events"""

ORACLES = {
    "streamed_high_water": """select event_type as topic, user_id % 4 as topic_partition, max(event_id) as partition_offset
        from events group by 1, 2""",
    "observed_throughput": """select cast(2 as bigint) as batches, count(*) as records, count(*) as ok_records,
        count(*) filter (where event_id % 10 > 0) as landed, count(*) filter (where event_id % 10 = 0) as dead,
        cast(sum(case when event_id % 10 = 0 then 4 else length('{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}') end) as bigint) as bytes,
        true as rated, true as mib_agrees from events""",
    "throughput_bytes": """select event_type, records, floor(seconds * 10 + 0.5) / 10 as duration_seconds,
        case when seconds > 0 then cast(floor(records / seconds) as bigint) else 0 end as records_per_sec,
        case when seconds > 0 then floor(b / (1048576 * seconds) * 10 + 0.5) / 10 else 0.0 end as mib_per_sec
        from (select event_type, cast(sum(n) as bigint) as records, sum(epoch_us(e) - epoch_us(s)) / 1e6 as seconds, cast(sum(b) as double) as b
            from (select event_type, date_trunc('hour', ts) as h, min(ts) as s, max(ts) as e, count(*) as n, sum(octet_length(encode(props))) * 100000000 as b
                from events group by 1, 2) group by 1)""",
    "lost_checkpoint_stream": f"select {_LAST} as outcome, event_type as topic, event_id from events",
    "changed_mapping": """select 'clicks' as "table", event_id from events where event_type = 'click'
        union all select 'page_views', event_id from events where event_type = 'view' and day(ts) >= 15""",
    "script_lookup": """select event_id, case when user_id % 4 < 2 then 'one' else 'two' end as batch, '${other}' as kept from events""",
    "missing_by_bitmap": "select event_id - 1000 as id from events where (event_id - 1000) % 3 = 0",
    "distinct_by_bitmap": """select 'event_id' as key, count(*) + count(*) filter (where event_id % 3 = 0) as records, count(distinct event_id) as distinct_ids,
            count(*) + count(*) filter (where event_id % 3 = 0) - count(distinct event_id) as repeated from events
        union all select 'user_id', count(*) + count(*) filter (where event_id % 3 = 0), count(distinct user_id),
            count(*) + count(*) filter (where event_id % 3 = 0) - count(distinct user_id) from events""",
    "mixed_records": """select event_id as id, case when event_id % 6 < 3 then event_id end as event_id,
        case event_id % 6 when 0 then epoch_us(ts) when 1 then epoch_us(cast(cast(ts as date) as timestamp)) when 2 then epoch_us(ts) end as ts,
        case event_id % 6 when 1 then cast(cast(user_id as decimal(12,2)) as varchar) when 0 then cast(cast(value as decimal(12,2)) as varchar)
            when 2 then cast(cast(value as decimal(12,2)) as varchar) end as value,
        case when event_id % 6 > 2 then 'no_converter' end as reason from events""",
    "typed_into_json": _JSON.format(p="sql") + " union all " + _JSON.format(p="binary"),
    "typed_under_sql": """select event_id, user_id, cast(round(cast(value as decimal(12,2)), 1) as varchar) as amount, epoch_us(ts) as seen, event_type as kind,
        case when event_id % 3 = 0 then 'small' when event_id % 2 = 0 then 'zoned' end as failed,
        case when event_id % 3 = 0 or event_id % 2 = 0 then 'incompatible_type' end as reason from events""",
    "missing_tables": "select distinct event_type as name from events where length(event_type) % 2 = 0",
    "random_log": """select event_id as id, true as repeats, true as in_range, 20::bigint as letters, 39::bigint as digits, true as flag from events""",
    "quoted_names": 'select event_id as "event id", event_type as "select", value as "a.b", user_id as "tick`ed" from events',
    "catalog_defaults": """select event_id, case when event_id % 3 = 0 then 'app' end as origin, 'none' as grade,
            cast(0 as double) as purchase from events where event_type <> 'purchase'
        union all select event_id, case when event_id % 3 = 0 then 'app' end, 'none',
            case when event_type = 'purchase' then value end from events where event_type in ('purchase', 'error')""",
    "replay_csv": _CSV.format(n="2 * count(*) + 5"),
    "replay_csv_stream": _CSV.format(n="3 * (count(*) * 2 // 3 + 1)"),
}
