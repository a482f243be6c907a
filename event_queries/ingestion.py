"""Routing, decoding, column resolution, offsets, dead letters and the full ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from event_queries.common import (
    as_log,
    bigint,
    event_fields,
    event_log,
    micros,
    scratch,
    table,
)
from tidegate import (
    IngestConfig,
    PostProcess,
    Script,
    TableSpec,
    TableStore,
    advance_offsets,
    append,
    decode_json,
    discover,
    drop_processed,
    fill_defaults,
    filter_topics,
    high_water,
    ingest_batch,
    latest_per_key,
    observed_columns,
    parse_mapping,
    plan_rows,
    prune_null_columns,
    quarantine_oversize,
    register_partitions,
    route,
    sanitize_names,
    skipped,
    split_by_table,
    split_valid,
    start_ingest,
    stream_topic_log,
    to_envelope,
    unknown_attributes,
    upsert,
    write_dead_letters,
    write_parquet_batch,
)
from tidegate.functions.names import sanitized
from tidegate.operators.decode import ERROR, SRC

MAPPING = "click: clicks, view: page_views"
TYPES = ("click", "view", "purchase", "signup", "error")
EVENTS = TableSpec.from_ddl(
    "events", "event_id BIGINT NOT NULL, ts TIMESTAMP, user_id BIGINT, event_type TEXT, value DOUBLE PRECISION"
)
ROUTED = "case event_type when 'click' then 'clicks' when 'view' then 'page_views' else event_type end"


def route_topics(spark: SparkSession, sf: str) -> DataFrame:
    routed = route(event_log(spark, sf), parse_mapping(MAPPING))
    return routed.groupBy("topic", "table").agg(F.count(F.lit(1)).alias("records"))


def split_tables(spark: SparkSession, sf: str) -> DataFrame:
    branches = split_by_table(event_log(spark, sf), parse_mapping(MAPPING), ["clicks", "error"])
    counted = [d.select(F.lit(t).alias("table"), "offset") for t, d in branches.items()]
    both = counted[0].unionAll(counted[1])
    return both.groupBy("table").agg(F.count(F.lit(1)).alias("records"), F.sum("offset").alias("offsets"))


def skipped_topics(spark: SparkSession, sf: str) -> DataFrame:
    return skipped(event_log(spark, sf), parse_mapping(MAPPING), ["clicks", "error"])


def subscribed_topics(spark: SparkSession, sf: str) -> DataFrame:
    kept = filter_topics(event_log(spark, sf), ["click", "signup"])
    return kept.groupBy("topic", bigint("partition").alias("partition")).agg(F.count(F.lit(1)).alias("records"))


def decode_schemaless(spark: SparkSession, sf: str) -> DataFrame:
    log = as_log(table(spark, sf, "events"), F.col("props"))
    rows = plan_rows(log, TableSpec.from_ddl("props", "k BIGINT NOT NULL"))
    return rows.select(F.col(f"{SRC}.offset").alias("event_id"), "k")


def decode_tombstones(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    log = as_log(events, F.when(F.col("event_id") % 17 != 0, F.col("props")))
    rows = plan_rows(log, TableSpec.from_ddl("props", "k BIGINT"))
    outcome = F.coalesce(F.col(f"{ERROR}.reason"), F.lit("landed")).alias("outcome")
    return rows.groupBy(outcome).agg(F.count(F.lit(1)).alias("records"))


def decode_typed_records(spark: SparkSession, sf: str) -> DataFrame:
    """Typed records: the value is a struct whose field types differ from the declared ones."""
    events = table(spark, sf, "events")
    typed = events.select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(None).cast("binary").alias("key"),
        F.struct(
            F.col("event_id").alias("EVENT_ID"),
            F.col("user_id").cast("int").alias("user_id"),
            F.col("value").cast("decimal(12,2)").alias("amount"),
            F.col("ts").alias("seen"),
            F.struct(F.col("user_id"), F.col("event_type")).alias("who"),
        ).alias("value"),
    )
    spec = TableSpec.from_ddl(
        "typed", "event_id BIGINT, user_id REAL, amount NUMERIC(12,1), seen TIMESTAMP, who JSON, absent TEXT"
    )
    rows = plan_rows(typed, spec, "binary")
    return rows.select(
        "event_id",
        F.col("user_id").cast("double").alias("user_id"),
        F.col("amount").cast("string").alias("amount"),
        micros("seen").alias("seen"),
        F.get_json_object("who", "$.event_type").alias("who_type"),
        "absent",
    )


def resolve_columns_ci(spark: SparkSession, sf: str) -> DataFrame:
    upper = F.struct(*[c.alias(n.upper()) for c, n in zip(event_fields(), EVENTS.names)], F.lit("x").alias("Extra"))
    rows = plan_rows(as_log(table(spark, sf, "events"), F.to_json(upper)), EVENTS)
    valid, _ = split_valid(rows, EVENTS)
    return valid.withColumn("ts", micros("ts"))


def mixed_spelling(spark: SparkSession, sf: str) -> DataFrame:
    """Attribute spelling that changes from record to record, and records that spell one column twice."""
    events = table(spark, sf, "events")
    kind = F.col("event_id") % 3
    payload = (
        F.when(kind == 0, F.to_json(F.struct("user_id", "value")))
        .when(kind == 1, F.to_json(F.struct(F.col("user_id").alias("User_Id"), F.col("value").alias("VALUE"))))
        .otherwise(F.to_json(F.struct(F.col("user_id"), F.col("user_id").alias("USER_ID"))))
    )
    spec = TableSpec.from_ddl("t", "user_id BIGINT, value DOUBLE")
    rows = plan_rows(as_log(events, payload), spec)
    return rows.select(
        F.col(f"{SRC}.offset").alias("event_id"),
        F.col(f"{ERROR}.reason").alias("reason"),
        F.when(F.col(ERROR).isNull(), F.col("user_id")).alias("user_id"),
        F.when(F.col(ERROR).isNull(), F.col("value")).alias("value"),
    )


def observed_attributes(spark: SparkSession, sf: str) -> DataFrame:
    extra = F.when(F.col("event_id") % 2 == 0, F.lit(1)).alias("extra")
    return observed_columns(decode_json(event_log(spark, sf, extra), EVENTS))


def unknown_attribute_report(spark: SparkSession, sf: str) -> DataFrame:
    extras = [F.when(F.col("event_id") % n == 0, F.lit(1)).alias(f"extra{n}") for n in (2, 5)]
    return unknown_attributes(decode_json(event_log(spark, sf, *extras), EVENTS), EVENTS)


def cast_fields_by_topic(spark: SparkSession, sf: str) -> DataFrame:
    casts = {"purchase": {"value": "int64"}, "cl.*": {"user_id": "string", "value": "int8"}}
    spec = TableSpec.from_ddl("t", "event_id BIGINT, user_id TEXT, value DOUBLE")
    rows = plan_rows(event_log(spark, sf), spec, casts=casts)
    return rows.select(
        F.col(f"{SRC}.offset").alias("event_id"), "user_id", "value", F.col(f"{ERROR}.column").alias("failed")
    )


def prune_null(spark: SparkSession, sf: str) -> DataFrame:
    spec = TableSpec.from_ddl("t", "event_id BIGINT, value DOUBLE, purchase_value DOUBLE, missing TEXT, empty TEXT")
    purchase = F.when(F.col("event_type") == "purchase", F.col("value")).alias("purchase_value")
    log = event_log(spark, sf, purchase, F.lit(None).cast("string").alias("empty"))
    used = prune_null_columns(plan_rows(log, spec), spec)
    return spark.createDataFrame([(i, c) for i, c in enumerate(used)], "position bigint, column string")


def replay_filter(spark: SparkSession, sf: str) -> DataFrame:
    """The ledger stands at the first half of every partition but one, which it has never seen."""
    log = event_log(spark, sf)
    ledger = high_water(log.where((F.col("offset") % 2 == 0) & (F.col("timestamp") < "2024-01-15") & (F.col("partition") < 3)))
    kept = drop_processed(log, ledger)
    return kept.groupBy("topic", bigint("partition").alias("partition")).agg(
        F.count(F.lit(1)).alias("records"), F.min("offset").alias("first_offset"), F.sum("offset").alias("offsets")
    )


def high_water_marks(spark: SparkSession, sf: str) -> DataFrame:
    return high_water(event_log(spark, sf)).withColumn("topic_partition", bigint("topic_partition"))


def advance_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """A late batch of low offsets moves nothing back; unseen partitions join at -1."""
    log = event_log(spark, sf)
    ledger = high_water(log.where(F.col("topic") != "view"))
    late = log.where((F.col("timestamp") < "2024-01-10") & (F.col("topic") != "signup"))
    wanted = log.select("topic", F.col("partition").alias("topic_partition")).unionByName(
        log.select(F.concat("topic", F.lit("-new")).alias("topic"), F.col("partition").alias("topic_partition"))
    )
    after = register_partitions(advance_offsets(late, ledger), wanted)
    return after.withColumn("topic_partition", bigint("topic_partition"))


def dead_letter_reasons(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    kind = F.col("event_id") % 8
    payload = (
        F.when(kind == 0, F.lit("not json"))
        .when(kind == 1, F.lit("[1]"))
        .when(kind == 2, F.lit('{"event_id":"x"}'))
        .when(kind == 3, F.lit('{"user_id":1}'))
        .when(kind == 4, F.to_json(F.struct(F.col("event_id"), F.lit("2024-1-5").alias("ts"))))
        .when(kind == 5, F.to_json(F.struct(F.col("event_id"), F.lit(True).alias("user_id"))))
        .when(kind == 6, F.to_json(F.struct(F.col("event_id"), F.col("event_id").alias("EVENT_ID"))))
        .otherwise(F.to_json(F.struct(*event_fields())))
    )
    _, dead = split_valid(plan_rows(as_log(events, payload), EVENTS), EVENTS)
    return dead.groupBy("table", "column", "reason").agg(
        F.count(F.lit(1)).alias("records"), F.sum("offset").alias("offsets")
    )


def dead_letters_written(spark: SparkSession, sf: str) -> DataFrame:
    """Dead letters written out and read back keep the whole original record."""
    log = as_log(table(spark, sf, "events"), F.when(F.col("event_id") % 3 == 0, F.col("props")).otherwise(F.col("event_type")))
    spec = TableSpec.from_ddl("props", "k BIGINT")
    _, dead = split_valid(plan_rows(log, spec), spec)
    path = scratch(spark)
    write_dead_letters(dead, path)
    back = spark.read.parquet(path)
    return back.select("topic", "offset", F.col("value").cast("string").alias("value"), "reason", "table")


def oversize_split(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    log = to_envelope(docs, F.col("source"), F.lit(0), F.col("doc_id"), F.col("text"))
    fits, too_large = quarantine_oversize(log, 4096)
    both = fits.withColumn("reason", F.lit(None).cast("string")).unionByName(too_large)
    return both.groupBy("reason").agg(
        F.count(F.lit(1)).alias("records"), F.sum(F.octet_length("value").cast("bigint")).alias("bytes")
    )


def latest_per_user(spark: SparkSession, sf: str) -> DataFrame:
    latest = latest_per_key(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"])
    return latest.select("user_id", "event_id", micros("ts").alias("ts"), "event_type", "value")


def upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Users as of mid-month, merged with the newest event of each user in the second half: two columns change."""
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    first, second = events.where("day(ts) < 15 and user_id % 3 > 0"), events.where("day(ts) >= 15 and user_id % 5 > 0")
    order = ["ts", "event_id"]
    target = latest_per_key(first, ["user_id"], order).drop("ts")
    source = latest_per_key(second, ["user_id"], order).drop("ts")
    return upsert(target, source, ["user_id"], ["event_id", "value"])


def post_process_script(spark: SparkSession, sf: str) -> DataFrame:
    """Ingest in two batches; after each a script writes a derived row per landed record, tagged by its batch."""
    staging = TableSpec.from_ddl("staging", "event_id BIGINT, event_type TEXT, batch_id TEXT")
    target = TableSpec.from_ddl("processed", "processed TEXT, batch_id TEXT")
    script = Script(
        "staging",
        sql="SELECT concat(event_id::string, upper(event_type)) AS processed, batch_id FROM staging "
        "WHERE batch_id = '${batch_id}'",
        target="processed",
    )
    mapping = {t: "staging" for t in TYPES}
    config = IngestConfig(
        {"staging": staging}, {"processed": target}, mapping, post_process=PostProcess((script,)), tolerance="all"
    )
    store = TableStore(spark, scratch(spark))
    log = event_log(spark, sf)
    ingest_batch(log.where("partition < 2"), "first", config, store)
    ingest_batch(log.where("partition >= 2"), "second", config, store)
    return store.read(target)


def merge_script(spark: SparkSession, sf: str) -> DataFrame:
    """Keep-latest and merge after each of two batches, into a keyed table."""
    staging = TableSpec.from_ddl(
        "staging", "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type TEXT, value DOUBLE, batch_id TEXT"
    )
    target = TableSpec.from_ddl("users", "user_id BIGINT, event_id BIGINT, event_type TEXT, value DOUBLE")
    script = Script(
        "staging",
        run=lambda batch, _: latest_per_key(batch, ["user_id"], ["ts", "event_id"]),
        target="users",
        keys=("user_id",),
        update=("event_id", "value"),
    )
    mapping = {t: "staging" for t in TYPES}
    config = IngestConfig({"staging": staging}, {"users": target}, mapping, post_process=PostProcess((script,)))
    store = TableStore(spark, scratch(spark))
    log = event_log(spark, sf)
    ingest_batch(log.where("timestamp < '2024-01-15'"), "first", config, store)
    ingest_batch(log.where("timestamp >= '2024-01-15'"), "second", config, store)
    return store.read(target)


def scripts_share_target(spark: SparkSession, sf: str) -> DataFrame:
    """Two tables whose scripts append to one target and merge into one other, in one batch: nothing is overwritten."""
    columns = "event_id BIGINT, user_id BIGINT, value DOUBLE"
    tables = {name: TableSpec.from_ddl(name, columns) for name in ("odd", "even")}
    log_of = TableSpec.from_ddl("seen", "event_id BIGINT, origin TEXT")
    newest = TableSpec.from_ddl("newest", "user_id BIGINT, event_id BIGINT")
    seen = PostProcess(tuple(Script(t, sql=f"SELECT event_id, '{t}' AS origin FROM batch", target="seen") for t in tables))
    # narrower keys than the target's: they are hashed as the target's type
    merged = PostProcess(tuple(Script(t, sql="SELECT cast(user_id AS int) AS user_id, max(event_id) AS event_id FROM batch GROUP BY 1", target="newest", keys=("user_id",)) for t in tables))
    log = event_log(spark, sf)
    log = log.withColumn("topic", F.when(F.col("offset") % 2 == 0, "even").otherwise("odd"))
    store = TableStore(spark, scratch(spark))
    for epoch, scripts in (("append", seen), ("merge", merged)):
        ingest_batch(log, epoch, IngestConfig(tables, {"seen": log_of, "newest": newest}, post_process=scripts), store)
    # a store opened anew goes on with the newest version
    again = IngestConfig({"odd": tables["odd"]}, {"newest": newest}, post_process=PostProcess(merged.scripts[:1]))
    ingest_batch(log, "again", again, TableStore(spark, store.root))
    store = TableStore(spark, store.root)
    rows = store.read(log_of).select("origin", "event_id", F.lit(None).cast("bigint").alias("user_id"))
    return rows.unionByName(store.read(newest).select(F.lit("newest").alias("origin"), "event_id", "user_id"))


def rolled_back_batch(spark: SparkSession, sf: str) -> DataFrame:
    """A failing script keeps its whole batch out; under tolerance all its records become dead letters."""
    spec = TableSpec.from_ddl("click", "event_id BIGINT, batch_id TEXT")
    failing = PostProcess((Script("click", sql="SELECT no_such_column FROM batch"),))
    store = TableStore(spark, scratch(spark))
    log, mapping = event_log(spark, sf), {t: "click" for t in TYPES}
    good = IngestConfig({"click": spec}, mapping=mapping, tolerance="all")
    ingest_batch(log.where("partition = 0"), "good", good, store)
    bad = IngestConfig({"click": spec}, mapping=mapping, tolerance="all", post_process=failing)
    ingest_batch(log.where("partition > 0"), "bad", bad, store)
    landed = store.read(spec).select(F.lit("landed").alias("outcome"), "event_id")
    dead = store.read_dead_letters("click").select(F.col("reason").alias("outcome"), F.col("offset").alias("event_id"))
    return landed.unionAll(dead)


def _stream(spark: SparkSession, sf: str, delivery: str) -> DataFrame:
    """Stream the events, lose the checkpoint, and stream them again into the same table."""
    root = scratch(spark)
    event_log(spark, sf).write.parquet(f"{root}/log")
    spec = TableSpec.from_ddl("clicks", "event_id BIGINT NOT NULL, user_id BIGINT, value DOUBLE")
    config = IngestConfig({"clicks": spec}, mapping={t: "clicks" for t in TYPES}, delivery=delivery)
    for attempt in ("first", "second"):
        log = stream_topic_log(spark, f"{root}/log")
        query = start_ingest(log, config, f"{root}/store", f"{root}/checkpoint-{attempt}", available_now=True)
        query.awaitTermination()
    return TableStore(spark, f"{root}/store").read(spec)


def exactly_once_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _stream(spark, sf, "exactly_once")


def at_least_once_stream(spark: SparkSession, sf: str) -> DataFrame:
    landed = _stream(spark, sf, "at_least_once")
    per_id = landed.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(F.count(F.lit(1)).alias("ids"), F.min("n").alias("fewest"), F.sum("n").alias("records"))


def ingest_events(spark: SparkSession, sf: str) -> DataFrame:
    """End to end: envelope, routing, decoding, coercion, quarantine, exactly-once append, and reading back."""
    store = TableStore(spark, scratch(spark))
    mapping = {t: "events" for t in TYPES}
    config = IngestConfig({"events": EVENTS}, mapping=mapping, delivery="exactly_once", tolerance="all")
    log = event_log(spark, sf)
    ingest_batch(log, "epoch-0", config, store)
    ingest_batch(log, "epoch-1", config, store)  # a replay: the ledger drops every record
    return store.read(EVENTS).withColumn("ts", micros("ts"))


def ingest_three_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Several topics in one batch, each to a table of its own; topics without a table are left alone."""
    store = TableStore(spark, scratch(spark))
    tables = {
        "clicks": TableSpec.from_ddl("clicks", "event_id BIGINT NOT NULL, user_id INTEGER"),
        "page_views": TableSpec.from_ddl("page_views", "event_id BIGINT NOT NULL, user_id TEXT"),
        "error": TableSpec.from_ddl("error", "event_id BIGINT NOT NULL, user_id BOOLEAN"),
    }
    config = IngestConfig(tables, mapping=MAPPING, profile="binary", delivery="exactly_once", tolerance="all")
    ingest_batch(event_log(spark, sf), "epoch", config, store)
    out = None
    for name, spec in tables.items():
        landed = store.read(spec).select(
            F.lit(name).alias("table"), F.lit("landed").alias("outcome"), "event_id", F.col("user_id").cast("string")
        )
        dead = store.read_dead_letters(name).select(
            "table", F.col("reason").alias("outcome"), F.col("offset").alias("event_id"), F.lit(None).cast("string")
        )
        out = landed.unionAll(dead) if out is None else out.unionAll(landed).unionAll(dead)
    return out


def column_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """A required column takes its default per record, a nullable one only where the whole batch lacks it."""
    spec = TableSpec.from_ddl(
        "t",
        "event_id BIGINT, origin TEXT NOT NULL DEFAULT 'log', grade TEXT DEFAULT 'none', purchase DOUBLE DEFAULT 0",
    )
    origin = F.when(F.col("event_id") % 3 == 0, F.lit("app")).alias("origin")
    purchase = F.when(F.col("event_type") == "purchase", F.col("value")).alias("purchase")
    rows = fill_defaults(plan_rows(event_log(spark, sf, origin, purchase), spec), spec)
    valid, _ = split_valid(rows, spec)
    return valid


def append_to_catalog_table(spark: SparkSession, sf: str) -> DataFrame:
    """Discover an existing table, append a batch that leaves a column out, and read it back."""
    path = scratch(spark)
    name = f"append_{path[-32:]}"
    spark.sql(f"CREATE TABLE {name} (event_id BIGINT, event_type STRING, value DOUBLE, note STRING) USING parquet LOCATION '{path}'")
    try:
        spec = discover(spark, [name])[name]
        valid, _ = split_valid(plan_rows(event_log(spark, sf), spec), spec)
        written = append(valid, name, spec)
        return spark.read.schema(spec.schema).parquet(path).withColumn("written", F.lit(",".join(written)))
    finally:
        spark.sql(f"DROP TABLE {name}")


def parquet_batch(spark: SparkSession, sf: str) -> DataFrame:
    """The columnar sink: full schema with arrays, written and read back."""
    events = table(spark, sf, "events")
    spec = TableSpec.from_ddl("t", "event_id BIGINT, pair BIGINT[], note TEXT")
    log = as_log(events, F.to_json(F.struct("event_id", F.array("user_id", "event_id").alias("pair"))))
    valid, _ = split_valid(plan_rows(log, spec, "binary"), spec)
    path = scratch(spark)
    write_parquet_batch(valid, path)
    back = spark.read.parquet(path)
    return back.select("event_id", F.col("pair")[0].alias("first"), F.col("pair")[1].alias("second"), "note")


def sanitized_part_names(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    raw = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.col("p_size").cast("string"), F.lit("-"), "p_name")).otherwise(
        F.when(F.col("p_partkey") % 3 == 1, F.col("p_brand")).otherwise(F.lit("#-.#"))
    )
    return part.select("p_partkey", sanitized(raw).alias("name"))


def sanitized_columns(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select(
        F.col("p_partkey").alias("part key"), F.col("p_name").alias("1st.name"), F.col("p_size").cast("bigint").alias("größe")
    )
    return sanitize_names(part)


_LOG = """(select event_type as topic, user_id % 4 as p, event_id as o, * from events)"""
_HALF = """(select topic, p, max(o) as last from {log} l where o % 2 = 0 and ts < timestamp '2024-01-15' and p < 3 group by 1, 2)"""
_LATEST = """(select * exclude (rn) from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) rn from events where {where}) where rn = 1)"""
_EVENT_ROWS = "select event_id, epoch_us(ts) as ts, user_id, event_type, value from events"

QUERIES = {
    "route_topics": route_topics,
    "split_tables": split_tables,
    "skipped_topics": skipped_topics,
    "subscribed_topics": subscribed_topics,
    "decode_schemaless": decode_schemaless,
    "decode_tombstones": decode_tombstones,
    "decode_typed_records": decode_typed_records,
    "resolve_columns_ci": resolve_columns_ci,
    "mixed_spelling": mixed_spelling,
    "observed_columns": observed_attributes,
    "unknown_attributes": unknown_attribute_report,
    "cast_fields": cast_fields_by_topic,
    "prune_null_columns": prune_null,
    "drop_processed": replay_filter,
    "high_water": high_water_marks,
    "advance_offsets": advance_ledger,
    "dead_letter_reasons": dead_letter_reasons,
    "write_dead_letters": dead_letters_written,
    "oversize_split": oversize_split,
    "latest_per_key": latest_per_user,
    "upsert_latest": upsert_latest,
    "post_process_script": post_process_script,
    "merge_script": merge_script,
    "rolled_back_batch": rolled_back_batch,
    "scripts_share_target": scripts_share_target,
    "exactly_once_stream": exactly_once_stream,
    "at_least_once_stream": at_least_once_stream,
    "ingest_events": ingest_events,
    "ingest_three_tables": ingest_three_tables,
    "column_defaults": column_defaults,
    "append_to_catalog_table": append_to_catalog_table,
    "parquet_batch": parquet_batch,
    "sanitize_names": sanitized_part_names,
    "sanitize_columns": sanitized_columns,
}

ORACLES = {
    "route_topics": f'select event_type as topic, {ROUTED} as "table", count(*) as records from events group by 1, 2',
    "split_tables": f"""select {ROUTED} as "table", count(*) as records, cast(sum(event_id) as bigint) as offsets
        from events where event_type in ('click', 'error') group by 1""",
    "skipped_topics": f"""select event_type as topic, {ROUTED} as "table", count(*) as records from events
        where event_type not in ('click', 'error') group by 1, 2""",
    "subscribed_topics": """select event_type as topic, user_id % 4 as "partition", count(*) as records from events
        where event_type in ('click', 'signup') group by 1, 2""",
    "decode_schemaless": "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events",
    "decode_tombstones": """select case when event_id % 17 = 0 then 'no_converter' else 'landed' end as outcome,
        count(*) as records from events group by 1""",
    "decode_typed_records": """select event_id, cast(user_id as double) as user_id,
        cast(round(cast(value as decimal(12,2)), 1) as varchar) as amount, epoch_us(ts) as seen,
        event_type as who_type, cast(null as varchar) as absent from events""",
    "resolve_columns_ci": _EVENT_ROWS,
    "mixed_spelling": """select event_id, case when event_id % 3 = 2 then 'ambiguous_column' end as reason,
        case when event_id % 3 < 2 then user_id end as user_id, case when event_id % 3 < 2 then value end as value
        from events""",
    "observed_columns": """select unnest(['event_id', 'ts', 'user_id', 'event_type', 'value']) as attribute,
        count(*) as records from events
        union all select 'extra', count(*) from events where event_id % 2 = 0""",
    "unknown_attributes": """select 'extra2' as attribute, count(*) as records from events where event_id % 2 = 0
        union all select 'extra5', count(*) from events where event_id % 5 = 0""",
    "cast_fields": """select event_id, cast(user_id as varchar) as user_id,
        case when event_type = 'purchase' then cast(trunc(value) as double)
             when event_type = 'click' then case when trunc(value) < 128 then cast(trunc(value) as double) end
             else value end as value,
        case when event_type = 'click' and trunc(value) >= 128 then 'value' end as failed from events""",
    "prune_null_columns": """select row_number() over (order by pos) - 1 as position, name as "column" from (
        select 0 as pos, 'event_id' as name, count(event_id) as n from events
        union all select 1, 'value', count(value) from events
        union all select 2, 'purchase_value', count(value) from events where event_type = 'purchase'
        union all select 3, 'missing', 0 union all select 4, 'empty', 0) where n > 0""",
    "drop_processed": f"""select l.topic, l.p as "partition", count(*) as records, min(l.o) as first_offset,
        cast(sum(l.o) as bigint) as offsets
        from {_LOG} l left join {_HALF.format(log=_LOG)} h on l.topic = h.topic and l.p = h.p
        where h.last is null or l.o > h.last group by 1, 2""",
    "high_water": """select event_type as topic, user_id % 4 as topic_partition, max(event_id) as partition_offset
        from events group by 1, 2""",
    "advance_offsets": """with l as (select event_type as topic, user_id % 4 as p, event_id as o, ts from events),
        a as (select topic, p, max(o) as last from l where topic <> 'view' or ts < timestamp '2024-01-10' group by 1, 2),
        w as (select distinct topic, p from l union select distinct topic || '-new', p from l)
        select w.topic, w.p as topic_partition, coalesce(a.last, -1) as partition_offset
        from w left join a on w.topic = a.topic and w.p = a.p""",
    "dead_letter_reasons": """select 'events' as "table",
        case event_id % 8 when 2 then 'event_id' when 3 then 'event_id' when 4 then 'ts' when 5 then 'user_id' end as "column",
        case event_id % 8 when 0 then 'no_converter' when 1 then 'no_converter' when 2 then 'unparsable'
            when 3 then 'not_null_violation' when 4 then 'not_iso' when 5 then 'incompatible_type'
            else 'ambiguous_column' end as reason,
        count(*) as records, cast(sum(event_id) as bigint) as offsets
        from events where event_id % 8 < 7 group by 1, 2, 3""",
    "write_dead_letters": """select event_type as topic, event_id as "offset", event_type as value,
        'no_converter' as reason, 'props' as "table" from events where event_id % 3 <> 0""",
    "oversize_split": """select case when octet_length(encode(text)) > 4096 then 'too_large' end as reason,
        count(*) as records, cast(sum(octet_length(encode(text))) as bigint) as bytes from documents group by 1""",
    "latest_per_key": f"""select user_id, event_id, epoch_us(ts) as ts, event_type, value
        from {_LATEST.format(where='true')}""",
    "upsert_latest": f"""select coalesce(t.user_id, s.user_id) as user_id,
        coalesce(s.event_id, t.event_id) as event_id,
        case when t.user_id is not null then t.event_type else s.event_type end as event_type,
        case when s.user_id is not null then s.value else t.value end as value
        from {_LATEST.format(where='day(ts) < 15 and user_id % 3 > 0')} t
        full outer join {_LATEST.format(where='day(ts) >= 15 and user_id % 5 > 0')} s on t.user_id = s.user_id""",
    "post_process_script": """select cast(event_id as varchar) || upper(event_type) as processed,
        case when user_id % 4 < 2 then 'first' else 'second' end as batch_id from events""",
    "merge_script": f"""with t as {_LATEST.format(where="ts < timestamp '2024-01-15'")},
        s as {_LATEST.format(where="ts >= timestamp '2024-01-15'")}
        select coalesce(t.user_id, s.user_id) as user_id, coalesce(s.event_id, t.event_id) as event_id,
        case when t.user_id is not null then t.event_type else s.event_type end as event_type,
        case when s.user_id is not null then s.value else t.value end as value
        from t full outer join s on t.user_id = s.user_id""",
    "rolled_back_batch": """select case when user_id % 4 = 0 then 'landed' else 'batch_failed' end as outcome, event_id
        from events""",
    # the tables of both types are merged in turn, "odd" first, and "odd" once more
    "scripts_share_target": """select case when event_id % 2 = 0 then 'even' else 'odd' end as origin, event_id,
            cast(null as bigint) as user_id from events
        union all select 'newest', coalesce(max(event_id) filter (event_id % 2 = 1), max(event_id)), user_id from events group by user_id""",
    "exactly_once_stream": "select event_id, user_id, value from events",
    "at_least_once_stream": """select count(*) as ids, 2 as fewest, 2 * count(*) as records
        from events""",
    "ingest_events": _EVENT_ROWS,
    "ingest_three_tables": """select 'clicks' as "table", 'landed' as outcome, event_id, cast(user_id as varchar) as user_id
            from events where event_type = 'click'
        union all select 'page_views', 'landed', event_id, cast(user_id as varchar) from events where event_type = 'view'
        union all select 'error', case when user_id < 2 then 'landed' else 'out_of_range' end, event_id,
            case user_id when 0 then 'false' when 1 then 'true' end from events where event_type = 'error'""",
    "column_defaults": """select event_id, case when event_id % 3 = 0 then 'app' else 'log' end as origin,
        'none' as grade, case when event_type = 'purchase' then value end as purchase from events""",
    "append_to_catalog_table": """select event_id, event_type, value, cast(null as varchar) as note,
        'event_id,event_type,value' as written from events""",
    "parquet_batch": """select event_id, user_id as "first", event_id as "second", cast(null as varchar) as note
        from events""",
    "sanitize_names": """select p_partkey, case when regexp_matches(n, '^_*$') then 'record'
        when regexp_matches(n, '^[0-9]') then '_' || n else n end as name
        from (select p_partkey, regexp_replace(case p_partkey % 3 when 0 then cast(p_size as varchar) || '-' || p_name
            when 1 then p_brand else '#-.#' end, '[^A-Za-z0-9_]', '_', 'g') as n from part)""",
    "sanitize_columns": """select p_partkey as part_key, p_name as _1st_name, cast(p_size as bigint) as gr__e
        from part""",
}
