"""The ingest of a topic log into a :class:`TableStore`, streamed by Spark's file sink or batch by batch.

Where every record's fate depends on that record alone, the whole plan is one streaming query into Spark's file sink,
which with its checkpoint lands each record once. Scripts, batch ids and defaults that look at a whole batch need
``foreachBatch``: there the checkpoint's batch id names the folders, so that a batch that runs again overwrites itself.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from uuid import uuid4

from pyspark.errors import (
    AnalysisException,
    ArithmeticException,
    ArrayIndexOutOfBoundsException,
    DateTimeException,
    NumberFormatException,
    ParseException,
    SparkRuntimeException,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.names import col, quote
from ..functions.types import SchemaError, TableSpec
from ..operators import merge, offsets, route
from ..operators.decode import ERROR, SRC
from ..operators.metrics import observed
from ..operators.quarantine import BatchFailed, enforce, whole_batch_dead
from ..plans.ingest import BATCH_ID, IngestConfig, Script, plan_tables, row_column, tag_batch
from ..session import configure
from .store import Change, TableStore, dealt, require_single


#: What a script's own text and values can cause. Anything else, such as lost executors, stops the query, and the epoch runs again.
SCRIPT_ERRORS = (
    AnalysisException,
    ParseException,
    ArithmeticException,
    ArrayIndexOutOfBoundsException,
    DateTimeException,
    NumberFormatException,
    SparkRuntimeException,
    BatchFailed,
    SchemaError,
)


class PostProcessFailed(BatchFailed):
    """The post-processing of a batch failed, so the batch is not published."""


def ingest_batch(batch: DataFrame, epoch: str, config: IngestConfig, store: TableStore) -> dict[str, dict[str, int]]:
    """One batch, read once and published by a single small file. Returns what landed and failed in each table.

    Under exactly-once an epoch that was published before is skipped, and records at or below the ledger are
    dropped, whichever query or checkpoint they come back through. Under at-least-once every attempt lands.
    """
    exactly_once = config.delivery == "exactly_once"
    if exactly_once:
        if store.committed(epoch):
            return {}
        if (ledger := store.ledger()) is not None:
            batch = offsets.drop_processed(batch, ledger)
    staged, seen = store.stage(epoch, plan_tables(batch, config, tag_batch(epoch)), config.tables)
    counts = {t: {o: seen.get(f"{o}_{n}") or 0 for o in ("landed", "dead")} for n, t in enumerate(config.tables)}
    if config.tolerance == "none":
        enforce(store.staged_dead(staged), config.tolerance)
    if config.profile == "sql":
        staged = _with_defaults(epoch, staged, seen, config, store)
    changes: list[Change] = []
    for table, outcomes in counts.items():
        own = [Change(o, table, staged, n) for o, n in outcomes.items() if n]
        try:
            script = config.post_process.script_for(table)
            if script is not None and outcomes["landed"]:
                own += run_script(script, epoch, own, config, store, changes)
        except (BatchFailed, SchemaError, AnalysisException) as e:
            # Failures of the cluster are not caught: the query stops and the epoch runs again.
            if config.tolerance == "none" or not _of_the_batch(e):
                raise
            records = route.filter_topics(batch, route.topic_names(table, config.mapping))
            if config.topics is not None:
                records = route.filter_topics(records, list(config.topics))
            own = store.stage_dead(epoch, whole_batch_dead(records, table, e), table)
            counts[table] = {"landed": 0, "dead": outcomes["landed"] + outcomes["dead"]}
        changes += own
    if exactly_once and any(n for outcomes in counts.values() for n in outcomes.values()):
        changes.append(store.stage_ledger(epoch, staged))
    store.publish(epoch, changes)
    return counts


def _with_defaults(epoch: str, staged: str, seen: dict[str, int], config: IngestConfig, store: TableStore) -> str:
    """Nullable columns that no record of a table had a value for take their default, as the write has shown.

    Only then is what was written read again: parsed rows, not records.
    """
    absent = {
        t: [c for k, c in enumerate(spec.columns) if c.default is not None and c.nullable and not seen.get(f"given_{n}_{k}")]
        for n, (t, spec) in enumerate(config.tables.items())
        if seen.get(f"landed_{n}")
    }
    if not any(absent.values()):
        return staged
    rows = store.staged_rows(staged, config.tables)
    for table, columns in absent.items():
        if columns:
            row = col(row_column(table))
            filled = row
            for c in columns:
                filled = filled.withField(quote(c.name), F.expr(c.default).cast(c.declared.spark))
            rows = rows.withColumn(row_column(table), F.when(row.isNotNull(), filled))
    return store.write_dealt(rows, f"{staged}-filled")


def _of_the_batch(e: Exception) -> bool:
    """False where files are gone or cannot be read: that is the storage's failure, not the batch's."""
    return not (isinstance(e, AnalysisException) and (e.getCondition() or "").startswith(("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")))


def run_script(
    script: Script, batch_id: str, changes: list[Change], config: IngestConfig, store: TableStore, staged: list[Change] = ()
) -> list[Change]:
    """Run a table's post-processing over its staged batch and stage the result.

    In SQL the batch is the view ``batch``, and every configured table the script names is a view of its own:
    what is published, plus this batch for the table itself.
    """
    spec = config.tables[script.table]
    landed = next(c.path for c in changes if c.kind == "landed" and c.name == script.table)
    batch = store.landed_rows(landed, spec)
    # A micro-batch has a session of its own, so the views do not clash with the user's.
    session = batch.sparkSession
    views = []
    try:
        if script.run is not None:
            result = script.run(batch, batch_id)
        else:
            batch.createOrReplaceTempView("batch")
            views.append("batch")
            for name, table in {**config.targets, **config.tables}.items():
                if not re.search(rf"(?<!\w){re.escape(name)}(?!\w)", script.sql):
                    continue
                view = store.read(table)
                if name == script.table:
                    view = view.unionByName(batch)
                view.createOrReplaceTempView(f"`{name}`")
                views.append(name)
            result = _sql(session, script.text(batch_id))
        if script.target is None or result is None:
            return []
        known = {**config.tables, **config.targets}
        target = known.get(script.target) or TableSpec.from_spark(script.target, result.schema)
        if script.keys and script.catalog:
            merge_into_catalog(result, script)
            return []
        if script.keys:
            update = list(script.update) if script.update is not None else None
            return store.stage_merge(batch_id, result, target, list(script.keys), update, script.table, [*staged, *changes])
        return store.stage_append(batch_id, result, target, script.table)
    except SCRIPT_ERRORS as e:
        if not _of_the_batch(e):
            raise
        raise PostProcessFailed(f"Post-processing of {script.table} failed: {e}") from e
    finally:
        for view in views:
            session.catalog.dropTempView(view)


def _sql(session: SparkSession, text: str) -> DataFrame:
    """A statement as it is written: parameters other than the batch id are the user's, not settings of the session."""
    key = "spark.sql.variable.substitute"
    before = session.conf.get(key)
    session.conf.set(key, False)
    try:
        return session.sql(text)
    finally:
        session.conf.set(key, before)


def merge_into_catalog(result: DataFrame, script: Script) -> None:
    """Merge a script's rows into a catalog table by its own row-level operation, which is one commit of that table.

    A batch that runs again merges the same rows again, which changes nothing. A failure later in the batch cannot take
    the merge back, so it is the last thing a script does.
    """
    work = result.sparkSession
    if not merge.supports_merge(work, script.target):
        raise SchemaError(f"{script.target} has no row-level operations; without `catalog` the store keeps its versions")
    require_single(result, script.target, list(script.keys))
    merge.merge_into(result, script.target, list(script.keys), list(script.update) if script.update is not None else None)


def streams_whole(config: IngestConfig) -> bool:
    """Whether each record's fate depends on that record alone."""
    columns = [c for spec in config.tables.values() for c in spec.columns]
    by_batch = any(c.name.lower() == BATCH_ID for c in columns)
    defaulted = config.profile == "sql" and any(c.default is not None and c.nullable for c in columns)
    return not (config.post_process.scripts or by_batch or defaulted)


def plan_stream(stream: DataFrame, config: IngestConfig) -> DataFrame:
    """All tables' rows and dead letters in one streaming DataFrame, laid out as the store reads them.

    Under tolerance ``none`` a record that does not fit fails its batch as it is written.
    """
    planned = plan_tables(stream, config)
    out = dealt(observed(planned, F.col(ERROR).isNotNull(), F.col(f"{SRC}.value")), config.tables)
    if config.tolerance == "none":
        where = F.concat_ws(" ", "_message", F.lit("(table"), "table", F.lit("topic"), "_topic", F.lit("offset"), F.col("_offset").cast("string"), F.lit(")"))
        out = out.withColumn("outcome", F.when(F.col("outcome") == "dead", F.raise_error(where)).otherwise(F.col("outcome")))
    return out


def start_ingest(
    stream: DataFrame,
    config: IngestConfig,
    root: str,
    checkpoint: str,
    *,
    available_now: bool = False,
    trigger_seconds: float | None = None,
) -> StreamingQuery:
    """Start the ingest. The mapping and tables are not part of the checkpoint and may change between runs.

    Under exactly-once, records that an earlier run (a lost checkpoint) has landed are dropped by their offsets.
    """
    spark = stream.sparkSession
    store = TableStore(spark, root)
    if streams_whole(config):
        run = store.run_of(checkpoint)
        if config.delivery == "exactly_once" and (before := store.start_of(run)) is not None:
            stream = offsets.drop_processed(stream, before)
        sink = plan_stream(stream, config).writeStream.format("parquet").partitionBy("table", "outcome")
        writer = sink.option("path", f"{store.root}/sink/{run}")
    else:
        writer = stream.writeStream.foreachBatch(_each_batch(config, store))
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger_seconds is not None:
        writer = writer.trigger(processingTime=f"{trigger_seconds} seconds")
    return writer.start()


def _each_batch(config: IngestConfig, store: TableStore) -> Callable[[DataFrame, int], None]:
    def run(batch: DataFrame, batch_number: int) -> None:
        session = configure(batch.sparkSession)
        query = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        epoch = f"{query}-{batch_number}"
        if config.delivery == "at_least_once":
            epoch = f"{epoch}-{uuid4().hex[:12]}"
        ingest_batch(batch, epoch, config, store.using(session))

    return run
