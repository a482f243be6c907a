"""Streaming ingest: delivery, dead letters, restart and post-processing."""

import json

import pytest
from pyspark.errors import StreamingQueryException

from event_queries import streams
from tidegate import (
    ENVELOPE,
    BatchFailed,
    IngestConfig,
    PostProcess,
    Script,
    TableSpec,
    TableStore,
    ingest_batch,
    latest_per_key,
    start_ingest,
    stream_topic_log,
)
from tidegate.operators import merge
from tidegate.plans.ingest import plan_tables
from tidegate.streaming.store import dealt

SPEC = TableSpec.from_ddl("games", "id BIGINT NOT NULL, score TEXT, batch_id TEXT")


def record(i, **fields):
    return json.dumps({"id": i, **fields})


def write_log(envelope, path, rows):
    envelope(rows).coalesce(1).write.mode("append").parquet(path)


def run(spark, config, tmp_path, checkpoint="ck"):
    log = stream_topic_log(spark, str(tmp_path / "log"), 1)
    query = start_ingest(log, config, str(tmp_path / "store"), str(tmp_path / checkpoint), available_now=True)
    query.awaitTermination()
    return TableStore(spark, str(tmp_path / "store"))


def config(**kwargs):
    return IngestConfig({"games": SPEC}, mapping={"g": "games"}, **kwargs)


def test_exactly_once_survives_a_lost_checkpoint(spark, envelope, tmp_path):
    cfg = config(delivery="exactly_once", tolerance="all")
    write_log(envelope, str(tmp_path / "log"), [("g", i % 3, i, record(i)) for i in range(30)])
    run(spark, cfg, tmp_path)
    write_log(envelope, str(tmp_path / "log"), [("g", i % 3, i, record(i)) for i in range(30, 50)])
    store = run(spark, cfg, tmp_path)
    assert store.read(SPEC).count() == 50
    # A fresh checkpoint replays the whole log; the ledger drops all of it.
    store = run(spark, cfg, tmp_path, "ck2")
    assert store.read(SPEC).count() == 50
    assert {(r.topic_partition, r.partition_offset) for r in store.ledger().collect()} == {(0, 48), (1, 49), (2, 47)}


def test_at_least_once_duplicates_on_replay(spark, envelope, tmp_path):
    write_log(envelope, str(tmp_path / "log"), [("g", 0, i, record(i)) for i in range(10)])
    run(spark, config(), tmp_path)
    store = run(spark, config(), tmp_path, "ck2")
    landed = store.read(SPEC)
    assert landed.count() == 20
    assert landed.select("id").distinct().count() == 10


def test_an_epoch_run_twice_lands_once(spark, envelope, tmp_path):
    cfg = config(delivery="exactly_once")
    store = TableStore(spark, str(tmp_path / "store"))
    batch = envelope([("g", 0, i, record(i)) for i in range(10)])
    # A crash after the write and before the batch is published leaves files nobody can see.
    from tidegate import tag_batch

    store.stage("e1", plan_tables(batch, cfg, tag_batch("e1")), cfg.tables)
    assert store.read(SPEC).count() == 0
    ingest_batch(batch, "e1", cfg, store)
    ingest_batch(batch, "e1", cfg, store)
    assert store.read(SPEC).count() == 10
    assert {r.batch_id for r in store.read(SPEC).select("batch_id").distinct().collect()} == {"e1"}


def test_dead_letters_keep_the_record(spark, envelope, tmp_path):
    rows = [("g", 0, 0, record(0)), ("g", 0, 1, '{"id":"x"}'), ("g", 0, 2, None), ("g", 0, 3, "[1]"), ("g", 0, 4, "{}")]
    store = TableStore(spark, str(tmp_path / "store"))
    ingest_batch(envelope(rows), "e", config(tolerance="all"), store)
    assert store.read(SPEC).count() == 1
    dead = {r.offset: r for r in store.read_dead_letters("games").collect()}
    assert {o: r.reason for o, r in dead.items()} == {
        1: "unparsable",
        2: "no_converter",
        3: "no_converter",
        4: "not_null_violation",
    }
    assert bytes(dead[1].value) == b'{"id":"x"}' and dead[1].column == "id" and dead[1].declared_type == "bigint"


def test_tolerance_none_publishes_nothing(spark, envelope, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    with pytest.raises(BatchFailed, match="offset 1"):
        ingest_batch(envelope([("g", 0, 0, record(0)), ("g", 0, 1, "bad")]), "e", config(), store)
    assert store.read(SPEC).count() == 0 and not store.published()


def test_oversize_records_are_quarantined(spark, envelope, tmp_path):
    rows = [("g", 0, 0, record(0)), ("g", 0, 1, record(1, score="x" * 200))]
    store = TableStore(spark, str(tmp_path / "store"))
    ingest_batch(envelope(rows), "e", config(tolerance="all", max_bytes=100), store)
    assert store.read(SPEC).count() == 1
    assert [r.reason for r in store.read_dead_letters("games").collect()] == ["too_large"]


def test_merge_script_keeps_the_latest(spark, envelope, tmp_path):
    target = TableSpec.from_ddl("best", "id BIGINT, score TEXT")
    script = Script(
        "games",
        sql="SELECT id, max_by(score, score) AS score FROM games WHERE batch_id = '${any_param.batch_id}' GROUP BY id",
        target="best",
        keys=("id",),
        update=("score",),
    )
    cfg = config(targets={"best": target}, post_process=PostProcess((script,)))
    store = TableStore(spark, str(tmp_path / "store"))
    first = [("g", 0, i, record(i % 5, score=f"{i:02d}")) for i in range(10)]
    second = [("g", 0, 10 + i, record(i, score=f"{20 + i}")) for i in (3, 7)]
    ingest_batch(envelope(first), "e1", cfg, store)
    ingest_batch(envelope(second), "e2", cfg, store)
    assert dict(store.read(target).collect()) == {0: "05", 1: "06", 2: "07", 3: "23", 4: "09", 7: "27"}
    assert store.read(SPEC).count() == 12


def test_callable_script_and_append(spark, envelope, tmp_path):
    target = TableSpec.from_ddl("copy", "id BIGINT, score TEXT, batch_id TEXT")
    script = Script("games", run=lambda batch, _: latest_per_key(batch, ["id"], ["score"]), target="copy")
    cfg = config(targets={"copy": target}, post_process=PostProcess((script,)))
    store = TableStore(spark, str(tmp_path / "store"))
    ingest_batch(envelope([("g", 0, i, record(1, score=str(i))) for i in range(5)]), "e1", cfg, store)
    assert [(r.id, r.score) for r in store.read(target).collect()] == [(1, "4")]


def test_failing_script_rolls_the_batch_back(spark, envelope, tmp_path):
    broken = PostProcess((Script("games", sql="SELECT nope FROM batch", target="best"),))
    batch = envelope([("g", 0, 0, record(0))])
    store = TableStore(spark, str(tmp_path / "a"))
    with pytest.raises(BatchFailed):
        ingest_batch(batch, "e", config(post_process=broken), store)
    assert store.read(SPEC).count() == 0
    store = TableStore(spark, str(tmp_path / "b"))
    ingest_batch(batch, "e", config(post_process=broken, tolerance="all"), store)
    assert store.read(SPEC).count() == 0
    assert [r.reason for r in store.read_dead_letters("games").collect()] == ["batch_failed"]


def test_mapping_may_change_between_runs(spark, envelope, tmp_path):
    other = TableSpec.from_ddl("other", "id BIGINT")
    write_log(envelope, str(tmp_path / "log"), [("g", 0, i, record(i)) for i in range(5)])
    run(spark, config(delivery="exactly_once"), tmp_path)
    write_log(envelope, str(tmp_path / "log"), [(t, 0, 5 + i, record(i)) for i in range(5) for t in ("g", "other", "lost")])
    both = IngestConfig({"games": SPEC, "other": other}, mapping={"g": "games"}, delivery="exactly_once")
    store = run(spark, both, tmp_path)
    assert store.read(SPEC).count() == 10 and store.read(other).count() == 5


def test_empty_batch_is_a_no_op(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    ingest_batch(spark.createDataFrame([], ENVELOPE), "e", config(delivery="exactly_once"), store)
    assert store.read(SPEC).count() == 0


TWO = {name: TableSpec.from_ddl(name, "id BIGINT, v BIGINT") for name in ("a", "b")}
TARGET = TableSpec.from_ddl("t", "id BIGINT NOT NULL, v BIGINT")


def two_tables(envelope, n=4):
    return envelope([(t, 0, i, json.dumps({"id": i + at, "v": i})) for t, at in (("a", 0), ("b", 100)) for i in range(n)])


def scripted(*scripts, **kwargs):
    return IngestConfig(TWO, {"t": TARGET}, post_process=PostProcess(scripts), **kwargs)


def test_scripts_that_append_to_one_table_keep_each_other(spark, envelope, tmp_path):
    store = TableStore(spark, str(tmp_path))
    ingest_batch(two_tables(envelope), "e", scripted(*(Script(t, sql="SELECT id, v FROM batch", target="t") for t in TWO)), store)
    assert sorted(r.id for r in store.read(TARGET).collect()) == [0, 1, 2, 3, 100, 101, 102, 103]


def test_scripts_that_merge_into_one_table_go_on_from_each_other(spark, envelope, tmp_path):
    store = TableStore(spark, str(tmp_path))
    ingest_batch(two_tables(envelope), "e", scripted(*(Script(t, sql="SELECT id, v FROM batch", target="t", keys=("id",)) for t in TWO)), store)
    assert sorted(r.id for r in store.read(TARGET).collect()) == [0, 1, 2, 3, 100, 101, 102, 103]


def test_merge_takes_the_targets_types(spark, envelope, tmp_path):
    narrow = Script("a", sql="SELECT cast(id AS int) AS id, v FROM batch", target="t", keys=("id",))
    ingest_batch(two_tables(envelope, 20), "e1", scripted(narrow), TableStore(spark, str(tmp_path)))
    wide = Script("a", sql="SELECT id, v + 1 AS v FROM batch WHERE id < 4", target="t", keys=("id",))
    store = TableStore(spark, str(tmp_path))
    ingest_batch(two_tables(envelope, 20), "e2", scripted(wide), store)
    assert sorted((r.id, r.v) for r in store.read(TARGET).collect()) == [(i, i + (i < 4)) for i in range(20)]


def test_repeated_keys_fail_the_merge(spark, envelope, tmp_path):
    store = TableStore(spark, str(tmp_path))
    twice = Script("a", sql="SELECT id % 2 AS id, v FROM batch", target="t", keys=("id",))
    with pytest.raises(BatchFailed, match="Several rows"):
        ingest_batch(two_tables(envelope), "e", scripted(twice), store)
    assert store.read(TARGET).count() == 0


@pytest.mark.parametrize("sql", ["SELECT id, v, 1 AS w FROM batch", "SELECT v FROM batch", "SELECT cast(null AS bigint) AS id, v FROM batch", "SELECT 'x' AS id, v FROM batch"])
def test_script_rows_must_fit_the_target(spark, envelope, tmp_path, sql):
    store = TableStore(spark, str(tmp_path))
    with pytest.raises(BatchFailed):
        ingest_batch(two_tables(envelope), "e", scripted(Script("a", sql=sql, target="t")), store)
    assert store.read(TARGET).count() == 0 and not store.committed("e")


def test_a_table_is_appended_to_or_merged_into():
    append, merge = (Script(t, sql="SELECT id, v FROM batch", target="t", keys=k) for t, k in (("a", ()), ("b", ("id",))))
    with pytest.raises(ValueError, match="not both: t"):
        scripted(append, merge)
    with pytest.raises(ValueError, match="not both: b"):
        scripted(Script("a", sql="SELECT id, v FROM batch", target="b", keys=("id",)))
    with pytest.raises(ValueError, match="different keys"):
        scripted(merge, Script("a", sql="SELECT id, v FROM batch", target="t", keys=("v",)))


def test_a_crash_while_publishing_leaves_nothing_that_is_read(spark, envelope, tmp_path):
    store = TableStore(spark, str(tmp_path))
    ingest_batch(two_tables(envelope), "e0", scripted(delivery="exactly_once"), store)
    (tmp_path / "published" / "e1" / "_temporary").mkdir(parents=True)
    assert not store.committed("e1")
    for _ in range(2):
        ingest_batch(two_tables(envelope, 6), "e1", scripted(delivery="exactly_once"), store)
    assert store.read(TWO["a"]).count() == 6 and store.committed("e1")


def test_a_failure_of_the_cluster_stops_the_query(spark, envelope, tmp_path):
    def lost(batch, batch_id):
        raise ConnectionError("storage is away")

    store = TableStore(spark, str(tmp_path))
    cfg = scripted(Script("a", run=lost, target="t"), tolerance="all", delivery="exactly_once")
    with pytest.raises(ConnectionError):
        ingest_batch(two_tables(envelope), "e", cfg, store)
    assert not store.committed("e") and store.ledger() is None and store.read_dead_letters("a").count() == 0
    ingest_batch(two_tables(envelope), "e", scripted(delivery="exactly_once"), store)
    assert store.read(TWO["a"]).count() == 4


def test_batches_are_read_once_and_not_shuffled(spark, envelope, tmp_path):
    """Three tables: one scan of the log, no join before there is a ledger, no exchange."""
    write_log(envelope, str(tmp_path / "log"), [(t, 0, i, json.dumps({"id": i, "v": i})) for i in range(8) for t in ("a", "b", "c", "other")])
    tables = {**TWO, "c": TableSpec.from_ddl("c", "id TEXT, v BOOLEAN")}
    cfg = IngestConfig(tables, delivery="exactly_once", tolerance="all")
    log = spark.read.schema(ENVELOPE).parquet(str(tmp_path / "log"))
    plan = dealt(plan_tables(log, cfg), tables)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan and "Exchange" not in plan and "Union" not in plan
    store = TableStore(spark, str(tmp_path / "store"))
    counts = ingest_batch(log, "e", cfg, store)
    assert counts == {"a": {"landed": 8, "dead": 0}, "b": {"landed": 8, "dead": 0}, "c": {"landed": 0, "dead": 8}}
    assert sorted(r.id for r in store.read(TWO["b"]).collect()) == list(range(8))
    assert [(r.topic, r.column) for r in store.read_dead_letters("c").collect()] == [("c", "v")] * 8


PLAIN = TableSpec.from_ddl("games", "id BIGINT NOT NULL, score TEXT")


def plain(**kwargs):
    return IngestConfig({"games": PLAIN}, mapping={"g": "games"}, **{"tolerance": "all", "delivery": "exactly_once", **kwargs})


def test_plain_ingest_is_one_streaming_query_into_the_file_sink(spark, envelope, tmp_path):
    write_log(envelope, str(tmp_path / "log"), [("g", i % 3, i, record(i)) for i in range(30)] + [("g", 0, 99, "bad")])
    store = run(spark, plain(), tmp_path)
    assert store.read(PLAIN).count() == 30 and [r.reason for r in store.read_dead_letters("games").collect()] == ["no_converter"]
    assert not store.published() and (tmp_path / "store" / "sink" / store.runs()[0] / "_spark_metadata").exists()
    write_log(envelope, str(tmp_path / "log"), [("g", i % 3, i, record(i)) for i in range(100, 120)])
    assert run(spark, plain(), tmp_path).read(PLAIN).count() == 50
    # A lost checkpoint: a run of its own reads the log again, and the offsets of what has landed keep all of it out.
    write_log(envelope, str(tmp_path / "log"), [("g", 7, 0, record(777))])
    store = run(spark, plain(), tmp_path, "ck2")
    assert len(store.runs()) == 2 and store.read(PLAIN).count() == 51
    assert run(spark, plain(delivery="at_least_once"), tmp_path, "ck3").read(PLAIN).count() == 102


def test_a_driver_lost_between_write_and_commit_lands_the_batch_once(spark, envelope, tmp_path):
    write_log(envelope, str(tmp_path / "log"), [("g", 0, i, record(i)) for i in range(10)])
    store = run(spark, plain(), tmp_path)
    sink = tmp_path / "store" / "sink" / store.runs()[0]
    written = list(sink.rglob("part-*.parquet"))
    # As after a crash: the files lie there, the sink's log and the checkpoint know nothing of the batch.
    for log in (sink / "_spark_metadata" / "0", tmp_path / "ck" / "commits" / "0"):
        log.unlink()
        log.with_name(f".{log.name}.crc").unlink(missing_ok=True)
    assert store.read(PLAIN).count() == 0
    store = run(spark, plain(), tmp_path)
    assert store.read(PLAIN).count() == 10 and len(list(sink.rglob("part-*.parquet"))) == 2 * len(written)


def test_tolerance_none_stops_the_stream_before_anything_lands(spark, envelope, tmp_path):
    write_log(envelope, str(tmp_path / "log"), [("g", 0, 0, record(0)), ("g", 0, 1, "bad")])
    with pytest.raises(StreamingQueryException, match="offset 1"):
        run(spark, plain(tolerance="none"), tmp_path)
    assert TableStore(spark, str(tmp_path / "store")).read(PLAIN).count() == 0


def test_plain_mapping_may_change_between_runs(spark, envelope, tmp_path):
    other = TableSpec.from_ddl("other", "id BIGINT")
    write_log(envelope, str(tmp_path / "log"), [("g", 0, i, record(i)) for i in range(5)])
    run(spark, plain(), tmp_path)
    write_log(envelope, str(tmp_path / "log"), [(t, 0, 5 + i, record(i)) for i in range(5) for t in ("g", "other", "lost")])
    both = IngestConfig({"games": PLAIN, "other": other}, mapping={"g": "games"}, delivery="exactly_once")
    store = run(spark, both, tmp_path)
    assert store.read(PLAIN).count() == 10 and store.read(other).count() == 5


def test_defaults_of_columns_that_the_write_saw_no_value_for(spark, envelope, tmp_path):
    spec = TableSpec.from_ddl("games", 'id BIGINT, grade TEXT DEFAULT \'none\', score TEXT DEFAULT \'x\', "odd name" INTEGER DEFAULT 7')
    store = TableStore(spark, str(tmp_path))
    ingest_batch(envelope([("g", 0, 0, record(0, score="a")), ("g", 0, 1, record(1))]), "e", IngestConfig({"games": spec}, mapping={"g": "games"}), store)
    assert sorted(map(tuple, store.read(spec).collect())) == [(0, "none", "a", 7), (1, "none", None, 7)]


def test_catalog_without_row_level_operations_is_refused_and_one_with_them_is_merged(spark, envelope, tmp_path, monkeypatch):
    name = f"merged_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE TABLE {name} (id BIGINT, v BIGINT, w BIGINT) USING parquet")
    assert not merge.supports_merge(spark, name) and not merge.supports_merge(spark, "no_such_table")
    cfg = scripted(Script("a", sql="SELECT id, v FROM batch", target=name, keys=("id",), catalog=True))
    store = TableStore(spark, str(tmp_path))
    with pytest.raises(BatchFailed, match="row-level"):
        ingest_batch(two_tables(envelope), "e", cfg, store)
    assert not store.committed("e")
    # A catalog with them: Spark is asked for one merge on the key, that updates and inserts.
    asked = []

    class Writer:
        def __init__(self, table, condition):
            asked.append((table, str(condition)))

        def __getattr__(self, step):
            return lambda *a: asked.append((step, sorted(a[0]) if a else None)) or self

    monkeypatch.setattr(merge, "supports_merge", lambda *_: True)
    monkeypatch.setattr(type(spark.range(1)), "mergeInto", lambda self, table, condition: Writer(table, condition))
    ingest_batch(two_tables(envelope), "e", cfg, store)
    assert asked[0][0] == f"`{name}`" and "id" in asked[0][1] and store.committed("e")
    assert asked[1:] == [("whenMatched", None), ("update", ["v"]), ("whenNotMatched", None), ("insert", ["id", "v"]), ("merge", None)]
    with pytest.raises(BatchFailed, match="Several rows"):
        ingest_batch(two_tables(envelope), "f", scripted(Script("a", sql="SELECT id % 2 AS id, v FROM batch", target=name, keys=("id",), catalog=True)), store)


def test_the_merge_statement_parses(spark):
    text = merge.merge_sql("cat.db.t`x", ["id", "a b", "v"], ["id"], ["v"], "batch")
    parsed = spark._jsparkSession.sessionState().sqlParser().parsePlan(text).toString()
    assert "MergeIntoTable" in parsed and parsed.count("=") >= 1


def test_the_halves_of_a_streamed_log_are_not_one_file_and_are_not_sorted(spark, tmp_path, monkeypatch):
    """Of events read in several parts, no batch comes from a single file; the session lets the sink write records as they come."""
    root, sf = str(tmp_path / "run"), tmp_path / "sf"
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(6, "event_id").write.parquet(str(sf / "events.parquet"))
    monkeypatch.setattr(streams, "scratch", lambda _: root)
    spark.conf.set("spark.sql.files.openCostInBytes", 128 << 20)  # a file is a split
    try:
        got = streams.observed_throughput(spark, str(sf)).collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [(r.batches, r.records, r.landed, r.mib_agrees) for r in got] == [(2, 1000, 900, True)]
    assert len(list((tmp_path / "run/log").glob("*.parquet"))) == 12
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "16"
