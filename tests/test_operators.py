"""Routing, resolution, offsets, merge, checks, metrics, sources and configuration."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

import tidegate as tg
from tidegate import IngestConfig, PostProcess, SchemaError, TableSpec
from tidegate.functions.names import sanitized
from tidegate.operators.quarantine import enforce
from tidegate.sources.replay import number_rows, read_csv


# --- routing and configuration ---


def test_mapping_is_trimmed_and_optional(spark):
    mapping = tg.parse_mapping(" a:x , b : y ")
    assert mapping == {"a": "x", "b": "y"} and tg.parse_mapping(None) == tg.parse_mapping("  ") == {}
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "topic string")
    assert dict(tg.route(df, mapping).collect()) == {"a": "x", "b": "y", "c": "c"}


@pytest.mark.parametrize("text", ["a", "a:", ":x", "a:x,,b:y", "a:x,a:y", "a:x,b:x", "a:b:c", "a:x,"])
def test_bad_mappings(text):
    with pytest.raises(ValueError):
        tg.parse_mapping(text)


def test_a_mapped_topic_leaves_the_table_of_its_name(spark, envelope):
    df = envelope([("a", 0, 0, "{}"), ("b", 0, 1, "{}")])
    branches = tg.split_by_table(df, {"a": "b"}, ["b", "a"])
    assert [r.offset for r in branches["b"].collect()] == [0, 1]
    assert branches["a"].count() == 0


def test_post_process_config(tmp_path):
    file = tmp_path / "s.sql"
    file.write_text("SELECT ${x.batch_id}, ${other}")
    text = json.dumps({"mappings": [{"table": "t", "scriptFile": str(file)}, {"table": "t", "script": "SELECT 2"}]})
    script = PostProcess.from_json(text).script_for("t")
    assert script.text("b1") == "SELECT b1, ${other}"
    assert PostProcess.from_json("").script_for("t") is None and PostProcess.from_json("{}").scripts == ()


@pytest.mark.parametrize(
    "mapping", [{"table": "t"}, {"script": "s"}, {"table": "t", "script": "s", "scriptFile": "f"}, {"table": " ", "script": "s"}]
)
def test_bad_post_process_config(mapping):
    with pytest.raises(ValueError):
        PostProcess.from_json(json.dumps({"mappings": [mapping]}))
    with pytest.raises(ValueError):
        PostProcess.from_json("not json")


def test_unknown_settings_are_refused():
    for wrong in ({"profile": "x"}, {"delivery": "x"}, {"tolerance": "x"}):
        with pytest.raises(ValueError):
            IngestConfig({}, **wrong)


# --- table specifications ---


def test_ddl_with_quoted_names_and_defaults():
    spec = TableSpec.from_ddl("t", '"a-b.c d" INTEGER NOT NULL, über TEXT NULL, at TIMESTAMPTZ NOT NULL DEFAULT current_timestamp(), n NUMERIC(5, 2)')
    assert spec.names == ["a-b.c d", "über", "at", "n"]
    assert [c.nullable for c in spec.columns] == [False, True, False, True]
    assert spec.columns[2].default == "current_timestamp()" and str(spec.columns[3].declared) == "decimal(5,2)"
    assert TableSpec.from_spark("t", spec.schema) == spec


def test_columns_differing_in_case_only():
    with pytest.raises(SchemaError):
        TableSpec.from_ddl("t", "a INTEGER, A TEXT")


def test_odd_names_survive(spark, envelope):
    spec = TableSpec.from_ddl("t", '"Mixed" INTEGER, "a-b" INTEGER, "c.d" INTEGER, "e f" INTEGER, über INTEGER, "o\'k" INTEGER, "b`t" INTEGER')
    record = {n: i for i, n in enumerate(spec.names)}
    shouted = {n.upper(): i for i, n in enumerate(spec.names)}
    rows = tg.plan_rows(envelope([("t", 0, 0, json.dumps(record)), ("t", 0, 1, json.dumps(shouted))]), spec)
    valid, dead = tg.split_valid(rows, spec)
    assert [tuple(r) for r in valid.collect()] == [tuple(range(7))] * 2 and dead.count() == 0


def test_discover(spark):
    with pytest.raises(SchemaError, match="no_such"):
        tg.discover(spark, ["no_such"])
    spark.sql("CREATE TABLE disc (id BIGINT, v DECIMAL(5,2), a ARRAY<STRING>) USING parquet")
    try:
        spec = tg.discover(spark, ["disc"])["disc"]
        assert [str(c.declared) for c in spec.columns] == ["bigint", "decimal(5,2)", "array(text)"]
        assert tg.missing_tables(spark, ["disc", "zz", "zz"]) == ["zz"]
    finally:
        spark.sql("DROP TABLE disc")


# --- decoding ---


@pytest.mark.parametrize("value", [None, "", " ", "null", "1", '"s"', "[]", "{bad", '{"a":1', "{'a':1}", '{"a":NaN}', b'{"a":"\xff"}'])
def test_no_converter(spark, envelope, value):
    spec = TableSpec.from_ddl("t", "a TEXT")
    row = tg.plan_rows(envelope([("t", 0, 0, value)]), spec).first()
    assert row["_error"]["reason"] == "no_converter"


def test_spellings(spark, envelope):
    spec = TableSpec.from_ddl("t", "userId INTEGER, x INTEGER")
    values = ['{"USERID":1,"x":2}', '{"userid":1,"UserID":2}', '{"userId":1,"userId":3}', '{"y":1,"Y":2,"x":5}', '{"USERID":1,"USERID":4}', "{}"]
    rows = tg.plan_rows(envelope([("t", 0, i, v) for i, v in enumerate(values)]), spec)
    got = {r["offset"]: r["reason"] or (r["userId"], r["x"]) for r in rows.select("_src.offset", "_error.reason", "userId", "x").collect()}
    assert got == {0: (1, 2), 1: "ambiguous_column", 2: (3, None), 3: (None, 5), 4: (4, None), 5: (None, None)}


def test_typed_records_have_a_size_limit_too(spark):
    schema = "topic string, partition int, offset bigint, timestamp timestamp, key binary, value struct<a:string>"
    rows = [("t", 0, i, None, None, v) for i, v in enumerate([("x",), ("x" * 100,), None])]
    out = tg.plan_rows(spark.createDataFrame(rows, schema), TableSpec.from_ddl("t", "a TEXT"), max_bytes=50)
    got = {r["offset"]: r["reason"] for r in out.select("_src.offset", "_error.reason").collect()}
    assert got == {0: None, 1: "too_large", 2: "no_converter"}


def test_first_failing_column_in_table_order(spark, envelope):
    spec = TableSpec.from_ddl("t", "a INTEGER, b DATE NOT NULL, c BOOLEAN")
    row = tg.plan_rows(envelope([("t", 0, 0, '{"c":"x","b":"y"}')]), spec).first()
    assert tuple(row["_error"]) == ("b", "date", "not_iso")


def test_defaults(spark, envelope):
    spec = TableSpec.from_ddl("t", "a INTEGER, b TEXT DEFAULT 'none', c INTEGER NOT NULL DEFAULT 7")
    rows = tg.plan_rows(envelope([("t", 0, 0, '{"a":1}'), ("t", 0, 1, '{"a":2,"c":8}')]), spec)
    filled = tg.fill_defaults(rows, spec)
    assert sorted(tuple(r) for r in filled.select("a", "b", "c").collect()) == [(1, "none", 7), (2, "none", 8)]
    some = tg.plan_rows(envelope([("t", 0, 0, '{"a":1}'), ("t", 0, 1, '{"a":2,"b":"x"}')]), spec)
    assert sorted(tg.fill_defaults(some, spec).select("a", "b").collect()) == [(1, None), (2, "x")]


def test_error_filter_stays_above_the_parsing(spark, envelope):
    """Pushed down, the filter would parse every record once per column."""
    spec = TableSpec.from_ddl("t", "a INTEGER, b TEXT")
    valid, _ = tg.split_valid(tg.plan_rows(envelope([("t", 0, 0, "{}")]), spec), spec)
    plan = valid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("json_object_keys") + plan.count("jsonObjectKeys") == 1
    assert "Filter isnull(_error" in plan


def test_ingest_plan_has_no_shuffle_and_reads_needed_columns(spark, envelope, tmp_path):
    envelope([("t", 0, 0, '{"a":1}')]).write.parquet(str(tmp_path / "log"))
    spec = TableSpec.from_ddl("t", "a INTEGER")
    log = tg.read_topic_log(spark, str(tmp_path / "log"), ["t"])
    plan = tg.plan_rows(log, spec).select("a")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PushedFilters: [In(topic, [t])]" in plan or "EqualTo(topic,t)" in plan
    assert "ReadSchema: struct<topic:string,value:binary>" in plan


# --- offsets, merge ---


def test_ledger(spark, envelope):
    log = envelope([("a", 0, 5, "{}"), ("a", 0, 9, "{}"), ("a", None, 3, "{}"), ("b", 1, 2, "{}")])
    ledger = tg.advance_offsets(log, tg.empty_ledger(spark))
    assert sorted(map(tuple, ledger.collect())) == [("a", -1, 3), ("a", 0, 9), ("b", 1, 2)]
    late = envelope([("a", 0, 7, "{}"), ("a", 0, 10, "{}"), ("a", None, 3, "{}"), ("b", 2, 0, "{}"), ("b", 1, 2, "{}")])
    assert sorted(r.offset for r in tg.drop_processed(late, ledger).collect()) == [0, 10]
    assert ("a", 0, 9) in set(map(tuple, tg.advance_offsets(late.where("offset < 8"), ledger).collect()))


def brute_latest(rows):
    best = {}
    for r in rows:
        if r[0] not in best or (r[1] is not None, r[1] or 0, r[2]) > (best[r[0]][1] is not None, best[r[0]][1] or 0, best[r[0]][2]):
            best[r[0]] = r
    return best


def test_latest_and_upsert_against_brute_force(spark):
    rng = random.Random(7)
    hot = [(0 if rng.random() < 0.4 else rng.randrange(50), rng.choice([None, *range(9)]), i, f"v{i}") for i in range(2000)]
    schema = "k int, at int, seq int, v string"
    latest = tg.latest_per_key(spark.createDataFrame(hot, schema).repartition(8), ["k"], ["at", "seq"])
    want = brute_latest(hot)
    assert {r.k: tuple(r) for r in latest.collect()} == want
    target = [(k, None, k, "old") for k in range(40, 60)] * 2 + [(None, 1, 1, "null key")]
    merged = tg.upsert(spark.createDataFrame(target, schema), latest, ["k"], ["v"]).collect()
    expected = [(k, a, s, want[k][3] if k in want else v) for k, a, s, v in target] + [r for k, r in want.items() if k < 40]
    assert sorted(map(str, map(tuple, merged))) == sorted(map(str, expected))


def test_latest_aggregates_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 AS k", "id AS at", "cast(id AS string) AS v")
    plan = tg.latest_per_key(df, ["k"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_tolerance(spark):
    dead = spark.createDataFrame([("t", 0, 1, "x", "boom")], "topic string, partition int, offset bigint, table string, message string")
    enforce(dead, "all")
    with pytest.raises(tg.BatchFailed, match="boom"):
        enforce(dead, "none")


# --- checks and metrics ---


def test_checks(spark):
    ids = tg.sequence_log(spark, 1000)
    assert tg.check_checksum(ids, "id", 1000).first()["ok"]
    assert not tg.check_checksum(ids, "id", 1001).first()["ok"]
    assert not tg.check_checksum(ids.where("id <> 5").unionAll(ids.where("id = 6")), "id", 1000).first()["ok"]
    assert tg.check_count(ids, 1000).first()["ok"] and not tg.check_count(ids.unionAll(ids), 1000).first()["ok"]
    assert tg.check_count(ids.unionAll(ids), 1000, "at_least_once").first()["ok"]
    assert tg.check_distinct(ids.unionAll(ids), "id", 1000).first()["ok"]
    assert [r.ok for r in tg.spot_check(ids, 1000).orderBy("id").collect()] == [True] * 3
    assert [r.ok for r in tg.spot_check(ids.where("id <> 500"), 1000).orderBy("id").collect()] == [True, False, True]


def test_metrics(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [("a", at, at + dt.timedelta(seconds=2), 10, 1 << 20, True), ("a", at + dt.timedelta(seconds=1), at + dt.timedelta(seconds=4), 20, 1 << 21, False), ("b", at, at, 5, 0, True)]
    batches = spark.createDataFrame(rows, "cell string, started_at timestamp, ended_at timestamp, records bigint, bytes bigint, ok boolean")
    got = {r.cell: tuple(r)[1:] for r in tg.throughput(batches, ["cell"]).collect()}
    assert got == {"a": (30, 5.0, 6, 0.6), "b": (5, 0.0, 0, 0.0)}
    rates = {r.cell: (r.seconds, r.records_per_sec) for r in tg.ingest_rate(batches, ["cell"]).collect()}
    assert rates == {"a": (2, 5), "b": (1, 5)}
    now = spark.createDataFrame([("up", 105.0), ("same", 95.0), ("down", 94.9), ("new", 1.0), ("zero", 1.0)], "cell string, rate double")
    base = spark.createDataFrame([("up", 100.0), ("same", 100.0), ("down", 100.0), ("zero", 0.0)], "cell string, rate double")
    verdicts = {r.cell: r.verdict for r in tg.compare_runs(now, base, ["cell"], "rate").collect()}
    assert verdicts == {"up": "good", "same": "ok", "down": "warn", "new": None, "zero": None}


# --- sources and names ---


def test_csv_sources(spark, tmp_path):
    path = tmp_path / "games.csv"
    path.write_text('id,name,note\n1,a,\n2,"b, ""x""\ny",NULL\n3, c\n', encoding="utf-8")
    log = tg.csv_to_topic_log(spark, str(path), "games", batch_size=2, multi_line=True)
    got = [(r.offset, r.batch_no, json.loads(bytes(r.value))) for r in log.orderBy("offset").collect()]
    assert got[0] == (0, 0, {"id": "1", "name": "a", "note": None})
    assert got[1] == (1, 0, {"id": "2", "name": 'b, "x"\ny', "note": "NULL"})
    assert got[2][0:2] == (2, 1)
    replayed = [json.loads(bytes(r.value)) for r in tg.replay_csv(spark, str(path), "games", 7, multi_line=True).orderBy("offset").collect()]
    assert [r["id"] for r in replayed] == ["1", "2", "3", "1", "2", "3", "1"]
    assert replayed[1]["note"] is None and replayed[2] == {"id": "3", "name": "c", "note": None}


def test_number_rows_keeps_order_across_partitions(spark):
    numbered = number_rows(spark.range(0, 1000, 1, 7).where("id % 3 > 0"))
    ids = [r.id for r in numbered.orderBy("_seq").collect()]
    assert ids == [i for i in range(1000) if i % 3] and [r._seq for r in numbered.orderBy("_seq").collect()] == list(range(len(ids)))


def test_generated_logs(spark):
    rows = tg.sequence_log(spark, 3, pad=12).collect()
    assert [r.name for r in rows] == ["record-1xxxx", "record-2xxxx", "record-3xxxx"] and rows[2].value == 3 * 1.1
    assert tg.sequence_log(spark, 1, pad=2).first().name == "record-1"
    one, again, other = (tg.random_log(spark, 50, s, 20).collect() for s in (1, 1, 2))
    assert one == again and one != other
    for r in one:
        assert len(str(r.colNumeric).replace(".", "")) == 38 and 1000 <= r.colBigint <= 9999
        assert 1.0 <= r.colReal <= 9.95 and 1 <= r.colDoublePrecision < 10 and len(r.colText) == 20 and r.colText.isalpha()


@pytest.mark.parametrize(
    "name, safe", [("a-b", "a_b"), ("1a", "_1a"), ("", "record"), ("---", "record"), ("über", "_ber"), ("ok_1", "ok_1"), ("a.b c", "a_b_c"), ("__", "record")]
)
def test_sanitize(spark, name, safe):
    assert tg.sanitize_name(name) == safe
    assert spark.createDataFrame([(name,)], "n string").select(sanitized(F.col("n"))).first()[0] == safe


def test_sanitize_collision(spark):
    with pytest.raises(ValueError, match="both become"):
        tg.sanitize_names(spark.createDataFrame([(1, 2)], "`a-b` int, `a.b` int"))


def test_append_prunes_null_columns(spark, envelope):
    spark.sql("CREATE TABLE app (id INT, a STRING, b STRING) USING parquet")
    try:
        spec = tg.discover(spark, ["app"])["app"]
        valid, _ = tg.split_valid(tg.plan_rows(envelope([("t", 0, 0, '{"id":1,"a":null}')]), spec), spec)
        assert tg.append(valid, "app", spec) == ["id"]
        empty, _ = tg.split_valid(tg.plan_rows(envelope([("t", 0, 0, "{}")]), spec), spec)
        assert tg.append(empty, "app", spec) == []
        assert [tuple(r) for r in spark.table("app").collect()] == [(1, None, None)]
    finally:
        spark.sql("DROP TABLE app")


def test_read_csv_header_only(spark, tmp_path):
    path = tmp_path / "empty.csv"
    path.write_text("a,b\n")
    assert read_csv(spark, str(path)).count() == 0
    assert tg.replay_csv(spark, str(path), "t", 5).count() == 0


def test_csv_rows_are_numbered_in_file_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id\n" + "\n".join(str(i) for i in range(3)) + "\n")
    (tmp_path / "b.csv").write_text("id\n" + "\n".join(str(i) for i in range(3, 4000)) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        log = tg.csv_to_topic_log(spark, str(tmp_path), "t")
        assert log.rdd.getNumPartitions() > 1
        assert [json.loads(bytes(r.value))["id"] for r in log.orderBy("offset").collect()] == [str(i) for i in range(4000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_table_names_are_quoted_part_by_part():
    from tidegate.operators.sinks import table_name

    assert table_name("my db.odd-name") == "`my db`.`odd-name`" and table_name("`a.b`.c") == "`a.b`.`c`"
