"""Streaming state, observed metrics, id sets, records of mixed kinds, and times in JSON."""

import datetime
import json
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate import (
    IngestConfig,
    IngestMetrics,
    TableSpec,
    bitmap_counts,
    discover,
    high_water,
    id_bitmaps,
    ingest_rate,
    merge_bitmaps,
    missing_from_bitmaps,
    plan_mixed,
    plan_rows,
    read_high_water,
    read_metrics,
    replay_csv_stream,
    start_high_water,
    start_ingest,
    stream_topic_log,
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_high_water_goes_on_from_its_state_and_never_back(spark, envelope, tmp_path):
    path, log = str(tmp_path / "ledger"), str(tmp_path / "log")
    assert read_high_water(spark, path).count() == 0
    rows = [("a", 0, 5), ("a", 0, 9), ("a", 1, 2), ("b", None, 4)], [("a", 0, 7), ("a", 1, 30), ("c", 0, 0)], [("b", None, 3)]
    for some in rows:
        envelope([(*r, "x") for r in some]).coalesce(1).write.mode("append").parquet(log)
        start_high_water(stream_topic_log(spark, log, 1), path, str(tmp_path / "ck"), available_now=True).awaitTermination()
    everything = high_water(spark.read.parquet(log))
    assert sorted(map(tuple, read_high_water(spark, path).collect())) == sorted(map(tuple, everything.collect()))
    # A batch writes the partitions it moved, not the state.
    assert spark.read.parquet(f"{path}/batch=1").count() < everything.count()


def test_metrics_come_from_the_write_and_name_failures(spark, envelope, tmp_path):
    spec = TableSpec.from_ddl("g", "id BIGINT NOT NULL")
    listener = IngestMetrics(spark, str(tmp_path / "metrics"))
    spark.streams.addListener(listener)
    try:
        log = str(tmp_path / "log")
        envelope([("g", 0, i, json.dumps({"id": i})) for i in range(5)] + [("g", 0, 5, "bad")]).coalesce(1).write.parquet(log)
        for tolerance, checkpoint in (("all", "a"), ("none", "b")):
            config = IngestConfig({"g": spec}, tolerance=tolerance)
            query = start_ingest(stream_topic_log(spark, log), config, str(tmp_path / "store"), str(tmp_path / checkpoint), available_now=True)
            try:
                query.awaitTermination()
            except StreamingQueryException:
                assert tolerance == "none"
        listener.wait(2)
    finally:
        spark.streams.removeListener(listener)
    rows = read_metrics(spark, str(tmp_path / "metrics"))
    assert sorted((r.records, r.landed, r.dead, r.bytes, r.ok) for r in rows.collect()) == [(0, 0, 0, 0, False), (6, 5, 1, 5 * 9 + 3, True)]
    assert [r.records for r in ingest_rate(rows, []).collect()] == [6]


@pytest.mark.parametrize("seed", range(3))
def test_bitmaps_are_sets(spark, seed):
    rng = random.Random(seed)
    parts = [[rng.choice([rng.randint(-70_000, 70_000), rng.randint(0, 50), 2**62, -(2**62)]) for _ in range(400)] for _ in range(3)]
    wanted = list(range(-40, 40)) + [32768, 32769, -32768, 65536, 2**62, 2**62 + 1]
    sets = [id_bitmaps(spark.createDataFrame([(i,) for i in (*p, None)], "id bigint"), "id") for p in parts]
    merged = merge_bitmaps(*sets)
    held = [i for p in parts for i in p]
    assert bitmap_counts(merged).first()[:] == (len(held), len(set(held)), len(held) - len(set(held)))
    expected = id_bitmaps(spark.createDataFrame([(i,) for i in wanted], "id bigint"), "id")
    assert sorted(r.id for r in missing_from_bitmaps(expected, merged).collect()) == sorted(set(wanted) - set(held))
    assert missing_from_bitmaps(merged, merged).count() == 0
    nothing = id_bitmaps(spark.createDataFrame([], "id bigint"), "id")
    assert bitmap_counts(nothing).first()[:] == (0, 0, 0) and missing_from_bitmaps(nothing, merged).count() == 0
    assert sorted(r.id for r in missing_from_bitmaps(expected, nothing).collect()) == sorted(set(wanted))


def test_bitmaps_shuffle_buckets_not_ids(spark):
    ids = spark.range(0, 1_000_000, 1, 8).toDF("id")
    text = plan(id_bitmaps(ids, "id"))
    assert text.count("Exchange") == 1 and "partial_bitmap_construct_agg" in text.split("Exchange")[1]


def test_records_of_mixed_kinds_are_read_once(spark, tmp_path):
    spec = TableSpec.from_ddl("t", "id BIGINT NOT NULL, at DATE")
    rows = [(1, '{"id": 1, "at": "2024-01-05"}', None), (2, '{"id": 2}', "v1"), (3, '{"id": 3}', "gone"), (4, "[1]", None), (5, None, "v1"), (6, '{"id": "x"}', None), (7, '{"ID": 7}', "v2"), (8, '{"id": 8, "at": 5}', "v1")]
    log = spark.createDataFrame(rows, "offset bigint, text string, schema_tag string").select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), "offset", F.current_timestamp().alias("timestamp"),
        F.lit(None).cast("binary").alias("key"), F.parse_json("text").alias("value"), "schema_tag",
    )
    log.write.parquet(str(tmp_path / "log"))
    schemas = {"v1": T.StructType.fromDDL("id int, at date"), "v2": T.StructType.fromDDL("ID bigint")}
    planned = plan_mixed(spark.read.parquet(str(tmp_path / "log")), spec, schemas)
    assert plan(planned).count("FileScan") == 1 and "Union" not in plan(planned)
    found = {r._src.offset: (r._error and r._error.reason, r.id, r.at) for r in planned.collect()}
    assert found[1] == (None, 1, datetime.date(2024, 1, 5)) and found[2] == (None, 2, None) and found[7] == (None, 7, None)
    assert {o: found[o][0] for o in (3, 4, 5, 6)} == {3: "no_converter", 4: "no_converter", 5: "no_converter", 6: "unparsable"}
    # Dead letters keep the record as JSON, typed or not.
    assert {r._src.offset: r._src.value for r in planned.where("_error is not null").collect()}[3] == b'{"id":3}'


@pytest.mark.parametrize("profile", ["sql", "binary"])
def test_times_and_bytes_in_json(spark, profile):
    utc = datetime.timezone.utc
    value = (datetime.date(1969, 12, 31), datetime.datetime(1969, 12, 31, 23, 59, 59, 999_500, utc), datetime.datetime(2024, 1, 1, 0, 0, 0, 1500), b"\x00\xff", [datetime.date(1970, 1, 2), None], {"k": datetime.date(1970, 1, 2)}, (None,))
    kinds = "d date, t timestamp, l timestamp_ntz, b binary, a array<date>, m map<string,date>, s struct<x:date>"
    df = spark.createDataFrame([("t", 0, 0, None, None, value), ("t", 0, 1, None, None, (None,) * 7)], f"topic string, partition int, offset bigint, timestamp timestamp, key binary, value struct<{kinds}>")
    names = ["d", "t", "l", "b", "a", "m", "s"]
    rows = plan_rows(df, TableSpec.from_ddl("t", ", ".join(f"{n} JSON" for n in names)), profile).orderBy("_src.offset").select(*names).collect()
    assert tuple(rows[0]) == ("-86400000", "-1", "1704067200001", '"AP8="', "[86400000,null]", '{"k":86400000}', '{"x":null}')
    assert tuple(rows[1]) == (None,) * 7


def test_catalog_defaults_are_discovered(spark):
    spark.sql("CREATE TABLE with_defaults (a BIGINT, b STRING DEFAULT upper('x')) USING parquet")
    try:
        assert [c.default for c in discover(spark, ["with_defaults"])["with_defaults"].columns] == [None, "upper('x')"]
    finally:
        spark.sql("DROP TABLE with_defaults")


def test_csv_stream_of_no_rows_gives_none(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("a,b\n")
    stream = replay_csv_stream(spark, str(tmp_path / "empty.csv"), "t", 10, str(tmp_path / "work"))
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.read.schema("topic string").parquet(str(tmp_path / "out")).count() == 0
