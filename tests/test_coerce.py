"""Coercion of schemaless and typed attributes: accepted values, refused values and their reasons."""

import datetime as dt
import decimal
import json
import math

import duckdb
import numpy as np
import pytest
from hypothesis import given as sampled
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from event_queries import coercion
from oracle import compare
from tidegate import Declared, SchemaError, TableSpec, cast_fields, decode_json, plan_rows, resolve_columns

D = decimal.Decimal
UTC = dt.timezone.utc
ALL = TableSpec.from_ddl(
    "t",
    """i INTEGER, b BIGINT, r REAL, d DOUBLE PRECISION, n NUMERIC(10,2), o BOOLEAN, t TEXT, y BYTEA, dt DATE,
    ts TIMESTAMP, tz TIMESTAMPTZ, j JSON, ai ARRAY(INTEGER), ab ARRAY(BIGINT), ar ARRAY(REAL), ad DOUBLE PRECISION[],
    an ARRAY(NUMERIC(10,2)), at TEXT[], ao ARRAY(BOOLEAN), ay ARRAY(BYTEA), add ARRAY(DATE), ats ARRAY(TIMESTAMP),
    atz ARRAY(TIMESTAMPTZ), aa ARRAY(ARRAY(INTEGER))""",
)
FRAGMENTS = """1|-0|0|1.0|1.5|1e2|0.1|1e40|1e400|3000000000|9223372036854775807|12345678901234567890|true|false|null
"1"|" 1 "|"+1"|"1.0"|"1.50"|"1e3"|"NaN"|"nan"|"Infinity"|"-Infinity"|"inf"|".5"|"5."|"1f"|"0x10"|""|" "|"t"|"F"|"TRUE"
" t "|"yes"|"abc"|"123456789012"|"2024-01-05"|"2024-1-5"|"2024-01-05 "|"2024-02-30"|"2024-01-01T10:00:00"
"2024-01-01 10:00:00.123456789Z"|"2024-01-01T10:00:00+05:30"|"2024-01-01T10:00:00.9999995-02"|"2024-01-01T10:00:00\\n"
{}|{"a":1.50}|"{}"|[]|[1]|[1,null]|[1.5,2]|["1","x"]|[true]|[[1],[null]]|[3000000000]|["2024-01-01",19000]|[1,"a",{}]|[null]
19000|1704067200000|1704067200000000|-1500|10000000000000|10000000000001|-9223372036854775808|2147483648|"é"|"a\\"b"
1.0000000000000001|123456789.125|"123456789.125"|"-2.345"|"2.344999"|[1e400]|["NaN"]|"1_0"|"٣"|"1,5"|"0001-01-01T00:00:00Z"|"\\"q"
"""
FRAGMENTS = [f for line in FRAGMENTS.splitlines() for f in line.split("|")]


def records(envelope, names, fragments):
    values = [f'{{"{n}":{f}}}' for n in names for f in fragments]
    return envelope([("t", 0, i, v) for i, v in enumerate(values)]), [(n, f) for n in names for f in fragments]


def shown(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, list):
        return [shown(x) for x in v]
    return bytes(v) if isinstance(v, bytearray) else v


def outcome(df, spec):
    """offset → (error or None, values of the row)."""
    # Dates as text: Spark holds years that Python does not.
    calendar = {c.name for c in spec.columns if "date" in str(c.declared) or "time" in str(c.declared)}
    columns = [F.col(n).cast("array<string>" if n.startswith("a") else "string").alias(n) if n in calendar else n for n in spec.names]
    rows = df.select("_src.offset", "_error", *columns).collect()
    return {
        r["offset"]: (tuple(r["_error"]) if r["_error"] else None, [shown(r[n]) for n in spec.names] if not r["_error"] else None)
        for r in rows
    }


@pytest.fixture(scope="module")
def results(spark):
    """profile → (column, fragment) → (reason, value), by the general route; both routes must agree."""
    from tidegate import ENVELOPE

    def build(rows):
        return spark.createDataFrame([(t, p, o, None, None, bytearray(v, "utf-8")) for t, p, o, v in rows], ENVELOPE)

    log, labels = records(build, ALL.names, FRAGMENTS)
    out = {}
    for profile in ("sql", "binary"):
        general = outcome(resolve_columns(decode_json(log, ALL), ALL, profile), ALL)
        usual = outcome(plan_rows(log, ALL, profile), ALL)
        assert {k: v for k, v in general.items() if usual[k] != v} == {}
        out[profile] = {}
        for i, (name, fragment) in enumerate(labels):
            error, values = general[i]
            if error:
                assert error[0] == name
            out[profile][name, fragment] = (error[2], None) if error else (None, values[ALL.names.index(name)])
    return out


def ts(*args):
    return dt.datetime(*args)


def as_text(v):
    if isinstance(v, list):
        return [as_text(x) for x in v]
    return str(v) if isinstance(v, (dt.date, dt.datetime)) else v


ACCEPTED = [
    # column, fragment, value in both profiles
    ("i", "1", 1), ("i", '" 1 "', 1), ("i", '"+1"', 1), ("i", "-0", 0), ("i", "null", None),
    ("b", "9223372036854775807", 2**63 - 1), ("b", '"123456789012"', 123456789012),
    ("r", "1", 1.0), ("r", "1.5", 1.5), ("r", '"1f"', 1.0), ("r", '"NaN"', "nan"), ("r", '"-Infinity"', -math.inf),
    ("d", "1", 1.0), ("d", "1e40", 1e40), ("d", "1e400", math.inf), ("d", '".5"', 0.5), ("d", '"5."', 5.0),
    ("n", "0.1", D("0.10")), ("n", '"-2.345"', D("-2.35")), ("n", '"2.344999"', D("2.34")), ("n", '"1e3"', D("1000.00")),
    ("n", "1", D("1.00")), ("n", "1e2", D("100.00")),
    ("o", "true", True), ("o", '"t"', True), ("o", '"F"', False), ("o", '"TRUE"', True), ("o", '"1"', True),
    ("t", "1.0", "1.0"), ("t", "1.5", "1.5"), ("t", '"1.50"', "1.50"), ("t", "1e2", "100.0"), ("t", "true", "true"),
    ("t", '{"a":1.50}', '{"a":1.5}'), ("t", '"{}"', "{}"), ("t", "[1,null]", "[1,null]"), ("t", "-0", "0"), ("t", '""', ""),
    ("j", "[]", "[]"), ("j", '"abc"', "abc"), ("j", "1e40", "1.0E40"),
    ("y", '"é"', "é".encode()), ("y", '""', b""),
    ("dt", "19000", dt.date(2022, 1, 8)), ("dt", '"2024-01-05"', dt.date(2024, 1, 5)), ("dt", "1.5", dt.date(1970, 1, 2)),
    ("ts", "1704067200000", ts(2024, 1, 1)), ("ts", "1704067200000000", ts(2024, 1, 1)),
    ("ts", "-1500", "1969-12-31 23:59:58.5"),
    ("ts", "10000000000000", ts(2286, 11, 20, 17, 46, 40)), ("ts", "10000000000001", ts(1970, 4, 26, 17, 46, 40, 1)),
    ("ts", '"2024-01-01 10:00:00.123456789Z"', ts(2024, 1, 1, 10, 0, 0, 123456)),
    ("ai", "[1,null]", [1, None]), ("ai", "[]", []), ("ai", "[null]", [None]), ("ab", "[3000000000]", [3000000000]),
    ("ar", "[1.5,2]", [1.5, 2.0]), ("ad", "[1.5,2]", [1.5, 2.0]), ("ad", "[1e400]", [math.inf]),
    ("an", "[1.5,2]", [D("1.50"), D("2.00")]), ("at", '["1","x"]', ["1", "x"]), ("ao", "[true]", [True]),
    ("ay", '["1","x"]', [b"1", b"x"]), ("aa", "[[1],[null]]", [[1], [None]]),
    ("add", '["2024-01-01",19000]', [dt.date(2024, 1, 1), dt.date(2022, 1, 8)]), ("at", "[1,null]", ["1", None]),
]
REFUSED = [
    # column, fragment, reason in both profiles
    ("i", "1.0", "incompatible_type"), ("i", "3000000000", "out_of_range"), ("i", '"1.0"', "unparsable"),
    ("i", '""', "unparsable"), ("i", "true", "incompatible_type"), ("i", "[1]", "incompatible_type"),
    ("b", "12345678901234567890", "incompatible_type"), ("b", '"1e3"', "unparsable"),
    ("d", '"inf"', "unparsable"), ("d", '"nan"', "unparsable"), ("d", '"1_0"', "unparsable"), ("d", "{}", "incompatible_type"),
    ("n", '"123456789.125"', "out_of_range"), ("n", "3000000000", "out_of_range"), ("n", '"abc"', "unparsable"),
    ("o", '"yes"', "unparsable"), ("y", "1", "incompatible_type"),
    ("dt", '"2024-1-5"', "not_iso"), ("dt", '"2024-02-30"', "not_iso"), ("dt", '"2024-01-05 "', "not_iso"),
    ("ts", '"2024-01-01T10:00:00+05:30"', "not_iso"), ("ts", '"2024-01-01T10:00:00\\n"', "not_iso"),
    ("ts", "-9223372036854775808", "out_of_range"), ("tz", '"2024-01-01T10:00:00"', "not_iso"),
    ("ai", "[3000000000]", "out_of_range"), ("ai", "1", "incompatible_type"), ("ai", '[1,"a",{}]', "unparsable"),
    ("ab", "[1.5,2]", "incompatible_type"), ("aa", "[1]", "incompatible_type"), ("ats", '["1","x"]', "not_iso"),
]
DIFFERENT = [
    # column, fragment, (reason, value) in sql, (reason, value) in binary
    ("o", "1", ("incompatible_type", None), (None, True)),
    ("o", "1.5", ("incompatible_type", None), (None, True)),
    ("o", "0.1", ("incompatible_type", None), (None, False)),
    ("o", "3000000000", ("incompatible_type", None), ("out_of_range", None)),
    ("o", '" t "', ("unparsable", None), (None, True)),
    ("r", "1e40", (None, math.inf), ("out_of_range", None)),
]


def test_accepted(results):
    for profile in ("sql", "binary"):
        got = {(c, f): results[profile][c, f] for c, f, _ in ACCEPTED}
        assert got == {(c, f): (None, as_text(v)) for c, f, v in ACCEPTED}


def test_refused(results):
    for profile in ("sql", "binary"):
        got = {(c, f): results[profile][c, f] for c, f, _ in REFUSED}
        assert got == {(c, f): (r, None) for c, f, r in REFUSED}


def test_profiles_differ(results):
    for c, f, sql, binary in DIFFERENT:
        assert (results["sql"][c, f], results["binary"][c, f]) == (sql, binary), (c, f)


def test_half_microseconds_round_up_in_binary_only(spark, envelope):
    spec = TableSpec.from_ddl("t", "tz TIMESTAMPTZ")
    log = envelope([("t", 0, 0, '{"tz":"2024-01-01T00:00:00.9999995+00:00"}')])
    got = {
        p: plan_rows(log, spec, p).select(F.unix_micros("tz")).first()[0] - 1704067200 * 10**6 for p in ("sql", "binary")
    }
    assert got == {"sql": 999999, "binary": 1000000}


@settings(max_examples=5, deadline=None)
@sampled(
    st.lists(
        st.recursive(
            st.none() | st.booleans() | st.integers(-(2**70), 2**70) | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=8),
            lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(max_size=3), inner, max_size=2),
            max_leaves=4,
        ),
        min_size=1,
        max_size=40,
    )
)
def test_routes_agree_on_any_json(spark, values):
    from tidegate import ENVELOPE

    names = ALL.names
    rows = [
        ("t", 0, i * len(names) + k, None, None, bytearray(json.dumps({n: v}, ensure_ascii=bool(i % 2)), "utf-8", "surrogatepass"))
        for i, v in enumerate(values)
        for k, n in enumerate(names)
    ]
    log = spark.createDataFrame(rows, ENVELOPE)
    for profile in ("sql", "binary"):
        general = outcome(resolve_columns(decode_json(log, ALL), ALL, profile), ALL)
        assert outcome(plan_rows(log, ALL, profile), ALL) == general


TYPED = [
    # Spark type of the attribute, value, column, (accepted in sql, accepted in binary)
    ("int", 5, "i", (5, 5)), ("bigint", 5, "i", ("incompatible_type", 5)), ("bigint", 2**40, "i", ("incompatible_type", "out_of_range")),
    ("string", " 5", "i", (5, 5)), ("double", 5.0, "i", ("incompatible_type", "incompatible_type")),
    ("int", 5, "b", (5, 5)), ("boolean", True, "b", ("incompatible_type", "incompatible_type")),
    ("int", 5, "r", (5.0, 5.0)), ("bigint", 5, "r", ("incompatible_type", 5.0)), ("double", 0.5, "r", ("incompatible_type", 0.5)),
    ("double", 1e40, "r", ("incompatible_type", "out_of_range")), ("float", 0.5, "r", (0.5, 0.5)),
    ("int", 5, "d", (5.0, 5.0)), ("decimal(10,2)", D("1.25"), "d", (1.25, 1.25)), ("string", "1.5", "d", (1.5, 1.5)),
    ("decimal(20,3)", D("-2.345"), "n", (D("-2.35"), D("-2.35"))), ("decimal(20,3)", D("123456789.125"), "n", ("out_of_range",) * 2),
    ("bigint", 7, "n", (D("7.00"),) * 2), ("double", 0.125, "n", (D("0.13"),) * 2), ("binary", b"x", "n", ("incompatible_type",) * 2),
    ("boolean", True, "o", (True, True)), ("int", 1, "o", ("incompatible_type", True)), ("int", 2, "o", ("incompatible_type", "out_of_range")),
    ("string", "T", "o", (True, True)),
    ("int", 5, "t", ("5", "5")), ("double", 1e10, "t", ("1.0E10", "1.0E10")), ("struct<a:int,b:string>", (1, None), "t", ('{"a":1,"b":null}',) * 2),
    ("map<string,int>", {"k": 1}, "j", ('{"k":1}',) * 2), ("array<int>", [1, None], "j", ("[1,null]",) * 2),
    ("binary", b"\x00\xff", "y", (b"\x00\xff",) * 2), ("binary", b"", "y", (b"",) * 2), ("string", "é", "y", ("é".encode(),) * 2), ("int", 1, "y", ("incompatible_type",) * 2),
    ("date", dt.date(2024, 1, 5), "dt", (dt.date(2024, 1, 5),) * 2), ("int", 19000, "dt", ("incompatible_type", dt.date(2022, 1, 8))),
    ("timestamp", dt.datetime(2024, 1, 5, 23, tzinfo=UTC), "dt", (dt.date(2024, 1, 5),) * 2), ("string", "2024-1-5", "dt", ("not_iso",) * 2),
    ("timestamp", dt.datetime(2024, 1, 5, 1, 2, 3, 4, tzinfo=UTC), "ts", (ts(2024, 1, 5, 1, 2, 3, 4),) * 2),
    ("timestamp_ntz", ts(2024, 1, 5), "ts", (ts(2024, 1, 5),) * 2), ("date", dt.date(2024, 1, 5), "ts", (ts(2024, 1, 5),) * 2),
    ("bigint", 1704067200000, "ts", (ts(2024, 1, 1),) * 2), ("int", 1000, "ts", ("incompatible_type", ts(1970, 1, 1, 0, 0, 1))),
    ("array<bigint>", [1, None], "ab", ([1, None],) * 2), ("array<bigint>", [1, None], "ai", ([1, None],) * 2), ("array<string>", ["1", "x"], "ai", ("unparsable",) * 2),
    ("array<double>", [0.5, None], "ar", ([0.5, None],) * 2), ("array<array<int>>", [[1], None], "aa", ([[1], None],) * 2), ("int", 1, "ai", ("incompatible_type",) * 2),
    ("array<date>", [dt.date(2024, 1, 5)], "add", ([dt.date(2024, 1, 5)],) * 2), ("array<int>", [19000], "add", ("incompatible_type", [dt.date(2022, 1, 8)])),
    ("array<bigint>", [1704067200000], "ats", ([ts(2024, 1, 1)],) * 2), ("array<binary>", [b"", None], "ay", ([b"", None],) * 2),
]


def test_typed_records(spark):
    """All cases in one record: case k is attribute ``c<k>`` of a table with column ``c<k>``."""
    columns = {c.name: c.declared for c in ALL.columns}
    from tidegate import ColumnSpec

    for at, profile in enumerate(("sql", "binary")):
        got = []
        for k, (spark_type, value, column, _) in enumerate(TYPED):
            spec = TableSpec("t", (ColumnSpec(f"c{k}", columns[column]),))
            got.append((spark_type, value, f"C{k}", spec))
        schema = "topic string, partition int, offset bigint, timestamp timestamp, key binary, value struct<" + ",".join(
            f"{n}:{t}" for t, _, n, _ in got
        ) + ">"
        row = ("t", 0, 0, None, None, tuple(v for _, v, _, _ in got))
        df = spark.createDataFrame([row], schema)
        # One table per column, so that every column reports its own error; all in one job.
        frames = [
            plan_rows(df, spec, profile).selectExpr(f"{k} AS k", "_error.reason", f"struct(c{k}) AS v")
            for k, (_, _, _, spec) in enumerate(got)
        ]
        by_type = {}
        for frame in frames:
            key = str(frame.schema["v"].dataType[0].dataType)
            frame = frame.selectExpr("k", "reason", "v.* ").toDF("k", "reason", "v")
            by_type[key] = by_type[key].unionAll(frame) if key in by_type else frame
        for frame in by_type.values():
            for r in frame.collect():
                actual = r["reason"] if r["reason"] is not None else shown(r["v"])
                assert actual == TYPED[r["k"]][3][at], (profile, TYPED[r["k"]], r)


def test_typed_timestamptz_takes_logical_values_in_binary_only(spark):
    schema = "topic string, partition int, offset bigint, timestamp timestamp, key binary, value struct<v:timestamp>"
    df = spark.createDataFrame([("t", 0, 0, None, None, (dt.datetime(2024, 1, 1, tzinfo=UTC),))], schema)
    spec = TableSpec.from_ddl("t", "v TIMESTAMPTZ")
    got = {p: plan_rows(df, spec, p).select("_error.reason", F.unix_seconds("v").alias("v")).first() for p in ("sql", "binary")}
    assert got["sql"].reason == "incompatible_type" and got["binary"].v == 1704067200


def test_cast_fields(spark, envelope):
    spec = TableSpec.from_ddl("t", "a INTEGER, b TEXT")
    rows = [("x1", 0, 0, '{"a":1.9,"b":5}'), ("x1", 0, 1, '{"a":70000,"b":5}'), ("y", 0, 2, '{"a":7,"b":5}'), ("x1", 0, 3, '{"a":"12","b":null}')]
    decoded = cast_fields(decode_json(envelope(rows), spec), {"x.*": {"a": "int16", "b": "string", "zz": "int8"}})
    got = {r["offset"]: (r["reason"], r["a"], r["b"]) for r in resolve_columns(decoded, spec).select("_src.offset", "_error.reason", "a", "b").collect()}
    assert got == {0: (None, 1, "5"), 1: ("unparsable", None, "5"), 2: (None, 7, "5"), 3: (None, 12, None)}


@pytest.mark.parametrize(
    "text, expected",
    [
        ("INT", "integer"), ("int4", "integer"), ("Long", "bigint"), ("float", "double"), ("FLOAT(10)", "double"), ("float4", "real"),
        ("double  precision", "double"), ("numeric", "decimal(38,9)"), ("DECIMAL(10)", "decimal(10,0)"), ("Numeric( 12 , 3 )", "decimal(12,3)"),
        ("ARRAY(TEXT NULL)", "array(text)"), ("ARRAY(TEXT NOT NULL)", "array(text)"), ("INTEGER[]", "array(integer)"),
        ("array(array(numeric(5,2)))", "array(array(decimal(5,2)))"),
    ],
)
def test_declared_types(text, expected):
    assert str(Declared.parse(text)) == expected


@pytest.mark.parametrize("text", ["struct", "GEOGRAPHY", "array(struct)", "varchar", "interval", "text(5)", "numeric(50,2)"])
def test_unsupported_types(text):
    with pytest.raises(SchemaError):
        Declared.parse(text)


@pytest.mark.parametrize("kind", ["integer", "double", "numeric", "nested"])
def test_array_queries_round_elements_as_floats(spark, tmp_path, kind):
    """Elements whose thousandfold is a whole number as a float, and just below it as a double."""
    near = [x for x in (np.float32(k / 1000) for k in range(1, 1000)) if np.floor(x * np.float32(1000)) != np.floor(float(x) * 1000)]
    assert near
    rows = [(i, [float(x), float(-x)], 0) for i, x in enumerate(near[:20])]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    for name in (f"coerce_array_{kind}", f"coerce_array_{kind}_sql"):
        assert compare(spark, con, str(tmp_path), coercion.QUERIES[name], coercion.ORACLES[name]) is None
