"""Strict coercion, per declared type and profile.

Every event becomes a record ``{"v": ...}`` whose attribute takes one of several JSON forms in turn, some of them
made from the event's own values. A case is (JSON text, expected value in sql, expected value in binary, reason in
sql, reason in binary); texts and expectations are SQL over the event columns that both engines understand.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from event_queries.common import as_log, bigint, event_log, micros, table
from tidegate import TableSpec, plan_rows, to_envelope
from tidegate.operators.decode import ERROR, SRC

NULL = "null"
BAD_TYPE, NOT_PARSED, TOO_BIG, NOT_ISO = "incompatible_type", "unparsable", "out_of_range", "not_iso"


class Case(NamedTuple):
    json: str
    sql: str = NULL
    binary: str = NULL
    sql_reason: str | None = None
    binary_reason: str | None = None


def same(json: str, value: str) -> Case:
    """Accepted alike by both profiles."""
    return Case(json, value, value)


def bad(json: str, reason: str) -> Case:
    """Refused alike by both profiles."""
    return Case(json, NULL, NULL, reason, reason)


USER, EVENT = "cast(user_id as varchar(20))", "cast(event_id as varchar(20))"
_MS = 1704067200000  # 2024-01-01T00:00:00Z
_TEXTUAL = [
    same(f"concat('\"u', {USER}, '\"')", f"concat('u', {USER})"),
    same("'\"\"'", "''"),
    same("'\"1.50\"'", "'1.50'"),
    same("'1.50'", "'1.5'"),
    same("'1e10'", "'1.0E10'"),
    same(EVENT, EVENT),
    same("'true'", "'true'"),
    same("'null'", NULL),
    same("'\"{x\"'", "'{x'"),
]

CASES: dict[str, tuple[str, list[Case]]] = {
    "integer": (
        "INTEGER",
        [
            same(USER, "user_id"),
            same(f"concat('\" ', {USER}, ' \"')", "user_id"),
            same("'\"+5\"'", "5"),
            bad("'1.0'", BAD_TYPE),
            bad("'3000000000'", TOO_BIG),
            bad("'\"3000000000\"'", TOO_BIG),
            bad("'\"1e3\"'", NOT_PARSED),
            bad("'true'", BAD_TYPE),
            bad("'[1]'", BAD_TYPE),
            bad("'\"\"'", NOT_PARSED),
            same("'null'", NULL),
        ],
    ),
    "bigint": (
        "BIGINT",
        [
            same(EVENT, "event_id"),
            same(f"concat('\"-', {EVENT}, '\"')", "-event_id"),
            same("'9223372036854775807'", "9223372036854775807"),
            bad("'12345678901234567890'", BAD_TYPE),
            bad("'\"9223372036854775808\"'", TOO_BIG),
            bad("'1.5'", BAD_TYPE),
            bad("'\"1.0\"'", NOT_PARSED),
            bad("'{\"a\":1}'", BAD_TYPE),
        ],
    ),
    "real": (
        "REAL",
        [
            same(f"concat({USER}, '.5')", "user_id + 0.5"),
            same(USER, "user_id"),
            same(f"concat('\"', {USER}, '.25 \"')", "user_id + 0.25"),
            same("'\"1.5f\"'", "1.5"),
            Case("'1e40'", "cast('Infinity' as double)", NULL, None, TOO_BIG),
            bad("'\"1,5\"'", NOT_PARSED),
            bad("'\"inf\"'", NOT_PARSED),
            bad("'false'", BAD_TYPE),
        ],
    ),
    "double": (
        "DOUBLE PRECISION",
        [
            same("cast(cast(value as decimal(12,2)) as varchar(20))", "value"),
            same(EVENT, "event_id"),
            same("'\" -1.5e3 \"'", "-1500"),
            same("'\".5\"'", "0.5"),
            same("'\"-Infinity\"'", "cast('-Infinity' as double)"),
            bad("'\"inf\"'", NOT_PARSED),
            bad("'\"infinity\"'", NOT_PARSED),
            bad("'\"1_0\"'", NOT_PARSED),
            bad("'[]'", BAD_TYPE),
            same("'null'", NULL),
        ],
    ),
    "decimal": (
        "NUMERIC(10,2)",
        [
            same("concat('\"', cast(cast(value as decimal(10,2)) as varchar(20)), '\"')", "cast(value as decimal(10,2))"),
            same("cast(cast(value as decimal(10,2)) as varchar(20))", "cast(value as decimal(10,2))"),
            same(USER, "user_id"),
            same("'\"-2.345\"'", "-2.35"),
            same("'2.344'", "2.34"),
            same("'\"1e3\"'", "1000"),
            bad("'\"123456789.00\"'", TOO_BIG),
            bad("'123456789'", TOO_BIG),
            bad("'\"12x\"'", NOT_PARSED),
            bad("'true'", BAD_TYPE),
        ],
    ),
    "boolean": (
        "BOOLEAN",
        [
            same("'true'", "true"),
            same("'false'", "false"),
            same("'\"T\"'", "true"),
            same("'\"False\"'", "false"),
            same("'\"0\"'", "false"),
            Case("'\" t \"'", NULL, "true", NOT_PARSED, None),
            Case("'1'", NULL, "true", BAD_TYPE, None),
            Case("'0.9'", NULL, "false", BAD_TYPE, None),
            Case(f"concat('2', {USER})", NULL, NULL, BAD_TYPE, TOO_BIG),
            bad("'\"yes\"'", NOT_PARSED),
        ],
    ),
    "text": ("TEXT", _TEXTUAL),
    "json": ("JSON", _TEXTUAL),
    "bytea": (
        "BYTEA",
        [
            same(f"concat('\"é', {USER}, '\"')", f"concat('é', {USER})"),
            same("'\"\"'", "''"),
            bad(USER, BAD_TYPE),
            bad("'{}'", BAD_TYPE),
            same("'null'", NULL),
        ],
    ),
    "date": (
        "DATE",
        [
            same(f"concat('1', {USER})", f"cast(concat('1', {USER}) as bigint)"),
            same("'\"2024-02-29\"'", "19782"),
            same("'19782.9'", "19782"),
            bad("'\"2023-02-29\"'", NOT_ISO),
            bad("'\"2024-1-5\"'", NOT_ISO),
            bad("'\" 2024-01-05\"'", NOT_ISO),
            bad("'\"2024-01-05T00:00:00\"'", NOT_ISO),
            bad("'true'", BAD_TYPE),
        ],
    ),
    "timestamp": (
        "TIMESTAMP",
        [
            same(f"cast({_MS} + event_id as varchar(20))", f"({_MS} + event_id) * 1000"),
            same(f"cast({_MS * 1000} + event_id as varchar(20))", f"{_MS * 1000} + event_id"),
            same("'\"2024-01-01T10:00:00\"'", f"{_MS * 1000} + 36000000000"),
            same("'\"2024-01-01 10:00:00.1234567Z\"'", f"{_MS * 1000} + 36000123456"),
            same("'\"2024-01-01t10:00:00z\"'", f"{_MS * 1000} + 36000000000"),
            same("'-1500'", "-1500000"),
            bad("'\"2024-01-01T10:00:00+02\"'", NOT_ISO),
            bad("'\"2024-01-01T10:00\"'", NOT_ISO),
            bad("'\"2024-02-30T10:00:00\"'", NOT_ISO),
            bad("'\"2024-01-01T24:00:00\"'", NOT_ISO),
            bad("'-9223372036854775807'", TOO_BIG),
            bad("'false'", BAD_TYPE),
        ],
    ),
    "timestamptz": (
        "TIMESTAMPTZ",
        [
            same(f"cast({_MS} + event_id as varchar(20))", f"({_MS} + event_id) * 1000"),
            same("'\"2024-01-01T10:00:00Z\"'", f"{_MS * 1000} + 36000000000"),
            same("'\"2024-01-01 10:00:00+05:30\"'", f"{_MS * 1000} + 16200000000"),
            same("'\"2024-01-01T10:00:00-02\"'", f"{_MS * 1000} + 43200000000"),
            Case(
                "'\"2024-01-01T10:00:00.1234565Z\"'",
                f"{_MS * 1000} + 36000123456",
                f"{_MS * 1000} + 36000123457",
            ),
            same("'\"2024-01-01T10:00:00.1234564Z\"'", f"{_MS * 1000} + 36000123456"),
            bad("'\"2024-01-01T10:00:00\"'", NOT_ISO),
            bad("'\"2024-01-01T10:00:00+19\"'", NOT_ISO),
            bad("'\"2024-01-01T10:00:00+5\"'", NOT_ISO),
            bad("'[1]'", BAD_TYPE),
        ],
    ),
}

# How a value of each type is shown, so that both engines print the same: (Spark column, type in the oracle).
_SHOWN = {
    "integer": (bigint, "bigint"),
    "bigint": (bigint, "bigint"),
    "real": (lambda c: F.col(c).cast("double"), "double"),
    "double": (F.col, "double"),
    "decimal": (lambda c: F.col(c).cast("string"), "decimal(10,2)"),
    "boolean": (F.col, "boolean"),
    "text": (F.col, "varchar"),
    "json": (F.col, "varchar"),
    "bytea": (lambda c: F.lower(F.hex(c)), "hex"),
    "date": (lambda c: F.unix_date(c).cast("bigint"), "bigint"),
    "timestamp": (micros, "bigint"),
    "timestamptz": (micros, "bigint"),
}


def _spark_query(kind: str):
    declared, cases = CASES[kind]
    branches = " ".join(f"WHEN {i} THEN {c.json}" for i, c in enumerate(cases))

    def run(spark: SparkSession, sf: str) -> DataFrame:
        value = F.expr(f"concat('{{\"v\":', CASE event_id % {len(cases)} {branches} END, '}}')")
        log = as_log(table(spark, sf, "events"), value)
        spec = TableSpec.from_ddl("t", f"v {declared}")
        show = _SHOWN[kind][0]
        judged = [
            plan_rows(log, spec, profile).select(
                F.col(f"{SRC}.offset").alias("event_id"),
                F.lit(profile).alias("profile"),
                show("v").alias("value"),
                F.col(f"{ERROR}.reason").alias("reason"),
            )
            for profile in ("sql", "binary")
        ]
        return judged[0].unionAll(judged[1])

    return run


def _oracle(kind: str) -> str:
    _, cases = CASES[kind]
    shown = _SHOWN[kind][1]

    def value(expr: str) -> str:
        if shown == "hex":
            return f"lower(hex(encode({expr})))" if expr != NULL else "null"
        if shown.startswith("decimal"):
            return f"cast(cast({expr} as {shown}) as varchar)"
        return f"cast({expr} as {shown})"

    selects = []
    for profile in ("sql", "binary"):
        values = " ".join(f"when {i} then {value(getattr(c, profile))}" for i, c in enumerate(cases))
        reasons = " ".join(
            f"when {i} then '{r}'" for i, c in enumerate(cases) if (r := getattr(c, f"{profile}_reason")) is not None
        )
        key = f"event_id % {len(cases)}"
        why = f"case {key} {reasons} end" if reasons else "cast(null as varchar)"
        selects.append(
            f"select event_id, '{profile}' as profile, case {key} {values} end as value, {why} as reason from events"
        )
    return " union all ".join(selects)


def timestamp_magnitude(spark: SparkSession, sf: str) -> DataFrame:
    """The event time as an epoch number, in milliseconds for even events and microseconds for odd ones."""
    events = table(spark, sf, "events")
    at = micros("ts")
    number = F.when(F.col("event_id") % 2 == 0, F.floor(at / 1000)).otherwise(at)
    log = as_log(events, F.to_json(F.struct(number.alias("at"), number.alias("tz"))))
    spec = TableSpec.from_ddl("t", "at TIMESTAMP, tz TIMESTAMPTZ")
    return plan_rows(log, spec).select(F.col(f"{SRC}.offset").alias("event_id"), micros("at").alias("at"), micros("tz").alias("tz"))


def decimal_half_up(spark: SparkSession, sf: str) -> DataFrame:
    """Two-digit values with a third digit 5 appended, positive and negative, rounded to two digits."""
    text = F.concat(F.col("value").cast("decimal(12,2)").cast("string"), F.lit("5"))
    signed = F.when(F.col("event_id") % 2 == 0, text).otherwise(F.concat(F.lit("-"), text))
    log = as_log(table(spark, sf, "events"), F.to_json(F.struct(signed.alias("v"))))
    rows = plan_rows(log, TableSpec.from_ddl("t", "v NUMERIC(12,2)"), "binary")
    return rows.select(F.col(f"{SRC}.offset").alias("event_id"), F.col("v").cast("string").alias("v"))


# --- arrays: each embedding, in thousandths, as an array of the element type ------------------------------------

# A float factor: Spark takes float times integer as a double, SQL as a float, and just below a whole number their floors differ.
_THOUSANDTH = "cast(floor(x * 1000F) as bigint)"
# (declared element, element as JSON text in Spark, sum of landed elements in Spark, the same in the oracle)
ARRAYS = {
    "integer": ("INTEGER", "cast(n as string)", "cast(e as bigint)", "n"),
    "bigint": ("BIGINT", "concat('\"', n * 10000000000, '\"')", "e", "n * 10000000000"),
    "real": ("REAL", "concat(n, '.5')", "cast(e * 2 as bigint)", "case when n < 0 then 2 * n - 1 else 2 * n + 1 end"),
    "double": ("DOUBLE PRECISION", "concat(n, '.25')", "cast(e * 4 as bigint)", "case when n < 0 then 4 * n - 1 else 4 * n + 1 end"),
    "numeric": ("NUMERIC(12,1)", "concat('\"', n, '.05\"')", "cast(e * 10 as bigint)", "case when n < 0 then 10 * n - 1 else 10 * n + 1 end"),
    "text": ("TEXT", "concat('\"', n, '\"')", "cast(length(e) as bigint)", "length(cast(n as varchar))"),
    "boolean": ("BOOLEAN", "cast(n > 0 as string)", "if(e, 1L, 0L)", "case when n > 0 then 1 else 0 end"),
    "bytea": ("BYTEA", "concat('\"', n, '\"')", "cast(octet_length(e) as bigint)", "length(cast(n as varchar))"),
    "date": ("DATE", "cast(n + 20000 as string)", "cast(unix_date(e) as bigint)", "n + 20000"),
    "timestamp": (
        "TIMESTAMP", "cast(n + 1704067200000 as string)", "unix_seconds(cast(e as timestamp)) - 1704067200",
        "cast(floor(n / 1000) as bigint)",
    ),
    "timestamptz": (
        "TIMESTAMPTZ", "if(n % 2 = 0, '\"2024-01-01T00:00:01+00\"', '1704067200000')", "unix_seconds(e) - 1704067200",
        "case when n % 2 = 0 then 1 else 0 end",
    ),
    "nested": ("ARRAY(INTEGER)", "concat('[', n, ',null]')", "cast(e[0] as bigint)", "n"),
}


def _array_query(kind: str, profile: str = "binary"):
    declared, text, shown, _ = ARRAYS[kind]

    def run(spark: SparkSession, sf: str) -> DataFrame:
        vectors = table(spark, sf, "embeddings").where("embedding is not null")
        parts = F.expr(f"transform(transform(embedding, x -> {_THOUSANDTH}), n -> {text})")
        # Every seventh record ends in an object no element type takes, every fifth in a null that stays.
        tail = F.expr("CASE WHEN vec_id % 7 = 0 THEN array('{\"no\":1}') WHEN vec_id % 5 = 0 THEN array('null') ELSE array() END")
        if kind in ("text",):
            tail = F.expr("CASE WHEN vec_id % 5 = 0 AND vec_id % 7 > 0 THEN array('null') ELSE array() END")
        payload = F.concat(F.lit('{"a":['), F.array_join(F.concat(parts, tail), ","), F.lit("]}"))
        log = to_envelope(vectors, F.lit("vectors"), F.col("label"), F.col("vec_id"), payload)
        rows = plan_rows(log, TableSpec.from_ddl("t", f"a ARRAY({declared})"), profile)
        total = F.expr(f"aggregate(filter(a, e -> e is not null), 0L, (s, e) -> s + {shown})")
        return rows.select(
            F.col(f"{SRC}.offset").alias("vec_id"),
            F.col(f"{ERROR}.reason").alias("reason"),
            bigint(F.size("a")).alias("elements"),
            total.alias("total"),
        )

    return run


def _array_oracle(kind: str) -> str:
    expected = ARRAYS[kind][3]
    fails = "false" if kind == "text" else "vec_id % 7 = 0"
    null_tail = "vec_id % 5 = 0 and vec_id % 7 > 0" if kind == "text" else "vec_id % 5 = 0"
    return f"""select vec_id, case when {fails} then 'incompatible_type' end as reason,
        case when not ({fails}) then len(embedding) + case when {null_tail} then 1 else 0 end end as elements,
        case when not ({fails}) then cast(list_sum(list_transform(list_transform(embedding,
            lambda x: cast(floor(x * 1000) as bigint)), lambda n: {expected})) as bigint) end as total from embeddings"""


def json_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """A nested object landing in TEXT and in JSON columns, read back out of the stored text."""
    nested = F.struct(F.col("event_id"), F.array("user_id", F.lit(None).cast("bigint")).alias("ids"), F.struct("event_type").alias("t"))
    events = table(spark, sf, "events")
    log = as_log(events, F.to_json(F.struct(nested.alias("doc"), nested.alias("txt")), {"ignoreNullFields": "false"}))
    rows = plan_rows(log, TableSpec.from_ddl("t", "doc JSON, txt TEXT"))
    return rows.select(
        F.get_json_object("doc", "$.event_id").cast("bigint").alias("event_id"),
        F.get_json_object("doc", "$.ids[0]").cast("bigint").alias("user_id"),
        F.get_json_object("txt", "$.t.event_type").alias("event_type"),
        bigint(F.json_array_length(F.get_json_object("txt", "$.ids"))).alias("ids"),
    )


def payload_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Every event column as a JSON number or string, through both profiles, back to the column it came from."""
    spec = TableSpec.from_ddl("t", "event_id BIGINT NOT NULL, user_id INTEGER, value NUMERIC(12,2), ts TIMESTAMP")
    out = []
    for profile in ("sql", "binary"):
        rows = plan_rows(event_log(spark, sf), spec, profile).where(F.col(ERROR).isNull())
        out.append(
            rows.select(
                F.lit(profile).alias("profile"), "event_id", bigint("user_id").alias("user_id"),
                F.col("value").cast("string").alias("value"), micros("ts").alias("ts"),
            )
        )
    return out[0].unionAll(out[1])


QUERIES = {f"coerce_{k}": _spark_query(k) for k in CASES}
QUERIES |= {f"coerce_array_{k}": _array_query(k) for k in ARRAYS}
QUERIES |= {f"coerce_array_{k}_sql": _array_query(k, "sql") for k in ARRAYS}
QUERIES |= {
    "coerce_timestamp_magnitude": timestamp_magnitude,
    "decimal_half_up": decimal_half_up,
    "json_round_trip": json_round_trip,
    "coerce_event_columns": payload_numbers,
}

_EVENT_COLUMNS = """select '{p}' as profile, event_id, user_id, cast(cast(value as decimal(12,2)) as varchar) as value,
    epoch_us(ts) as ts from events"""
ORACLES = {f"coerce_{k}": _oracle(k) for k in CASES}
ORACLES |= {f"coerce_array_{k}": _array_oracle(k) for k in ARRAYS}
ORACLES |= {f"coerce_array_{k}_sql": _array_oracle(k) for k in ARRAYS}
ORACLES |= {
    "coerce_timestamp_magnitude": """select event_id, n as "at", n as tz from (select event_id,
        case when event_id % 2 = 0 then epoch_us(ts) // 1000 * 1000 else epoch_us(ts) end as n from events)""",
    "decimal_half_up": """select event_id, cast(case when event_id % 2 = 0 then 1 else -1 end
        * (cast(value as decimal(12,2)) + cast(0.01 as decimal(12,2))) as varchar) as v from events""",
    "json_round_trip": "select event_id, user_id, event_type, cast(2 as bigint) as ids from events",
    "coerce_event_columns": _EVENT_COLUMNS.format(p="sql") + " union all " + _EVENT_COLUMNS.format(p="binary"),
}
