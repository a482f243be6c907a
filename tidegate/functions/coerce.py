"""Strict type coercion as Catalyst expressions.

``coerce`` gives two expressions for one attribute: the value in the declared type (NULL when it does not fit)
and the reason it does not fit. The reason is only meaningful, and only evaluated, where an attribute was given
and its value came out NULL; keeping it apart lets the hot path compute nothing but values.

Two profiles exist because the two sink modes accept different inputs:

* ``sql``: what the row-insert mode accepts;
* ``binary``: what the columnar mode accepts.

Attributes of schemaless records are VARIANT and are judged by the type tag of each value. Attributes of typed
records are judged once, by their Spark type, while the plan is built.

Expressions are Spark SQL text. A table of hundreds of columns needs tens of thousands of expression nodes, and
micro-batches are planned afresh each time: text reaches the JVM in one call per projection, Column objects would
take one call per node.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

from . import grammar as G
from .names import quote
from .types import ColumnSpec, Declared

PROFILES = ("sql", "binary")

INCOMPATIBLE = "incompatible_type"
UNPARSABLE = "unparsable"
OUT_OF_RANGE = "out_of_range"
NOT_ISO = "not_iso"

_NUMERIC = ("integer", "bigint", "real", "double", "decimal")
_SMALL = (T.ByteType, T.ShortType, T.IntegerType)
_FRACTION = (T.FloatType, T.DoubleType, T.DecimalType)
_NESTED = (T.StructType, T.MapType, T.ArrayType)
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)
_IN_JSON = (T.BinaryType, *_TIMES)
_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


class Coerced(NamedTuple):
    value: str
    reason: str


def coerce(raw: str, source: T.DataType, declared: Declared, profile: str, depth: int = 0) -> Coerced:
    """Coerce the expression ``raw``, of Spark type ``source``, to ``declared`` under ``profile``."""
    if profile not in PROFILES:
        raise ValueError(f"Unknown profile '{profile}', expected one of {', '.join(PROFILES)}")
    if isinstance(source, T.NullType):
        return Coerced(_null(declared), text(INCOMPATIBLE))
    if declared.kind == "array":
        if isinstance(source, T.VariantType):
            return _variant_array(raw, declared, profile, depth)
        return _typed_array(raw, source, declared, profile, depth)
    if isinstance(source, T.VariantType):
        return _variant_scalar(raw, declared, profile)
    return _typed_scalar(raw, source, declared, profile)


def given(raw: str, source: T.DataType) -> str:
    """True where the attribute is present and not null (neither SQL NULL nor JSON null)."""
    if isinstance(source, T.VariantType):
        return f"({raw} IS NOT NULL AND NOT is_variant_null({raw}))"
    return f"({raw} IS NOT NULL)"


def to_json_text(value: str) -> str:
    """Nested values as JSON text, null fields kept."""
    return f"to_json({value}, map('ignoreNullFields', 'false'))"


# --- building blocks -------------------------------------------------------------------------------------------


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def case(branches: list[tuple[str, str]], otherwise: str = "NULL") -> str:
    """``CASE``; an empty one is its default."""
    if not branches:
        return otherwise
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in branches) + f" ELSE {otherwise} END"


def cast(value: str, data_type: T.DataType | str) -> str:
    return f"CAST({value} AS {data_type if isinstance(data_type, str) else data_type.simpleString()})"


def try_cast(value: str, data_type: T.DataType | str) -> str:
    return "TRY_" + cast(value, data_type)


def matches(value: str, pattern: str) -> str:
    return f"({value} RLIKE {text(pattern)})"


def _null(declared: Declared) -> str:
    return cast("NULL", declared.spark)


def _trimmed(s: str) -> str:
    return f"btrim({s}, '{''.join(f'\\u{ord(c):04x}' for c in G.BLANKS)}')"


def _words(words: tuple[str, ...]) -> str:
    return "(" + ", ".join(text(w) for w in words) + ")"


def _from_string(s: str, declared: Declared, profile: str) -> str:
    """The value of a string attribute, NULL when the declared type does not accept that text."""
    kind = declared.kind
    if kind in ("text", "json"):
        return s
    if kind == "bytea":
        return cast(s, "binary")
    if kind == "date":
        return case([(matches(s, G.DATE), try_cast(s, "date"))])
    if kind == "timestamp":
        return case([(matches(s, G.TIMESTAMP), try_cast(f"upper({s})", "timestamp_ntz"))])
    if kind == "timestamptz":
        instant = try_cast(f"upper({s})", "timestamp")
        if profile == "binary":
            instant = f"timestampadd(MICROSECOND, if({matches(s, G.HALF_MICRO_UP)}, 1, 0), {instant})"
        return case([(matches(s, G.TIMESTAMPTZ), instant)])
    if kind == "boolean":
        word = f"lower({_trimmed(s) if profile == 'binary' else s})"
        return case([(f"{word} IN {_words(G.TRUE_WORDS)}", "true"), (f"{word} IN {_words(G.FALSE_WORDS)}", "false")])
    trimmed = _trimmed(s)
    if kind in ("real", "double"):
        return case([(matches(trimmed, G.NUMBER), try_cast(trimmed, declared.spark))])
    return try_cast(trimmed, declared.spark)


def _string_reason(s: str, declared: Declared) -> str:
    kind = declared.kind
    if kind in ("date", "timestamp", "timestamptz"):
        return text(NOT_ISO)
    if kind in ("integer", "bigint"):
        return case([(matches(_trimmed(s), G.INTEGRAL), text(OUT_OF_RANGE))], text(UNPARSABLE))
    if kind == "decimal":
        return case([(f"{try_cast(_trimmed(s), 'double')} IS NOT NULL", text(OUT_OF_RANGE))], text(UNPARSABLE))
    return text(UNPARSABLE)


def _wall_clock(micros: str) -> str:
    """Epoch microseconds as a zone-free timestamp, whatever the session time zone is."""
    return f"timestampadd(MICROSECOND, {micros}, {_EPOCH})"


def _from_epoch(n: str, kind: str) -> str:
    """Magnitude rule: large numbers are microseconds, others milliseconds; NULL when not representable."""
    micros = f"if({n} > {G.MICROS_ABOVE}L, {n}, try_multiply({n}, 1000L))"
    return _wall_clock(micros) if kind == "timestamp" else f"timestamp_micros({micros})"


def _from_long(n: str, declared: Declared, profile: str) -> str | None:
    """The value of an integral attribute (as BIGINT), or None when the type never accepts one."""
    kind = declared.kind
    if kind in ("text", "json"):
        return cast(n, "string")
    if kind == "bigint":
        return n
    if kind in _NUMERIC:
        return try_cast(n, declared.spark)
    if kind == "boolean" and profile == "binary":
        return case([(f"{n} = 1", "true"), (f"{n} = 0", "false")])
    if kind == "date":
        return f"date_from_unix_date({try_cast(n, 'int')})"
    if kind in ("timestamp", "timestamptz"):
        return _from_epoch(n, kind)
    return None


def _from_double(x: str, declared: Declared, profile: str) -> str | None:
    """The value of a fractional attribute (as DOUBLE), or None when the type never accepts one."""
    kind = declared.kind
    if kind in ("text", "json"):
        return cast(x, "string")
    if kind == "double":
        return x
    if kind == "real":
        narrowed = cast(x, "float")
        return case([(f"abs({narrowed}) < float('Infinity')", narrowed)]) if profile == "binary" else narrowed
    if kind == "decimal":
        return try_cast(x, declared.spark)
    if kind == "boolean" and profile == "binary":
        return case([(f"{x} > -1 AND {x} < 1", "false"), (f"{x} >= 1 AND {x} < 2", "true")])
    if kind == "date":
        return f"date_from_unix_date({try_cast(x, 'int')})"
    if kind in ("timestamp", "timestamptz"):
        return _from_epoch(try_cast(x, "bigint"), kind)
    return None


# --- schemaless records ----------------------------------------------------------------------------------------


def _variant(v: str, data_type: str) -> str:
    return f"try_variant_get({v}, '$', '{data_type}')"


def _variant_scalar(v: str, declared: Declared, profile: str) -> Coerced:
    tag = f"schema_of_variant({v})"
    is_text, is_long = f"{tag} = 'STRING'", f"{tag} = 'BIGINT'"
    is_fraction = f"(startswith({tag}, 'DECIMAL') OR {tag} IN ('DOUBLE', 'FLOAT'))"
    as_text, as_double = _variant(v, "string"), _variant(v, "double")

    if declared.kind in ("text", "json"):
        # Objects and arrays print as JSON; fractions print the way a double does.
        return Coerced(case([(is_fraction, cast(as_double, "string"))], as_text), text(INCOMPATIBLE))

    values, reasons = [], [(is_text, _string_reason(as_text, declared))]
    if declared.kind == "boolean":
        values.append((f"{tag} = 'BOOLEAN'", _variant(v, "boolean")))
    values.append((is_text, _from_string(as_text, declared, profile)))
    for condition, value in (
        (is_long, _from_long(_variant(v, "bigint"), declared, profile)),
        (is_fraction, _from_double(as_double, declared, profile)),
    ):
        if value is not None:
            values.append((condition, value))
            reasons.append((condition, text(OUT_OF_RANGE)))
    return Coerced(cast(case(values), declared.spark), case(reasons, text(INCOMPATIBLE)))


def _native_array(v: str, tag: str, declared: Declared) -> list[tuple[str, str]]:
    """Condition and value for JSON arrays whose elements all share one tag that needs no per-element rule.

    These convert in one native call; every other array goes element by element.
    """
    kind = declared.element.kind
    if kind == "text":
        return [(f"{tag} = 'ARRAY<STRING>'", _variant(v, "array<string>"))]
    if kind == "boolean":
        return [(f"{tag} = 'ARRAY<BOOLEAN>'", _variant(v, "array<boolean>"))]
    if kind == "bigint":
        return [(f"{tag} = 'ARRAY<BIGINT>'", _variant(v, "array<bigint>"))]
    if kind == "double":
        numeric = f"({tag} IN ('ARRAY<BIGINT>', 'ARRAY<DOUBLE>') OR startswith({tag}, 'ARRAY<DECIMAL'))"
        return [(numeric, _variant(v, "array<double>"))]
    return []


def _variant_array(v: str, declared: Declared, profile: str, depth: int) -> Coerced:
    tag = f"schema_of_variant({v})"
    is_array = f"startswith({tag}, 'ARRAY<')"
    value, reason = _elementwise(_variant(v, "array<variant>"), T.VariantType(), declared, profile, depth)
    branches = [*_native_array(v, tag, declared), (is_array, value)]
    return Coerced(case(branches), case([(is_array, reason)], text(INCOMPATIBLE)))


def _elementwise(elements: str, source: T.DataType, declared: Declared, profile: str, depth: int) -> Coerced:
    """Coerce each element; NULL elements stay, one bad element makes the whole array NULL."""
    # Numbers inside arrays are not held to the stricter per-column rules of the sql profile.
    inner = "binary" if declared.element.kind in _NUMERIC else profile
    x, judged = f"x{depth}", f"j{depth}"
    c = coerce(x, source, declared.element, inner, depth + 1)
    failed = f"({given(x, source)} AND {c.value} IS NULL)"
    pairs = f"transform({elements}, {x} -> named_struct('value', {c.value}, 'bad', {failed}))"
    # The one-element outer array binds the judged elements to a name, so that they are computed once.
    good = case([(f"NOT exists({judged}, j -> j.bad)", f"transform({judged}, j -> j.value)")])
    value = cast(f"transform(array({pairs}), {judged} -> {good})[0]", declared.spark)
    reasons = f"filter(transform({elements}, {x} -> {case([(failed, c.reason)])}), r -> r IS NOT NULL)"
    return Coerced(value, f"try_element_at({reasons}, 1)")


# --- the usual shape of schemaless records ---------------------------------------------------------------------


def usual_json_type(declared: Declared) -> T.DataType:
    """The type to parse a JSON attribute straight into, when its JSON form is the usual one for the column.

    A parser that meets another form flags the record, which then takes the general VARIANT route.
    """
    kind = declared.kind
    if kind in ("integer", "bigint", "boolean"):
        return declared.spark
    if kind in ("real", "double"):
        return T.DoubleType()
    if kind in ("text", "date", "timestamp", "timestamptz"):
        return T.StringType()
    if kind == "array" and declared.element.kind in ("integer", "bigint", "double", "boolean"):
        return declared.spark
    return T.VariantType()


def from_usual_json(raw: str, declared: Declared, profile: str) -> str:
    source = usual_json_type(declared)
    if isinstance(source, T.VariantType):
        return coerce(raw, source, declared, profile).value
    if isinstance(source, T.StringType):
        return _from_string(raw, declared, profile)
    if declared.kind == "real":
        return _from_double(raw, declared, profile)
    return raw


def doubtful_json(raw: str, value: str, column: ColumnSpec) -> str | None:
    """True where ``value``, made by :func:`from_usual_json` from ``raw``, may not be the right one."""
    declared, source = column.declared, usual_json_type(column.declared)
    missing = [] if column.nullable else [f"{value} IS NULL"]
    if declared.kind == "text":
        return " OR ".join([*missing, matches(raw, G.MAYBE_NOT_STRING)])
    if missing:
        return missing[0]
    if source == declared.spark or declared.kind == "double":
        return None
    return f"{value} IS NULL AND {given(raw, source)}"


# --- typed records ---------------------------------------------------------------------------------------------


def _typed_array(raw: str, source: T.DataType, declared: Declared, profile: str, depth: int) -> Coerced:
    if not isinstance(source, T.ArrayType):
        return Coerced(_null(declared), text(INCOMPATIBLE))
    if source.elementType == declared.element.spark and declared.element.kind != "array":
        return Coerced(cast(raw, declared.spark), text(INCOMPATIBLE))
    return _elementwise(raw, source.elementType, declared, profile, depth)


def _typed_scalar(raw: str, source: T.DataType, declared: Declared, profile: str) -> Coerced:
    kind = declared.kind
    value, reason = None, text(OUT_OF_RANGE)
    if isinstance(source, T.StringType):
        value, reason = _from_string(raw, declared, profile), _string_reason(raw, declared)
    elif kind == "json" and isinstance(source, _IN_JSON):
        value = _json_scalar(raw, source)
    elif isinstance(source, T.BinaryType):
        if kind in ("bytea", "text"):
            value, reason = cast(raw, declared.spark), text(UNPARSABLE)
    elif isinstance(source, T.BooleanType):
        if kind in ("boolean", "text", "json"):
            value = cast(raw, declared.spark)
    elif isinstance(source, _SMALL + (T.LongType,) + _FRACTION):
        if _accepts_number(kind, source, profile):
            value = _from_number(raw, source, declared, profile)
    elif isinstance(source, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        value = _from_calendar(raw, source, kind, profile)
    elif isinstance(source, _NESTED):
        if kind in ("text", "json"):
            value = to_json_text(_for_json(raw, source))
    if value is None:
        return Coerced(_null(declared), text(INCOMPATIBLE))
    return Coerced(cast(value, declared.spark), reason)


def _json_scalar(raw: str, source: T.DataType) -> str:
    """A typed value that JSON has no form for: bytes as base-64 text, points in time as milliseconds since 1970."""
    if isinstance(source, T.BinaryType):
        return f"concat('\"', base64({raw}), '\"')"
    return cast(_millis(raw, source), "string")


def _millis(raw: str, source: T.DataType) -> str:
    if isinstance(source, T.DateType):
        return f"(unix_date({raw}) * 86400000L)"
    if isinstance(source, T.TimestampType):
        return f"unix_millis({raw})"
    micros = f"timestampdiff(MICROSECOND, {_EPOCH}, {raw})"
    return f"(({micros} - pmod({micros}, 1000L)) DIV 1000)"


def _for_json(raw: str, source: T.DataType, depth: int = 0) -> str:
    """The same value with points in time inside it as milliseconds since 1970 (bytes become base-64 text by themselves)."""
    if not _holds_time(source):
        return raw
    if isinstance(source, T.StructType):
        fields = ", ".join(f"{text(f.name)}, {_for_json(f'{raw}.{quote(f.name)}', f.dataType, depth)}" for f in source.fields)
        return f"if({raw} IS NULL, NULL, named_struct({fields}))"
    if isinstance(source, T.ArrayType):
        return f"transform({raw}, e{depth} -> {_for_json(f'e{depth}', source.elementType, depth + 1)})"
    if isinstance(source, T.MapType):
        return f"transform_values({raw}, (k{depth}, e{depth}) -> {_for_json(f'e{depth}', source.valueType, depth + 1)})"
    return _millis(raw, source)


def _holds_time(source: T.DataType) -> bool:
    if isinstance(source, T.StructType):
        return any(_holds_time(f.dataType) for f in source.fields)
    if isinstance(source, T.ArrayType):
        return _holds_time(source.elementType)
    if isinstance(source, T.MapType):
        return _holds_time(source.valueType)
    return isinstance(source, _TIMES)


def _accepts_number(kind: str, source: T.DataType, profile: str) -> bool:
    small, whole = isinstance(source, _SMALL), isinstance(source, _SMALL + (T.LongType,))
    if kind in ("double", "decimal", "text", "json"):
        return True
    if kind == "bigint":
        return whole
    if kind == "integer":
        return small or (whole and profile == "binary")
    if kind == "real":
        if isinstance(source, T.DecimalType):
            return False
        return profile == "binary" or small or isinstance(source, T.FloatType)
    if kind in ("boolean", "date"):
        return profile == "binary"
    if kind in ("timestamp", "timestamptz"):
        return profile == "binary" or isinstance(source, T.LongType)
    return False


def _from_number(raw: str, source: T.DataType, declared: Declared, profile: str) -> str | None:
    if isinstance(source, T.DecimalType):
        if declared.kind in ("decimal", "text", "json"):
            return try_cast(raw, declared.spark)
        return _from_double(cast(raw, "double"), declared, profile)
    if isinstance(source, T.FloatType) and declared.kind in ("real", "text", "json"):
        return cast(raw, declared.spark)
    if isinstance(source, _FRACTION):
        return _from_double(cast(raw, "double"), declared, profile)
    return _from_long(cast(raw, "bigint"), declared, profile)


def _from_calendar(raw: str, source: T.DataType, kind: str, profile: str) -> str | None:
    """Logical date and timestamp values; instants are read in UTC, whatever the session time zone is."""
    if kind == "text":
        return cast(raw, "string")
    if isinstance(source, T.TimestampType):
        local = _wall_clock(f"unix_micros({raw})")
    else:
        local = cast(raw, "timestamp_ntz")
    if kind == "date":
        return cast(local, "date")
    if kind == "timestamp":
        return local
    if kind == "timestamptz" and profile == "binary":
        if isinstance(source, T.TimestampType):
            return raw
        return f"timestamp_micros(timestampdiff(MICROSECOND, {_EPOCH}, {local}))"
    return None
