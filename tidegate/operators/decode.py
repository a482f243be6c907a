"""Record conversion: topic-log envelopes to attributes, and attributes to the columns of one table.

``decode_json`` / ``decode_typed`` give every record a ``_doc`` struct with one field per table column;
``resolve_columns`` coerces those fields and reports, per record, the first column that does not fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import coerce as C
from ..functions.names import col, quote
from ..functions.types import ColumnSpec, TableSpec

ENVELOPE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
    ]
)
SRC, DOC, USUAL, ERROR = "_src", "_doc", "_usual", "_error"
RESERVED = (SRC, DOC, USUAL, ERROR, "_keys", "_text", "_status")
ERROR_TYPE = T.StructType(
    [
        T.StructField("column", T.StringType()),
        T.StructField("declared_type", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)

NO_CONVERTER = "no_converter"
AMBIGUOUS = "ambiguous_column"
NOT_NULL = "not_null_violation"
TOO_LARGE = "too_large"

_CORRUPT = "_corrupt_text"
_JSON_OPTIONS = {
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    "columnNameOfCorruptRecord": _CORRUPT,
}
# Names of the pre-ingestion cast types and the Spark types they stand for.
CAST_TYPES = {
    "int8": "tinyint",
    "int16": "smallint",
    "int32": "int",
    "int64": "bigint",
    "float32": "float",
    "float64": "double",
    "boolean": "boolean",
    "string": "string",
}


def error(reason: str | Column, column: str | None = None, declared: str | None = None) -> Column:
    reason = F.lit(reason) if isinstance(reason, str) else reason
    return F.struct(
        F.lit(column).cast("string").alias("column"),
        F.lit(declared).cast("string").alias("declared_type"),
        reason.alias("reason"),
    )


def _error_text(why: str, column: ColumnSpec) -> str:
    name, declared = C.text(column.name), C.text(str(column.declared))
    return f"named_struct('column', {name}, 'declared_type', {declared}, 'reason', {why})"


def _status_text(reason: str) -> str:
    return (
        "named_struct('column', CAST(NULL AS STRING), 'declared_type', CAST(NULL AS STRING), "
        f"'reason', {C.text(reason)})"
    )


def no_error() -> Column:
    return F.lit(None).cast(ERROR_TYPE)


def decode_json(
    df: DataFrame,
    spec: TableSpec,
    max_bytes: int | None = None,
    usual_profile: str | None = None,
    only: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Schemaless records: the value is one JSON object; attribute names match columns without regard to case.

    Names are compared exactly while parsing, which is what nearly all records need. Only a record that spells some
    column differently is re-keyed first, so the cost stays linear in the width of the table either way.

    With ``usual_profile`` records are first parsed straight into the types their attributes usually have; where
    that is certain to give what the general route would, ``_usual`` holds the finished values and ``_doc`` is NULL.
    Records for which the SQL predicate ``only`` does not hold are not parsed; columns in ``keep`` are carried along.
    """
    kept = [quote(c) for c in keep]
    names, lowers = _list(spec.names), _list([n.lower() for n in spec.names])
    value = "try_validate_utf8(CAST(value AS STRING))"
    too_large = "false" if max_bytes is None else f"octet_length({SRC}.value) > {int(max_bytes)}"
    if max_bytes is not None:
        # An oversize payload is quarantined, not parsed.
        value = f"if(octet_length(value) <= {int(max_bytes)}, {value}, NULL)"
    if only is not None:
        value = f"if({only}, {value}, NULL)"
    envelope = ", ".join(f"'{f.name}', {quote(f.name)}" for f in ENVELOPE.fields)
    base = df.selectExpr(f"named_struct({envelope}) AS {SRC}", f"{value} AS _text", *kept)
    keyed = base.selectExpr(SRC, "_text", "json_object_keys(_text) AS _keys", *kept)

    respelled = f"exists(_keys, k -> k NOT IN {names} AND lower(k) IN {lowers})"
    matching = f"filter(array_distinct(_keys), k -> lower(k) IN {lowers})"
    clashing = f"size({matching}) > size(array_distinct(transform({matching}, k -> lower(k))))"
    flagged = keyed.selectExpr(SRC, "_text", "_keys", f"{respelled} AS _respelled", *kept)
    flagged = flagged.selectExpr(SRC, "_text", "_keys", "_respelled", f"if(_respelled, {clashing}, false) AS _clash", *kept)
    rekeyed = f"if(_respelled AND NOT _clash, {_rekey(spec)}, _text)"
    ready = flagged.selectExpr(SRC, f"{rekeyed} AS _text", "_keys", "_clash", *kept)

    general = _parse([(n, "VARIANT") for n in spec.names])
    usual = []
    if usual_profile is not None:
        ready, usual = _read_usual(ready, spec, usual_profile, kept), [USUAL]
        general = f"if({USUAL} IS NULL, {general}, NULL)"
    parsed = ready.selectExpr(SRC, "_keys", "_clash", *usual, f"{general} AS {DOC}", *kept)
    corrupt = f"(_keys IS NULL OR {DOC}.{_CORRUPT} IS NOT NULL)"
    status = C.case(
        [(too_large, _status_text(TOO_LARGE)), (corrupt, _status_text(NO_CONVERTER)), ("_clash", _status_text(AMBIGUOUS))]
    )
    return parsed.selectExpr(SRC, "_keys", *usual, DOC, f"{status} AS _status", *kept)


def _read_usual(ready: DataFrame, spec: TableSpec, profile: str, kept: list[str]) -> DataFrame:
    """Add ``_usual``: the finished row where the record has the usual form throughout, else NULL."""
    reading = _parse([(c.name, C.usual_json_type(c.declared).simpleString()) for c in spec.columns])
    raw = ready.selectExpr(SRC, "_text", "_keys", "_clash", f"{reading} AS _raw", *kept)
    fields = [
        f"{C.text(c.name)}, {C.cast(C.from_usual_json(f'_raw.{quote(c.name)}', c.declared, profile), c.declared.spark)}"
        for c in spec.columns
    ]
    valued = raw.selectExpr(SRC, "_text", "_keys", "_clash", "_raw", f"named_struct({', '.join(fields)}) AS _values", *kept)
    doubts = ["_keys IS NULL", "_clash", f"_raw.{_CORRUPT} IS NOT NULL"]
    doubts += [C.doubtful_json(f"_raw.{quote(c.name)}", f"_values.{quote(c.name)}", c) for c in spec.columns]
    # Branches of one CASE, not one long OR: generated code for branches can be split into methods.
    usual = C.case([(d, "NULL") for d in doubts if d is not None], "_values")
    return valued.selectExpr(SRC, "_text", "_keys", "_clash", f"{usual} AS {USUAL}", *kept)


def _list(names: list[str]) -> str:
    return "(" + ", ".join(C.text(n) for n in names) + ")"


def _parse(attributes: list[tuple[str, str]]) -> str:
    ddl = ", ".join(f"{quote(name)} {data_type}" for name, data_type in [*attributes, (_CORRUPT, "STRING")])
    options = ", ".join(f"'{k}', '{v}'" for k, v in _JSON_OPTIONS.items())
    return f"from_json(_text, {C.text(ddl)}, map({options}))"


def _rekey(spec: TableSpec) -> str:
    """The same JSON object with attributes named as the table names them, and those no column matches left out."""
    lowers = [n.lower() for n in spec.names]
    name = "lower(e.key)"
    if lowers != spec.names:
        name = f"try_element_at(map_from_arrays(array{_list(lowers)}, array{_list(spec.names)}), {name})"
    entries = "map_entries(from_json(_text, 'map<string,variant>', map('allowSingleQuotes', 'false')))"
    wanted = f"filter({entries}, e -> lower(e.key) IN {_list(lowers)})"
    member = f"concat(to_json(CAST({name} AS VARIANT)), ':', coalesce(to_json(e.value), 'null'))"
    return f"concat('{{', array_join(transform({wanted}, e -> {member}), ','), '}}')"


def decode_typed(
    df: DataFrame, spec: TableSpec, value: str = "value", max_bytes: int | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Typed records: ``value`` is a struct column whose field types are known while the plan is built.

    The size of a typed record, where it is limited, is that of its JSON form.
    """
    value_type = df.schema[value].dataType
    if not isinstance(value_type, T.StructType):
        raise TypeError(f"Column '{value}' is {value_type.simpleString()}, expected a struct")
    by_lower: dict[str, list[str]] = {}
    for name in value_type.names:
        by_lower.setdefault(name.lower(), []).append(name)
    fields, clash = [], False
    for name in spec.names:
        found = by_lower.get(name.lower(), [])
        clash = clash or len(found) > 1
        fields.append((col(value).getField(found[0]) if found else F.lit(None)).alias(name))
    envelope = F.struct(
        *[F.col(f.name) for f in ENVELOPE.fields if f.name != "value"],
        # A NULL record has nothing to print; anything else is kept as JSON for the dead-letter table.
        F.expr(C.to_json_text(quote(value))).cast("binary").alias("value"),
    )
    status = F.when(col(value).isNull(), error(NO_CONVERTER))
    if max_bytes is not None:
        status = status.when(F.octet_length(F.expr(C.to_json_text(quote(value)))) > max_bytes, error(TOO_LARGE))
    status = status.otherwise(error(AMBIGUOUS) if clash else no_error())
    return df.select(
        envelope.alias(SRC),
        F.struct(*fields).alias(DOC),
        F.lit(value_type.names).alias("_keys"),
        status.alias("_status"),
        *[col(c) for c in keep],
    )


def decode(df: DataFrame, spec: TableSpec, max_bytes: int | None = None) -> DataFrame:
    """Dispatch on the kind of record: a struct value is typed, bytes or text are schemaless JSON."""
    if isinstance(df.schema["value"].dataType, T.StructType):
        return decode_typed(df, spec, max_bytes=max_bytes)
    return decode_json(df, spec, max_bytes)


def cast_fields(decoded: DataFrame, rules: dict[str, dict[str, str]]) -> DataFrame:
    """Per-topic casts ahead of ingestion: ``{topic pattern: {attribute: cast type}}``.

    The pattern must match the whole topic name. A value that cannot be cast fails its record.
    """
    doc_type = decoded.schema[DOC].dataType
    topic = F.col(f"{SRC}.topic")
    updates, failures = {}, []
    for pattern, casts in rules.items():
        applies = topic.rlike(f"^(?:{pattern})\\z")
        for name, cast_name in casts.items():
            if name not in doc_type.names:
                continue
            target = CAST_TYPES[cast_name]
            raw = updates.get(name, F.col(DOC).getField(name))
            if isinstance(doc_type[name].dataType, T.VariantType):
                number = F.when(
                    F.schema_of_variant(raw) == "STRING", F.try_variant_get(raw, "$", "string").try_cast(target)
                ).otherwise(F.try_variant_get(raw, "$", target))
                cast, present = number.cast("variant"), raw.isNotNull() & ~F.is_variant_null(raw)
            else:
                cast, present = raw.try_cast(target).cast(doc_type[name].dataType), raw.isNotNull()
            updates[name] = F.when(applies & present, cast).otherwise(raw)
            failures.append(F.when(applies & present & cast.isNull(), error(C.UNPARSABLE, name, cast_name)))
    if not updates:
        return decoded
    fields = [updates.get(n, F.col(DOC).getField(n)).alias(n) for n in doc_type.names]
    others = [quote(c) for c in decoded.columns if c not in (DOC, "_status")]
    return decoded.select(
        *others, F.struct(*fields).alias(DOC), F.coalesce(F.col("_status"), *failures).alias("_status")
    )


def resolve_columns(
    decoded: DataFrame,
    spec: TableSpec,
    profile: str = "sql",
    constants: dict[str, Column] | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Decoded records as table rows: ``_src``, ``_error`` and one column per table column.

    ``_error`` is NULL for a good record, else the first failing column in table order. ``constants`` replaces
    attributes by a fixed expression (used for the batch id). Attributes unknown to the table are dropped; missing
    and null attributes are NULL.
    """
    doc_type = decoded.schema[DOC].dataType
    constants = {k.lower(): v for k, v in (constants or {}).items()}
    names = [quote(c.name) for c in spec.columns]
    values: list[str | Column] = []
    errors = ["_status"]
    has_usual = USUAL in decoded.columns
    for column, name in zip(spec.columns, names):
        if column.name in RESERVED:
            raise ValueError(f"Column name '{column.name}' is reserved")
        if column.name.lower() in constants:
            values.append(constants[column.name.lower()].cast(column.declared.spark).alias(column.name))
            continue
        source = doc_type[column.name].dataType
        raw = f"{DOC}.{name}"
        value, reason = C.coerce(raw, source, column.declared, profile)
        is_given = C.given(raw, source)
        if column.default is not None and not column.nullable:
            value = C.case([(is_given, value)], C.cast(column.default, column.declared.spark))
        if has_usual:
            value = C.case([(f"{USUAL} IS NOT NULL", f"{USUAL}.{name}")], value)
        values.append(f"{value} AS {name}")
        if column.nullable:
            failed, why = f"{name} IS NULL AND {is_given}", reason
        else:
            failed, why = f"{name} IS NULL", C.case([(is_given, reason)], C.text(NOT_NULL))
        errors.append(C.case([(failed, _error_text(why, column))]))
    carried = [quote(c) for c in keep]
    kept = [c for c in (SRC, DOC, USUAL, "_status") if c in decoded.columns] + carried
    usual = [(f"{USUAL} IS NOT NULL", "NULL")] if has_usual else []
    first_error = C.case(usual, f"coalesce({', '.join(errors)})")
    # A filter on the error must run on its finished value. Pushed below these projections, it would repeat the
    # parsing and coercion of every column; reading the partition id, always >= 0, keeps the optimizer from that.
    first_error = C.case([("spark_partition_id() >= 0", first_error)])
    valued = decoded.select(*kept, *[F.expr(v) if isinstance(v, str) else v for v in values])
    return valued.selectExpr(SRC, f"{first_error} AS {ERROR}", *names, *carried)


def observed_columns(decoded: DataFrame) -> DataFrame:
    """Attribute names that occur anywhere in the batch, with the number of records that carry each."""
    return (
        decoded.select(F.explode(F.array_distinct("_keys")).alias("attribute"))
        .groupBy("attribute")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def unknown_attributes(decoded: DataFrame, spec: TableSpec) -> DataFrame:
    """Attributes no column matches: they are dropped, and this reports them."""
    lowers = [n.lower() for n in spec.names]
    return observed_columns(decoded).where(~F.lower("attribute").isin(lowers))


def prune_null_columns(rows: DataFrame, spec: TableSpec) -> list[str]:
    """Table columns that hold a value in at least one row, from a single aggregate over the batch.

    Columns that are null everywhere are left out of an insert, so that the table's default applies to them.
    """
    counts = rows.agg(*[F.max(col(n).isNotNull()).alias(str(i)) for i, n in enumerate(spec.names)]).first()
    return [n for i, n in enumerate(spec.names) if counts[str(i)]]
