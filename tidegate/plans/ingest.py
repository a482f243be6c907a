"""The ingestion plan: one lazy DataFrame from envelope to table rows, per target table."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import coerce as C
from ..functions.coerce import PROFILES
from ..functions.names import col
from ..functions.types import ColumnSpec, TableSpec
from ..operators import decode as D
from ..operators.quarantine import TOLERANCES
from ..operators.route import filter_topics, known_topics, parse_mapping, table_of, topic_names
from ..operators.verify import DELIVERIES

BATCH_ID = "batch_id"
_BATCH_ID_PARAMETER = re.compile(r"\$\{(?:\w+\.)?batch_id\}")


@dataclass(frozen=True)
class Script:
    """What to run after a batch of ``table`` is staged.

    ``sql`` may be a query, whose result goes to ``target`` (appended, or merged on ``keys``) and is published with the
    batch; with ``catalog`` the target is merged in the catalog instead. Or, without ``target``, any statement, which then acts on the catalog by itself. ``run`` is the same
    as a function of (batch rows, batch id).
    """

    table: str
    sql: str | None = None
    run: Callable[[DataFrame, str], DataFrame | None] | None = None
    target: str | None = None
    keys: tuple[str, ...] = ()
    update: tuple[str, ...] | None = None
    catalog: bool = False  # the target is a catalog table with row-level operations, merged in place

    def text(self, batch_id: str) -> str:
        """The SQL with the batch id filled in; other parameters stay as they are."""
        return _BATCH_ID_PARAMETER.sub(lambda _: batch_id, self.sql)


@dataclass(frozen=True)
class PostProcess:
    scripts: tuple[Script, ...] = ()

    @classmethod
    def from_json(cls, text: str | None) -> "PostProcess":
        """``{"mappings": [{"table", "script" or "scriptFile", "target"?, "keys"?, "update"?}]}``."""
        if text is None or not text.strip():
            return cls()
        try:
            config = json.loads(text)
        except json.JSONDecodeError as e:
            raise ValueError(f"The post-processing setting is not JSON: {e}") from e
        if not isinstance(config, dict):
            raise ValueError("The post-processing setting must hold one JSON object")
        scripts = []
        for mapping in config.get("mappings") or []:
            table, sql, file = ((mapping.get(k) or "").strip() for k in ("table", "script", "scriptFile"))
            if not table:
                raise ValueError(f"Post-processing entry names no table: {mapping}")
            if bool(sql) == bool(file):
                raise ValueError(f"Post-processing of {table} needs a script or a scriptFile, not both")
            scripts.append(
                Script(
                    table,
                    sql or Path(file).read_text(encoding="utf-8"),
                    target=mapping.get("target"),
                    keys=tuple(mapping.get("keys") or ()),
                    update=tuple(mapping["update"]) if mapping.get("update") else None,
                    catalog=bool(mapping.get("catalog")),
                )
            )
        return cls(tuple(scripts))

    def script_for(self, table: str) -> Script | None:
        return next((s for s in self.scripts if s.table == table), None)


@dataclass(frozen=True)
class IngestConfig:
    """Everything that decides what lands where."""

    tables: dict[str, TableSpec]
    targets: dict[str, TableSpec] = field(default_factory=dict)  # written by post-processing only
    mapping: dict[str, str] = field(default_factory=dict)
    topics: tuple[str, ...] | None = None  # subscribed topics; None takes all
    profile: str = "sql"
    delivery: str = "at_least_once"
    tolerance: str = "none"
    max_bytes: int | None = None
    casts: dict[str, dict[str, str]] = field(default_factory=dict)
    post_process: PostProcess = field(default_factory=PostProcess)

    def __post_init__(self):
        if isinstance(self.mapping, str):
            object.__setattr__(self, "mapping", parse_mapping(self.mapping))
        for name, value, allowed in (
            ("profile", self.profile, PROFILES),
            ("delivery", self.delivery, DELIVERIES),
            ("tolerance", self.tolerance, TOLERANCES),
        ):
            if value not in allowed:
                raise ValueError(f"Unknown {name} '{value}', expected one of {', '.join(allowed)}")
        merged = {s.target: s.keys for s in self.post_process.scripts if s.target and s.keys}
        appended = {*self.tables, *(s.target for s in self.post_process.scripts if s.target and not s.keys)}
        if both := sorted(merged.keys() & appended):
            raise ValueError(f"Tables are appended to or merged into, not both: {', '.join(both)}")
        if odd := sorted({s.target for s in self.post_process.scripts if s.target in merged and s.keys and s.keys != merged[s.target]}):
            raise ValueError(f"Scripts merge into one table on different keys: {', '.join(odd)}")


def tag_batch(batch_id: str) -> dict[str, Column]:
    """The batch id as a constant; it lands only in tables that declare the column."""
    return {BATCH_ID: F.lit(batch_id)}


def plan_rows(
    envelope: DataFrame,
    spec: TableSpec,
    profile: str = "sql",
    *,
    max_bytes: int | None = None,
    casts: dict[str, dict[str, str]] | None = None,
    constants: dict[str, Column] | None = None,
    only: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Envelope rows of one table as ``_src``, ``_error`` and the table's columns. No shuffle.

    JSON for which the predicate ``only`` does not hold is not parsed; columns in ``keep`` are carried along.
    """
    fixed = {k.lower() for k in constants or {}}
    read = TableSpec(spec.name, tuple(c for c in spec.columns if c.name.lower() not in fixed))
    if isinstance(envelope.schema["value"].dataType, T.StructType):
        decoded = D.decode_typed(envelope, read, max_bytes=max_bytes, keep=keep)
    else:
        # Casts work on VARIANT attributes, so with them the direct route does not apply.
        decoded = D.decode_json(envelope, read, max_bytes, None if casts else profile, only, keep)
    if casts:
        decoded = D.cast_fields(decoded, casts)
    return D.resolve_columns(decoded, spec, profile, constants, keep)


TAG = "schema_tag"


def plan_mixed(
    envelope: DataFrame, spec: TableSpec, schemas: dict[str, T.StructType], profile: str = "sql", *, max_bytes: int | None = None
) -> DataFrame:
    """Typed and schemaless records of one table in the same batch: ``_src``, ``_error`` and the table's columns.

    ``value`` is a VARIANT, and ``schema_tag`` names the schema of a typed record, or is NULL. A record is typed where its
    tag is one of ``schemas`` and its value an object, schemaless where it has no tag and its value is an object;
    anything else (an unknown tag, no value, a value that is no object) has no converter. All kinds are read in one pass.
    """
    is_object = F.coalesce(F.schema_of_variant("value").startswith("OBJECT"), F.lit(False))
    rows = envelope.select(
        *[F.col(f.name) for f in D.ENVELOPE.fields if f.name != "value"],
        F.to_json("value").cast("binary").alias("value"),
        F.col("value").alias("_variant"),
        F.when(~is_object, F.lit("none")).when(F.col(TAG).isNull(), F.lit("json")).otherwise(F.concat(F.lit("typed "), TAG)).alias("_kind"),
    )
    keep: tuple[str, ...] = ("_variant", "_kind")
    results = []
    for n, (kind, schema) in enumerate([("json", None), *((f"typed {t}", s) for t, s in schemas.items())]):
        mine = F.col("_kind") == kind
        if schema is None:
            planned = plan_rows(rows, spec, profile, max_bytes=max_bytes, only="_kind = 'json'", keep=keep)
        else:
            typed = F.when(mine, F.try_variant_get("_variant", "$", schema.simpleString()))
            decoded = D.decode_typed(rows.withColumn("_record", typed), spec, "_record", max_bytes, keep=(*keep, "_json"))
            planned = D.resolve_columns(decoded, spec, profile, None, (*keep, "_json"))
        own = F.struct(F.col(D.ERROR).alias("error"), *[col(c).alias(f"c{k}") for k, c in enumerate(spec.names)])
        source = [F.col(f"{D.SRC}.{f.name}") for f in D.ENVELOPE.fields if f.name != "value"]
        value = F.col(f"{D.SRC}.value" if schema is None else "_json").alias("value")
        rows = planned.select(*source, value, value.alias("_json"), *[F.col(c) for c in keep], F.when(mine, own).alias(f"_kind_{n}"))
        keep = (*keep, f"_kind_{n}")
        results.append(F.col(f"_kind_{n}"))
    found = F.coalesce(*results)
    source = F.struct(*[F.col(f.name) for f in D.ENVELOPE.fields])
    return rows.select(source.alias(D.SRC), found.alias("_found")).select(
        D.SRC,
        F.when(F.col("_found").isNull(), D.error(D.NO_CONVERTER)).otherwise(F.col("_found.error")).alias(D.ERROR),
        *[F.col(f"_found.c{k}").alias(c) for k, c in enumerate(spec.names)],
    )


def row_column(table: str) -> str:
    """The struct that holds a table's columns where rows of several tables share a DataFrame."""
    return f"row_{table}"


def plan_tables(envelope: DataFrame, config: "IngestConfig", constants: dict[str, Column] | None = None) -> DataFrame:
    """Records of all tables in one pass: ``_src``, ``table``, ``_error`` and for each table a struct of its columns.

    The input is read once, whatever the number of tables: a record is parsed for the table that its topic goes to, and
    the other tables' structs are NULL. Records of topics without a table, or not subscribed to, are left out.
    """
    if config.topics is not None:
        envelope = filter_topics(envelope, list(config.topics))
    envelope = filter_topics(envelope, known_topics(config.mapping, list(config.tables)))
    typed = isinstance(envelope.schema["value"].dataType, T.StructType)
    done: tuple[str, ...] = ("_typed",) if typed else ()
    rows = envelope.withColumn("_typed", F.col("value")) if typed else envelope
    errors = {}
    for n, (table, spec) in enumerate(config.tables.items()):
        mine = f"topic IN ({', '.join(C.text(t) for t in topic_names(table, config.mapping))})"
        planned = plan_rows(
            rows, spec, config.profile, max_bytes=config.max_bytes, casts=config.casts, constants=constants, only=mine, keep=done
        )
        errors[table] = f"_error_{n}"
        row = F.struct(*[col(c) for c in spec.names])
        good = F.expr(f"{D.SRC}.{mine}") & F.col(D.ERROR).isNull()
        fields = [F.col(f"{D.SRC}.{f.name}") for f in D.ENVELOPE.fields if f.name != "value"]
        value = F.col("_typed" if typed else f"{D.SRC}.value").alias("value")
        last = [F.col(f"{D.SRC}.value").alias("_text")] if typed else []
        rows = planned.select(
            *fields,
            value,
            *last,
            *[col(c) for c in done if c != "_text"],
            F.when(good, row).alias(row_column(table)),
            F.when(F.expr(f"{D.SRC}.{mine}"), F.col(D.ERROR)).alias(errors[table]),
        )
        done = (*[c for c in done if c != "_text"], row_column(table), errors[table])
    value = F.col("_text" if typed else "value").alias("value")
    source = F.struct(*[value if f.name == "value" else F.col(f.name) for f in D.ENVELOPE.fields])
    return rows.select(
        source.alias(D.SRC),
        table_of(F.col("topic"), config.mapping).alias("table"),
        F.coalesce(*[F.col(e) for e in errors.values()]).alias(D.ERROR),
        *[col(row_column(t)) for t in config.tables],
    )


def fill_defaults(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Give nullable columns their default where the whole batch has no value for them.

    Costs an aggregate over the batch, so only tables that declare such defaults pay for it.
    """
    defaulted = [c for c in spec.columns if c.default is not None and c.nullable]
    if not defaulted:
        return rows
    used = D.prune_null_columns(rows, TableSpec(spec.name, tuple(defaulted)))
    absent = {c.name: c for c in defaulted if c.name not in used}

    def filled(c: ColumnSpec) -> Column:
        return F.expr(c.default).cast(c.declared.spark).alias(c.name) if c.name in absent else col(c.name)

    return rows.select(D.SRC, D.ERROR, *[filled(c) for c in spec.columns]) if absent else rows
