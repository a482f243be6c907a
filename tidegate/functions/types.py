"""Declared column types and table specifications.

A target table is described by DDL-like text (``id INTEGER NOT NULL, tags ARRAY(TEXT)``) and is fixed:
ingestion resolves and coerces records against it and never evolves it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

# Accepted type names per declared type.
ALIASES = {
    "integer": ("integer", "int", "int4"),
    "bigint": ("bigint", "int8", "long"),
    "real": ("real", "float4"),
    "double": ("double precision", "double", "float", "float8"),
    "decimal": ("numeric", "decimal"),
    "boolean": ("boolean", "bool"),
    "text": ("text",),
    "bytea": ("bytea",),
    "date": ("date",),
    "timestamp": ("timestamp",),
    "timestamptz": ("timestamptz",),
    "json": ("json",),
}
UNSUPPORTED = ("struct", "geography")
DEFAULT_PRECISION, DEFAULT_SCALE = 38, 9

_KIND_BY_NAME = {alias: kind for kind, names in ALIASES.items() for alias in names}
_SPARK_TYPES = {
    "integer": T.IntegerType(),
    "bigint": T.LongType(),
    "real": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "text": T.StringType(),
    "bytea": T.BinaryType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "timestamptz": T.TimestampType(),
    "json": T.StringType(),
}


class SchemaError(ValueError):
    """The declared table cannot be ingested into at all (as opposed to one bad record)."""


@dataclass(frozen=True)
class Declared:
    """A parsed declared type; ``element`` is set for arrays only."""

    kind: str
    precision: int | None = None
    scale: int | None = None
    element: "Declared | None" = None

    @classmethod
    def parse(cls, text: str) -> "Declared":
        name = re.sub(r"\s+", " ", text.strip().lower())
        name = re.sub(r" (not )?null$", "", name)
        if name.endswith("[]"):
            return cls("array", element=cls.parse(name[:-2]))
        if name.startswith("array(") and name.endswith(")"):
            return cls("array", element=cls.parse(name[6:-1]))
        base, _, args = name.partition("(")
        base, args = base.strip(), args.rstrip(") ")
        if base in UNSUPPORTED:
            raise SchemaError(f"Data type {base} is not yet supported")
        kind = _KIND_BY_NAME.get(base)
        if kind is None or (args and kind != "decimal" and base != "float"):
            raise SchemaError(f"Unknown data type: {text.strip()}")
        if kind != "decimal":
            return cls(kind)
        parts = [int(p) for p in args.split(",")] if args else [DEFAULT_PRECISION, DEFAULT_SCALE]
        precision, scale = parts[0], parts[1] if len(parts) > 1 else 0
        if not (1 <= precision <= 38 and 0 <= scale <= precision):
            raise SchemaError(f"Invalid precision or scale: {text.strip()}")
        return cls("decimal", precision, scale)

    @classmethod
    def of(cls, data_type: T.DataType) -> "Declared":
        """The declared type of an existing Spark column (used by catalog discovery)."""
        if isinstance(data_type, T.ArrayType):
            return cls("array", element=cls.of(data_type.elementType))
        if isinstance(data_type, T.DecimalType):
            return cls("decimal", data_type.precision, data_type.scale)
        for kind, spark_type in _SPARK_TYPES.items():
            if data_type == spark_type:
                return cls(kind)
        if isinstance(data_type, (T.ByteType, T.ShortType)):
            return cls("integer")
        raise SchemaError(f"Data type {data_type.simpleString()} is not yet supported")

    @property
    def spark(self) -> T.DataType:
        if self.kind == "array":
            return T.ArrayType(self.element.spark, True)
        if self.kind == "decimal":
            return T.DecimalType(self.precision, self.scale)
        return _SPARK_TYPES[self.kind]

    @property
    def sql(self) -> str:
        """Spark SQL name of the type, for ``try_variant_get`` and casts."""
        return self.spark.simpleString()

    def __str__(self) -> str:
        if self.kind == "array":
            return f"array({self.element})"
        if self.kind == "decimal":
            return f"decimal({self.precision},{self.scale})"
        return self.kind


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    declared: Declared
    nullable: bool = True
    default: str | None = None  # Spark SQL expression used when a batch leaves the column out


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[ColumnSpec, ...]

    def __post_init__(self):
        lowered = [c.name.lower() for c in self.columns]
        repeated = sorted({n for n in lowered if lowered.count(n) > 1})
        if repeated:
            raise SchemaError(f"Table {self.name}: columns differ only in case: {', '.join(repeated)}")

    @classmethod
    def from_ddl(cls, name: str, ddl: str) -> "TableSpec":
        return cls(name, tuple(_parse_column(part) for part in _split_top_level(ddl)))

    @classmethod
    def from_spark(cls, name: str, schema: T.StructType) -> "TableSpec":
        columns = []
        for field in schema.fields:
            text = field.metadata.get("declared_type")
            columns.append(
                ColumnSpec(
                    field.name,
                    Declared.parse(text) if text else Declared.of(field.dataType),
                    field.nullable and not field.metadata.get("required", False),
                    field.metadata.get("default", field.metadata.get("CURRENT_DEFAULT")),  # the second is the catalog's own
                )
            )
        return cls(name, tuple(columns))

    @property
    def schema(self) -> T.StructType:
        """Spark schema; fields stay nullable because a batch may leave columns out."""
        fields = []
        for c in self.columns:
            meta = {"declared_type": str(c.declared)}
            if not c.nullable:
                meta["required"] = True
            if c.default is not None:
                meta["default"] = c.default
            fields.append(T.StructField(c.name, c.declared.spark, True, meta))
        return T.StructType(fields)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]


def _split_top_level(ddl: str) -> list[str]:
    """Split on commas that are outside parentheses and double quotes."""
    parts, depth, quoted, start = [], 0, False, 0
    for i, ch in enumerate(ddl):
        if ch == '"':
            quoted = not quoted
        elif not quoted:
            depth += (ch == "(") - (ch == ")")
            if ch == "," and depth == 0:
                parts.append(ddl[start:i])
                start = i + 1
    parts.append(ddl[start:])
    return [p.strip() for p in parts if p.strip()]


_COLUMN = re.compile(r'^(?:"(?P<quoted>[^"]+)"|(?P<plain>\S+))\s+(?P<rest>.+)$', re.S)
_DEFAULT = re.compile(r"\s+default\s+(?P<expr>.+)$", re.I | re.S)
_NULLABILITY = re.compile(r"\s+(?P<not>not\s+)?null$", re.I)


def _parse_column(text: str) -> ColumnSpec:
    match = _COLUMN.match(text)
    if not match:
        raise SchemaError(f"Malformed column definition: {text}")
    rest, default, nullable = match["rest"].strip(), None, True
    found = _DEFAULT.search(rest)
    if found:
        default, rest = found["expr"].strip(), rest[: found.start()].strip()
    found = _NULLABILITY.search(rest)
    if found:
        nullable, rest = not found["not"], rest[: found.start()].strip()
    return ColumnSpec(match["quoted"] or match["plain"], Declared.parse(rest), nullable, default)
