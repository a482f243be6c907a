"""Where tables lie, and which of their folders count. What is in a folder is committed by Spark's own writers.

    sink/<run>/table=<t>/outcome=landed|dead     streamed rows: the file sink, whose metadata log says what is there
    start/<run>/                                 last offsets before that run
    batches/<epoch>/rows/table=<t>/outcome=...   a batch, written as one; an epoch that runs again overwrites it
    derived/<epoch>/<target>-by-<table>/         what a script appends
    versions/<epoch>/<target>-by-<table>/        a merged target as a whole
    published/<epoch>/                           one small file that names what a batch made, all at once

A run is the life of one checkpoint: Spark's sink skips batches by number, so a new checkpoint gets a folder of its own.
"""

from __future__ import annotations

import re
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import col, quote
from ..functions.types import SchemaError, TableSpec
from ..operators import merge, offsets
from ..operators.decode import ENVELOPE, ERROR, SRC
from ..operators.quarantine import BatchFailed, describe
from ..plans.ingest import row_column

PUBLISHED = "epoch string, version bigint, kind string, name string, path string, records bigint"
_FIELDS = tuple(f.split()[0] for f in PUBLISHED.split(", "))
#: Files a task keeps open at once; with more tables and outcomes its rows are sorted by them first.
OPEN_FILES = 16
DEAD_FIELDS = ("column", "declared_type", "reason")
_SOURCE = T.StructType([T.StructField(f"_{f.name}", f.dataType) for f in ENVELOPE.fields if f.name in ("topic", "partition", "offset")])
_RECORD = T.StructType(
    [T.StructField(f"_{f.name}", f.dataType) for f in ENVELOPE.fields if f.name in ("timestamp", "key", "value")]
    + [T.StructField(f"_{name}", T.StringType()) for name in (*DEAD_FIELDS, "message")]
)
# The characters that Spark escapes in the path of a partition.
_ESCAPED = re.compile("[\x01-\x1f\"#%'*/:=?\\\\\x7f{[\\]^]")
_DEALT = T.StructType([T.StructField(name, T.StringType()) for name in ("table", "outcome")])


@contextmanager
def _open_files(spark: SparkSession, most: int):
    """Let a task keep one file per table and outcome open, instead of sorting its rows by them first."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, most)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@dataclass(frozen=True)
class Change:
    """One thing a batch makes: kind is landed, dead, merged or ledger."""

    kind: str
    name: str
    path: str
    records: int | None = None


def dealt(rows: DataFrame, tables: dict[str, TableSpec]) -> DataFrame:
    """Planned records as they are stored: ``table``, ``outcome``, coordinates, the whole record with its reason where it is
    a dead letter, and a struct for each table's columns (as names repeat between tables).
    """
    is_dead = F.col(ERROR).isNotNull()
    src, err = (lambda f: F.col(f"{SRC}.{f}")), (lambda f: F.col(f"{ERROR}.{f}"))
    return rows.select(
        "table",
        F.when(is_dead, "dead").otherwise("landed").alias("outcome"),
        *[src(f).alias(f"_{f}") for f in ("topic", "partition", "offset")],
        *[F.when(is_dead, src(f)).alias(f"_{f}") for f in ("timestamp", "key", "value")],
        *[err(f).alias(f"_{f}") for f in DEAD_FIELDS],
        F.when(is_dead, describe()).alias("_message"),
        *[col(row_column(t)) for t in tables],
    )


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._published: list[Row] | None = None

    def using(self, spark: SparkSession) -> "TableStore":
        """The same store through another session (a micro-batch has its own)."""
        other = TableStore(spark, self.root)
        other._published = self._published
        return other

    def _found(self, path: str, schema: str | T.StructType, **options) -> DataFrame | None:
        """The files under a path; None where nothing was ever written there."""
        try:
            return self.spark.read.options(**options).schema(schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    # --- what counts ---

    def published(self) -> list[Row]:
        """All that batches published, oldest first: a few short rows per batch, read once by a store, which is its table's one writer."""
        if self._published is None:
            rows = self._found(f"{self.root}/published", PUBLISHED, recursiveFileLookup=True)
            self._published = sorted(rows.collect(), key=lambda r: r["version"]) if rows is not None else []
        return self._published

    def committed(self, epoch: str) -> bool:
        return any(r["epoch"] == epoch for r in self.published())

    def publish(self, epoch: str, changes: list[Change]) -> None:
        """Name everything a batch made in one file: until that file is there, nothing of the batch is read."""
        known = self.published()
        version = known[-1]["version"] + 1 if known else 0
        made = [(epoch, version, c.kind, c.name, c.path, c.records) for c in changes] or [(epoch, version, "empty", "", "", 0)]
        self.spark.createDataFrame(made, PUBLISHED).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/published/{epoch}")
        known += [Row(*_FIELDS)(*row) for row in made]  # shared with the stores of other sessions

    def _paths(self, kind: str, name: str) -> list[str]:
        return [r["path"] for r in self.published() if r["kind"] == kind and r["name"] == name]

    def runs(self) -> list[str]:
        rows = self._found(f"{self.root}/runs", "run string", recursiveFileLookup=True)
        return sorted(r["run"] for r in rows.collect()) if rows is not None else []

    def run_of(self, checkpoint: str) -> str:
        """The run a checkpoint belongs to. It is noted inside the checkpoint, so it is lost and replaced with it."""
        note = f"{checkpoint.rstrip('/')}/tidegate-run"
        noted = self._found(note, "run string")
        if noted is not None and (row := noted.first()) is not None:
            return row["run"]
        run = uuid4().hex
        name = self.spark.createDataFrame([(run,)], "run string").coalesce(1)
        name.write.parquet(f"{self.root}/runs/{run}")
        name.write.mode("overwrite").parquet(note)
        return run

    # --- reading ---

    def read(self, spec: TableSpec) -> DataFrame:
        """Rows of a table, declared columns only. Of a merged table, its newest version."""
        if merged := self._paths("merged", spec.name):
            return self.spark.read.schema(spec.schema).parquet(merged[-1])
        return self.read_with_source(spec).select(*[col(n) for n in spec.names])

    def read_with_source(self, spec: TableSpec) -> DataFrame:
        """Rows with the topic, partition and offset each came from (NULL for rows that a script made)."""
        schema = T.StructType(_SOURCE.fields + spec.schema.fields)
        landed = self._paths("landed", spec.name)
        batches = [p for p in landed if not p.startswith(f"{self.root}/derived/")]
        frames = [self._streamed(run, spec.name, "landed", spec) for run in self.runs()]
        if batches:
            frames.append(self._batched(batches, spec.name, "landed", spec))
        if made := [p for p in landed if p not in batches]:
            frames.append(self.spark.read.schema(schema).parquet(*made))
        return self._all(frames, schema)

    def read_dead_letters(self, table: str) -> DataFrame:
        stored = T.StructType(_SOURCE.fields + _RECORD.fields)
        frames = [self._streamed(run, table, "dead") for run in self.runs()]
        if paths := self._paths("dead", table):
            frames.append(self._batched(paths, table, "dead"))
        return self._all(frames, stored).select(*[F.col(f.name).alias(f.name[1:]) for f in stored.fields], F.lit(table).alias("table"))

    def landed_rows(self, path: str, spec: TableSpec) -> DataFrame:
        """One staged batch's rows of a table."""
        return self._batched([path], spec.name, "landed", spec).select(*[col(n) for n in spec.names])

    def _streamed(self, run: str, table: str, outcome: str, spec: TableSpec | None = None) -> DataFrame | None:
        """What a run's sink has committed of a table: read as one folder, so that Spark goes by the sink's metadata log."""
        found = self._found(f"{self.root}/sink/{run}", T.StructType([*_stored(spec).fields, *_DEALT.fields]))
        return found and _columns(found.where((F.col("table") == table) & (F.col("outcome") == outcome)), spec)

    def _batched(self, paths: list[str], table: str, outcome: str, spec: TableSpec | None = None) -> DataFrame:
        """A table's part of published batches: only its own folders are listed."""
        own = [f"{p}/table={_folder(table)}/outcome={outcome}" for p in paths]
        return _columns(self.spark.read.schema(_stored(spec)).parquet(*own), spec)

    def _all(self, frames: list[DataFrame | None], schema: T.StructType) -> DataFrame:
        there = [f for f in frames if f is not None]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), there) if there else self.spark.createDataFrame([], schema)

    # --- offsets ---

    def ledger(self, before: str | None = None) -> DataFrame | None:
        """Last offset per topic partition over all batches and runs (but run ``before``); None where there is nothing yet."""
        last = self._paths("ledger", "")[-1:]
        parts = [self.spark.read.schema(offsets.LEDGER_SCHEMA).parquet(p) for p in last]
        for run in self.runs():
            seen = self._found(f"{self.root}/sink/{run}", T.StructType(_SOURCE.fields + _DEALT.fields)) if run != before else None
            if seen is not None:
                parts.append(_offsets(seen))
        if not parts:
            return None
        return reduce(DataFrame.unionByName, parts).groupBy("topic", "topic_partition").agg(F.max("partition_offset").alias("partition_offset"))

    def start_of(self, run: str) -> DataFrame | None:
        """The ledger as it stood before a run, written once when the run starts, so that every batch of it sees the same."""
        path = f"{self.root}/start/{run}"
        found = self._found(path, offsets.LEDGER_SCHEMA)
        if found is None and (ledger := self.ledger(before=run)) is not None:
            ledger.coalesce(1).write.mode("overwrite").parquet(path)
            found = self._found(path, offsets.LEDGER_SCHEMA)
        return found

    def stage_ledger(self, epoch: str, staged: str) -> Change:
        """The ledger after a staged batch."""
        seen = self.spark.read.schema(T.StructType(_SOURCE.fields + _DEALT.fields)).parquet(staged)
        parts = [_offsets(seen), *([before] if (before := self.ledger()) is not None else [])]
        after = reduce(DataFrame.unionByName, parts).groupBy("topic", "topic_partition").agg(F.max("partition_offset").alias("partition_offset"))
        path = f"{self.root}/batches/{epoch}/ledger"
        after.coalesce(1).write.mode("overwrite").parquet(path)
        return Change("ledger", "", path)

    # --- staging a batch ---

    def stage(self, epoch: str, rows: DataFrame, tables: dict[str, TableSpec]) -> tuple[str, dict[str, int]]:
        """Write a batch's good rows and dead letters of all tables in one pass; where, and what was seen on the way.

        Seen are ``landed_<n>`` and ``dead_<n>`` of the n-th table, and ``given_<n>_<k>`` where its k-th column has a
        default: they are observed by the write itself, so nothing is read again to count it.
        """
        seen = []
        for n, (table, spec) in enumerate(tables.items()):
            mine = F.col("table") == table
            seen += [F.count_if(mine & (F.col("outcome") == o)).alias(f"{o}_{n}") for o in ("landed", "dead")]
            row = quote(row_column(table))
            defaulted = [(k, c) for k, c in enumerate(spec.columns) if c.default is not None and c.nullable]
            seen += [F.count(F.col(f"{row}.{quote(c.name)}")).alias(f"given_{n}_{k}") for k, c in defaulted]
        noticed = Observation()
        path = self.write_dealt(dealt(rows, tables).observe(noticed, *seen), f"{self.root}/batches/{epoch}/rows")
        return path, noticed.get

    def write_dealt(self, out: DataFrame, path: str) -> str:
        with _open_files(self.spark, OPEN_FILES):
            out.write.mode("overwrite").partitionBy("table", "outcome").parquet(path)
        return path

    def staged_rows(self, path: str, tables: dict[str, TableSpec]) -> DataFrame:
        rows = [T.StructField(row_column(t), spec.schema) for t, spec in tables.items()]
        return self.spark.read.schema(T.StructType([*_SOURCE.fields, *_RECORD.fields, *_DEALT.fields, *rows])).parquet(path)

    def staged_dead(self, path: str) -> DataFrame:
        found = self.staged_rows(path, {}).where("outcome = 'dead'")
        return found.select(*[F.col(f"_{n}").alias(n) for n in ("topic", "partition", "offset", "message")], "table")

    def stage_dead(self, epoch: str, dead: DataFrame, table: str) -> list[Change]:
        """Write ready-made dead letters of one table."""
        fields = [*[f.name[1:] for f in _SOURCE.fields], *[f.name[1:] for f in _RECORD.fields]]
        noticed = Observation()
        out = dead.select(F.lit(table).alias("table"), F.lit("dead").alias("outcome"), *[F.col(f).alias(f"_{f}") for f in fields])
        path = self.write_dealt(out.observe(noticed, F.count(F.lit(1)).alias("n")), f"{self.root}/batches/{epoch}/failed/{table}")
        return [Change("dead", table, path, noticed.get["n"])] if noticed.get["n"] else []

    def stage_append(self, epoch: str, rows: DataFrame, spec: TableSpec, producer: str) -> list[Change]:
        path = f"{self.root}/derived/{epoch}/{spec.name}-by-{producer}"
        conform(rows, spec).write.mode("overwrite").parquet(path)
        return [Change("landed", spec.name, path)]

    def stage_merge(self, epoch: str, source: DataFrame, target: TableSpec, keys: list[str], update: list[str] | None, producer: str, staged: list[Change]) -> list[Change]:
        """``source`` (one row per key, else the batch fails) merged into a target that no catalog holds: its next version.

        ``staged`` are the changes of this epoch so far: a second merge into a target goes on from the first.
        """
        work = f"{self.root}/batches/{epoch}/{target.name}-source-by-{producer}"
        conform(source, target, source=True).write.mode("overwrite").parquet(work)
        incoming = self.spark.read.parquet(work)
        if incoming.isEmpty():
            return []
        require_single(incoming, target.name, keys)
        before = [*self._paths("merged", target.name), *(c.path for c in staged if c.kind == "merged" and c.name == target.name)]
        current = self.spark.read.schema(target.schema).parquet(before[-1]) if before else self.spark.createDataFrame([], target.schema)
        path = f"{self.root}/versions/{epoch}/{target.name}-by-{producer}"
        merge.upsert(current, incoming, keys, update).write.mode("overwrite").parquet(path)
        return [Change("merged", target.name, path)]


def _stored(spec: TableSpec | None) -> T.StructType:
    """What is stored of a record, with the columns of one table or of none."""
    row = [T.StructField(row_column(spec.name), spec.schema)] if spec is not None else []
    return T.StructType([*_SOURCE.fields, *_RECORD.fields, *row])


def _columns(stored: DataFrame, spec: TableSpec | None) -> DataFrame:
    if spec is None:
        return stored.select(*_SOURCE.names, *_RECORD.names)
    return stored.select(*_SOURCE.names, *[F.col(f"{quote(row_column(spec.name))}.{quote(n)}").alias(n) for n in spec.names])


def _folder(value: str) -> str:
    """A partition value as Spark writes it in a path."""
    return _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", value)


def _offsets(rows: DataFrame) -> DataFrame:
    """Last offset per topic partition, from three narrow columns of what was written."""
    partition = F.coalesce("_partition", F.lit(offsets.UNKNOWN_PARTITION))
    return rows.groupBy(F.col("_topic").alias("topic"), partition.alias("topic_partition")).agg(F.max("_offset").alias("partition_offset"))


def require_single(rows: DataFrame, name: str, keys: list[str]) -> None:
    """Fail the batch where a key of a merge source has several rows."""
    repeated = rows.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").first()
    if repeated is not None:
        raise BatchFailed(f"Several rows to merge into {name} for the key {[repeated[k] for k in keys]}")


def conform(rows: DataFrame, spec: TableSpec, source: bool = False) -> DataFrame:
    """Rows in the declared columns and types of a table. A value that does not fit fails the batch when it is written.

    The source of a merge may have further columns, as in SQL; they take no part in it.
    """
    unknown = [c for c in rows.columns if c not in spec.names and not source]
    if unknown:
        raise SchemaError(f"{spec.name} has no columns {', '.join(unknown)}")
    kinds = {f.name: f.dataType for f in spec.schema.fields}
    required = [f.name for f in spec.schema.fields if f.metadata.get("required")]
    absent = [c for c in required if c not in rows.columns]
    if absent:
        raise SchemaError(f"{spec.name} needs values for {', '.join(absent)}")
    kept = [n for n in spec.names if n in rows.columns]
    cast = rows.select(*[col(n).cast(kinds[n]).alias(n) for n in kept])
    for n in required:
        cast = cast.withColumn(n, F.coalesce(col(n), F.raise_error(F.lit(f"{spec.name}.{n} must not be NULL")).cast(kinds[n])))
    return cast
