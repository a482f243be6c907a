"""Keep-latest and upsert: the relational part of per-batch post-processing."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import col, quote
from .sinks import table_name


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` columns, compared left to right, NULL lowest.

    What ``row_number() over (partition by keys order by order desc) = 1`` gives, as an aggregate: it combines
    map-side, so a key that holds a third of all rows sends one row per task instead of filling a single sort.
    ``order`` should end in something unique per row (an offset), else equal rows are an arbitrary choice.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.select(*[col(k) for k in keys]).distinct()
    row = F.struct(*[col(c) for c in others])
    # A NULL struct field sorts first, so NULL order values lose against any other.
    winner = F.max_by(row, F.struct(*[col(o) for o in order])).alias("_row")
    picked = df.groupBy(*[col(k) for k in keys]).agg(winner)
    return picked.select(*[col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns])


def upsert(
    target: DataFrame, source: DataFrame, keys: list[str], update: list[str] | None = None
) -> DataFrame:
    """``MERGE``: rows of ``target`` whose key is in ``source`` take the ``update`` columns from it; other source
    rows are added. ``source`` must have one row per key (see :func:`latest_per_key`).

    Matches and additions are two joins rather than one full outer join, because Spark can split a skewed side of a
    left join at run time but not of a full outer one. Keys compare with ``=``: a NULL key never matches.
    """
    update = [c for c in target.columns if c not in keys] if update is None else update
    missing = [c for c in update if c not in source.columns]
    if missing:
        raise ValueError(f"Update columns not in source: {', '.join(missing)}")
    src = source.select(
        *[col(k).alias(f"_key_{i}") for i, k in enumerate(keys)],
        F.struct(*[col(c) for c in update]).alias("_new") if update else F.lit(True).alias("_new"),
    )
    on = [target[quote(k)] == src[f"_key_{i}"] for i, k in enumerate(keys)]
    joined = target.join(src, on, "left")
    merged = joined.select(
        *[
            F.when(F.col("_new").isNotNull(), F.col("_new").getField(c)).otherwise(col(c)).alias(c)
            if c in update
            else col(c)
            for c in target.columns
        ]
    )
    existing = target.select(*[col(k) for k in keys]).distinct()
    added = source.join(existing, keys, "left_anti")
    filled = [
        col(c) if c in source.columns else F.lit(None).cast(target.schema[c].dataType).alias(c)
        for c in target.columns
    ]
    return merged.unionByName(added.select(*filled))


def merge_sql(table: str, columns: list[str], keys: list[str], update: list[str], source: str) -> str:
    """The statement that :func:`merge_into` stands for."""
    on = " AND ".join(f"t.{quote(k)} = s.{quote(k)}" for k in keys)
    matched = f" WHEN MATCHED THEN UPDATE SET {', '.join(f't.{quote(c)} = s.{quote(c)}' for c in update)}" if update else ""
    added = ", ".join(quote(c) for c in columns)
    return f"MERGE INTO {table_name(table)} t USING {source} s ON {on}{matched} WHEN NOT MATCHED THEN INSERT ({added}) VALUES ({', '.join(f's.{quote(c)}' for c in columns)})"


def supports_merge(spark: SparkSession, table: str) -> bool:
    """Whether the catalog can merge rows into a table: asked by planning a merge of nothing, not by running one."""
    try:
        columns = spark.table(table_name(table)).columns
        shown = spark.sql(f"EXPLAIN {merge_sql(table, columns, columns[:1], [], f'(SELECT * FROM {table_name(table)} LIMIT 0)')}").first()[0]
    except AnalysisException:
        return False
    return "Error occurred during query planning" not in shown


def merge_into(source: DataFrame, table: str, keys: list[str], update: list[str] | None = None) -> None:
    """Merge into a catalog table with row-level operations: matched rows take the ``update`` columns, others are added.

    ``source`` must have one row per key; columns that the table lacks take no part.
    """
    own = source.sparkSession.table(table_name(table)).columns
    columns = [c for c in own if c in source.columns]
    update = [c for c in columns if c not in keys] if update is None else update
    on = [F.col(f"s.{quote(k)}") == F.col(f"{table_name(table)}.{quote(k)}") for k in keys]
    condition = on[0]
    for one in on[1:]:
        condition = condition & one
    writer = source.select(*[col(c) for c in columns]).alias("s").mergeInto(table_name(table), condition)
    if update:
        writer = writer.whenMatched().update({c: F.col(f"s.{quote(c)}") for c in update})
    writer.whenNotMatched().insert({c: F.col(f"s.{quote(c)}") for c in columns}).merge()
