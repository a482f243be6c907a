"""Good rows, dead letters and what happens between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import col
from ..functions.types import TableSpec
from .decode import ERROR, SRC, TOO_LARGE

TOLERANCES = ("none", "all")


class BatchFailed(RuntimeError):
    """The batch as a whole must not land."""


def split_valid(rows: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """(table rows, dead letters) of resolved rows. Both are lazy; neither side is computed here."""
    valid = rows.where(F.col(ERROR).isNull()).select(*[col(n) for n in spec.names])
    return valid, dead_letters(rows, spec.name)


def dead_letters(rows: DataFrame, table: str) -> DataFrame:
    """Failed records in their original form, with where they were headed and why they were refused."""
    return rows.where(F.col(ERROR).isNotNull()).select(
        f"{SRC}.*",
        F.lit(table).alias("table"),
        F.col(f"{ERROR}.column").alias("column"),
        F.col(f"{ERROR}.declared_type").alias("declared_type"),
        F.col(f"{ERROR}.reason").alias("reason"),
        describe().alias("message"),
    )


def describe():
    """Readable text for an error."""
    return F.concat_ws(
        " ",
        F.lit("Cannot convert record"),
        F.when(
            F.col(f"{ERROR}.column").isNotNull(),
            F.concat(
                F.lit("attribute "), F.col(f"{ERROR}.column"), F.lit(" to a "), F.col(f"{ERROR}.declared_type")
            ),
        ),
        F.concat(F.lit("due to "), F.col(f"{ERROR}.reason")),
    )


def reasons(dead: DataFrame) -> DataFrame:
    """Dead letters counted by table, column and reason."""
    return dead.groupBy("table", "column", "reason").agg(F.count(F.lit(1)).alias("records"))


def enforce(dead: DataFrame, tolerance: str) -> None:
    """Under tolerance ``none`` one bad record fails the batch. Looks for a single example, not for all of them."""
    if tolerance not in TOLERANCES:
        raise ValueError(f"Unknown error tolerance '{tolerance}', expected one of {', '.join(TOLERANCES)}")
    if tolerance == "none":
        example = dead.select("topic", "partition", "offset", "table", "message").first()
        if example is not None:
            raise BatchFailed(
                f"{example['message']} (table {example['table']}, topic {example['topic']}, "
                f"partition {example['partition']}, offset {example['offset']})"
            )


def write_dead_letters(dead: DataFrame, path: str) -> None:
    """Append to a dead-letter directory, laid out by table so that one table's letters read alone."""
    dead.write.mode("append").partitionBy("table").parquet(path)


def whole_batch_dead(batch: DataFrame, table: str, exception: Exception) -> DataFrame:
    """Every record of a batch that failed as a whole, as dead letters carrying the exception text."""
    value = F.col("value")
    if batch.schema["value"].dataType.typeName() == "struct":
        value = F.to_json("value", {"ignoreNullFields": "false"}).cast("binary").alias("value")
    return batch.select(
        "topic", "partition", "offset", "timestamp", "key", value,
        F.lit(table).alias("table"),
        F.lit(None).cast("string").alias("column"),
        F.lit(None).cast("string").alias("declared_type"),
        F.lit("batch_failed").alias("reason"),
        F.lit(f"{type(exception).__name__}: {exception}").alias("message"),
    )


def quarantine_oversize(df: DataFrame, max_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(records that fit, records whose value exceeds ``max_bytes``). Every record is in exactly one."""
    too_large = F.coalesce(F.octet_length("value") > max_bytes, F.lit(False))
    return df.where(~too_large), df.where(too_large).withColumn("reason", F.lit(TOO_LARGE))
