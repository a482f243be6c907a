"""Session settings the library relies on or runs best with. All are runtime settings, so any session can take them."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Zone-free columns are UTC wall clock.
    "spark.sql.session.timeZone": "UTC",
    # Coercion makes large generated methods. Beyond this size the JVM would interpret a fused stage instead of
    # compiling it; Spark then generates one class per operator, split into small methods, which is faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A stream's file sink goes by the session's setting: without it, every task sorts its records by table and outcome in
    # memory before it writes them; with it, a task keeps so many files open and sorts only where there are more.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
