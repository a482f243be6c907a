"""Compare every registered query with its SQL in DuckDB: ``python tests/oracle.py [sf dir] [name ...]``."""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf):
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def _key(v):
    if isinstance(v, float):
        return ("f", "nan" if math.isnan(v) else repr(v))
    return (type(v).__name__, repr(v))


def compare(spark, con, sf, query, sql):
    """None when equal, else what differs first. Types must match too: an int is not a float."""
    df = query(spark, sf)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    got = sorted(tuple(_key(r[c]) for c in order) for r in df.collect())
    want = sorted(tuple(_key(r[names.index(c)]) for c in order) for r in cur.fetchall())
    if got == want:
        return None
    only_got, only_want = sorted(set(got) - set(want))[:2], sorted(set(want) - set(got))[:2]
    return f"{len(got)} rows != {len(want)}; spark only {only_got}; oracle only {only_want}"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", "/tmp/tidegate-oracle-warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf), 0
    oracles = e.oracle_sql()
    for name, query in e.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf, query, oracles[name]) if name in oracles else f"rows {query(spark, sf).count()}"
        except Exception as ex:
            problem = f"{type(ex).__name__}: {str(ex)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} differ")
    sys.exit(bool(failed))
