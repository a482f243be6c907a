"""Exact dedup by heavy-hitter split.

Digests that occur in a large share of the rows are found with a frequent-items sketch (``approx_top_k``, Spark's mergeable
form of the Misra-Gries counters), verified by exact counts, and removed map-side by a broadcast of at most ``heavy``
rows. All other digests are grouped by an ordinary shuffle, where no group can be large any more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage, text_of

#: At most so many digests are taken as heavy; the broadcast is bounded by this many rows of about 100 bytes.
HEAVY = 512
#: Counters of the sketch: every digest in more than about one row in a thousand is among them.
COUNTERS = 4096


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY, counters: int = COUNTERS) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical; null counts as empty. The row with the largest id stays (null ids are smallest); of
    rows that repeat both id and text one stays. An empty table gives an empty result; other columns are not read.
    """
    rows = stage(
        docs.select(
            F.col(id_col).alias("id"),
            F.sha2(text_of(text_col).cast("binary"), 256).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "exact-digests",
    )
    frequent = rows.agg(F.expr(f"approx_top_k(digest, {heavy}, {counters})").alias("top")).select(F.expr("inline(top)")).select(F.col("item").alias("digest"))
    candidates = stage(frequent, "exact-candidates")
    verified = stage(
        rows.join(F.broadcast(candidates), "digest")
        .groupBy("digest")
        .agg(F.max(F.struct("id", "row")).alias("best"), F.count("*").alias("group_size"))
        .filter("group_size > 1"),
        "exact-winners",
    )
    hot = rows.join(F.broadcast(verified), "digest")
    group = Window.partitionBy("digest")
    cold = rows.join(F.broadcast(verified.select("digest")), "digest", "left_anti").select(
        "digest", "id", "row", F.max(F.struct("id", "row")).over(group).alias("best"), F.count("*").over(group).alias("group_size")
    )
    return hot.select(*cold.columns).unionAll(cold).select(
        F.col("id").alias(id_col),
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
