"""Topic → table routing."""

from __future__ import annotations

from collections import Counter
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_mapping(text: str | None) -> dict[str, str]:
    """``topic1:table1,topic2:table2`` as a dict. The mapping must be one-to-one and well-formed."""
    if text is None or not text.strip():
        return {}
    pairs = [[side.strip() for side in entry.split(":")] for entry in text.split(",")]
    malformed = [":".join(p) for p in pairs if len(p) != 2 or not all(p)]
    if malformed:
        raise ValueError(f"Not a 'topic:table' pair: {malformed}")
    for side, names in zip(("topics", "tables"), zip(*pairs)):
        repeated = [n for n, times in Counter(names).items() if times > 1]
        if repeated:
            raise ValueError(f"The topic mapping repeats {side}: {repeated}")
    return dict(pairs)


def table_of(topic: Column, mapping: dict[str, str]) -> Column:
    """The table a topic goes to; a topic without a mapping goes to the table of its own name."""
    if not mapping:
        return topic
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(lookup, topic), topic)


def route(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumn("table", table_of(F.col("topic"), mapping))


def topic_names(table: str, mapping: dict[str, str]) -> list[str]:
    """The topics that go to one table."""
    sources = [t for t, target in mapping.items() if target == table]
    return sources if table in mapping else [*sources, table]


def topics_of(table: str, mapping: dict[str, str]) -> Column:
    """Predicate on ``topic`` for one table's records. A plain comparison, so it reaches the scan."""
    return F.col("topic").isin(topic_names(table, mapping))


def known_topics(mapping: dict[str, str], tables: list[str]) -> list[str]:
    """All topics that go to one of the tables."""
    own = [t for t in tables if t not in mapping]
    return [*(topic for topic, table in mapping.items() if table in tables), *own]


def filter_topics(df: DataFrame, subscribed: list[str]) -> DataFrame:
    """Only records of topics this ingest is subscribed to."""
    return df.where(F.col("topic").isin(list(subscribed)))


def split_by_table(df: DataFrame, mapping: dict[str, str], tables: list[str]) -> dict[str, DataFrame]:
    """One lazy branch per known table. Records of other tables are in none; see :func:`skipped`."""
    return {table: df.where(topics_of(table, mapping)) for table in tables}


def skipped(df: DataFrame, mapping: dict[str, str], tables: list[str]) -> DataFrame:
    """How many records per topic have no table to go to."""
    routed = route(df, mapping).where(~F.col("table").isin(list(tables)))
    return routed.groupBy("topic", "table").agg(F.count(F.lit(1)).alias("records"))
