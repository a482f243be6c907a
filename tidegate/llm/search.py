"""Ranked lexical search by bag deduplication.

Documents are restricted to the words of the items. Documents whose restricted bags (words and how often each occurs)
and length weights agree score alike for every item, so they are made one class: bags are dealt by a hash and compared
whole. Each class is scored once, against all items of a block; the best classes of an item are then expanded to their
members by rising id.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, text_of

# Fixed values of the ranking: saturation and length weights, in thousandths and hundredths.
GAIN, SATURATION, LENGTH_SHARE = 1_000_000_000, 8, 75
#: Bytes of item texts (an item counts as ``ITEM_BYTES`` at least) that are searched for in one pass over the documents; more
#: items take more passes. So a block has at most 500 items and 50,000 words.
BLOCK_BYTES, ITEM_BYTES = 100_000, 200
#: Cells of a block of bags that are scored at once.
CELLS = 2_000_000
#: Scores up to here are exact in double precision.
_EXACT = 1 << 53

_KEEP = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    """Stretches of ASCII letters, ASCII digits and all characters beyond ASCII; A-Z in lower case."""
    return text.encode().translate(_KEEP).split()


def _bags(docs: DataFrame, words: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """``doc``, ``n`` (terms with repeats), and the bag as ``words`` (rising places in the vocabulary) and ``tfs``."""
    place = docs.sparkSession.sparkContext.broadcast({w: k for k, w in enumerate(words)})

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = place.value
        for b in batches:
            lengths, bags = [], []
            for text in b.column(1):
                found = terms(text.as_py())
                lengths.append(len(found))
                bags.append(sorted((at[w], k) for w, k in Counter(found).items() if w in at))
            columns = [pa.array([[x[i] for x in bag] for bag in bags], pa.list_(pa.int32())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lengths, pa.int64()), *columns], ["doc", "n", "words", "tfs"])

    read = docs.select(F.col(id_col).cast("long").alias("doc"), text_of(text_col).alias("t"))
    return read.mapInArrow(part, "doc long, n long, words array<int>, tfs array<int>")


class Scorer:
    """Scores of bags against all items of a block, and the best classes of each item so far."""

    def __init__(self, weights: np.ndarray, items: list[dict[int, int]], top: int):
        self.weights, self.top = weights, top
        longest = max((sum(q.values()) for q in items), default=0)
        self.kind = np.float64 if int(weights.max(initial=0)) * (GAIN // 1000) * longest < _EXACT else np.int64
        self.queries = np.zeros((len(weights), len(items)), self.kind)
        for k, q in enumerate(items):
            for word, times in q.items():
                self.queries[word, k] = times
        self.floor = np.ones(len(items), self.kind)  # what a score must reach to be among the best
        self.best: list[list[tuple]] = [[] for _ in items]

    def scores(self, words: list[np.ndarray], tfs: list[np.ndarray], m: np.ndarray) -> np.ndarray:
        rows = np.repeat(np.arange(len(words)), [len(w) for w in words])
        places, tf = np.concatenate(words), np.concatenate(tfs).astype(np.int64)
        impact = self.weights[places] * (GAIN * tf // (1000 * tf + SATURATION * m[rows]))
        block = np.zeros((len(words), len(self.weights)), self.kind)
        block[rows, places] = impact
        return block @ self.queries

    def add(self, keys: list[tuple], words: list[np.ndarray], tfs: list[np.ndarray], m: np.ndarray) -> None:
        """``keys``: first id (or infinity) and place of each class; ties of score go to the lower key."""
        scores = self.scores(words, tfs, m)
        rows, items = np.nonzero(scores >= self.floor)
        touched = set(items.tolist())
        for r, k in zip(rows.tolist(), items.tolist()):
            self.best[k].append((-int(scores[r, k]), *keys[r]))
        for k in touched:
            self.best[k] = sorted(self.best[k])[: self.top]
            if len(self.best[k]) == self.top:
                self.floor[k] = -self.best[k][-1][0]


def _best_classes(classes: DataFrame, weights: np.ndarray, items: list[tuple[int, dict[int, int]]], top: int) -> DataFrame:
    """For each task and item, the classes with the highest scores: ``item``, ``score`` and the class."""
    shared = classes.sparkSession.sparkContext.broadcast((weights, items))
    schema = "item int, score long, first long, key long, m long, words array<int>, tfs array<int>"

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, items = shared.value
        scorer = Scorer(weights, [q for _, q in items], top)
        size = max(1, CELLS // max(1, len(weights)))
        kept: dict[int, tuple] = {}
        seen = 0
        for b in batches:
            for start in range(0, len(b), size):
                cut = b.slice(start, size)
                words, tfs = ([np.asarray(x.values, np.int32) for x in cut.column(c)] for c in ("words", "tfs"))
                firsts, hashes, m = (cut.column(c).to_pylist() for c in ("first", "key", "m"))
                keys = [(float("inf") if f is None else f, seen + k) for k, f in enumerate(firsts)]
                scorer.add(keys, words, tfs, np.array(m, np.int64))
                kept |= {seen + k: row for k, row in enumerate(zip(firsts, hashes, m, words, tfs))}
                seen += len(cut)
                wanted = {x[2] for best in scorer.best for x in best}
                kept = {k: v for k, v in kept.items() if k in wanted}
        rows = [(k, -score, *kept[at]) for k, best in enumerate(scorer.best) for score, _, at in best]
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
        columns = list(zip(*rows)) if rows else [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["item", "score", "first", "key", "m", "words", "tfs"])

    return classes.mapInArrow(part, schema)


def _search_block(docs: DataFrame, items: list[tuple[object, str]], item_type: str, top: int, id_col: str, text_col: str, item_col: str) -> DataFrame:
    spark = docs.sparkSession
    queries = [Counter(terms(text)) for _, text in items]
    words = sorted({w for q in queries for w in q})
    place = {w: k for k, w in enumerate(words)}
    bags = stage(_bags(docs, words, id_col, text_col), "search-bags")
    with_terms, length = bags.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not length or not words:
        return spark.createDataFrame([], f"{item_col} {item_type}, rank int, doc_id long, score long")
    found = {r["word"]: r["df"] for r in bags.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("df")).collect()}
    df = np.array([found.get(k, 0) for k in range(len(words))], np.float64)
    weights = np.floor(1000 * np.log((2.0 * with_terms + 2) / (2 * df + 1))).astype(np.int64)

    m = F.expr(f"{100 - LENGTH_SHARE} + ({LENGTH_SHARE} * n * {with_terms}L) div {length}L")
    keyed = bags.filter("size(words) > 0").select("doc", "words", "tfs", m.alias("m"), F.xxhash64("words", "tfs", m).alias("key"))
    bag = ["key", "m", "words", "tfs"]
    classes = keyed.groupBy(*bag).agg(F.min("doc").alias("first"))
    numbered = [(k, {place[w]: n for w, n in q.items()}) for k, q in enumerate(queries)]
    best = _best_classes(classes.select("first", *bag), weights, numbered, top)
    ranked = best.withColumn("at", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("first").asc_nulls_last(), "key")))
    winners = stage(ranked.filter(F.col("at") <= top).drop("at", "first"), "search-winners")  # at most ``top`` rows an item

    # Only classes that won are expanded, each to its lowest ids; the limit is taken in every task before rows move.
    won = F.broadcast(winners.select(*bag).distinct())
    by_id = Window.partitionBy(*bag).orderBy(F.col("doc").asc_nulls_last())
    members = keyed.join(won, bag, "left_semi").withColumn("at", F.row_number().over(by_id)).filter(F.col("at") <= top)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc").asc_nulls_last())
    hits = members.drop("at").join(F.broadcast(winners), bag).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(items)], f"item int, `{item_col}` {item_type}")
    return hits.join(F.broadcast(names), "item").select(F.col(f"`{item_col}`"), "rank", F.col("doc").alias("doc_id"), "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``top`` documents with the highest scores above 0 for each item: item, ``rank`` from 1, ``doc_id``, ``score``.

    Items are searched for in blocks of about ``block_bytes`` of text, one pass over the documents each: what is sent to
    all tasks is bounded by that, and by ``top`` bags an item. A null or empty text of a document counts as having no
    term, as does one of separators only; such items find nothing. Every row is a document of its own: of rows with equal
    score and id each takes a rank, and null ids come last. Rows of items are searched for one by one, repeated ids too.
    Empty tables give no rows; other columns are not read. Ids are whole numbers.
    """
    kind = items.schema[item_col].dataType.simpleString()
    read = items.select(F.col(item_col).alias("i"), text_of(item_text_col).alias("t"))
    size = read.agg(F.sum(F.greatest(F.octet_length("t"), F.lit(ITEM_BYTES)))).first()[0] or 0
    parts = -(-size // block_bytes) or 1
    if parts == 1:
        blocks = [read]
    else:
        dealt = stage(read.withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(parts))), "search-items")
        blocks = [dealt.filter(F.col("part") == k).drop("part") for k in range(parts)]
    found = [_search_block(docs, [tuple(r) for r in b.collect()], kind, top, id_col, text_col, item_col) for b in blocks]
    return reduce(DataFrame.unionAll, found)
