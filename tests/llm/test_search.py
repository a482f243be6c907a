"""Ranked search against a plain scorer of every document for every item."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidegate.llm import search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, top=10):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    count, total = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    out = []
    for item, text in items:
        scored = []
        for d, bag in bags:
            if not bag:
                continue
            m, score = 25 + 75 * sum(bag.values()) * count // total, 0
            for t in terms(text):
                if tf := bag.get(t):
                    df = sum(t in b for _, b in bags)
                    score += math.floor(1000 * math.log((2.0 * count + 2) / (2 * df + 1))) * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, k, None if none else d, -s) for k, (s, none, d) in enumerate(sorted(scored)[:top], 1)]
    return out


def rows(frame):
    return [(r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect()]


def same(found, wanted):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3], r[2] is None, r[2] or 0)
    assert sorted(found, key=key) == sorted(wanted, key=key)


def made(seed, n, words="the of and Straße ÉTÉ x9 漢字 rare other".split()):
    rng = random.Random(seed)
    return [" ".join(rng.choices(words, [9, 7, 5, 2, 2, 1, 1, 0.2, 3], k=rng.randint(0, 30))) for _ in range(n)]


def test_terms_are_the_pattern():
    for seed in range(300):
        rng = random.Random(seed)
        text = "".join(rng.choice([*map(chr, range(128)), *"éÉßİ漢🙂 ­"]) for _ in range(60))
        assert [t.decode() for t in search.terms(text)] == terms(text)


@pytest.mark.parametrize("block_bytes", [search.BLOCK_BYTES, 1000])
def test_search_is_the_plain_scorer(spark, block_bytes):
    texts = made(1, 120)
    docs = [(k * 3, t) for k, t in enumerate(texts)] + [(1000 + k, texts[k % 5]) for k in range(60)] + [(None, texts[3]), (5000, None), (5001, ""), (5002, "?! ..")]
    docs += [(9, texts[7]), (9, texts[7])]  # an id that three rows have
    items = [(k, t) for k, t in enumerate(made(2, 12))] + [(50, None), (51, "..."), (52, "unseen words only"), (3, "rare RARE the")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").select("*", F.lit("x").alias("n"), F.lit(0).alias("key")).repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string")
    same(rows(search.search(frame, asked, block_bytes=block_bytes)), plain(docs, items))


def test_large_class_is_expanded_by_rising_id(spark):
    docs = [(5000 - k, "alpha beta gamma") for k in range(4000)] + [(9000, "alpha alpha"), (9001, "delta")] * 3
    items = [(1, "alpha"), (2, "beta delta")]
    same(rows(search.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))), plain(docs, items))


def test_no_rows(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert rows(search.search(docs.filter("false"), items)) == rows(search.search(docs, items.filter("false"))) == []


def test_scores_beyond_double_precision_stay_exact():
    import numpy as np

    scorer = search.Scorer(np.array([18_000]), [{0: 10**6}], 10)
    assert scorer.kind is np.int64
    assert scorer.scores([np.array([0])], [np.array([7])], np.array([113])).tolist() == [[18_000 * 10**6 * (7 * 10**9 // (7000 + 8 * 113))]]
