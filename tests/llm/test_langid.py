"""The random field against enumeration of all labelings, plain gradients, and held-out accuracy."""

import itertools
import pickle
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.llm import langid, registry

SF = "/root/testdata/sf0.01"
STOCK = {
    "en": "the house stands with wooden windows near thinking people who were walking through weather",
    "de": "das große haus steht mit schönen fenstern über straßen durch welche leute gingen und dachten",
    "fr": "la maison près des fenêtres où les gens marchaient avec plaisir était très belle aujourd hui",
}


def enumerated(scores, transition):
    """Word probabilities of one chain, and the log of its normaliser, over all labelings."""
    n, size = scores.shape
    held, total = np.zeros((n, size)), 0.0
    for path in itertools.product(range(size), repeat=n):
        p = np.exp(sum(scores[t, y] for t, y in enumerate(path)) + sum(transition[x, y] for x, y in zip(path, path[1:])))
        total += p
        for t, y in enumerate(path):
            held[t, y] += p
    return held / total, np.log(total)


@pytest.mark.parametrize("window", [1, 2, 3, 64])
def test_messages_give_the_enumerated_probabilities(window):
    rng = np.random.default_rng(3)
    lengths = np.array([1, 7, 2, 6, 3, 1])
    scores, transition = rng.normal(0, 2, (lengths.sum(), 3)), rng.normal(0, 1, (3, 3))
    forward, backward, _ = langid.messages(scores, lengths, transition, window)
    wanted = np.concatenate([enumerated(s, transition)[0] for s in np.split(scores, np.cumsum(lengths)[:-1])])
    assert np.allclose(langid.marginals(forward, backward), wanted)


def test_long_chains_do_not_depend_on_windows():
    rng = np.random.default_rng(4)
    lengths = np.array([5000, 1, 64, 65, 700])
    scores, transition = rng.normal(0, 9, (lengths.sum(), 4)), rng.normal(0, 2, (4, 4))
    one = langid.marginals(*langid.messages(scores, lengths, transition, 64)[:2])
    assert np.isfinite(one).all() and np.allclose(one, langid.marginals(*langid.messages(scores, lengths, transition, 5000)[:2]))


def switching(n, seed, low=3, high=8):
    rng, texts, answers = random.Random(seed), [], []
    for _ in range(n):
        words, truth = [], []
        for _ in range(rng.randint(1, 4)):
            lang = rng.choice(sorted(STOCK))
            some = [rng.choice(STOCK[lang].split()) for _ in range(rng.randint(low, high))]
            words += some
            truth += [lang] * len(some)
        texts.append(words)
        answers.append(truth)
    return texts, answers


def test_learning_lowers_the_loss_and_finds_that_languages_go_on():
    texts, truth = switching(60, 1)
    names = sorted(STOCK)
    answers = [np.array([names.index(x) for x in t]) for t in truth]

    def loss(field):
        out = 0.0
        for words, y in zip(texts[:8], answers[:8]):
            scores = np.array([field.weights[langid.features(w, {})].sum(axis=0) for w in words[:7]])
            path = y[:7]
            gold = scores[np.arange(len(path)), path].sum() + sum(field.transition[a, b] for a, b in zip(path, path[1:]))
            out += enumerated(scores, field.transition)[1] - gold
        return out

    field = langid.Field(names, {})
    before = loss(field)
    field.learn(texts, answers, rounds=3, batch=10)
    assert loss(field) < before / 3
    assert all(field.transition[k, k] > np.delete(field.transition[k], k).max() for k in range(3))


def test_code_switched_words_are_labelled():
    rng = random.Random(5)
    sample = [(lang, " ".join(rng.choices(words.split(), k=40))) for lang, words in STOCK.items() for _ in range(30)]
    field = langid.learned(sample)
    texts, truth = switching(80, 9)
    found = [[field.languages[k] for k in p.argmax(axis=1)] for p in pickle.loads(pickle.dumps(field)).label(texts)]
    right = [x == y for a, b in zip(found, truth) for x, y in zip(a, b)]
    assert sum(right) / len(right) > 0.95


def test_remembering_changes_nothing(monkeypatch):
    field = langid.learned([(lang, words) for lang, words in STOCK.items()])
    texts, _ = switching(40, 2)
    whole = field.label(texts)
    monkeypatch.setattr(langid, "REMEMBERED", 5)
    field._forget()
    assert all(np.allclose(a, b) for a, b in zip(whole, [p for t in texts for p in field.label([t])]))


def test_held_out_accuracy(spark):
    out = registry.op12_language_id(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text")
    rows = out.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    judged = [r for r in rows if r.held_out and r.lang and any(c.isalpha() for c in r.text or "")]
    assert sum(r.lang_pred == r.lang for r in judged) / len(judged) > 0.97


def rows_of(frame):
    return {(r.doc_id, r.n): (r.lang_pred, round(r.score, 6), r.runs) for r in frame.select("doc_id", F.col("doc_id").alias("n"), "lang_pred", "score", "runs").collect()}


def test_awkward_rows(spark):
    rng = random.Random(6)
    docs = [(k, " ".join(rng.choices(STOCK[lang].split(), k=30)), lang) for k in range(300) for lang in [sorted(STOCK)[k % 3]]]
    odd = [(1001, None, "en"), (1002, "", "de"), (1003, "12 ² ?! _", "fr"), (1004, "the house " * 60_000, None), (1004, "the house " * 60_000, None), (None, "das große haus", "xx"), (1005, "漢字 🙂", None)]
    frame = spark.createDataFrame(docs + odd, "doc_id long, text string, lang string").select("*", *(F.lit("x").alias(c) for c in ("id", "t", "draw", "score", "runs_of", "n", "shares")))
    found = langid.identify(frame).collect()
    by = {r.doc_id: r for r in found}
    assert len(found) == len(docs) + len(odd)
    assert all((by[k].lang_pred, by[k].score, by[k].runs) == ("und", 0.0, []) for k in (1001, 1002, 1003))
    assert by[1004].lang_pred == "en" and [r.words for r in by[1004].runs] == [120_000]
    assert by[None].lang_pred == "de" and by[None].held_out is False
    assert all(by[k].lang_pred == lang for k, _, lang in docs) and by[1005].lang_pred in STOCK  # "xx" has a null id only: not learned
    assert abs(sum(by[0].shares.values()) - 1) < 1e-6
    assert langid.identify(frame.filter("false")).collect() == []
    assert {(r.lang_pred, r.score) for r in langid.identify(frame.withColumn("lang", F.lit(None).cast("string"))).collect()} == {("und", 0.0)}
    alone = {(r.lang_pred, r.score) for r in langid.identify(frame.withColumn("lang", F.lit("en"))).collect()}
    assert alone == {("en", 1.0), ("und", 0.0)}


def test_sample_is_bounded_and_spans_repeated_rows(spark):
    same = spark.range(5000).select(F.lit(4).cast("long").alias("doc_id"), F.lit("the house stands").alias("text"), F.lit("en").alias("lang"))
    other = spark.range(900).select("id", F.concat(F.lit("das haus "), "id"), F.lit("de")).toDF("doc_id", "text", "lang")
    rows = langid.drawn(same.union(other), "doc_id", "text", "lang", 50, 10, 5)
    count = {x: sum(lang == x for lang, _ in rows) for x in ("en", "de")}
    assert 0 < count["en"] <= 50 and 20 < count["de"] <= 50 and all(len(t) <= 10 for _, t in rows)
