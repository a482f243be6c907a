"""The classifier's sample, whatever repeats in the rows, and its risk against a plain minimiser."""

import numpy as np
import pytest

from tidegate.llm import quality


def sampled(spark, rows, parts=4, sample=300):
    return quality._matrix(spark.createDataFrame(rows, "id long, text string").repartition(parts), sample)


def test_copies_of_one_row_are_drawn_by_their_share(spark):
    """A plain draw by id would take all of the copies or none."""
    x = sampled(spark, [(None, "the same text")] * 20_000 + [(i, f"text of its own {i} " * (i % 5 + 1)) for i in range(5_000)])
    copies = (x == quality.features(b"the same text")).all(axis=1).sum()
    assert abs(copies - 300 * 0.8) <= 1 and abs(len(x) - 300) < 40


@pytest.mark.parametrize("some_id", [7, None])
def test_texts_of_one_id_are_drawn_one_by_one(spark, some_id):
    rows = [(some_id, f"line {i}\n" * (i % 17 + 1)) for i in range(5_000)]
    x = sampled(spark, rows)
    assert abs(len(x) - 300) < 80
    assert np.array_equal(x, sampled(spark, rows[::-1], parts=11))


def test_small_tables_are_taken_whole(spark):
    x = sampled(spark, [(1, "a"), (1, "a"), (2, ""), (None, "b b")])
    assert sorted(map(bytes, x)) == sorted(quality.features(t).tobytes() for t in (b"a", b"a", b"", b"b b"))
    assert sampled(spark, []).shape == (0, quality.SIZE)


def test_repeated_positives_reach_the_driver_by_the_bound(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", lambda p, u: seen.append((len(p), len(u))))
    docs = spark.createDataFrame([(1, f"text {i % 900}") for i in range(9_000)], "doc_id long, text string")
    quality.train(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"), sample=200)
    assert all(100 < n < 300 for n in seen[0])


def test_risk_is_that_of_a_plain_minimiser():
    """Newton steps by finite differences on the written-out risk, where the negatives' part stays above zero."""
    rng, prior, decay = np.random.default_rng(2), 0.4, 1e-2
    p = rng.normal([1, 0.5], 1, (3000, 2))
    u = np.where(rng.random((3000, 1)) < prior, rng.normal([1, 0.5], 1, (3000, 2)), rng.normal([-0.5, -0.5], 1, (3000, 2)))

    def risk(w):
        zp, zu = p @ w[:2] + w[2], u @ w[:2] + w[2]
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        return prior * np.logaddexp(0, -zp).mean() + max(0, negative) + decay / 2 * (w[:2] ** 2).sum()

    plain, e = np.zeros(3), 1e-4 * np.eye(3)
    for _ in range(30):
        slope = np.array([(risk(plain + d) - risk(plain - d)) / 2e-4 for d in e])
        bend = np.array([[(risk(plain + a + b) - risk(plain + a - b) - risk(plain - a + b) + risk(plain - a - b)) / 4e-8 for a in e] for b in e])
        plain = plain - np.linalg.solve(bend, slope)
    weights, bias = quality._descend(p, u, prior, 3000)
    assert np.abs(np.r_[weights, bias] - plain).max() < 0.02 and risk(np.r_[weights, bias]) < risk(plain) + 1e-4


def test_negative_part_does_not_fall_far_below_zero():
    """An unbiased risk alone would be driven ever lower by few rows in many dimensions."""
    rng = np.random.default_rng(3)
    p, u = rng.normal(0.3, 1, (40, 60)), rng.normal(0, 1, (40, 60))
    weights, bias = quality._descend(p, u, 0.9, 2000, decay=0.0)
    negative = np.logaddexp(0, u @ weights + bias).mean() - 0.9 * np.logaddexp(0, p @ weights + bias).mean()
    assert negative > -0.2


def test_scoring_holds_few_rows_at_once(spark, monkeypatch):
    """A batch of many short texts is not one matrix."""

    class Sizes:
        def score(self, x):
            return np.full(len(x), float(len(x)))

    monkeypatch.setattr(quality, "train", lambda *_: Sizes())
    docs = spark.range(0, 3000, 1, 1).selectExpr("id as doc_id", "'a few words' as text")
    scores = [r.score for r in quality.classify(docs, spark.createDataFrame([], "doc_id long, quality int")).collect()]
    assert len(scores) == 3000 and min(scores) >= 1 and max(scores) <= 1000
