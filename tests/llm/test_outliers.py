"""The verdict of the quality rules against a plain minimum-covariance-determinant estimate, and what it goes by."""

import math
import random

import numpy as np
import pytest

from tidegate.llm import outliers
from tidegate.llm.common import table

K, SHARE = outliers.BORROWED, outliers.COVERAGE


def plain_moments(x, floors, target):
    """Mean and covariance, with so many rows of the target's moments among them; variances not below the floors."""
    n, s, q = len(x), x.sum(axis=0), x.T @ x
    if target is not None:
        m, c = target
        n, s, q = n + K, s + K * m, q + K * (c + np.outer(m, m))
    mean = s / n
    cov = q / n - np.outer(mean, mean)
    np.fill_diagonal(cov, np.maximum(np.diag(cov), floors**2))
    return mean, cov


def far(x, mean, cov):
    return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)


def plain_mcd(x, floors, target=None, tries=20, rng=np.random.default_rng(1)):
    """Concentration from many random starts: another search for the same minimum."""
    h, best = math.ceil(SHARE * len(x)), None
    for t in range(tries):
        start = x if t == 0 else x[rng.choice(len(x), min(len(x), max(3, len(x) // 2)), replace=False)]
        estimate, last = plain_moments(start, floors, target), np.inf
        while True:
            estimate = plain_moments(x[np.argsort(far(x, *estimate), kind="stable")[:h]], floors, target)
            volume = np.linalg.det(estimate[1])
            if volume >= last * (1 - 1e-9):
                break
            last = volume
        if best is None or last < best[0]:
            best = last, estimate
    mean, cov = best[1]
    near = far(x, mean, cov) / outliers._consistency(SHARE) <= outliers._chi2_quantile(0.975, outliers._DIM)
    mean, cov = plain_moments(x[near].reshape(-1, x.shape[1]), floors, target)
    return mean, cov * outliers._consistency(0.975)


@pytest.fixture(scope="module")
def judged(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    out = outliers.quality_rules(docs).join(docs.select("doc_id", "lang", "source"), "doc_id").join(table(spark, "/root/testdata/sf0.01", "labels"), "doc_id", "left").toPandas()
    return out[~out.base_failed].sort_values("doc_id").reset_index(drop=True)


def transformed(frame):
    return frame[[f"x{i}" for i in range(8)]].to_numpy(float) / 1024


def test_kept_is_that_of_a_plain_estimate(judged):
    x = transformed(judged)
    floors = np.full(8, outliers.FLOOR)
    for i in outliers._SPARSE:
        floors[i] = max(outliers.FLOOR, outliers.HURDLE * np.median(x[x[:, i] > 0, i]))
    whole = plain_mcd(x, floors)
    d2 = np.full(len(x), np.nan)
    for _, some in judged.groupby("lang", dropna=False).groups.items():
        language = plain_mcd(x[some], floors, whole)
        for _, own in judged.loc[some].groupby("source", dropna=False).groups.items():
            d2[own] = far(x[own], *plain_mcd(x[own], floors, language))
    # Steps by whole bins and other starts end in estimates that differ a little; verdicts hardly do.
    assert ((d2 <= outliers.CUTOFF) == judged.kept).mean() > 0.985
    assert np.corrcoef(np.log(d2 + 1), np.log(judged.distance + 1))[0, 1] > 0.98


def test_no_single_statistic_decides(judged):
    x, gone = transformed(judged), ~judged.kept.to_numpy()
    for i in range(8):
        for sign in (1, -1):
            y = gone[np.argsort(-sign * x[:, i], kind="stable")]
            hits = np.cumsum(y)
            assert (2 * hits / (np.arange(1, len(y) + 1) + y.sum())).max() < 0.95
    for i in outliers._SPARSE[1:]:  # having some repeats is no reason by itself
        assert gone[x[:, i] > 0].mean() < 0.7


def test_good_texts_stay_and_bad_ones_go(judged):
    assert judged.kept[judged.quality == 1].mean() > 0.95 and judged.kept[judged.quality == 0].mean() < 0.1


def test_rejected_without_one_extreme_value(spark):
    """Statistics that each are common, together as in no other text of the stratum."""
    rng, rows = random.Random(3), []

    def text(words, size):
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(max(1, size + rng.randint(-1, 1)))) for _ in range(words))

    for i in range(600):  # longer texts have longer words
        step = rng.random()
        rows.append((i, text(int(60 * math.exp(3 * step)), 3 + round(8 * step))))
    rows += [(1000 + k, text(60, 11)) for k in range(3)] + [(2000 + k, text(1150, 3)) for k in range(3)]
    out = outliers.quality_rules(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' as lang", "'s' as source")).toPandas()
    kept = dict(zip(out.doc_id, out.kept))
    assert np.mean([kept[i] for i in range(600)]) > 0.99
    x = {r.doc_id: (r.x0, r.x1) for r in out.itertuples()}
    for k in (1000, 1001, 1002, 2000, 2001, 2002):
        inside = [all(min(x[i][c] for i in range(600)) <= x[k][c] + 60 and x[k][c] - 60 <= max(x[i][c] for i in range(600)) for c in (0, 1))]
        assert inside and not kept[k]


def test_small_strata_are_judged_by_what_encloses_them(spark):
    """A source with one text: an ordinary text stays, an odd one goes, whatever the number of rows."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    rows = [(i, " ".join(word() for _ in range(rng.randint(60, 300))), "s") for i in range(300)]
    rows += [(900, " ".join(word() for _ in range(150)), "alone"), (901, " ".join("#" * 5 + word() * 4 for _ in range(150)), "odd")]
    out = outliers.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "'en' as lang")).toPandas()
    kept = dict(zip(out.doc_id, out.kept))
    assert kept[900] and not kept[901]
