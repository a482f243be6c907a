"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text are all that the risk sees. The class prior is estimated from how far the
unlabelled scores reach below those of the positives; then the non-negative unbiased risk
``prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))`` is minimised for a linear model on statistics
of the characters, words and lines of a text. Labels below 1, language, source and id are inputs of nothing.

The model is fitted on bounded samples (``SAMPLE`` rows of each kind) and is a few kilobytes; every document is scored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, text_of

#: Rows of the positives and of the unlabelled texts that the model is fitted on, at most (in expectation).
SAMPLE = 6000
#: Partitions that the sample is dealt to.
LEAST_PARTS = 64
#: Score from which a text is predicted to be good.
THRESHOLD = 0.7
#: Texts scored at once: a matrix of a megabyte, whatever the size of a batch.
SCORED = 512
SEED = 42
FOLDS, HELD_OUT = 4, 2

_CLASSES = 18


def _byte_classes() -> np.ndarray:
    classes = np.full(256, 15, np.uint8)
    for k, members in enumerate((b" \t\x0b\x0c\r", b"\n", bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58)), bytes(range(128, 256)), b".", b",;:", b"!", b"?", b"*", b"#", b"$%&", b"|", b"'\"()-")):
        classes[list(members)] = k
    classes[list(b"<>{}[]")] = 16
    classes[list(b"/@=\\_")] = 17
    return classes


_CLASS = _byte_classes()
SIZE = 12 + _CLASSES * _CLASSES


def features(text: bytes) -> np.ndarray:
    """Statistics of a whole text: sizes, repetition, and the shares of neighbouring character classes. Zeros for an empty one."""
    out = np.zeros(SIZE, np.float32)
    words = text.split()
    if not words:
        return out
    n = len(words)
    counts = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    letters = sum(map(len, words))
    pairs = Counter(zip(words, words[1:]))
    out[:12] = (
        np.log1p(n),
        letters / n,
        np.log1p(len(lines)),
        np.log1p(n / len(lines)),
        1 - len(set(lines)) / len(lines),
        np.log(len(counts)) / np.log(n) if n > 1 else 1.0,
        1 - len(pairs) / max(1, n - 1),
        max(counts.values()) / n,
        sum(c for w, c in counts.items() if w.isupper()) / n,
        sum(c for w, c in counts.items() if len(w) == 1) / n,
        sum(map(eq, words, words[1:])) / n,
        np.log1p(20 * (1 - len(pairs) / max(1, n - 1))),
    )
    kind = _CLASS[np.frombuffer(text, np.uint8)]
    pair = kind[:-1].astype(np.int64) * _CLASSES + kind[1:]
    out[12:] = np.log1p(np.bincount(pair, minlength=_CLASSES * _CLASSES) * (1000.0 / max(1, len(pair))))
    return out


@dataclass(frozen=True)
class Model:
    """A linear model of standardised features; ``prior`` is the estimated share of positives."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of the positive class."""
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _descend(p: np.ndarray, u: np.ndarray, prior: float | None, steps: int, rate: float = 0.02, decay: float = 1e-2) -> tuple[np.ndarray, float]:
    """Adam on the non-negative risk with logistic loss; without a prior, on positives against unlabelled, equally weighted."""
    w, m, v = (np.zeros(p.shape[1] + 1) for _ in range(3))
    p, u = (np.hstack([x, np.ones((len(x), 1))]) for x in (p, u))
    for t in range(1, steps + 1):
        zp, zu = p @ w, u @ w
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        up = p.T @ (sp - 1) / len(p)  # of the loss of positives taken as positive
        down_p, down_u = p.T @ sp / len(p), u.T @ su / len(u)  # taken as negative
        if prior is None:
            g = up + down_u
        else:
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            g = prior * up + (down_u - prior * down_p) if negative >= 0 else -(down_u - prior * down_p)
        g[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives in the unlabelled scores: the least ratio of the two tails above a threshold.

    Negatives lie low, so above a threshold that still passes most positives the unlabelled tail is the positives' share
    of it and little else.
    """
    cuts = np.quantile(positive, np.linspace(0.005, 0.5, 100))
    tail_p = 1 - np.searchsorted(np.sort(positive), cuts) / len(positive)
    tail_u = 1 - np.searchsorted(np.sort(unlabelled), cuts) / len(unlabelled)
    return float(np.clip((tail_u / tail_p).min(), 0.05, 0.98))


def fit(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 300) -> Model:
    """The model of both samples. The prior is the mean of two estimates, each from a half that its scorer has not seen."""
    both = np.vstack([positive, unlabelled]).astype(np.float64)
    mean, scale = both.mean(axis=0), both.std(axis=0)
    scale = np.where(scale < 1e-6, 1.0, np.maximum(scale, 0.05))
    p, u = (np.clip((x - mean) / scale, -8, 8) for x in (positive.astype(np.float64), unlabelled.astype(np.float64)))
    estimates = []
    for half in (0, 1):
        if min(len(p), len(u)) > 1:
            w, b = _descend(p[half::2], u[half::2], None, steps)
            estimates.append(estimate_prior(p[1 - half :: 2] @ w + b, u[1 - half :: 2] @ w + b))
    prior = float(np.mean(estimates)) if estimates else 0.5
    w, b = _descend(p, u, prior, steps)
    return Model(mean, scale, w, b, prior)


def fold(id_col: str) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)).cast("int")


def _matrix(docs: DataFrame, sample: int) -> np.ndarray:
    """Features of about ``sample`` rows, in a fixed order.

    A text with an id is drawn by a hash of both, and of its ``n`` copies a share of ``n``, rounded up or down by that hash:
    however rows repeat, about ``sample`` vectors reach the driver, whatever the order and partitions of the rows.
    """
    keyed = docs.select(F.xxhash64(F.lit(SEED), "id", "text").alias("g"), "text")
    groups = stage(keyed.groupBy("g").agg(F.count("*").alias("n")), "quality-groups")
    share = min(1.0, sample / max(1, groups.agg(F.sum("n")).first()[0] or 0))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(SEED + 2), "g"), 12) / F.lit(float(1 << 52))
    drawn = groups.select("g", F.floor(F.col("n") * share + draw).alias("k")).filter("k > 0")
    taken = keyed.join(F.broadcast(drawn), "g")  # groups: at most about SAMPLE, by the share
    once = taken.repartition(LEAST_PARTS, "g").groupBy("g").agg(F.first("k").alias("k"), F.first("text").cast("binary").alias("text"))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([features(t).tobytes() for t in b.column(2).to_pylist()], pa.binary())], ["g", "k", "x"])

    got = sorted((r.g, r.k, bytes(r.x)) for r in once.mapInArrow(part, "g long, k long, x binary").collect())
    vectors = np.array([np.frombuffer(x, np.float32) for _, _, x in got]).reshape(-1, SIZE)
    return np.repeat(vectors, [k for _, k, _ in got], axis=0) if got else vectors


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Model | None:
    """The model from the training folds; None without positives or without texts."""
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).filter(fold("id") != HELD_OUT)
    trusted = labels.filter(F.col(label_col) == 1).select(F.col(id_col).alias("id")).filter("id is not null").distinct()
    trusted = trusted.filter(fold("id") != HELD_OUT)
    # the sample of labels is drawn before the texts are read, so only its ids meet the texts
    share = min(1.0, sample / max(1, trusted.count()))
    drawn = trusted.filter(F.shiftrightunsigned(F.xxhash64(F.lit(SEED + 1), "id"), 12) / F.lit(float(1 << 52)) < share)
    positive = _matrix(texts.join(F.broadcast(drawn), "id"), sample)  # ids only: at most about SAMPLE rows
    unlabelled = _matrix(texts, sample)
    return fit(positive, unlabelled) if len(positive) and len(unlabelled) else None


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """All columns of ``docs`` but those named so, and ``held_out``, ``score`` (0 to 1), ``predicted`` (1 from ``THRESHOLD``).

    Empty and null texts are scored by all-zero features; a null id is never held out; repeated rows have one score; with
    no labels to learn from every score is the neutral 0.5; an empty table gives no rows. Scoring is one pass, no shuffle.
    """
    model = train(docs, labels, id_col, text_col, label_col, sample)
    others = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    rows = docs.select(*(F.col(f"`{c}`") for c in others), text_of(text_col).cast("binary").alias("__bytes"))
    schema = rows.drop("__bytes").withColumn("score", F.lit(0.0)).schema

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = np.full(b.num_rows, 0.5)
            for lo in range(0, b.num_rows if model else 0, SCORED):
                texts = b.column(b.num_columns - 1).slice(lo, SCORED)
                scores[lo : lo + SCORED] = model.score(np.array([features(t.as_py()) for t in texts]))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(scores, pa.float64())], [*others, "score"])

    return rows.mapInArrow(part, schema).select(
        *(F.col(f"`{c}`") for c in others), (fold(id_col) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
