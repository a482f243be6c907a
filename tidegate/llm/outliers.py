"""Quality rules: fixed base rules, then robust multivariate outliers within each language and source.

Eight transformed statistics of a text are compared with a minimum-covariance-determinant estimate of its stratum. Five
vary from text to text everywhere (size, word length, distinct words, punctuation, capitals); three are zero for most texts
(symbols, repeated lines, repeated windows), and there the unit is taken from the texts that have any, so that having a few
is no outlier by itself. Concentration steps from several starts (coordinate-wise median and MAD, all rows, two halves by
hash) keep the rows nearest in Mahalanobis distance and re-estimate until no determinant falls; the start with the
smallest determinant wins and is reweighted once. Texts beyond a squared distance are rejected.

The covariance is regularised towards that of the language, and this towards that of the whole table, as if so many of
their rows were among each stratum's: strata of any size are estimated alike, large ones by their own rows.

Statistics are integers (1/1024 of a transformed unit), so all sums are exact and the verdict does not depend on the
order of rows. A step is one aggregate over (stratum, distance bin): nothing of a stratum is gathered anywhere, and the
share to keep is counted off whole bins.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import cache
from math import exp, lgamma, log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACE, stage, text_of

#: Share of a stratum whose covariance determinant is minimised.
COVERAGE = 0.75
#: Rows of the enclosing stratum that a stratum's moments are regularised by.
BORROWED = 30
#: A step has converged when no root of a determinant falls by more than this share.
SETTLED = 1e-3
#: Least standard deviation of a transformed statistic. Where most texts have zero, it is this share of the median of the others.
FLOOR, HURDLE = 0.03, 1 / 3
_DIM, _UNIT = 8, 1024
_SPARSE = (5, 6, 7)
_X = [f"x{i}" for i in range(_DIM)]
_LOW = [(i, j) for i in range(_DIM) for j in range(i + 1)]
_COLUMNS = [f"m{i}" for i in range(_DIM)] + [f"l{i}{j}" for i, j in _LOW]
#: Estimates of so many strata (some 400 bytes each) are broadcast; more are joined by shuffling, hot strata split.
_BROADCAST_STRATA = 20_000
# Punctuation and capital letters that are counted.
_PUNCTUATION = ".,;:!?\"'()-…«»„“”"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"


def _chi2_cdf(x: float, k: int) -> float:
    a, term, total, n = k / 2, 2 / k, 2 / k, 0
    while term > 1e-15 * total:
        n += 1
        term *= x / 2 / (a + n)
        total += term
    return total * exp(-x / 2 + a * log(x / 2) - lgamma(a))


def _chi2_quantile(p: float, k: int) -> float:
    low, high = 1e-9, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi2_cdf(middle, k) < p else (low, middle)
    return high


#: Share of the squared distances of so many normal variables that is kept, and the distance beyond which a text is rejected.
QUANTILE = 1 - 1e-6
CUTOFF = _chi2_quantile(QUANTILE, _DIM)


def _consistency(share: float) -> float:
    """What a covariance of the nearest ``share`` of normal rows is to be multiplied by."""
    return share / _chi2_cdf(_chi2_quantile(share, _DIM), _DIM + 2)


def statistics(docs: DataFrame, keep: list[Column], text_col: str = "text") -> DataFrame:
    """``keep`` and the counts of each whole text; null has no words. Windows of three words are told apart by 64-bit hashes."""
    counted = docs.select(*keep, text_of(text_col).alias("__t")).select(
        *_named(keep),
        F.length(F.translate("__t", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        *((F.length("__t") - F.length(F.translate("__t", c, ""))).cast("long").alias(n) for c, n in (("#*$%&|<>", "n_symbols"), (_PUNCTUATION, "n_marks"), (_CAPITALS, "n_capitals"))),
        F.filter(F.split("__t", "\n"), lambda x: x.rlike(f"[^{SPACE}]")).alias("__lines"),
        F.filter(F.split("__t", f"[{SPACE}]+"), lambda x: x != "").alias("__w"),
    )
    hashed = counted.select(
        *_named(keep), "word_chars", "n_symbols", "n_marks", "n_capitals",
        F.size("__w").cast("long").alias("n_words"),
        F.size(F.array_distinct("__w")).cast("long").alias("n_distinct"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.expr("transform(slice(__w, 1, greatest(size(__w) - 2, 0)), (w, i) -> struct(xxhash64(w, __w[i + 1], __w[i + 2]) as h, i as i))").alias("__win"),
    )
    rest = ["word_chars", "n_symbols", "n_marks", "n_capitals", "n_words", "n_distinct", "n_lines", "n_dup_lines"]
    ordered = hashed.select(*_named(keep), *rest, F.sort_array("__win").alias("__win"))
    found = ordered.select(
        *_named(keep), *rest,
        F.expr("sort_array(transform(filter(__win, (p, j) -> p.h = get(__win, j - 1).h or p.h = get(__win, j + 1).h), p -> p.i))").alias("__at"),
    )
    covered = F.expr("aggregate(transform(__at, (p, j) -> cast(least(3, coalesce(get(__at, j + 1) - p, 3)) as bigint)), 0L, (a, x) -> a + x)")
    return found.select(*_named(keep), *rest, covered.alias("n_repeat_words"))


def _named(columns: list[Column]) -> list[str]:
    return [f"__k{i}" for i in range(len(columns))]


def _transformed() -> list[Column]:
    """The statistics as integers of 1/1024, all but the distinct words on a logarithmic scale."""
    words, lines, chars = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1)), F.greatest("word_chars", F.lit(1))
    values = [
        F.log1p("n_words"),
        F.log1p(F.col("word_chars") / words),
        4 * F.log1p("n_distinct") / F.log1p(words),
        F.log1p(100 * F.col("n_marks") / chars),
        F.log1p(100 * F.col("n_capitals") / chars),
        F.log1p(100 * F.col("n_symbols") / chars),
        F.log1p(100 * F.col("n_dup_lines") / lines),
        F.log1p(100 * F.col("n_repeat_words") / words),
    ]
    return [F.floor(v * _UNIT + 0.5).cast("long").alias(x) for v, x in zip(values, _X, strict=True)]


def _near(rows: DataFrame, small: DataFrame, n: int | None = None) -> DataFrame:
    """Rows with their stratum's estimates, of which there are ``n`` (counted where it is not known)."""
    return rows.join(F.broadcast(small) if (small.count() if n is None else n) <= _BROADCAST_STRATA else small, "stratum")


def _distance(rows: DataFrame) -> DataFrame:
    """``d2`` of rows that carry means ``m*`` and the Cholesky factor ``l*``."""
    steps = []
    for i in range(_DIM):
        moved = f"({_X[i]} / {_UNIT}D - m{i})" + "".join(f" - l{i}{j} * z{j}" for j in range(i))
        steps.append(f"({moved}) / l{i}{i} AS z{i}")
    squares = " + ".join(f"z{i} * z{i}" for i in range(_DIM))
    return rows.selectExpr("*", *steps, f"{squares} AS d2").drop(*(f"z{i}" for i in range(_DIM)))


@cache
def _sums() -> list[Column]:
    """Built once: a plan of three levels and their rounds takes them dozens of times."""
    products = [F.expr(f"sum({_X[i]} * {_X[j]}) AS q{i}{j}") for i, j in _LOW]
    return [F.count("*").alias("n"), *(F.sum(x).alias(f"s{i}") for i, x in enumerate(_X)), *products]


@cache
def _added() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("n", *(f"s{i}" for i in range(_DIM)), *(f"q{i}{j}" for i, j in _LOW))]


class Estimator:
    """Minimum-covariance-determinant estimates of strata, by the least standard deviations of this table's statistics."""

    def __init__(self, floors: list[float]):
        self.floors = floors

    def moments(self, per: DataFrame, keys: list[str], target: DataFrame | None) -> DataFrame:
        """Means and Cholesky factors from counts ``n``, sums ``s*`` and sums of products ``q*`` of ``stratum`` and its ``parent``."""
        total = per.groupBy(*keys).agg(*_added())
        if target is None:
            borrowed, lent = "0D", {c: "0D" for c in _COLUMNS}
        else:
            named = target.selectExpr("stratum AS parent", *(f"{c} AS t{c}" for c in _COLUMNS))
            total, borrowed, lent = total.join(named, "parent"), f"{BORROWED}D", {c: f"t{c}" for c in _COLUMNS}
        all_ = f"(n + {borrowed})"
        means = [f"(s{i} / {_UNIT}D + {borrowed} * {lent[f'm{i}']}) / {all_} AS m{i}" for i in range(_DIM)]
        products = []
        for i, j in _LOW:
            theirs = " + ".join([f"{lent[f'm{i}']} * {lent[f'm{j}']}", *(f"{lent[f'l{i}{k}']} * {lent[f'l{j}{k}']}" for k in range(j + 1))])
            products.append(f"(q{i}{j} / {_UNIT * _UNIT}D + {borrowed} * ({theirs})) / {all_} AS q{i}{j}")
        out = total.selectExpr(*keys, *means, *products)
        entries = [f"greatest(q{i}{i} - m{i} * m{i}, {self.floors[i] ** 2}D)" if i == j else f"q{i}{j} - m{i} * m{j}" for i, j in _LOW]
        out = out.selectExpr(*keys, *_COLUMNS[:_DIM], f"array({', '.join(entries)}) AS c")
        # Cholesky's factor entry by entry, rows in order: p is a place in the lower triangle, k runs before its column.
        rows_of, columns_of = (f"array({', '.join(str(x[k]) for x in _LOW)})" for k in (0, 1))
        least = f"array({', '.join(f'{f * f / 4}D' for f in self.floors)})"
        i, j = f"{rows_of}[p]", f"{columns_of}[p]"
        left = f"c[p] - aggregate(if({j} = 0, array(), sequence(0, {j} - 1)), 0D, (t, k) -> t + l[{i} * ({i} + 1) div 2 + k] * l[{j} * ({j} + 1) div 2 + k])"
        entry = f"if({i} = {j}, sqrt(greatest({left}, {least}[{i}])), ({left}) / l[{j} * ({j} + 1) div 2 + {j}])"
        factor = f"aggregate(sequence(0, {len(_LOW) - 1}), cast(array() as array<double>), (l, p) -> concat(l, array({entry})))"
        out = out.selectExpr(*keys, *_COLUMNS[:_DIM], f"{factor} AS f")
        return out.selectExpr(*keys, *_COLUMNS[:_DIM], *(f"f[{p}] AS l{i}{j}" for p, (i, j) in enumerate(_LOW)))

    def starts(self, rows: DataFrame, target: DataFrame | None) -> DataFrame:
        middle = stage(rows.groupBy("stratum", "parent").agg(*(F.median(x).alias(f"c{i}") for i, x in enumerate(_X))), "mcd-medians")
        spread = _near(rows.drop("parent"), middle).groupBy("stratum", "parent").agg(*(F.median(F.abs(F.col(x) - F.col(f"c{i}"))).alias(f"a{i}") for i, x in enumerate(_X)))
        flat = [F.lit(0.0).alias(f"l{i}{j}") for i, j in _LOW if i != j]
        by_median = middle.join(spread, ["stratum", "parent"]).select(
            "stratum", "parent", F.lit(0).alias("start"), *(F.expr(f"c{i} / {_UNIT}D").alias(f"m{i}") for i in range(_DIM)),
            *(F.expr(f"greatest(1.4826D * a{i} / {_UNIT}D, {self.floors[i]}D)").alias(f"l{i}{i}") for i in range(_DIM)), *flat,
        )
        halves = rows.groupBy("stratum", "parent", (F.col("half") + 2).alias("start")).agg(*_sums())
        parts = stage(halves, "mcd-halves")
        sums = parts.unionByName(parts.withColumn("start", F.lit(1)))  # both halves together are all rows
        return by_median.unionByName(self.moments(sums, ["stratum", "parent", "start"], target).withColumn("start", F.col("start").cast("int")))

    def concentrate(self, rows: DataFrame, estimate: DataFrame, target: DataFrame | None, n: int) -> DataFrame:
        """One step of ``n`` estimates of strata and starts: the nearest rows, by whole distance bins, give the next estimate."""
        apart = _distance(_near(rows.drop("parent"), estimate, n)).withColumn("bin", F.floor(F.log1p(F.least("d2", F.lit(1e12))) * 32))
        bins = apart.groupBy("stratum", "parent", "start", "bin").agg(*_sums())
        nearer = Window.partitionBy("stratum", "start").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        share = bins.withColumn("before", F.coalesce(F.sum("n").over(nearer), F.lit(0))).withColumn("all", F.sum("n").over(Window.partitionBy("stratum", "start")))
        return self.moments(share.filter(F.col("before") < F.col("all") * COVERAGE), ["stratum", "parent", "start"], target)

    def estimates(self, rows: DataFrame, target: DataFrame | None = None) -> DataFrame:
        """Robust means and Cholesky factors per ``stratum`` from its rows ``x*``; ``parent`` names its stratum in ``target``."""
        volume = F.expr(" * ".join(f"l{i}{i}" for i in range(_DIM)))
        packed = f"struct(parent, {', '.join(_COLUMNS)}, volume)"
        state = self.starts(rows, target).withColumn("volume", F.lit(float("inf")))
        state = stage(state.selectExpr("stratum", "start", f"{packed} AS now", f"{packed} AS best", "true AS fell"), "mcd-start")
        # A round is one written table; only estimates whose determinant still falls take another step. Every round lowers a
        # determinant, and they have a lower bound.
        while falling := state.agg(F.count_if("fell").alias("n")).first()["n"]:
            step = self.concentrate(rows, state.filter("fell").select("stratum", "start", *(f"now.{c}" for c in ("parent", *_COLUMNS))), target, falling)
            step = step.withColumn("volume", volume).selectExpr("stratum", "start", f"{packed} AS new")
            both = state.join(step, ["stratum", "start"], "left")
            falls = F.coalesce(F.col("new.volume") < F.col("best.volume") * (1 - SETTLED), F.lit(False))
            state = stage(both.select("stratum", "start", F.coalesce("new", "now").alias("now"), F.when(falls, F.col("new")).otherwise(F.col("best")).alias("best"), falls.alias("fell")), "mcd-step")
        best = state.select("stratum", "start", "best.*")
        won = stage(best.groupBy("stratum").agg(F.min_by(F.struct("parent", *_COLUMNS), F.struct("volume", "start")).alias("e")).select("stratum", "e.*"), "mcd-won")
        raw, near = _consistency(COVERAGE), 0.975
        weighed = _distance(_near(rows.drop("parent"), won)).withColumn("near", F.col("d2") / raw <= _chi2_quantile(near, _DIM))
        # Left out as sums: a filter on rows would be pushed through the distance and repeat its steps. A stratum without a
        # near row has what it borrows.
        sums = stage(weighed.groupBy("stratum", "parent", "near").agg(*_sums()), "mcd-near")
        sums = sums.selectExpr("stratum", "parent", *(f"if(near, {c}, 0L) AS {c}" for c in sums.columns[3:]))
        final = self.moments(sums, ["stratum", "parent"], target)
        grown = _consistency(near) ** 0.5
        return stage(final.select("stratum", *_COLUMNS[:_DIM], *(F.expr(f"l{i}{j} * {grown}D").alias(f"l{i}{j}") for i, j in _LOW)), "mcd-final")


@contextmanager
def _without_stage_code(spark: SparkSession):
    """Plan the rounds without code of whole stages: the driver would generate, compile and keep some of it for every round."""
    key = "spark.sql.codegen.wholeStage"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def estimator(rows: DataFrame) -> Estimator:
    """With the least deviations that this table's statistics ask for."""
    typical = rows.agg(*(F.median(F.when(F.col(_X[i]) > 0, F.col(_X[i]))).alias(f"t{i}") for i in _SPARSE)).first()
    return Estimator([max(FLOOR, HURDLE * (typical[f"t{i}"] or 0) / _UNIT) if i in _SPARSE else FLOOR for i in range(_DIM)])


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", cutoff: float = CUTOFF
) -> DataFrame:
    """One row per input row: id, the counts, ``base_failed``, ``kept``, ``distance`` (squared) and the transformed statistics ``x0`` to ``x7``.

    Base rule: under 50 words, or more than half the words in repeated windows of three. Null and empty texts have no
    words and fail it; null languages and sources are strata of their own; repeated rows count as often as they occur;
    an empty table gives no rows; other columns are not read.
    """
    lang, source = F.col(lang_col).cast("string"), F.col(source_col).cast("string")
    keys = [F.col(id_col).alias("__k0"), F.to_json(F.struct(lang.alias("l"), source.alias("s"))).alias("__k1"), F.to_json(F.struct(lang.alias("l"))).alias("__k2")]
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    named = {"__k0": "id", "__k1": "stratum", "__k2": "language"}
    rows = stage(statistics(docs, keys, text_col).withColumn("base_failed", base).withColumnsRenamed(named).select("*", *_transformed()), "rule-statistics")
    half = F.pmod(F.xxhash64("id", *_X), F.lit(2)).alias("half")
    judged_by = rows.filter("not base_failed").select("stratum", "language", half, *_X)
    with _without_stage_code(docs.sparkSession):
        mcd = estimator(judged_by)
        whole = mcd.estimates(judged_by.select(F.lit("").alias("stratum"), F.lit("").alias("parent"), "half", *_X))
        languages = mcd.estimates(judged_by.select(F.col("language").alias("stratum"), F.lit("").alias("parent"), "half", *_X), whole)
        found = mcd.estimates(judged_by.select("stratum", F.col("language").alias("parent"), "half", *_X), languages)
    judged = _distance(rows.join(F.broadcast(found) if found.count() <= _BROADCAST_STRATA else found, "stratum", "left"))
    return judged.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("d2") <= cutoff, F.lit(True))).alias("kept"), F.col("d2").alias("distance"), *_X,
    )
