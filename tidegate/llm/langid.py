"""Language identification by a linear-chain conditional random field over words.

A word's features are its affixes, its character n-grams, itself, and how a lexicon sees it in each language; features
are hashed to weights, and transitions between languages are learned with them. Texts that switch language are made for
learning out of stretches of texts in one language. Forward-backward labels every word with the probability of each
language; a document's language is the one with the most probable letters.

The chain of a document is cut into windows whose transfer matrices are multiplied first, so that the messages into each
window are known and all windows of many documents run side by side: exact, and as fast for one long text as for many
short ones.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import chain
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import text_of
from .tokens import _Remembered

UNDETERMINED = "und"
#: Texts of a language that are learned from, and characters of each (a stretch anywhere in the text). Documented bound.
SAMPLE, STRETCH = 400, 3000
#: Languages that are learned: those of the most texts.
LANGUAGES = 100
#: Rounds over the made texts, how many there are, words of each, and the learning rate.
ROUNDS, MADE, MADE_WORDS, RATE = 4, 2400, 48, 0.25
SLOTS = 1 << 17
#: Words of a window, and of the documents that are labelled at once.
WINDOW, CHUNK = 64, 300_000
#: Words a worker remembers before it starts afresh.
REMEMBERED = 300_000
_WORD = re.compile(r"[^\W\d_]+")
_SLOT = _Remembered(lambda name: zlib.crc32(name.encode()) % SLOTS, REMEMBERED)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def features(word: str, lexicon: dict[str, list[tuple[int, int]]]) -> list[int]:
    """Slots of a word's features: affixes, n-grams, the word, and the languages' lexicons by strength."""
    w = f"^{word}$"
    n = len(w)
    named = [w[k : k + 2] for k in range(n - 1)] + [w[k : k + 3] for k in range(n - 2)]
    named += [f"{w[:k]}*" for k in range(2, min(5, n))] + [f"*{w[-k:]}" for k in range(2, min(5, n))]
    if word in lexicon:
        named += [f"#{k}:{strength}" for k, strength in lexicon[word]]
    return [*map(_SLOT.__getitem__, named), zlib.crc32(w.encode()) % SLOTS]


def messages(scores: np.ndarray, lengths: np.ndarray, transition: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scaled forward and backward messages, and potentials, of chains laid end to end (``lengths`` words each, none empty)."""
    total, size = scores.shape
    psi = np.exp(scores - scores.max(axis=1, keepdims=True))
    step = np.exp(transition - transition.max())
    counts = -(-lengths // window)
    chain_of = np.repeat(np.arange(len(lengths)), counts)
    first = np.cumsum(counts) - counts  # each chain's first window
    rank = np.arange(len(chain_of)) - first[chain_of]
    begin = (np.cumsum(lengths) - lengths)[chain_of] + rank * window
    size_of = np.minimum(window, lengths[chain_of] - rank * window)

    def moved(x: np.ndarray, at: np.ndarray, active: np.ndarray, t: int) -> np.ndarray:
        """Messages one word on: no transition leads into a chain's first word."""
        after = x @ step
        if t == 0:
            head = rank[active] == 0
            after[head] = x[head]
        return after * (psi[at] if x.ndim == 2 else psi[at][:, None, :])

    # Transfer matrices of all windows but a chain's last, which nothing follows.
    passing = np.flatnonzero(rank + 1 < counts[chain_of])
    product = np.broadcast_to(np.eye(size), (len(passing), size, size)).copy()
    for t in range(window if len(passing) else 0):
        product = moved(product, begin[passing] + t, passing, t)
        product /= product.max(axis=(1, 2), keepdims=True)
    place = np.full(len(chain_of), -1)
    place[passing] = np.arange(len(passing))

    # Into each window from the left; from the right follow the words after it, so the last windows are run first.
    into = np.ones((len(chain_of), size))
    for r in range(1, int(counts.max(initial=0))):
        here = first[counts > r] + r
        got = np.einsum("wi,wij->wj", into[here - 1], product[place[here - 1]])
        into[here] = got / got.sum(axis=1, keepdims=True)
    forward, backward = np.empty((total, size)), np.empty((total, size))
    x = into
    for t in range(int(size_of.max(initial=0))):
        active = np.flatnonzero(size_of > t)
        got = moved(x[active], begin[active] + t, active, t)
        got /= got.sum(axis=1, keepdims=True)
        x[active] = forward[begin[active] + t] = got

    def back(active: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Backward messages of these windows, given those at their last words; returns what leaves on the left."""
        left = after.copy()
        for t in range(int(size_of[active].max(initial=0)) - 1, -1, -1):
            on = np.flatnonzero(size_of[active] > t)
            at = begin[active[on]] + t
            backward[at] = left[on]
            got = (psi[at] * left[on]) @ step.T
            left[on] = got / got.sum(axis=1, keepdims=True)
        return left

    leaving = np.ones((len(chain_of), size))
    tails = first + counts - 1
    leaving[tails] = back(tails, np.ones((len(tails), size)))
    # What leaves a window on the left, through its transfer matrix (whose first factor is the transition into it).
    for r in range(int(counts.max(initial=0)) - 2, 0, -1):
        here = first[counts > r + 1] + r
        got = np.einsum("wij,wj->wi", product[place[here]], leaving[here + 1])
        leaving[here] = got / got.sum(axis=1, keepdims=True)
    if len(passing):
        back(passing, leaving[passing + 1])
    return forward, backward, psi


def marginals(forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
    both = forward * backward
    return both / both.sum(axis=1, keepdims=True)


class Field:
    """Learned weights, transitions and lexicon; labels words."""

    def __init__(self, languages: list[str], lexicon: dict[str, list[tuple[int, int]]]):
        self.languages, self.lexicon = languages, lexicon
        self.weights = np.zeros((SLOTS, len(languages)))
        self.transition = np.zeros((len(languages), len(languages)))
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.rows, self.used = np.zeros((1024, len(self.languages))), 0

    def __getstate__(self) -> dict:
        """Without what a worker remembers, and only the weights that are not zero."""
        used = np.flatnonzero(self.weights.any(axis=1))
        return {"languages": self.languages, "lexicon": self.lexicon, "used": used, "weights": self.weights[used], "transition": self.transition}

    def __setstate__(self, state: dict) -> None:
        self.__init__(state["languages"], state["lexicon"])
        self.weights[state["used"]], self.transition = state["weights"], state["transition"]

    def scores(self, words: list[str]) -> np.ndarray:
        """Each word's score for each language; words without a letter say nothing."""
        fresh = [w for w in dict.fromkeys(words) if w not in self.known]
        if self.used + len(fresh) > REMEMBERED and self.used:
            self._forget()
            fresh = list(dict.fromkeys(words))
        if fresh:
            slots = [features(w, self.lexicon) if any(map(str.isalpha, w)) else [] for w in fresh]
            sizes = np.array([len(s) for s in slots])
            flat = np.fromiter(chain.from_iterable(slots), np.int64, int(sizes.sum()))
            rows = np.zeros((len(fresh), len(self.languages)))
            said = sizes > 0
            if len(flat):
                rows[said] = np.add.reduceat(self.weights[flat], (np.cumsum(sizes) - sizes)[said])
            while self.used + len(fresh) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[self.used : self.used + len(fresh)] = rows
            self.known |= {w: self.used + k for k, w in enumerate(fresh)}
            self.used += len(fresh)
        return self.rows[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))]

    def label(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Probabilities of the languages for each word of each text."""
        lengths = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(lengths)
        if not len(texts) or not ends[-1]:
            return [np.zeros((0, len(self.languages))) for _ in texts]
        forward, backward, _ = messages(self.scores([w for t in texts for w in t]), lengths[lengths > 0], self.transition)
        return np.split(marginals(forward, backward), ends[:-1])

    def learn(self, texts: list[list[str]], answers: list[np.ndarray], rounds: int = ROUNDS, rate: float = RATE, batch: int = 40) -> None:
        """Adaptive gradient steps on the likelihood of the answers (a language's place for each word)."""
        rng = np.random.default_rng(7)
        slots = {w: features(w, self.lexicon) for w in {w for t in texts for w in t}}
        seen, moved = np.full(self.weights.shape, 1e-6), np.full(self.transition.shape, 1e-6)
        for _ in range(rounds):
            for some in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // batch)):
                flat_words = [w for k in some for w in texts[k]]
                sizes = np.array([len(slots[w]) for w in flat_words])
                flat = np.fromiter((i for w in flat_words for i in slots[w]), np.int64, int(sizes.sum()))
                lengths = np.array([len(texts[k]) for k in some])
                truth = np.concatenate([answers[k] for k in some])
                scores = np.add.reduceat(self.weights[flat], np.cumsum(sizes) - sizes)
                forward, backward, psi = messages(scores, lengths, self.transition)
                error = marginals(forward, backward)
                error[np.arange(len(truth)), truth] -= 1
                used, at = np.unique(flat, return_inverse=True)
                spread = np.repeat(error, sizes, axis=0)
                gradient = np.stack([np.bincount(at, spread[:, k], len(used)) for k in range(spread.shape[1])], axis=1)
                seen[used] += gradient**2
                self.weights[used] -= rate * gradient / np.sqrt(seen[used])
                # Pairs of neighbours inside a text.
                inner = np.ones(len(truth), bool)
                inner[np.cumsum(lengths) - lengths] = False
                later = np.flatnonzero(inner)
                step = np.exp(self.transition - self.transition.max())
                pairs = forward[later - 1][:, :, None] * step * (psi[later] * backward[later])[:, None, :]
                expected = (pairs / pairs.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
                np.subtract.at(expected, (truth[later - 1], truth[later]), 1)
                moved += expected**2
                self.transition -= rate * expected / np.sqrt(moved)


def lexicon_of(texts: list[tuple[int, list[str]]], languages: int) -> dict[str, list[tuple[int, int]]]:
    """Words of two texts or more, with how strongly they speak for languages: (language, strength) for those above an even share."""
    held: dict[str, Counter] = defaultdict(Counter)
    sizes = Counter()
    for k, words in texts:
        sizes[k] += 1
        for w in set(words):
            held[w][k] += 1
    lexicon = {}
    for w, by in held.items():
        if by.total() > 1:
            rates = {k: n / sizes[k] for k, n in by.items()}
            total = sum(rates.values()) + 1e-9
            strong = [(k, min(4, int(4 * r / total))) for k, r in sorted(rates.items()) if r / total * languages > 1]
            lexicon[w] = strong
    return lexicon


def made_texts(texts: dict[int, list[list[str]]], count: int = MADE, words: int = MADE_WORDS, seed: int = 7) -> tuple[list[list[str]], list[np.ndarray]]:
    """Texts to learn from: half in one language, half switching between stretches of several."""
    rng = np.random.default_rng(seed)
    languages = sorted(k for k, some in texts.items() if some)
    out, answers = [], []
    for n in range(count):
        made, truth = [], []
        while len(made) < words:
            k = languages[rng.integers(len(languages))] if not made or n % 2 else truth[-1]
            source = texts[k][rng.integers(len(texts[k]))]
            size = int(rng.integers(3, 25)) if n % 2 else words
            start = int(rng.integers(max(1, len(source) - size + 1)))
            piece = source[start : start + size][: words - len(made)]
            made += piece
            truth += [k] * len(piece)
        out.append(made)
        answers.append(np.array(truth))
    return out, answers


def learned(sample: list[tuple[str, str]]) -> Field | None:
    """A field from (language, text) rows; repeated rows count once. One half gives the lexicon, the other the weights."""
    rows = [(lang, [w for w in words_of(text) if any(map(str.isalpha, w))]) for lang, text in sorted(set(sample))]
    rows = [(lang, words) for lang, words in rows if words]
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return None
    place = {lang: k for k, lang in enumerate(languages)}
    halves: list[dict[int, list[list[str]]]] = [defaultdict(list), defaultdict(list)]
    for lang, words in rows:
        mine = [len(h[place[lang]]) for h in halves]
        halves[mine[1] > mine[0]][place[lang]].append(words)
    for k in place.values():  # a language of one text gives it to both
        halves[1][k] = halves[1][k] or halves[0][k]
    field = Field(languages, lexicon_of([(k, t) for k, some in sorted(halves[0].items()) for t in some], len(languages)))
    if len(languages) > 1:
        field.learn(*made_texts(halves[1]))
    return field


def drawn(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int, stretch: int, languages: int) -> list[tuple[str, str]]:
    """At most ``sample`` stretches of texts for each of the ``languages`` with the most texts, drawn by a hash of id and text."""
    held_out = F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2
    known = docs.filter(F.col(lang_col).isNotNull() & ~held_out)
    counts = known.groupBy(F.col(lang_col).cast("string").alias("lang")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()
    text = text_of(text_col)
    draw = F.pmod(F.xxhash64(F.lit(7), F.col(id_col).cast("string"), text), F.lit(1 << 30))
    start = F.pmod(F.xxhash64(F.lit(8), text), F.greatest(F.length(text) - stretch + 1, F.lit(1))).cast("int") + 1
    rows = known.filter(text.rlike(r"\p{L}")).select(F.col(lang_col).cast("string").alias("lang"), F.substring(text, start, F.lit(stretch)).alias("text"), draw.alias("draw"))

    def take(rates: dict[str, float]) -> list[tuple[str, str]]:
        """The draw is made as rows are read, so that few of them reach the limit, which bounds what comes to the driver."""
        wanted = [(F.col("lang") == lang) & (F.col("draw") < int(rate * (1 << 30))) for lang, rate in rates.items()]
        some = rows.filter(reduce(or_, wanted, F.lit(False)))
        first = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "text"))
        return [(r["lang"], r["text"]) for r in some.withColumn("at", first).filter(F.col("at") <= sample).collect()]

    found = take({r["lang"]: min(1.0, 2 * sample / r["n"]) for r in counts})
    absent = {r["lang"] for r in counts} - {lang for lang, _ in found}
    return found + (take(dict.fromkeys(sorted(absent), 1.0)) if absent else [])


def judged(field: Field | None, texts: list[str]) -> Iterator[tuple[str, float, list[float], list[tuple[int, int]]]]:
    """For each text its language, how probable that is over its letters, all languages' shares, and runs of words (words, language)."""
    nothing = (UNDETERMINED, 0.0, [], [])
    if field is None:
        yield from (nothing for _ in texts)
        return
    split = [words_of(t) for t in texts]
    start = 0
    while start < len(split):
        end, held = start, 0
        while end < len(split) and (end == start or held + len(split[end]) <= CHUNK):
            held += len(split[end])
            end += 1
        for words, chances in zip(split[start:end], field.label(split[start:end])):
            letters = np.array([len(w) if w.isalpha() else sum(map(str.isalpha, w)) for w in words], np.float64)
            if not letters.sum():
                yield nothing
                continue
            shares = np.minimum(letters @ chances / letters.sum(), 1.0)
            top = int(shares.argmax())
            best = chances.argmax(axis=1)
            cuts = np.flatnonzero(np.diff(best, prepend=-1))
            yield field.languages[top], float(shares[top]), shares.tolist(), list(zip(np.diff(cuts, append=len(best)).tolist(), best[cuts].tolist()))
        start = end


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE,
    stretch: int = STRETCH,
    languages: int = LANGUAGES,
) -> DataFrame:
    """One row per document: id, ``held_out``, ``lang_pred``, ``score``, ``shares`` (of the letters, by language), ``runs`` (words, language).

    Learned from at most ``sample`` texts (``stretch`` characters of each) of the ``languages`` with the most texts, out of
    rows with a language whose crc32(id) mod 4 is not 2; rows with a null id are never learned from nor held out. Every
    whole text is labelled. Null texts, texts without a letter, and all texts where nothing could be learned are ``und``
    with score 0; a single learned language is given to all others with score 1. Repeated rows are documents like any
    other; an empty table gives no rows; other columns are not read. Rows are independent: no shuffle.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    field = docs.sparkSession.sparkContext.broadcast(learned(drawn(docs, id_col, text_col, lang_col, sample, stretch, languages)))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = field.value
        names = model.languages if model else []
        types = (pa.string(), pa.float64(), pa.map_(pa.string(), pa.float64()), pa.list_(pa.struct([("words", pa.int64()), ("lang", pa.string())])))
        for b in batches:
            rows = [
                (lang, score, list(zip(names, shares)), [{"words": n, "lang": names[k]} for n, k in runs])
                for lang, score, shares, runs in judged(model, b.column(2).to_pylist())
            ]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 4, types)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *columns], ["id", "held_out", "lang_pred", "score", "shares", "runs"])

    held_out = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
    read = docs.select(F.col(id_col).alias("id"), held_out.alias("held_out"), text_of(text_col).alias("t"))
    schema = f"id {kind}, held_out boolean, lang_pred string, score double, shares map<string,double>, runs array<struct<words:long,lang:string>>"
    return read.mapInArrow(part, schema).withColumnRenamed("id", id_col)
