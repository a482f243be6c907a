"""Alignment of two tokenisations against a plain walk over both."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tidegate.llm import alignment

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = {c: b for b, c in zip([*range(33, 127), *range(161, 173), *range(174, 256)], map(chr, [*range(33, 127), *range(161, 173), *range(174, 256)]))}
ALPHABET |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(ALPHABET.values()))}


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=PIECES)


def tokens(libraries, text):
    """(id, start, end) on both sides; none where the bytes differ."""
    if not text:
        return [], []
    a, b = libraries
    ids = a.encode(" " + text, add_special_tokens=False).ids
    left = [(i, bytes(ALPHABET[c] for c in a.id_to_token(i))) for i in ids]
    right = [(i, bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i in b.encode(text) for p in [b.id_to_piece(i)]]
    if any(b"".join(x for _, x in side) != (" " + text).encode() for side in (left, right)):
        return [], []
    out = []
    for side in (left, right):
        at, spans = 0, []
        for i, x in side:
            spans.append((i, at, at + len(x)))
            at += len(x)
        out.append(spans)
    return out


def plain(libraries, docs):
    laid = [(d, *tokens(libraries, t)) for d, t in docs]
    linked = [[(i, j) for i, s, e in a for j, u, v in b if s < v and u < e] for _, a, b in laid]
    counts = Counter(p for pairs in linked for p in pairs)
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    out = []
    for (d, a, b), pairs in zip(laid, linked):
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, lo = [], 0
        for hi in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in side if lo < e <= hi) for side in (a, b)))
            lo = hi
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((d, len(a), len(b), len(groups), len(pairs), sum(counts[p] == best[p[1]] for p in pairs), sum(counts[p] for p in pairs), digest))
    return out


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def made(n, seed=3):
    rng = random.Random(seed)
    parts = ["the ", "Straße", " \n\t", "don't", "  ", "漢字", "🙂", "<|endoftext|>", "</s>", "<0x41>", "12345", "'ll ", "é", "́", "\x00", "\xa0", "ab", "internationalisation", "\r\n", "…", "ﬁ"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def test_ranked_encoder_is_the_library(libraries):
    a, _ = alignment.sides(BYTES, PIECES)
    assert a.ranked is not None
    for text in made(3000, 5):
        assert a.encode([text])[0] == libraries[0].encode(" " + text, add_special_tokens=False).ids


@pytest.mark.parametrize("most", [alignment.BROADCAST_PAIRS, 40, 0])
def test_alignment_is_the_plain_walk(spark, libraries, most, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK", 200)
    texts = made(150)
    docs = [(k, t) for k, t in enumerate(texts)] + [(500 + k, "the same text") for k in range(30)]
    docs += [(None, texts[1]), (1, texts[1]), (1, texts[1]), (900, None), (901, ""), (902, "a ▁ b"), (903, "▁"), (904, " lead"), (905, "long word " * 3000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").select("*", *(F.lit("x").alias(c) for c in ("row", "id", "pairs", "n_a", "pair", "count"))).repartition(5)
    found = alignment.alignment(frame, BYTES, PIECES, broadcast_pairs=most)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows(found) == sorted(plain(libraries, docs), key=repr)


def test_nothing_to_align(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert rows(alignment.alignment(docs, BYTES, PIECES)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
    assert rows(alignment.alignment(docs.filter("false"), BYTES, PIECES)) == []
