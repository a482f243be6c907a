"""Alignment of two tokenisations of the same text, and how often each pair of ids meets corpus-wide.

Both sides are laid out as byte offsets of a batch of documents. ``pandas.merge_asof``, keyed by document, finds for each
token start the other side's token that covers it; the two directions together give every overlapping pair, and starts
that both sides have (so ends that both sides have) cut the text into groups.

The links of a document are kept as distinct pairs with their multiplicity. Corpus-wide counts are one combining
aggregate; going back to the documents, the most counted pairs (of a proven number) are broadcast and the others joined
by shuffling.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, text_of
from .tokens import _byte_alphabet

SPACE_SIGN = "▁"
#: Bytes of text that are laid out at once; a longer text is laid out by itself.
CHUNK = 500_000
#: The most counted pairs, at most so many (16 bytes each), are sent to all tasks; the rest is joined by shuffling.
BROADCAST_PAIRS = 500_000
_COLUMNS = "row long, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"


class Side:
    """One tokenisation: ids of texts, and the bytes that each id stands for."""

    def __init__(self, output: list[bytes]):
        self.output = output
        self.sizes = np.array([len(x) for x in output], np.int64)
        #: Decimal ids, with what may follow them.
        self.written = {s: np.array([b"%d%s" % (i, s) for i in range(len(output))], object) for s in (b",", b"|", b";")}

    def encode(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def tokens(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text; none where their bytes are not those of a space and the text."""
        found, output = self.encode(texts), self.output
        return [ids if b"".join([output[i] for i in ids]) == b" " + t.encode() else [] for ids, t in zip(found, texts)]


class ByteSide(Side):
    """Byte-level BPE of a ``tokenizers`` file, encoding a space and the text; strings of special tokens are plain text.

    Where the file's merges make its ids in order, as rank-based encoders take it, such an encoder does the work.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        back = {chr(c): b for b, c in ({b: b for b in range(256)} | _byte_alphabet()).items()}
        special = {i for i, t in self.library.get_added_tokens_decoder().items() if t.special}
        ranks = {bytes(back[c] for c in t): i for t, i in model["vocab"].items() if i not in special}
        output = [b""] * (max([*ranks.values(), *special]) + 1)
        for b, i in ranks.items():
            output[i] = b
        super().__init__(output)
        merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        made = [model["vocab"][m.replace(" ", "")] for m in merges]
        self.ranked = None
        if made == sorted(set(made)) and len(made) + 256 == len(ranks):
            self.ranked = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.ranked is None:
            return [e.ids for e in self.library.encode_batch([f" {t}" for t in texts], add_special_tokens=False)]
        return [self.ranked.encode_ordinary(f" {t}") for t in texts]


class PieceSide(Side):
    """SentencePiece model; the library puts the space before the text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [(i, self.model.id_to_piece(i)) for i in range(self.model.get_piece_size())]
        super().__init__([bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.replace(SPACE_SIGN, " ").encode() for i, p in pieces])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@cache
def sides(bytes_path: str, pieces_path: str) -> tuple[Side, Side]:
    """Both tokenisations, once for all tasks of a Python worker."""
    return ByteSide(bytes_path), PieceSide(pieces_path)


def _laid_out(ids: list[list[int]], side: Side) -> tuple[pd.DataFrame, np.ndarray]:
    """Tokens of all documents in order: document, start among the bytes of all, place; and the ids by place."""
    flat = np.fromiter(chain.from_iterable(ids), np.int64, sum(map(len, ids)))
    sizes = side.sizes[flat]
    docs = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    return pd.DataFrame({"doc": docs, "start": np.cumsum(sizes) - sizes, "place": np.arange(len(flat))}, copy=False), flat


def _covering(starts: pd.DataFrame, tokens: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """For each start the other side's token that covers it, and whether that token starts there too."""
    other = tokens.assign(begin=tokens["start"])
    found = pd.merge_asof(starts[["doc", "start"]], other, on="start", by="doc")
    return found["place"].to_numpy(np.int64), found["begin"].to_numpy() == starts["start"].to_numpy()


def align(texts: list[str], a: Side, b: Side) -> list[tuple[int, int, int, int, str, np.ndarray, np.ndarray]]:
    """For each text: tokens on both sides, groups, links, digest of the groups, distinct linked id pairs (a * 2^32 + b) and how often each is linked."""
    both = [(x, y) if x and y else ([], []) for x, y in zip(a.tokens(texts), b.tokens(texts))]
    (ta, ia), (tb, ib) = (_laid_out([x[k] for x in both], s) for k, s in enumerate((a, b)))
    over_a, cuts_a = _covering(ta, tb)  # the B token over each A start
    over_b, cuts_b = _covering(tb, ta)
    doc_a, doc_b, n = ta["doc"].to_numpy(), tb["doc"].to_numpy(), len(texts)

    # Groups, written with A's ids before B's: a token's place is its own among its side plus the other side's before it.
    group_a, group_b = np.cumsum(cuts_a) - 1, np.cumsum(cuts_b) - 1
    per_a, per_b = np.bincount(group_a, minlength=0), np.bincount(group_b, minlength=0)
    last_a, last_b = (np.append(g[1:] != g[:-1], True)[: len(g)] for g in (group_a, group_b))
    parts = np.empty(len(ia) + len(ib), object)
    if len(ia):
        parts[np.arange(len(ia)) + (np.cumsum(per_b) - per_b)[group_a]] = np.where(last_a, a.written[b"|"][ia], a.written[b","][ia])
        parts[np.arange(len(ib)) + np.cumsum(per_a)[group_b]] = np.where(last_b, b.written[b";"][ib], b.written[b","][ib])

    # Links from both directions; where starts agree both find the same one.
    late = ~cuts_b
    linked_doc = np.concatenate([doc_a, doc_b[late]])
    first = np.concatenate([ia, ia[over_b[late]]])
    second = np.concatenate([ib[over_a], ib[late]])
    links = np.bincount(linked_doc, minlength=n)
    order = np.sort((linked_doc * len(a.output) + first) * len(b.output) + second)
    begins = np.flatnonzero(np.diff(order, prepend=-1))
    times = np.diff(begins, append=len(order)).astype(np.int32)
    pair_doc, pair = np.divmod(order[begins], len(a.output) * len(b.output))
    keys = (pair // len(b.output) << 32) + pair % len(b.output)
    pair_ends = np.cumsum(np.bincount(pair_doc, minlength=n))

    n_a, n_b, groups = np.bincount(doc_a, minlength=n), np.bincount(doc_b, minlength=n), np.bincount(doc_a[cuts_a], minlength=n)
    ends = np.cumsum(n_a + n_b)
    out, written = [], parts.tolist()
    for k in range(n):
        lo, hi, p, q = ends[k] - n_a[k] - n_b[k], ends[k], pair_ends[k - 1] if k else 0, pair_ends[k]
        digest = hashlib.sha256(b"".join(written[lo:hi])[:-1]).hexdigest() if hi > lo else ""
        out.append((int(n_a[k]), int(n_b[k]), int(groups[k]), int(links[k]), digest, keys[p:q], times[p:q]))
    return out


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = held = 0
    for k, t in enumerate(texts):
        if held and held + len(t) > CHUNK:
            yield start, k
            start, held = k, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def aligned(docs: DataFrame, bytes_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's counts, digest and distinct id pairs; ``row`` tells apart rows of equal id."""
    kind = docs.schema[id_col].dataType.simpleString()

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, row = sides(bytes_path, pieces_path), TaskContext.get().partitionId() << 36
        for b in batches:
            texts = b.column(1).to_pylist()
            for lo, hi in _chunks(texts):
                *counts, digests, keys, times = zip(*align(texts[lo:hi], *both))
                ends = pa.array(np.concatenate([[0], np.cumsum([len(k) for k in keys])]), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x))) for x in (keys, times)]
                columns = [pa.array(range(row, row + hi - lo), pa.int64()), b.column(0).slice(lo, hi - lo), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string())]
                row += hi - lo
                yield pa.RecordBatch.from_arrays([*columns, *lists], [c.split()[0] for c in _COLUMNS.split(", ")])

    read = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t"))
    return read.mapInArrow(part, _COLUMNS.replace("id long", f"id {kind}", 1))


def pair_counts(found: DataFrame) -> DataFrame:
    """``pair``, ``count`` (links that hold it, over all documents) and ``best`` (no pair of the same B id has a higher count)."""
    counts = found.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("count"))
    counts = stage(counts, "alignment-counts")
    second = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    highest = counts.groupBy(second.alias("second")).agg(F.max("count").alias("highest"))
    return counts.withColumn("second", second).join(highest, "second").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def _frequent(counts: DataFrame, most: int) -> int:
    """The lowest power of two such that at most ``most`` pairs are counted as often."""
    bins = counts.groupBy(F.floor(F.log2("count")).cast("int").alias("bin")).agg(F.count("*").alias("pairs")).collect()
    held, least = 0, 1 << 62
    for b, pairs in sorted(((r["bin"], r["pairs"]) for r in bins), reverse=True):
        held += pairs
        if held > most:
            break
        least = 1 << b
    return least


def alignment(
    docs: DataFrame, bytes_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text", broadcast_pairs: int = BROADCAST_PAIRS
) -> DataFrame:
    """One row per document: id, ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    Null and empty texts, and texts that either tokenisation does not give back byte by byte, have no tokens: zeros and an
    empty digest. Null ids and repeated rows are documents like any other, and count; an empty table gives no rows; other
    columns are not read.
    """
    found = stage(aligned(docs, bytes_path, pieces_path, id_col, text_col), "alignment")
    counts = stage(pair_counts(found), "alignment-pairs")
    least = _frequent(counts, broadcast_pairs)
    links = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    often = F.broadcast(counts.filter(F.col("count") >= least))
    matched = links.join(often, "pair")
    if counts.filter(F.col("count") < least).head(1):
        rest = links.join(often, "pair", "left_anti").join(counts.filter(F.col("count") < least), "pair")
        matched = matched.unionByName(rest)
    sums = matched.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return found.join(sums, "row", "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"
    )
