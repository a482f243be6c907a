"""Suffix-array dedup: bytes covered by a string of ``WINDOW`` bytes that also starts in a document with a smaller id.

Every window of 50 bytes is dealt by the smallest hash of its 20-byte strings, so equal windows meet in one shard, and
neighbouring windows mostly stay together as one stretch of text. Only stretches whose hash occurs in two documents are
sent. A shard joins its stretches to one text, sorts the suffixes by induced sorting, and takes permuted common prefixes;
suffixes that share 50 bytes form a class, and all but those of its smallest id are marked. A phrase in very many different
surroundings would fill one shard; windows of a hash with more different stretches than a shard holds are dealt by a hash
of all their 50 bytes instead.

Documents travel in chunks of about a megabyte, hashes in buckets per chunk with repeats combined, stretches with
equal ones of a chunk combined; identical documents are settled by their digests beforehand. So a text or passage with
many copies sends one entry per chunk. Buckets and shards grow in number with the bytes, not in size.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, stage, text_of
from .suffix_array import common_prefixes, suffix_array

WINDOW = 50
#: Strings whose hashes deal the windows.
ANCHOR = 20
CHUNK_BYTES = 1_000_000
#: Bytes of text per bucket of hashes, and per shard of stretches.
BUCKET_BYTES, SHARD_BYTES = 32_000_000, 4_000_000
LEAST_PARTS = 64
#: Shards of such windows for each other shard: alone, the windows of a stretch have so many times its bytes.
SPREAD = 20
#: Windows of one stretch at most.
STRETCH = 250
_LAST = 2**63 - 1

_rng = np.random.default_rng(20)
_TABLE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def _anchor_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``ANCHOR`` bytes from each position on, by joining hashes of doubled lengths."""
    now, length, out, done, level = _TABLE[data], 1, None, 0, 0
    left = ANCHOR
    while left:
        if left & 1:
            if out is None:
                out = now
            else:
                size = len(now) - done
                out = (out[:size] * _STEP[4]) ^ now[done : done + size]
            done += length
        left >>= 1
        if left:
            size = len(now) - length
            now = (now[:size] * _STEP[level % 4]) + now[length:]
            now ^= now >> np.uint64(29)
            length, level = 2 * length, level + 1
    out = out * _STEP[0]
    out ^= out >> np.uint64(32)
    return out * _STEP[1]


def stretches(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first window and number of windows of each stretch of the joined documents that begin at ``starts``; the hash of each ``ANCHOR`` bytes."""
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    anchors, span = _anchor_hashes(data), 1
    least = anchors
    width = WINDOW - ANCHOR + 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    # windows that would cross into the next document are none
    ends = np.r_[starts[1:], n]
    real = np.zeros(len(least) + 1, np.int32)
    lengths = np.maximum(ends - starts - WINDOW + 1, 0)
    has = lengths > 0
    np.add.at(real, starts[has], 1)
    np.add.at(real, np.minimum(starts[has] + lengths[has], len(least)), -1)
    inside = np.cumsum(real[:-1]) > 0
    edge = np.ones(len(least), bool)
    edge[1:] = (least[1:] != least[:-1]) | (inside[1:] != inside[:-1])
    edge[starts[has]] = True
    first = np.flatnonzero(edge)
    count = np.diff(np.r_[first, len(least)])
    first, count = first[inside[first]], count[inside[first]]
    parts = -(-count // STRETCH)
    if len(parts) and parts.max() > 1:
        which = np.repeat(np.arange(len(first)), parts)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
        first, count = first[which] + nth * STRETCH, np.minimum(count[which] - nth * STRETCH, STRETCH)
    return least[first], first, count, anchors


def _whole_hash(anchors: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A hash of stretches: of all bytes of those that have one anchor in common, of both ends and the length of longer ones."""
    last = first + count - 1 + WINDOW - ANCHOR
    out = count.astype(np.uint64)
    for at, step in zip((first, first + ANCHOR, last - ANCHOR, last), _STEP[:4], strict=True):
        out = (out ^ anchors[at]) * step
        out ^= out >> np.uint64(29)
    return out


def _short(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 32 bits of a hash: within a bucket of bounded size that tells hashes apart well enough to choose candidates."""
    return (hashes >> np.uint64(33)) % np.uint64(buckets), (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _grouped(keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal sorted keys."""
    if len(keys):
        cut = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        for a, b in zip(cut, [*cut[1:], len(keys)], strict=True):
            yield int(keys[a]), slice(a, b)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents (rank, bytes) joined to chunks: ids, sizes, digests and text, each as one binary."""
    chunk, held, size = TaskContext.get().partitionId() << 32, [], 0

    def close() -> pa.RecordBatch:
        columns = [
            np.array([r for r, _ in held], np.int64).tobytes(),
            np.array([len(t) for _, t in held], np.int64).tobytes(),
            b"".join(md5(t).digest() for _, t in held),
            b"".join(t for _, t in held),
        ]
        return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), *(pa.array([c], pa.binary()) for c in columns)], ["chunk", "ranks", "sizes", "digests", "text"])

    for b in batches:
        for rank, text in zip(b.column(0), b.column(1), strict=True):
            held.append((rank.as_py(), text.as_py()))
            size += len(held[-1][1])
            if size >= CHUNK_BYTES:
                yield close()
                chunk, held, size = chunk + 1, [], 0
    if held:
        yield close()


def _opened(sizes: bytes, text: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = np.frombuffer(sizes, np.int64)
    return np.cumsum(n) - n, np.frombuffer(text, np.uint8)


def _send_hashes(buckets: int):
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, sizes, text in zip(*(b.column(k) for k in range(3)), strict=True):
                starts, data = _opened(sizes.as_py(), text.as_py())
                hashes, first, count, anchors = stretches(data, starts)
                doc = np.searchsorted(starts, first, side="right") - 1
                bucket, short = _short(hashes, buckets)
                key = (bucket << np.uint64(32)) | short
                whole = _whole_hash(anchors, first, count)
                order = np.lexsort((whole, key))
                key, doc, whole = key[order], doc[order], whole[order]
                new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
                if not len(new):
                    continue
                several = np.minimum.reduceat(doc, new) != np.maximum.reduceat(doc, new)
                different = np.add.reduceat(np.r_[True, (key[1:] != key[:-1]) | (whole[1:] != whole[:-1])].astype(np.int64), new)
                # eighths of a power of two: one stretch is zero, as it is for most
                kinds = np.ceil(8 * np.log2(different)).astype(np.uint8)
                key = key[new]
                rows = [(k, (key[s] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(), np.packbits(several[s]).tobytes(), kinds[s].tobytes()) for k, s in _grouped((key >> np.uint64(32)).astype(np.int64))]
                k, h, m, d = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array([chunk.as_py()] * len(k), pa.int64()), pa.array(h, pa.binary()), pa.array(m, pa.binary()), pa.array(d, pa.binary())], ["bucket", "chunk", "hashes", "several", "kinds"])

    return part


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which values are in an ordered array."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _hot(ordered: np.ndarray, rows: list[np.ndarray], kinds: list[np.ndarray], limit: int) -> np.ndarray:
    """Hashes with more different stretches than ``limit``, the chunks' numbers added; ordered."""
    cut = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    known, total = ordered[cut], np.diff(np.r_[cut, len(ordered)]).astype(np.float64)  # one from each chunk
    for row, kind in zip(rows, kinds, strict=True):
        more = np.flatnonzero(kind)
        total[np.searchsorted(known, row[more])] += 2.0 ** (kind[more] / 8) - 1
    return known[total > limit]


def _shared_hashes(limit: int):
    """Of one bucket, per chunk: the hashes that occur in two documents, and which of them have too many different stretches."""

    def bucket(table: pa.Table) -> pa.Table:
        rows = [np.frombuffer(h.as_py(), np.uint32) for h in table.column("hashes")]
        several = [np.unpackbits(np.frombuffer(m.as_py(), np.uint8), count=len(r)).astype(bool) for m, r in zip(table.column("several"), rows, strict=True)]
        everything = np.sort(np.concatenate(rows))
        twice = everything[1:][everything[1:] == everything[:-1]]
        hot = _hot(everything, rows, [np.frombuffer(k.as_py(), np.uint8) for k in table.column("kinds")], limit)
        found = [r[m | _among(r, twice)] for r, m in zip(rows, several, strict=True)]
        keep = [i for i, f in enumerate(found) if len(f)]
        return pa.table(
            {
                "chunk": pa.array([table.column("chunk")[i].as_py() for i in keep], pa.int64()),
                "bucket": pa.array([table.column("bucket")[i].as_py() for i in keep], pa.int32()),
                "hashes": pa.array([found[i].tobytes() for i in keep], pa.binary()),
                "hot": pa.array([found[i][_among(found[i], hot)].tobytes() for i in keep], pa.binary()),
            }
        )

    return bucket


def _keys(names: list[int], hashes: list[bytes]) -> np.ndarray:
    """Buckets and the hashes of each as one ordered array."""
    return np.sort(np.concatenate([(np.uint64(n) << np.uint64(32)) | np.frombuffer(s, np.uint32).astype(np.uint64) for n, s in zip(names, hashes, strict=True)]))


def _send_stretches(buckets: int, shards: int):
    """Chunks with their shared hashes to stretches: different ones once, with where they stand."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, ranks, sizes, text, names, shared, hot in zip(*(b.column(k) for k in range(7)), strict=True):
                rank, raw = np.frombuffer(ranks.as_py(), np.int64), text.as_py()
                starts, data = _opened(sizes.as_py(), raw)
                hashes, first, count, anchors = stretches(data, starts)
                bucket, short = _short(hashes, buckets)
                key = (bucket << np.uint64(32)) | short
                chosen = np.flatnonzero(_among(key, _keys(names.as_py(), shared.as_py())))
                first, count = first[chosen], count[chosen]
                shard = (hashes[chosen] >> np.uint64(7)) % np.uint64(shards)
                apart = _among(key[chosen], _keys(names.as_py(), hot.as_py()))
                if apart.any():
                    n = count[apart]
                    single = np.repeat(first[apart] - np.cumsum(n) + n, n) + np.arange(n.sum())
                    one = np.ones(len(single), np.int64)
                    dealt = np.uint64(shards) + (_whole_hash(anchors, single, one) >> np.uint64(7)) % np.uint64(SPREAD * shards)
                    first, count, shard = np.r_[first[~apart], single], np.r_[count[~apart], one], np.r_[shard[~apart], dealt]
                doc = np.searchsorted(starts, first, side="right") - 1
                order = np.argsort(shard, kind="stable")
                out = []
                for k, s in _grouped(shard[order].astype(np.int64)):
                    at = order[s]
                    out.append((k, *_combined(raw, first[at], count[at], doc[at], rank, starts)))
                if out:
                    columns = list(zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[0], pa.int32()), pa.array([chunk.as_py()] * len(out), pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])],
                        ["shard", "chunk", "text", "sizes", "ranks", "which", "doc", "at"],
                    )

    return part


def _combined(raw: bytes, first: np.ndarray, count: np.ndarray, doc: np.ndarray, rank: np.ndarray, starts: np.ndarray) -> tuple[bytes, ...]:
    """Different stretches with the smallest rank of each, and every occurrence: which, document, offset there."""
    known: dict[bytes, int] = {}
    which = np.array([known.setdefault(raw[a : a + n + WINDOW - 1], len(known)) for a, n in zip(first.tolist(), count.tolist(), strict=True)], np.int64)
    least = np.full(len(known), _LAST, np.int64)
    np.minimum.at(least, which, rank[doc])
    return (
        b"".join(known), np.array([len(x) for x in known], np.uint16).tobytes(), least.tobytes(),
        which.astype(np.uint32).tobytes(), doc.astype(np.uint32).tobytes() + (rank[doc] > least[which]).astype(np.uint8).tobytes(), (first - starts[doc]).astype(np.uint32).tobytes(),
    )


def repeated_windows(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """For each text, which of its windows also starts in a text of smaller rank: suffix array, common prefixes, classes."""
    sizes = np.array([len(x) for x in texts])
    joined = np.zeros(int(sizes.sum()) + len(texts) + 1, np.uint16)
    ends = np.cumsum(sizes + 1)
    begins = ends - sizes - 1
    body = np.ones(len(joined), bool)
    body[ends - 1] = False
    body[-1] = False
    joined[body] = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint16) + 2
    joined[ends - 1] = 1
    sa = suffix_array(joined)
    shared = common_prefixes(joined, sa, WINDOW)
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    whole = np.zeros(len(joined), bool)
    whole[:-1] = (ends[owner] - 1 - np.arange(len(owner))) >= WINDOW
    inner = np.cumsum(shared[sa] < WINDOW) - 1
    position = sa[whole[sa]]
    group = inner[whole[sa]]
    out = np.zeros(len(joined), bool)
    if len(position):
        cut = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        own = ranks[owner[position]]
        smallest = np.repeat(np.minimum.reduceat(own, cut), np.diff(np.r_[cut, len(own)]))
        out[position] = own > smallest
    return [out[a : a + max(0, n - WINDOW + 1)] for a, n in zip(begins.tolist(), sizes.tolist(), strict=True)]


def _sorted_shard(table: pa.Table) -> pa.Table:
    """One shard: repeated windows of its different stretches, told to each chunk as (document, first byte, length)."""
    known: dict[bytes, int] = {}
    parts = []
    for text, sizes, ranks in zip(*(table.column(c) for c in ("text", "sizes", "ranks")), strict=True):
        raw, n = text.as_py(), np.frombuffer(sizes.as_py(), np.uint16).astype(np.int64)
        begin = np.cumsum(n) - n
        names = np.array([known.setdefault(raw[a : a + k], len(known)) for a, k in zip(begin.tolist(), n.tolist(), strict=True)], np.int64)
        parts.append((names, np.frombuffer(ranks.as_py(), np.int64), n))
    least = np.full(len(known), _LAST, np.int64)
    for names, rank, _ in parts:
        np.minimum.at(least, names, rank)
    marks = repeated_windows(list(known), least)
    runs: list[list[tuple[int, int]]] = []
    for m in marks:
        step = np.flatnonzero(np.diff(np.r_[False, m, False].astype(np.int8)))
        runs.append([(int(a), int(b - a) + WINDOW - 1) for a, b in zip(step[::2], step[1::2], strict=True)])
    chunks, found = [], []
    for chunk, (names, rank, n), which, doc, at in zip(table.column("chunk"), parts, *(table.column(c) for c in ("which", "doc", "at")), strict=True):
        w = np.frombuffer(which.as_py(), np.uint32)
        packed, offset = doc.as_py(), np.frombuffer(at.as_py(), np.uint32).astype(np.int64)
        d, later = np.frombuffer(packed[: 4 * len(w)], np.uint32).astype(np.int64), np.frombuffer(packed[4 * len(w) :], np.uint8).astype(bool)
        entire = later | (rank > least[names])[w]
        out = [np.stack([d[entire], offset[entire], n[w[entire]]], axis=1)]
        some = [(int(d[i]), int(offset[i]) + a, k) for i in np.flatnonzero(~entire) for a, k in runs[names[w[i]]]]
        if some:
            out.append(np.array(some, np.int64))
        spans = np.concatenate(out)
        if len(spans):
            chunks.append(chunk.as_py())
            found.append(spans.astype(np.uint32).tobytes())
    return pa.table({"chunk": pa.array(chunks, pa.int64()), "spans": pa.array(found, pa.binary())})


def _merged(spans: np.ndarray) -> np.ndarray:
    """Overlapping and adjoining (start, end) joined; sorted."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.r_[True, spans[1:, 0] > reach[:-1]]
    return np.stack([spans[new, 0], reach[np.r_[np.flatnonzero(new)[1:] - 1, len(spans) - 1]]], axis=1)


def _per_document(ids: pa.Table, spans: pa.Table) -> pa.Table:
    """Of one chunk: the merged spans of each document that has any."""
    out = []
    if len(ids) and len(spans):
        rank, digest = np.frombuffer(ids.column("ranks")[0].as_py(), np.int64), ids.column("digests")[0].as_py()
        every = np.concatenate([np.frombuffer(x.as_py(), np.uint32).reshape(-1, 3) for x in spans.column("spans")]).astype(np.int64)
        every = every[np.argsort(every[:, 0], kind="stable")]
        for doc, s in _grouped(every[:, 0]):
            merged = _merged(np.stack([every[s, 1], every[s, 1] + every[s, 2]], axis=1))
            out.append((int(rank[doc]), digest[16 * doc : 16 * doc + 16], merged.tobytes()))
    r, d, s = zip(*out, strict=True) if out else ((), (), ())
    return pa.table({"rank": pa.array(r, pa.int64()), "digest": pa.array(d, pa.binary()), "spans": pa.array(s, pa.binary())})


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, and ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept_bytes``.

    The text column becomes what is left, without characters that lost some of their bytes; a null text stays null and
    counts as empty. Null ids are largest; rows with equal ids are not earlier than one another, so repeated rows share
    their result. Texts under 50 bytes lose nothing; an empty table gives no rows; columns of the new names are replaced.
    """
    named = ("n_bytes", "n_removed", "n_spans", "kept_bytes")
    data, rank = text_of(text_col).cast("binary"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST))
    every = stage(docs.select(rank.alias("rank"), F.unhex(F.md5(data)).alias("digest"), F.octet_length(data).cast("long").alias("n")), "substring-digests")
    copied = every.filter(F.col("n") >= WINDOW).groupBy("digest").agg(F.min("rank").alias("least"), F.max("rank").alias("most")).filter("least < most")
    copies = stage(every.join(bounded(stage(copied, "substring-copied")), "digest").filter("rank > least").select("rank", "digest", "n").distinct(), "substring-copies")
    total = every.agg(F.sum("n")).first()[0] or 0
    buckets, shards = max(LEAST_PARTS, total // BUCKET_BYTES), max(LEAST_PARTS, total // SHARD_BYTES)

    own = docs.select(rank.alias("rank"), data.alias("text"), F.unhex(F.md5(data)).alias("digest")).filter(F.octet_length("text") >= WINDOW)
    single = own.join(bounded(copies.select("rank", "digest")), ["rank", "digest"], "left_anti").select("rank", "text")
    chunks = stage(single.mapInArrow(_chunks, "chunk long, ranks binary, sizes binary, digests binary, text binary"), "substring-chunks")
    hashes = chunks.select("chunk", "sizes", "text").mapInArrow(_send_hashes(buckets), "bucket int, chunk long, hashes binary, several binary, kinds binary")
    shared = hashes.groupBy("bucket").applyInArrow(_shared_hashes(SHARD_BYTES // (2 * WINDOW - ANCHOR)), "chunk long, bucket int, hashes binary, hot binary")
    shared = shared.groupBy("chunk").agg(F.collect_list("bucket").alias("names"), F.collect_list("hashes").alias("shared"), F.collect_list("hot").alias("hot"))
    met = chunks.select("chunk", "ranks", "sizes", "text").join(shared, "chunk")
    sent = met.mapInArrow(_send_stretches(buckets, shards), "shard int, chunk long, text binary, sizes binary, ranks binary, which binary, doc binary, at binary")
    spans = sent.groupBy("shard").applyInArrow(_sorted_shard, "chunk long, spans binary")
    near = chunks.select("chunk", "ranks", "digests").groupBy("chunk").cogroup(spans.groupBy("chunk")).applyInArrow(_per_document, "rank long, digest binary, spans binary")
    found = stage(near.unionAll(copies.select("rank", "digest", F.lit(None).cast("binary").alias("spans"))).groupBy("rank", "digest").agg(F.first("spans").alias("spans")), "substring-spans")

    others = [c for c in docs.columns if c not in named and c != text_col]
    keyed = docs.select(*(F.col(f"`{c}`") for c in others), F.col(text_col).alias("__text"), rank.alias("__rank"), F.unhex(F.md5(data)).alias("__digest"))
    marked = bounded(found.select(F.col("rank").alias("__rank"), F.col("digest").alias("__digest"), F.col("spans").alias("__spans"), F.lit(True).alias("__found")))
    joined = keyed.join(marked, ["__rank", "__digest"], "left").select(*(F.col(f"`{c}`") for c in others), F.col("__text").cast("binary").alias("__text"), "__spans", "__found")
    schema = joined.select(*(F.col(f"`{c}`") for c in others), "__text", *(F.lit(0).cast("long").alias(c) for c in named[:3]), F.lit(None).cast("string").alias("__left")).schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = len(others)
            texts, counts = [], []
            for text, spans, marked in zip(*(b.column(i) for i in range(k, k + 3)), strict=True):
                raw = text.as_py()
                n = len(raw or b"")
                gone = np.frombuffer(spans.as_py(), np.int64).reshape(-1, 2).tolist() if spans.is_valid else [[0, n]] if marked.is_valid and n else []
                if gone:
                    raw = b"".join(raw[a:z] for a, z in zip([0, *(z for _, z in gone)], [*(a for a, _ in gone), n], strict=True))
                texts.append(raw)
                counts.append((n, n - len(raw or b""), len(gone)))
            left = [None if t is None else t.decode("utf-8", "ignore") for t in texts]
            columns = list(zip(*counts, strict=True)) if counts else [(), (), ()]
            yield pa.RecordBatch.from_arrays([*b.columns[:k], pa.array(texts, pa.binary()), *(pa.array(c, pa.int64()) for c in columns), pa.array(left, pa.string())], [*others, "__text", *named[:3], "__left"])

    done = joined.mapInArrow(cut, schema)
    return done.select(
        *(F.col("__left").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c in others or c == text_col),
        *named[:3], F.coalesce("__text", F.lit(b"")).alias("kept_bytes"),
    )
