"""SimHash near-dedup with bit-sliced comparison.

A fingerprint has 64 bits; two are linked when at most ``radius`` bits differ. The bits are cut into ``radius + 2``
blocks: fingerprints within the radius agree on two blocks at least, so every link is found in one of the tables keyed
by a pair of blocks. Within a key, fingerprints are stored as 64 bit planes of 64 fingerprints each; a query is compared
with a plane word at a time, 64 distances advance in three carry-save counter words, and a block is abandoned as soon
as all its distances exceed the radius. Links leave a key as a forest, never as pairs, and components are merged by
label passing between tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, text_of
from .graph import components

RADIUS = 4
SHINGLE = 4
SEED = 42
#: Fingerprints of one key that a task compares at once; larger keys are compared as pairs of such parts.
PART = 2048
_LANES = np.uint64(1) << np.arange(64, dtype=np.uint64)


def shingle_hashes(text: bytes, shingle: int, seed: int = SEED) -> list[int]:
    """The XXH64 of all word shingles; of all words where they are fewer, nothing for a text without words."""
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(joined, seed)]
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: len(words) - shingle] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[s:e], seed) for s, e in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The majority bits of the XXH64 of all word shingles; 0 for a text without words."""
    hashes = shingle_hashes(text, shingle, seed)
    if not hashes:
        return 0
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id`` and ``fp`` (the fingerprint as a signed long) of every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], ["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), text_of(text_col).cast("binary").alias("t")).mapInArrow(part, f"id {kind}, fp long")


def _keys(radius: int) -> Column:
    """Of ``fp``: the masked bits of each pair of blocks, with the table's number."""
    size = radius + 2
    cuts = [64 * i // size for i in range(size + 1)]
    masks = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(size)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return F.array(*(F.struct(F.lit(k).alias("table"), F.col("fp").bitwiseAND(F.lit(signed(masks[a] | masks[b]))).alias("bits")) for k, (a, b) in enumerate(combinations(range(size), 2))))


def near(fps: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) of the same group within the radius, by bit-sliced comparison. ``group`` is sorted."""
    n = len(fps)
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, n])
    blocks = -(-sizes // 64)
    first = np.r_[0, np.cumsum(blocks)]
    which = np.repeat(np.arange(len(starts)), sizes)
    at = np.arange(n) - starts[which]
    block, lane = first[which] + at // 64, (at % 64).astype(np.uint64)
    planes = np.zeros((64, first[-1]), np.uint64)
    valid = np.zeros(first[-1], np.uint64)
    np.bitwise_or.at(valid, block, _LANES[lane])
    for b in range(64):
        np.bitwise_or.at(planes[b], block, (fps >> np.uint64(b) & np.uint64(1)) << lane)
    # every row against the blocks of its group from its own on
    left = first[which + 1] - block
    query = np.repeat(np.arange(n), left)
    against = np.arange(len(query)) - np.repeat(np.cumsum(left) - left, left) + block[query]
    found_i, found_j = [], []
    for lo in range(0, len(query), 1 << 18):
        q, blk = query[lo : lo + (1 << 18)], against[lo : lo + (1 << 18)]
        own = blk == block[q]
        alive = valid[blk] & np.where(own, ~((_LANES[lane[q]] << np.uint64(1)) - np.uint64(1)), ~np.uint64(0))
        ones, twos, fours, over = (np.zeros(len(q), np.uint64) for _ in range(4))
        fp = fps[q]
        for b in range(64):
            differ = planes[b][blk] ^ (np.uint64(0) - (fp >> np.uint64(b) & np.uint64(1)))
            carry = ones & differ
            ones ^= differ
            more = twos & carry
            twos ^= carry
            over |= fours & more
            fours ^= more
            if b % 4 == 3:
                if radius < 4:
                    beyond = fours | (twos & (ones if radius == 2 else ~np.uint64(0)) if radius < 3 else 0)
                else:
                    beyond = fours & (twos | ones) if radius == 4 else fours & twos if radius == 5 else np.uint64(0)
                alive &= ~(over | beyond)
                keep = alive != 0
                if not keep.all():
                    q, blk, fp, alive, ones, twos, fours, over = (x[keep] for x in (q, blk, fp, alive, ones, twos, fours, over))
                if not len(q):
                    break
        for b in range(64 if len(q) else 0):
            hit = np.flatnonzero(alive >> np.uint64(b) & np.uint64(1))
            if len(hit):
                other = starts[which[q[hit]]] + (blk[hit] - first[which[q[hit]]]) * 64 + b
                found_i.append(q[hit])
                found_j.append(other)
    if not found_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_i), np.concatenate(found_j)


def forest(i: np.ndarray, j: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links as (fingerprint, smallest of its component): what a key sends on is linear in its rows."""
    if not len(i):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    signed = fps.view(np.int64)
    label = signed.copy()
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        if (new == label).all():
            break
        label = new
    touched = np.unique(np.concatenate([i, j]))
    touched = touched[label[touched] != signed[touched]]
    return signed[touched], label[touched]


def links(fps: DataFrame, radius: int = RADIUS, part: int = PART) -> DataFrame:
    """Links between distinct fingerprints ``fp``: pairs (``a``, ``b``) that span the components."""
    if radius not in range(1, 6):
        raise ValueError("the radius must be from 1 to 5")
    keyed = fps.select("fp", F.explode(_keys(radius)).alias("key")).select("fp", "key.*")
    sizes = keyed.groupBy("table", "bits").agg(F.count("*").alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / part).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(7)), parts).cast("int")
    cells = (
        keyed.join(sizes, ["table", "bits"])
        .withColumn("parts", parts)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("table", "bits", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp")
    )
    dealt = cells.repartition("table", "bits", "low", "high").sortWithinPartitions("table", "bits", "low", "high")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for cell, fp in _closed(batches):
            i, j = near(fp, cell, radius)
            a, z = forest(i, j, fp)
            if len(a):
                yield pd.DataFrame({"a": a, "b": z})

    return dealt.mapInPandas(compare, "a long, b long").distinct()


def _closed(batches: Iterator[pd.DataFrame], rows: int = 50_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Whole cells, many at a time: numbered cells and fingerprints."""
    names, held = ["table", "bits", "low", "high"], []

    def ready(frame: pd.DataFrame, last: bool) -> tuple[pd.DataFrame, pd.DataFrame]:
        keys = frame[names].to_numpy()
        new = np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]
        cut = len(frame) if last else np.flatnonzero(new)[-1]
        return frame.iloc[:cut].assign(cell=np.cumsum(new)[:cut]), frame.iloc[cut:]

    for b in batches:
        held.append(b)
        if sum(map(len, held)) >= rows:
            whole, rest = ready(pd.concat(held, ignore_index=True), False)
            held = [rest]
            if len(whole):
                yield whole["cell"].to_numpy(), whole["fp"].to_numpy().view(np.uint64)
    if held and len(frame := pd.concat(held, ignore_index=True)):
        whole, _ = ready(frame, True)
        yield whole["cell"].to_numpy(), whole["fp"].to_numpy().view(np.uint64)


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per input row: id, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id reachable by links).

    Null and wordless texts have fingerprint zero and are linked like any other. A null id never names a component that
    has another id; a component of null ids alone has none. Repeated rows share their component; an empty table gives
    no rows; other columns are not read.
    """
    prints = stage(fingerprints(docs, id_col, text_col), "simhash-prints")
    distinct = stage(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    return label_rows(prints, distinct, stage(links(distinct, radius), "simhash-links"), id_col, "simhash")


def label_rows(prints: DataFrame, distinct: DataFrame, found: DataFrame, id_col: str, name: str, *more: str) -> DataFrame:
    """Each row of ``prints`` with the smallest ``first`` of its fingerprint's component (``label``) under the links found."""
    label = components(found)
    named = distinct.join(label, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    named = stage(named, f"{name}-labels")
    smallest = named.groupBy("label").agg(F.min("first").alias("component_id"))
    by_print = named.select("fp", "label").join(smallest, "label").select("fp", "label", "component_id")
    return prints.join(by_print, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", *more
    )
