"""Hierarchical multi-length packing.

A document's whole windows of the longest context stand alone; what is left is routed to the shortest of several context
sizes that holds it. Windows are opened from the longest tier down, one remainder each; the gap is filled with the
longest pieces of shorter tiers that fit, and a piece is cut only where none fits. Windows are then dealt to step groups
so that the groups hold nearly the same number of tokens.

Every partition is packed by itself while its rows stream through: no shuffle, and memory is bounded by ``BLOCK_TOKENS``
and one document. Only the end of a partition can leave a window short.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import text_of
from .tokens import word_encoder

TIERS = (256, 512, 1024, 2048)
END = 1
#: Tokens of a training step, per group.
STEP_TOKENS = 65_536
#: Tokens packed at once in a partition.
BLOCK_TOKENS = 2_000_000
_END = END.to_bytes(4, "little")
_COLUMNS = [
    *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")),
    T.StructField("tier", T.IntegerType()),
    *(T.StructField(c, T.LongType()) for c in ("sequence_tokens", "step_group")),
]

Piece = tuple[int, int, int, bytes, object]  # length, order, start, all ids of the document, id


class Packer:
    """The pieces of one partition that wait for a window."""

    def __init__(self, base: int, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS):
        self.tiers, self.step_tokens = sorted(tiers), step_tokens
        self.next, self.group, self.order = base, base, 0
        self.pool: list[Piece] = []
        self.waiting = 0
        self.windows: list[tuple[int, list[Piece]]] = []

    def _tier(self, length: int) -> int:
        return self.tiers[bisect_left(self.tiers, length)]

    def _add(self, piece: Piece) -> None:
        insort(self.pool, piece, key=lambda p: p[:2])
        self.waiting += piece[0]

    def _take(self, at: int) -> Piece:
        piece = self.pool.pop(at)
        self.waiting -= piece[0]
        return piece

    def document(self, key: object, ids: bytes) -> None:
        total, longest = len(ids) // 4, self.tiers[-1]
        for start in range(0, total - longest + 1, longest):
            self.windows.append((longest, [(longest, 0, start, ids, key)]))
        if left := total % longest:
            self.order += 1
            self.pool.append((left, self.order, total - left, ids, key))
            self.waiting += left

    def _fill(self, window: list[Piece], gap: int) -> None:
        """Longest pieces that fit; the head of the shortest that does not, where none fits."""
        while gap and self.pool:
            at = bisect_right(self.pool, gap, key=lambda p: p[0]) - 1
            if at >= 0:
                window.append(piece := self._take(at))
            else:
                length, order, start, ids, key = self._take(0)
                window.append(piece := (gap, order, start, ids, key))
                self._add((length - gap, order, start + gap, ids, key))
            gap -= piece[0]

    def pack(self, last: bool = False) -> None:
        """Close every window that the waiting pieces can fill; at the end all of them, by falling tiers."""
        self.pool.sort(key=lambda p: p[:2])
        while self.pool and self.waiting >= (tier := self._tier(self.pool[-1][0])):
            first = self._take(len(self.pool) - 1)
            window = [first]
            self._fill(window, tier - first[0])
            self.windows.append((tier, window))
        while last and self.pool:
            tier = next((t for t in reversed(self.tiers) if t <= self.waiting), self.tiers[0])
            window: list[Piece] = []
            self._fill(window, tier)
            self.windows.append((tier, window))

    def rows(self) -> list[tuple]:
        """The closed windows, dealt to step groups: the longest first, each to the group with the fewest tokens."""
        sizes = [sum(p[0] for p in w) for _, w in self.windows]
        groups = [(0, g) for g in range(max(1, round(sum(sizes) / self.step_tokens)))]
        out, ends = [], {}
        for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
            held, group = heapq.heappop(groups)
            heapq.heappush(groups, (held + sizes[k], group))
            tier, window = self.windows[k]
            offset = 0
            for length, _, start, ids, key in window:
                if id(ids) not in ends:
                    ends[id(ids)] = memoryview(ids)
                crc = zlib.crc32(ends[id(ids)][4 * start : 4 * (start + length)])
                out.append((key, start, length, crc, len(ids) // 4, self.next, offset, tier, sizes[k], self.group + group))
                offset += length
            self.next += 1
        self.group += len(groups)
        self.windows = []
        return out


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS
) -> DataFrame:
    """One row per piece of a document in a sequence.

    Columns: id, ``start`` (the document's ids before the piece), ``length``, ``ids_crc32``, ``doc_tokens`` (with the end
    id), ``sequence_id``, ``offset`` (gapless from 0 in its sequence), ``tier`` (window size), ``sequence_tokens``,
    ``step_group``. Null and empty texts are the end id alone; null ids and repeated rows are packed like any other; an
    empty table gives no rows; other columns are not read.
    """
    columns = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *_COLUMNS])
    schema = to_arrow_schema(columns)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = word_encoder(tokenizer), Packer(TaskContext.get().partitionId() << 36, tiers, step_tokens)

        def closed() -> Iterator[pa.RecordBatch]:
            if packer.windows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*packer.rows(), strict=True), schema, strict=True)], schema=schema)

        held = 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.encode(text.as_py()) + _END
                packer.document(key, ids)
                held += len(ids) // 4
                if held >= BLOCK_TOKENS:
                    held = 0
                    packer.pack()
                    yield from closed()
        packer.pack(last=True)
        yield from closed()

    return docs.select(F.col(id_col).alias("k"), text_of(text_col).cast("binary").alias("t")).mapInArrow(part, columns)
