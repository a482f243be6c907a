"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three machines are compiled from the model file and composed with each input: the normaliser (dummy prefix, spaces to
the space sign); the pieces with byte fallback, as an automaton that finds every arc over a text in one walk (an arc for
each piece, and for a character in no piece an arc to its bytes); and, for a model of merges, a machine over pieces that
lets ``b`` follow ``a`` only where merging their joint text gives back ``a b``. Arcs are weighted in the tropical
semiring and the shortest path is taken, its states being a place in the text and the piece before it.

A unigram model's arcs weigh the negative score of their piece, and the third machine lets everything pass. In a model of
merges arcs weigh one each. There a path whose neighbours may all follow one another is the model's encoding, and there is
only one: merging goes by score alone, so a merge across the border of two pieces that comes before their own would also
come first in their joint text, and no sum of weights could tell. One state for each place is then enough; tests hold the
result to the library's on arbitrary text for both kinds.

Compositions are made per stretch of text between places that no piece spans, and remembered.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache
from operator import add

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .tokens import _packed, _Remembered

SPACE_SIGN = "▁"
#: Words, and as many stretches of text, that a worker has at hand before it puts them aside.
REMEMBERED = 200_000
#: What a character in no piece weighs beyond the worst piece of a unigram model.
_UNKNOWN = 10.0


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protocol-buffer message: number, and integer or bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = varint() if kind == 2 else 4 if kind == 5 else 8
            yield tag >> 3, data[at : at + size]
            at += size


class Transducer:
    """The machines of one model file whose normaliser is the identity."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        parts = {k: v for k, v in _fields(model.serialized_model_proto()) if k in (2, 3)}
        normaliser, trainer = dict(_fields(parts[3])), dict(_fields(parts.get(2, b"")))
        self.unigram = trainer.get(3, 1) == 1
        if not self.unigram and trainer[3] != 2:
            raise ValueError("only unigram models and models of merges are supported")
        if normaliser.get(2) or normaliser.get(4, 1):
            raise ValueError("only models whose normaliser changes nothing but spaces are supported")
        self.prefix = SPACE_SIGN if normaliser.get(3, 1) else ""
        size = model.get_piece_size()
        self.byte_ids = [0] * 256
        self.output = [b""] * size
        self.piece_ids: dict[str, int] = {}
        self.scores = [model.get_score(i) for i in range(size)]
        self.text = [""] * size
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.output[i] = bytes([int(piece[1:-1], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.piece_ids[piece] = i
                self.text[i] = piece
                self.output[i] = piece.replace(SPACE_SIGN, " ").encode()
        worst = min((self.scores[i] for i in self.piece_ids.values()), default=0.0)
        #: The machine of pieces: over a text it gives the end of every arc, its piece, length and weight.
        self.arcs = ahocorasick.Automaton()
        for p, i in self.piece_ids.items():
            self.arcs.add_word(p, (i, len(p), -self.scores[i] if self.unigram else 1))
        self.arcs.make_automaton()
        self.fallback = _UNKNOWN - worst if self.unigram else 1
        self.single = {p for p in self.piece_ids if len(p) == 1}
        inside = {p[k : k + 2] for p in self.piece_ids for k in range(len(p) - 1)}
        self.whole_words = not any(x[1] == SPACE_SIGN != x[0] for x in inside)
        self.inside = inside
        #: How texts are cut before anything is looked up: nowhere, before spaces, or also around Latin letters.
        self.cut = None
        if self.whole_words:
            mixed = any(bool(_LETTER.match(a)) != bool(_LETTER.match(b)) for a, b in inside if a != SPACE_SIGN)
            self.cut = _WORD if mixed else _STRETCH
        self.follows = _Remembered(self._may_follow, remembered)
        self.words, self.stretches = _Remembered(self._word, remembered), _Remembered(self._stretch, remembered)

    def normalise(self, text: str) -> str:
        return self.prefix + text.replace(" ", SPACE_SIGN) if text else ""

    def merged(self, text: str) -> list[str]:
        """Merging neighbours by score, leftmost first, until none is a piece: what defines the third machine."""
        parts = list(text)
        while True:
            best = None
            for k in range(len(parts) - 1):
                i = self.piece_ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.scores[i] > best[0]):
                    best = (self.scores[i], k)
            if best is None:
                return parts
            k = best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def _may_follow(self, pair: tuple[int, int]) -> bool:
        x, y = self.text[pair[0]], self.text[pair[1]]
        return self.merged(x + y) == [x, y]

    def shortest_path(self, text: str) -> list[int]:
        """Ids along the cheapest path of the composition with one stretch."""
        n, follow, free = len(text), self.follows, self.unigram
        cost = [float("inf")] * (n + 1)
        cost[0] = 0
        last = [-1] * (n + 1)  # the piece before a place; bytes and the start are -1 and may precede all
        back = [0] * (n + 1)
        bare = [] if self.single.issuperset(text) else [k for k, c in enumerate(text) if c not in self.single]
        at = 0  # of the characters that no piece stands for alone, the first whose arc to bytes is not yet taken
        for end, (piece, size, weight) in self.arcs.iter(text):
            start = end + 1 - size
            while at < len(bare) and bare[at] < start:
                self._to_bytes(text, bare[at], cost, last, back)
                at += 1
            so_far = cost[start] + weight
            if so_far < cost[end + 1]:
                before = last[start]
                if before < 0 or free or follow[before, piece]:
                    cost[end + 1], last[end + 1], back[end + 1] = so_far, piece, start
        for k in bare[at:]:
            self._to_bytes(text, k, cost, last, back)
        path, end = [], n
        while end:
            path.append([last[end]] if last[end] >= 0 else [self.byte_ids[b] for b in text[back[end] : end].encode()])
            end = back[end]
        return [i for x in reversed(path) for i in x]

    def _to_bytes(self, text: str, at: int, cost: list, last: list, back: list) -> None:
        weight = self.fallback if self.unigram else len(text[at].encode())
        if cost[at] + weight < cost[at + 1]:
            cost[at + 1], last[at + 1], back[at + 1] = cost[at] + weight, -1, at

    def _stretch(self, text: str) -> bytes:
        return _packed(self.shortest_path(text))

    def _word(self, word: str) -> bytes:
        inside, found, start = self.inside, [], 0
        for k, pair in enumerate(map(add, word, word[1:]), 1):
            if pair not in inside:
                found.append(self.stretches[word[start:k]])
                start = k
        found.append(self.stretches[word[start:]])
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        text = self.normalise(text)
        if self.cut is None:
            return self._word(text)
        return b"".join(map(self.words.__getitem__, self.cut.findall(text)))

    def decode(self, ids: bytes) -> str:
        """The text of ids: pieces and bytes joined, without the dummy prefix; bytes that are no text become U+FFFD."""
        output = self.output
        text = b"".join([output[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
_LETTER = re.compile(f"[{_LATIN}]")
_WORD = re.compile(f"{SPACE_SIGN}+[^{SPACE_SIGN}]*|[^{SPACE_SIGN}]+")
_STRETCH = re.compile(f"{SPACE_SIGN}*[{_LATIN}]+|{SPACE_SIGN}*[^{_LATIN}{SPACE_SIGN}]+|{SPACE_SIGN}+")


@cache
def transducer(path: str) -> Transducer:
    """One transducer for all tasks of a Python worker."""
    return Transducer(path)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``ids`` (little-endian unsigned 32-bit), ``n_ids``, ``ids_crc32``, ``n_byte_ids``, ``decoded``.

    Null and empty texts have no ids and decode to an empty text; null ids and repeated rows are encoded like any other;
    an empty table gives no rows; other columns are not read. Rows are independent: no shuffle.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model)
        low, high = min(machine.byte_ids), max(machine.byte_ids)
        for b in batches:
            rows = []
            for text in b.column(1):
                ids = machine.encode(text.as_py())
                numbers = np.frombuffer(ids, "<u4")
                rows.append((ids, len(numbers), zlib.crc32(ids), int(((numbers >= low) & (numbers <= high)).sum()), machine.decode(ids)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["id", "ids", "n_ids", "ids_crc32", "n_byte_ids", "decoded"])

    read = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t"))
    return read.mapInArrow(part, f"id {kind}, ids binary, n_ids long, ids_crc32 long, n_byte_ids long, decoded string").withColumnRenamed("id", id_col)
