"""The transducer on a unigram model, written field by field, against the library's own Viterbi search."""

import random
import struct

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor

from tidegate.llm import transducer


def varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def field(number, value):
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def model(path, pieces):
    """A model file of these (piece, score) with byte fallback; kinds: 1 normal, 2 unknown, 3 control, 6 byte."""
    rows = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *((f"<0x{b:02X}>", 0.0, 6) for b in range(256)), *((p, s, 1) for p, s in pieces)]
    out = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, k)) for p, s, k in rows)
    out += field(2, field(3, 1) + field(4, len(rows)) + field(35, 1)) + field(3, field(1, b"identity") + field(3, 1) + field(4, 0) + field(5, 1))
    path.write_bytes(out)
    return str(path)


@pytest.mark.parametrize("seed", range(4))
def test_weights_give_the_librarys_path(tmp_path, seed):
    rng = random.Random(seed)
    letters = ["▁", *"abcdé,"]
    pieces = {c: -rng.uniform(4, 9) for c in letters if c != "d"}  # a letter that longer pieces hold and none stands for
    pieces |= {"".join(rng.choices(letters, k=rng.randint(2, 5))): -rng.uniform(3, 12) for _ in range(60)}
    path = model(tmp_path / "unigram.model", list(pieces.items()))
    machine, library = transducer.Transducer(path, remembered=20), SentencePieceProcessor(model_file=path)
    assert machine.unigram
    ties = 0
    for _ in range(1500):
        text = "".join(rng.choice([*"abcdé,", " ", " ", "漢", "🙂"]) for _ in range(rng.randint(0, 14)))
        ids, wanted = np.frombuffer(machine.encode(text), "<u4").tolist(), library.encode(text)
        if ids != wanted:  # paths of equal weight, such as "a aa" and "aa a", which the library tells apart by rounding
            ties += 1
            assert abs(sum(map(library.get_score, ids)) - sum(map(library.get_score, wanted))) < 1e-4, text
        assert machine.decode(machine.encode(text)) == text
    assert ties < 15
