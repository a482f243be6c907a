"""Token ids of whole texts with a ``tokenizers`` file, encoding a word once while the Python worker remembers it.

Usable where no token crosses the white space between words and words are cut at the border of letters and punctuation,
as in ``word_bpe_49k.json``; tests hold the result to the library's own on arbitrary text.
"""

from __future__ import annotations

import re
import struct
from functools import cache
from unicodedata import normalize

#: Words and stems that a worker has at hand before it puts them aside (and forgets what was aside): about 150 bytes each.
REMEMBERED = 250_000
_TAIL = re.compile(rb"(.*[A-Za-z0-9\x80-\xff])([!-/:-@\[-`{-~]+)", re.DOTALL)
_LATIN_END = "ɐ"


def _byte_alphabet() -> dict[int, int]:
    """Byte-level alphabet: printable Latin-1 stands for itself, the rest follows from 256 on, in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (b for b in range(256) if b not in own)
    return {b: 256 + k for k, b in enumerate(rest)}


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Remembered(dict):
    """Results of a function in two generations: what is asked for again is found in the older one, and lives on."""

    def __init__(self, of, most: int):
        super().__init__()
        self.of, self.most, self.aside = of, most, {}

    def __missing__(self, key):
        if len(self) >= self.most:
            self.aside = dict(self)
            self.clear()
        found = self.aside.get(key)
        if found is None:
            found = self.of(key)
        self[key] = found
        return found


class WordEncoder:
    """Texts to ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.alphabet = self.tokenizer.model, _byte_alphabet()
        self.words = _Remembered(self._word, remembered)  # a stem by itself is a word: both are kept here, once

    def _word(self, word: bytes) -> bytes:
        """A word and the punctuation after its last letter encode independently, unless it holds a special token."""
        if word.isalpha():  # ASCII letters only
            return self._part(word) if (low := word.lower()) == word else self.words[low]
        if b"<|" not in word and (m := _TAIL.fullmatch(word)) and (m[1][-1] < 128 or m[1].decode("utf-8")[-1].lower().isalpha()):
            return self.words[m[1].lower()] + self.words[m[2]]
        return self._part(word)

    def _part(self, part: bytes) -> bytes:
        if part.isalpha():
            return _packed([t.id for t in self.model.tokenize(part.decode().lower())])
        text = part.decode("utf-8")
        if max(text) < _LATIN_END:
            low = normalize("NFC", text).lower()
            if low.isalpha():  # one stretch of letters: the model alone, without the search for its borders
                written = low.encode("utf-8").decode("latin-1").translate(self.alphabet)
                return _packed([t.id for t in self.model.tokenize(written)])
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, text: bytes) -> bytes:
        return b"".join(map(self.words.__getitem__, text.split()))


@cache
def word_encoder(path: str) -> WordEncoder:
    """One encoder for all tasks of a Python worker."""
    return WordEncoder(path)
