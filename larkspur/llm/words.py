"""Whole texts to ids of a ``tokenizers`` file, each distinct word encoded once per task.

A byte-pair tokenizer first cuts a text into words by a fixed pattern and then
merges inside words only, so the ids of a text are the ids of its words in
order.  For texts whose characters all lie below U+0180 the cut is made here
with classes built from ``unicodedata``; words then come from a table that asks
the library about each new word.  Any other text goes to the library whole, so
the ids are the library's in every case.  Strings of special tokens inside a
text are ordinary text.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable

import numpy as np
from tokenizers import Tokenizer

_TOP, _LOWERED_TOP = 0x180, 0x250  # lower case of a letter below the first lies below the second


def _class(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(_LOWERED_TOP) if unicodedata.category(chr(c)).startswith(kind))


_SPACE = re.escape("\t\n\x0b\x0c\r \x85\xa0")
_LETTER, _NUMBER = _class("L"), _class("N")
_OUTSIDE = re.compile(f"[^\\x00-{chr(_TOP - 1)}]")
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"  # fixed by the tokenizers' published patterns
_BYTE_WORDS = re.compile(
    f"{_CONTRACTIONS}| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
_LOWER_WORDS = re.compile(f"{_CONTRACTIONS}|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")


def _byte_characters() -> dict[int, str]:
    """The published byte-level alphabet: visible Latin-1 characters stand for themselves, other bytes for 256, 257, ..."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


_BYTE_CHARACTERS = _byte_characters()


class WordTable(dict):
    """word -> its ids as bytes.  Starts afresh at ``limit`` words; words over 64 characters are not kept."""

    def __init__(self, ids_of: Callable[[str], Iterable[int]], dtype: str, limit: int = 400_000) -> None:
        super().__init__()
        self.ids_of, self.dtype, self.limit = ids_of, dtype, limit

    def __missing__(self, word: str) -> bytes:
        ids = np.asarray(self.ids_of(word), self.dtype).tobytes()
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[word] = ids
        return ids


class TextEncoder:
    """``encode(text)`` gives the text's ids, without special tokens, as an array of ``dtype``."""

    def __init__(self, file: bytes, dtype: str = "<u4") -> None:
        self.tokenizer = Tokenizer.from_str(file.decode())
        self.tokenizer.encode_special_tokens = True
        self.dtype = np.dtype(dtype)
        model = self.tokenizer.model  # the library's merges of one word, without the cost of offsets and masks
        # the table refers to the model and not to this object, so that both go as soon as nothing uses them
        self.table = WordTable(lambda word: [t.id for t in model.tokenize(word.encode().decode("latin-1").translate(_BYTE_CHARACTERS))], self.dtype)
        kind = (type(self.tokenizer.normalizer).__name__, type(self.tokenizer.pre_tokenizer).__name__)
        if kind == ("NoneType", "ByteLevel"):
            self.cut = _BYTE_WORDS.findall
        elif kind == ("Sequence", "Sequence") and self.tokenizer.normalizer.normalize_str("A \n b") == "a b":
            self.cut = lambda text: _LOWER_WORDS.findall(text.lower())
        else:
            self.cut = None

    def _library(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, self.dtype)
        if self.cut is None or _OUTSIDE.search(text):
            return np.asarray(self._library(text), self.dtype)
        return np.frombuffer(b"".join(map(self.table.__getitem__, self.cut(text))), self.dtype)
