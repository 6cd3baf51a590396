"""Sets of hashed word shingles, computed on whole Arrow columns of text.

Words are the runs of bytes other than space and 0x09-0x0D after A-Z became
a-z.  A word's hash is a polynomial of its bytes, mixed; a shingle's combines
the hashes of its words.  All of it is array arithmetic over the bytes of many
texts at once, in pieces of about ``_PIECE`` bytes (one text at least).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_PIECE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_TAG = np.uint64(0xD1B54A32D192ED03)
EMPTY = np.empty(0, "u8")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) > 1 else values


def _sets_of_piece(data: np.ndarray, cuts: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """One sorted set per text; text ``i`` holds the bytes ``cuts[i]:cuts[i + 1]``."""
    n, texts = len(data), len(cuts) - 1
    weights = _mixed(np.arange(1, width + 1, dtype="u8") * _BASE) | np.uint64(1)
    data = np.where((data >= 65) & (data <= 90), data + 32, data)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    opens = np.append(True, space[:-1]) if n else space
    opens[cuts[:-1][cuts[:-1] < n]] = True
    starts = np.flatnonzero(opens & ~space)
    if not len(starts):
        yield from (EMPTY for _ in range(texts))
        return
    at = starts[0]
    inside = np.arange(at, n) - np.repeat(starts, np.diff(np.append(starts, n)))
    inside[space[at:]] = 0
    powers = np.append(np.uint64(1), np.cumprod(np.full(inside.max(), _BASE | np.uint64(1), "u8"), dtype="u8"))
    values = (data[at:].astype("u8") + np.uint64(1)) * powers[inside]
    values[space[at:]] = 0
    words = _mixed(np.add.reduceat(values, starts - at))
    counts = np.bincount(np.searchsorted(cuts, starts, "right") - 1, minlength=texts)
    grams = EMPTY
    if len(words) >= width:
        grams = np.zeros(len(words) - width + 1, "u8")
        for i in range(width):
            grams += words[i : len(words) - width + 1 + i] * weights[i]
        grams = _mixed(grams)
    first = 0
    for count in counts.tolist():
        if count >= width:
            yield _distinct(grams[first : first + count - width + 1])
        elif count:
            short = (words[first : first + count] * weights[:count]).sum(keepdims=True) + np.array([count], "u8") * _TAG
            yield _mixed(short)
        else:
            yield EMPTY
        first += count


def shingle_sets(texts: pa.Array, width: int = 5) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles of each text.

    Fewer words make one shingle of the whole sequence; a null text, or one
    without words, has the empty set.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    cuts = np.frombuffer(offsets, "<i8", len(texts) + 1, texts.offset * 8)
    content = np.frombuffer(data, "u1") if data is not None else np.empty(0, "u1")
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(cuts, cuts[first] + _PIECE, "right")) - 1)
        yield from _sets_of_piece(content[cuts[first] : cuts[last]], cuts[first : last + 1] - cuts[first], width)
        first = last
