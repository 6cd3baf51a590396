"""Quality rules of a text: plain counts, and repetition found with a suffix array of its words.

The words of a block of documents become numbers, and one suffix array orders
the suffixes of every document (prefix doubling: only suffixes that still tie
are sorted again, so prose takes few rounds).  The ranks of the rounds give the
longest common prefix of neighbouring suffixes.  Intervals of that array are
the repeated word sequences; an interval whose suffixes are preceded by
different words cannot be extended to the left either and is a maximal repeat.
A suffix lies in nested intervals, of which the innermost has the longest
repeat that starts there, so the union of the spans of all repeats needs one
mark per suffix and not one per interval and suffix.

A document is rejected (``kept`` false) if it fails the base rules (fewer than
``min_words`` words, or more than ``max_repeat_words`` per cent of its words in
word windows of ``window`` that occur twice), if repeats of ``least`` words or
more cover over ``max_covered`` per cent of its word characters, or if one
repeat is longer than ``max_longest`` words.

Defined cases: a word is a run of characters other than the six ASCII
white-space ones; null and empty texts have no word, count zero everywhere and
fail the base rules; a text is scanned whole, in a block of its own if it is
long; repeated ids and rows are judged one by one; other columns stay, and an
empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOLS = "[#*$%&|<>]"
_BLOCK_BYTES = 1 << 21  # of text that one suffix array covers, unless one text is longer

REPETITION = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, covered_chars long, longest_repeat long, "
    "n_repeats long, repeat_spans array<struct<start:long,end:long>>, kept boolean"
)


def suffix_array(symbols: np.ndarray, docs: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order of all suffixes (document by document) and, per round ``r``, ranks that are equal just where the first ``2**r`` symbols are.

    ``docs`` numbers the document of each position (ascending), ``stops`` is where that document ends.
    """
    n = len(symbols)
    key = docs * (int(symbols.max(initial=0)) + 1) + symbols
    order = np.argsort(key, kind="stable")
    slots, key = np.arange(n), key[order]
    rank, ranks, width = np.empty(n, "i4"), [], 1
    while True:
        new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
        rank[order[slots]] = slots[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))] if len(new) else 0
        ranks.append(rank.copy())
        alone = new & np.concatenate([new[1:], [True]]) if len(new) else new
        slots = slots[~alone]
        if not len(slots):
            return order, ranks
        tied = order[slots]
        ahead = tied + width
        key = rank[tied].astype("i8") * (n + 1) + np.where(ahead < stops[tied], rank[np.minimum(ahead, n - 1)] + 1, 0)
        again = np.argsort(key)
        order[slots], key = tied[again], key[again]
        width *= 2


def common_prefixes(order: np.ndarray, ranks: list[np.ndarray], least: int) -> np.ndarray:
    """Length of the common prefix of each suffix and the one before it in the order, 0 where it is below ``least``."""
    n = len(order)
    found = np.zeros(n, "i8")
    first = min(least.bit_length() - 1, len(ranks) - 1)
    a, b = order[:-1], order[1:]
    near = np.flatnonzero(ranks[first][a] == ranks[first][b])
    a, b, length = a[near], b[near], np.zeros(len(near), "i8")
    for r in reversed(range(len(ranks))):
        at, other = a + length, b + length
        inside = (at < n) & (other < n)
        same = inside & (ranks[r][np.minimum(at, n - 1)] == ranks[r][np.minimum(other, n - 1)])
        length += same.astype("i8") << r
    found[near + 1] = np.where(length >= least, length, 0)
    return found


def maximal_repeats(prefixes: np.ndarray, before: np.ndarray) -> list[tuple[int, int, int]]:
    """Intervals ``(length, first, last)`` of the order whose sequence can be extended neither to the right nor to the left.

    ``before`` holds the symbol before each suffix of the order, another one for each start of a document.
    """
    changes = np.concatenate([[0], np.cumsum(before[1:] != before[:-1])]) if len(before) else before
    found: list[tuple[int, int, int]] = []
    open_: list[tuple[int, int]] = []

    def close(down_to: int, last: int) -> int:
        first = last
        while open_ and open_[-1][0] > down_to:
            length, first = open_.pop()
            if changes[last] != changes[first]:
                found.append((length, first, last))
        return first

    previous = -1
    for slot in np.flatnonzero(prefixes).tolist():
        if slot != previous + 1:
            close(0, previous)
        length, first = int(prefixes[slot]), slot - 1
        if open_ and open_[-1][0] > length:
            first = close(length, slot - 1)
        if not open_ or open_[-1][0] < length:
            open_.append((length, first))
        previous = slot
    close(0, previous)
    return found


def _covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in one of the spans."""
    edges = np.zeros(n + 1, "i8")
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + lengths, -1)
    return np.cumsum(edges[:-1]) > 0


def _spans(text: str, covered: np.ndarray) -> list[dict[str, int]]:
    """Runs of covered words as code point spans of the text."""
    words = [m.span() for m in _WORD.finditer(text)]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype("i1"), [0]])))
    return [{"start": words[a][0], "end": words[z - 1][1]} for a, z in edges.reshape(-1, 2).tolist()]


def scan_block(texts: pa.Array, window: int, min_words: int, max_repeat_words: int, least: int, max_covered: int, max_longest: int) -> dict[str, list]:
    """The columns of :data:`REPETITION` for a few texts."""
    n_docs = len(texts)
    texts = pc.fill_null(texts, "")
    split = pc.ascii_split_whitespace(texts)
    docs = np.repeat(np.arange(n_docs), np.diff(split.offsets.to_numpy()))
    words = split.flatten()
    real = pc.greater(pc.binary_length(words), 0)
    docs, coded = docs[real.to_numpy(zero_copy_only=False)], words.filter(real).dictionary_encode()
    symbols = coded.indices.to_numpy().astype("i8")
    chars = pc.utf8_length(coded.dictionary).to_numpy()[symbols] if len(symbols) else symbols
    marks = pc.count_substring_regex(coded.dictionary, _SYMBOLS).to_numpy()[symbols] if len(symbols) else symbols
    n = len(symbols)
    count = lambda weights: np.bincount(docs, weights, n_docs).astype("i8")
    n_words, word_chars = np.bincount(docs, minlength=n_docs), count(chars)

    lines = pc.split_pattern(texts, "\n")
    line_docs, line = np.repeat(np.arange(n_docs), np.diff(lines.offsets.to_numpy())), lines.flatten()
    filled = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(line)), 0).to_numpy(zero_copy_only=False)
    numbers = line.dictionary_encode().indices.to_numpy().astype("i8")[filled]
    each = line_docs[filled] * (len(line) + 1) + numbers
    dup_lines = np.bincount(line_docs[filled], minlength=n_docs) - np.bincount(np.unique(each) // (len(line) + 1), minlength=n_docs)

    longest, repeats, covered_chars, repeat_words = (np.zeros(n_docs, "i8") for _ in range(4))
    spans: list[list] = [[] for _ in range(n_docs)]
    if n:
        ends = np.cumsum(n_words)
        order, ranks = suffix_array(symbols, docs, ends[docs])
        prefixes = common_prefixes(order, ranks, min(window, least))
        here = np.maximum(prefixes, np.concatenate([prefixes[1:], [0]]))  # of the innermost interval of each suffix
        for shortest, total, weights in ((window, repeat_words, None), (least, covered_chars, chars)):
            rows = np.flatnonzero(here >= shortest)
            if len(rows):
                total += np.bincount(docs, _covered(order[rows], here[rows], n) * (1 if weights is None else weights), n_docs).astype("i8")
        np.maximum.at(longest, docs[order], here)
        long = np.where(prefixes >= least, prefixes, 0)
        if long.any():
            before = np.where(order == ends[docs[order]] - n_words[docs[order]], -1 - order, symbols[order - 1])
            for _, first, _ in maximal_repeats(long, before):
                repeats[docs[order[first]]] += 1
            rows = np.flatnonzero(here >= least)
            covered = _covered(order[rows], here[rows], n)
            for doc in np.unique(docs[covered]).tolist():
                spans[doc] = _spans(texts[doc].as_py(), covered[ends[doc] - n_words[doc] : ends[doc]])
    failed = (n_words < min_words) | (100 * repeat_words > max_repeat_words * n_words)
    kept = ~failed & (100 * covered_chars <= max_covered * word_chars) & (longest <= max_longest)
    out = {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": count(marks), "n_dup_lines": dup_lines, "n_repeat_words": repeat_words, "base_failed": failed,
        "covered_chars": covered_chars, "longest_repeat": np.where(longest >= min(window, least), longest, 0), "n_repeats": repeats,
    }
    return {**{k: v.tolist() for k, v in out.items()}, "repeat_spans": spans, "kept": kept.tolist()}


def with_repetition(
    df: DataFrame, text_column: str = "text", result_column: str = "repetition", window: int = 5, min_words: int = 10, max_repeat_words: int = 20,
    least: int = 10, max_covered: int = 25, max_longest: int = 50,
) -> DataFrame:
    """Add one struct per row with the fields of :data:`REPETITION`; ``repeat_spans`` are code points, end exclusive."""
    kind = pa.struct(
        [(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [("base_failed", pa.bool_())]
        + [(n, pa.int64()) for n in ("covered_chars", "longest_repeat", "n_repeats")]
        + [("repeat_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.bool_())]
    )

    @F.arrow_udf(REPETITION)
    def scan(texts: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype("i8")
        block = np.cumsum(sizes) // _BLOCK_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(texts)]
        done = [scan_block(texts.slice(a, z - a), window, min_words, max_repeat_words, least, max_covered, max_longest) for a, z in zip(cuts, cuts[1:]) if z > a]
        merged = {f.name: [x for part in done for x in part[f.name]] for f in kind}
        return pa.StructArray.from_arrays([pa.array(merged[f.name], f.type) for f in kind], fields=list(kind))

    return df.withColumn(result_column, scan(F.col(text_column)))
