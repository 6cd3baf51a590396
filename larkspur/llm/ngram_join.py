"""Exact Jaccard self-join of documents on word shingles by vertical partitioning.

All shingles stand in one global order, rare ones first and within a frequency
by hash, and the order is cut into fragments.  A document's set falls into one
segment per fragment; two sets overlap by the sum of what their segments share.

* The first fragment of a document is its prefix, the ``n - ceil(t n) + 1``
  leading shingles: sets of similarity ``t`` must share some of them, and a
  bound on how many prunes pairs by this partial overlap alone.
* Pairs that survive get their partial overlaps in every fragment of the order
  as separate rows, which are summed per pair and tested exactly.

Frequencies come from all documents: a task counts shingles over pieces of
two million and reports those it has met twice, so whatever is common is
found; the ``ordered`` most frequent ones are sent to the tasks (a bounded
table).  The order decides only how much work there is, never the result: any
order that all documents share gives the same links.

Skew.  Equal sets are one class, and a task puts out the prefix of a class
once.  Frequent shingles stand last, so they are in a prefix only where nearly
the whole set is frequent, as in large groups of near copies; their rows are
salted and never meet in one task.  Such a group is not paired up either: every
class is first compared with one class at the head of its posting lists, then in
long lists the few nearest pairs of every component, and what links becomes one
component.  The pairs across components that then remain are compared without
exception: row by row in short posting lists, by blocks of classes in long ones.
Links inside a component cannot change the components.

Defined cases: a null text, or one without words, has the empty set and links
with nothing; fewer than ``width`` words are one shingle; rows with a null id
link with nothing and have a null component; repeated rows, and rows that
share an id, are in one component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import reduce
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from larkspur.llm.common import components, release, staged
from larkspur.llm.shingles import shingle_sets

_COUNT_PIECE = 2_000_000
_SEEN = 1_000_000
_SALTS = 64
_NEAREST = (2, 8, 32)  # pairs of each component that a turn compares in a long list
_WORTH = 0.02  # share of links among a turn's comparisons that makes another turn worth it
_LONG_LIST = 64  # classes of a posting list up to which it is paired up row by row
_BLOCK = 1024
_COLUMNS = 4096
_PAIR = ("ar", "ah", "an", "ac", "br", "bh", "bn", "bc")
_PROFILE = "doc_id long, h long, n long, class binary, ckey long, token long, times long"


def _digest(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def _signed(tokens: np.ndarray) -> pa.Array:
    return pa.array(tokens.view("i8"))


def _profile(width: int):
    """Per document: set size and class.  Besides, rows ``token, times`` of the shingles met in two classes of a piece."""
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("n", pa.int64()), ("class", pa.binary()), ("ckey", pa.int64()), ("token", pa.int64()), ("times", pa.int64())])

    def common(held: list[np.ndarray]) -> pa.RecordBatch:
        tokens, times = np.unique(np.concatenate(held), return_counts=True)
        tokens, times = tokens[times > 1], times[times > 1]
        nothing = [pa.nulls(len(tokens), t) for t in schema.types[:5]]
        return pa.RecordBatch.from_arrays([*nothing, _signed(tokens), pa.array(times)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()
        for batch in batches:
            sizes, classes = [], []
            for tokens in shingle_sets(batch.column("text"), width):
                sizes.append(len(tokens))
                classes.append(_digest(tokens) if len(tokens) else None)
                if len(tokens) and classes[-1] not in seen:
                    seen.add(classes[-1])
                    held.append(tokens)
                    size += len(tokens)
                if size > _COUNT_PIECE:
                    yield common(held)
                    held, size, seen = [], 0, set()
            keys = [None if c is None else int.from_bytes(c[:8], "little", signed=True) for c in classes]
            rows = [batch.column("doc_id"), batch.column("h"), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), pa.array(keys, pa.int64())]
            yield pa.RecordBatch.from_arrays([*rows, pa.nulls(len(sizes), pa.int64()), pa.nulls(len(sizes), pa.int64())], schema=schema)
        if held:
            yield common(held)

    return run


class _Order:
    """The global order: frequent shingles last by their count, all others by hash."""

    def __init__(self, tokens: np.ndarray, times: np.ndarray) -> None:
        at = np.argsort(tokens)
        self.tokens, self.times = tokens[at], times[at]

    def weights(self, tokens: np.ndarray) -> np.ndarray:
        """0 for a shingle that is not frequent."""
        if not len(self.tokens) or not len(tokens):
            return np.zeros(len(tokens), "i8")
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return np.where(self.tokens[at] == tokens, self.times[at], 0)


def _order_of(counts: DataFrame, ordered: int) -> _Order:
    """The most frequent shingles, at most ``ordered``: the least power of two of times that gives no more."""
    level = F.floor(F.log2("times")).cast("int")
    sizes = {r["level"]: r["count"] for r in counts.groupBy(level.alias("level")).count().collect()}
    least, held = 64, 0
    for at in sorted(sizes, reverse=True):
        if at < 3 or held + sizes[at] > ordered:
            break
        least, held = at, held + sizes[at]
    rows = counts.filter(level >= least).select("token", "times").toArrow()
    return _Order(rows["token"].to_numpy().view("u8"), rows["times"].to_numpy())


def _fragments_of(order: _Order, tokens: np.ndarray, fragments: int) -> list[np.ndarray]:
    """Segments of a sorted set: equal ranges of hashes among the rare shingles, then the frequent ones."""
    frequent = order.weights(tokens) > 0
    rare = tokens[~frequent]
    pivots = np.array([(i << 64) // (fragments - 1) for i in range(1, fragments - 1)], "u8")
    return [*np.split(rare, np.searchsorted(rare, pivots)), tokens[frequent]]


def _holds(rows: np.ndarray, columns: np.ndarray, n: int) -> np.ndarray:
    """How many columns each two of ``n`` rows share."""
    shared = np.zeros((n, n), "f4")
    columns = np.unique(columns, return_inverse=True)[1]
    for first in range(0, int(columns.max(initial=-1)) + 1, _COLUMNS):
        here = (columns >= first) & (columns < first + _COLUMNS)
        holds = np.zeros((n, _COLUMNS), "f4")
        holds[rows[here], columns[here] - first] = 1
        shared += holds @ holds.T
    return shared


def _close_pairs(percent: int, most: int | None):
    """Pairs of a block of classes, of different components and parts, whose shared prefix shingles reach the bound.

    ``most`` keeps the so many pairs of each component that share most.  Without
    it every pair comes out, in the block of the least long list that both stand in.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        size, n, component = len(group), group["n"].to_numpy(), group["component"].to_numpy()
        rows, tokens = np.repeat(np.arange(size), group["tokens"].map(len)), np.concatenate(group["tokens"].to_numpy())
        _, columns, times = np.unique(tokens, return_inverse=True, return_counts=True)
        keep = times[columns] > 1
        shared = _holds(rows[keep], columns[keep], size)
        low, high, both = np.minimum(n[:, None], n[None, :]), np.maximum(n[:, None], n[None, :]), n[:, None] + n[None, :]
        least = -(-both * percent // (100 + percent)) + high * percent // -100 + 1
        close = (shared >= least) & (low * 100 >= high * percent) & (component[:, None] != component[None, :])
        if group["i"].iloc[0] != group["j"].iloc[0]:
            part = group["part"].to_numpy()
            close &= part[:, None] != part[None, :]
        if most is None:
            rows, tokens = np.repeat(np.arange(size), group["long"].map(len)), np.concatenate(group["long"].to_numpy())
            earlier = tokens < group["token"].iloc[0]
            close = np.triu(close & (_holds(rows[earlier], tokens[earlier], size) == 0), 1)
        else:
            # ties go by a hash, so that a component has the same nearest partners in all of its lists
            order = np.where(close, shared + (group["h"].to_numpy().view("u8") >> np.uint64(11)) / 2.0**53, -1)
            width = min(most, size)
            near = np.argpartition(-order, width - 1, axis=1)[:, :width]
            found = pd.DataFrame({"a": np.repeat(np.arange(size), width), "b": near.ravel(), "order": np.take_along_axis(order, near, axis=1).ravel()})
            found = found[found["order"] > 0].assign(component=lambda f: component[f["a"]]).sort_values(["order", "a"], ascending=False)
            found = found[found.groupby("component").cumcount() < most]
            close = np.zeros_like(close)
            close[found["a"], found["b"]] = True
        rep, h = group["rep"].to_numpy(), group["h"].to_numpy()
        a, b = np.nonzero(close)
        return pd.DataFrame(np.stack([rep[a], h[a], n[a], component[a], rep[b], h[b], n[b], component[b]], axis=1), columns=list(_PAIR))

    return run


def ngram_components(
    docs: DataFrame, width: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text", ordered: int = 1_000_000, fragments: int = 8
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``; documents link when ``100 * intersection >= percent * union``."""
    context = docs.sparkSession.sparkContext
    text = F.col(text_column)
    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))
    profile = staged(slim.mapInArrow(_profile(width), _PROFILE), "shingle-profile")
    sized = profile.filter("n is not null").select("doc_id", "h", "n", "class", "ckey")
    common = profile.filter("token is not null").groupBy("token").agg(F.sum("times").alias("times"))
    order = context.broadcast(_order_of(common, ordered))
    share = Fraction(percent, 100)

    members = sized.filter("doc_id is not null and class is not null")
    # one row per class: its first document stands for it
    classes = members.groupBy("class", "ckey").agg(F.min(F.struct("doc_id", "h")).alias("first"), F.max("n").alias("n"))
    classes = staged(classes.select("class", "ckey", F.col("first.doc_id").alias("rep"), F.col("first.h").alias("h"), "n"), "shingle-classes")

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            tokens_out, keys_out, salts_out = [], [], []
            for tokens in shingle_sets(batch.column("text"), width):
                if not len(tokens):
                    continue
                key = int.from_bytes(_digest(tokens)[:8], "little", signed=True)
                if key in seen:
                    continue
                if len(seen) >= _SEEN:
                    seen.clear()
                seen.add(key)
                weights = order.value.weights(tokens)
                leading = np.argsort(weights, kind="stable")[: len(tokens) - ceil(share * len(tokens)) + 1]
                tokens_out.append(tokens[leading])
                keys_out.append(np.full(len(leading), key, "i8"))
                salts_out.append(np.where(weights[leading] > 0, 1 + key % _SALTS, 0).astype("i4"))
            if tokens_out:
                yield pa.RecordBatch.from_arrays(
                    [_signed(np.concatenate(tokens_out)), pa.array(np.concatenate(keys_out)), pa.array(np.concatenate(salts_out))], names=["token", "ckey", "salt"]
                )

    found = slim.filter("doc_id is not null").select("text").mapInArrow(prefixes, "token long, ckey long, salt int")
    # rare shingles (salt 0) stay if another class has them too; frequent ones are known to be shared
    same = F.count("*").over(Window.partitionBy("token", "salt"))
    postings = found.repartition("token", "salt").withColumn("m", same).filter("salt > 0 or m > 1").select("token", "ckey")
    held = postings.join(classes.select("ckey", F.struct("rep", "h", "n").alias("x")), "ckey").select("token", "x").distinct()
    lists = staged(held.withColumn("component", F.col("x.rep")), "postings")

    def bound(n: Column, m: Column) -> Column:
        """Least overlap of a linked pair of such sizes."""
        return F.ceil((n + m) * F.lit(percent) / F.lit(100 + percent) - F.lit(1e-9))

    def fits(n: Column, m: Column) -> Column:
        return F.least(n, m) * 100 >= F.greatest(n, m) * percent

    def prefix_bound(n: Column, m: Column) -> Column:
        """Least overlap of the prefixes of a linked pair: at least that of the one whose prefix ends first."""
        return bound(n, m) - F.ceil(F.greatest(n, m) * F.lit(percent) / F.lit(100) - F.lit(1e-9)) + 1

    wanted = lists.select(F.col("x.rep").alias("doc_id"), F.col("x.h").alias("h")).distinct()
    texts = staged(slim.join(wanted, ["doc_id", "h"]).dropDuplicates(["doc_id", "h"]), "shingle-texts")

    def partial_overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, counts = [], []
            for left, right in zip(shingle_sets(batch.column("left"), width), shingle_sets(batch.column("right"), width)):
                cut = zip(_fragments_of(order.value, left, fragments), _fragments_of(order.value, right, fragments))
                counts += [len(np.intersect1d(x, y, assume_unique=True)) for x, y in cut]
                parts += range(fragments)
            repeated = [pa.array(np.repeat(batch.column(c).to_numpy(zero_copy_only=False), fragments)) for c in _PAIR]
            yield pa.RecordBatch.from_arrays([*repeated, pa.array(parts, pa.int32()), pa.array(counts, pa.int64())], names=[*_PAIR, "fragment", "shared"])

    def linked(pairs: DataFrame) -> DataFrame:
        """Those of the pairs ``a, b, ac, bc`` that are links: partial overlaps per fragment, summed per pair."""
        flat = pairs.select(*[F.col(f"{s}.{c}").alias(f"{s}{k}") for s in "ab" for c, k in (("rep", "r"), ("h", "h"), ("n", "n"))], "ac", "bc")
        left = texts.select(F.col("doc_id").alias("ar"), F.col("h").alias("ah"), F.col("text").alias("left"))
        right = texts.select(F.col("doc_id").alias("br"), F.col("h").alias("bh"), F.col("text").alias("right"))
        both = flat.join(left, ["ar", "ah"]).join(right, ["br", "bh"])
        partial = both.mapInArrow(partial_overlaps, ", ".join(f"{c} long" for c in _PAIR) + ", fragment int, shared long")
        summed = partial.groupBy(*_PAIR).agg(F.sum("shared").alias("shared"))
        return summed.filter(F.col("shared") * 100 >= (F.col("an") + F.col("bn") - F.col("shared")) * percent).select("ar", "br", "ac", "bc")

    def merged(postings: DataFrame, links: DataFrame) -> DataFrame:
        """Postings with the components that the links join, of the shingles that still stand in several components."""
        joined = components(links, "ac", "bc").select(F.col("node").alias("component"), F.col("component").alias("into"))
        placed = postings.join(joined, "component", "left").select("token", "x", F.coalesce("into", "component").alias("component"))
        mixed = placed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("token")
        return staged(placed.join(mixed, "token", "left_semi"), "postings")

    links, compared = [], []

    def upward(pairs: DataFrame) -> DataFrame:
        """Each pair once, whichever side it was found from."""
        swap = F.col("a") < F.col("b")
        sides = {"a": ("b", "a"), "b": ("a", "b"), "ac": ("bc", "ac"), "bc": ("ac", "bc")}
        return pairs.select(*[F.when(swap, F.col(x)).otherwise(F.col(y)).alias(name) for name, (x, y) in sides.items()])

    def compare(pairs: DataFrame) -> int:
        """Compare the pairs that are not compared yet; their links join components.  Gives the number of links."""
        nonlocal lists
        oriented = upward(pairs).dropDuplicates(["a", "b"])
        if compared:
            oriented = oriented.join(reduce(DataFrame.unionByName, compared).select("a", "b"), ["a", "b"], "left_anti")
        compared.append(staged(oriented, "pairs"))
        links.append(staged(linked(compared[-1]), "links"))
        last, lists = lists, merged(lists, links[-1])
        release(last)  # the new postings are written, and nothing reads the old ones again
        return links[-1].count()

    def long_lists(most: int | None) -> DataFrame:
        """Pairs from long posting lists: blocks of classes, each with all its shingles, so that only pairs within the bound come out."""
        sizes = lists.groupBy("token").agg(F.count("*").alias("m")).filter(F.col("m") > _LONG_LIST)
        in_long = F.collect_list(F.when(F.col("m").isNotNull(), F.struct("token", "m"))).alias("long")
        sets = lists.join(sizes, "token", "left").groupBy("x", "component").agg(F.collect_list("token").alias("tokens"), in_long).filter(F.size("long") > 0)
        longer = sets.select("x", "component", "tokens", F.col("long.token").alias("long"), F.explode("long").alias("at")).select("*", "at.token", "at.m")
        parts = F.ceil(F.col("m") / _BLOCK).cast("int")
        cut = longer.withColumn("part", F.pmod(F.xxhash64("x.rep", "x.h"), parts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        blocks = cut.select(
            "token", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "x.rep", "x.h", "x.n", "component", "tokens", "long"
        )
        found = blocks.groupBy("token", "i", "j").applyInPandas(_close_pairs(percent, most), ", ".join(f"{c} long" for c in _PAIR))
        ends = [F.struct(F.col(f"{s}r").alias("rep"), F.col(f"{s}h").alias("h"), F.col(f"{s}n").alias("n")).alias(s) for s in "ab"]
        return found.select(*ends, "ac", "bc")

    def short_lists() -> DataFrame:
        """Pairs from short posting lists, row by row; shingles that the two may share in long lists count in their favour."""
        sizes = lists.groupBy("token").agg(F.count("*").alias("m"))
        sized_lists = lists.join(sizes, "token")
        held_long = sized_lists.filter(F.col("m") > _LONG_LIST).groupBy("x").agg(F.count("*").alias("long"))
        short = sized_lists.filter(F.col("m") <= _LONG_LIST).join(held_long, "x", "left").select("token", "x", "component", F.coalesce("long", F.lit(0)).alias("long"))
        one, two = (short.select("token", F.col("x").alias(s), F.col("component").alias(f"{s}c"), F.col("long").alias(f"{s}l")) for s in "ab")
        across = one.join(two, "token").filter((F.col("a") > F.col("b")) & (F.col("ac") != F.col("bc")) & fits(F.col("a.n"), F.col("b.n")))
        counted = across.groupBy("a", "b", "ac", "bc", "al", "bl").agg(F.count("*").alias("m"))
        return counted.filter(F.col("m") + F.least("al", "bl") >= prefix_bound(F.col("a.n"), F.col("b.n"))).select("a", "b", "ac", "bc")

    # each class with the one class, of those at the head of its posting lists, that shares most of its prefix
    heads = lists.groupBy("token").agg(F.min(F.struct(F.xxhash64("x.rep", "x.h").alias("k"), F.col("x").alias("b"), F.col("component").alias("bc"))).alias("one"))
    toward = lists.select("token", F.col("x").alias("a"), F.col("component").alias("ac")).join(heads.select("token", "one.b", "one.bc"), "token")
    stars = toward.filter((F.col("ac") != F.col("bc")) & fits(F.col("a.n"), F.col("b.n"))).groupBy("a", "b", "ac", "bc").agg(F.count("*").alias("m"))
    compare(stars.groupBy("a", "ac").agg(F.max_by(F.struct("b", "bc"), F.struct("m", "b")).alias("to")).select("a", "ac", "to.b", "to.bc"))
    # large groups: the nearest few pairs of every component, more and more of them while that still joins many
    for most in _NEAREST:
        if compare(long_lists(most)) <= _WORTH * compared[-1].count():
            break
    remaining = staged(upward(short_lists().unionByName(long_lists(None))), "pairs")
    release(lists)
    new = remaining.dropDuplicates(["a", "b"]).join(reduce(DataFrame.unionByName, compared).select("a", "b"), ["a", "b"], "left_anti")
    links.append(staged(linked(new), "links"))

    copies = members.join(classes.select("class", "ckey", "rep"), ["class", "ckey"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    edges = reduce(DataFrame.unionByName, links).select(F.col("ar").alias("a"), F.col("br").alias("b"))
    whole = components(edges.unionByName(copies))
    out = sized.join(whole.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
