"""Trie of conversation prefixes, built from range-partitioned paths and a skeleton of splitter paths.

A turn is a key of 16 bytes (a digest of role and text), a conversation the
path of its keys, and a node a prefix of paths.  Paths are range-partitioned by
``(path, conv_id)`` at splitters drawn from a bounded sample, so copies of one
conversation spread over shards too.  If conversations of one node lie in two
shards, a splitter lies between them and starts with that node's prefix.  The
prefixes of the splitters, the skeleton, are therefore the only nodes that need
more than one shard.  The splitters are broadcast (at most ``max_shards`` paths
of ``splitter_turns`` keys; a longer path splits at its beginning).

A shard reads its paths in order and keeps the nodes of the current path open.
A closed node outside the skeleton is final.  A skeleton node puts out its part
of the aggregates; the parts are summed per node, the totals of subtrees over
the few ancestors of each skeleton node.  The ids that end at a skeleton node
are put out as joined text in pieces and hashed piece by piece in order, so
they are never held together, and neither is a shard: it is a stream.

Defined cases: rows with a null conversation id take no part; null roles and
texts are empty; turns are ordered by number, null first, then by key; repeated
rows stay as turns of their own; conversations without a turn after rebuilding
are members of the root and end there; other columns are ignored; an empty
table gives no node.  A conversation's path (about 20 bytes a turn) is one row.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from larkspur.llm.common import Shared, staged

_KEY = 16  # bytes of a turn's key
_PIECE = 16_384  # characters of joined ids put out at once
_ROWS = 4_096  # rows of an output batch
_FINAL, _BELOW, _PART, _ENDS = range(4)  # kinds of rows a shard puts out
_FIELDS = [
    ("kind", pa.int32()), ("key", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.string()), ("chars", pa.int64()), ("shard", pa.int32()), ("piece", pa.int64()),
]
_DDL = (
    "kind int, key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, "
    "chars long, shard int, piece long"
)
_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversation_turns(rows: DataFrame) -> DataFrame:
    """``conv_id, turns``: the keys and code points of each conversation's turns, in order; texts do not travel."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.substring(F.sha2(F.encode(F.concat(F.length(role), F.lit(":"), role, text), "UTF-8"), 256), 1, 2 * _KEY)
    turn = F.struct("turn", key.alias("key"), F.length(text).alias("chars"))
    return rows.filter("conv_id is not null").groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def with_shared_heads(turns: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Replace the first ``crc32(conv_id) % most`` turns of each conversation by those of the first conversation of its ``group`` ids (towards zero for negative ids)."""
    heads = turns.filter(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("head"))
    own = turns.withColumns({"base": F.col("conv_id") - F.col("conv_id") % group, "h": (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")})
    head = F.coalesce("head", F.slice("turns", 1, 0))
    both = F.concat(F.slice(head, F.lit(1), F.col("h")), F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1))))
    return own.join(heads, "base", "left").select("conv_id", both.alias("turns"))


class Splitters:
    """Sorted splitter points and the prefixes that make up the skeleton."""

    def __init__(self, points: list[tuple[bytes, int]]) -> None:
        self.points = points
        self.skeleton = {b""} | {path[:end] for path, _ in points for end in range(_KEY, len(path) + 1, _KEY)}


def splitter_points(paths: DataFrame, shards: int, n: int, splitter_turns: int, per_shard: int = 16) -> list[tuple[bytes, int]]:
    """``shards - 1`` points of ``(path, conv_id)`` from a hash sample of at most about ``per_shard`` rows a shard."""
    share, longest = min(1.0, per_shard * shards / max(n, 1)), _KEY * splitter_turns
    drawn = paths.filter(F.pmod(F.xxhash64("conv_id"), F.lit(1 << 30)) < F.lit(math.ceil(share * (1 << 30))))
    rows = drawn.select(F.expr(f"substring(path, 1, {longest})").alias("path"), (F.length("path") > longest).alias("cut"), "conv_id").collect()
    points = sorted((bytes(r["path"]), -(1 << 63) if r["cut"] else r["conv_id"]) for r in rows)
    return sorted({points[len(points) * i // shards] for i in range(1, shards)}) if points else []


class _Node:
    __slots__ = ("chars", "n_convs", "least", "children", "leaves", "saved", "digest", "skeleton", "ids", "size", "piece", "waiting")

    def __init__(self, chars: int, skeleton: bool) -> None:
        self.chars, self.skeleton = chars, skeleton
        self.n_convs = self.children = self.leaves = self.saved = self.size = self.piece = 0
        self.least, self.digest, self.ids, self.waiting = None, None, [], []


def _common(a: bytes, b: bytes) -> int:
    """Keys at the start of both paths."""
    low, high = 0, min(len(a), len(b)) // _KEY
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[: _KEY * middle] == b[: _KEY * middle] else (low, middle - 1)
    return low


class ShardTrie:
    """Nodes of one sorted shard; finished rows gather in ``out``."""

    def __init__(self, shard: int, skeleton: set[bytes]) -> None:
        self.shard, self.skeleton, self.out = shard, skeleton, []
        self.path, self.open = b"", [_Node(0, True)]

    def add(self, path: bytes, chars: list[int], conv_id: int) -> None:
        shared = _common(self.path, path)
        while len(self.open) - 1 > shared:
            self._close()
        self.path = path
        for depth in range(shared + 1, len(path) // _KEY + 1):
            self.open.append(_Node(chars[depth - 1], self.open[-1].skeleton and path[: _KEY * depth] in self.skeleton))
        node = self.open[-1]
        node.n_convs += 1
        node.least = conv_id if node.least is None else min(node.least, conv_id)
        if node.skeleton:
            node.ids.append(str(conv_id))
            node.size += len(node.ids[-1]) + 1
            if node.size > _PIECE:
                self._put_ids(node, path)
        elif node.digest is None:
            node.digest = hashlib.sha256(b"%d" % conv_id)
        else:
            node.digest.update(b",%d" % conv_id)

    def end(self) -> None:
        while self.open:
            self._close()

    def _put_ids(self, node: _Node, key: bytes) -> None:
        if node.ids:
            self.out.append((_ENDS, key, None, None, None, None, None, None, None, ",".join(node.ids), None, self.shard, node.piece))
            node.ids, node.size, node.piece = [], 0, node.piece + 1

    def _close(self) -> None:
        node, depth = self.open.pop(), len(self.open)
        self.path = self.path[: _KEY * depth]
        parent = self.open[-1] if self.open else None
        if parent is not None:
            parent.n_convs += node.n_convs
            parent.least = node.least if parent.least is None else min(parent.least, node.least)
        if node.skeleton:
            self._put_ids(node, self.path)
            self.out.append((_PART, self.path, node.least, depth, None, node.n_convs, node.children, node.leaves, node.saved, None, node.chars, self.shard, None))
        else:
            leaves, saved = node.leaves or 1, node.saved + (node.n_convs - 1) * node.chars
            parent.children += 1
            parent.leaves += leaves
            parent.saved += saved
            digest = (node.digest or hashlib.sha256()).hexdigest()
            above = self.path[: _KEY * (depth - 1)]
            row = [_FINAL, None, node.least, depth, None, node.n_convs, node.children, leaves, saved, digest, None, self.shard, None]
            if parent.skeleton:
                row[:2] = _BELOW, above
                self.out.append(tuple(row))
            else:
                parent.waiting.append(row)  # until the parent's smallest member is known
            for child in node.waiting:
                child[4] = node.least
                self.out.append(tuple(child))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS)], names=[n for n, _ in _FIELDS])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's pieces, which arrive in order; only the running digest is held."""
    key, digest = None, None
    done: list[tuple[bytes, str]] = []
    for batch in batches:
        for k, text in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if digest is not None and k == key:
                digest.update(b"," + text.encode())
                continue
            if digest is not None:
                done.append((key, digest.hexdigest()))
            key, digest = k, hashlib.sha256(text.encode())
    if digest is not None:
        done.append((key, digest.hexdigest()))
    if done:
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([d for _, d in done])], names=["key", "ends_sha256"])


def prefix_trie(turns: DataFrame, shard_rows: int = 2_000, max_shards: int = 4_096, splitter_turns: int = 32) -> DataFrame:
    """One row per node of the trie of ``conv_id, turns`` rows: smallest member, depth, parent's smallest member, and the counts of the node and its subtree."""
    keys = F.array_join(F.transform("turns", lambda t: t["key"]), "")
    paths = staged(turns.select("conv_id", F.unhex(keys).alias("path"), F.transform("turns", lambda t: t["chars"]).alias("chars")), "paths")
    n = paths.count()
    shards = max(1, min(max_shards, math.ceil(n / shard_rows)))
    shared = turns.sparkSession.sparkContext.broadcast(Shared(splitter_points(paths, shards, n, splitter_turns), Splitters))

    @F.pandas_udf("int")
    def shard_of(path: pd.Series, conv_id: pd.Series) -> pd.Series:
        points = shared.value.made().points
        return pd.Series([bisect_right(points, (bytes(p), c)) for p, c in zip(path, conv_id.tolist())], dtype="int32")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        skeleton, trie = shared.value.made().skeleton, None
        for batch in batches:
            for shard, path, chars, conv_id in zip(*(batch.column(c).to_pylist() for c in ("shard", "path", "chars", "conv_id"))):
                if trie is None or trie.shard != shard:
                    if trie is not None:
                        trie.end()
                        yield _batch(trie.out)
                    trie = ShardTrie(shard, skeleton)
                trie.add(path, chars, conv_id)
                if len(trie.out) >= _ROWS:
                    yield _batch(trie.out)
                    trie.out = []
        if trie is not None:
            trie.end()
            yield _batch(trie.out)

    dealt = paths.withColumn("shard", shard_of("path", "conv_id")).repartition(shards, "shard").sortWithinPartitions("shard", "path", "conv_id")
    found = staged(dealt.mapInArrow(build, _DDL), "nodes")

    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    parts = found.filter(F.col("kind") == _PART).groupBy("key", "depth").agg(F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars"), *sums)
    above = F.expr(f"substring(key, 1, length(key) - {_KEY})")
    inner = parts.filter("depth > 0").groupBy(above.alias("key")).agg(F.count("*").alias("inner"))
    skeleton = staged(parts.join(inner, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("inner", F.lit(0))).drop("inner"), "skeleton")
    ancestor = F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("depth")), lambda d: F.expr("key").substr(F.lit(1), (d * _KEY).cast("int"))))
    own = skeleton.select(
        ancestor.alias("key"), (F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    )
    totals = own.groupBy("key").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    pieces = found.filter(F.col("kind") == _ENDS).select("key", "shard", "piece", "ends").repartition("key").sortWithinPartitions("key", "shard", "piece")
    ends = pieces.mapInArrow(_hashed, "key binary, ends_sha256 string")
    nodes = skeleton.drop("n_leaves", "saved_tokens").join(totals, "key").join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
    parents = skeleton.select("key", F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.withColumn("key", F.when(F.col("depth") > 0, above)).join(parents, "key", "left")
    final = found.withColumnRenamed("ends", "ends_sha256")
    below = final.filter(F.col("kind") == _BELOW).drop("parent_conv_id").join(parents, "key")
    return nodes.select(_NODE).unionByName(below.select(_NODE)).unionByName(final.filter(F.col("kind") == _FINAL).select(_NODE))
