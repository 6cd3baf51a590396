"""The prefix trie against a plain one, with hot copies, deep paths, splitters inside groups and odd rows."""

import hashlib
import math
import zlib
from collections import defaultdict

import numpy as np
import pytest

from larkspur.llm import prefix_trie as module
from larkspur.llm.prefix_trie import conversation_turns, prefix_trie, with_shared_heads

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth map<string,int>"


def rebuilt(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own[conv_id].append((turn is not None, turn or 0, digest, role, text))
    turns = {c: [(role, text) for *_, role, text in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = turns.get(c - int(math.fmod(c, 100)), [])[:h] + mine[h:]
    return out


def plain_trie(conversations):
    members, kids, enders = defaultdict(list), defaultdict(set), defaultdict(list)
    for c, turns in conversations.items():
        path = tuple(turns)
        enders[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                kids[path[: d - 1]].add(path[:d])
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[k] for k in kids[path]) or 1
        saved[path] = (len(members[path]) - 1) * (len(path[-1][1]) if path else 0) + sum(saved[k] for k in kids[path])
    return sorted(
        (min(ms), len(p), min(members[p[:-1]]) if p else None, len(ms), len(kids[p]), leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(enders[p]))).encode()).hexdigest())
        for p, ms in members.items()
    )


def table():
    draw = np.random.default_rng(2)
    rows = []
    for c in range(700):
        if c % 3 == 0:
            texts = ["hello", "hi", "how are you", "fine", "bye", "ok", "again"]  # a third are copies
        elif c % 3 == 1:
            texts = [str(x) for x in draw.integers(0, 3, draw.integers(1, 9))]
        else:
            texts = [f"{'deep '}{i}" for i in range(draw.integers(30, 60))] if c % 15 == 2 else [str(draw.integers(0, 50))]
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", x, "k", None) for t, x in enumerate(texts)]
    rows += [(205, 3, "user", "tie"), (205, 3, "user", "tie"), (205, 3, "assistant", "tie"), (205, None, None, None), (None, 1, "user", "lost"), (5_000, 0, "user", "no base 5_000")]
    rows += [(5_001, 0, "user", ""), (9_876, 0, "only", "one turn and no base"), (-7, 0, "user", "below"), (-7, 1, "user", "zero")]
    return [(*r, "k", None) if len(r) == 4 else r for r in rows]


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 20}, {"shard_rows": 1, "max_shards": 60}, {"shard_rows": 25, "splitter_turns": 2}])
def test_against_plain_trie(spark, sizes, monkeypatch):
    monkeypatch.setattr(module, "_PIECE", 40)
    rows = table()
    found = prefix_trie(with_shared_heads(conversation_turns(spark.createDataFrame(rows, SCHEMA))), **sizes)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(plain_trie(rebuilt(rows)), key=repr)


def test_copies_spread_over_shards(spark):
    turns = conversation_turns(spark.createDataFrame([(c, 0, "user", "same", "k", None) for c in range(2_000)], SCHEMA))
    paths = turns.selectExpr("conv_id", "unhex(turns[0].key) AS path")
    points = module.splitter_points(paths, 10, 2_000, 32)
    assert len(points) == 9 and len({c for _, c in points}) == 9
    (root, node) = sorted(prefix_trie(turns, shard_rows=100).collect(), key=lambda r: r["depth"])
    assert (root.n_children, root.n_leaves, root.saved_tokens) == (1, 1, 1999 * 4)
    assert node.ends_sha256 == hashlib.sha256(",".join(map(str, range(2_000))).encode()).hexdigest()


def test_empty_table(spark):
    assert prefix_trie(with_shared_heads(conversation_turns(spark.createDataFrame([], SCHEMA)))).count() == 0
