import hashlib
import math
import zlib

import pytest

from odometrix.llm import prefix_trie
from odometrix.llm.prefix_trie import Skeleton, conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string, shard int, key string, path string, depth long"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", "p", 9) for r in rows], SCHEMA).repartition(5)


def order(row):
    c, turn, role, text = row
    role, text = role or "", text or ""
    digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
    return turn is not None, turn or 0, role, digest


def expected(rows):
    own = {}
    for row in sorted((r for r in rows if r[0] is not None), key=order):
        own.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    paths = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + seq[h:])
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        kids = children.get(node, [])
        leaves = sum(sums[k][0] for k in kids) or 1
        own_saved = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        sums[node] = (leaves, own_saved + sum(sums[k][1] for k in kids))
    out = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if paths[c] == node)
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(ids), len(node), parent, len(ids), len(children.get(node, [])), *sums[node], digest))
    return sorted(out, key=str)


def rows_of():
    rows = [
        (0, 0, "user", "hello"), (0, 1, "bot", "hi"), (0, 2, "user", "Ünïcode 🙂"), (0, 3, None, None),
        (1, 0, "user", "hello"), (2, None, "user", "first"), (2, 0, "user", "second"), (2, 0, "user", "second"),
        (2, 0, "bot", "tie"), (3, 5, "user", ""), (3, 7, "", "user"), (None, 0, "user", "lost"), (105, 0, "x", "y"),
        (207, 0, "user", "a" * 50_000), (207, 1, "user", "b"), (-3, 0, "user", "below zero"),
    ]
    rows += [(300 + i, t, "user", f"turn {t} of many") for i in range(120) for t in range(3)]
    rows += [(500 + i, t, "user", "shared" if t == 0 else f"own {i % 7} {t}") for i in range(150) for t in range(1 + i % 5)]
    rows += [(900, t, "user", f"chain {t}") for t in range(200)]
    rows += [(901, t, "user", f"chain {t}") for t in range(150)]
    return rows


@pytest.mark.parametrize("shards, depth, block", [(1, 64, 100), (8, 64, 4), (40, 2, 1 << 15)])
def test_matches_brute_force(spark, monkeypatch, shards, depth, block):
    monkeypatch.setattr(prefix_trie, "SPLITTER_DEPTH", depth)
    monkeypatch.setattr(prefix_trie, "BLOCK_IDS", block)
    rows = rows_of()
    got = [tuple(r) for r in conversation_trie(table(spark, rows), shards=shards).collect()]
    assert sorted(got, key=str) == expected(rows)


def test_empty_table(spark):
    assert conversation_trie(table(spark, rows_of()).limit(0)).count() == 0


def test_nodes_off_the_skeleton_lie_in_one_shard():
    paths = [[bytes([a]), bytes([b]), bytes([c])] for a in range(4) for b in range(4) for c in range(4)]
    bones = Skeleton([tuple(paths[i][: 1 + i % 3]) for i in range(5, 64, 9)])
    held = set()
    for path in bones.splitters:
        held.update(path[:d] for d in range(len(path) + 1))
    shards = {}
    for path in paths:
        for d in range(4):
            shards.setdefault(tuple(path[:d]), set()).add(bones.shard(path))
    assert all(len(s) == 1 for node, s in shards.items() if node not in held and node)
    assert len(bones.parent) == len(held | {()})
