"""The prefix trie against a plain trie, with low bands so that totals cross them."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from feedlens.llm import prefix_trie

SCHEMA = "conv long, turn long, role string, text string, depth string, k1 string, rep string"


def sequences(rows):
    """Turns of every conversation in order, rebuilt to share beginnings."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        rest = abs(c) % 5 * (1 if c >= 0 else -1)
        out[c] = own.get(c - rest, [])[:h] + own[c][h:]
    return own, out


def plain(seqs):
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    kids = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, m in members.items():
        own = (len(m) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += own
            leaves[node[:d]] += node not in kids
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(seqs[c]) == len(node)))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), kids[node] if node in kids else 0,
                    leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, height):
    table = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    turns = prefix_trie.positions(table)
    convs = turns.select("conv").distinct()
    got = prefix_trie.trie(prefix_trie.branched(turns), convs, height=height)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                           "ends_sha256"]
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.mark.parametrize("height", [2, 5])
def test_trie(spark, height):
    rows = []
    for c in range(40):                         # shared beginnings, copies, and two long conversations
        n = 21 if c in (3, 30) else c % 7
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of {c // 10 if t > 2 else 0} \u00e9") for t in range(n)]
    rows += [(50, 1, "user", "b"), (50, None, None, None), (50, 1, "user", "a"), (50, 1, "user", "a"), (51, None, "", ""),
             (None, 1, "user", "nobody"), (-7, 2, "user", "x"), (-3, 1, "user", "turn 0 of 0 \u00e9")]
    rows += [(60, t * 3000, "user", "") for t in range(12)]       # turn numbers in many blocks
    own, seqs = sequences(rows)
    assert run(spark, rows, height) == plain(seqs)


def test_positions_and_rebuilding(spark):
    rows = [(5, 2, "b", "2"), (5, None, "a", "n"), (5, 1, "a", "1"), (6, 1, "u", "own"), (6, 1, "u", "own")]
    table = spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA)
    turns = prefix_trie.positions(table).collect()
    assert sorted((r.conv, r.pos, r.text) for r in turns) == [(5, 0, "n"), (5, 1, "1"), (5, 2, "2"), (6, 0, "own"), (6, 1, "own")]


def test_empty_tables(spark):
    assert run(spark, [], 4) == []
    turnless = spark.createDataFrame([(9,), (4,)], "conv long")
    none = spark.createDataFrame([], "conv long, pos long, role string, text string")
    got = prefix_trie.trie(none, turnless).collect()
    assert [tuple(r) for r in got] == [(4, 0, None, 2, 0, 1, 0, hashlib.sha256(b"4,9").hexdigest())]


def test_many_ends_of_one_node_in_chunks(spark):
    ids = [*range(0, 30000, 3)]
    convs = spark.createDataFrame([(i,) for i in ids], "conv long")
    turns = convs.selectExpr("conv", "0L AS pos", "'u' AS role", "'hello' AS text")
    got = {r.depth: r for r in prefix_trie.trie(turns, convs).collect()}
    assert got[1].ends_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert got[1].saved_tokens == got[0].saved_tokens == (len(ids) - 1) * 5 and got[0].n_leaves == 1
