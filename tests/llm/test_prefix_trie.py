"""The trie against one built by plain loops, for blocks of several sizes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np

from wardstar.llm import prefix_trie, running
from wardstar.llm.words import BASE

SCHEMA = "conv_id long, turn long, role string, text string, start long, m string, q1 int, place int"


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0, digest), role, text))
    for found in own.values():
        found.sort(key=lambda t: t[0])
    members, ends = defaultdict(list), defaultdict(list)
    for conv, mine in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        family = conv - int(np.fmod(conv, 100))
        whole = tuple(t[1:] for t in own.get(family, [])[:h] + mine[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(conv)
        ends[whole].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out, leaves, saved = [], {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[c] for c in below) if below else 1
        own_saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own_saved + sum(saved[c] for c in below)
        listed = ",".join(map(str, sorted(ends[node])))
        out.append(
            (min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]),
             len(below), leaves[node], saved[node], hashlib.sha256(listed.encode()).hexdigest())
        )
    return sorted(out, key=lambda r: r[:2])


def conversations():
    rng = random.Random(6)
    rows = []
    trunk = [("user" if k % 2 else "system", f"turn {k} é") for k in range(30)]
    for conv in [*range(-5, 60), *range(100, 220), 301, 1000, 1001]:
        copied = rng.choice([0, 2, 4, 5, 8, 9, 13, 30])
        mine = trunk[:copied] + [("user", f"own {rng.randint(0, 2)}") for _ in range(rng.randint(0, 5))]
        for k, (role, text) in enumerate(mine):
            rows.append((conv, k if rng.random() < 0.9 else 5, role, text, 1, "m", 2, 3))
    rows += [(400 + k, 0, "user", "the same", 1, "m", 2, 3) for k in range(150)]
    rows += [(7, None, None, None, 1, "m", 2, 3), (8, None, "user", None, 1, "m", 2, 3), (None, 1, "user", "x", 1, "m", 2, 3)]
    rows += [(9, 2, "user", "tie", 1, "m", 2, 3)] * 3 + [(9, 2, "user", "t" * 100_000, 1, "m", 2, 3)]
    rows += [(2000, k, "user", f"long {k}", 1, "m", 2, 3) for k in range(700)]
    return rows


def test_against_plain_loops(spark):
    rows = conversations()
    expected = brute(rows)
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = sorted((tuple(r) for r in prefix_trie.trie(table).collect()), key=lambda r: r[:2])
    assert got == expected


def test_blocks_of_any_size_give_the_same_segments(spark):
    rows, _ = prefix_trie.rebuilt(spark.createDataFrame(conversations(), SCHEMA))
    steps = prefix_trie.prefixes(rows)
    nodes = []
    for block in (1, 3, 4, 64):
        found = prefix_trie.segments(steps, block)
        turns = found.selectExpr("n", "m", "start", "posexplode(steps) as (k, s)")
        nodes.append(sorted(turns.selectExpr("start + k", "m", "n", "s.p1", "s.p2").collect()))
    assert nodes[0] == nodes[1] == nodes[2] == nodes[3]


def test_turnless_and_empty(spark):
    alone = spark.createDataFrame([(101, 0, "user", "x", 1, "m", 2, 3)], SCHEMA)
    got = [tuple(r) for r in prefix_trie.trie(alone).collect()]
    assert got == brute([(101, 0, "user", "x")])
    assert not prefix_trie.trie(spark.createDataFrame([], SCHEMA)).collect()


def test_running_sums_over_many_partitions(spark):
    rng = random.Random(1)
    rows = [(g, k, rng.randrange(-(2**63), 2**63)) for g, n in ((1, 5), (2, 3000), (3, 1), (9, 40)) for k in range(n)]
    table = spark.createDataFrame(rows, "g long, k long, v long").repartition(5)
    found = running.running(table, "g", [running.F.col("k")], ["v"], BASE)
    got = {(r.g, r.k): (r.place, r.v_before % 2**64, r.v_sum % 2**64) for r in found.collect()}
    sums = defaultdict(int)
    for g, k, v in sorted(rows):
        before = sums[g]
        sums[g] = (before + v * pow(BASE, k, 2**64)) % 2**64
        assert got[g, k] == (k, before, sums[g])
