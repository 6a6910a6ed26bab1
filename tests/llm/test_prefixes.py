"""The prefix trie of conversations, against a plain one."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from terrace.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string, path string, depth long, node string, kind int"


def plain(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append((turn is not None, turn or 0, key, (role, text)))
    own = {c: [x[3] for x in sorted(t)] for c, t in own.items()}
    nodes = {}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    kids = {}
    for n in nodes:
        if n:
            kids.setdefault(n[:-1], []).append(n)
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for n, members in nodes.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += n not in kids
            saved[n[:d]] += (len(members) - 1) * len(n[-1][1].encode()) if n else 0
    return sorted(
        (
            min(m), len(n), min(nodes[n[:-1]]) if n else None, len(m), len(kids.get(n, ())), leaves[n], saved[n],
            hashlib.sha256(",".join(str(c) for c in sorted(m) if whole[c] == n).encode()).hexdigest(),
        )
        for n, m in nodes.items()
    )


def check(spark, rows, **more):
    frame = spark.createDataFrame([(*r, "p", 1, "n", 2) for r in rows], SCHEMA)
    got = [tuple(r) for r in prefixes.prefix_nodes(frame, **more).collect()]
    assert sorted(got, key=lambda r: (r[0], r[1])) == plain(rows)
    return got


def conversations(seed, n, copies):
    rng = random.Random(seed)
    say = [f"words {i} é" for i in range(4)]
    rows = []
    for c in range(n):
        turns = [(rng.choice(["user", "assistant"]), rng.choice(say)) for _ in range(rng.randrange(1, 9))]
        if rng.random() < 0.5:
            turns[0] = ("system", "the first turn of very many")
        rows += [(c, i, *t) for i, t in enumerate(turns)]
    for c in range(5 * n, 5 * n + 5 * copies, 5):  # their own heads, so whole copies
        rows += [(c, i, "user", f"copy {i}") for i in range(3)]
    return rows


@pytest.mark.parametrize("shard", [prefixes.SHARD, 20])
def test_nodes(spark, shard):
    got = check(spark, conversations(1, 120, 60), shard=shard)
    assert max(r[3] for r in got if r[1] == 3) >= 60


def test_many_shards_and_levels(spark):
    check(spark, conversations(2, 1500, 900), shard=5)


def test_nulls_ties_and_repeated_turns(spark):
    rows = [
        (0, None, None, None), (0, None, "user", "b"), (0, 1, "user", ""), (0, 1, "", "user"), (0, 1, "", "user"), (0, -5, None, "x"),
        (1, 1, "user", "own"), (2, None, None, None), (7, 3, "user", "no first of the block"), (9, 1, "a", "é" * 1000),
        (None, 1, "user", "of no conversation"), (-3, 1, "user", "negative"), (-5, 1, "u", "v"),
    ]
    rows += [(3, i, "user", f"turn {i}") for i in range(120)] + [(4, i, "user", f"turn {i}") for i in range(115)]
    frame = spark.createDataFrame([(*r, "p", 1, "n", 2) for r in rows if r[0] is None or r[0] >= 0], SCHEMA)
    got = sorted((tuple(r) for r in prefixes.prefix_nodes(frame).collect()), key=lambda r: (r[0], r[1]))
    assert got == plain([r for r in rows if r[0] is not None and r[0] >= 0])


def test_empty_table(spark):
    assert prefixes.prefix_nodes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_findclose_over_blocks():
    rng = random.Random(5)
    depth = [0]
    for _ in range(3000):
        depth.append(rng.randrange(max(1, depth[-1] - 40), depth[-1] + 2) if rng.random() < 0.3 else depth[-1] + 1)
    depth = np.array(depth)
    tree = prefixes.Parentheses(depth, 16)
    close = tree.findclose(tree.open)
    stack, want = [], {}
    step = np.diff(np.concatenate([[0], tree.excess]))
    for at, s in enumerate(step):
        if s > 0:
            stack.append(at)
        else:
            want[stack.pop()] = at
    assert [want[p] for p in tree.open.tolist()] == close.tolist() and not stack
