"""Ranked search against a plain scoring of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from terrace.llm import ranking

DOCS = "doc_id long, text string, item_id long, score long, rank int, path string, m long, head string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(docs, items, top=50):
    vectors = [(i, Counter(plain_terms(t))) for i, t in docs]
    n_docs = sum(1 for _, v in vectors if v)
    length = sum(sum(v.values()) for _, v in vectors)
    df = Counter(t for _, v in vectors for t in v)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(plain_terms(t))
    out = []
    for item, terms in wanted.items():
        scored = []
        for i, v in vectors:
            m = 100 - 50 + (50 * sum(v.values()) * n_docs) // max(1, length)
            s = 0
            for t in terms & set(v):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                s += w * ((1000000000 * v[t]) // (1000 * v[t] + 20 * m))
            if s > 0:
                scored.append((-s, i is None, i or 0))
        for rank, (s, none, i) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, None if none else i, -s))
    return sorted(out, key=str)


def tables(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, 1, 2, 3, "p", 4, "h") for i, t in docs], DOCS),
        spark.createDataFrame([(i, t, 9, "x") for i, t in items], "item_id long, text string, doc_id long, term string"),
    )


def corpus(seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(200)] + ["É", "é", "日本", "A1"]
    weights = [1 / (i + 1) for i in range(len(words))]
    draw = lambda n: rng.choices(words, weights, k=n)
    docs = [(i, " ".join(draw(rng.randrange(0, 80)))) for i in range(300)]
    docs += [(1000 + i, docs[5][1].upper()) for i in range(150)]  # one large group of equal scores
    docs += [(2000, None), (2001, ""), (2002, " .,-_ "), (None, docs[7][1]), (None, docs[7][1]), (3, docs[3][1]), (3, "w1 w2 w150")]
    docs += [(3000, " ".join(draw(60_000)))]
    items = [(i, ", ".join(draw(rng.randrange(1, 40)))) for i in range(25)]
    items += [(100, None), (101, "!?"), (102, "not in any document"), (None, "w3 w4"), (0, "w180 W180"), (0, "w181"), (1, items[1][1])]
    return docs, items


@pytest.mark.parametrize(("top", "at_once", "cells"), [(50, ranking.TERMS, ranking.CELLS), (3, 60, 1)])
def test_best_documents(spark, top, at_once, cells):
    docs, items = corpus()
    got = ranking.best_documents(*tables(spark, docs, items), top, at_once, cells).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(docs, items, top)
    assert {r.item_id for r in got if r.item_id is None} == {None}


def test_empty_tables(spark):
    docs, items = corpus()
    for d, i in (([], items), (docs, []), ([], []), ([(1, None)], items)):
        assert ranking.best_documents(*tables(spark, d, i)).count() == 0


def test_trie_and_bounds():
    rng = np.random.default_rng(4)
    paths = sorted((sorted(rng.choice(30, rng.integers(1, 12), replace=False)) for _ in range(400)), key=list)
    paths = [np.array(p) for p in paths + paths[-1:] * 100]
    nodes = ranking.trie(paths, 8)
    for a, b, children in nodes:
        if children:
            assert [nodes[c][0] for c in children] == [a, *[nodes[c][1] for c in children]][:-1]
            assert nodes[children[-1]][1] == b
        else:
            assert b - a <= 8
    # A subtree with children shares a prefix that no neighbour shares.
    for a, b, children in nodes[1:]:
        if children:
            inside = min(ranking.common_prefix(paths[i], paths[i + 1]) for i in range(a, b - 1))
            for i in (a, b):
                if 0 < i < len(paths):
                    assert ranking.common_prefix(paths[i - 1], paths[i]) <= inside
    tree = ranking.Tree(list(range(500)), rng.integers(50, 300, 500), paths, [rng.integers(1, 9, len(p)) for p in paths], 8)
    weights = np.arange(30, 0, -1) * 100
    query = ranking.grouped([np.array([2, 5, 28])], weights)[0]
    best = [ranking.Best(5)]
    scored = tree.search(query, best)
    every = ranking.Best(5)
    table = np.zeros((500, 30), dtype=np.int64)
    for i, p in enumerate(paths):
        table[i, p] = tree.tf[tree.row == i]
    every.add((ranking.share(table[:, [2, 5, 28]], tree.m[:, None]) * weights[[2, 5, 28]]).sum(1), tree.ids)
    assert best[0].kept == every.kept and scored < 400
