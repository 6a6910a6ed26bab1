"""Stages of the corpus pipeline on rows whose doc_id is null or repeated, and near copies
against brute force."""

import os
import random
from pathlib import Path

import numpy as np

import corpus_pipeline
from terrace.llm import similar, toxicity
from terrace.llm.common import table

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LARGER = str(Path(SF_DIR).parent / "sf0.01")  # the smallest with texts found toxic


def kept(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def plain_shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}


def plain_groups(texts):
    sets, root = [plain_shingles(t) for t in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]) - 1e-9 and root[i] != root[j]:
                old, new = root[i], root[j]
                root = [new if x == old else x for x in root]
    out = {}
    for i, x in enumerate(root):
        out.setdefault(x, set()).add(i)
    return sorted(map(sorted, out.values()))


def texts_with_copies(rng):
    word = lambda: f"w{rng.randrange(400)}"
    texts = [None, "", " \n", "One two", "one  TWO", "a b c d e"]
    for _ in range(50):
        base = [word() for _ in range(rng.randrange(30, 300))]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(4)):
            other = list(base)
            for _ in range(rng.randrange(1, 2 + len(base) // 30)):
                other[rng.randrange(len(other))] = word()
            texts.append(" ".join(other))
    base = [word() for _ in range(200)]
    for i in range(60):  # one large group
        texts.append(" ".join(base[:i] + ["x"] + base[i + 1 :]))
    return [*texts, texts[8], texts[8]]


def check_groups(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    nodes = {r.doc_id: r.node for r in docs.select("doc_id", similar.node_of("text").alias("node")).collect()}
    roots = {r.node: r.root for r in similar.groups(docs).collect()}
    got = {}
    for i, node in nodes.items():
        got.setdefault(roots.get(node, node), set()).add(i)
    assert sorted(map(sorted, got.values())) == plain_groups(texts)
    left = corpus_pipeline.one_of_each_group(spark, docs, SF_DIR)
    assert sorted(r.doc_id for r in left.collect()) == sorted(g[0] for g in plain_groups(texts))


def test_near_copies_by_brute_force(spark):
    check_groups(spark, texts_with_copies(random.Random(5)))


def test_other_near_copies_by_brute_force(spark):
    check_groups(spark, texts_with_copies(random.Random(6)))


def test_pairs_of_loosely_similar_texts_stay_in_proportion(spark, monkeypatch):
    """Copies of one text with noise of all degrees: most pairs are not similar enough."""
    rng, verified = random.Random(7), []
    base = [f"w{rng.randrange(400)}" for _ in range(150)]
    texts = []
    for i in range(400):
        other = list(base)
        for _ in range(i // 40):
            other[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(other))
    counted = similar._verified
    monkeypatch.setattr(similar, "_verified", lambda pairs, sets: verified.append(pairs.count()) or counted(pairs, sets))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    roots = {r.node: r.root for r in similar.groups(docs).collect()}
    nodes = {r.doc_id: r.node for r in docs.select("doc_id", similar.node_of("text").alias("node")).collect()}
    size = {}
    for node in nodes.values():
        size[roots.get(node, node)] = size.get(roots.get(node, node), 0) + 1
    linked = {i for g in plain_groups(texts) if len(g) > 1 for i in g}
    found = {i for i, node in nodes.items() if size[roots.get(node, node)] > 1}
    assert found <= linked and len(found) >= 0.95 * len(linked)
    assert sum(verified) < 400 * similar.BANDS * 3


def test_crowded_bands_lose_no_link(spark, monkeypatch):
    """In each of some crowds of loosely similar texts two are linked, which have no noise in common."""
    monkeypatch.setattr(similar, "NEXT", 1)
    monkeypatch.setattr(similar, "BANDS", 4)
    rng, texts, want = random.Random(11), [], []
    for _ in range(3):
        base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
        first = len(texts)
        for i in range(200):
            other = list(base)
            for k in range(max(2 - i, 0) or 5):
                other[25 * k + 10 + rng.randrange(10)] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(other))
        want += [[first + i for i in g] for g in plain_groups(texts[first:])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    roots = {r.node: r.root for r in similar.groups(docs).collect()}
    got = {}
    for r in docs.select("doc_id", similar.node_of("text").alias("node")).collect():
        got.setdefault(roots.get(r.node, r.node), []).append(r.doc_id)
    assert sorted(map(sorted, got.values())) == want and sum(len(g) > 1 for g in want) >= 3


def test_marks_differ_in_no_more_bits_than_sets_in_shingles():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    for n in (0, 1, 4, 40, 400, 3000):
        other = list(words[:n])
        for _ in range(n // 20):
            other[rng.randrange(n)] = "x"
        a, b = (similar.shingles(" ".join(t).encode()) for t in (words[:n], other))
        bits = int(np.bitwise_count((similar.marks(a) ^ similar.marks(b)).view(np.uint64)).sum())
        assert bits <= len(np.setxor1d(a, b)) and (bits > 0) == (len(np.setxor1d(a, b)) > 0)


def test_dedup_by_text_not_by_id(spark):
    a = " ".join(f"a{i}" for i in range(40))
    near, b, c = a + " end", "another text of its own words", "a third text of its own words"
    rows = [(1, a), (5, near), (5, b), (None, c), (None, c), (None, c.upper()), (None, "lone"), (None, a), (7, b), (8, "z"), (8, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = kept(corpus_pipeline.one_of_each_group(spark, docs, SF_DIR))
    assert len(got) == 5
    assert {(1, a), (5, b), (None, "lone"), (8, "z")} < set(got)
    assert len({(None, c), (None, c.upper())} & set(got)) == 1


def test_rejection_takes_only_the_rejected_row(spark):
    documents, labels = table(spark, LARGER, "documents"), table(spark, LARGER, "labels")
    toxic = {r.doc_id for r in toxicity.score(documents, labels).filter("predicted = 1").collect()}
    bad = documents.filter(documents.doc_id == min(toxic)).collect()[0].text
    item = max(table(spark, LARGER, "benchmark").collect(), key=lambda r: len(r.text or "")).text
    more = [(i, t) for i in (None, 10**9) for t in (bad, item, "clean words", None)]
    extra = spark.createDataFrame(more, "doc_id long, text string")
    docs = documents.select("doc_id", "text").unionByName(extra)
    mine = lambda df: kept(df.filter("doc_id IS NULL OR doc_id = 1000000000"))
    want = lambda gone: sorted(((i, t) for i, t in more if t != gone), key=str)
    assert mine(corpus_pipeline.without_toxic(spark, docs, LARGER)) == want(bad)
    assert mine(corpus_pipeline.without_benchmark(spark, docs, LARGER)) == want(item)


CLASHING = (
    "doc_id long, text string, lang string, source string, n_chars long, _node long, _row long, _key string, _nth int, _md5 string, "
    "_use int, shard string, _shard int, SLOT string, doc string, node string, key long, root long, n int, r string, d string, "
    "meta map<string, int>, `a.b` string"
)


def test_stages_keep_columns_of_any_name(spark):
    def row(i, text):
        return (i, text, "en", "s", 3, 1, 2, "k", 4, "m", 5, "sh", 6, "sl", "d", "no", 7, 8, 9, "r", "dd", {"x": i or 0}, "ab")

    rows = [row(1, "some words of a first text"), row(2, "and others of a second one"), row(None, None), row(3, "some words of a first text")]
    docs = spark.createDataFrame(rows, CLASHING)
    want = sorted(map(str, rows))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        assert out.columns[: len(docs.columns)] == docs.columns, name
        got = sorted({str(tuple(r)[: len(docs.columns)]) for r in out.collect()})
        assert got == (sorted(map(str, rows[:3])) if name == "simhash_dedup" else want), name
        assert out.columns[len(docs.columns) :] == (["__shard", "_slot"] if name == "sharding" else [])
