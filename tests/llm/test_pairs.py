"""Operators on groups of similar rows, against brute force on small tables."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash

from terrace.llm import embed, sharding, simhash, suffix
from terrace.llm.common import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard string, fp string, rank int"


def docs_of(spark, texts, sources=None):
    """Documents with some columns whose names operators use themselves."""
    rows = [
        (i, t, "en", (sources or {}).get(i, "a"), len(t or ""), "x", "y", 3) for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCS)


def roots(n, linked):
    at = list(range(n))

    def find(i):
        while at[i] != i:
            at[i] = at[at[i]]
            i = at[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((find(i), find(j)))
                at[b] = a
    return [find(i) for i in range(n)]


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def texts_with_copies(seed=3, n=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    texts = [None, "", " \t\n", "One", "one", "a b c", "É é Z"]
    for _ in range(n):
        base = [rng.choice(words) for _ in range(rng.randrange(3, 200))]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(3)):
            changed = list(base)
            changed[rng.randrange(len(changed))] = rng.choice(words)
            texts.append(" ".join(changed))
    return [*texts, texts[8], texts[8], "x " * 50_000]


@pytest.mark.parametrize("hot_run", [simhash.HOT_RUN, 2])
def test_simhash_components(spark, hot_run):
    texts = texts_with_copies()
    fps = [plain_fingerprint(t) for t in texts]
    want = roots(len(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 4)
    got = simhash.near_duplicates(docs_of(spark, texts), hot_run).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {
        i: (f"{fps[i]:016x}", want[i]) for i in range(len(fps))
    }
    assert any(w != i and fps[i] != fps[w] for i, w in enumerate(want))


def test_simhash_table_keys_bring_all_near_pairs_together():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    for _ in range(50):
        x = base[rng.integers(200)]
        y = x
        for b in rng.choice(64, 4, replace=False):
            y ^= np.uint64(1 << int(b))
        assert any(
            all((x ^ y) & simhash.masks()[s] == 0 for s in t) for t in simhash.TABLES
        )
        assert (np.abs(simhash.distances(np.array([x])) - simhash.distances(np.array([y]))) <= 4).all()


def test_simhash_dense_ball_same_with_midpoints(spark):
    rng = np.random.default_rng(5)
    fps = {0}
    while len(fps) < 150:
        x = 0
        for b in rng.choice(64, rng.integers(1, 7), replace=False):
            x |= 1 << int(b)
        fps.add(x)
    fps = sorted(fps)
    want = roots(len(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 4)
    frame = spark.createDataFrame([(int(np.array(x, np.uint64).view(np.int64)),) for x in fps], "fp long")
    for hot_run in (4, 10_000):
        links = simhash.fingerprint_links(frame, hot_run)
        found = {r.node: r.root for r in components(links, "t").collect()}
        place = {int(np.array(x, np.uint64).view(np.int64)): i for i, x in enumerate(fps)}
        label = {i: place[found.get(f, f)] for f, i in place.items()}
        groups = lambda m: {frozenset(k for k in m if m[k] == v) for v in m.values()}
        assert groups(label) == groups(dict(enumerate(want)))


def test_null_and_repeated_ids(spark):
    rows = spark.createDataFrame([(None, "a b c d"), (None, "q r s t"), (5, "a b c d"), (5, "a b c d")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in simhash.near_duplicates(rows).collect())
    assert got == [(-1, -1), (-1, 5), (5, 5), (5, 5)]


def test_empty_tables(spark):
    none = docs_of(spark, [])
    assert simhash.near_duplicates(none).count() == 0
    assert sharding.assign(none).count() == 0
    assert suffix.without_repeats(none).count() == 0
    assert embed.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def vectors(seed=2, n=120, dims=16):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        v = rng.standard_normal(dims)
        rows.append(v)
        for _ in range(rng.integers(0, 4)):
            rows.append(v + rng.standard_normal(dims) * 0.12)
    rows = [r.astype(np.float32) for r in rows]
    return [*rows, rows[0], rows[0], rows[1] * 2]


def test_embedding_links(spark):
    vs = vectors()
    bad = [None, [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [], [1.0, 2.0]]
    data = [(i, [float(x) for x in v], 7) for i, v in enumerate(vs)] + [(1000 + i, b, 7) for i, b in enumerate(bad)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")
    u = np.array(vs, dtype=np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    for block in (embed.BLOCK, 3):
        got = {r.vec_id: r for r in embed.near_vectors(frame, block=block).collect()}
        assert len(got) == len(data)
        links = np.array([got[i].n_links for i in range(len(vs))])
        assert (links <= near.sum(1)).all()
        assert links.sum() >= 0.95 * near.sum() > 100
        want = roots(len(vs), lambda i, j: near[i, j])
        assert np.mean([got[i].component_id == w for i, w in enumerate(want)]) > 0.95
        assert all(got[i].kept == (got[i].component_id == i) for i in range(len(vs)))
        for i in range(len(bad)):
            assert (got[1000 + i].n_links, got[1000 + i].component_id, got[1000 + i].kept) == (0, 1000 + i, True)


def test_embedding_recall_near_the_line(spark):
    """Pairs planted at cosines from 0.9 up: at least 0.95 of them are found, and none below."""
    rng = np.random.default_rng(9)
    rows, want = [], []
    for i in range(1500):
        a, b = rng.standard_normal((2, 64))
        a /= np.linalg.norm(a)
        b -= a * (a @ b)
        b /= np.linalg.norm(b)
        c = rng.uniform(0.9005, 0.92) if i % 3 else rng.uniform(0.88, 0.8995)
        rows += [(2 * i, a.tolist()), (2 * i + 1, (3 * (c * a + np.sqrt(1 - c * c) * b)).tolist())]
        want.append(i % 3 != 0)
    got = {r.vec_id: r for r in embed.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    found = np.array([got[2 * i + 1].component_id == 2 * i for i in range(1500)])
    assert not found[~np.array(want)].any() and found[np.array(want)].mean() >= 0.95


def test_shards_hold_the_mixture(spark):
    sources = {i: ("big" if i % 3 == 0 else None if i % 7 == 0 else f"s{i % 5}") for i in range(500)}
    texts = ["t" * (i % 11) if i % 13 else None for i in range(500)]
    docs = docs_of(spark, texts, sources)
    rows = sharding.assign(docs).collect()
    assert len(rows) == 500
    counts = {}
    for r in rows:
        t = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(t) + 1, zlib.crc32(t), "rows", None)
        counts.setdefault(r.shard, []).append(r)
    assert sorted(counts) == list(range(16))
    assert {len(v) for v in counts.values()} <= {31, 32}
    for members in counts.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
        big = sum(sources[r.doc_id] == "big" for r in members)
        assert abs(big - len(members) * 167 / 500) <= 1 + 7 * 167 / 500  # seven sources
    again = {(r.doc_id, r.shard, r.slot) for r in sharding.assign(docs.repartition(3)).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in rows}


def test_shard_keeps_columns_and_repeated_rows(spark):
    docs = docs_of(spark, ["a", "b"]).unionByName(docs_of(spark, ["a", None]))
    out = sharding.shard(docs, 2)
    assert out.columns == [*docs.columns, "_shard", "slot"]
    assert sorted((r._shard, r.slot) for r in out.collect()) == [(0, 0), (0, 1), (1, 0), (1, 1)]
    assert sharding.assign(docs_of(spark, ["only"])).collect()[0].shard == 0


def plain_removed(texts, span=200):
    seen = {}
    for b in texts:
        for i in range(len(b) - span + 1):
            seen[b[i : i + span]] = seen.get(b[i : i + span], 0) + 1
    out = []
    for b in texts:
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - span + 1):
            if seen[b[i : i + span]] > 1:
                gone[i : i + span] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot_run", [suffix.HOT_RUN, 3])
def test_repeated_bytes(spark, hot_run):
    rng = random.Random(4)
    noise = lambda n: "".join(rng.choice("abcdefé ") for _ in range(n))
    passages = [noise(rng.randrange(150, 420)) for _ in range(6)]
    texts = [None, "", "short", noise(199), "a" * 3000, "ab" * 800, noise(250) * 3]
    for _ in range(70):
        parts = [noise(rng.randrange(0, 400))]
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(passages)
            if rng.random() < 0.4:
                k = rng.randrange(len(p))
                p = p[:k] + "#" + p[k + 1 :]
            parts += [p, noise(rng.randrange(0, 60))]
        texts.append("".join(parts))
    texts += [texts[10], texts[10], "\x00" * 600, "z" * 450]
    want = plain_removed([(t or "").encode() for t in texts])
    got = suffix.without_repeats(docs_of(spark, texts), hot_run).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == dict(enumerate(want))


def test_repeated_bytes_over_chunks(monkeypatch):
    rng = random.Random(9)
    text = bytes(rng.randrange(97, 101) for _ in range(3000))
    whole = suffix.anchors(text)
    monkeypatch.setattr(suffix, "CHUNK", 256)
    parts = suffix.anchors(text)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_deep_shallow_order_and_blind_trie():
    rng = np.random.default_rng(3)
    rows = rng.integers(0, 2, (300, 200), dtype=np.uint8)
    rows[:150, :120] = 0
    rows[50:60] = rows[50]
    group = rng.integers(0, 3, 300)
    order, common = suffix.deep_shallow(rows, group)
    keys = [(int(group[i]), rows[i].tobytes()) for i in order]
    assert keys == sorted(keys)
    for i in range(1, 300):
        a, b = rows[order[i - 1]], rows[order[i]]
        differs = np.flatnonzero(a != b)
        assert common[i] == (differs[0] if len(differs) else 200)
    strings = [bytes(r[:80]) for r in rows]
    assert [strings[i] for i in suffix.blind_trie_order(strings, 0)] == sorted(strings)


def test_same_id_different_texts(spark):
    p = "0123456789" * 30
    docs = spark.createDataFrame([(1, p), (1, "x" + p[:200]), (None, "q")], "doc_id long, text string")
    got = sorted((r.n_bytes, r.n_removed) for r in suffix.without_repeats(docs).collect())
    assert got == [(1, 0), (201, 200), (300, 300)]


def test_many_rows_repeat_one_id_and_text(spark):
    rng = random.Random(12)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    long, part = noise(4000), noise(300)
    rows = [(None, long)] * 1500 + [(7, noise(500) + part)] * 700 + [(8, part + noise(900)), (9, long[100:700]), (9, long[100:700]), (10, "short"), (10, "short")]
    rows += [(11, noise(450)), (None, noise(450))]
    got = suffix.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()
    want = plain_removed([t.encode() for _, t in rows])
    assert sorted(tuple(r)[1:] for r in got) == sorted(want)
    assert {r.doc_id: r.n_removed for r in got}[8] == 300
