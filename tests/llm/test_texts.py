"""Operators on single texts: SQL, brute force, round trips and held-out accuracy."""

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest
from compare import difference, duck
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from terrace.llm import decontam, langid, mixing, secrets, toxicity, warc
from terrace.llm.queries import ORACLE, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None


def test_registered():
    assert {re.match(r"op\d+", k)[0] for k in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in contract.queries()


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_contamination_by_brute_force(spark):
    long = " ".join(f"b{i}" for i in range(25))
    items = [(1, long), (2, "Tiny Item"), (3, ""), (4, None), (5, "É b3 b4 b5"), (None, "lone words here"), (2, "tiny item"), (10, "b3 b4 b5 b6 b7 b8 b9 b10 b11 b12")]
    texts = [
        None, "", "...", "x tiny, ITEM! y tiny item", long, long.upper(), "a " + " ".join(long.split()[:10]) + " z " + " ".join(long.split()[7:19]),
        " ".join(long.split()[:9]), "é b3 b4 b5", "É b3 b4 b5", "lone words here", "tiny " * 5000 + "item", long + " " + long,
    ]
    docs = spark.createDataFrame([(i, t, 0, "k") for i, t in enumerate(texts)], "doc_id long, text string, n int, word string")
    bench = spark.createDataFrame([(a, b, 1) for a, b in items], "item_id long, text string, n int")
    got = {r.doc_id: r for r in decontam.contamination(docs, bench).collect()}
    for d, text in enumerate(texts):
        w, hit, found = words(text), set(), set()
        for item, it in items:
            iw = words(it)
            k = min(10, len(iw))
            for s in range(len(iw) - k + 1 if iw else 0):
                for p in range(len(w) - k + 1):
                    if w[p : p + k] == iw[s : s + k]:
                        hit |= set(range(p, p + k))
                        found.add(item)
        ids = ",".join(sorted(str(i) for i in found if i is not None))
        r = got[d]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (
            len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)), text
    assert decontam.contamination(docs.limit(0), bench).count() == 0
    none = decontam.contamination(docs, bench.limit(0)).collect()
    assert len(none) == len(texts) and not any(r.contaminated for r in none)


def test_secrets_by_brute_force(spark):
    texts = [
        None, "", "no", "password = 'hunter22' and PASSWD:abc", "token=token: abcdefgh", "é token=ab secret=cd-ef-gh AKIA" + "A" * 16,
        "AKIA" + "B" * 15 + " AKIAAKIA" + "C" * 20, "0" * 23 + " " + "f" * 24 + "g" + "a1" * 20, "api_key: \"x.y.z.1.2\" apikey=_____6",
        "api key=abcdefghi", "deadbeef" * 4 + " ", "k" * 100_000 + " secret=zzzzzz", "-----BEGIN RSA PRIVATE KEY-----",
        "ghp_" + "a" * 36, "eyJ" + "a" * 10 + ".eyJ" + "b" * 10 + "." + "c" * 10, " ".join(["secret=abcdefg"] * 700),
    ]
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, kinds string")
    got = {r.doc_id: r for r in secrets.secrets(docs).collect()}
    base = [
        ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
        ("access", r"AKIA[A-Z0-9]+", 0, 20),
        ("hex", r"[0-9a-f]+", 0, 24),
    ]
    added = 0
    for d, text in enumerate(texts):
        spans = []
        for rank, (kind, pattern, group, least) in enumerate(base):
            fold = re.IGNORECASE if kind == "assign" else 0
            for m in re.finditer(pattern, text or "", fold | re.ASCII):
                if len(m[group]) >= least:
                    spans.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}", kind))
        spans.sort()
        r = got[d]
        counts = [sum(s[3] == k for s in spans) for k in ("assign", "access", "hex")]
        assert [r.n_assign, r.n_access, r.n_hex] == counts, text
        assert r.base_sha256 == hashlib.sha256(",".join(s[2] for s in spans).encode()).hexdigest()
        every = r.spans.split(",") if r.spans else []
        assert {s[2] for s in spans} <= set(every)
        added += len(every) - len(spans)
    assert added == 3
    assert secrets.secrets(docs.limit(0)).count() == 0


def some_match(tree, rng, fold=False):
    """A random string that an expression matches, from its parse tree."""
    out = []
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            c = chr(arg)
            out.append(rng.choice([c.lower(), c.upper()]) if fold else c)
        elif name == "IN":
            kind, x = rng.choice(arg)
            c = chr(x if str(kind) == "LITERAL" else rng.randint(*x))
            out.append(rng.choice([c.lower(), c.upper()]) if fold else c)
        elif name == "SUBPATTERN":
            out.append(some_match(arg[3], rng, (fold or bool(arg[1] & re.I)) and not arg[2] & re.I))
        elif name == "BRANCH":
            out.append(some_match(rng.choice(arg[1]), rng, fold))
        elif name == "ANY":
            out.append(rng.choice("ab \u00e9"))
        elif name != "AT":
            out += [some_match(arg[2], rng, fold) for _ in range(rng.randint(arg[0], min(arg[1], arg[0] + 3)))]
    return "".join(out)


OWN_RULES = [
    r"(?i:key|pass(?:code|phrase))-[a-c]{2}(x|yz)+[0-9]{4}", r"(?i)Bearer\x20+[A-Za-z]{5,}tail", r"(ab|cde.fgh|ij+klm)[xyz]?end", r"a{3}b{2,3}c",
    r"^abc|def$", r"(abc)*d[ab]e", r"[a-z]+", r"(?:foo)?ba[rz]qu+x", r"ab(?-i:CD)ef",
]


def test_trigram_queries_are_necessary():
    """Every match of a rule, also of a caller's, has all trigrams of one alternative."""
    rng = random.Random(2)
    rules = [*secrets.RULES, *[secrets.Rule("own", p) for p in OWN_RULES]]
    for rule in rules:
        query, fold = rule.query(), rule.fold
        assert all(len(g) == 3 for alt in query for g in alt)
        for _ in range(300 if query else 0):
            text = some_match(re._parser.parse(rule.pattern), rng)
            assert re.search(rule.pattern, text)
            text = text.lower() if fold else text
            assert any(all(g in text for g in alt) for alt in query), (rule.pattern, text, query)
    assert not next(r for r in rules if r.kind == "hex").query() and not rules[-3].query()
    assert sum(bool(r.query()) for r in rules) >= 13
    assert secrets.Rule("java", r"\p{Lu}abc").query() == []


def test_own_rule_without_literals_beside_it(spark):
    texts = ["x Bearer  abcdefTAIL y", "bearer abctail", "pass the key", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rules = (*secrets.RULES, secrets.Rule("bearer", OWN_RULES[1]))
    assert [r.spans for r in secrets.secrets(docs, rules).orderBy("doc_id").collect()] == ["bearer:2:20", "", "", ""]


def test_secrets_and_contamination_without_ids_and_with_repeated_ones(spark):
    """Each row counts for its own text, whatever other rows of its id have."""
    long = " ".join(f"b{i}" for i in range(12))
    texts = ["secret=abcdefg", "nothing", long, "x " + long, "", "ghp_" + "a" * 36]
    rows = [(i, t) for t in texts for i in (None, 5)] + [(None, texts[0])] * 40 + [(None, long)] * 40
    bench = spark.createDataFrame([(1, long)], "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    alone = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    for apply in (secrets.secrets, lambda d: decontam.contamination(d, bench)):
        got = sorted((str(tuple(r)[1:]) for r in apply(docs).collect()))
        assert got == sorted(str(tuple(r)[1:]) for r in apply(alone).collect()) and len(got) == len(rows)


def test_mixture(spark):
    texts = [("big", "w " * 40)] * 30 + [("mid", "w " * 20)] * 20 + [("tiny", "w " * 3)] * 9 + [(None, "w")] * 2 + [("none", None), ("none", "")]
    docs = spark.createDataFrame([(i, t, s, 1, "z") for i, (s, t) in enumerate(texts)], "doc_id long, text string, source string, epoch int, weight string")
    rows = mixing.mixture(docs, 3.0).collect()
    uses = {}
    for r in rows:
        uses.setdefault(r.doc_id, set()).add(r.epoch)
    assert set(uses) == set(range(len(texts))) and all(e == set(range(1, len(e) + 1)) for e in uses.values())
    weight = {r.source: r.weight for r in rows}
    assert abs(sum(weight.values()) - 1) < 1e-6
    assert max(r.repeats for r in rows) <= 3.0 + 1e-6 and {r.repeats for r in rows if r.source == "big"} == {1.0}
    for s, size in (("mid", 20), ("tiny", 3)):
        used = sum(r.n_tokens for r in rows if r.source == s)
        target = next(r.repeats for r in rows if r.source == s) * sum(size for x, _ in texts if x == s)
        assert target - size < used <= target + 1e-6
    out = mixing.mix(docs, 3.0)
    assert out.columns == docs.columns and out.count() == len(rows)
    assert mixing.mixture(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0


def test_exponents(spark):
    sources = spark.createDataFrame([("a", 1000), ("b", 100), ("c", 10), ("d", 0)], "source string, tokens long")
    a = mixing.exponent_for_repeats(sources, 4.0)
    assert 100 ** (1 - a) <= 4 + 1e-6 < 100 ** (1 - a + 2 ** -18) + 1e-4
    a = mixing.exponent_for_entropy(sources, 0.9)
    p = np.array([1000, 100, 10.0]) ** a
    p /= p.sum()
    assert abs(-(p * np.log(p)).sum() - 0.9 * np.log(3)) < 1e-4


def test_warc_round_trip(spark):
    pages = [(1, "http://a/\r\nx", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""), (5, "v", "\r\n\r\nWARC/1.1\r\n\r\n" * 50), (None, "w", "<p>é</p>"), (6, "x", "y" * 300_000), (6, "x", "y" * 300_000)]
    frame = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, digest string")
    got = sorted(((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(frame).collect()), key=str)
    want = []
    for page, _, html in pages:
        data = (html or "").encode()
        top = max(p for p, _, h in pages if (h or "").encode() == data and p is not None)
        same = page == top
        want.append((page or 0, len(data), warc.payload_digest(data), "response" if same else "revisit", None if same else top))
    assert got == sorted(want, key=str)
    assert warc.round_trip(frame.limit(0)).count() == 0


def test_warc_selected_records_and_files(spark, tmp_path):
    frame = spark.createDataFrame([(i, f"u{i}", "h" * i) for i in range(50)], "page_id long, url string, html string")
    index = warc.write_archives(frame, str(tmp_path / "w"), file_bytes=2000)
    assert index.select("file").distinct().count() > 1
    some = index.filter("url IN ('u3', 'u40')")
    got = warc.read_archives(some, str(tmp_path / "w"), "bigint").collect()
    assert {(r.page_id, r.payload_bytes) for r in got} == {(3, 3), (40, 40)}


def remainder(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_language_held_out(spark):
    rows = QUERIES["op6_language"](spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    assert all(r.held_out == (remainder(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.98


def test_language_edges(spark):
    learn = [(i, ("the and of " if i % 2 else "der die und ") * 20, "en" if i % 2 else "de") for i in range(40)]
    odd = [(100, None, "en"), (101, "123 !?", "en"), (102, "", None), (103, "der die und " * 90_000, None), (None, "the", "en")]
    frame = spark.createDataFrame([(*r, 0.5) for r in learn + odd], "doc_id long, text string, lang string, score double")
    got = {r.doc_id: r for r in langid.identify(frame).collect()}
    assert [got[i].lang_pred for i in (100, 101, 102, 103, None)] == ["und", "und", "und", "de", "en"]
    assert got[100].score == 0.0 and not got[None].held_out
    nothing = langid.identify(frame.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in nothing.collect()} == {("und", 0.0)}
    assert langid.identify(frame.limit(0)).count() == 0


def test_codewords_differ():
    for n in (1, 2, 4, 5, 12):
        code = langid.codewords(n)
        assert code.shape[0] == n and len({tuple(c) for c in code}) == n
    code = langid.codewords(12).astype(int)
    assert min((code[i] != code[j]).sum() for i in range(12) for j in range(i)) >= 8


def plain_segments(score):
    """Maximal segments by definition: the best run, then the same left and right of it."""
    best = None
    for a in range(len(score)):
        for b in range(a, len(score)):
            s = score[a : b + 1].sum()
            if s > 1e-12 and (best is None or s > best[2] + 1e-12):
                best = (a, b, s)
    if best is None:
        return []
    a, b, s = best
    right = [(x + b + 1, y + b + 1, z) for x, y, z in plain_segments(score[b + 1 :])]
    return [*plain_segments(score[:a]), best, *right]


def test_segments_by_definition():
    rng = np.random.default_rng(8)
    for _ in range(200):
        score = rng.integers(-30, 31, rng.integers(0, 14)) + rng.uniform(-0.4, 0.4)
        got, want = toxicity.segments(score.astype(float)), plain_segments(score.astype(float))
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert np.allclose([g[2] for g in got], [w[2] for w in want])


def test_tokens_match_a_plain_scan():
    text = "Ab ab, ABCDEFG é-x 12 abcdefg!"
    found = np.concatenate(list(toxicity.units(text.encode())))
    assert len(found) == len(words(text))
    assert (found[0] == found[1]).all() and (found[2] == found[-1]).all()
    assert found[0][1] == 0 and len(set(found[2].tolist())) == 4


def test_language_decoding_by_plain_model(monkeypatch):
    """Weighted logistic loss of every codeword, in slices of rows as in one."""
    rng = np.random.default_rng(3)
    code = langid.codewords(4)
    model = langid.Model(list("abcd"), code, np.zeros((langid.BUCKETS, code.shape[1])), rng.uniform(0.1, 2, code.shape[1]))
    margins, n = rng.normal(size=(50, code.shape[1])), rng.integers(1, 90, 50).astype(float)
    margins[7] = 0  # a tie of all
    whole = model.decode(margins, n)
    monkeypatch.setattr(langid, "CELLS", 64)
    assert np.array_equal(whole, model.decode(margins, n))
    for i in range(50):
        loss = [sum(w * np.log1p(np.exp(-m * np.sqrt(n[i]) * c)) for w, m, c in zip(model.weight, margins[i], row)) for row in code]
        p = np.exp(min(loss) - np.array(loss))
        assert np.allclose(whole[i], p / p.sum())
    assert whole[7].argmax() == 0


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in QUERIES["op7_toxicity"](spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    held = [(r.toxic, rows[r.doc_id]) for r in labels if remainder(r.doc_id, 3) == 1]
    assert all(r.held_out and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for _, r in held)
    caught = [r.predicted for t, r in held if t]
    wrong = [r.predicted for t, r in held if not t]
    assert np.mean(caught) > 0.85 and np.mean(wrong) < 0.01


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None, 2.0), (2, "", 2.0), (None, "vile words", 2.0), (3, "fine " * 100_000, 2.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    rows = toxicity.score(docs, labels).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    assert toxicity.score(docs, labels.limit(0)).filter("predicted = 1").count() == 0
    assert toxicity.score(docs.limit(0), labels).count() == 0


def test_pipeline_stages(spark):
    sf = SF_DIR
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    n = docs.count()
    toxic = {r.doc_id for r in toxicity.score(docs, spark.read.parquet(f"{sf}/labels.parquet")).filter("predicted = 1").collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:3]:
        before = docs
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), docs.schema)
        kept[name] = {r.doc_id for r in docs.collect()}
        assert docs.columns == before.columns and kept[name] <= {r.doc_id for r in before.collect()}
    assert kept["toxicity"] == set(range(n)) - toxic
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    assert not decontam.contamination(docs, bench).filter("contaminated").count()
    mixed = corpus_pipeline.STAGES[3][1](spark, docs, sf)
    assert {r.doc_id for r in mixed.collect()} == kept["decontamination"]
    out = corpus_pipeline.STAGES[4][1](spark, mixed, sf)
    assert out.columns == [*docs.columns, "shard", "slot"] and out.count() == mixed.count()


def test_pipeline_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.count() == 0
