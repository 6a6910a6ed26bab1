"""The toxicity score against a plain model of it, and the size of what is sent to tasks."""

import importlib
import math
import pkgutil
import random
import re
import types
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark import cloudpickle

import terrace.llm
from terrace.llm import toxicity


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n


def plain_units(token):
    token = token.encode()
    return [(0, token)] + [(c, token[:c]) for c in toxicity.PREFIXES if len(token) > c]


def plain_segments(score):
    """Maximal segments by splitting: the best one, then left and right of it."""
    if not len(score):
        return []
    sums = np.concatenate([[0], np.cumsum(score)])
    best = max(((sums[j] - sums[i], -(j - i), -i, i, j) for i in range(len(score)) for j in range(i + 1, len(score) + 1)), default=None)
    if best[0] <= 1e-12:
        return []
    i, j = best[3], best[4]
    left, right = plain_segments(score[:i]), plain_segments(score[j:])
    return left + [(i, j - 1, best[0])] + [(a + j, b + j, s) for a, b, s in right]


def plain(docs, labels):
    known = {i: t for i, t in labels if crc(i, 3) != 1}
    tokens = {i: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower()) for i, t in docs}
    counts = {}
    for i, toxic in known.items():
        for u in {u for w in tokens.get(i, ()) for u in plain_units(w)}:
            counts.setdefault(u, Counter())[("t" if toxic == 1 else "c") + str(crc(i, 3))] += 1
    n = Counter()
    for c in counts.values():
        n.update(c)

    def bound(t, c, nt, nc):
        nt, nc = max(nt, 1), max(nc, 1)
        a = max(nt * (t + c) / (nt + nc), 1e-9)
        b = math.log((t + a) / (2 * nt)) - math.log((c + a) / (nc + nt)) - toxicity.BOUND * math.sqrt(1 / (t + a) + 1 / (c + a))
        return b if b >= toxicity.LEAST else 0.0

    model, clean = {}, [Counter(), Counter(), Counter()]
    for u, c in counts.items():
        if c["t0"] + c["t2"] > 1:
            sides = [("t0", "t2"), ("t0",), ("t2",)]
            scores = [bound(*(sum(c[k.replace("t", x)] for k in s) for x in "tc"), *(sum(n[k.replace("t", x)] for k in s) for x in "tc")) for s in sides]
            if scores[0] > 0:
                model[u] = scores
                for k, s in enumerate(sides):
                    clean[k][round(scores[k] / toxicity.STEP) * toxicity.STEP] += sum(c[x.replace("t", "c")] for x in s)
    totals = [n["c0"] + n["c2"], n["c0"], n["c2"]]
    rates = [toxicity._rate(np.array(list(c)), np.array(list(c.values()), dtype=float), t) for c, t in zip(clean, totals, strict=True)]

    def found(i, k):
        score = np.array([max([0.0, *(model[u][k] for u in plain_units(w) if u in model)]) - toxicity.DRIFT for w in tokens[i]])
        return [(a, b, rates[k] * s) for a, b, s in plain_segments(score)]

    crossed = {i: found(i, 2 if crc(i, 3) == 0 else 1) for i in known if i in tokens}
    calm = [i for i in crossed if known[i] != 1]
    k = (sum(s[2] > toxicity.LONG for i in calm for s in crossed[i]) + 1) * math.exp(toxicity.LONG) / (sum(len(tokens[i]) for i in calm) + 1)

    def evidence(i, segments):
        chance = math.log(k * max(1, len(tokens[i])) + 1)
        each = [s[2] - chance for s in segments]
        good = [x for x in each if x > 0]
        return sum(good) if good else max(each, default=-chance)

    bins = {}
    for i, s in crossed.items():
        x = evidence(i, s)
        bins.setdefault(round(min(max(x, toxicity.LOWEST), toxicity.HIGHEST) / toxicity.BIN), []).append((x, known[i]))
    xs, ps = toxicity.calibration(*[np.array([f(v) for v in bins.values()], dtype=float) for f in (lambda v: np.mean([x for x, _ in v]), lambda v: sum(t for _, t in v), len)])
    out = {}
    for i in tokens:
        x = evidence(i, found(i, 0))
        out[i] = (x, (1 - toxicity.RISE) * np.interp(x, xs, ps) + toxicity.RISE / (1 + math.exp(-x / 10)))
    return out


def corpus():
    rng = random.Random(8)
    calm, vile = [f"word{i}" for i in range(150)], [f"nasty{i}" for i in range(6)] + ["vilest", "vileness"]
    docs, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        words = rng.choices(calm, k=rng.randrange(3, 40))
        if toxic or rng.random() < 0.01:
            at = rng.randrange(len(words))
            words[at:at] = rng.choices(vile, k=rng.randrange(3, 9))
        docs.append((i, rng.choice([", ", " "]).join(words).upper() if i % 7 == 0 else " ".join(words)))
        if i % 3:
            labels.append((i, int(toxic)))
    return [*docs, (500, None), (501, ""), (502, "?!")], labels


@pytest.mark.parametrize("model_bytes", [toxicity.MODEL_BYTES, 0])
def test_score_by_plain_model(spark, model_bytes):
    docs, labels = corpus()
    frame = spark.createDataFrame([*docs, (None, docs[4][1]), (4, docs[4][1])], "doc_id long, text string")
    rows = toxicity.score(frame, spark.createDataFrame(labels, "doc_id long, toxic int"), model_bytes=model_bytes).collect()
    want = plain(docs, labels)
    assert len(rows) == len(docs) + 2
    for r in rows:
        assert math.isclose(r.score, want[4 if r.doc_id is None else r.doc_id][1], abs_tol=1e-9)
        assert r.predicted == (r.score >= 0.7)
    ordered = sorted(want.values())
    assert all(b[1] > a[1] for a, b in zip(ordered, ordered[1:], strict=False) if b[0] > a[0] + 1e-9)  # more evidence, higher
    assert sum(r.predicted for r in rows) > 50 and len({r.score for r in rows}) > 100


def test_nothing_sent_to_tasks_is_large():
    """Every function of the operators, and with it the module it is shipped with."""
    for info in pkgutil.iter_modules(terrace.llm.__path__):
        module = importlib.import_module(f"terrace.llm.{info.name}")
        for name, f in vars(module).items():
            if isinstance(f, types.FunctionType) and f.__module__ == module.__name__:
                assert len(cloudpickle.dumps(f)) < 100_000, f"{info.name}.{name}"
