"""Toxic passages by maximum-scoring segments.

Tokens are scored by log-odds between toxic and other documents with a Dirichlet prior that
holds the share of the token in both together. A token is looked up whole and by its first
bytes (``PREFIXES``), so unseen endings of a known stem count; its score is the lower bound
of the log-odds, ``BOUND`` standard errors down, of the best of these, and zero if none is
over ``LEAST``. Every token also costs ``DRIFT``, so scores fall on average.

One linear scan then finds all maximal-scoring segments of a text: the runs that no shorter
or longer run beats. Scores of such segments follow an extreme-value law: segments with a
score over ``S`` are expected ``K n exp(-lambda S)`` times in ``n`` tokens by chance, with
``lambda`` from the token scores of the documents that are not toxic and ``K`` from the
segments counted in those of the training rows. Segments expected less than once are
significant passages; their evidence, ``lambda S - log(K n)``, is added up. The sum becomes a
probability by isotonic regression on the training rows, each scored with a model that was
learned from the other half of them; between the points of the regression and beyond them the
score keeps rising, so more evidence always scores higher.

Token counts come from all labelled training rows, and every token whose score counts is in the
model. A model of at most ``MODEL_BYTES`` is shipped with the tasks; of a larger one every text
gets the tokens that it holds by a join.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import by_batch, keep, small
from terrace.llm.langid import remainder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PREFIXES = (4, 5, 6)
PRIOR = 1.0  # weight of the prior, in sizes of the toxic part
BOUND = 1.64
LEAST = 1.0
DRIFT = 0.1
LONG = 2.0  # lambda S from which on segments are counted for K
THRESHOLD = 0.7
MODEL_BYTES = 32 << 20
STEP = 1e-3  # of token scores, where lambda is fitted
RISE = 0.02  # share of the score that rises with the evidence everywhere
MAP_BITS = 20
BIN, LOWEST, HIGHEST = 0.5, -15.0, 60.0
CHUNK = 1 << 22

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_WORD = np.zeros(256, dtype=bool)
_WORD[list(range(0x30, 0x3A)) + list(range(0x61, 0x7B)) + list(range(0x80, 0x100))] = True


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Tables(dict):
    """Arrays that each process makes for itself: empty when sent to tasks."""

    def __reduce__(self):
        return _Tables, ()


_tables = _Tables()


def _both_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, made where they are used."""
    if len(_tables.get("up", ())) < n:
        _tables["up"], _tables["down"] = _powers(_BASE, max(n, 1 << 16)), _powers(_INVERSE, max(n, 1 << 16))
    return _tables["up"], _tables["down"]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _units_of(block: bytes) -> np.ndarray:
    """Rows of hashes, one row per token: the whole token, then its prefixes (zero where the
    token is not longer than the prefix)."""
    data = np.frombuffer(block, dtype=np.uint8)
    word = _WORD[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    up, down = _both_powers(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    units = np.zeros((len(start), 1 + len(PREFIXES)), dtype=np.uint64)
    for c, size in enumerate((None, *PREFIXES)):
        stop = end if size is None else np.minimum(start + size, end)
        h = _mix((sums[stop] - sums[start]) * down[start] + np.uint64(c * 0x2545F4914F6CDD1D % (1 << 64)))
        units[:, c] = h if size is None else np.where(end - start > size, h, np.uint64(0))
    return units


def units(text: bytes | None) -> Iterator[np.ndarray]:
    """Units of a whole text, cut between words into blocks."""
    text, at = (text or b"").lower(), 0
    while at < len(text):
        to = min(len(text), at + CHUNK)
        while to < len(text) and _WORD[text[to]]:
            to += 1
        yield _units_of(text[at:to])
        at = to


def _count(batch: pa.RecordBatch) -> Iterator[dict]:
    """Documents that have each unit, by fold and label."""
    pieces, kinds = [], []
    folds, toxic = batch.column("fold").to_pylist(), batch.column("toxic").to_pylist()
    for text, fold, bad in zip(batch.column("text").to_pylist(), folds, toxic, strict=True):
        each = [np.unique(u) for u in units(text)]
        if each:
            found = np.unique(np.concatenate(each))
            found = found[found != 0]
            pieces.append(found)
            kinds.append(np.full(len(found), 2 * (fold != 0) + (bad != 1), dtype=np.int8))
    if not pieces:
        return
    unit, kind = np.concatenate(pieces), np.concatenate(kinds)
    names, at = np.unique(unit, return_inverse=True)
    counts = np.bincount(at * 4 + kind, minlength=4 * len(names)).reshape(-1, 4)
    yield {"unit": names.view(np.int64), **{c: counts[:, i].astype(np.int64) for i, c in enumerate(("t0", "c0", "t2", "c2"))}}


def _bound(t: Column, c: Column, nt: float, nc: float) -> Column:
    """Lower bound of the log-odds with the Dirichlet prior; zero below ``LEAST``."""
    nt, nc = max(nt, 1.0), max(nc, 1.0)
    prior = PRIOR * nt
    a = F.greatest(F.lit(prior) * (t + c) / (nt + nc), F.lit(1e-9))
    odds = F.log((t + a) / (nt + prior)) - F.log((c + a) / (nc + prior))
    bound = odds - BOUND * F.sqrt(1 / (t + a) + 1 / (c + a))
    return F.when(bound >= LEAST, bound).otherwise(0.0)


@dataclass
class Model:
    unit: np.ndarray  # sorted hashes
    score: np.ndarray  # one column: learned from all, from fold 0, from fold 2

    def look_up(self, found: np.ndarray, column: int) -> np.ndarray:
        """Score of each token: the best of its units."""
        best = np.zeros(len(found))
        if not len(self.unit):
            return best
        for c in range(found.shape[1]):
            h = found[:, c]
            at = np.flatnonzero(self.mark[h >> np.uint64(64 - MAP_BITS)])
            place = np.minimum(np.searchsorted(self.unit, h[at]), len(self.unit) - 1)
            same = self.unit[place] == h[at]
            np.maximum.at(best, at[same], self.score[place[same], column])
        return best

    def __post_init__(self):
        self.mark = np.zeros(1 << MAP_BITS, dtype=bool)
        self.mark[self.unit >> np.uint64(64 - MAP_BITS)] = True


SCORES = ("all", "fold0", "fold2")


def _rate(score: np.ndarray, clean: np.ndarray, total: float) -> float:
    """The lambda at which the mean of exp(lambda * score) over clean tokens is one; ``clean``
    of them have each ``score``, the others of ``total`` have none."""
    p = (clean + 1.0 / max(1, len(clean))) / (total + 1)
    low, high = 1e-3, 20.0
    for _ in range(60):
        mid = (low + high) / 2
        mean = (p * np.exp(np.minimum(mid * (score - DRIFT), 500))).sum() + max(0.0, 1 - p.sum()) * np.exp(-mid * DRIFT)
        low, high = (mid, high) if mean < 1 else (low, mid)
    return low


def learn(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, list[float], DataFrame]:
    """The model as kept rows ``(unit, all, fold0, fold2)`` of scores learned from all training
    rows and from either half, lambda of each, and the labels it may use as kept rows
    ``(doc_id, toxic, fold)``."""
    known = keep(
        labels.filter((remainder(3) != 1) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .withColumn("fold", remainder(3).cast("int")),
        "toxicity-labels",
    )
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(small(known), "doc_id")
    counts = by_batch(rows, _count, "unit long, t0 long, c0 long, t2 long, c2 long")
    names = ("t0", "c0", "t2", "c2")
    counts = keep(counts.groupBy("unit").agg(*[F.sum(c).alias(c) for c in names]), "toxicity-units")
    total = counts.agg(*[F.sum(c).alias(c) for c in names]).collect()[0]
    n = {c: float(total[c] or 0) for c in names}
    t0, c0, t2, c2 = (F.col(c) for c in names)
    sides = [(t0 + t2, c0 + c2, n["t0"] + n["t2"], n["c0"] + n["c2"]), (t0, c0, n["t0"], n["c0"]), (t2, c2, n["t2"], n["c2"])]
    model = keep(
        counts.filter("t0 + t2 > 1")
        .select("unit", "c0", "c2", *[_bound(*side).alias(s) for s, side in zip(SCORES, sides, strict=True)])
        .filter(F.col("all") > 0),
        "toxicity-model",
    )
    rates = []
    for s, clean, all_clean in zip(SCORES, ("c0 + c2", "c0", "c2"), (side[3] for side in sides), strict=True):
        # Scores are below 50: a bounded number of steps.
        steps = model.groupBy(F.round(F.col(s) / STEP).alias("step")).agg(F.sum(F.expr(clean)).alias("n")).collect()
        score, clean_n = np.array([r["step"] * STEP for r in steps]), np.array([float(r["n"]) for r in steps])
        rates.append(_rate(score, clean_n, all_clean))
    return model.select("unit", *SCORES), rates, known


def segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments ``(first, last, score)`` of a sequence, in order: for each
    positive element, the segments to its left are merged while that pays."""
    at = np.flatnonzero(score > 0)
    if not len(at):
        return []
    total = np.cumsum(score)
    after = total[at].tolist()
    before = (total[at] - score[at]).tolist()
    out: list[list] = []  # first, last, sum before, sum after
    for place, low, high in zip(at.tolist(), before, after, strict=True):
        first = place
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= low:
                j = out[j][4]
            if j < 0 or out[j][3] >= high:
                out.append([first, place, low, high, j])
                break
            first, low = out[j][0], out[j][2]
            del out[j:]
    return [(a, b, high - low) for a, b, low, high, _ in out]


def _model(unit: pa.Array, scores: list[pa.Array]) -> Model:
    unit = unit.to_numpy().view(np.uint64)
    order = np.argsort(unit)
    return Model(unit[order], np.stack([s.to_numpy()[order] for s in scores], axis=1) if len(unit) else np.zeros((0, 3)))


def _held(batch: pa.RecordBatch) -> Iterator[dict]:
    """The distinct units of each text."""
    row, found = [], []
    for i, text in enumerate(batch.column("text").to_pylist()):
        each = [np.unique(u) for u in units(text)]
        mine = np.unique(np.concatenate(each)) if each else np.zeros(0, dtype=np.uint64)
        row.append(np.full(len(mine), i))
        found.append(mine)
    row = pa.array(np.concatenate(row) if row else np.zeros(0, dtype=np.int64))
    yield {
        "doc_id": batch.column("doc_id").take(row),
        "key": batch.column("key").take(row),
        "unit": np.concatenate(found).view(np.int64) if found else np.zeros(0, dtype=np.int64),
    }


_SEGMENTS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())]))


def _scorer(model: Model | None, rates: list[float]):
    """Number of tokens and maximal segments of each text, their scores times lambda; ``crossed``
    by the model of the other half, for training rows. Without ``model``, rows bring theirs."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        folds = batch.column("fold").to_pylist()
        own = None if model else batch.column("units")
        n, found, crossed = [], [], []
        for i, (text, fold) in enumerate(zip(batch.column("text").to_pylist(), folds, strict=True)):
            if model:
                here = model
            else:
                mine = own[i].values
                here = _model(*([mine.field("unit"), [mine.field(s) for s in SCORES]] if mine is not None else [pa.array([], pa.int64()), []]))
            tokens = list(units(text))
            n.append(sum(len(u) for u in tokens))

            def passages(column: int, tokens=tokens, here=here) -> list[dict]:
                score = np.concatenate([here.look_up(u, column) for u in tokens]) - DRIFT if tokens else np.zeros(0)
                return [{"first": a, "last": b, "score": rates[column] * s} for a, b, s in segments(score)]

            found.append(passages(0))
            crossed.append(None if fold is None else passages(2 if fold == 0 else 1))
        yield {
            **{c: batch.column(c) for c in ("doc_id", "key", "held_out", "toxic")},
            "n": pa.array(n, pa.int64()),
            "found": pa.array(found, _SEGMENTS),
            "crossed": pa.array(crossed, _SEGMENTS),
        }

    return run


def _evidence(found: str, k: float) -> tuple[Column, Column]:
    """Added evidence of a text's significant passages, or of its best segment where none is
    significant, and those passages."""
    chance = F.log(k * F.greatest(F.col("n"), F.lit(1)) + 1)
    each = F.transform(found, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"), (s["score"] - chance).alias("evidence")))
    good = F.filter(each, lambda s: s["evidence"] > 0)
    added = F.aggregate(good, F.lit(0.0), lambda x, s: x + s["evidence"])
    best = F.coalesce(F.array_max(F.transform(each, lambda s: s["evidence"])), -chance)
    return F.when(F.size(good) > 0, added).otherwise(best), good


def calibration(x: np.ndarray, bad: np.ndarray, all_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of the toxic share by mean evidence of bins, with half a row of either
    kind added to each pooled block: ``(x, probability)`` points in the middle of the blocks."""
    blocks: list[list[float]] = []
    for at, b, n in sorted(zip(x, bad, all_, strict=True)):
        blocks.append([b, n, at * n])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            last = blocks.pop()
            blocks[-1] = [u + v for u, v in zip(blocks[-1], last, strict=True)]
    xs = np.array([at / n for _, n, at in blocks])
    ps = np.array([(b + 0.5) / (n + 1) for b, n, _ in blocks])
    return xs, np.maximum.accumulate(ps) if len(ps) else ps


def score(docs: DataFrame, labels: DataFrame, keyed: bool = False, model_bytes: int = MODEL_BYTES) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted, passages``.

    Labels of rows whose crc32(doc_id) modulo 3 is not 1 are learned from (a document with
    several labels is toxic if one says so). ``passages`` holds first and last word number
    and evidence of each significant passage. Of two texts the one with more evidence scores
    higher; equal evidence scores alike. Null and empty texts have no evidence and get
    the score of such rows; without any training rows every score is about 0.5. A null
    doc_id is not held out and has no label. Repeated rows stay; an empty table gives no
    rows. Other columns are not read. With ``keyed``, ``key`` (xxhash64 of the text) is added,
    for rows whose doc_id is null or repeated.
    """
    model, rates, known = learn(docs, labels)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = (
        docs.select("doc_id", F.xxhash64("text").alias("key"), F.col("text").cast("binary").alias("text"))
        .join(small(known), "doc_id", "left")
        .withColumn("held_out", F.coalesce(remainder(3) == 1, F.lit(False)))
    )
    shipped = None
    if model.count() * 8 * (1 + len(SCORES)) <= model_bytes:
        table = model.toArrow()
        shipped = _model(table.column("unit"), [table.column(s) for s in SCORES])
    else:
        held = by_batch(rows, _held, f"doc_id {kind}, key long, unit long").join(model, "unit")
        # The tokens of one text that count; rows that repeat it ask for the same ones.
        held = held.groupBy("doc_id", "key").agg(F.collect_set(F.struct("unit", *SCORES)).alias("units"))
        same = F.col("r.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("r.key") == F.col("h.key"))
        rows = rows.alias("r").join(held.alias("h"), same, "left").select("r.*", "h.units")
    segment = "array<struct<first: int, last: int, score: double>>"
    found = keep(
        by_batch(
            rows,
            _scorer(shipped, rates),
            f"doc_id {kind}, key long, held_out boolean, toxic int, n long, found {segment}, crossed {segment}",
        ),
        "toxicity-segments",
    )
    clean = found.filter("toxic <> 1")
    seen = clean.agg(F.sum(F.size(F.filter("crossed", lambda s: s["score"] > LONG))).alias("long"), F.sum("n").alias("n")).collect()[0]
    k = ((seen["long"] or 0) + 1) * float(np.exp(LONG)) / ((seen["n"] or 0) + 1)
    # One row per bin.
    x, _ = _evidence("crossed", k)
    trained = found.filter("toxic IS NOT NULL").select("toxic", x.alias("x"))
    place = F.round(F.least(F.greatest("x", F.lit(LOWEST)), F.lit(HIGHEST)) / BIN)
    bins = trained.groupBy(place.alias("bin")).agg(F.avg("x").alias("x"), F.sum("toxic").alias("bad"), F.count("*").alias("n")).collect()
    xs, ps = calibration(*[np.array([float(r[c]) for r in bins]) for c in ("x", "bad", "n")])
    if not len(xs):
        xs, ps = np.array([0.0]), np.array([0.5])
    x, passages = _evidence("found", k)
    key = ["key"] if keyed else []
    out = found.select("doc_id", "held_out", x.alias("x"), passages.alias("passages"), *key)
    return out.select("doc_id", "held_out", _probability(F.col("x"), xs, ps).alias("score"), "passages", *key).select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "passages", *key
    )


def _probability(x: Column, xs: np.ndarray, ps: np.ndarray) -> Column:
    """Linear between the points (few, one per block of bins), level beyond them; a small share
    rises with the evidence everywhere."""
    value = F.lit(float(ps[-1]))
    for i in range(len(xs) - 2, -1, -1):
        run = max(1e-12, float(xs[i + 1] - xs[i]))
        here = F.lit(float(ps[i])) + (x - float(xs[i])) * float((ps[i + 1] - ps[i]) / run)
        value = F.when(x <= float(xs[i]), F.lit(float(ps[i]))).when(x < float(xs[i + 1]), here).otherwise(value)
    return (1 - RISE) * value + RISE / (1 + F.exp(-x / 10))
