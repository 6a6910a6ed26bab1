"""Near-duplicate documents by SimHash fingerprints, linked through pivot distance tables.

The distance of every distinct fingerprint to ``PIVOTS`` reference fingerprints is computed
once, segment by segment (the distance is the sum over seven segments). Two fingerprints
that differ in at most four bits differ in at most four segments, so they have the same
distances to every pivot on at least three segments: the distances on each three segments
are the key of one table, and only rows of one key are compared. Of those, a pair goes as
soon as one coordinate (distance to a pivot) differs by more than four, since two
fingerprints are at least that far apart (triangle inequality); what is left is verified
bit by bit. Nothing is lost and nothing unverified is linked.

Equal fingerprints are one node. A run of more than ``hot_run`` different fingerprints with
one key is not compared pair by pair: each lists the points within two bits on the free
segments, and two are within four bits exactly when they share such a point, so the links
come from a grouping whose cost grows with the run, not with its square.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import by_batch, by_runs, components, keep, parts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 4
SEED = 42
MAX_BITS = 4
PIVOTS = 16
SEGMENTS = 7
HOT_RUN = 8192
BLOCK = 1 << 15

TABLES = list(combinations(range(SEGMENTS), SEGMENTS - MAX_BITS))


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (odd multiplications and shifts)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pivots() -> np.ndarray:
    return _mix(np.arange(1, PIVOTS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def masks() -> list[np.uint64]:
    cuts = np.linspace(0, 64, SEGMENTS + 1).round().astype(int)
    return [np.uint64(((1 << int(b - a)) - 1) << int(a)) for a, b in zip(cuts, cuts[1:], strict=False)]


def fingerprint(text: bytes | None) -> int:
    """64-bit SimHash of one text in UTF-8; zero without words."""
    words = (text or b"").lower().split()  # A-Z only; splits on ASCII white space only
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - SHINGLE + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]).tolist()
    ends = ends.tolist()
    ends = ends[SHINGLE - 1 :] if len(words) >= SHINGLE else [len(joined)]
    ones, digest = np.zeros(64, dtype=np.uint64), xxhash.xxh64_intdigest
    for at in range(0, n, BLOCK):
        to = min(n, at + BLOCK)
        h = np.array(
            [digest(joined[s:e], SEED) for s, e in zip(starts[at:to], ends[at:to], strict=True)],
            dtype="<u8",
        )
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0)
    return int(np.packbits(ones * np.uint64(2) > np.uint64(n), bitorder="little").view("<u8")[0])


def _fingerprints(batch: pa.RecordBatch) -> Iterator[dict]:
    found = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], dtype=np.uint64)
    yield {"doc_id": batch.column("doc_id"), "fp": found.view(np.int64)}


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp)`` with the fingerprint as a signed long."""
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return by_batch(texts, _fingerprints, f"doc_id {kind}, fp long")


def distances(fps: np.ndarray) -> np.ndarray:
    """Rows of distances to every pivot."""
    return np.bitwise_count(fps[:, None] ^ pivots()[None, :]).astype(np.int8)


def _table_rows(batch: pa.RecordBatch) -> Iterator[dict]:
    fps = batch.column("fp").to_numpy().view(np.uint64)
    away, codes = fps[:, None] ^ pivots()[None, :], []
    for mask in masks():
        code = np.zeros(len(fps), dtype=np.uint64)
        for p in range(PIVOTS):  # at most ten bits a segment: four bits hold a distance
            code |= np.bitwise_count(away[:, p] & mask).astype(np.uint64) << np.uint64(4 * p)
        codes.append(code)
    for t, segments in enumerate(TABLES):
        key = np.full(len(fps), t + 1, dtype=np.uint64)
        for s in segments:
            key = _mix(key ^ codes[s]) * np.uint64(0x9E3779B97F4A7C15)
        yield {"key": key.view(np.int64), "tab": np.full(len(fps), t, dtype=np.int32), "fp": fps.view(np.int64)}


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of ``a`` x ``b`` are within four bits: coordinates first, then the bits."""
    da, db = distances(a), distances(b)
    left = np.abs(da[:, 0][:, None] - db[:, 0][None, :]) <= MAX_BITS
    for p in range(1, PIVOTS):
        left &= np.abs(da[:, p][:, None] - db[:, p][None, :]) <= MAX_BITS
    i, j = np.nonzero(left)
    left[i, j] = np.bitwise_count(a[i] ^ b[j]) <= MAX_BITS
    return left


def _groups(fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.uint64]]:
    """Linked fingerprints of one run, each with the first one that reached it."""
    left = np.unique(fps)
    while len(left) > 1:
        root, front, left = left[0], left[:1], left[1:]
        while len(front) and len(left):
            hit = np.zeros(len(left), dtype=bool)
            for at in range(0, len(front), 64):
                hit |= _near(front[at : at + 64], left).any(0)
            front, left = left[hit], left[~hit]
            if len(front):
                yield front, root


def _run_links(hot_run: int):
    def links(rows: pa.Table) -> Iterator[dict]:
        key, tab = rows.column("key").to_numpy(), rows.column("tab").to_numpy()
        fps = rows.column("fp").to_numpy().view(np.uint64)
        cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
        size = np.diff(cuts)
        a, b, hot = [], [], []
        # Runs of two are by far the most: all at once.
        two = cuts[:-1][size == 2]
        x, y = fps[two], fps[two + 1]
        ok = (np.abs(distances(x) - distances(y)) <= MAX_BITS).all(1)
        x, y = x[ok], y[ok]
        ok = np.bitwise_count(x ^ y) <= MAX_BITS
        a.append(x[ok])
        b.append(y[ok])
        for at, n in zip(cuts[:-1][size > 2], size[size > 2], strict=True):
            run = fps[at : at + n]
            if n > hot_run:
                hot.append((np.full(n, tab[at], dtype=np.int32), run))
                continue
            for members, root in _groups(run):
                a.append(members)
                b.append(np.full(len(members), root))
        a, b = np.concatenate(a), np.concatenate(b)
        yield {"a": a.view(np.int64), "b": b.view(np.int64), "tab": pa.nulls(len(a), pa.int32())}
        for t, run in hot:
            yield {"a": run.view(np.int64), "b": run.view(np.int64), "tab": t}

    return links


def _hot_rows(rows: pa.Table) -> Iterator[dict]:
    """Rows of one run that is too long to hold."""
    fps = rows.column("fp").combine_chunks()
    yield {"a": fps, "b": fps, "tab": rows.column("tab").combine_chunks()}


def _midpoints(batch: pa.RecordBatch) -> Iterator[dict]:
    """Points within two bits of each fingerprint, on the segments that its table leaves free."""
    tab, fps = batch.column("tab").to_numpy(), batch.column("a").to_numpy().view(np.uint64)
    cuts = masks()
    for t in np.unique(tab):
        fixed = sum(int(cuts[s]) for s in TABLES[t])
        bits = [np.uint64(1 << i) for i in range(64) if not fixed >> i & 1]
        flips = np.array([0, *bits, *[x | y for x, y in combinations(bits, 2)]], dtype=np.uint64)
        for fp in fps[tab == t]:
            yield {"tab": np.full(len(flips), t, dtype=np.int32), "mid": (fp ^ flips).view(np.int64), "fp": np.full(len(flips), fp).view(np.int64)}


def fingerprint_links(fps: DataFrame, hot_run: int = HOT_RUN) -> DataFrame:
    """Links ``(a, b)`` whose connected components are those of "at most four bits apart"
    among the distinct fingerprints ``fps (fp)``."""
    rows = by_batch(fps, _table_rows, "key long, tab int, fp long")
    dealt = rows.repartition(parts(fps.sparkSession), "key").sortWithinPartitions("key", "fp")
    found = keep(by_runs(dealt, ["key"], _run_links(hot_run), "a long, b long, tab int", hot_run, _hot_rows), "simhash-links")
    near = by_batch(found.filter("tab IS NOT NULL"), _midpoints, "tab int, mid long, fp long")
    first = near.groupBy("tab", "mid").agg(F.min("fp").alias("b"))
    far = near.join(first, ["tab", "mid"]).filter("fp <> b").select(F.col("fp").alias("a"), "b")
    return found.filter("tab IS NULL").select("a", "b").unionByName(far)


def near_duplicates(docs: DataFrame, hot_run: int = HOT_RUN) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hexadecimal digits) and
    ``component_id``, the smallest doc_id that links of at most four bits reach.

    Null and empty texts have fingerprint zero and link with each other. A null doc_id is
    kept but never the smallest one (null only if its whole component has none). Repeated
    rows stay repeated; an empty table gives no rows; other columns are not read.
    """
    fps = keep(fingerprints(docs), "simhash-fp")
    nodes = keep(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    roots = components(fingerprint_links(nodes.select("fp"), hot_run), "simhash-components")
    nodes = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = nodes.join(least, "root").select("fp", "component_id")
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
