"""Groups of near copies: texts that share at least ``SIMILARITY`` of their word shingles.

Every text gets a SimHash fingerprint of 256 bits over its distinct shingles and min-wise
hashes of them in ``BANDS`` bands of ``ROWS``. Candidate pairs come from both:

1. Pivot distance tables over the first 64 bits (``simhash.fingerprint_links``) link what is
   within four bits, whatever the size of a group.
2. At a similarity of 0.8 fingerprints differ in about ten of 64 bits, too many for tables of
   equal segments. Texts that share a band meet there: a pair with similarity ``s`` shares one
   with probability ``1 - (1 - s**ROWS)**BANDS``. All rows are put in the order of band and
   of further min-wise hashes, in which texts that agree on more of them stand closer, so a
   crowded band is deepened by itself. Each row is compared with the next one; in a second
   round, with the member of the band's largest group and with ``NEXT`` more that follow it. A
   band of up to ``NEXT + 2`` texts is compared in full; the pairs of both rounds rise with the
   rows, never with the square of a band.

Pairs of one group already are left out of the second round, as are pairs whose fingerprints
differ in more than ``MOST_BITS`` (of two texts at a similarity of 0.8, three in a thousand do).
What is left is verified on the whole shingle sets, so nothing unverified is linked. Groups of
the second round are found among those of the first, not among all texts again.

A band of more than ``NEXT + 2`` texts that still holds several groups is not left at that: its
texts are compared in full, without the fingerprints (``_rest``), by bounds that lose nothing.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import by_batch, components, forget, keep, ranked
from terrace.llm.simhash import _mix, fingerprint_links

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4
SEED = 42
BLOCK = 1024
NEXT = 4
SLACK = 1e-6  # for rounding
MARKS = 16  # words of 64 bits
FURTHER = 2  # min-wise hashes that order the texts of a band
WORDS = 4  # of 64 bits, in a fingerprint
MOST_BITS = 55

_STEP = np.uint64(0x9E3779B97F4A7C15)


def node_of(text: Column | str) -> Column:
    """Exact copies are one node; null is the empty text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.xxhash64(F.coalesce(text, F.lit("")))


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text in UTF-8; a text with fewer words than
    a shingle, none at all too, is one shingle."""
    words = (text or b"").lower().split()  # A-Z only; splits on ASCII white space only
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
    each = np.array([xxhash.xxh64_intdigest(w, SEED) for w in words], dtype=np.uint64)
    n = len(words) - SHINGLE + 1
    found = np.zeros(n, dtype=np.uint64)
    for i in range(SHINGLE):
        found = _mix(found + _STEP) ^ each[i : i + n]
    return np.unique(_mix(found))


def bands(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A key for each band of min-wise hashes of a shingle set, and hashes of the band after it."""
    seeds = np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * _STEP
    add, times = _mix(seeds), _mix(seeds ^ _STEP) | np.uint64(1)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(found), BLOCK):
        np.minimum(least, ((found[at : at + BLOCK, None] + add) * times).min(0), out=least)
    keys = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        keys = _mix(keys * _STEP ^ column)
    return keys, np.roll(least.reshape(BANDS, ROWS), -1, axis=0)[:, :FURTHER]


def fingerprint(found: np.ndarray) -> np.ndarray:
    """SimHash of a shingle set: ``WORDS`` words of 64 bits, a bit set if it is in over half."""
    ones = np.zeros((WORDS, 64), dtype=np.int64)
    for at in range(0, len(found), BLOCK):
        part = found[at : at + BLOCK]
        for w in range(WORDS):
            bits = np.unpackbits((part if not w else _mix(part + np.uint64(w * int(_STEP) % (1 << 64)))).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones[w] += bits.sum(0, dtype=np.int64)
    return np.packbits(2 * ones > len(found), axis=1, bitorder="little").view("<u8").ravel()


def marks(found: np.ndarray) -> np.ndarray:
    """``MARKS`` words of 64 bits: whether an odd number of a set's shingles falls on a bit. Two
    sets differ in at least as many shingles as their marks do in bits."""
    odd = np.bincount(found.view(np.uint64) % np.uint64(64 * MARKS), minlength=64 * MARKS) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view("<i8")


def _sketches(batch: pa.RecordBatch) -> Iterator[dict]:
    keys, further, fps = [], [], []
    for text in batch.column("text").to_pylist():
        found = shingles(text)
        k, f = bands(found)
        keys.append(k.view(np.int64))
        further.append(f.ravel().view(np.int64))
        fps.append(fingerprint(found).view(np.int64))
    longs = pa.list_(pa.int64())
    yield {"node": batch.column("node"), "keys": pa.array(keys, longs), "further": pa.array(further, longs), "fp": pa.array(fps, longs)}


def _sets(batch: pa.RecordBatch) -> Iterator[dict]:
    longs = pa.list_(pa.int64())
    for node, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist(), strict=True):
        found = shingles(text)
        yield {"node": pa.array([node], pa.int64()), "found": pa.array([found.view(np.int64)], longs), "marks": pa.array([marks(found)], longs)}


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` that are similar enough, kept."""
    a = sets.select(F.col("node").alias("a"), F.col("found").alias("left"))
    b = sets.select(F.col("node").alias("b"), F.col("found").alias("right"))
    both = F.size(F.array_intersect("left", "right"))
    enough = both >= SIMILARITY * (F.size("left") + F.size("right") - both) - 1e-9
    return keep(pairs.join(a, "a").join(b, "b").filter(enough).select("a", "b"), "similar-links")


def _pairs(met: DataFrame) -> DataFrame:
    return met.select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b")).distinct()


def _worth() -> Column:
    """Whether two rows ``x`` and ``y`` may be similar and are not in one group yet."""
    bits = sum((F.bit_count(F.col(f"x.f{w}").bitwiseXOR(F.col(f"y.f{w}"))) for w in range(1, WORDS)), F.bit_count(F.col("x.f0").bitwiseXOR(F.col("y.f0"))))
    return (F.col("x.root") != F.col("y.root")) & (bits <= MOST_BITS)


def _by_pivots(sketches: DataFrame) -> DataFrame:
    """Pairs of texts whose first words of fingerprint are within four bits, each with one that
    is linked with it."""
    one = keep(sketches.groupBy("f0").agg(F.min("node").alias("node")), "similar-fingerprints")
    links = fingerprint_links(one.select(F.col("f0").alias("fp"))).filter("a <> b").distinct()
    x, y = one.select(F.col("f0").alias("a"), F.col("node").alias("x")), one.select(F.col("f0").alias("b"), F.col("node").alias("y"))
    far = links.join(x, "a").join(y, "b")
    same = sketches.join(one.withColumnRenamed("node", "y"), "f0").filter("node <> y").select(F.col("node").alias("x"), "y")
    return far.select("x", "y").unionByName(same).select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def _mixed(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Texts ``(node, root)``, kept, of crowded bands that hold texts of several groups."""
    rooted = rows.select("key", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    bands = rooted.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("least"), F.max("root").alias("most"))
    open_ = bands.filter((F.col("n") > NEXT + 2) & (F.col("least") < F.col("most"))).select("key")
    return keep(rooted.join(open_, "key").select("node", "root").distinct(), "similar-mixed")


def _rest(mixed: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of ``mixed`` of different groups that may be similar enough: none that is, is left out.

    Of two sets of a similarity of 0.8, each shares 0.8 of itself at least, so the first 0.2 of
    both (``first``), in one order of all shingles, have one in common. In the order of
    frequency these are mostly shingles that a text has for itself, and most texts do not meet.
    Where two do, the places of what they share and their marks bound how similar they are."""
    each = mixed.join(sets, "node").select("node", "root", F.size("found").alias("n"), F.explode("found").alias("shingle"))
    often = each.groupBy("shingle").agg(F.count("*").alias("often"))
    place = F.row_number().over(Window.partitionBy("node").orderBy("often", "shingle"))
    first = F.col("n") - F.ceil(SIMILARITY * F.col("n") - SLACK) + 1
    placed = each.join(often, "shingle").withColumn("place", place).filter((F.col("place") <= first) & (F.col("often") > 1))
    prefixes = keep(placed.drop("often"), "similar-prefixes")
    words = [F.get("marks", F.lit(w)).alias(f"m{w}") for w in range(MARKS)]
    placed = prefixes.join(mixed.join(sets, "node").select("node", *words), "node")
    # Of two groups one at least is not the most frequent one with that shingle.
    most = prefixes.groupBy("shingle", "root").agg(F.count("*").alias("n")).groupBy("shingle")
    most = most.agg(F.count("*").alias("groups"), F.max(F.struct("n", "root")).alias("m")).filter("groups > 1").select("shingle", F.col("m.root").alias("main"))
    told = keep(placed.join(most, "shingle").withColumn("odd", F.col("root") != F.col("main")).drop("main"), "similar-told")
    once = ~F.col("y.odd") | (F.col("x.node") < F.col("y.node"))
    both = F.least("x.place", "y.place") + F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    enough = both >= SIMILARITY / (1 + SIMILARITY) * (F.col("x.n") + F.col("y.n")) - SLACK
    apart = reduce(add, [F.bit_count(F.col(f"x.m{w}").bitwiseXOR(F.col(f"y.m{w}"))) for w in range(MARKS)])
    enough &= apart <= (1 - SIMILARITY) / (1 + SIMILARITY) * (F.col("x.n") + F.col("y.n")) + SLACK
    same = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.root") != F.col("y.root"))
    pairs = keep(_pairs(told.filter("odd").alias("x").join(told.alias("y"), same & once & enough)), "similar-rest")
    forget(prefixes, told)
    return pairs


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots``, kept, after further ``links`` of texts, some of which were in no group yet."""
    root_of = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
    linked = links.join(root_of("a"), "a", "left").join(root_of("b"), "b", "left")
    linked = keep(linked.select("a", "b", F.coalesce("a_root", "a").alias("x"), F.coalesce("b_root", "b").alias("y")), "similar-linked")
    merged = components(linked.select(F.col("x").alias("a"), F.col("y").alias("b")), "similar-components")
    merged = keep(merged.select(F.col("node").alias("root"), F.col("root").alias("whole")), "similar-merged")
    alone = linked.select(F.col("a").alias("node")).unionByName(linked.select(F.col("b").alias("node"))).distinct()
    every = roots.unionByName(alone.join(roots, "node", "left_anti").withColumn("root", F.col("node")))
    return keep(every.join(merged, "root", "left").select("node", F.coalesce("whole", "root").alias("root")), "similar-groups")


def groups(docs: DataFrame) -> DataFrame:
    """Rows ``(node, root)``, kept: the texts (by ``node_of``) that have a near copy, and the
    smallest node that links reach. A text without one is left out."""
    longs = "array<long>"
    texts = docs.select(node_of("text").alias("node"), F.col("text").cast("binary").alias("text"))
    sketches = by_batch(texts, _sketches, f"node long, keys {longs}, further {longs}, fp {longs}").dropDuplicates(["node"])
    words = [F.get("fp", F.lit(w)).alias(f"f{w}") for w in range(WORDS)]
    sketches = keep(sketches.select("node", "keys", "further", *words), "similar-sketches")
    each = sketches.select("node", F.posexplode("keys").alias("band", "key"))
    shared = each.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    met = keep(each.join(shared, "key"), "similar-met")
    order = [F.get("further", F.col("band") * FURTHER + i).alias(f"s{i}") for i in range(FURTHER)]
    rows = met.join(sketches.drop("keys"), "node").select("key", "node", *[f"f{w}" for w in range(WORDS)], *order)
    placed = ranked(rows, ["key", *[f"s{i}" for i in range(FURTHER)], "node"], "similar-placed").drop(*[f"s{i}" for i in range(FURTHER)])
    placed = keep(placed, "similar-rows")
    close = keep(_by_pivots(sketches.select("node", "f0")), "similar-close")
    wanted = met.select("node").unionByName(close.select(F.col("a").alias("node"))).unionByName(close.select(F.col("b").alias("node"))).distinct()
    sets = by_batch(texts.join(wanted, "node", "left_semi"), _sets, f"node long, found {longs}, marks {longs}").dropDuplicates(["node"])
    sets = keep(sets, "similar-sets")

    def follow(rows: DataFrame, steps: range) -> DataFrame:
        """Rows with those so many places after them in their band."""
        x = rows.withColumn("at", F.explode(F.array([F.col("rank") + s for s in steps])))
        same = (F.col("x.at") == F.col("y.rank")) & (F.col("x.key") == F.col("y.key"))
        return x.alias("x").join(rows.alias("y"), same & _worth())

    beside = _pairs(follow(placed.withColumn("root", F.col("node")), range(1, 2)))
    first = _verified(close.unionByName(beside).distinct(), sets)
    forget(sketches, met, close)
    roots = keep(components(first, "similar-components"), "similar-roots")
    rows = keep(placed.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "similar-rooted")
    forget(first, placed)

    sizes = roots.groupBy("root").agg(F.count("*").alias("n"))
    columns = ["node", "root", *[f"f{w}" for w in range(WORDS)]]
    largest = F.max(F.struct(F.coalesce("n", F.lit(1)).alias("n"), *columns)).alias("y")
    hubs = rows.join(sizes, "root", "left").groupBy("key").agg(largest).select("key", *[f"y.{c}" for c in columns])
    with_hub = rows.alias("x").join(hubs.alias("y"), (F.col("x.key") == F.col("y.key")) & _worth())
    second = _verified(_pairs(with_hub).unionByName(_pairs(follow(rows, range(2, NEXT + 2)))).distinct(), sets)
    found = _merged(roots, second)

    # What crowded bands have left.
    mixed = _mixed(rows, found)
    if not mixed.isEmpty():
        found = _merged(found, _verified(_rest(mixed, sets), sets))
    forget(rows, sets, mixed)
    return found
