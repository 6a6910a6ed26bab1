"""Near-duplicate embeddings: Euclidean p-stable hashing, then exact cosines.

Vectors are normalised, so a cosine of 0.9 is a distance of 0.447. Each of ``TABLES``
tables hashes a vector by ``PROJECTIONS`` Gaussian projections, shifted at random and
quantised to steps of ``WIDTH``; vectors with equal codes in a table are compared by exact
cosine in double precision. At a cosine of just 0.9 one projection agrees with probability
0.82, a table with 0.092 and at least one of 32 tables with 0.955; closer pairs are found
with a higher probability (0.99 at a cosine of 0.925). Two vectors at right angles share a
table with probability 0.0003.

Equal vectors are one class with a weight. A pair is counted in the first table where its
codes agree, so every link counts once. A bucket of more than ``block`` classes is cut into
blocks and each two of its blocks are compared by one task, so no task holds a hot bucket;
links are summed in the task and never written out. At first only ids with a sketch of
``SKETCH`` signs of further projections meet in the buckets. At a cosine of 0.9 signs differ in
18 of 128 with a deviation of 4, at right angles in 64; a vector goes on to a bucket only if
another one there differs in at most ``SIGNS`` (at 0.9 all but one pair in ten million do). So
vectors are fetched just where they have a likely partner.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import by_batch, by_runs, components, keep, parts, small

cloudpickle.register_pickle_by_value(sys.modules[__name__])

COSINE = 0.9
TABLES = 32
PROJECTIONS = 12
WIDTH = 2.0
BLOCK = 2048
SKETCH, SIGNS = 128, 40
SEED = 11


def _unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _family(dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, dims])
    k = TABLES * PROJECTIONS
    odd = rng.integers(0, 1 << 63, size=(TABLES, PROJECTIONS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return rng.standard_normal((dims, k)), rng.uniform(0, WIDTH, k), odd


def codes(units: np.ndarray) -> np.ndarray:
    """A 32-bit code per row and table, from its quantised projections."""
    lines, shift, odd = _family(units.shape[1])
    steps = np.floor((units @ lines + shift) / WIDTH).astype(np.int64).astype(np.uint64)
    mixed = (steps.reshape(len(units), TABLES, PROJECTIONS) * odd[None]).sum(axis=2, dtype=np.uint64)
    return (mixed >> np.uint64(32)).astype(np.uint32)


def sketches(units: np.ndarray) -> np.ndarray:
    """Signs of ``SKETCH`` projections of each row, as words of 64 bits."""
    lines = np.random.default_rng([SEED, 1, units.shape[1]]).standard_normal((units.shape[1], SKETCH))
    return np.packbits(units @ lines > 0, axis=1, bitorder="little").view("<u8")


def _coded(batch: pa.RecordBatch) -> Iterator[dict]:
    """Per vector its codes, and the bucket of each table: table, length and code in one number."""
    lists = batch.column("embedding")
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    wide = lists.type.value_type.bit_width // 8
    for dims in np.unique(sizes):
        mine = pa.array(np.flatnonzero(sizes == dims))
        sub = lists.take(mine)
        v = sub.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
        unit = _unit(v)
        code, sketch = codes(unit), sketches(unit)
        keys = code.astype(np.int64) + ((np.arange(TABLES) * 65536 + np.int64(dims % 65536)) << np.int64(32))
        yield {
            "cid": batch.column("cid").take(mine),
            "n": batch.column("n").take(mine),
            "wide": np.full(len(v), wide, dtype=np.int32),
            "codes": pa.array([r.tobytes() for r in code], pa.binary()),
            "sketch": pa.array([r.tobytes() for r in sketch], pa.binary()),
            "keys": pa.ListArray.from_arrays(np.arange(len(v) + 1, dtype=np.int32) * TABLES, keys.ravel()),
            "vector": pa.array([r.tobytes() for r in v], pa.binary()),
        }


def _likely(rows: pa.Table) -> Iterator[dict]:
    """Rows of each cell that have another one with a close sketch there."""
    key, cell = rows.column("key").to_numpy(), rows.column("cell").to_numpy()
    cuts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (cell[1:] != cell[:-1]), [True]]))
    home, other = rows.column("home").to_numpy(), rows.column("other").to_numpy()
    sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), "<u8").reshape(-1, SKETCH // 64)
    keep_row = np.zeros(len(key), dtype=bool)
    for at, to in zip(cuts[:-1], cuts[1:], strict=True):
        if to - at < 2:
            continue
        mine, where = sketch[at:to], home[at:to]
        mixed = other[at] != home[at]  # two blocks: only pairs across
        for s in range(0, to - at, 512):
            near = np.bitwise_count(mine[s : s + 512, None] ^ mine[None]).sum(2) <= SIGNS
            near[np.arange(len(near)), s + np.arange(len(near))] = False
            if mixed:
                near &= where[s : s + 512, None] != where[None]
            keep_row[at + s : at + s + len(near)] |= near.any(1)
    rows = rows.filter(pa.array(keep_row)).select(["cid", "key", "tab", "home", "other", "cell"])
    yield {c: rows.column(c).combine_chunks() for c in rows.column_names}


def _labels(i: np.ndarray, j: np.ndarray, cid: np.ndarray) -> np.ndarray:
    """Smallest id reachable over the pairs, by repeated exchange of the smaller label."""
    label = cid.copy()
    while True:
        low = label.copy()
        np.minimum.at(low, i, label[j])
        np.minimum.at(low, j, low[i])
        if (low == label).all():
            return label
        label = low


def _cell_links(cosine: float):
    def links(rows: pa.Table) -> Iterator[dict]:
        key, cell = rows.column("key").to_numpy(), rows.column("cell").to_numpy()
        cuts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (cell[1:] != cell[:-1]), [True]]))
        for at, to in zip(cuts[:-1], cuts[1:], strict=True):
            if to - at < 2:
                continue
            run = rows.slice(at, to - at)
            tab, cid = int(run.column("tab")[0].as_py()), run.column("cid").to_numpy()
            n, home = run.column("n").to_numpy(), run.column("home").to_numpy()
            kind = "<f4" if run.column("wide")[0].as_py() == 4 else "<f8"
            unit = _unit(np.array([np.frombuffer(b, kind) for b in run.column("vector").to_pylist()]))
            code = np.array([np.frombuffer(b, np.uint32) for b in run.column("codes").to_pylist()])
            mixed = run.column("other")[0].as_py() != home[0]  # two blocks: only pairs across
            ii, jj = [], []
            for s in range(0, len(cid), 512):
                near = unit[s : s + 512] @ unit.T >= cosine
                i, j = np.nonzero(near)
                i = i + s
                ok = i < j
                if mixed:
                    ok &= home[i] != home[j]
                i, j = i[ok], j[ok]
                for t in range(tab):  # counted where they met first
                    fresh = code[i, t] != code[j, t]
                    i, j = i[fresh], j[fresh]
                ii.append(i)
                jj.append(j)
            i, j = np.concatenate(ii), np.concatenate(jj)
            if not len(i):
                continue
            found = np.bincount(i, n[j], len(cid)) + np.bincount(j, n[i], len(cid))
            has = found > 0
            yield {"cid": cid[has], "links": found[has].astype(np.int64), "root": _labels(i, j, cid)[has]}

    return links


def near_vectors(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links`` (other rows with a cosine of at least
    ``cosine`` that share a bucket, and all equal vectors), ``component_id`` (smallest vec_id
    reachable) and ``kept`` (the row is that one).

    Null vectors, zero vectors and those with null or non-finite components link with
    nothing. Vectors of different lengths never link. Repeated rows are equal vectors; rows
    that repeat the vec_id too are all kept. A null vec_id is never the smallest; alone it
    has a null component and ``kept`` is false. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", "embedding")
    fine = F.coalesce(
        F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0),
        F.lit(False),
    )
    classes = keep(
        rows.filter(fine)
        .groupBy("embedding")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
        .withColumn("cid", F.monotonically_increasing_id()),
        "embed-classes",
    )
    coded = keep(
        by_batch(
            classes.select("cid", "n", "embedding"),
            _coded,
            "cid long, n long, wide int, codes binary, sketch binary, keys array<long>, vector binary",
        ),
        "embed-coded",
    )
    buckets = coded.select("cid", "sketch", F.explode("keys").alias("key"))
    hot = buckets.groupBy("key").agg(F.count("*").alias("size")).filter(F.col("size") > block)
    hot = small(keep(hot.select("key", F.ceil(F.col("size") / block).alias("blocks")), "embed-hot"))
    cells = (
        buckets.join(hot, "key", "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
        .withColumn("tab", F.shiftright("key", 48).cast("int"))
        .withColumn("home", F.pmod(F.xxhash64("cid"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("cell", F.least("home", "other") * F.col("blocks") + F.greatest("home", "other"))
    )

    def by_cell(rows: DataFrame) -> DataFrame:
        return rows.repartition(parts(spark), "key", "cell").sortWithinPartitions("key", "cell", "cid")

    place = "cid long, key long, tab int, home long, other long, cell long"
    likely = keep(by_runs(by_cell(cells.drop("blocks")), ["key", "cell"], _likely, place), "embed-likely")
    dealt = by_cell(likely.join(coded.select("cid", "n", "wide", "codes", "vector"), "cid"))
    found = keep(by_runs(dealt, ["key", "cell"], _cell_links(cosine), "cid long, links long, root long"), "embed-links")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")), "embed-components")
    linked = (
        classes.join(links, "cid", "left")
        .join(roots, F.col("cid") == F.col("node"), "left")
        .select("embedding", "least", F.coalesce("root", "cid").alias("root"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    least = linked.groupBy("root").agg(F.min("least").alias("component"))
    linked = linked.join(least, "root").select("embedding", "n_links", "component")
    good = rows.filter(fine).join(linked, "embedding").select("vec_id", "n_links", F.col("component").alias("component_id"))
    bad = rows.filter(~fine).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(bad).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )
