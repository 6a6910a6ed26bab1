"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.sources.places import new_dir

# Ship the code with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, is computed
    once, and survives lost executors."""
    spark, path = df.sparkSession, new_dir(df.sparkSession, name)
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.kept_at = path
    return kept


def boxed(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that their names clash with nothing; ``select("x.*")``
    unpacks it."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])


def row_hash(df: DataFrame) -> Column:
    """Hash of a whole row, also with types that have no hash of their own (maps, variants)."""

    def plain(c: str) -> Column:
        kind, column = df.schema[c].dataType.simpleString(), F.col("`" + c.replace("`", "``") + "`")
        return F.to_json(F.struct(column.alias("v"))) if "map<" in kind or "variant" in kind else column

    return F.xxhash64(*map(plain, df.columns))


def forget(*kept: DataFrame) -> None:
    """Remove kept tables that nothing reads any more."""
    for df in kept:
        if path := getattr(df, "kept_at", None):
            spark = df.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def parts(spark: SparkSession) -> int:
    """Number of partitions the session shuffles into."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def by_batch(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``fn`` turns each Arrow batch of ``df`` into an iterator of column dictionaries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in fn(batch):
                yield pa.RecordBatch.from_pydict(columns)

    return df.mapInArrow(run, schema)


def by_runs(
    df: DataFrame,
    keys: Sequence[str],
    fn: Callable,
    schema: str,
    limit: int | None = None,
    over: Callable | None = None,
) -> DataFrame:
    """Apply ``fn`` to blocks of whole runs of equal ``keys`` in a frame that is partitioned
    and sorted by them. A task holds one Arrow batch and one run at a time; a run that goes
    on over batches and passes ``limit`` rows is not held, its pieces go to ``over``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the run that the last batch ended with
        last_key, passing = None, False

        def out(call: Callable, some: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if sum(b.num_rows for b in some):
                for columns in call(pa.Table.from_batches(some)):
                    yield pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = np.zeros(batch.num_rows, dtype=bool)
            for k in keys:
                c = batch.column(k).to_numpy(zero_copy_only=False)
                fresh[1:] |= c[1:] != c[:-1]
            first_key = tuple(batch.column(k)[0].as_py() for k in keys)
            fresh[0] = first_key != last_key
            starts = np.flatnonzero(fresh)
            last_key = tuple(batch.column(k)[-1].as_py() for k in keys)
            end_of_old = int(starts[0]) if len(starts) else batch.num_rows
            if end_of_old:
                held.append(batch.slice(0, end_of_old))
            if limit and sum(b.num_rows for b in held) > limit or passing:
                passing = True
                yield from out(over, held)
                held = []
            if not len(starts):
                continue
            yield from out(fn, held)
            passing, last = False, int(starts[-1])
            yield from out(fn, [batch.slice(end_of_old, last - end_of_old)])
            held = [batch.slice(last)]
        yield from out(over if passing else fn, held)

    return df.mapInArrow(run, schema)


def ranked(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``rank``: the place of each row (from 0) in the order of ``order`` over
    the whole frame. Rows are dealt by range, so no task holds more than its share; only
    one count per partition is gathered."""
    spark = df.sparkSession
    dealt = df.repartitionByRange(parts(spark), *order).sortWithinPartitions(*order)
    placed = keep(dealt.withColumn("_at", F.monotonically_increasing_id()), name)
    # Spark's identifier: the partition above 33 bits for the place in it.
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    counts = sorted((r["_part"], r["n"]) for r in placed.groupBy("_part").agg(F.count("*").alias("n")).collect())
    before, rows = 0, []
    for part, n in counts:
        rows.append((part, before))
        before += n
    starts = spark.createDataFrame(rows, "_part long, _before long")
    return (
        placed.join(F.broadcast(starts), "_part")  # one row per shuffle partition
        .withColumn("rank", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1))
        .drop("_part", "_at", "_before")
    )


def components(edges: DataFrame, name: str) -> DataFrame:
    """Smallest node of each connected component: rows ``(node, root)`` for every node of
    ``edges (a, b)``, by alternating large-star and small-star steps. Each step is two
    joins over the links; a node with many links is never gathered. Only the links of the last
    step stay on disk."""
    edges = keep(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        name,
    )
    seen = None
    while True:
        state = edges.agg(
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")
        ).collect()[0]
        if state == seen or not state["n"]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root"))
            ).groupBy("node").agg(F.min("root").alias("root"))
        seen = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        before, edges = edges, keep(small.filter("a <> b").distinct(), name)
        forget(before)


SMALL_BYTES = 32 << 20


def small(df: DataFrame, limit: int = SMALL_BYTES) -> DataFrame:
    """``df``, a kept table, marked for broadcast if its measured size is within ``limit``;
    otherwise as it is, for a shuffled join."""
    row = df.agg(
        F.count("*").alias("n"),
        *[F.sum(F.octet_length(F.col(c).cast("string"))).alias(f"_{i}") for i, c in enumerate(df.columns)],
    ).collect()[0]
    width = 16 * (len(df.columns) + 2)
    size = row["n"] * width + sum(v or 0 for v in row[1:])
    return F.broadcast(df) if size <= limit else df
