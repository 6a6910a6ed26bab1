"""The corpus pipeline: documents in, shards of a mixed and cleaned corpus out.

Each stage works on what the one before kept, written as Parquet and read again. All but
the last return the columns of documents; the last adds ``shard`` and ``slot``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import decontam, mixing, sharding, similar, toxicity
from terrace.llm.common import boxed, keep, row_hash, small, table
from terrace.sources.places import new_dir


def _rejected(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id and text (by ``key``, its xxhash64) are in
    ``gone``; a null doc_id is an id too. Few keys go to where the texts are; many are joined
    by shuffle."""
    keys = small(keep(gone.select("doc_id", "key").distinct(), "pipeline-rejected"))
    same = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.xxhash64("d.text") == F.col("g.key"))
    return docs.alias("d").join(keys.alias("g"), same, "left_anti")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject."""
    found = toxicity.score(docs, table(spark, sf_dir, "labels"), keyed=True)
    return _rejected(docs, found.filter("predicted = 1"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies (exact copies are one text) the row with the smallest
    doc_id; a row without a doc_id only if the whole group has none, and of rows that repeat
    a doc_id the one with the smallest hashes. Texts count, not ids: different texts under one
    id are kept or dropped each for itself."""
    groups = similar.groups(docs)
    rows = docs.select(boxed(docs).alias("doc"), "doc_id", similar.node_of("text").alias("node"), row_hash(docs).alias("row"))
    names = rows.groupBy("doc_id", "node", "row").agg(F.count("*").alias("n"))
    each = names.join(groups, "node", "left").groupBy(F.coalesce("root", "node").alias("root"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node", "row", "n")).alias("r")
    chosen = keep(each.agg(first).select("r.doc_id", "r.node", "r.row", "r.n"), "pipeline-chosen")

    def named(some: DataFrame) -> DataFrame:
        same = [F.col(f"d.{c}").eqNullSafe(F.col(f"c.{c}")) for c in ("node", "row", "doc_id")]
        return rows.alias("d").join(some.alias("c"), same, "left_semi")

    once = named(chosen.filter("n = 1"))
    again = named(small(keep(chosen.filter("n > 1"), "pipeline-repeated"))).dropDuplicates(["doc_id", "node", "row"])
    return once.unionByName(again).select("doc.*")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    found = decontam.contamination(docs, table(spark, sf_dir, "benchmark"), keyed=True)
    return _rejected(docs, found.filter("contaminated"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks: at least once, so none is lost."""
    return mixing.mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with shard and slot."""
    return sharding.shard(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("simhash_dedup", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


# SimHash and the learned score cannot be written in SQL.
ORACLE_SQL = None
