"""Shards that each hold the mixture of the whole: proportional stratified interleaving.

Rows are shuffled by a seeded hash within their source and ranked there; the rank divided
by the size of the source is a row's fractional rank. In the order of fractional ranks
every stretch holds each source in proportion, so cutting that order into equal stretches
gives shards whose counts differ by at most one and whose mixture is that of the corpus: a
source with the share ``p`` among ``S`` sources is off by at most ``1 + p S`` rows a shard.

Both rankings deal rows by range, so a source with a third of all rows is spread over all
tasks. Only ids, sizes and hashes are ranked; texts stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import boxed, keep, ranked

SHARDS = 16
SEED = 7


def _row_key(df: DataFrame) -> Column:
    """Hash of a whole row: rows with one doc_id and one key are the same row repeated."""
    return F.xxhash64(F.lit(SEED), *[F.col(f"`{c}`") for c in ("doc_id", "text", "source")])


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard`` and
    the internal ``row_key``.

    ``size`` is the UTF-8 length of the text plus one (null: one), ``text_crc32`` that of
    the text (null: 0). The law is ``rows``; ``slot`` counts from 0 in each shard, in an
    order that interleaves the sources. Null sources are a source of their own; rows that
    are equal take any of their places; fewer rows than shards leave shards empty.
    """
    narrow = keep(
        docs.select(
            "doc_id",
            "source",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
            F.coalesce(F.crc32("text"), F.lit(0).cast("long")).alias("text_crc32"),
            _row_key(docs).alias("row_key"),
        ),
        "shard-rows",
    )
    within = ranked(narrow, ["source", "row_key", "doc_id"], "shard-within")
    sources = within.groupBy("source").agg(F.min("rank").alias("lo"), F.count("*").alias("n"))
    frac = (F.col("rank") - F.col("lo") + 0.5) / F.col("n")
    placed = (
        within.alias("w")
        .join(sources.alias("s"), F.col("w.source").eqNullSafe(F.col("s.source")))
        .select("w.doc_id", "w.size", "w.text_crc32", "w.row_key", frac.alias("frac"), F.xxhash64("w.source").alias("tie"))
    )
    order = ranked(placed, ["frac", "tie", "row_key", "doc_id"], "shard-order")
    total = narrow.count()
    # Whole-number division: floor(rank * shards / total), and the first rank of a shard.
    shard = F.expr(f"(rank * {shards}) div {max(1, total)}")
    first = F.expr(f"((shard * {total}L) + {shards - 1}) div {shards}")
    return (
        order.withColumn("shard", shard)
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("rank") - first).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "row_key",
        )
    )


def _free(name: str, taken: list[str]) -> str:
    while name.lower() in {c.lower() for c in taken}:
        name = f"_{name}"
    return name


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``, or these names after as many ``_`` as make them new
    where the documents have such a column already. Rows that are equal are numbered and take
    the places of equal rows by number; none is gathered."""
    names = [_free(c, docs.columns) for c in ("shard", "slot")]
    same = Window.partitionBy("doc_id", "row_key")
    places = assign(docs, shards).withColumn("nth", F.row_number().over(same.orderBy("shard", "slot")))
    rows = docs.select(boxed(docs).alias("doc"), "doc_id", _row_key(docs).alias("row_key"))
    rows = rows.withColumn("nth", F.row_number().over(same.orderBy("row_key")))
    match = F.col("r.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("r.row_key") == F.col("p.row_key")) & (F.col("r.nth") == F.col("p.nth"))
    return rows.alias("r").join(places.alias("p"), match).select("r.doc.*", F.col("p.shard").alias(names[0]), F.col("p.slot").alias(names[1]))
