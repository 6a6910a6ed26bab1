"""Registered queries of the operators here, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terrace.llm import decontam, embed, langid, lines, mixing, prefixes, ranking, secrets, sharding, simhash, suffix, toxicity, warc
from terrace.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return register


@query()
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.assign(table(spark, sf_dir, "documents")).drop("row_key")


@query()
def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every embedding."""
    return embed.near_vectors(table(spark, sf_dir, "embeddings"))


@query(decontam.SQL)
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words and items in every document."""
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(secrets.SQL)
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secrets.secrets(table(spark, sf_dir, "documents"))


@query(mixing.SQL)
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every use of a document in the mixture."""
    return mixing.mixture(table(spark, sf_dir, "documents"))


@query(warc.SQL)
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to a WARC archive and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query()
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return langid.identify(table(spark, sf_dir, "documents"))


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op10_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated bytes."""
    return suffix.without_repeats(table(spark, sf_dir, "documents"))


@query(lines.SQL)
def op13_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without lines that many documents share."""
    return lines.without_shared_lines(table(spark, sf_dir, "documents"))


@query(ranking.SQL)
def op12_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best documents of every benchmark item."""
    return ranking.best_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(prefixes.SQL)
def op11_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of rebuilt conversations."""
    return prefixes.prefix_nodes(table(spark, sf_dir, "conversations"))
