"""Registry of the queries and of the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.skew import is_small

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function under ``name`` or its own name, with its SQL."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql:
            ORACLE[key] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SPLIT_BYTES = 128 << 20


def spread(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table for work that is heavy per row. Input that fits one scan split, and so would
    be one task, is first spread over the cores; larger input has tasks enough."""
    rows = table(spark, sf_dir, name)
    if is_small(rows, SPLIT_BYTES):
        return rows.repartition(spark.sparkContext.defaultParallelism)
    return rows


def stamp(c: Column | str) -> Column:
    """Timestamp as text with microseconds."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
