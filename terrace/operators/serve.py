"""Serving: full refresh of a sink with row-count verification."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_SIZE = 10_000
CONNECTIONS = 4


class LoadError(RuntimeError):
    """A table did not arrive whole."""


def content_digest(df: DataFrame) -> tuple[int, int, int]:
    """Number of rows, and the sum and the exclusive or of two hashes of every row: equal for
    frames with the same rows as often, in any order of rows and columns. One pass, summed where
    the rows are; only three numbers are shuffled per task."""

    def plain(c: str) -> Column:
        kind = df.schema[c].dataType.simpleString()
        return F.to_json(F.struct(F.col(f"`{c}`").alias("v"))) if "map<" in kind or "variant" in kind else F.col(f"`{c}`")

    # A null takes part by its place, so that it does not equal a null of another column.
    columns = [x for c in sorted(df.columns) for x in (F.col(f"`{c}`").isNull(), plain(c))]
    first, second = F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)
    row = df.agg(F.count(F.lit(1)), F.sum(first.cast("decimal(20,0)")), F.bit_xor(second)).first()
    return int(row[0]), int(row[1] or 0), int(row[2] or 0)


def refresh(
    df: DataFrame,
    write: Callable[[DataFrame], None],
    count: Callable[[], int],
    verify: bool = True,
    read: Callable[[], DataFrame] | None = None,
) -> int | None:
    """Run ``write``; with ``verify`` the sink must then count as many rows as ``df``, and if it
    can be ``read`` back, hold the same rows."""
    expected = (content_digest(df) if read else (df.count(),)) if verify else None
    write(df)
    if not verify:
        return None
    if (actual := count()) != expected[0]:
        raise LoadError(f"expected {expected[0]} rows, the sink has {actual}")
    if read and content_digest(read()) != expected:
        raise LoadError(f"the sink has {actual} rows as expected, but not the same ones")
    return expected[0]


def jdbc_count(spark: SparkSession, url: str, table: str, properties: Mapping[str, str]) -> int:
    query = f"(SELECT COUNT(*) AS n FROM {table}) t"
    return int(spark.read.jdbc(url, query, properties=dict(properties)).first()[0])


def refresh_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    verify: bool = True,
    batch_size: int = BATCH_SIZE,
    connections: int = CONNECTIONS,
) -> int | None:
    """Full refresh over JDBC: truncate and insert, at most ``connections`` at a time."""
    props = dict(properties or {})

    def write(rows: DataFrame) -> None:
        (
            rows.write.mode("overwrite")
            .option("truncate", "true")
            .option("batchsize", batch_size)
            .option("numPartitions", connections)
            .jdbc(url, table, properties=props)
        )

    return refresh(df, write, lambda: jdbc_count(df.sparkSession, url, table, props), verify)


def load_all(tables: Iterable[str], load: Callable[[str], object]) -> None:
    """Load every table; go on past a failing one and raise with the list at the end."""
    failed = {}
    for table in tables:
        try:
            load(table)
        except Exception as e:  # noqa: BLE001 - every failure is reported below
            failed[table] = e
    if failed:
        detail = "; ".join(f"{t}: {str(e).splitlines()[0]}" for t, e in failed.items())
        raise LoadError(f"{len(failed)} tables failed: {detail}")
