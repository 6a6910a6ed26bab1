"""Batch write strategies: append/overwrite, merge (upsert) and slice replacement."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.sources.places import shared_dir
from terrace.sources.tables import (
    partition_folder,
    read_snapshot,
    require_columns,
    snapshot_of,
    write_snapshot,
)


def write_append(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
) -> None:
    """Append to (or overwrite) a plain table."""
    writer = df.write.format(fmt).mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def _same(a: str, b: str, cols: Sequence[str]):
    return reduce(and_, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols])


def _without(rows: DataFrame, gone: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows whose ``cols`` are not in ``gone`` (null equals null)."""
    return rows.alias("a").join(gone.select(*cols).alias("b"), _same("a", "b", cols), "left_anti")


def _settled(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared folder, so that what is read of it twice is the same
    also after an executor is lost."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def _folders(df: DataFrame, partition_by: Sequence[str]) -> set[str]:
    """Partition folders that ``df`` has rows in (metadata: one entry per partition)."""
    if not partition_by:
        return {""}
    values = df.select(*partition_by).distinct().collect()
    return {partition_folder(partition_by, row) for row in values}


def write_merge(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    newer_by: str | None = None,
    batch: tuple[str, str, int] | None = None,
    fmt: str = "parquet",
    feed: bool = False,
    unique: bool = False,
) -> None:
    """Upsert: rows with the same keys (and partition) are replaced, others are added.

    Two rows of ``df`` with one key are an error, also if they are equal; a caller that made
    one row per key says ``unique`` and saves the count. Only partitions that ``df`` touches are read and written
    again. With ``newer_by`` a stored row that is newer than its update stays; no time is
    older than any. ``batch`` (stream, its run, number) makes a repeated batch of the run a
    no-op; a new run starts over. ``fmt`` is the file format of a table that is new. With
    ``feed`` the table gets a change feed, which every later write goes on with; a stored row
    that is replaced by an equal one is no change.
    """
    spark = df.sparkSession
    snap = snapshot_of(spark, path)
    on = list(dict.fromkeys([*keys, *partition_by]))
    if snap is None and unique and not feed:
        write_snapshot(df, path, None, partition_by, batch=batch, fmt=fmt)
        return
    df = _settled(df)
    if not unique and not df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").isEmpty():
        raise ValueError(f"several rows for one key ({', '.join(on)}) in an update of {path}")
    if snap is None:
        write_snapshot(df, path, None, partition_by, batch=batch, fmt=fmt, changes=df if feed else None)
        return
    run, number = snap.batches.get(batch[0], (None, -1)) if batch else (None, -1)
    if batch and run == batch[1] and number >= batch[2]:
        return
    require_columns(df, snap, path)
    touched = _folders(df, partition_by)
    target = read_snapshot(spark, path, snap, touched)
    fresh = df
    if newer_by:
        stale = (
            target.select(*on, newer_by).alias("a")
            .join(df.select(*on, newer_by).alias("b"), _same("a", "b", on))
            .filter(
                (F.col(f"a.{newer_by}") > F.col(f"b.{newer_by}"))
                | (F.col(f"a.{newer_by}").isNotNull() & F.col(f"b.{newer_by}").isNull())
            )
            .select("b.*")
        )
        fresh = _without(df, stale, on)
    new = _without(target, fresh, on).unionByName(fresh)
    changes = None
    if snap.feed:
        changes = _without(fresh, target, [*on, *[c for c in df.columns if c not in on]])
    elif feed:
        rest = set(snap.partitions) - touched
        changes = new.unionByName(read_snapshot(spark, path, snap, rest)) if rest else new
    write_snapshot(new, path, snap, partition_by, touched, batch, changes=changes)


def write_replace(
    df: DataFrame, path: str, by: Sequence[str], partition_by: Sequence[str] = (), fmt: str = "parquet"
) -> None:
    """Replace the slices that ``df`` holds: every stored row whose ``by`` values occur in
    ``df`` goes, all rows of ``df`` come. An empty ``df`` changes nothing. ``fmt`` is the
    file format of a table that is new."""
    spark = df.sparkSession
    snap = snapshot_of(spark, path)
    df = _settled(df)
    if df.isEmpty():
        return
    if snap is None:
        write_snapshot(df, path, None, partition_by, fmt=fmt)
        return
    require_columns(df, snap, path)
    slices = df.select(*by).distinct()
    touched = _folders(df, partition_by)
    if not set(partition_by) <= set(by):
        # A slice may also have rows in partitions that the new rows are not in.
        columns = read_snapshot(spark, path, snap).select(*dict.fromkeys([*by, *partition_by]))
        old = columns.alias("a").join(slices.alias("b"), _same("a", "b", by), "left_semi")
        touched |= _folders(old, partition_by)
    target = read_snapshot(spark, path, snap, touched)
    changes = df.exceptAll(target.select(*df.columns)) if snap.feed else None
    write_snapshot(_without(target, slices, by).unionByName(df), path, snap, partition_by, touched, changes=changes)


def write_overwrite(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet"
) -> None:
    """Make ``df`` the whole table; readers of the old state are not disturbed. A change feed goes
    on with the rows that are new; it cannot go on with other columns."""
    snap = snapshot_of(df.sparkSession, path)
    changes = None
    if snap and snap.feed:
        require_columns(df, snap, path)
        df = _settled(df)
        changes = df.exceptAll(read_snapshot(df.sparkSession, path, snap).select(*df.columns))
    write_snapshot(df, path, snap, partition_by, fmt=snap.fmt if changes is not None else fmt, changes=changes)
