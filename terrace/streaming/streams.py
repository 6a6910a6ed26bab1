"""Stream operators and sinks. Every run drains what is available and stops."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from terrace.operators.shape import latest_per_key, row_order
from terrace.operators.write import write_merge
from terrace.sources.places import read_text
from terrace.sources.topics import read_topic

LATENESS = "30 minutes"


def dedup_stream(
    df: DataFrame, keys: Sequence[str], time_column: str, lateness: str = LATENESS
) -> DataFrame:
    """First row per key within the watermark; rows behind the watermark are dropped."""
    return df.withWatermark(time_column, lateness).dropDuplicatesWithinWatermark(list(keys))


def set_aside(records: DataFrame, kept: DataFrame, keys: Sequence[str], time_column: str) -> DataFrame:
    """What :func:`dedup_stream` left out of ``records``, given the table it was ``kept`` in: all
    columns and ``reason``, ``repeated`` where the table has a row of the key, else ``late``.

    Both are batches. Records of one key and time are numbered on both sides and leave as many as
    the table has, so the records set aside and those kept add up to all of them. Only keys,
    times and the records themselves are shuffled, once.
    """
    at = [*keys, time_column]
    order = row_order(records, skip=tuple(at)) or [F.lit(1)]
    numbered = records.withColumn("_nth", F.row_number().over(Window.partitionBy(*at).orderBy(*order)))
    there = kept.select(*at).withColumn("_nth", F.row_number().over(Window.partitionBy(*at).orderBy(F.lit(1))))

    def same(columns: Sequence[str]):
        return [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in columns]

    gone = numbered.alias("a").join(there.alias("b"), same([*at, "_nth"]), "left_anti").drop("_nth")
    known = kept.select(*keys).distinct().withColumn("_known", F.lit("repeated"))
    reason = F.coalesce("b._known", F.lit("late")).alias("reason")
    return gone.alias("a").join(known.alias("b"), same(keys), "left").select("a.*", reason)


def start_append(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    output_mode: str = "append",
    per_file: int | None = None,
) -> StreamingQuery:
    """Append a stream to a plain table, exactly once per checkpoint; files of at most
    ``per_file`` rows."""
    writer = (
        df.writeStream.format(fmt)
        .outputMode(output_mode)
        .option("maxRecordsPerFile", per_file or 0)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    return (writer.partitionBy(*partition_by) if partition_by else writer).start(path)


def start_limited(
    spark: SparkSession, topic: str, chunks: str, checkpoint: str, records: int, fmt: str = "parquet"
) -> DataFrame:
    """A folder topic as a stream of at most ``records`` messages per micro-batch, however large
    its files are. What is new in the topic is first copied, exactly once per checkpoint, to
    files of at most so many messages in ``chunks``; the stream takes one of these at a time."""
    start_append(read_topic(spark, topic, fmt=fmt), chunks, checkpoint, fmt=fmt, per_file=records).awaitTermination()
    return read_topic(spark, chunks, fmt=fmt, per_trigger=1)


def start_upsert(
    df: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    newer_by: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    feed: bool = False,
) -> StreamingQuery:
    """Merge a stream into a snapshot table, newest row per key by ``newer_by``.

    The stored row takes part in the comparison, so an old row in a later batch does not
    win. The number of a batch is stored with the state together with the query's own id,
    which lives in the checkpoint: a replayed batch changes nothing, and after a reset of
    the checkpoint all batches count again. With ``feed`` the table has a change feed, so that
    further streams can read it.
    """
    on = list(dict.fromkeys([*keys, *partition_by]))
    order = [F.col(newer_by).desc_nulls_last(), *row_order(df, skip=(newer_by, *on))]

    def upsert(rows: DataFrame, number: int) -> None:
        if not rows.isEmpty():
            newest = latest_per_key(rows, on, order)
            run = json.loads(read_text(rows.sparkSession, f"{checkpoint}/metadata"))["id"]
            write_merge(newest, path, keys, partition_by, newer_by, (checkpoint, run, number), fmt, feed, unique=True)

    return (
        df.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
