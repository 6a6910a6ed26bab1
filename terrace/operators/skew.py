"""Work on groups of any size: hot groups are cut into pieces that fit one task.

Pieces are cut at quantiles of the order column, so they hold about equally many rows
however the values are spread.

A group is hot when it has more than ``piece_rows`` rows. One map-side aggregated count
over the key columns finds the hot groups before the real job is planned. Only the
``MAX_HOT`` largest are cut, so the table that describes them is bounded whatever the
size of the data, and a group left whole holds under 1/``MAX_HOT`` of all rows. Without
hot groups the plan is the plain one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE_ROWS = 5_000_000
MAX_HOT = 100_000
PIECE = "_piece"
MAX_PIECES = 8_192
BLOCK = 64


def hot_groups(
    df: DataFrame, keys: Sequence[str], aggs: Sequence[Column] = (), piece_rows: int = PIECE_ROWS
) -> DataFrame | None:
    """Keys, ``_rows`` and ``aggs`` of the hot groups (at most ``MAX_HOT``); None without any."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *aggs)
    largest = groups.filter(F.col("_rows") > piece_rows).orderBy(F.desc("_rows")).limit(MAX_HOT)
    rows = largest.collect()
    return df.sparkSession.createDataFrame(rows, largest.schema) if rows else None


def join_hot(df: DataFrame, hot: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join the hot groups on equal keys, null equal to null; the group of null keys counts."""
    named = hot.withColumnsRenamed({k: f"_hot_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
    joined = df.join(F.broadcast(named), same, how)
    return joined if how == "left_semi" else joined.drop(*[f"_hot_{k}" for k in keys])


def _axis(c: Column, data_type: str) -> Column:
    """A number that rises with ``c``: for text that of its first six bytes."""
    if data_type == "date":
        return F.unix_date(c).cast("double")
    if data_type.startswith("timestamp"):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if data_type.startswith(("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")):
        return c.cast("double")
    if data_type == "string":
        return F.conv(F.rpad(F.hex(F.encode(c, "UTF-8")), 12, "0"), 16, 10).cast("double")
    return F.lit(0.0)


def axis_of(df: DataFrame, column: str) -> Column:
    return _axis(F.col(column), dict(df.dtypes)[column])


def _place(df: DataFrame, order: str) -> Column:
    """Where a row of a hot group lies on the order; text counts from ``_skip`` characters on,
    after what all of the group's texts begin with."""
    c, data_type = F.col(order), dict(df.dtypes)[order]
    return _axis(F.substr(c, F.col("_skip") + 1, F.lit(6)) if data_type == "string" else c, data_type)


def hot_ranges(
    df: DataFrame, keys: Sequence[str], order: str, piece_rows: int = PIECE_ROWS
) -> DataFrame | None:
    """Per hot group the bounds between its pieces, at quantiles of ``order``.

    Only hot groups are read a second time, for their quantiles. The bounds of all groups
    together are fewer than rows / ``piece_rows``, so the table is as bounded as the list of
    hot groups. A group has at most ``MAX_PIECES`` pieces.
    """
    rows = df.select(*keys, order)
    is_text = dict(df.dtypes)[order] == "string"
    ends = [F.min(order).alias("_min"), F.max(order).alias("_max")] if is_text else []
    hot = hot_groups(rows, keys, ends, piece_rows)
    if hot is None:
        return None
    shared = F.lit(0)
    if is_text:  # characters that the least and the greatest text have in common at their start
        at = F.sequence(F.lit(1), F.greatest(F.length("_min"), F.lit(1)))
        same = F.filter(at, lambda i: F.left("_min", i) == F.left("_max", i))
        shared = F.coalesce(F.size(same), F.lit(0))
    count = F.least(F.ceil(F.col("_rows") / piece_rows), F.lit(MAX_PIECES)).cast("int")
    hot = hot.select(*keys, count.alias("_count"), shared.alias("_skip"))
    steps = min(4 * hot.agg(F.max("_count")).first()[0], MAX_PIECES)
    grid = [i / steps for i in range(1, steps)]
    marked = join_hot(rows, hot, keys, "left").filter("_count IS NOT NULL")
    spread = marked.groupBy(*keys, "_count", "_skip").agg(
        F.percentile_approx(_place(df, order), grid, 10 * max(steps, 1_000)).alias("_grid")
    )
    # Of the grid, the values at equal distances; equal values bound one piece.
    numbers = F.filter(F.sequence(F.lit(0), F.col("_count") - 1), lambda i: i > 0)
    picked = F.transform(numbers, lambda i: F.get("_grid", F.round(i * steps / F.col("_count")).cast("int") - 1))
    bounds = F.array_distinct(F.filter(picked, lambda b: b.isNotNull() & ~F.isnan(b)))
    found = spread.select(*keys, "_skip", bounds.alias("_bounds")).select(
        "*",
        F.filter("_bounds", lambda b, i: i % BLOCK == 0).alias("_blocks"),
        (F.size("_bounds") + 1).cast("bigint").alias("_pieces"),
    )
    return df.sparkSession.createDataFrame(found.collect(), found.schema)


def cut(df: DataFrame, keys: Sequence[str], order: str, ranges: DataFrame) -> DataFrame:
    """Add the piece number: rises with ``order`` inside a hot group, null in other groups.

    The bounds at or below a row's value are counted, in the right block only. Null sorts
    first, NaN last.
    """
    own = join_hot(df, ranges, keys, "left").withColumn("_at", _place(df, order))

    def below(bounds: Column) -> Column:
        return F.size(F.filter(bounds, lambda b: b <= F.col("_at")))

    before = (F.greatest(below(F.col("_blocks")) - 1, F.lit(0)) * BLOCK).cast("int")
    own = own.withColumn("_before", before)
    piece = F.col("_before") + below(F.slice("_bounds", F.col("_before") + 1, F.lit(BLOCK)))
    return own.withColumn(PIECE, F.when(F.col("_pieces").isNotNull(), piece.cast("bigint"))).drop(
        "_bounds", "_blocks", "_pieces", "_skip", "_at", "_before"
    )


def group_values(
    df: DataFrame,
    keys: Sequence[str],
    aggs: Mapping[str, tuple[str, str]],
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Add an aggregate over the row's group to every row; ``aggs``: name -> (function, column).

    Hot groups are aggregated map-side and their result is broadcast; their rows do not
    take part in the window that serves all other groups.
    """
    calls = {name: getattr(F, fn)(F.col(c)) for name, (fn, c) in aggs.items()}
    hot = hot_groups(df, keys, [c.alias(f"_value_{n}") for n, c in calls.items()], piece_rows)
    w = Window.partitionBy(*keys)
    if hot is None:
        return df.select("*", *[c.over(w).alias(n) for n, c in calls.items()])
    marked = join_hot(df, hot, keys, "left")
    cold = marked.filter("_rows IS NULL").select(
        *df.columns, *[c.over(w).alias(n) for n, c in calls.items()]
    )
    return cold.unionByName(
        marked.filter("_rows IS NOT NULL").select(
            *df.columns, *[F.col(f"_value_{n}").alias(n) for n in calls]
        )
    )


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    lag: Mapping[str, str] | None = None,
    lead: Mapping[str, str] | None = None,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Add values of the previous (``lag``: new name -> column) and next (``lead``) row.

    ``order`` must be unique inside a group. In hot groups every piece gets a copy of the
    row before and the row after it, so one window over (group, piece) sees the same
    neighbours as a window over the whole group.
    """
    lag, lead = dict(lag or {}), dict(lead or {})
    ranges = hot_ranges(df, keys, order, piece_rows)
    groups = [*keys, PIECE] if ranges is not None else list(keys)
    w = Window.partitionBy(*groups).orderBy(order)
    added = [F.lag(c).over(w).alias(n) for n, c in lag.items()]
    added += [F.lead(c).over(w).alias(n) for n, c in lead.items()]
    if ranges is None:
        return df.select("*", *added)

    needed = sorted({order, *lag.values(), *lead.values()} - set(keys))
    row = F.struct(*needed)
    edges = (
        cut(join_hot(df.select(*keys, *needed), ranges, keys, "left_semi"), keys, order, ranges)
        .groupBy(*groups)
        .agg(F.min_by(row, order).alias("_first"), F.max_by(row, order).alias("_last"))
    )
    across = Window.partitionBy(*keys).orderBy(PIECE)
    copies = (
        edges.select(
            *groups,
            F.array(F.lag("_last").over(across), F.lead("_first").over(across)).alias("_copies"),
        )
        .select(*groups, F.explode("_copies").alias("_row"))
        .filter("_row IS NOT NULL")
        .select(*groups, "_row.*", F.lit(True).alias("_copy"))
    )
    rows = cut(df, keys, order, ranges).withColumn("_copy", F.lit(False))
    both = rows.unionByName(copies, allowMissingColumns=True)
    return both.select(*df.columns, *added, "_copy").filter(~F.col("_copy")).drop("_copy")


def is_small(df: DataFrame, limit: int | None = None) -> bool:
    """Whether Spark's own estimate of ``df`` is within ``limit`` (the broadcast threshold)."""
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(estimate)) <= (conf.autoBroadcastJoinThreshold() if limit is None else limit)


def lookup(
    df: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Join ``table``, which holds at most one row per key, to every row of ``df``.

    A small table is left to Spark, which broadcasts it. Otherwise the hot groups of
    ``df`` meet their table rows (one per hot group) by broadcast where they are, and
    only the other groups are shuffled. Null keys find nothing.
    """
    columns = [*df.columns, *[c for c in table.columns if c not in keys]]
    if is_small(table):
        return df.join(table, list(keys), how).select(*columns)
    hot = hot_groups(df.select(*keys), keys, piece_rows=piece_rows)
    if hot is None:
        return df.join(table, list(keys), how).select(*columns)
    hot = hot.select(*keys, F.lit(True).alias("_is_hot"))
    few = F.broadcast(table.join(F.broadcast(hot.drop("_is_hot")), list(keys), "left_semi"))
    marked = join_hot(df, hot, keys, "left")
    cold = marked.filter("_is_hot IS NULL").join(table, list(keys), how).select(*columns)
    return cold.unionByName(
        marked.filter("_is_hot").join(few, list(keys), how).select(*columns)
    )
