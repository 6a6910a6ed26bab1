"""Time-series alignment: gap filling, validity windows, range and as-of joins."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.operators.skew import PIECE, PIECE_ROWS, axis_of, cut, hot_ranges, neighbours

EXPLODE_STEP = 10_000
# Mean window over the median one from which on windows count as of mixed length.
MIXED = 16
LEVEL = 4.0


def fill_gaps(
    df: DataFrame,
    part: Sequence[str],
    order: str,
    start: str,
    end: str,
    length: str,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Fill missing interval ends from the neighbours, else from the interval's length.

    start: own, else the previous end, else end - length. end: own, else the next start,
    else start + length. All from the original values. ``is_<start>_estimated`` and
    ``is_<end>_estimated`` tell which values were filled.
    """
    near = neighbours(df, part, order, {"_prev_end": end}, {"_next_start": start}, piece_rows)
    s, e, n = F.col(start), F.col(end), F.col(length)
    filled_start = F.coalesce(s, F.col("_prev_end"), e - n)
    filled_end = F.coalesce(e, F.col("_next_start"), s + n)
    return near.withColumns(
        {
            start: filled_start,
            end: filled_end,
            f"is_{start}_estimated": s.isNull() & filled_start.isNotNull(),
            f"is_{end}_estimated": e.isNull() & filled_end.isNotNull(),
        }
    ).drop("_prev_end", "_next_start")


def valid_to(
    df: DataFrame,
    part: Sequence[str],
    order: str,
    start: str,
    end: str | None = None,
    name: str = "valid_to",
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Add where each row stops being valid: the next row's start, else its own end."""
    near = neighbours(df, part, order, lead={name: start}, piece_rows=piece_rows)
    return near.withColumn(name, F.coalesce(F.col(name), F.col(end))) if end else near


def unrolled(df: DataFrame, first: Column, last: Column, name: str) -> DataFrame:
    """A row for each number from ``first`` to ``last``, as ``name``. Many are unrolled in steps, so
    no row ever holds a huge array."""
    return (
        df.select("*", first.alias("_first"), last.alias("_last"))
        .withColumn("_from", F.explode(F.sequence("_first", "_last", F.lit(EXPLODE_STEP))))
        .withColumn("_to", F.least(F.col("_last"), F.col("_from") + EXPLODE_STEP - 1))
        .withColumn(name, F.explode(F.sequence("_from", "_to")))
        .drop("_first", "_last", "_from", "_to")
    )


def range_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    t: str,
    start: str,
    end: str,
    how: str = "left",
    width: float | None = None,
) -> DataFrame:
    """Join on equal ``on`` and ``start <= t < end``; overlapping windows all match.

    Both sides get a time bin as one more equality key, so a row meets only the windows
    of its bin and a hot key spreads over its bins. A bin is as wide as the mean window
    (rounded up to a power of two), which keeps the binned right side under three rows
    per window. Where the mean is far over the median, so that a few long windows would put
    many short ones in one bin, windows are binned by levels of length instead
    (:func:`level_join`). Which side is broadcast, if any, is left to the runtime sizes.
    ``t``, ``start`` and ``end`` must be of one type; ``width`` is in seconds or numbers.
    """
    micros = dict(left.dtypes)[t].startswith("timestamp")
    lo, hi, at = axis_of(right, start), axis_of(right, end), axis_of(left, t)
    windows = right.filter(F.col(start) < F.col(end))
    if width is None:
        mean, middle = windows.agg(F.avg(hi - lo), F.percentile_approx(hi - lo, 0.5)).first()
        if mean and mean > MIXED * middle:
            return level_join(left, right, on, t, start, end, how)
        width = 2.0 ** math.ceil(math.log2(mean)) if mean else 1.0
    elif micros:
        width *= 1_000_000
    binned = unrolled(windows, F.floor(lo / width), F.floor(hi / width), "_bin")
    l, r = left.withColumn("_bin", F.floor(at / width)).alias("l"), binned.alias("r")
    match = F.col("l._bin") == F.col("r._bin")
    for k in on:
        match &= F.col(f"l.{k}") == F.col(f"r.{k}")
    match &= (F.col(f"l.{t}") >= F.col(f"r.{start}")) & (F.col(f"l.{t}") < F.col(f"r.{end}"))
    return l.join(r, match, how).select(
        *[F.col(f"l.{c}") for c in left.columns],
        *[F.col(f"r.{c}") for c in right.columns if c not in on],
    )


def level_of(length: Column, unit: float) -> Column:
    """The lowest level whose cells are not narrower than ``length``."""
    return F.greatest(F.ceil(F.log(length / unit) / math.log(LEVEL)).cast("int"), F.lit(0))


def binned_by_level(windows: DataFrame, start: str, end: str, unit: float) -> DataFrame:
    """Windows on the cells they touch at the level of their length: ``_level`` and ``_cell``, at
    most two rows per window. Cells of level ``n`` are ``unit * LEVEL**n`` wide, not narrower
    than its windows; level 0 also holds all shorter windows."""
    lo, hi = axis_of(windows, start), axis_of(windows, end)
    cells = windows.withColumn("_level", level_of(hi - lo, unit))
    size = F.lit(unit) * F.pow(F.lit(LEVEL), F.col("_level"))
    return cells.withColumn("_cell", F.explode(F.sequence(F.floor(lo / size), F.floor(hi / size))))


def level_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], t: str, start: str, end: str, how: str = "left"
) -> DataFrame:
    """:func:`range_join` for windows of very mixed length, by a grid for each level of length.

    A window is put on one or two cells of its own level. A row is looked up on the levels on
    which it has windows, and only there: those where the latest end of the windows that have
    started is after it. For that, rows and ends of windows go by time bins once; a bin is as wide
    as the mean window, so a window is in under three of them on average. A row meets windows
    that are about as long as the cell it looks in, whatever others there are, and looks that
    find nothing are not shuffled.
    """
    windows = right.filter(F.col(start) < F.col(end))
    lo, hi, at = axis_of(windows, start), axis_of(windows, end), axis_of(left, t)
    shortest, mean = windows.agg(F.percentile_approx(hi - lo, 0.1), F.avg(hi - lo)).first()
    added = [c for c in right.columns if c not in on]
    if shortest is None:  # no window at all
        nothing = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in added]
        return left.select("*", *nothing) if how == "left" else left.select("*", *nothing).limit(0)
    unit, width = float(shortest), 2.0 ** math.ceil(math.log2(mean))
    binned = binned_by_level(windows, start, end, unit)
    levels = sorted(r[0] for r in binned.select("_level").distinct().collect())  # a few dozen at most

    keys = [*on, "_bin"]
    rows = left.select(*on, F.floor(at / width).alias("_bin"), F.col(t).alias("_t"), F.struct(*left.columns).alias("_l"))
    ends = windows.select(*on, F.col(start).alias("_t"), F.col(end).alias("_end"), level_of(hi - lo, unit).alias("_level"), lo.alias("_lo"), hi.alias("_hi"))
    ends = unrolled(ends, F.floor(F.col("_lo") / width), F.floor(F.col("_hi") / width), "_bin").drop("_lo", "_hi")
    before = Window.partitionBy(*keys).orderBy("_t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    latest = [F.max(F.when(F.col("_level") == n, F.col("_end"))).over(before) for n in levels]
    keyed = reduce(and_, [F.col(k).isNotNull() for k in on], F.lit(True))
    has = F.array(*[F.when(keyed & (F.col(f"_e{n}") > F.col("_t")), F.lit(n)) for n in levels])
    told = rows.unionByName(ends, allowMissingColumns=True).select("*", *[e.alias(f"_e{n}") for n, e in zip(levels, latest, strict=True)])
    told = told.filter("_l IS NOT NULL").select(*on, "_t", "_l", F.array_compact(has).alias("_levels"))

    looks = told.select(*on, "_t", "_l", (F.explode_outer if how == "left" else F.explode)("_levels").alias("_level"))
    size = F.lit(unit) * F.pow(F.lit(LEVEL), F.col("_level"))
    looks = looks.withColumn("_cell", F.floor(axis_of(looks, "_t") / size))
    match = reduce(and_, [F.col(f"l.{k}") == F.col(f"r.{k}") for k in [*on, "_level", "_cell"]])
    match &= (F.col("l._t") >= F.col(f"r.{start}")) & (F.col("l._t") < F.col(f"r.{end}"))
    return looks.alias("l").join(binned.alias("r"), match, how).select("l._l.*", *[F.col(f"r.{c}") for c in added])


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    t: str,
    start: str,
    end: str | None = None,
    how: str = "left",
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """For each left row the right row with the latest ``start <= t``; with ``end`` only
    if also ``t < end``. The same rows as :func:`range_join` when windows do not overlap.

    Both sides share one shuffle and one sort; nothing is broadcast and every left row
    is written once, so neither side has to be small. Hot keys are cut into time pieces,
    and each piece starts with the row that was valid before it.
    """
    payload = [c for c in right.columns if c not in on]
    at_key = reduce(and_, [F.col(k).isNotNull() for k in on])
    starts = right.filter(at_key & F.col(start).isNotNull()).select(
        *on,
        F.col(start).alias("_t"),
        F.lit(0).alias("_side"),
        F.struct(F.col(start).alias("_start"), *payload).alias("_r"),
    )
    rows = left.select(
        *on, F.col(t).alias("_t"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_l")
    )
    instants = rows.select(*on, "_t").unionByName(starts.select(*on, "_t"))
    ranges = hot_ranges(instants, on, "_t", piece_rows)
    groups = list(on)
    if ranges is not None:
        groups.append(PIECE)
        rows, starts = cut(rows, on, "_t", ranges), cut(starts, on, "_t", ranges)
        last_in_piece = (
            starts.filter(F.col(PIECE).isNotNull()).groupBy(*groups).agg(F.max("_r").alias("_r"))
        )
        numbers = F.sequence(F.lit(0).cast("bigint"), F.col("_pieces") - 1)
        before = Window.partitionBy(*on).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
        carried = (
            ranges.filter(at_key)
            .select(*on, F.explode(numbers).alias(PIECE))
            .join(last_in_piece, groups, "left")
            .select(
                *groups,
                F.last("_r", ignorenulls=True).over(before).alias("_r"),
                F.lit(-1).alias("_side"),
            )
            .filter("_r IS NOT NULL")
        )
        starts = starts.unionByName(carried, allowMissingColumns=True)
    both = rows.unionByName(starts, allowMissingColumns=True)
    w = (
        Window.partitionBy(*groups)
        .orderBy(F.col("_t").asc_nulls_first(), "_side", "_r")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = both.select(
        "_l", "_side", "_t", F.last("_r", ignorenulls=True).over(w).alias("_r")
    ).filter("_side = 1")
    valid = F.col("_t").isNotNull() & F.col("_r").isNotNull()
    if end:
        valid &= F.col("_t") < F.col(f"_r.{end}")
    if how == "inner":
        found = found.filter(valid)
    return found.select("_l.*", *[F.when(valid, F.col(f"_r.{c}")).alias(c) for c in payload])
