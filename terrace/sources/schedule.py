"""Which rounds of a schedule to work on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick_rounds(
    schedule: DataFrame, which: str, date: str, number: str, today: Column | None = None
) -> DataFrame:
    """``all`` finished rounds (date before today), the ``latest`` of them, or one by number."""
    if which.isdigit():
        return schedule.filter(F.col(number) == int(which))
    finished = schedule.filter(F.col(date) < (F.current_date() if today is None else today))
    if which.lower() == "all":
        return finished
    if which.lower() == "latest":
        return finished.orderBy(F.desc(date), F.desc(number)).limit(1)
    raise ValueError(f"which must be a number, 'all' or 'latest', not {which!r}")


def nth_row(
    schedule: DataFrame, n: int, order: Sequence[Column | str], cancelled: Column, per: Sequence[str] = ()
) -> DataFrame:
    """The n-th row (from 1) that is not cancelled, overall or per group.

    Tasks keep only their first n rows (of each group) before anything is shuffled.
    """
    held = schedule.filter(~F.coalesce(cancelled, F.lit(False)))
    if per:
        w = Window.partitionBy(*per).orderBy(*order)
        return held.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == n).drop("_rn")
    return held.orderBy(*order).offset(n - 1).limit(1)
