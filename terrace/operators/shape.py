"""Reshape records: parse, rename, compute, keep keyed rows, keep the newest row per key."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten_json(
    df: DataFrame,
    schema: T.StructType,
    value_col: str = "kafka_value",
    meta: Mapping[str, Column] | None = None,
    corrupt_col: str | None = None,
) -> DataFrame:
    """Parse the JSON column and lay its fields out as columns, followed by ``meta``.

    A malformed record becomes all nulls, a bad field only itself. With ``corrupt_col``
    the text of malformed records is kept in that column. The record is laid out by a
    generator, through which later filters do not move: each text is parsed once.
    """
    options = {}
    if corrupt_col:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_col, T.StringType())])
        options = {"columnNameOfCorruptRecord": corrupt_col}
    data = F.from_json(F.col(value_col), schema, options)
    extra = [c.alias(name) for name, c in (meta or {}).items()]
    return df.select(F.inline(F.array(data)), *extra)


def pick_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in the declared types; a column the input lacks is null."""
    have = set(df.columns)
    return df.select(
        [
            (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def rename_lower(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Rename the columns that exist, then lower-case every name."""
    renamed = df.withColumnsRenamed({k: v for k, v in (renames or {}).items() if k in df.columns})
    return renamed.toDF(*[c.lower() for c in renamed.columns])


def compute(
    df: DataFrame, exprs: Mapping[str, str | Column | Callable[[Column], Column]] | None
) -> DataFrame:
    """Set columns from SQL text, from expressions, or from functions of their own value.

    A new name adds a column. Every expression sees the columns as they were before.
    """

    def column(name: str, e) -> Column:
        if isinstance(e, str):
            return F.expr(e)
        return e if isinstance(e, Column) else e(F.col(name))

    cols = {n: column(n, e) for n, e in (exprs or {}).items()}
    return df.withColumns(cols) if cols else df


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key columns are all present."""
    return df.dropna(subset=list(keys))


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column | str]
) -> DataFrame:
    """One row per key: the first one in ``newest_first`` order.

    The order should end in a tie-break. Spark keeps one row per key in every map task
    before the shuffle (a group limit under the window), so a hot key costs one row per
    task, not its whole group.
    """
    w = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def row_order(df: DataFrame, skip: Sequence[str] = ()) -> list[Column]:
    """A hash of the row: the tie-break that keeps a choice the same when it is made again."""
    plain = [
        F.col(f"`{f.name}`")
        for f in df.schema.fields
        if f.name not in skip and not isinstance(f.dataType, T.MapType | T.VariantType)
    ]
    return [F.xxhash64(*plain)] if plain else []
