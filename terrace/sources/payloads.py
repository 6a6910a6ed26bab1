"""API payloads: walk to the record list inside a JSON text and give one row per record."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _type_at(path: Sequence[str | int], record: str) -> str:
    """DDL type that holds just the records at ``path`` (names and list positions)."""
    if not path:
        return f"array<struct<{record}>>"
    inner = _type_at(path[1:], record)
    return f"array<{inner}>" if isinstance(path[0], int) else f"struct<`{path[0]}`: {inner}>"


def payload_records(
    df: DataFrame,
    payload: str,
    path: Sequence[str | int],
    record: str,
    tags: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per record found at ``path`` in the JSON of column ``payload``.

    ``record`` is the DDL of a record's fields; only these are parsed. ``tags`` are
    columns (of ``df``) to put on every record. A payload without the path has no rows.
    """
    at = F.from_json(F.col(payload), _type_at(path, record))
    for step in path:
        at = F.get(at, F.lit(step)) if isinstance(step, int) else at.getField(step)
    extra = [c.alias(name) for name, c in (tags or {}).items()]
    return df.select(F.explode(at).alias("_record"), *extra).select(
        "_record.*", *[name for name in (tags or {})]
    )


def _json_path(path: Sequence[str | int]) -> str:
    return "$" + "".join(f"[{step}]" if isinstance(step, int) else f"['{step}']" for step in path)


def variant_records(
    df: DataFrame, payload: str, path: Sequence[str | int], tags: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row per record found at ``path``, whatever its fields: ``record`` (VARIANT) and
    ``place`` (from 0) beside the ``tags``. A payload that is no JSON, or has no list there, has
    no rows."""
    records = F.try_variant_get(F.try_parse_json(F.col(payload)), _json_path(path), "array<variant>")
    extra = [c.alias(name) for name, c in (tags or {}).items()]
    return df.select(*extra, F.posexplode(records).alias("place", "record"))


def variant_leaves(df: DataFrame, column: str = "record", levels: int = 8) -> DataFrame:
    """All values inside a VARIANT column, one row each: the other columns, ``path`` (names and
    places joined by dots) and ``value`` as text (null for a JSON null). What is nested deeper
    than ``levels`` comes as JSON text; empty objects and lists have no rows."""
    others = [c for c in df.columns if c != column]
    at = df.select(*others, F.lit("").alias("path"), F.col(column).alias("_v"))
    found = []
    nested = F.schema_of_variant("_v").rlike("^(OBJECT|ARRAY)<")
    for _ in range(levels):
        inner = df.sparkSession.tvf.variant_explode(F.col("_v").outer())
        at = at.filter(nested).lateralJoin(inner).select(
            *others,
            F.concat_ws(".", F.nullif("path", F.lit("")), F.coalesce("key", F.col("pos").cast("string"))).alias("path"),
            F.col("value").alias("_v"),
        )
        found.append(at.filter(~nested))
    found.append(at.filter(nested))
    leaves = found[0]
    for more in found[1:]:
        leaves = leaves.unionByName(more)
    return leaves.select(*others, "path", F.when(~F.is_variant_null("_v"), F.col("_v").cast("string")).alias("value"))
