"""Tables bucketed by a key, so that windows, groups and joins by it need no shuffle.

A bucketed table is a folder of files that Spark's catalog knows as buckets: rows of one key are
in one bucket, sorted. It pays where a table is written once and then grouped or joined by the
same key many times, such as laps by session. Windows by the key and further columns are
served as well. The catalog of a session may be empty: ``read_bucketed`` declares the table
again from what the writer said. Hot keys make large buckets; where ``operators.skew`` cuts
hot groups, it does so by a shuffle of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _name(path: str) -> str:
    return f"bucketed_{hashlib.md5(path.encode()).hexdigest()}"


def write_bucketed(df: DataFrame, path: str, by: Sequence[str], buckets: int, fmt: str = "parquet") -> DataFrame:
    """Write ``df`` to ``path`` in buckets by ``by``, sorted by it; returns the table. One task
    writes one bucket, so there are as many files as buckets."""
    dealt = df.repartition(buckets, *by)
    writer = dealt.write.format(fmt).mode("overwrite").bucketBy(buckets, *by).sortBy(*by).option("path", path)
    writer.saveAsTable(_name(path))
    return df.sparkSession.table(_name(path))


def read_bucketed(
    spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str], buckets: int, fmt: str = "parquet"
) -> DataFrame:
    """A table that :func:`write_bucketed` wrote, also in another session."""
    name = _name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        keys = ", ".join(f"`{c}`" for c in by)
        place = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING {fmt} CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
    return spark.table(name)
