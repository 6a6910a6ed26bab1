"""Tables: plain folders of files, and snapshot tables that can be merged into.

A snapshot table keeps every partition in the version folder that last wrote it
(``_v=7/season=2024``); one small ``_current`` file lists which version of which
partition counts. A write adds files beside the old ones and then swaps that file, so
readers always see a whole state, a lost executor or a failed job changes nothing, and
only the touched partitions are written again. One writer per table at a time.

A snapshot table may have a change feed: the rows that each version brought, new ones and
changed ones, in files of their own (``changes/7``). They are written hidden, beside the
version, and get their name once the version counts, so a stream over the feed sees the
changes of whole versions only, each once. Rows that went are not in it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.sources.places import exists, hidden_dirs, leaf_dirs, read_text, rename, swap_text

CURRENT = "_current"
VERSION = "_v"
CHANGES = "changes"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# Fixed value: characters Spark escapes in partition folder names.
ESCAPED = re.compile(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""")


@dataclass
class Snapshot:
    """State of a snapshot table: schema, partition columns, version of each partition, format,
    and whether it has a change feed."""

    schema: T.StructType
    partition_by: list[str]
    version: int = 0
    partitions: dict[str, int] = field(default_factory=dict)
    batches: dict[str, list] = field(default_factory=dict)  # stream -> [run, number]
    fmt: str = "parquet"
    feed: bool = False

    def to_text(self) -> str:
        return json.dumps({**self.__dict__, "schema": self.schema.jsonValue()})

    @staticmethod
    def from_text(text: str) -> Snapshot:
        state = json.loads(text)
        return Snapshot(**{**state, "schema": T.StructType.fromJson(state["schema"])})


def snapshot_of(spark: SparkSession, path: str) -> Snapshot | None:
    pointer = f"{path}/{CURRENT}"
    return Snapshot.from_text(read_text(spark, pointer)) if exists(spark, pointer) else None


def partition_folder(cols: Sequence[str], row: Row) -> str:
    """Folder name Spark gives to a partition."""

    def text(v) -> str:
        if v is None:
            return NULL_PARTITION
        plain = str(v).lower() if isinstance(v, bool) else str(v)
        return ESCAPED.sub(lambda m: f"%{ord(m.group()):02X}", plain)

    return "/".join(f"{c}={text(row[c])}" for c in cols)


def read_snapshot(
    spark: SparkSession, path: str, snap: Snapshot, only: set[str] | None = None
) -> DataFrame:
    """The current rows, or those of the partitions named in ``only``."""
    parts = {p: v for p, v in snap.partitions.items() if only is None or p in only}
    if not parts:
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in snap.schema.fields]
        return spark.range(0).select(nothing)
    full = T.StructType([*snap.schema.fields, T.StructField(VERSION, T.LongType())])
    folders = [f"{path}/{VERSION}={v}/{p}".rstrip("/") for p, v in sorted(parts.items())]
    return (
        spark.read.schema(full)
        .format(snap.fmt)
        .option("basePath", path)
        .load(folders)
        .select(*snap.schema.names)
    )


def _other_columns(new: T.StructType, old: T.StructType) -> list[str]:
    """Names that only one side has, or that have another type."""
    a, b = ({f.name: f.dataType.simpleString() for f in s.fields} for s in (new, old))
    return sorted(c for c in {*a, *b} if a.get(c) != b.get(c))


def require_columns(df: DataFrame, snap: Snapshot, path: str) -> None:
    """Raise unless ``df`` has the columns and types of the table."""
    if odd := _other_columns(df.schema, snap.schema):
        raise ValueError(f"columns that differ from those of {path}: {', '.join(odd)}")


def write_snapshot(
    df: DataFrame,
    path: str,
    snap: Snapshot | None,
    partition_by: Sequence[str],
    replaced: set[str] | None = None,
    batch: tuple[str, str, int] | None = None,
    fmt: str = "parquet",
    changes: DataFrame | None = None,
) -> Snapshot:
    """Write ``df`` as the new state of the partitions it holds and of those in ``replaced``
    (all partitions when None), then make it current. A whole new state brings its own
    columns and file format; a part must have the columns of the table and takes its format.
    With ``changes`` the table has a change feed, of which these rows are the next part."""
    spark, parts = df.sparkSession, list(partition_by)
    snap = snap or Snapshot(df.schema, parts)
    if replaced is None:
        snap = replace(snap, schema=df.schema, fmt=fmt)
    else:
        require_columns(df, snap, path)
    version = snap.version + 1
    rows = df.select(*snap.schema.names)
    if parts and spark.conf.get("spark.sql.adaptive.enabled") == "true":
        # Few files per partition, and a hot partition split over tasks, by runtime sizes.
        rows = rows.hint("rebalance", *parts)
    writer = rows.write.format(snap.fmt).mode("overwrite")
    (writer.partitionBy(*parts) if parts else writer).save(f"{path}/{VERSION}={version}")
    if changes is not None:
        changes.select(*snap.schema.names).write.format(snap.fmt).mode("overwrite").save(f"{path}/{CHANGES}/.{version}")
    written = leaf_dirs(spark, f"{path}/{VERSION}={version}", len(parts)) if parts else [""]
    kept = {} if replaced is None else {p: v for p, v in snap.partitions.items() if p not in replaced}
    batches = {**snap.batches, batch[0]: list(batch[1:])} if batch else snap.batches
    new = Snapshot(
        snap.schema, parts, version, {**kept, **dict.fromkeys(written, version)}, batches, snap.fmt, changes is not None
    )
    swap_text(spark, f"{path}/{CURRENT}", new.to_text())
    publish_changes(spark, path, new)
    return new


def publish_changes(spark: SparkSession, path: str, snap: Snapshot) -> None:
    """Give the changes of versions that count their name; those of a write that failed stay
    hidden. A write that ended between the two steps is made up for here."""
    if snap.feed:
        for name in hidden_dirs(spark, f"{path}/{CHANGES}"):
            if name[1:].isdigit() and int(name[1:]) <= snap.version:
                rename(spark, f"{path}/{CHANGES}/{name}", f"{path}/{CHANGES}/{name[1:]}")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Batch scan of a plain folder or of the current state of a snapshot table."""
    snap = snapshot_of(spark, path)
    return read_snapshot(spark, path, snap) if snap else spark.read.format(fmt).load(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    return exists(spark, path)


def stream_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    per_trigger: int | None = None,
) -> DataFrame:
    """A table as a stream source. A plain table gives the rows appended to it; a snapshot table
    the rows of its change feed, every version once: what was added or changed, with its new
    values. A snapshot table without a feed is no source: its files also hold rows that were
    replaced since."""
    snap = snapshot_of(spark, path)
    if snap is not None:
        if not snap.feed:
            raise ValueError(f"{path} is a table with replaced rows and no change feed, it cannot be read as a stream")
        publish_changes(spark, path, snap)
        schema, fmt, path = snap.schema, snap.fmt, f"{path}/{CHANGES}"
    if schema is None:
        raise ValueError(f"a stream over {path} needs a schema")
    reader = spark.readStream.format(fmt).schema(schema)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    if snap is not None:
        reader = reader.option("recursiveFileLookup", "true")  # one folder per version
    return reader.load(path)
