"""Table graphs run through the layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.plans.layers import Layers, run_all, run_bronze, run_stage
from terrace.queries.base import query, table
from terrace.sources.places import new_dir
from terrace.sources.tables import read_table
from terrace.sources.topics import to_records, write_topic
from terrace.specs import Source, TableSpec

_NATION = Source("topic", "nation", "N_NationKey int, N_Name string, N_RegionKey int")
_REGION = Source("topic", "region", "R_RegionKey int, R_Name string")


def _flat(sources: dict[str, DataFrame]) -> DataFrame:
    nation, region = sources["NATION"], sources["REGION"]
    return nation.join(region, nation.region_key == region.region_key).select(
        "nation_key", "nation", region.region_key, "region"
    )


def _broken(sources: dict[str, DataFrame]) -> DataFrame:
    return sources["NATION"].select("no_such_column")


def _suppliers(sources: dict[str, DataFrame]) -> DataFrame:
    return sources["SUPPLIER"].join(sources["PLACE"], "nation_key", "left")


SPECS = [
    TableSpec(
        name="SUPPLIER_PLACE",
        layer="gold",
        sources=(Source("silver", "SUPPLIER"), Source("gold", "PLACE")),
        transform=_suppliers,
        keys=("supplier_key",),
        newest_first=(),
    ),
    TableSpec(
        name="AFTER_BROKEN", layer="gold", sources=(Source("gold", "BROKEN"),), keys=("nation_key",)
    ),
    TableSpec(
        name="BROKEN",
        layer="gold",
        sources=(Source("silver", "NATION"),),
        transform=_broken,
        keys=("nation_key",),
    ),
    TableSpec(
        name="PLACE",
        layer="gold",
        sources=(Source("silver", "NATION"), Source("silver", "REGION")),
        transform=_flat,
        keys=("nation_key",),
        partition_by=("region",),
    ),
    TableSpec(
        name="NATION",
        layer="silver",
        sources=(_NATION,),
        strategy="merge",
        keys=("nation_key",),
        renames={"N_NationKey": "nation_key", "N_Name": "nation", "N_RegionKey": "region_key"},
    ),
    TableSpec(
        name="REGION",
        layer="silver",
        sources=(_REGION,),
        strategy="dynamic_overwrite",
        keys=("region_key",),
        replace_by=("region_key",),
        renames={"R_RegionKey": "region_key", "R_Name": "region"},
    ),
    TableSpec(
        name="SUPPLIER",
        layer="silver",
        sources=(
            Source("topic", "supplier", "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
        ),
        mode="stream",
        strategy="merge",
        keys=("supplier_key",),
        renames={"s_suppkey": "supplier_key", "s_nationkey": "nation_key"},
        computed={"s_acctbal": "try_cast(s_acctbal AS decimal(12,2))"},
    ),
]


def _run(spark: SparkSession, sf_dir: str) -> tuple[Layers, DataFrame]:
    layers = Layers.under(new_dir(spark, "layers"))
    topics = {
        "nation": table(spark, sf_dir, "nation").toDF("N_NationKey", "N_Name", "N_RegionKey"),
        "region": table(spark, sf_dir, "region").toDF("R_RegionKey", "R_Name"),
        "supplier": table(spark, sf_dir, "supplier"),
    }
    for name, rows in topics.items():
        write_topic(to_records(rows), f"{layers.topics}/{name}")
    run_bronze(spark, layers, list(topics))
    return layers, run_stage(spark, layers, SPECS, allow_partial=True)


@query(
    """
SELECT s_suppkey AS supplier_key, s_name, CAST(s_acctbal AS DOUBLE) AS s_acctbal, n_name AS nation, r_name AS region
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
"""
)
def layered_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics -> bronze -> silver (merge, replace, stream) -> gold, in dependency order."""
    layers, _ = _run(spark, sf_dir)
    gold = read_table(spark, layers.path("gold", "SUPPLIER_PLACE"))
    return gold.select(
        "supplier_key", "s_name", F.col("s_acctbal").cast("double").alias("s_acctbal"), "nation", "region"
    )


@query(
    """
SELECT layer, name, status, n_rows FROM (VALUES
  ('silver', 'NATION', 'ok', (SELECT count(*) FROM nation)), ('silver', 'REGION', 'ok', (SELECT count(*) FROM region)),
  ('silver', 'SUPPLIER', 'ok', (SELECT count(*) FROM supplier)), ('gold', 'PLACE', 'ok', (SELECT count(*) FROM nation)),
  ('gold', 'SUPPLIER_PLACE', 'ok', (SELECT count(*) FROM supplier)),
  ('gold', 'BROKEN', 'failed', NULL), ('gold', 'AFTER_BROKEN', 'skipped', NULL)) t(layer, name, status, n_rows)
"""
)
def failure_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a partly failing run reports, with the rows of the tables that were built."""
    layers, results = _run(spark, sf_dir)
    built = [(s.layer, s.name) for s in SPECS if "BROKEN" not in s.name]
    counts = [
        read_table(spark, layers.path(layer, name))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(layer).alias("layer"), F.lit(name).alias("name"), "n_rows")
        for layer, name in built
    ]
    sizes = counts[0]
    for c in counts[1:]:
        sizes = sizes.unionByName(c)
    named = results.withColumnRenamed("table", "name").drop("error")
    return named.join(sizes, ["layer", "name"], "left")


_EVENTS = TableSpec(
    name="EVENT",
    layer="silver",
    sources=(Source("topic", "events", "event_id bigint, user_id bigint"),),
    strategy="merge",
    keys=("event_id",),
)


@query(
    """
SELECT event_id, user_id, CASE WHEN event_id % 7 < 3 THEN 'quarantine' ELSE 'silver' END AS place,
  CASE event_id % 7 WHEN 0 THEN '{"event_id": ' || event_id WHEN 1 THEN 'no record'
    WHEN 2 THEN '{"event_id": "x' || event_id || '"}' END AS bad
FROM events WHERE event_id % 7 <> 3
"""
)
def malformed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which some arrive cut off, as other text, with a wrong type, or empty: the
    malformed ones are in quarantine as they arrived, once after two runs; tables are ORC."""
    layers = Layers.under(new_dir(spark, "layers"), fmt="orc")
    kind, key = F.col("event_id") % 7, F.col("event_id").cast("string")
    value = (
        F.when(kind == 0, F.concat(F.lit('{"event_id": '), key))
        .when(kind == 1, F.lit("no record"))
        .when(kind == 2, F.concat(F.lit('{"event_id": "x'), key, F.lit('"}')))
        .when(kind == 3, F.lit(""))
        .otherwise(F.to_json(F.struct("event_id", "user_id")))
    )
    events = table(spark, sf_dir, "events")
    sent = events.select(key.alias("key"), value.alias("value"), F.col("ts").alias("timestamp"))
    for half in (0, 1):
        write_topic(sent.filter(F.col("key").cast("bigint") % 2 == half), f"{layers.topics}/events")
        run_all(spark, layers, ["events"], [_EVENTS], quarantine=True)
    bad = read_table(spark, layers.path("silver", "quarantine/EVENT-events"), layers.fmt)
    owner = events.select("event_id", "user_id")
    aside = bad.select(F.col("kafka_key").cast("bigint").alias("event_id"), F.col("kafka_value").alias("bad"))
    silver = read_table(spark, layers.path("silver", "EVENT"), layers.fmt)
    return (
        aside.join(owner, "event_id")
        .select("event_id", "user_id", F.lit("quarantine").alias("place"), "bad")
        .unionByName(silver.select("event_id", "user_id", F.lit("silver").alias("place"), F.lit(None).cast("string").alias("bad")))
    )
