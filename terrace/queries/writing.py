"""Batch write strategies and full refreshes, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.serve import LoadError, load_all, refresh
from terrace.operators.write import write_append, write_merge, write_overwrite, write_replace
from terrace.queries.base import query, table
from terrace.sources.places import new_dir
from terrace.sources.tables import read_table


@query(
    """
WITH changed AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1000 AS c_acctbal, c_mktsegment
  FROM customer WHERE c_acctbal < 0
  UNION ALL
  SELECT -1 - c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
  FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 2) AS c_acctbal, c_mktsegment FROM customer
WHERE c_custkey NOT IN (SELECT c_custkey FROM changed)
UNION ALL SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 2), c_mktsegment FROM changed
"""
)
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, then an upsert of changed and new ones, twice (the second changes nothing)."""
    customers = table(spark, sf_dir, "customer")
    changed = customers.filter("c_acctbal < 0").withColumn("c_acctbal", F.col("c_acctbal") + 1000)
    added = customers.filter("c_mktsegment = 'BUILDING'").withColumn("c_custkey", -1 - F.col("c_custkey"))
    updates = changed.unionByName(added)
    path = new_dir(spark, "merge")
    write_merge(customers, path, ["c_custkey"], ["c_mktsegment"])
    write_merge(updates, path, ["c_custkey"], ["c_mktsegment"])
    write_merge(updates, path, ["c_custkey"], ["c_mktsegment"])
    return read_table(spark, path).withColumn("c_acctbal", F.round("c_acctbal", 2))


@query(
    """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'F'
UNION ALL
SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice > 100000
"""
)
def replace_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slice of one status is replaced whole; other slices stay as they are."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    new = orders.filter("o_orderstatus = 'F' AND o_totalprice > 100000")
    path = new_dir(spark, "replace")
    write_overwrite(orders, path, ["o_orderstatus"])
    write_replace(new.withColumn("o_orderkey", -1 - F.col("o_orderkey")), path, ["o_orderstatus"], ["o_orderstatus"])
    write_replace(new.filter("o_orderkey < 0"), path, ["o_orderstatus"], ["o_orderstatus"])
    return read_table(spark, path)


@query(
    """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
UNION ALL
SELECT c_custkey, c_custkey, 'N', c_acctbal FROM customer WHERE c_acctbal < 0
"""
)
def replace_across_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices by customer in a table partitioned by status: old rows go from every partition."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    new = (
        table(spark, sf_dir, "customer")
        .filter("c_acctbal < 0")
        .select(
            F.col("c_custkey").alias("o_orderkey"),
            F.col("c_custkey").alias("o_custkey"),
            F.lit("N").alias("o_orderstatus"),
            F.col("c_acctbal").alias("o_totalprice"),
        )
    )
    path = new_dir(spark, "slices")
    write_overwrite(orders, path, ["o_orderstatus"])
    write_replace(new, path, ["o_custkey"], ["o_orderstatus"])
    return read_table(spark, path)


@query(
    """
SELECT o_orderpriority AS priority, count(*) AS n, sum(CAST(o_custkey AS BIGINT)) AS custkeys FROM (
  SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'O') GROUP BY 1
"""
)
def append_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwrite a partitioned plain table, then append to it."""
    orders = table(spark, sf_dir, "orders")
    path = new_dir(spark, "append")
    write_append(orders, path, "overwrite", ["o_orderpriority"])
    write_append(orders.filter("o_orderstatus = 'O'"), path, "append", ["o_orderpriority"])
    return (
        read_table(spark, path)
        .groupBy(F.col("o_orderpriority").alias("priority"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").cast("bigint").alias("custkeys"))
    )


@query(
    """
SELECT n_name AS nation, count(*) AS loaded FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
"""
)
def refresh_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full refresh of two tables into a sink, each verified by its row count."""
    base = new_dir(spark, "serving")

    def load(name: str) -> None:
        path = f"{base}/{name}"
        refresh(
            table(spark, sf_dir, name),
            lambda rows: write_overwrite(rows, path),
            lambda: read_table(spark, path).count(),
        )

    load_all(["customer", "nation"], load)
    customers, nations = read_table(spark, f"{base}/customer"), read_table(spark, f"{base}/nation")
    return (
        customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("nation"))
        .agg(F.count(F.lit(1)).alias("loaded"))
    )


@query("SELECT c_custkey, c_name, c_nationkey * 2 AS c_nationkey, c_acctbal > 0 AS in_credit FROM customer")
def overwrite_new_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written anew with other columns and types."""
    path, customers = new_dir(spark, "table"), table(spark, sf_dir, "customer")
    write_overwrite(customers.select("c_custkey", "c_name", F.col("c_nationkey").cast("string").alias("c_nationkey")), path)
    write_overwrite(
        customers.select("c_custkey", "c_name", F.expr("c_nationkey * 2").alias("c_nationkey"), (F.col("c_acctbal") > 0).alias("in_credit")), path
    )
    return read_table(spark, path)


@query("SELECT event_id, value, CASE WHEN event_id % 2 = 0 THEN user_id END AS at FROM events")
def upsert_null_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a time do not replace stored rows that have one; any time replaces none."""
    path, events = new_dir(spark, "table"), table(spark, sf_dir, "events")
    timed = events.select("event_id", "value", F.expr("CASE WHEN event_id % 2 = 0 THEN user_id END").alias("at"))
    blank = events.select("event_id", F.lit(-1.0).alias("value"), F.lit(None).cast("long").alias("at"))
    write_merge(timed.filter("event_id % 4 < 2"), path, ["event_id"], newer_by="at")
    write_merge(blank.filter("event_id % 2 = 0"), path, ["event_id"], newer_by="at")
    write_merge(timed.filter("event_id % 4 > 1"), path, ["event_id"], newer_by="at")
    return read_table(spark, path)


@query(
    """
SELECT name, CASE name WHEN 'whole' THEN 'ok' ELSE 'rows differ' END AS found, (SELECT count(*) FROM customer) AS rows
FROM (VALUES ('whole'), ('changed value'), ('swapped duplicate')) t(name)
"""
)
def refresh_by_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refreshes verified by content: a sink that changes one value, or holds one row twice and
    another not at all, has the right number of rows and is found out."""
    customers = table(spark, sf_dir, "customer")
    last = customers.agg(F.max("c_custkey")).first()[0]
    sinks = {
        "whole": lambda df: df.repartition(3).select(*reversed(df.columns)),
        "changed value": lambda df: df.withColumn("c_acctbal", F.when(F.col("c_custkey") == last, F.col("c_acctbal") + 0.01).otherwise(F.col("c_acctbal"))),
        "swapped duplicate": lambda df: df.filter(F.col("c_custkey") != last).unionByName(df.filter(F.col("c_custkey") == last - 1)),
    }
    found = []
    for name, spoil in sinks.items():
        path = new_dir(spark, "sink")
        read = lambda path=path: read_table(spark, path)
        try:
            n = refresh(customers, lambda df, spoil=spoil, path=path: write_overwrite(spoil(df), path), lambda read=read: read().count(), read=read)
            found.append((name, "ok", n))
        except LoadError as e:
            found.append((name, "rows differ" if "not the same" in str(e) else str(e), read().count()))
    return spark.createDataFrame(found, "name string, found string, rows bigint")
