"""Star schema: dimensions, unknown members, surrogate keys, facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions import foreign_key, normalize_text, surrogate_key
from terrace.functions.keys import UNKNOWN_KEY, assign_keys, key_collisions
from terrace.operators.shape import latest_per_key
from terrace.operators.skew import lookup
from terrace.operators.star import add_unknown
from terrace.queries.base import query, table


def dim_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier flattened with nation and region, keyed."""
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            surrogate_key("s_suppkey").alias("supplier_key"),
            "s_suppkey",
            "s_name",
            F.col("n_name").alias("nation"),
            F.col("r_name").alias("region"),
        )
    )


@query(
    """
SELECT s_suppkey, s_name, n_name AS nation, r_name AS region, TRUE AS key_is_unique
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""
)
def star_dim_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = dim_supplier(spark, sf_dir)
    clashes = key_collisions(dim, "supplier_key", ["s_suppkey"])
    marked = dim.join(clashes, "supplier_key", "left")
    return marked.select(
        "s_suppkey", "s_name", "nation", "region", F.col("natural_keys").isNull().alias("key_is_unique")
    )


@query(
    """
SELECT c_custkey, c_name, c_mktsegment, c_acctbal, FALSE AS is_unknown FROM customer
UNION ALL SELECT NULL, 'UNKNOWN', 'UNKNOWN', NULL, TRUE
"""
)
def star_dim_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = table(spark, sf_dir, "customer").select(
        surrogate_key("c_custkey").alias("customer_key"),
        "c_custkey",
        "c_name",
        "c_mktsegment",
        "c_acctbal",
    )
    return add_unknown(dim, "customer_key").select(
        "c_custkey",
        "c_name",
        "c_mktsegment",
        "c_acctbal",
        (F.col("customer_key") == UNKNOWN_KEY).alias("is_unknown"),
    )


@query(
    """
SELECT l_orderkey, l_linenumber, l_partkey, o.o_custkey AS customer,
       o.o_orderkey IS NULL AS customer_unknown, p.p_brand AS brand,
       p.p_partkey IS NULL AS part_unknown, l_returnflag AS chassis, l_quantity
FROM lineitem
LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') o ON l_orderkey = o_orderkey
LEFT JOIN (SELECT * FROM part WHERE p_size > 10) p ON l_partkey = p_partkey
"""
)
def star_fact_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with keys into two incomplete dimensions; a missing member is key -1.

    The natural columns come back through the keys, which shows that the keys work.
    """
    orders = (
        table(spark, sf_dir, "orders")
        .filter("o_orderstatus <> 'P'")
        .select(
            F.col("o_orderkey").alias("l_orderkey"),
            "o_custkey",
            surrogate_key("o_custkey").alias("_customer_key"),
        )
    )
    parts = table(spark, sf_dir, "part").filter("p_size > 10")
    dim_part = add_unknown(
        parts.select(surrogate_key("p_partkey").alias("part_key"), "p_partkey", "p_brand"), "part_key"
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity"
    )
    known = parts.select(F.col("p_partkey").alias("l_partkey"), surrogate_key("p_partkey").alias("_part_key"))
    fact = (
        lookup(lookup(lines, orders, ["l_orderkey"]), known, ["l_partkey"])
        .withColumn("customer_key", foreign_key("_customer_key"))
        .withColumn("part_key", foreign_key("_part_key"))
        .drop("_customer_key", "_part_key")
    )
    return lookup(fact, dim_part, ["part_key"]).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("o_custkey").alias("customer"),
        (F.col("customer_key") == UNKNOWN_KEY).alias("customer_unknown"),
        F.when(F.col("part_key") != UNKNOWN_KEY, F.col("p_brand")).alias("brand"),
        (F.col("part_key") == UNKNOWN_KEY).alias("part_unknown"),
        F.col("l_returnflag").alias("chassis"),
        "l_quantity",
    )


@query(
    r"""
WITH names AS (SELECT p_name AS name, min(p_partkey) AS first_part, max(p_retailprice) AS top_price
               FROM part GROUP BY p_name)
SELECT p_partkey, first_part, top_price
FROM part LEFT JOIN names ON part.p_name = names.name AND p_brand <> 'Brand#1'
"""
)
def normalise_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Join on text that differs in case and white space, and on a case-blind source tag."""
    parts = table(spark, sf_dir, "part")
    noisy = F.concat(F.lit("  "), F.upper(F.replace("p_name", F.lit(" "), F.lit("\t  "))), F.lit(" "))
    left = parts.select(
        "p_partkey",
        normalize_text(noisy).alias("name"),
        normalize_text(F.when(F.col("p_brand") == "Brand#1", "other").otherwise("SITE")).alias("source"),
    )
    names = (
        parts.groupBy(F.initcap("p_name").alias("name"))
        .agg(F.min("p_partkey").alias("first_part"), F.max("p_retailprice").alias("top_price"))
        .withColumn("name", normalize_text(F.col("name")))
        .withColumn("source", normalize_text(F.lit("Site")))
    )
    return lookup(left, names, ["name", "source"]).select("p_partkey", "first_part", "top_price")


@query(
    """
WITH last_order AS (
  SELECT o_custkey, o_orderkey, o_orderpriority FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders) WHERE rn = 1)
SELECT n_name AS nation, coalesce(o_orderpriority, 'none') AS priority,
       count(*) AS customers, count(DISTINCT o_orderkey) AS orders
FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN last_order ON c_custkey = o_custkey
GROUP BY ALL
"""
)
def star_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report over conformed dimensions: customers by nation and priority of their last order."""
    orders = table(spark, sf_dir, "orders")
    last = latest_per_key(
        orders.select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate"),
        ["o_custkey"],
        [F.desc("o_orderdate"), F.desc("o_orderkey")],
    )
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation")
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    last = last.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderpriority")
    return (
        lookup(lookup(customers, nations, ["c_nationkey"], "inner"), last, ["c_custkey"])
        .groupBy("nation", F.coalesce("o_orderpriority", F.lit("none")).alias("priority"))
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.countDistinct("o_orderkey").alias("orders"),
        )
    )


@query(
    """
SELECT c_mktsegment, count(*) AS n, count(*) AS n_keys, count(*) FILTER (c_custkey % 3 = 0) AS as_before FROM customer GROUP BY 1
"""
)
def star_unique_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of so few bits that hashes collide, given out in two loads: unique, and those of the
    first load as they were."""
    names = table(spark, sf_dir, "customer").select("c_name", "c_custkey", "c_mktsegment")
    first = assign_keys(names.filter("c_custkey % 3 = 0"), ["c_name"], bits=20).checkpoint()
    both = assign_keys(names, ["c_name"], first, bits=20)
    once = both.groupBy("key").agg(F.count(F.lit(1)).alias("_n"))
    before = first.select("c_name", F.col("key").alias("_before"))
    rows = names.join(both, "c_name").join(once, "key").join(before, "c_name", "left")
    return rows.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("_n") == 1).alias("n_keys"),
        F.count_if(F.col("key") == F.col("_before")).alias("as_before"),
    )
