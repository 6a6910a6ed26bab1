"""Entity resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.resolve import resolve
from terrace.queries.base import query, table
from terrace.sources.places import shared_dir

def _ratio(a: str, b: str) -> str:
    return f"CASE WHEN greatest(length({a}), length({b})) > 0 THEN 1 - levenshtein({a}, {b})::DOUBLE / greatest(length({a}), length({b})) ELSE 0 END"


def _less(a: str, b: str) -> str:
    return f"list_sort(list_filter(list_distinct({a}), lambda w: NOT list_contains({b}, w)))"


# Candidates (over half of the lighter name's word weight shared, or a Dice coefficient of the
# trigrams' weights of 45 percent), scored; the top five per name, from `asked(name)` and
# `masters(id, name)`. A name that equals masters has only those as candidates.
_SCORES = rf"""
every AS (SELECT name FROM asked UNION SELECT name FROM masters),
known AS (SELECT count(DISTINCT name) + 7 AS n FROM masters),
words AS (SELECT name, unnest(list_distinct(string_split(name, ' '))) AS w FROM every),
word_uses AS (SELECT w, count(*) AS n FROM words WHERE name IN (SELECT name FROM masters) GROUP BY w),
weighed AS (
  SELECT name, w, least(10, length(bin((SELECT n FROM known))) - 1, length(bin((SELECT n FROM known) // coalesce(n, 1))) - 1) AS n
  FROM words LEFT JOIN word_uses USING (w)),
word_sizes AS (SELECT name, sum(n) AS n FROM weighed GROUP BY name),
plain AS (
  SELECT name, gram || row_number() OVER (PARTITION BY name, gram) AS gram FROM (
    SELECT name, substr('  ' || w || ' ', CAST(i AS BIGINT), 3) AS gram
    FROM (SELECT name, w, unnest(range(1, len(w) + 2)) AS i
          FROM (SELECT name, unnest(string_split(name, ' ')) AS w FROM every) WHERE w <> ''))),
uses AS (SELECT gram, count(*) AS n FROM plain WHERE name IN (SELECT name FROM masters) GROUP BY gram),
grams AS (
  SELECT name, gram, least(10, length(bin((SELECT n FROM known) // coalesce(n, 1))) - 1) AS n
  FROM plain LEFT JOIN uses USING (gram)),
sizes AS (SELECT name, sum(n) AS n FROM grams GROUP BY name),
pairs AS (
  SELECT name, master_name FROM (
    SELECT a.name, m.name AS master_name, sum(a.n) AS shared
    FROM grams a JOIN grams m ON a.gram = m.gram
    WHERE a.n > 0 AND a.name IN (SELECT name FROM asked) AND m.name IN (SELECT name FROM masters)
    GROUP BY a.name, m.name) p
  JOIN sizes s USING (name) JOIN sizes t ON t.name = master_name
  WHERE shared * 200.0 / (s.n + t.n) >= 45
  UNION
  SELECT name, master_name FROM (
    SELECT a.name, m.name AS master_name, sum(a.n) AS shared
    FROM weighed a JOIN weighed m ON a.w = m.w
    WHERE a.name IN (SELECT name FROM asked) AND m.name IN (SELECT name FROM masters)
    GROUP BY a.name, m.name) p
  JOIN word_sizes s USING (name) JOIN word_sizes t ON t.name = master_name
  WHERE shared * 2 > least(s.n, t.n)
  UNION SELECT name, name FROM asked WHERE name IN (SELECT name FROM masters)),
parts AS (
  SELECT *, array_to_string(list_sort(x), ' ') AS sx, array_to_string(list_sort(y), ' ') AS sy,
         array_to_string(list_sort(list_intersect(x, y)), ' ') AS core,
         array_to_string(list_concat(list_sort(list_intersect(x, y)), {_less("x", "y")}), ' ') AS wx,
         array_to_string(list_concat(list_sort(list_intersect(x, y)), {_less("y", "x")}), ' ') AS wy
  FROM (SELECT name, master_name, string_split(name, ' ') AS x, string_split(master_name, ' ') AS y FROM pairs)),
scored AS (
  SELECT p.name, m.id, p.name = m.name AS is_equal, CASE WHEN p.name = m.name THEN 100.0::DOUBLE ELSE
    100 * greatest({_ratio("p.name", "m.name")}, 0.95::DOUBLE * greatest({_ratio("sx", "sy")}, {_ratio("core", "wx")}, {_ratio("core", "wy")}, {_ratio("wx", "wy")}))
    END AS score
  FROM parts p JOIN masters m ON m.name = p.master_name),
top AS (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY score DESC, id) AS rk
  FROM (SELECT *, bool_or(is_equal) OVER (PARTITION BY name) AS has_equal FROM scored)
  WHERE is_equal OR NOT has_equal QUALIFY rk <= 5),
"""


def _misspelt(name: Column, form: Column) -> Column:
    """One of six spellings of a two-word name."""
    first, second = F.split_part(name, F.lit(" "), F.lit(1)), F.split_part(name, F.lit(" "), F.lit(2))
    return (
        F.when(form == 0, name)
        .when(form == 1, F.concat_ws(", ", F.upper(second), first))
        .when(form == 2, F.concat_ws(" ", first, F.substring(second, 1, 3)))
        .when(form == 3, F.concat(F.lit("team "), name))
        .when(form == 4, F.substring(second, 2, 9))
        .otherwise(F.lit(""))
    )


_MISSPELT = """CASE p_partkey % 6
    WHEN 0 THEN p_name WHEN 1 THEN split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1)
    WHEN 2 THEN split_part(p_name, ' ', 1) || ' ' || substr(split_part(p_name, ' ', 2), 1, 3)
    WHEN 3 THEN 'team ' || p_name WHEN 4 THEN substr(split_part(p_name, ' ', 2), 2, 9) ELSE '' END"""


@query(
    f"""
WITH names AS (SELECT p_partkey, p_brand, {_MISSPELT} AS name FROM part),
masters AS (SELECT DISTINCT p_name AS id, p_name AS name FROM part),
asked AS (SELECT DISTINCT name FROM names WHERE name <> ''),
{_SCORES}
best AS (SELECT name, max(CASE WHEN rk = 1 THEN id END) AS id, max(CASE WHEN rk = 1 THEN score END) AS score
         FROM top GROUP BY name)
SELECT p_partkey, CASE WHEN score >= 50 THEN id END AS master_key,
       round(coalesce(CASE WHEN score >= 50 THEN score / 100 END, 0), 3) AS confidence_score
FROM names LEFT JOIN best ON names.name = best.name
"""
)
def fuzzy_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Misspelt part names to the names in use."""
    shared_dir(spark)
    parts = table(spark, sf_dir, "part")
    names = parts.select("p_partkey", _misspelt(F.col("p_name"), F.col("p_partkey") % 6).alias("name"))
    masters = parts.select("p_name").distinct().select(F.col("p_name").alias("id"), "p_name")
    found = resolve(names, masters, "name", "id", "p_name")
    return found.select(
        "p_partkey", "master_key", F.round(F.col("confidence_score").cast("double"), 3).alias("confidence_score")
    )


@query(
    f"""
WITH supply AS (
  SELECT DISTINCT l_suppkey AS id, CAST(year(l_shipdate) AS INTEGER) AS season, s_nationkey AS nation
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
names AS (
  SELECT DISTINCT substr(lower(replace(s_name, '#', ' ')), 1, length(s_name) - 1) AS name, season, nation
  FROM supply JOIN supplier ON id = s_suppkey),
masters AS (SELECT CAST(s_suppkey AS VARCHAR) AS id, lower(replace(s_name, '#', ' ')) AS name FROM supplier),
asked AS (SELECT DISTINCT name FROM names),
{_SCORES}
offers AS (
  SELECT n.name, n.season, n.nation, t.id, t.score, t.rk,
         EXISTS (SELECT 1 FROM supply s WHERE CAST(s.id AS VARCHAR) = t.id AND s.season = n.season
                 AND s.nation = n.nation) AS fits
  FROM names n JOIN top t ON n.name = t.name),
choice AS (
  SELECT name, season, nation, max(CASE WHEN rk = 1 THEN id END) AS best,
         max(CASE WHEN rk = 1 THEN score END) AS first, max(CASE WHEN rk = 2 THEN score END) AS second,
         count(*) FILTER (fits) AS fitting, max(CASE WHEN fits THEN id END) AS fit,
         max(CASE WHEN fits THEN score END) AS fit_score
  FROM offers GROUP BY name, season, nation),
pick AS (
  SELECT *, CASE WHEN first - second < 5 AND fitting = 1 THEN fit ELSE best END AS id,
            CASE WHEN first - second < 5 AND fitting = 1 THEN fit_score ELSE first END AS score FROM choice)
SELECT n.name, n.season, n.nation, CASE WHEN score >= 50 THEN id END AS master_key,
       round(coalesce(CASE WHEN score >= 50 THEN score / 100 END, 0), 3) AS confidence_score
FROM names n LEFT JOIN pick p ON n.name = p.name AND n.season = p.season AND n.nation = p.nation
"""
)
def fuzzy_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut-off supplier names; close candidates are told apart by (season, nation)."""
    shared_dir(spark)
    suppliers = table(spark, sf_dir, "supplier")
    supply = (
        table(spark, sf_dir, "lineitem")
        .select(F.col("l_suppkey").alias("s_suppkey"), F.year("l_shipdate").alias("season"))
        .distinct()
        .join(suppliers, "s_suppkey")
        .select("s_suppkey", "season", F.col("s_nationkey").alias("nation"), "s_name")
    )
    plain = F.replace("s_name", F.lit("#"), F.lit(" "))
    cut = F.substring(F.lower(plain), F.lit(1), F.length("s_name") - 1)
    names = supply.select(cut.alias("name"), "season", "nation").distinct()
    found = resolve(
        names,
        suppliers,
        "name",
        "s_suppkey",
        "s_name",
        context=supply,
        context_on=["season", "nation"],
    )
    return found.select(
        "name",
        "season",
        "nation",
        "master_key",
        F.round(F.col("confidence_score").cast("double"), 3).alias("confidence_score"),
    )
