"""Parsing, reshaping and deduplication of records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrace.functions import (
    map_status,
    nfkd_strip,
    parse_duration,
    parse_race_time_ms,
    race_timestamp,
    record_text,
    slug,
)
from terrace.operators.shape import (
    compute,
    flatten_json,
    latest_per_key,
    pick_columns,
    rename_lower,
    with_keys,
)
from terrace.queries.base import query, spread, table
from terrace.sources.pages import cell, html_rows
from terrace.sources.payloads import payload_records, variant_leaves, variant_records
from terrace.sources.schedule import nth_row, pick_rounds


@query(
    """
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1
""",
    name="latest_per_key",
)
def latest_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", "ts")
    newest = [F.desc("ts"), F.desc("event_id")]
    return latest_per_key(events, ["user_id", "event_type"], newest).drop("ts")


@query(
    """
SELECT event_id,
       CASE event_id % 5
         WHEN 3 THEN NULL
         WHEN 4 THEN round(value - 86400, 3)
         ELSE round(value + (CASE WHEN event_id % 5 = 1 THEN 0 ELSE event_id * 60 END), 3) END AS seconds
FROM events
"""
)
def duration_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days and clock, clock alone, a missing mark, and a negative number of days."""
    value, form = F.col("value"), F.col("event_id") % 5
    clock = F.substring_index(record_text(value, "double"), " ", -1)
    text = (
        F.when(form == 1, clock)
        .when(form == 3, F.lit("NaT"))
        .when(form == 4, F.concat(F.lit("-1 days +"), clock))
        .otherwise(record_text(value + F.col("event_id") * 60, "double"))
    )
    texts = table(spark, sf_dir, "events").select("event_id", text.alias("text"))
    return texts.select("event_id", F.round(parse_duration(F.col("text")), 3).alias("seconds"))


@query(
    """
SELECT o_orderkey,
       CAST((o_orderkey % 3) * 3600000 + (o_orderkey % 60) * 60000
         + (CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE (o_custkey % 600) * 100 END) AS DOUBLE) AS race_time_ms,
       CASE WHEN o_orderkey % 2 = 0 THEN '+' || o_custkey || ' laps' ELSE '' END AS gap
FROM orders
"""
)
def race_time_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Race times with missing parts, and the gap to the leader in brackets."""
    key, tenths = F.col("o_orderkey"), F.col("o_custkey") % 600
    seconds = F.concat(F.floor(tenths / 10), F.lit("."), tenths % 10, F.lit("s"))
    text = F.concat_ws(
        " ",
        F.when(key % 3 != 0, F.concat(key % 3, F.lit("h"))),
        F.when(key % 60 != 0, F.concat(key % 60, F.lit("m"))),
        F.when(key % 4 != 0, seconds),
        F.when(key % 2 == 0, F.concat(F.lit("( +"), F.col("o_custkey"), F.lit(" laps)"))),
    )
    texts = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"))
    return texts.select(
        "o_orderkey",
        F.round(parse_race_time_ms(F.col("text")), 1).alias("race_time_ms"),
        F.regexp_extract("text", r"\(\s*(\+[^)]+)\)", 1).alias("gap"),
    )


@query(
    """
WITH p AS (
  SELECT o_orderkey, CASE o_orderkey % 6
    WHEN 0 THEN CAST(o_custkey AS VARCHAR) WHEN 1 THEN 'ab' WHEN 2 THEN 'NpQ' WHEN 3 THEN 'f'
    WHEN 4 THEN o_orderstatus ELSE o_orderpriority END AS position
  FROM orders)
SELECT o_orderkey, position,
       CASE WHEN regexp_full_match(position, '[0-9]+') THEN 'FINISHED'
            ELSE CASE lower(position)
              WHEN 'ab' THEN 'DNF' WHEN 'nc' THEN 'NC' WHEN 'np' THEN 'DNS' WHEN 'nq' THEN 'DNQ'
              WHEN 'npq' THEN 'DNPQ' WHEN 'dsq' THEN 'DSQ' WHEN 'exc' THEN 'EXCLUDED'
              WHEN 'f' THEN 'WITHDRAWAL' ELSE upper(position) END END AS status
FROM p
"""
)
def status_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    form = F.col("o_orderkey") % 6
    position = (
        F.when(form == 0, F.col("o_custkey").cast("string"))
        .when(form == 1, "ab")
        .when(form == 2, "NpQ")
        .when(form == 3, "f")
        .when(form == 4, F.col("o_orderstatus"))
        .otherwise(F.col("o_orderpriority"))
    )
    rows = table(spark, sf_dir, "orders").select("o_orderkey", position.alias("position"))
    return rows.select("o_orderkey", "position", map_status(F.col("position")).alias("status"))


@query(
    """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, user_id AS owner_id,
       event_type AS kind, round(value, 2) AS amount
FROM events
"""
)
def nested_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse JSON text, then read fields three levels down."""
    events = table(spark, sf_dir, "events")
    wrapped = events.withColumn(
        "body",
        F.to_json(
            F.struct(
                F.col("event_id").alias("id"),
                F.col("props").alias("inner"),
                F.struct(
                    F.col("user_id").cast("string").alias("userId"),
                    F.struct(
                        F.col("event_type").alias("kind"), F.col("value").cast("string").alias("amount")
                    ).alias("What"),
                ).alias("Who"),
            )
        ),
    )
    record = StructType.fromDDL(
        "id bigint, inner string, Who struct<userId: string, What: struct<kind: string, amount: string>>"
    )
    flat = flatten_json(wrapped.select("body"), record, "body")
    return flat.select(
        F.col("id").alias("event_id"),
        F.from_json("inner", "k int").getField("k").alias("k"),
        F.col("Who.userId").try_cast("bigint").alias("owner_id"),
        F.col("Who.What.kind").alias("kind"),
        F.round(F.col("Who.What.amount").try_cast("double"), 2).alias("amount"),
    )


@query(
    """
SELECT l_orderkey AS order_id, CAST(n AS INTEGER) AS number, round(l_quantity * n, 1) AS points,
       l_shipmode AS source
FROM (SELECT l_orderkey, l_quantity, l_returnflag AS l_shipmode, unnest(range(1, l_linenumber + 1)) AS n
      FROM lineitem)
""",
    name="payload_records",
)
def payload_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records inside API payloads, one payload per line item, tagged with their source."""
    numbers = F.sequence(F.lit(1), F.col("l_linenumber"))
    records = F.transform(
        numbers,
        lambda n: F.struct(n.cast("string").alias("number"), (F.col("l_quantity") * n).alias("points")),
    )
    race = F.struct(F.col("l_orderkey").alias("id"), records.alias("Results"))
    payload = F.to_json(F.struct(F.struct(F.array(race).alias("Races")).alias("RaceTable")))
    payloads = spread(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", payload.alias("payload"))
    rows = payload_records(
        payloads,
        "payload",
        ["RaceTable", "Races", 0, "Results"],
        "number string, points double",
        {"order_id": F.col("l_orderkey"), "source": F.col("l_returnflag")},
    )
    return rows.select(
        "order_id", F.col("number").try_cast("int").alias("number"), F.round("points", 1).alias("points"), "source"
    )


@query(
    """
SELECT page_id, CAST(i - 1 AS INTEGER) AS "row", trim(items[i][1]) AS href, trim(items[i][2]) AS link
FROM (SELECT page_id, items, unnest(range(1, len(items) + 1)) AS i FROM (
  SELECT page_id, list_zip(
    regexp_extract_all(nav, '<li><a href="([^"]*)">([^<]*)</a></li>', 1),
    regexp_extract_all(nav, '<li><a href="([^"]*)">([^<]*)</a></li>', 2)) AS items
  FROM (SELECT page_id, regexp_extract(html, '(?s)<ul>(.*?)</ul>', 1) AS nav FROM pages)))
"""
)
def html_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of an HTML table on every page (the page's first list, marked up as a table)."""
    item = r'<li><a href="([^"]*)">([^<]*)</a></li>'
    html = F.regexp_replace("html", item, r'<tr><td data-key="$1"> <a>$2</a></td></tr>')
    html = F.replace(html, F.lit("<ul>"), F.lit('<table class="datatable wide"><tbody>'))
    html = F.replace(html, F.lit("</ul>"), F.lit("</tbody></table>"))
    pages = spread(spark, sf_dir, "pages").select("page_id", html.alias("html"))
    rows = html_rows(pages, "html", "datatable", ["page_id"])
    return rows.select("page_id", "row", cell(0, "attr:data-key").alias("href"), cell(0, "link").alias("link"))


@query(
    """
WITH s AS (
  SELECT o_custkey, o_orderkey, o_orderdate,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders WHERE o_orderstatus <> 'F')
SELECT 'third' AS pick, o_custkey, o_orderkey FROM s WHERE rn = 3
UNION ALL
SELECT 'latest', o_custkey, o_orderkey FROM (
  SELECT * FROM orders WHERE o_orderdate < DATE '2000-01-01' ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1)
UNION ALL
SELECT 'tenth', o_custkey, o_orderkey FROM (
  SELECT * FROM orders WHERE o_orderstatus <> 'F' ORDER BY o_orderdate, o_orderkey LIMIT 1 OFFSET 9)
"""
)
def schedule_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Third open order of each customer, latest order before a day, tenth open order of all."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    order, cancelled = ["o_orderdate", "o_orderkey"], F.col("o_orderstatus") == "F"
    today = F.lit("2000-01-01").cast("date")
    picks = {
        "third": nth_row(orders, 3, order, cancelled, ["o_custkey"]),
        "latest": pick_rounds(orders, "latest", "o_orderdate", "o_orderkey", today),
        "tenth": nth_row(orders, 10, order, cancelled),
    }
    parts = [df.select(F.lit(name).alias("pick"), "o_custkey", "o_orderkey") for name, df in picks.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    """
SELECT o_orderkey, 'r' || year(o_orderdate) || '_' || month(o_orderdate) || '_R' AS session_id,
       strftime(CASE o_orderkey % 3
         WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)
         WHEN 1 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_hours(o_custkey % 24)
         ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_hours(o_custkey % 24) - INTERVAL 2 HOUR END,
         '%Y-%m-%d %H:%M:%S') AS started
FROM orders
""",
    name="race_timestamp",
)
def race_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date and nullable time text, with and without an offset, to one timestamp."""
    hour = F.lpad((F.col("o_custkey") % 24).cast("string"), 2, "0")
    form = F.col("o_orderkey") % 3
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.when(form == 1, F.concat(hour, F.lit(":00:00Z")))
        .when(form == 2, F.concat(hour, F.lit(":00:00+02")))
        .alias("time"),
        F.concat_ws("_", F.concat(F.lit("r"), F.year("o_orderdate")), F.month("o_orderdate"), F.lit("R")).alias(
            "session_id"
        ),
    )
    started = race_timestamp(F.col("date"), F.col("time"))
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), started.cast("timestamp_ntz"))
    return rows.select("o_orderkey", "session_id", F.date_format(utc, "yyyy-MM-dd HH:mm:ss").alias("started"))


@query(
    """
SELECT c_custkey AS driver_id, c_name AS driver_tla, CAST(c_nationkey AS INTEGER) AS permanent_number,
       CAST(NULL AS VARCHAR) AS nickname, c_acctbal * 2 AS double_points, 'given' AS source
FROM customer WHERE c_custkey % 10 <> 3
"""
)
def optional_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared columns of which one is absent; rename, lower-case, compute, drop keyless rows."""
    customers = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_custkey") % 10 != 3, F.col("c_custkey")).alias("driverId"),
        F.col("c_name").alias("Code"),
        F.concat(F.col("c_nationkey"), F.lit("")).alias("permanentNumber"),
        F.col("c_acctbal").alias("Points"),
    )
    declared = StructType.fromDDL(
        "driverId bigint, Code string, permanentNumber string, Points double, Nickname string"
    )
    renamed = rename_lower(
        pick_columns(customers, declared),
        {"driverId": "driver_id", "permanentNumber": "permanent_number", "Code": "driver_tla", "gone": "x"},
    )
    done = compute(
        renamed,
        {
            "permanent_number": "try_cast(permanent_number AS int)",
            "double_points": "points * 2",
            "source": F.lit("given"),
        },
    )
    return with_keys(done, ["driver_id"]).drop("points")


@query(
    r"""
WITH t AS (
  SELECT p_partkey AS id, CASE p_partkey % 3
    WHEN 0 THEN 'Grand Prix de ' || p_name WHEN 1 THEN 'GP d''' || upper(p_name)
    ELSE p_name || ' (n° ' || p_size || ')' END AS title
  FROM part
  UNION ALL SELECT -1 - n_nationkey, 'Grand-Prix du ' || n_name FROM nation)
SELECT id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(
         lower(trim(title)),
         '^(grand[\s-]prix|gp)\s*(de\s+l[''’]|de\s+la|de|du|des|d[''’])?\s*', ''),
         '[^a-z0-9_\s-]', '', 'g'), '[\s_]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug
FROM t
"""
)
def slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles to slugs; accents are added first and must come off again."""
    form, name = F.col("p_partkey") % 3, F.col("p_name")
    title = (
        F.when(form == 0, F.concat(F.lit("Grand Prix de "), name))
        .when(form == 1, F.concat(F.lit("GP d'"), F.upper(name)))
        .otherwise(F.concat(name, F.lit(" (n° "), F.col("p_size"), F.lit(")")))
    )
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), title.alias("title"))
    nations = table(spark, sf_dir, "nation").select(
        (F.lit(-1) - F.col("n_nationkey")).cast("bigint").alias("id"),
        F.concat(F.lit("Grand-Prix du "), F.col("n_name")).alias("title"),
    )
    titles = parts.unionByName(nations)
    prefix = F.regexp_extract("title", "^(?:Grand.Prix d[eu] |GP d')", 0)
    rest = F.translate(F.substr("title", F.length(prefix) + 1), "eoEO", "éõÉÔ")
    return titles.select("id", slug(F.concat(prefix, rest)).alias("slug"))


@query(
    """
SELECT c_custkey, trim(c_mktsegment || ' ' || c_name) AS label FROM customer
"""
)
def nfkd_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compatibility forms (no-break spaces, wide letters) back to plain text."""
    wide = F.translate("c_name", "CM", "ＣＭ")
    noisy = F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" "), wide, F.lit(" "))
    return table(spark, sf_dir, "customer").select("c_custkey", nfkd_strip(noisy).alias("label"))


_COUNTED = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


@query(" UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in _COUNTED))
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [
        table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("name"), "n")
        for t in _COUNTED
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@query(
    """
SELECT user_id, event_id, path, value FROM (
  SELECT user_id, event_id, unnest([
      {'path': 'id', 'value': event_id::VARCHAR}, {'path': 'kind', 'value': event_type},
      {'path': 'props.k', 'value': json_extract_string(props, '$.k')},
      {'path': 'list.0', 'value': (event_id % 3)::VARCHAR}, {'path': 'list.1.deep', 'value': NULL}], recursive := true)
  FROM events)
UNION ALL SELECT user_id, event_id, 'only.here', user_id::VARCHAR FROM events WHERE event_id % 5 = 0
"""
)
def payload_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of unknown fields, walked by path: every value that any of them has."""
    own = F.when(F.col("event_id") % 5 == 0, F.format_string(', "only": {"here": %d}', "user_id")).otherwise("")
    record = F.format_string(
        '{"id": %d, "kind": "%s", "props": %s, "list": [%d, {"deep": null}], "none": {}%s}', "event_id", "event_type", "props", F.col("event_id") % 3, own
    )
    payload = F.concat(F.lit('{"data": [{"rows": ['), record, F.lit("]}]}"))
    calls = spread(spark, sf_dir, "events").select("user_id", "event_id", payload.alias("body"))
    records = variant_records(calls, "body", ["data", 0, "rows"], {"user_id": F.col("user_id"), "event_id": F.col("event_id")})
    return variant_leaves(records.drop("place")).select("user_id", "event_id", "path", "value")
