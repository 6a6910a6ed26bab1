"""Lines that many documents share, dropped by line hash.

The lines of every text are exploded with their position, normalised (white space at both
ends stripped, A-Z in lower case) and hashed to 128 bits. Lines of at least ``LEAST`` code
points whose hash is found in at least ``DOCUMENTS`` distinct documents go, except in the
document with the largest doc_id that holds them; what stays is put together by position.

Only hashes and positions are shuffled for the counts, first by hash and document, then
summed by hash, so a line of a third of all documents is never gathered. Shared hashes meet
the lines again by ``lookup`` (hot hashes by broadcast of just their rows). Texts go through
a shuffle only to meet their own positions, and not at all where the table of positions is
small. A text without shared lines is returned as it is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import keep, small
from terrace.operators.skew import lookup

LEAST = 40
DOCUMENTS = 5
# Fixed values of the operator's definition.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(line: Column) -> Column:
    """The key of a line."""
    return F.translate(F.trim(line, F.lit(SPACE)), UPPER, LOWER)


def _with(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` evaluated once per row: inside a lambda it is a variable."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _without_places(text: Column, places: Column) -> Column:
    """``text`` without the lines at ``places`` (sorted, from 0): the runs of lines between
    them, so the cost is that of the lines, not lines times places."""

    def of(lines: Column) -> Column:
        def pieces(cuts: Column) -> Column:
            runs = F.transform(
                F.sequence(F.lit(1), F.size(cuts) - 1),
                lambda i: F.slice(lines, F.get(cuts, i - 1) + 2, F.get(cuts, i) - F.get(cuts, i - 1) - 1),
            )
            return F.array_join(F.flatten(runs), "\n")

        return _with(F.concat(F.array(F.lit(-1)), places, F.array(F.size(lines))), pieces)

    return _with(F.split(text, "\n", -1), of)


def kept_lines(docs: DataFrame, least: int = LEAST, documents: int = DOCUMENTS) -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_dropped, text`` (what is left of it).

    Null is the empty text, which has one empty line. A document is a doc_id with its text:
    rows that repeat both count once, rows with one id and different texts, or without an id,
    each for themselves. No id is the smallest one; of several rows with the largest doc_id all
    keep the line. An empty table gives no rows; other columns are not read.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    key = normalised(F.col("line"))
    lines = (
        texts.filter(F.length("text") >= least)  # no shorter text has a long line
        .select("doc_id", "th", F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
        .select("doc_id", "th", "place", key.alias("line"))
        .filter(F.length("line") >= least)
        .select("doc_id", "th", "place", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"))
    )
    lines = keep(lines, "lines-hashes")
    shared = (
        lines.groupBy("h1", "h2")
        .agg(F.count_distinct(F.xxhash64("doc_id", "th")).alias("n"), F.max("doc_id").alias("owner"))
        .filter(F.col("n") >= documents)
        .select("h1", "h2", "owner", F.lit(True).alias("shared"))
    )
    shared = keep(shared, "lines-shared")
    dropped = (
        lookup(lines, shared, ["h1", "h2"])
        .filter(F.col("shared") & ~F.col("doc_id").eqNullSafe(F.col("owner")))
        # Rows that repeat a document have the same places: each once.
        .groupBy("doc_id", "th")
        .agg(F.array_sort(F.collect_set("place")).alias("places"))
    )
    dropped = small(keep(dropped, "lines-dropped"))
    same = F.col("t.doc_id").eqNullSafe(F.col("d.doc_id")) & (F.col("t.th") == F.col("d.th"))
    return texts.alias("t").join(dropped.alias("d"), same, "left").select(
        "t.doc_id",
        (F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("places").isNull(), F.col("text")).otherwise(_without_places(F.col("text"), F.col("places"))).alias("text"),
    )


def without_shared_lines(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_dropped, kept_sha256``; see ``kept_lines``."""
    return kept_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = f"""
WITH lines AS (
  SELECT doc_id, place, lines[place] AS line,
         translate(trim(lines[place], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
  FROM (SELECT doc_id, lines, unnest(generate_series(1, len(lines))) AS place
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
shared AS (
  SELECT key, max(doc_id) AS owner FROM lines WHERE length(key) >= {LEAST}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {DOCUMENTS}),
marked AS (
  SELECT doc_id, place, line, owner IS NOT NULL AND owner <> doc_id AS gone FROM lines LEFT JOIN shared USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
