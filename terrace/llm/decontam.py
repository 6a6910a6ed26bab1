"""Documents that contain benchmark passages: a prefix-filtered containment join.

A window of an item is contained in a document only with all its words, so of its words,
ordered from the rarest in the corpus, the first is the necessary prefix: only documents
with that word can hold the window. The word counts come from all documents. Each
occurrence of a prefix word that leaves room for a window (positional and length bounds)
is then verified: the words around it must be those of the window.

Everything is DataFrame functions. The corpus is exploded into words twice, without its
texts, and meets word lists made from the benchmark; these are broadcast only if their
measured size is small, and joined by shuffle otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import keep, small

WINDOW = 10
# Between words: ASCII other than letters and digits. Capitals are lowered afterwards.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def raw_words(text: Column | str) -> Column:
    """Words of a text, capitals kept; empty for null."""
    return F.coalesce(F.array_remove(F.split(text, BETWEEN), ""), F.array().cast("array<string>"))


def lowered(word: Column | str) -> Column:
    """A-Z lowered and nothing else."""
    word = F.col(word) if isinstance(word, str) else word
    plain = F.octet_length(word) == F.char_length(word)
    return F.when(plain, F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def _windows(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct windows ``(wid, words)`` and which items have them ``(wid, item_id)``."""
    items = benchmark.select("item_id", F.transform(raw_words("text"), lowered).alias("all"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - (WINDOW - 1), F.lit(1)))
    each = (
        items.filter(F.size("all") > 0)
        .select("item_id", "all", F.explode(starts).alias("at"))
        .select("item_id", F.slice("all", F.col("at"), WINDOW).alias("words"))
        .distinct()
    )
    windows = keep(
        each.select("words").distinct().withColumn("wid", F.monotonically_increasing_id()),
        "decontam-windows",
    )
    return windows, each.join(windows, "words").select("wid", "item_id")


def _same(a: str, b: str, *cols: str) -> Column:
    return reduce(Column.__and__, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols])


def contamination(docs: DataFrame, benchmark: DataFrame, keyed: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    A window is ten consecutive words of an item (all of them if there are fewer; items
    without words have none); every document word inside an occurrence of a window is hit.
    Null and empty texts have no words. Rows that repeat a doc_id each count for their own
    text; repeated items count once per item_id, and a null item_id counts as an item but
    has no place in the list of ids. Without documents there are no rows, without benchmark
    no hits. Other columns are not read. With ``keyed``, ``key`` (xxhash64 of the text) is
    added, for rows whose doc_id is null or repeated.
    """
    # The hash of the text tells rows with one doc_id, or none, apart.
    texts = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    windows, owners = _windows(benchmark)
    words = windows.select("wid", "words", F.posexplode("words").alias("off", "word"))
    vocabulary = small(keep(words.select("word").distinct(), "decontam-words"))

    exploded = texts.select("doc_id", "key", raw_words("text").alias("all")).select(
        "doc_id", "key", F.size("all").alias("n"), F.posexplode("all").alias("pos", "raw")
    )
    spread = exploded.withColumn("word", lowered("raw")).drop("raw")
    counts = keep(
        spread.select("word").join(vocabulary, "word").groupBy("word").agg(F.count("*").alias("n")),
        "decontam-counts",
    )

    # The rarest word of each window and its place; a window with a word that no document
    # has cannot occur.
    rarest = words.join(counts, "word", "left").groupBy("wid").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "off")).alias("r")
    )
    prefixes = keep(
        windows.join(rarest.filter("r.n > 0"), "wid").select(
            "wid", "words", F.size("words").alias("len"), F.col("r.word").alias("word"), F.col("r.off").alias("off")
        ),
        "decontam-prefixes",
    )
    bounds = keep(
        prefixes.groupBy("word").agg(
            F.min("off").alias("before"), F.min(F.col("len") - F.col("off")).alias("after")
        ),
        "decontam-bounds",
    )
    found = (
        spread.join(small(bounds), "word")
        .filter("pos >= before AND n - pos >= after")
        .groupBy("doc_id", "key")
        .agg(F.collect_set("pos").alias("places"))
    )

    # Verify: the words around each place against every window with that prefix word.
    around = F.transform(
        "places",
        lambda p: F.struct(
            p.alias("pos"),
            F.transform(
                F.slice(F.col("all"), F.greatest(p - (WINDOW - 2), F.lit(1)), F.least(p, F.lit(WINDOW - 1)) + WINDOW),
                lowered,
            ).alias("near"),
        ),
    )
    places = (
        texts.alias("t")
        .join(found.alias("f"), _same("t", "f", "doc_id", "key"))
        .select("t.doc_id", "t.key", raw_words("t.text").alias("all"), "f.places")
        .select("doc_id", "key", F.filter("places", lambda p: p < F.size("all")).alias("places"), "all")
        .select("doc_id", "key", F.explode(around).alias("c"))
        .select("doc_id", "key", "c.pos", "c.near", F.least("c.pos", F.lit(WINDOW - 1)).alias("at"))
        .withColumn("word", F.element_at("near", F.col("at") + 1))
    )
    hits = keep(
        places.join(small(prefixes), "word")
        .filter("at >= off AND slice(near, at - off + 1, len) = words")
        .select("doc_id", "key", "wid", (F.col("pos") - F.col("off")).alias("start"), "len")
        .distinct(),
        "decontam-hits",
    )
    covered = F.flatten(
        F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1))
    )
    hit = (
        hits.groupBy("doc_id", "key")
        .agg(F.collect_set(F.struct("start", "len")).alias("spans"))
        .select("doc_id", "key", F.size(F.array_distinct(covered)).cast("long").alias("n_hit"))
    )
    ids = F.collect_set(F.col("item_id").cast("string"))
    named = (
        hits.select("doc_id", "key", "wid").distinct().join(owners, "wid")
        .groupBy("doc_id", "key")
        .agg((F.size(F.collect_set("item_id")) + F.max(F.col("item_id").isNull().cast("int"))).cast("long").alias("n_items"),
             F.array_join(F.array_sort(ids), ",").alias("items"))
    )
    by_doc = hit.alias("a").join(named.alias("b"), _same("a", "b", "doc_id", "key")).select("a.*", "b.n_items", "b.items")
    base = texts.select(
        "doc_id", F.xxhash64("text").alias("key"), F.size(raw_words("text")).cast("long").alias("n_words")
    )
    zero = F.lit(0).cast("long")
    return (
        base.alias("d")
        .join(by_doc.alias("h"), _same("d", "h", "doc_id", "key"), "left")
        .select(
            "d.doc_id",
            "d.n_words",
            F.coalesce("h.n_hit", zero).alias("n_hit"),
            F.coalesce("h.n_items", zero).alias("n_items"),
            F.sha2(F.coalesce("h.items", F.lit("")), 256).alias("items_sha256"),
            (F.coalesce("h.n_hit", zero) > 0).alias("contaminated"),
            *([F.col("d.key")] if keyed else []),
        )
    )


# Windows of each length that items have, in every document, joined on their words.
SQL = r"""
WITH b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, w[i:i + least(len(w), 10) - 1] AS win, least(len(w), 10) AS k
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
dw AS (
  SELECT doc_id, i, k, w[i:i + k - 1] AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
h AS (SELECT dw.doc_id, dw.i, dw.k, bw.item_id FROM dw JOIN bw ON dw.win = bw.win),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM h)) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""
