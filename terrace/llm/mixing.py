"""Mix sources to target weights by temperature.

A source with the share ``p`` of all tokens gets the weight ``p ** a``, normalised. The
exponent ``a`` is bisected: the smallest one at which no source is repeated more often than
``max_repeat`` times (``exponent_for_repeats``), or the one whose weights have the entropy
asked for (``exponent_for_entropy``). The total is the least at which the largest source is
used once, so nothing is left out and smaller sources are repeated.

The weights become budgeted block permutations: each epoch of a source is a permutation of
its documents by a hash seeded with the epoch; whole epochs are taken whole, and of the last
one as many leading documents as the token budget allows. A permutation is cut into blocks
by the leading digits of the hash: running totals go over blocks first, and only the block
in which the budget ends is ranked document by document. A source with a third of all rows
is thereby spread over its blocks.

Everything is DataFrame functions; only two numbers (or entropies) come to the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import boxed, keep

MAX_REPEAT = 2.0
STEPS = 20  # the exponent is a multiple of 2 ** -STEPS
DIGITS = 3  # of the hash that name a block: 4096 blocks per source and epoch
WORDS = r"[^\x20\x09-\x0D]+"


def _n_tokens() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long")


def _key(epoch: Column) -> Column:
    """Place of a document in the permutation of an epoch (as SQL can compute it too)."""
    return F.md5(
        F.concat_ws("|", epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_md5")).cast("binary")
    )


def bisect(holds, low: float = 0.0, high: float = 1.0, steps: int = STEPS) -> float:
    """Smallest multiple of ``2 ** -steps`` between ``low`` and ``high`` from which
    ``holds``, which is monotone, is true; ``high`` if it never is."""
    a, b = 0, round((high - low) * 2**steps)
    while a < b:
        mid = (a + b) // 2
        a, b = (a, mid) if holds(low + mid / 2**steps) else (mid + 1, b)
    return low + a / 2**steps


def exponent_for_repeats(sources: DataFrame, max_repeat: float = MAX_REPEAT) -> float:
    """Sources ``(source, tokens)``: the exponent at which the smallest is repeated at most
    ``max_repeat`` times while the largest is used once."""
    row = sources.filter("tokens > 0").agg(F.max("tokens").alias("most"), F.min("tokens").alias("least")).collect()[0]
    if not row["most"]:
        return 1.0
    ratio = row["most"] / row["least"]
    return bisect(lambda a: ratio ** (1 - a) <= max_repeat * (1 + 1e-12))


def exponent_for_entropy(sources: DataFrame, share: float, per_job: int = 32) -> float:
    """The largest exponent whose weights reach ``share`` (0 to 1) of the highest entropy.
    Each job tries ``per_job`` exponents over all sources at once, so few jobs bisect."""
    rows = sources.filter("tokens > 0")
    low, high = 0.0, 1.0
    n = rows.count()
    if n < 2:
        return 1.0
    top = rows.agg(F.max(F.log("tokens"))).collect()[0][0]
    for _ in range(math.ceil(STEPS / math.log2(per_job))):
        tried = [low + (high - low) * i / per_job for i in range(per_job + 1)]
        power = [F.exp((F.log("tokens") - top) * a) for a in tried]
        sums = rows.agg(
            *[F.sum(p).alias(f"z{i}") for i, p in enumerate(power)],
            *[F.sum(p * (F.log("tokens") - top) * a).alias(f"s{i}") for i, (p, a) in enumerate(zip(power, tried, strict=True))],
        ).collect()[0]
        entropy = [math.log(sums[f"z{i}"]) - sums[f"s{i}"] / sums[f"z{i}"] for i in range(per_job + 1)]
        good = [i for i, h in enumerate(entropy) if h >= share * math.log(n)]
        at = max(good, default=0)
        low, high = tried[at], tried[min(at + 1, per_job)]
    return low


def mixture(docs: DataFrame, max_repeat: float = MAX_REPEAT, exponent: float | None = None) -> DataFrame:
    """One row per use of a document: ``doc_id, source, n_tokens, epoch`` (from 1),
    ``weight`` (of its source), ``repeats`` (of its source), ``text_md5``.

    Tokens are words between white space. Every document is used at least once and, with
    ``max_repeat`` 2, at most twice. Null sources are a source of their own; documents
    without tokens cost nothing and come with every whole epoch, and with the part of the
    last one that the budget reaches. Repeated rows are documents of their own; those that
    are equal in doc_id and text share a place, so a budget that ends there takes all or
    none of them. An empty table gives no rows. Other columns are not read.
    """
    rows = keep(
        docs.select("doc_id", "source", _n_tokens().alias("n_tokens"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5")),
        "mixing-rows",
    )
    sources = keep(rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), "mixing-sources")
    a = exponent_for_repeats(sources, max_repeat) if exponent is None else exponent
    sums = sources.agg(F.max("tokens").alias("most"), F.sum(F.pow("tokens", F.lit(a))).alias("z")).collect()[0]
    most, z = sums["most"] or 1, sums["z"] or 1.0
    ratio = F.when(F.col("tokens") > 0, F.pow(F.lit(float(most)) / F.col("tokens"), F.lit(1 - a))).otherwise(F.lit(1.0))
    plan = sources.select(
        F.col("source").alias("plan_source"),
        "tokens",
        F.round(F.when(F.col("tokens") > 0, F.pow("tokens", F.lit(a)) / z).otherwise(F.lit(0.0)), 9).alias("weight"),
        F.round(ratio, 9).alias("repeats"),
    )
    plan = plan.withColumn("whole", F.floor("repeats").cast("int")).withColumn(
        "budget", F.floor((F.col("repeats") - F.col("whole")) * F.col("tokens"))
    )
    used = rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source"))).drop("plan_source", "tokens")
    columns = ["doc_id", "source", "n_tokens", "epoch", "weight", "repeats", "text_md5"]
    whole = used.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("whole")))).select(*columns)

    # The last, partial epoch.
    last = used.filter("budget > 0").withColumn("epoch", F.col("whole") + 1)
    last = last.withColumn("key", _key(F.col("epoch"))).withColumn("block", F.substring("key", 1, DIGITS))
    blocks = last.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens"), F.max("budget").alias("budget"))
    until = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    ends = (
        blocks.withColumn("upto", F.sum("tokens").over(until))
        .select(
            F.col("source").alias("b_source"),
            F.col("block").alias("b_block"),
            (F.col("upto") - F.col("tokens")).alias("before"),
            "upto",
        )
    )
    placed = last.join(
        ends, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("block") == F.col("b_block"))
    ).filter("before <= budget")
    taken = placed.filter("upto <= budget").select(*columns)
    along = Window.partitionBy("source", "block").orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    cut = (
        placed.filter("upto > budget")
        .withColumn("run", F.col("before") + F.sum("n_tokens").over(along))
        .filter("run <= budget")
        .select(*columns)
    )
    return whole.unionByName(taken).unionByName(cut)


def mix(docs: DataFrame, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """``docs`` as often as the mixture uses them, with their own columns."""
    uses = (
        mixture(docs, max_repeat)
        .groupBy("doc_id", "source", "text_md5", "epoch")
        .agg(F.count("*").alias("n"))
        .groupBy("doc_id", "source", "text_md5")
        .agg(F.count("*").cast("int").alias("times"))
    )
    rows = docs.select(boxed(docs).alias("doc"), "doc_id", "source", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5"))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"u.{c}")) for c in ("doc_id", "source", "text_md5")]
    used = rows.alias("r").join(uses.alias("u"), same)
    return used.select("r.doc", F.explode(F.sequence(F.lit(1), F.col("u.times"))).alias("use")).select("doc.*")


# The bisection in closed form; permutations by one running total per source.
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source,
                  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens,
                  md5(coalesce(text, '')) AS text_md5
           FROM documents),
s AS (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM d GROUP BY source),
m AS (SELECT max(tokens) AS most, min(tokens) FILTER (WHERE tokens > 0) AS least FROM s),
x AS (SELECT most, CASE WHEN most <= least * {MAX_REPEAT} THEN 0.0
                   ELSE ceil((1 - ln({MAX_REPEAT}) / ln(CAST(most AS DOUBLE) / least)) * {2**STEPS}) / {2**STEPS} END AS a FROM m),
z AS (SELECT sum(pow(tokens, a)) AS z FROM s, x WHERE tokens > 0),
p AS (SELECT source, tokens, CASE WHEN tokens > 0 THEN round(pow(tokens, a) / z, 9) ELSE 0.0 END AS weight,
             CASE WHEN tokens > 0 THEN round(pow(CAST(most AS DOUBLE) / tokens, 1 - a), 9) ELSE 1.0 END AS repeats
      FROM s, x, z),
q AS (SELECT *, CAST(floor(repeats) AS BIGINT) AS whole, CAST(floor((repeats - floor(repeats)) * tokens) AS BIGINT) AS budget FROM p),
u AS (SELECT d.*, weight, repeats, whole, budget FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
w AS (SELECT *, unnest(range(1, whole + 1)) AS epoch FROM u),
l AS (SELECT *, whole + 1 AS epoch,
             md5(concat_ws('|', CAST(whole + 1 AS VARCHAR), coalesce(CAST(doc_id AS VARCHAR), ''), text_md5)) AS k
      FROM u WHERE budget > 0),
c AS (SELECT *, sum(n_tokens) OVER (PARTITION BY source ORDER BY k) AS run FROM l)
SELECT doc_id, source, n_tokens, CAST(epoch AS INTEGER) AS epoch, weight, repeats, text_md5 FROM w
UNION ALL
SELECT doc_id, source, n_tokens, CAST(epoch AS INTEGER), weight, repeats, text_md5 FROM c WHERE run <= budget
"""
