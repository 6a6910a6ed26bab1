"""Secrets in texts through a trigram inverted index.

The Boolean trigram query of a rule is derived from its regular expression (``trigrams``): the
expression's parse tree gives the strings that any match must contain, one alternative per
branch, each cut into its trigrams (in lower case if a part of the expression ignores case).
The index has one posting per query trigram and text. A rule's candidates are the texts
that have all trigrams of one of its alternatives, found by intersecting postings; only these
are searched with the expression. A rule whose matches need no string of three characters has
no query and scans all texts.

Everything is DataFrame functions. ``split`` and ``regexp_extract_all`` walk over the same
matches, so the lengths of the pieces between matches and of the matches give positions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


ALTERNATIVES = 64
CLASS = 16  # characters of a class that are told apart


def _needed(tree, fold: bool) -> list[set[str] | None]:
    """What a match of ``tree`` is made of: sets of strings of which one stands there, without a
    gap between neighbours, and None for anything."""
    out: list[set[str] | None] = [{""}]

    def add(some: set[str]) -> None:
        if out[-1] is not None and len(out[-1]) * len(some) <= ALTERNATIVES:
            out[-1] = {a + b for a in out[-1] for b in some}
        else:
            out.extend([None, some] if out[-1] is not None else [some])

    def follow(pieces: list[set[str] | None]) -> None:
        for piece in pieces:
            if piece is None:
                out.append(None)
            else:
                add(piece)

    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            add({chr(arg).lower() if fold else chr(arg)})
        elif name == "IN":
            chars: set[str] | None = set()
            for kind, x in arg:
                if str(kind) == "LITERAL" and chars is not None:
                    chars.add(chr(x))
                elif str(kind) == "RANGE" and chars is not None and x[1] - x[0] < CLASS:
                    chars |= {chr(c) for c in range(x[0], x[1] + 1)}
                else:
                    chars = None
            if chars and fold:
                chars = {c.lower() for c in chars}
            add(chars) if chars and len(chars) <= CLASS else out.append(None)
        elif name == "SUBPATTERN":
            _, more, less, inner = arg
            follow(_needed(inner, (fold or bool(more & re.IGNORECASE)) and not less & re.IGNORECASE))
        elif name == "ATOMIC_GROUP":
            follow(_needed(arg, fold))
        elif name == "BRANCH":
            each = [_needed(inner, fold) for inner in arg[1]]
            if all(len(e) == 1 and e[0] is not None for e in each):
                add(set().union(*[e[0] for e in each]))
            else:  # the best string of each branch, if every branch has one
                best = [max((p for p in e if p is not None), key=lambda p: min(map(len, p)), default={""}) for e in each]
                out.extend([None, set().union(*best), None])
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            least, most, inner = arg
            once = _needed(inner, fold)
            exact = once[0] if len(once) == 1 else None
            if least == 0:
                add(exact | {""}) if exact and most == 1 else out.append(None)
            elif exact and least == most and len(exact) ** min(least, 9) <= ALTERNATIVES and least <= 64:
                for _ in range(least):
                    add(exact)
            else:
                follow(once)
                out.append(None)
        elif name not in ("AT", "ASSERT", "ASSERT_NOT"):  # these take no room
            out.append(None)
    return out


def trigrams(pattern: str) -> tuple[bool, list[list[str]]]:
    """Whether letters of either case are one, and the alternatives of trigrams of which every
    match of ``pattern`` has one whole; none if the pattern cannot tell."""
    try:
        tree = re._parser.parse(pattern)
    except re.error:  # an expression that only Java knows
        return False, []
    whole = bool(tree.state.flags & re.IGNORECASE)
    fold = whole or bool(re.search(r"\(\?[a-zA-Z]*i[a-zA-Z-]*:", pattern))
    found = [p for p in _needed(tree, whole) if p and min(map(len, p)) >= 3]
    queries: list[frozenset[str]] = [frozenset()]
    for piece in sorted(found, key=len):
        each = {frozenset(s[i : i + 3].lower() if fold else s[i : i + 3] for i in range(len(s) - 2)) for s in piece}
        if len(queries) * len(each) <= ALTERNATIVES:
            queries = list({a | b for a in queries for b in each})
    least = [q for q in queries if not any(other < q for other in queries)]
    return fold, sorted(sorted(q) for q in least if q)


@dataclass(frozen=True)
class Rule:
    """``least`` characters are asked of ``group`` (0: the match); others drop."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False

    @property
    def fold(self) -> bool:
        return trigrams(self.pattern)[0]

    def query(self) -> list[list[str]]:
        """Alternatives of mandatory trigrams; empty when there is none."""
        return trigrams(self.pattern)[1]


# The first three are the contract's, in its order.
RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
        base=True,
    ),
    # A run that is long enough is the same match with or without the length in the pattern.
    Rule("access", r"AKIA[A-Z0-9]{16,}", base=True),
    Rule("hex", r"[0-9a-f]{24,}", base=True),
    # Added by this operator.
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[0-9A-Za-z-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
BLOCK = 256
SPANS = "array<struct<start:int,rank:int,kind:string,end:int,good:boolean>>"


def _folds(rule: Rule) -> str:
    return "f:" if rule.fold else "x:"


def postings(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The index: ``(doc_id, key, gram)`` for each query trigram that a text has; ``key`` is a
    hash of the text, which tells rows with one doc_id or none apart. A folded gram
    is looked for in the lowered text; lowering may change other letters too, which can only
    add candidates."""
    marks = sorted({_folds(r) + g for r in rules for alt in r.query() for g in alt})
    texts = docs.select("doc_id", F.xxhash64("text").alias("key"), "text", F.lower("text").alias("low"))
    found = F.array_compact(
        F.array(*[F.when(F.contains("low" if m[0] == "f" else "text", F.lit(m[2:])), F.lit(m)) for m in marks])
    )
    return texts.select("doc_id", "key", F.explode(found).alias("gram")).distinct()


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(doc_id, key, kinds)``: the rules whose trigram query holds for a text."""
    asked = [
        (_folds(r) + g, r.kind, n, len(alt))
        for r in rules
        for n, alt in enumerate(r.query())
        for g in alt
    ]
    queries = index.sparkSession.createDataFrame(asked, "gram string, kind string, alt int, need int")
    return (
        index.join(F.broadcast(queries), "gram")  # one row per gram and rule, from RULES
        .groupBy("doc_id", "key", "kind", "alt", "need")
        .agg(F.count("*").alias("have"))
        .filter("have = need")
        .groupBy("doc_id", "key")
        .agg(F.collect_set("kind").alias("kinds"))
    )


def _matches(rule: Rule) -> Column:
    """The matches of ``rule`` in column ``text``, each with the piece before it."""
    gaps = F.split("text", rule.pattern, -1)
    hits = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    asked = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group)) if rule.group else F.array()
    found = F.struct(gaps.alias("gaps"), hits.alias("hits"), asked.cast("array<string>").alias("asked"))
    there = F.col("text").rlike(rule.pattern)
    return F.when(F.array_contains("kinds", rule.kind) & there if rule.query() else there, found)


def _placed(found: Column, rule: Rule, rank: int) -> Column:
    """Spans ``(start, rank, kind, end)``, code points counted from 0, of long enough matches."""
    rows = F.transform(
        found["hits"],
        lambda hit, i: F.struct(
            F.char_length(F.get(found["gaps"], i)).alias("gap"),
            F.char_length(hit).alias("size"),
            F.char_length(F.get(found["asked"], i) if rule.group else hit).alias("asked"),
        ),
    )
    # Running totals by blocks of matches, so that many matches do not cost their square.
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(found["hits"]) - 1) / BLOCK).cast("int")),
        lambda b: F.slice(rows, b * BLOCK + 1, BLOCK),
    )

    def total(block: Column) -> Column:
        return F.aggregate(block, F.lit(0), lambda a, r: a + r["gap"] + r["size"])

    def span(start: Column, r: Column) -> Column:
        return F.struct(
            start.alias("start"),
            F.lit(rank).alias("rank"),
            F.lit(rule.kind).alias("kind"),
            (start + r["size"]).alias("end"),
            (r["asked"] >= rule.least).alias("good"),
        )

    def add(state: Column, block: Column) -> Column:
        here = F.transform(
            block, lambda r, i: span(state["at"] + total(F.slice(block, 1, i)) + r["gap"], r)
        )
        return F.struct(
            (state["at"] + total(block)).alias("at"), F.concat(state["out"], F.array(here)).alias("out")
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPANS}>").alias("out"))
    return F.filter(F.flatten(F.aggregate(blocks, start, add)["out"]), lambda s: s["good"])


def _texts(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``.

    Null and empty texts have no secrets. Rows that repeat a doc_id each count for their own
    text. Without documents there are no rows; other columns are not read.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    found = candidates(postings(texts, rules), rules)
    rows = (
        texts.alias("t")
        .join(found.alias("f"), F.col("t.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("t.key") == F.col("f.key")), "left")
        .select("t.doc_id", "t.text", "f.kinds")
    )
    rows = rows.select("doc_id", *[_matches(r).alias(f"_m{i}") for i, r in enumerate(rules)])
    spans = [
        F.when(F.col(f"_m{i}").isNotNull(), _placed(F.col(f"_m{i}"), r, i))
        .otherwise(F.array().cast(SPANS))
        .alias(f"_s{i}")
        for i, r in enumerate(rules)
    ]
    rows = rows.select("doc_id", *spans)
    base = [i for i, r in enumerate(rules) if r.base]
    count = {rules[i].kind: F.size(f"_s{i}").cast("long") for i in base}
    some = F.array_sort(F.concat(*[F.col(f"_s{i}") for i in base]))
    every = F.array_sort(F.concat(*[F.col(f"_s{i}") for i in range(len(rules))]))
    return rows.select(
        "doc_id",
        *[n.alias(f"n_{kind}") for kind, n in count.items()],
        F.sha2(_texts(some), 256).alias("base_sha256"),
        _texts(every).alias("spans"),
    )


def _kind_sql(rule: Rule, rank: int) -> str:
    pattern = rule.pattern.replace("'", "''").replace(r"\x20", " ")
    return f"""
  SELECT r, {rank} AS rank, '{rule.kind}' AS kind, i,
         len(hits[i]) AS size, len(asked[i]) AS asked,
         list_sum(list_transform(gaps[:i], lambda x: len(x))) + coalesce(list_sum(list_transform(hits[:i - 1], lambda x: len(x))), 0) AS start
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM (
    SELECT r, regexp_extract_all(text, '{pattern}', 0) AS hits,
           regexp_extract_all(text, '{pattern}', {rule.group}) AS asked,
           string_split_regex(text, '{pattern}') AS gaps FROM d))"""


# The same expressions over all texts, without an index.
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({" UNION ALL ".join(_kind_sql(r, i) for i, r in enumerate(RULES))}),
s AS (SELECT r, rank, kind, start, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + size AS BIGINT) AS span
      FROM m JOIN (VALUES {", ".join(f"('{r.kind}', {r.least})" for r in RULES)}) AS l(kind, least) USING (kind)
      WHERE asked >= least),
g AS (SELECT r, count(*) FILTER (WHERE kind = 'assign') AS a, count(*) FILTER (WHERE kind = 'access') AS b,
             count(*) FILTER (WHERE kind = 'hex') AS c,
             string_agg(span, ',' ORDER BY start, rank) FILTER (WHERE rank < 3) AS base,
             string_agg(span, ',' ORDER BY start, rank) AS spans
      FROM s GROUP BY r)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)
"""
