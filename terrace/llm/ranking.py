"""Ranked lexical search: the best documents of every item, by a document FP-tree.

1. One pass over the texts gives every document its length in terms and its term vector,
   restricted to the terms of the items. Lengths and document frequencies are summed by Spark.
2. The terms of a vector are put in the order of their document frequency, most frequent
   first, so vectors share the beginning of their paths. Vectors are dealt by range of the
   first terms of their path (then by doc_id, so a group of copies spreads) and sorted by path.
3. A task cuts its sorted vectors into blocks. Sorted paths are the trie in depth-first order:
   a node is a range of them, its depth their common prefix; small neighbours with one parent
   form a bucket. Every node knows, over its subtree, the largest frequency of every term, the
   least m and the smallest doc_id.
4. Per item the tree is searched depth first, the child with the largest bound first. A term's
   share rises with its frequency and falls with m, so the largest frequencies with the least m
   bound every document below. A subtree is left out when its bound is below the score of the
   last of the best documents so far, or equal to it with only larger doc_ids. What is left is
   scored exactly, in 64-bit integers.
5. Every task gives its best per item; the best of those are the result.

The terms of the items are shipped with the tasks, at most about ``TERMS`` per block of items; more
items take further blocks, each a pass of its own. Nothing else of the documents' size leaves
the executors; texts are not shuffled.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import by_batch, keep, parts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP = 50
TERMS = 1 << 19  # of one block of items, repeats over items included
COLUMNS = 1 << 14  # terms of the items that are searched together in a task
CELLS = 1 << 23  # of the frequency table of one tree
BUCKET = 64
ROWS = 4096  # documents per task at least, where there are enough
HEAD = 8  # terms of the path that deal the documents
# Fixed values of the operator's definition: terms in lower-cased UTF-8.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
SCALE, TF, M = 1_000_000_000, 1000, 20


def terms(text: bytes | None) -> list[bytes]:
    """Terms of a whole text with repeats; only A-Z are put in lower case."""
    return TERM.findall((text or b"").lower())


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def share(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds for each unit of its weight; rises with ``tf``, falls with ``m``."""
    return (SCALE * tf) // (TF * tf + M * m)


def _item_terms(batch: pa.RecordBatch) -> Iterator[dict]:
    at, found = [], []
    for i, text in enumerate(batch.column("text").to_pylist()):
        for t in set(terms(text)):
            at.append(i)
            found.append(t)
    yield {"item_id": batch.column("item_id").take(pa.array(at, pa.int64())), "term": pa.array(found, pa.binary())}


def _vectors(number: dict[bytes, int]):
    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        n, each, tfs = [], [], []
        for text in batch.column("text").to_pylist():
            found = terms(text)
            n.append(len(found))
            counted = Counter(found)
            mine = [(number[t], c) for t, c in counted.items() if t in number]
            each.append([t for t, _ in mine])
            tfs.append([c for _, c in mine])
        yield {
            "doc_id": batch.column("doc_id"),
            "n": pa.array(n, pa.int64()),
            "terms": pa.array(each, pa.list_(pa.int32())),
            "tfs": pa.array(tfs, pa.list_(pa.int32())),
        }

    return run


def _paths(place: np.ndarray, n_docs: int, length: int):
    """Vectors in path order; ``place`` has the place of each term in the order of frequency."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        paths, tfs, m = [], [], []
        for n, t, f in zip(batch.column("n").to_pylist(), batch.column("terms"), batch.column("tfs"), strict=True):
            path = place[t.values.to_numpy()]
            order = np.argsort(path)
            paths.append(path[order])
            tfs.append(f.values.to_numpy()[order])
            m.append(50 + (50 * n * n_docs) // length)  # 100 - 50 + ...
        yield {
            "doc_id": batch.column("doc_id"),
            "m": pa.array(m, pa.int64()),
            "path": pa.array(paths, pa.list_(pa.int32())),
            "tfs": pa.array(tfs, pa.list_(pa.int32())),
        }

    return run


@dataclass
class Query:
    """Items that are searched together: terms (places in the order), per item the columns of
    its terms and their weights."""

    items: list[int]
    columns: np.ndarray
    of_item: list[np.ndarray]
    weights: list[np.ndarray]


def grouped(wanted: list[np.ndarray], weights: np.ndarray, width: int = COLUMNS) -> list[Query]:
    """Items in groups of at most ``width`` terms (or one item)."""
    groups, held, size = [], [], 0
    for i, places in enumerate(wanted):
        if held and size + len(places) > width:
            groups.append(held)
            held, size = [], 0
        held.append(i)
        size += len(places)
    out = []
    for items in [*groups, held] if held else groups:
        columns = np.unique(np.concatenate([wanted[i] for i in items])) if items else np.zeros(0, dtype=np.int64)
        out.append(Query(items, columns, [np.searchsorted(columns, wanted[i]) for i in items], [weights[wanted[i]] for i in items]))
    return out


def common_prefix(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differs = a[:n] != b[:n]
    return int(differs.argmax()) if differs.any() else n


def trie(paths: list[np.ndarray], bucket: int = BUCKET) -> list[tuple[int, int, list[int]]]:
    """Nodes ``(from, to, children)`` of the trie of sorted paths: ranges of them, the root
    first. Chains without branches are one node; neighbouring small subtrees of one parent are
    one bucket, which has no children."""
    shared = np.array([0, *[common_prefix(a, b) for a, b in zip(paths, paths[1:], strict=False)]], dtype=np.int64)
    nodes: list[tuple[int, int, list[int]]] = [(0, len(paths), [])]
    todo = [0]
    while todo:
        a, b, children = nodes[v := todo.pop()]
        if b - a <= bucket:
            continue
        inner = shared[a + 1 : b]
        cuts = [a, *(np.flatnonzero(inner == inner.min()) + a + 1).tolist(), b]
        start = a
        for x, y in zip(cuts, cuts[1:], strict=False):
            # The small ones before x, if with this one they are too many or this one is large.
            if x > start and y - start > bucket:
                children.append(len(nodes))
                nodes.append((start, x, []))
                start = x
            if y - start > bucket or y == b:
                children.append(len(nodes))
                nodes.append((start, y, []))
                todo.append(len(nodes) - 1)
                start = y
    return nodes


def _key(doc) -> tuple:
    return (doc is None, doc if doc is not None else 0)  # no id is the largest one


class Best:
    """The ``top`` best documents of one item so far."""

    def __init__(self, top: int):
        self.top, self.kept = top, []

    @property
    def least(self) -> tuple[int, tuple | None]:
        """Score a document must have, and the id it must be below when it has just this."""
        if len(self.kept) < self.top:
            return 1, None
        return -self.kept[-1][0], self.kept[-1][1]

    def add(self, score: np.ndarray, ids: list) -> None:
        least, _ = self.least
        new = [(-int(score[i]), _key(ids[i])) for i in np.flatnonzero(score >= least)]
        if new:
            self.kept = sorted(self.kept + new)[: self.top]


class Tree:
    """One block of sorted vectors."""

    def __init__(self, ids: list, m: np.ndarray, paths: list[np.ndarray], tfs: list[np.ndarray], bucket: int = BUCKET):
        self.ids, self.m = ids, m
        self.nodes = trie(paths, bucket)
        self.row = np.repeat(np.arange(len(paths)), [len(p) for p in paths])
        self.term, self.tf = np.concatenate(paths), np.concatenate(tfs)
        self.least_m = np.array([m[a:b].min() for a, b, _ in self.nodes])
        self.least_id = [min(map(_key, ids[a:b])) for a, b, _ in self.nodes]

    def search(self, query: Query, best: list[Best]) -> int:
        """Add the documents of this block to the ``best`` of the items; how many were scored."""
        table = np.zeros((len(self.ids), len(query.columns)), dtype=np.int64)
        if not len(query.columns):
            return 0
        at = np.minimum(np.searchsorted(query.columns, self.term), len(query.columns) - 1)
        mine = query.columns[at] == self.term
        table[self.row[mine], at[mine]] = self.tf[mine]
        most = np.stack([table[a:b].max(0) for a, b, _ in self.nodes])
        scored = 0
        for item, columns, weights in zip(query.items, query.of_item, query.weights, strict=True):
            bound = (share(most[:, columns], self.least_m[:, None]) * weights).sum(1).tolist()
            kept, todo = best[item], [0]
            while todo:
                v = todo.pop()
                least, below = kept.least
                if bound[v] < least or bound[v] == least and below is not None and self.least_id[v] >= below:
                    continue
                a, b, children = self.nodes[v]
                if children:
                    todo += sorted(children, key=bound.__getitem__)  # the best one comes next
                    continue
                scored += b - a
                kept.add((share(table[a:b].take(columns, axis=1), self.m[a:b, None]) * weights).sum(1), self.ids[a:b])
        return scored


def _search(queries: list[Query], n_items: int, top: int, kind: pa.DataType, cells: int):
    width = max((len(q.columns) for q in queries), default=1)
    size = max(BUCKET, min(ROWS, cells // max(1, width)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in range(n_items)]
        ids: list = []
        m: list[int] = []
        paths: list[np.ndarray] = []
        tfs: list[np.ndarray] = []

        def search() -> None:
            if ids:
                tree = Tree(ids, np.array(m, dtype=np.int64), paths, tfs)
                for q in queries:
                    tree.search(q, best)

        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                if len(ids) + part.num_rows > size:
                    search()
                    ids, m, paths, tfs = [], [], [], []
                ids += part.column("doc_id").to_pylist()
                m += part.column("m").to_pylist()
                paths += [x.values.to_numpy() for x in part.column("path")]
                tfs += [x.values.to_numpy() for x in part.column("tfs")]
        search()
        found = [(i, None if none else doc, -score) for i, b in enumerate(best) for score, (none, doc) in b.kept]
        yield pa.RecordBatch.from_pydict(
            {
                "item": pa.array([x[0] for x in found], pa.int32()),
                "doc_id": pa.array([x[1] for x in found], kind),
                "score": pa.array([x[2] for x in found], pa.int64()),
            }
        )

    return run


def _rank_block(docs: DataFrame, items: list, wanted: list[list[bytes]], top: int, cells: int) -> DataFrame:
    """The best documents of the items of one block: ``item`` (number), ``doc_id, score, rank``."""
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType
    kind = id_type.simpleString()
    names = sorted({t for terms_of in wanted for t in terms_of})
    number = {t: i for i, t in enumerate(names)}
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    vectors = keep(by_batch(texts, _vectors(number), f"doc_id {kind}, n long, terms array<int>, tfs array<int>"), "ranking-vectors")
    total = vectors.agg(F.count_if(F.col("n") > 0).alias("n"), F.sum("n").alias("length"), F.count_if(F.size("terms") > 0).alias("rows")).collect()[0]
    n_docs, length = total["n"], total["length"] or 0
    # One row per term of the items.
    counts = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()
    df = np.zeros(len(names), dtype=np.int64)
    df[counts.column("term").to_numpy()] = counts.column("df").to_numpy()
    order = np.lexsort((np.arange(len(names)), -df))
    place = np.empty(len(names), dtype=np.int32)
    place[order] = np.arange(len(names), dtype=np.int32)
    weights = np.array([weight(n_docs, int(d)) for d in df[order]], dtype=np.int64)
    places = [np.sort(place[[number[t] for t in terms_of if df[number[t]]]].astype(np.int64)) for terms_of in wanted]
    paths = by_batch(
        vectors.filter(F.size("terms") > 0), _paths(place, n_docs, length), f"doc_id {kind}, m long, path array<int>, tfs array<int>"
    )
    tasks = max(1, min(parts(spark), -(-total["rows"] // ROWS)))
    dealt = paths.withColumn("head", F.slice("path", 1, HEAD)).repartitionByRange(tasks, "head", "doc_id").sortWithinPartitions("path", "doc_id")
    arrow = vectors.select("doc_id").limit(0).toArrow().schema.field("doc_id").type
    found = dealt.select("doc_id", "m", "path", "tfs").mapInArrow(
        _search(grouped(places, weights), len(items), top, arrow, cells), f"item int, doc_id {kind}, score long"
    )
    ranks = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(ranks)).filter(F.col("rank") <= top)


def best_documents(docs: DataFrame, items: DataFrame, top: int = TOP, terms_at_once: int = TERMS, cells: int = CELLS) -> DataFrame:
    """The ``top`` documents of every item with a score above zero: ``item_id, rank, doc_id,
    score``; equal scores by ascending doc_id.

    Null texts have no terms; an item without terms, or whose terms are in no document, has no
    rows. Rows with one item_id are one item with the terms of all; no id is an id. Every row
    of documents counts and is ranked for itself, also one that repeats another; no doc_id
    comes after all others. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    item_kind, kind = items.schema["item_id"].dataType.simpleString(), docs.schema["doc_id"].dataType.simpleString()
    texts = items.select("item_id", F.col("text").cast("binary").alias("text"))
    each = by_batch(texts, _item_terms, f"item_id {item_kind}, term binary").distinct()
    each = keep(each, "ranking-items")
    blocks = max(1, -(-each.count() // terms_at_once))
    if blocks > 1:
        each = each.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    found = []
    for block in range(blocks):
        some = each.filter(F.col("block") == block) if blocks > 1 else each
        wanted: dict = {}
        for row in some.select("item_id", "term").toLocalIterator():  # at most about terms_at_once rows
            wanted.setdefault(row["item_id"], []).append(bytes(row["term"]))
        if not wanted:
            continue
        ids = list(wanted)
        ranked = _rank_block(docs, ids, list(wanted.values()), top, cells)
        names = spark.createDataFrame(list(enumerate(ids)), f"item int, item_id {item_kind}")
        found.append(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not found:
        return spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {kind}, score long")
    return reduce(DataFrame.unionByName, found)


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

SQL = f"""
WITH terms AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
vectors AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
docs AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM vectors GROUP BY doc_id),
total AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS length FROM docs),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM vectors GROUP BY term), total),
wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
lengths AS (SELECT doc_id, 100 - 50 + (50 * n * n_docs) // length AS m FROM docs, total),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN vectors USING (term) JOIN lengths USING (doc_id) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= {TOP}
"""
