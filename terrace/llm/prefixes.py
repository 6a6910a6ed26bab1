"""Prefix trie of conversations, as balanced parentheses per shard.

1. Turns become 128-bit keys of (role, text) with the size of the text; texts are not
   shuffled. Every conversation is rebuilt (``rebuilt``) and is one row: its path of keys.
2. Paths are dealt by range and sorted, conv_id last, so a group of equal conversations
   spreads over tasks. A shard is a run of sorted paths of about ``SHARD`` turns. Its trie is a
   sequence of balanced parentheses in depth-first order. ``findclose`` on a range min-max tree
   of block excesses delimits every subtree; ranks of ``()`` pairs count its leaves; cumulative
   arrays over the preorder give its members and savings.
3. Only nodes on the first and on the last path of a shard can go on in other shards. These
   two spines, with what hangs from them summed up, are the items of the next level, which is
   dealt, sorted and encoded in the same way, until one shard holds all that is left. Every
   level has about a sixteenth of the items of the one before at most, as a shard has at least
   ``ITEMS`` of them.
4. Nodes whose parent is on a spine get the parent's conversation by a join; lists of
   conversations that end at a spine are hashed piece by piece in their order.

A conversation is 24 bytes a turn in one row; nothing else is gathered by key.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import keep, parts, small

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the rebuilding: conversations share the head of the first of each block of
# BLOCK ids; the head has fewer than HEADS turns.
BLOCK, HEADS = 5, 9
SHARD = 1 << 17
ITEMS = 16
FEW = 64  # items that one shard takes whatever their turns
PIECE = 1000  # ids in one row of a list that is hashed over shards
EXCESS = 256  # parentheses in a block
NONE = np.iinfo(np.int64).max

SUMS = ("members", "least", "kids", "leaves", "saved")
SCHEMA = (
    "kind byte, conv_id long, depth long, parent_conv_id long, up binary, node binary, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends string, path array<binary>, sizes array<long>, "
    + ", ".join(f"{c} array<long>" for c in SUMS)
)
_NUMBERS, _BINARY = pa.list_(pa.int64()), pa.list_(pa.binary())
TYPES = {
    "kind": pa.int8(), "conv_id": pa.int64(), "depth": pa.int64(), "parent_conv_id": pa.int64(), "up": pa.binary(),
    "node": pa.binary(), "n_convs": pa.int64(), "n_children": pa.int64(), "n_leaves": pa.int64(), "saved_tokens": pa.int64(),
    "ends": pa.string(), "path": _BINARY, "sizes": _NUMBERS, **dict.fromkeys(SUMS, _NUMBERS),
}
ROW, SPINE, LIST = 0, 1, 2  # kinds


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id, path, sizes`` of every conversation: the first h turns of the conversation
    that begins its block, then its own turns after its first h."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("key"),
        F.octet_length(text).cast("long").alias("size"),
    )
    own = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "key", "size"))).alias("turns"))
    # array_sort puts null structs last, but a null turn inside a struct first.
    own = keep(own.select("conv_id", F.transform("turns", lambda t: F.struct(t["key"].alias("key"), t["size"].alias("size"))).alias("turns")), "prefix-own")
    first = F.col("conv_id") - F.col("conv_id") % BLOCK
    heads = own.filter(F.col("conv_id") == first).select(F.col("conv_id").alias("first"), F.slice("turns", 1, HEADS - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    both = own.withColumns({"first": first, "h": h}).join(heads, "first", "left")
    whole = F.concat(
        F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0)),
        F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0))),
    )
    return both.withColumn("whole", whole).select("conv_id", F.col("whole.key").alias("path"), F.col("whole.size").alias("sizes"))


class Parentheses:
    """Balanced parentheses of a tree with nodes of these depths in depth-first order, with a
    tree of least excesses over blocks."""

    def __init__(self, depth: np.ndarray, block: int = EXCESS):
        n = len(depth)
        self.open = 2 * np.arange(n) - depth  # place of each node's opening parenthesis
        step = np.full(2 * n, -1, dtype=np.int64)
        step[self.open] = 1
        self.excess = np.cumsum(step)
        leaf = np.zeros(2 * n, dtype=np.int64)
        leaf[self.open] = step[np.minimum(self.open + 1, 2 * n - 1)] < 0
        self.pairs = np.concatenate([[0], np.cumsum(leaf)])  # "()" that start before a place
        self.leaf = leaf[self.open] > 0
        self.block = block
        blocks = -(-2 * n // block)
        padded = np.full(blocks * block, n + 1, dtype=np.int64)
        padded[: 2 * n] = self.excess
        self.rows = padded.reshape(blocks, block)
        self.levels = [self.rows.min(1)]  # least excess of the blocks, of pairs of them, ...
        while len(self.levels[-1]) > 1:
            low = self.levels[-1]
            self.levels.append(np.minimum(low[::2], np.append(low[1::2], [n + 1] * (len(low) % 2))))

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """Places of the parentheses that close those at ``at``."""
        target = self.excess[at] - 1
        block = at // self.block
        out = np.full(len(at), -1, dtype=np.int64)
        for s in range(0, len(at), 4096):
            e = s + 4096
            hit = (self.rows[block[s:e]] <= target[s:e, None]) & (np.arange(self.block) > (at[s:e] % self.block)[:, None])
            found = hit.any(1)
            out[s:e][found] = (block[s:e] * self.block + hit.argmax(1))[found]
        todo = np.flatnonzero(out < 0)
        if not len(todo):
            return out
        # Up until a block to the right has it, then down to the first such block.
        node, goal, level = block[todo], target[todo], np.zeros(len(todo), dtype=np.int64)
        found = np.zeros(len(todo), dtype=bool)
        for k, low in enumerate(self.levels):
            right = node + 1
            here = ~found & (node % 2 == 0) & (right < len(low))
            here[here] = low[right[here]] <= goal[here]
            node[here], level[here], found = right[here], k, found | here
            node[~found] //= 2
        for k in range(len(self.levels) - 2, -1, -1):
            down = level > k
            left = 2 * node[down]
            node[down] = left + (self.levels[k][left] > goal[down])
        for s in range(0, len(todo), 4096):
            mine = node[s : s + 4096]
            first = (self.rows[mine] <= goal[s : s + 4096, None]).argmax(1)
            out[todo[s : s + 4096]] = mine * self.block + first
        return out


def digests(path: list[bytes]) -> list[bytes]:
    """A name for each prefix of a path, the empty one first."""
    running = hashlib.md5()
    out = [running.digest()]
    for key in path:
        running.update(key)
        out.append(running.digest())
    return out


class Shard:
    """A run of sorted items, taken in one by one."""

    def __init__(self, named: bool):
        self.named = named  # nodes have names (all but the first level)
        self.items = self.weight = 0
        self.depth, self.parent, self.size = [0], [-1], [0]
        self.sums = {c: [NONE if c == "least" else 0] for c in SUMS}
        self.first: list[bytes] | None = None
        self.last: list[bytes] = []
        self.stack, self.hashes = [0], [hashlib.md5()]
        self.names = [self.hashes[0].digest()]
        self.ends: dict[int, list[int]] = {}

    def _walk(self, path: list[bytes], sizes: list[int]) -> None:
        same = 0
        for a, b in zip(self.last, path, strict=False):
            if a != b:
                break
            same += 1
        del self.stack[same + 1 :], self.hashes[same + 1 :]
        for d in range(same, len(path)):
            self.parent.append(self.stack[-1])
            self.stack.append(len(self.depth))
            self.depth.append(d + 1)
            self.size.append(sizes[d])
            for c in SUMS:
                self.sums[c].append(NONE if c == "least" else 0)
            if self.named:
                h = self.hashes[-1].copy()
                h.update(path[d])
                self.hashes.append(h)
                self.names.append(h.digest())
        self.first = path if self.first is None else self.first
        self.last = path
        self.items += 1
        self.weight += 1 + len(path)

    def add_conversation(self, conv_id: int, path: list[bytes], sizes: list[int]) -> None:
        self._walk(path, sizes)
        end = self.stack[-1]
        self.sums["members"][end] += 1
        self.sums["least"][end] = min(self.sums["least"][end], conv_id)
        self.ends.setdefault(end, []).append(conv_id)

    def add_spine(self, path: list[bytes], sizes: list[int], sums: dict[str, list[int]]) -> None:
        self._walk(path, sizes)
        for c in SUMS:
            mine = self.sums[c]
            for v, x in zip(self.stack, sums[c], strict=True):
                mine[v] = min(mine[v], x) if c == "least" else mine[v] + x

    def rows(self, whole: bool) -> Iterator[dict]:
        """Columns of finished nodes, of what goes on to the next level (nothing if this shard
        is the ``whole`` trie) and of lists of ends there."""
        depth, parent, size = (np.array(x, dtype=np.int64) for x in (self.depth, self.parent, self.size))
        own = {c: np.array(self.sums[c], dtype=np.int64) for c in SUMS}
        n = len(depth)
        tree = Parentheses(depth)
        close = tree.findclose(tree.open)
        node, end = np.arange(n), np.arange(n) + (close - tree.open + 1) // 2

        def below(values: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(values)])
            return total[end] - total[node]

        convs = below(own["members"])
        saved = below((convs - 1) * size + own["saved"])
        # A pair whose node has children in shards before is no leaf.
        leaves = tree.pairs[close] - tree.pairs[tree.open] + below(own["leaves"] - (tree.leaf & (own["kids"] > 0)))
        kids = own["kids"] + np.bincount(parent[1:], minlength=n)
        least = own["least"].copy()
        by_depth = np.argsort(depth, kind="stable")
        cuts = np.searchsorted(depth[by_depth], np.arange(depth.max() + 2))
        for d in range(int(depth.max()), 0, -1):
            level = by_depth[cuts[d] : cuts[d + 1]]
            np.minimum.at(least, parent[level], least[level])
        spine = np.zeros(n, dtype=bool)
        if not whole:
            spine[: len(self.first) + 1] = True  # the first path comes first
            spine[self.stack] = True
        names = self.names
        if not self.named:
            names = dict(zip(self.stack, digests(self.last), strict=True)) | dict(enumerate(digests(self.first)))
        done = np.flatnonzero(~spine)
        up = [names[p] if p >= 0 and spine[p] else None for p in parent[done]]
        yield {
            "kind": np.full(len(done), ROW, dtype=np.int8),
            "conv_id": least[done],
            "depth": depth[done],
            "parent_conv_id": pa.array(least[np.maximum(parent[done], 0)], mask=(parent[done] < 0) | spine[np.maximum(parent[done], 0)]),
            "up": pa.array(up, pa.binary()),
            "node": pa.array([names[v] for v in done] if self.named or whole else [None] * len(done), pa.binary()),
            "n_convs": convs[done],
            "n_children": kids[done],
            "n_leaves": leaves[done],
            "saved_tokens": saved[done],
            "ends": pa.array([None if self.named else self._hash(v) for v in done.tolist()], pa.string()),
        }
        if whole:
            return
        hung = done[spine[parent[done]]]  # whose parent goes on
        for c, values in (("members", convs), ("leaves", leaves), ("saved", saved), ("kids", np.ones(n, dtype=np.int64))):
            np.add.at(own[c], parent[hung], values[hung])
        np.minimum.at(own["least"], parent[hung], least[hung])
        paths = [(self.first, list(range(len(self.first) + 1)), 0)]
        if self.stack != paths[0][1]:
            paths.append((self.last, self.stack, sum(v == d for d, v in enumerate(self.stack[: len(self.first) + 1]))))
        for path, nodes, known in paths:  # what both paths share is given once
            some = {c: own[c][nodes] for c in SUMS}
            for c in SUMS:
                some[c][:known] = NONE if c == "least" else 0
            yield {
                "kind": np.array([SPINE], dtype=np.int8),
                "path": pa.array([path], _BINARY),
                "sizes": pa.array([size[nodes[1:]]], _NUMBERS),
                **{c: pa.array([some[c]], _NUMBERS) for c in SUMS},
            }
        for v, ids in self.ends.items():
            for at in range(0, len(ids) if spine[v] else 0, PIECE):
                some = ids[at : at + PIECE]
                yield {
                    "kind": np.array([LIST], dtype=np.int8),
                    "conv_id": np.array(some[:1], dtype=np.int64),
                    "node": pa.array([names[v]], pa.binary()),
                    "ends": pa.array([",".join(map(str, some))]),
                }

    def _hash(self, v: int) -> str:
        return hashlib.sha256(",".join(map(str, self.ends.get(v, ()))).encode()).hexdigest()


def _level(named: bool, whole: bool, shard: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(done: Shard) -> Iterator[pa.RecordBatch]:
            held: list[pa.Table] = []
            for columns in done.rows(whole) if done.items else ():
                n = len(columns["kind"])
                held.append(pa.table({c: columns.get(c, pa.nulls(n, t)) for c, t in TYPES.items()}, pa.schema(TYPES)))
            if held:
                yield from pa.concat_tables(held).combine_chunks().to_batches()

        now = Shard(named)
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in batch.schema.names]
            for row in zip(*columns, strict=True):
                if not whole and now.weight >= shard and now.items >= ITEMS:
                    yield from out(now)
                    now = Shard(named)
                if named:
                    now.add_spine(row[0], row[1], dict(zip(SUMS, row[2:], strict=True)))
                else:
                    now.add_conversation(*row)
        yield from out(now)

    return run


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of lists that come in pieces, sorted by node and place."""
    last, running = None, None
    for batch in batches:
        found = []
        for node, ids in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if node != last:
                if last is not None:
                    found.append((last, running.hexdigest()))
                last, running = node, hashlib.sha256()
            else:
                running.update(b",")
            running.update(ids.encode())
        yield pa.RecordBatch.from_pydict({"node": pa.array([x[0] for x in found], pa.binary()), "ended": pa.array([x[1] for x in found], pa.string())})
    if last is not None:
        yield pa.RecordBatch.from_pydict({"node": pa.array([last], pa.binary()), "ended": pa.array([running.hexdigest()])})


def prefix_nodes(conversations: DataFrame, shard: int = SHARD) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: ``conv_id`` (smallest member),
    ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Null role and text are empty. Turns of one number, null too, are ordered by the MD5 of the
    role's byte length, a colon, role and text; rows that repeat a turn are turns. Rows without conv_id
    belong to no conversation and are left out. An empty table gives no rows, not even the
    root. Other columns are not read.
    """
    spark = conversations.sparkSession
    paths = keep(rebuilt(conversations), "prefix-paths")
    dealt = paths.repartitionByRange(parts(spark), "path", "conv_id").sortWithinPartitions("path", "conv_id")
    found = keep(dealt.select("conv_id", "path", "sizes").mapInArrow(_level(False, False, shard), SCHEMA), "prefix-level")
    levels, lists = [found], found.filter(F.col("kind") == LIST)
    while True:
        items = levels[-1].filter(F.col("kind") == SPINE).select("path", "sizes", *SUMS)
        state = items.agg(F.count("*").alias("n"), F.sum(F.size("path")).alias("turns")).collect()[0]
        if not state["n"]:
            break
        n, weight = state["n"], state["n"] + (state["turns"] or 0)
        if whole := n <= FEW or weight <= shard:
            dealt = items.repartition(1)
        else:
            tasks = min(parts(spark), -(-weight // shard), n // ITEMS)
            dealt = items.repartitionByRange(tasks, "path")
        levels.append(keep(dealt.sortWithinPartitions("path").mapInArrow(_level(True, whole, shard), SCHEMA), "prefix-level"))
    rows = reduce(DataFrame.unionByName, levels).filter(F.col("kind") == ROW)
    # Two paths for each shard at most.
    spines = reduce(DataFrame.unionByName, levels[1:] or levels).filter((F.col("kind") == ROW) & F.col("node").isNotNull())
    above = spines.select(F.col("node").alias("up"), F.col("conv_id").alias("above"))
    ended = lists.select("node", "conv_id", "ends").repartition(parts(spark), "node").sortWithinPartitions("node", "conv_id")
    ended = keep(ended.select("node", "ends").mapInArrow(_ends, "node binary, ended string"), "prefix-ends")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        rows.join(small(keep(above, "prefix-above")), "up", "left")
        .join(small(ended), "node", "left")
        .select(
            "conv_id",
            "depth",
            F.coalesce("parent_conv_id", "above").alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends", "ended", nothing).alias("ends_sha256"),
        )
    )


_KEY = "md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))"

SQL = f"""
WITH RECURSIVE
bits(i, c, k) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
crc(conv_id, c, k) AS (
  SELECT conv_id, 4294967295::BIGINT, 0 FROM ids
  UNION ALL SELECT conv_id, xor(crc.c >> 8, bits.c), crc.k + 1
  FROM crc JOIN bits ON bits.k = 8 AND bits.i = xor(crc.c, ascii(substr(conv_id::VARCHAR, crc.k + 1, 1))) & 255
  WHERE crc.k < length(conv_id::VARCHAR)),
heads AS (SELECT conv_id, conv_id - conv_id % {BLOCK} AS first, xor(c, 4294967295) % {HEADS} AS h FROM crc WHERE k = length(conv_id::VARCHAR)),
own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {_KEY}) AS i,
         {_KEY} AS key, strlen(coalesce(text, '')) AS size FROM conversations),
turns AS (
  SELECT heads.conv_id, i AS d, key, size FROM heads JOIN own ON own.conv_id = first AND i <= h
  UNION ALL
  SELECT heads.conv_id, i - h + (SELECT count(*) FROM own f WHERE f.conv_id = first AND f.i <= h), key, size
  FROM heads JOIN own ON own.conv_id = heads.conv_id AND i > h),
members AS (
  SELECT conv_id, d, size, string_agg(key, ',') OVER w AS node, d = max(d) OVER (PARTITION BY conv_id) AS is_end
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY d)
  UNION ALL SELECT conv_id, 0, 0, '', conv_id NOT IN (SELECT conv_id FROM turns) FROM ids),
nodes AS (
  SELECT node, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (is_end) AS ended FROM members GROUP BY node),
edges AS (
  SELECT DISTINCT b.node, a.node AS parent FROM members a JOIN members b ON a.conv_id = b.conv_id AND b.d = a.d + 1),
kids AS (SELECT parent AS node, count(*) AS n FROM edges GROUP BY parent),
below AS (
  SELECT node, count(*) FILTER (n IS NULL) AS n_leaves, sum((n_convs - 1) * size)::BIGINT AS saved_tokens
  FROM (SELECT DISTINCT a.node, b.node AS other FROM members a JOIN members b ON a.conv_id = b.conv_id AND b.d >= a.d) p
  JOIN (SELECT node AS other, n_convs, size FROM nodes) USING (other)
  LEFT JOIN (SELECT node AS other, n FROM kids) USING (other) GROUP BY node)
SELECT nodes.conv_id, nodes.depth::BIGINT AS depth, above.conv_id AS parent_conv_id, nodes.n_convs,
       coalesce(kids.n, 0) AS n_children, n_leaves, saved_tokens, sha256(coalesce(nodes.ended, '')) AS ends_sha256
FROM nodes JOIN below USING (node) LEFT JOIN kids USING (node) LEFT JOIN edges USING (node)
LEFT JOIN nodes above ON above.node = edges.parent
"""
