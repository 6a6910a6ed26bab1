"""Bytes of texts that repeat elsewhere, by sorting sampled suffixes deep and shallow.

A text's removed bytes are those covered by a 200-byte string that starts anywhere else.
Sorting all suffixes would move every text two hundred times, so suffixes are sampled by
content: in each 200-byte window the 32-byte gram with the least hash (the first of equals)
is an anchor. Equal windows have their anchor at the same place, so two of them always meet
as two anchors with the same gram, one in about 85 bytes; nothing is missed.

1. Anchors whose gram is unique are dropped. A task drops nothing that it saw twice itself
   and sends such a gram once, so a gram of a third of all texts is not gathered.
2. The others get their context: up to 168 bytes to the left, 200 from the anchor on.
   Equal contexts in one batch are covered at once and one of them goes on.
3. Per gram the right contexts, and the left ones read backwards, are sorted: multikey
   quicksort on words of eight bytes to ``SHALLOW`` bytes, then blind tries for the groups
   that still tie. Common prefixes of neighbours give, for each split ``j`` of the 200 bytes
   into left and right, classes of equal left parts and of equal right parts; two anchors in
   the same pair of classes have an equal window that starts ``j`` bytes to their left.
   This is exact: bytes are compared, hashes only bring candidates together.
4. All windows of an anchor contain its gram, so they cover one stretch. A gram with more
   than ``hot_run`` different contexts is not held by one task: the windows around its
   anchors are counted by a 128-bit digest in a further shuffle instead.

Texts are shuffled once (both joins read the same exchange); contexts only where grams
repeat. Rows that repeat a doc_id and its text are counted first; one of them takes part.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import by_batch, by_runs, keep, parts, small

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPAN = 200
GRAM = 32
LEFT = SPAN - GRAM
SHALLOW = 64
HOT_RUN = 1 << 16
CHUNK = 1 << 20
PLACE_BITS = 21

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PLACE = np.uint64((1 << PLACE_BITS) - 1)


class _Tables(dict):
    """Arrays that each process makes for itself: empty when sent to tasks."""

    def __reduce__(self):
        return _Tables, ()


_tables = _Tables()


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _tables:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(CHUNK + SPAN + 8, base, dtype=np.uint64)
            steps[0] = 1
            _tables[name] = np.multiply.accumulate(steps)
    return _tables["up"], _tables["down"]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` neighbours: least from block start and from block end."""
    n = len(v) - w + 1
    full = np.full(-(-len(v) // w) * w, np.iinfo(v.dtype).max, dtype=v.dtype)
    full[: len(v)] = v
    blocks = full.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and gram hashes of the anchors of all 200-byte windows of a text."""
    data = np.frombuffer(text, dtype=np.uint8)
    places, grams = [], []
    up, down = _powers()
    for at in range(0, len(data) - SPAN + 1, CHUNK):
        part = data[at : at + CHUNK + SPAN - 1]
        n = len(part) - GRAM + 1
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
        gram = _mix((sums[GRAM:] - sums[:-GRAM]) * down[:n])
        ranked = (gram & ~_PLACE) | np.arange(n, dtype=np.uint64)
        least = _sliding_min(ranked, LEFT + 1)
        found = (least[np.concatenate([[True], least[1:] != least[:-1]])] & _PLACE).astype(np.int64)
        found = np.unique(found)
        places.append(found + at)
        grams.append(gram[found])
    if not places:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    place, first = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(grams)[first]


def _gram_rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Grams to look up (kind 0: once in this batch), grams known to repeat (kind 1, one row
    per text) and one notice of each of these (kind 2)."""
    row, gram, twice = [], [], []
    for i, text in enumerate(batch.column("text").to_pylist()):
        _, g = anchors(text or b"")
        g, n = np.unique(g, return_counts=True)
        row.append(np.full(len(g), i))
        gram.append(g)
        twice.append(n > 1)
    if not row:
        return
    row, gram, twice = np.concatenate(row), np.concatenate(gram), np.concatenate(twice)
    names, at, n = np.unique(gram, return_inverse=True, return_counts=True)
    known = (n > 1)[at] | np.bincount(at, twice, len(names)).astype(bool)[at]
    ids, keys = batch.column("doc_id"), batch.column("th")
    for kind, mine in ((0, np.flatnonzero(~known)), (1, np.flatnonzero(known))):
        g = gram[mine]
        # Known grams only travel to their text: dealt evenly, not by gram.
        key = g if kind == 0 else _mix(g ^ (row[mine].astype(np.uint64) * _BASE) ^ np.uint64(batch.num_rows))
        yield {
            "key": key.view(np.int64),
            "gram": g.view(np.int64) if kind else pa.nulls(len(g), pa.int64()),
            "kind": np.full(len(g), kind, dtype=np.int8),
            "doc_id": ids.take(pa.array(row[mine])),
            "th": keys.take(pa.array(row[mine])),
        }
    seen = np.unique(gram[known])
    yield {
        "key": seen.view(np.int64),
        "gram": pa.nulls(len(seen), pa.int64()),
        "kind": np.full(len(seen), 2, dtype=np.int8),
        "doc_id": pa.nulls(len(seen), ids.type),
        "th": pa.nulls(len(seen), pa.int64()),
    }


def _merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of stretches, as disjoint stretches in order."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    fresh = np.concatenate([[True], start[1:] > end[:-1]])
    return start[fresh], end[np.concatenate([np.flatnonzero(fresh)[1:] - 1, [len(end) - 1]])]


def _contexts(batch: pa.RecordBatch) -> Iterator[dict]:
    ids, keys, hashes = batch.column("doc_id"), batch.column("th"), batch.column("grams")
    row, place, gram, llen, rlen, context = [], [], [], [], [], []
    for i, text in enumerate(batch.column("text").to_pylist()):
        wanted = hashes[i].values.to_numpy().view(np.uint64)
        at, g = anchors(text or b"")
        mine = np.isin(g, wanted)
        at, g = at[mine], g[mine]
        if not len(at):
            continue
        padded = np.zeros(LEFT + len(text) + SPAN, dtype=np.uint8)
        padded[LEFT : LEFT + len(text)] = np.frombuffer(text, dtype=np.uint8)
        for s in range(0, len(at), 1 << 14):
            a = at[s : s + (1 << 14)]
            row.append(np.full(len(a), i))
            place.append(a)
            gram.append(g[s : s + (1 << 14)])
            llen.append(np.minimum(a, LEFT))
            rlen.append(np.minimum(len(text) - a, SPAN))
            near = np.concatenate([np.arange(LEFT - 1, -1, -1), np.arange(LEFT, LEFT + SPAN)])
            context.append(padded[a[:, None] + near[None, :]])
    if not row:
        return
    row, place, gram, llen, rlen = (np.concatenate(x) for x in (row, place, gram, llen, rlen))
    context = np.concatenate(context)
    # Equal contexts (lengths included) in this batch cover each other; one goes on.
    whole = np.ascontiguousarray(np.concatenate([context, llen[:, None].astype("<u2").view(np.uint8), rlen[:, None].astype("<u2").view(np.uint8)], axis=1))
    digest = np.array([hash(x) for x in whole.view(f"V{whole.shape[1]}").ravel().tolist()], dtype=np.int64)
    _, first, at = np.unique(digest, return_index=True, return_inverse=True)
    same = (whole == whole[first[at]]).all(1)  # a digest that fits only by chance goes on alone
    n = np.bincount(at, same, len(first))
    twin = same & (n[at] > 1)
    goes = ~same | (np.arange(len(at)) == first[at])
    key = gram.view(np.int64)
    g = np.flatnonzero(goes)
    yield {
        "key": key[g],
        "doc_id": ids.take(pa.array(row[g])),
        "th": keys.take(pa.array(row[g])),
        "place": place[g],
        "llen": llen[g].astype(np.int32),
        "rlen": rlen[g].astype(np.int32),
        "twin": twin[g],
        "context": pa.array([x.tobytes() for x in context[g]], pa.binary()),
    }
    t = np.flatnonzero(twin)
    out_row, out_start, out_end = [], [], []
    for i in np.unique(row[t]):
        mine = t[row[t] == i] if len(t) < 1000 else t[np.searchsorted(row[t], i) : np.searchsorted(row[t], i, "right")]
        s, e = _merged(place[mine] - llen[mine], place[mine] + rlen[mine])
        out_row.append(np.full(len(s), i))
        out_start.append(s)
        out_end.append(e)
    if out_row:
        out_row, out_start, out_end = np.concatenate(out_row), np.concatenate(out_start), np.concatenate(out_end)
        spread = _mix((out_row.astype(np.uint64) << np.uint64(32)) ^ out_start.astype(np.uint64) ^ gram[0])
        yield {
            "key": spread.view(np.int64),
            "doc_id": ids.take(pa.array(out_row)),
            "th": keys.take(pa.array(out_row)),
            "place": out_start,
            "llen": np.zeros(len(out_row), dtype=np.int32),
            "rlen": (out_end - out_start).astype(np.int32),
            "twin": np.ones(len(out_row), dtype=bool),
            "context": pa.nulls(len(out_row), pa.binary()),
        }


def blind_trie_order(rows: list[bytes], skip: int) -> list[int]:
    """Order of byte strings of one length that agree on the first ``skip`` bytes. The trie
    keeps only where strings part and the byte each goes on with: a string walks down by
    these bytes alone, is compared once with the leaf it reaches, and branches off where
    the comparison parts."""
    root: list | None = None  # inner node: [depth, {byte: node}]; leaf: (index, ...) tuple

    def one_leaf(node):
        while isinstance(node, list):
            node = next(iter(node[1].values()))
        return node

    for i, s in enumerate(rows):
        if root is None:
            root = (i,)
            continue
        node = root
        while isinstance(node, list):
            node = node[1].get(s[node[0]]) or one_leaf(node)
        other = rows[node[0]]
        if s == other:
            depth = len(s)
        else:
            # First difference, by halves of what is left.
            low, high = skip, len(s)
            while high - low > 1:
                mid = (low + high) // 2
                low, high = (mid, high) if s[low:mid] == other[low:mid] else (low, mid)
            depth = low
        parent, child, node = None, None, root
        while isinstance(node, list) and node[0] < depth:
            parent, child = node, s[node[0]]
            node = node[1].get(child)
        if depth == len(s):
            new = (*node, i)
        elif isinstance(node, list) and node[0] == depth:
            node[1][s[depth]] = (i,)
            continue
        else:
            new = [depth, {other[depth]: node, s[depth]: (i,)}]
        if parent is None:
            root = new
        else:
            parent[1][child] = new
    out, stack = [], [root] if root is not None else []
    while stack:
        node = stack.pop()
        if isinstance(node, list):
            stack.extend(node[1][b] for b in sorted(node[1], reverse=True))
        else:
            out.extend(node)
    return out


def multikey_quicksort(words: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows of words by group and content, and the number of the group of equal rows
    each place is in. All groups that still tie are split in three at once: by a pivot (the
    median of three) into rows whose word at the group's depth is less, equal and greater; the
    equal ones go on with the next word."""
    n, deep = words.shape
    order = np.argsort(group, kind="stable")
    gid = group[order]
    gid = np.cumsum(np.concatenate([[0], gid[1:] != gid[:-1]]))[:n]
    level = np.zeros(n, dtype=np.int64)
    while True:
        at = np.flatnonzero((np.bincount(gid, minlength=1)[gid] > 1) & (level < deep))
        if not len(at):
            return order, gid
        g, w = gid[at], words[order[at], level[at]]
        start = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        count = np.diff(np.append(start, len(g)))
        a, b, c = w[start], w[start + count // 2], w[start + count - 1]
        pivot = np.repeat(np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c)), count)
        part = 3 * g + (w >= pivot) + (w > pivot)
        by = np.argsort(part, kind="stable")
        part = part[by]
        order[at] = order[at][by]
        level[at] += part % 3 == 1
        fresh = np.concatenate([[False], gid[1:] != gid[:-1]])
        fresh[at[1:]] |= part[1:] != part[:-1]
        gid = np.cumsum(fresh)


def deep_shallow(rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte rows by group and content, and the common prefix of each with the one
    before it in that order."""
    n, width = rows.shape
    wide = np.zeros((n, -(-width // 8) * 8), dtype=np.uint8)
    wide[:, :width] = rows
    order, gid = multikey_quicksort(wide.view(">u8")[:, : SHALLOW // 8].astype(np.uint64), group)
    size = np.bincount(gid) if n else np.zeros(0, dtype=int)
    ends = np.cumsum(size)
    for g in np.flatnonzero(size > 1):
        mine = order[ends[g] - size[g] : ends[g]]
        if (rows[mine[1:]] == rows[mine[0]]).all():
            continue
        by = blind_trie_order([r.tobytes() for r in rows[mine]], SHALLOW)
        order[ends[g] - size[g] : ends[g]] = mine[by]
    common = np.zeros(n, dtype=np.int64)
    for s in range(1, n, 1 << 14):
        e = min(n, s + (1 << 14))
        differs = rows[order[s:e]] != rows[order[s - 1 : e - 1]]
        common[s:e] = np.where(differs.any(1), differs.argmax(1), width)
    return order, common


def covered(context: np.ndarray, llen: np.ndarray, rlen: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of anchors with contexts (left part backwards, then right part), those with the same
    gram in one ``run``: how many bytes to the left and right of each the windows reach that
    another anchor has too (zero and zero if none)."""
    n = len(run)
    left, right = context[:, :LEFT], context[:, LEFT:]
    order_r, common_r = deep_shallow(right, run)
    order_l, common_l = deep_shallow(left, run)
    most = np.zeros((2, n), dtype=np.int64)
    for side, order, common, length in ((0, order_l, common_l, llen), (1, order_r, common_r, rlen)):
        beside = np.maximum(common, np.concatenate([common[1:], [0]]))
        most[side][order] = beside
        most[side] = np.minimum(most[side], length)
    reach_l, reach_r = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    able = np.flatnonzero(most[0] + most[1] >= SPAN)
    if not len(able):
        return reach_l, reach_r
    low, high = SPAN - most[1][able], most[0][able]
    class_l, class_r = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for j in range(max(0, int(low.min())), min(LEFT, int(high.max())) + 1):
        mine = able[(low <= j) & (high >= j)]
        if len(mine) < 2:
            continue
        class_l[order_l] = np.cumsum(common_l < j)
        class_r[order_r] = np.cumsum(common_r < SPAN - j)
        key = class_r[mine] * (n + 1) + class_l[mine]
        by = np.argsort(key)
        key = key[by]
        same = key[1:] == key[:-1]
        hit = mine[by[np.concatenate([[False], same]) | np.concatenate([same, [False]])]]
        reach_l[hit] = j  # rises with j
        fresh = hit[reach_r[hit] == 0]
        reach_r[fresh] = SPAN - j  # the first j reaches farthest
    return reach_l, reach_r


def _columns(rows: pa.Table) -> tuple[np.ndarray, ...]:
    raw = rows.column("context").to_pylist()
    context = np.frombuffer(b"".join(raw), dtype=np.uint8).reshape(len(raw), LEFT + SPAN)
    return (context, *(rows.column(c).to_numpy().astype(np.int64) for c in ("llen", "rlen", "place")))


def _stretches(rows: pa.Table, start: np.ndarray, stop: np.ndarray) -> dict:
    """Rows of stretches that count as they are."""
    return {
        "doc_id": rows.column("doc_id").combine_chunks(),
        "th": rows.column("th").combine_chunks(),
        "start": start,
        "stop": stop,
        "hot": np.zeros(len(start), dtype=bool),
        "w1": np.zeros(len(start), dtype=np.int64),
        "w2": np.zeros(len(start), dtype=np.int64),
    }


def _hot_windows(rows: pa.Table) -> Iterator[dict]:
    """All windows around anchors of a gram with too many contexts to hold: stretches that
    count if another has the same digest."""
    rows = rows.filter(rows.column("context").is_valid())
    for i in range(0, rows.num_rows, 1000):
        part = rows.slice(i, 1000)
        context, llen, rlen, place = _columns(part)
        twin = part.column("twin").to_numpy(zero_copy_only=False)
        at, start, digest = [], [], []
        for r in range(len(place)):
            text = context[r, :LEFT][::-1].tobytes() + context[r, LEFT:].tobytes()
            for k in range(max(0, SPAN - int(rlen[r])), min(LEFT, int(llen[r])) + 1):
                at.append(r)
                start.append(int(place[r]) - k)
                # With its place in the window, so that two anchors of one window differ.
                digest.append(hashlib.md5(k.to_bytes(2, "little") + text[LEFT - k : LEFT - k + SPAN]).digest())
        at, start = np.array(at, dtype=np.int64), np.array(start, dtype=np.int64)
        pair = np.frombuffer(b"".join(digest), dtype="<i8").reshape(-1, 2)
        yield {
            **_stretches(part.take(pa.array(at)), start, start + SPAN),
            "hot": ~twin[at],  # what a twin covers counts already
            "w1": np.ascontiguousarray(pair[:, 0]),
            "w2": np.ascontiguousarray(pair[:, 1]),
        }


def _match(hot_run: int):
    def match(rows: pa.Table) -> Iterator[dict]:
        direct = rows.filter(rows.column("context").is_null())
        if direct.num_rows:
            place = direct.column("place").to_numpy()
            yield _stretches(direct, place, place + direct.column("rlen").to_numpy())
        rows = rows.filter(rows.column("context").is_valid())
        _, run, size = np.unique(rows.column("key").to_numpy(), return_inverse=True, return_counts=True)
        hot = np.flatnonzero(size[run] > hot_run)
        if len(hot):
            yield from _hot_windows(rows.take(pa.array(hot)))
        some = np.flatnonzero((size[run] > 1) & (size[run] <= hot_run))
        if not len(some):
            return
        rows, run = rows.take(pa.array(some)), run[some]
        context, llen, rlen, place = _columns(rows)
        reach_l, reach_r = covered(context, llen, rlen, run)
        got = np.flatnonzero((reach_r > 0) & ~rows.column("twin").to_numpy(zero_copy_only=False))
        if len(got):
            yield _stretches(rows.take(pa.array(got)), place[got] - reach_l[got], place[got] + reach_r[got])

    return match


def _kept(batch: pa.RecordBatch) -> Iterator[dict]:
    n_bytes, removed, spans, digest = [], [], [], []
    for text, stretches in zip(batch.column("text").to_pylist(), batch.column("stretches"), strict=True):
        text = text or b""
        n_bytes.append(len(text))
        if not stretches.is_valid or not len(stretches.values):
            removed.append(0)
            spans.append(0)
            digest.append(hashlib.sha256(text).hexdigest())
            continue
        pairs = stretches.values
        start, stop = _merged(pairs.field("start").to_numpy(), pairs.field("stop").to_numpy())
        left, at = hashlib.sha256(), 0
        for s, e in zip(start.tolist(), stop.tolist(), strict=True):
            left.update(text[at:s])
            at = e
        left.update(text[at:])
        removed.append(int((stop - start).sum()))
        spans.append(len(start))
        digest.append(left.hexdigest())
    yield {"doc_id": batch.column("doc_id"), "n_bytes": np.array(n_bytes, dtype=np.int64), "n_removed": np.array(removed, dtype=np.int64), "n_spans": np.array(spans, dtype=np.int64), "kept_sha256": pa.array(digest, pa.string())}


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & F.col(f"{a}.th").eqNullSafe(F.col(f"{b}.th"))


def repeats(docs: DataFrame, hot_run: int = HOT_RUN) -> tuple[DataFrame, DataFrame]:
    """The texts ``(doc_id, th, text)`` and the stretches ``(doc_id, th, start, stop)`` of
    bytes that repeat, overlapping ones included; ``th`` is a hash of the text that tells
    rows with one doc_id apart."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.xxhash64("text").alias("th"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    # A row that another repeats, doc_id and text, loses all bytes; one of them stands for all.
    names = texts.groupBy("doc_id", "th").agg(F.count("*").alias("n"), F.max(F.octet_length("text")).alias("size"))
    again = keep(names.filter("n > 1").select("doc_id", "th", "size"), "suffix-again")
    once = texts
    if some := not again.isEmpty():
        few = small(again)
        same = texts.alias("t"), few.alias("a"), _same("t", "a")
        once = same[0].join(*same[1:], "left_anti").unionByName(same[0].join(*same[1:], "left_semi").dropDuplicates(["doc_id", "th"]))
    grams = by_batch(once, _gram_rows, f"key long, gram long, kind byte, doc_id {kind}, th long")
    same = Window.partitionBy("key")
    wanted = (
        grams.withColumn("n", F.count("*").over(same)).withColumn("top", F.max("kind").over(same))
        .filter("kind = 1 OR (kind = 0 AND (n > 1 OR top = 2))")
        .select("doc_id", "th", F.coalesce("gram", "key").alias("gram"))
        .groupBy("doc_id", "th")
        .agg(F.collect_set("gram").alias("grams"))
    )
    asked = (
        once.alias("t").join(wanted.alias("w"), _same("t", "w"), "left")
        .select("t.doc_id", "t.th", "t.text", "w.grams").filter("grams IS NOT NULL")
    )
    contexts = by_batch(
        asked,
        _contexts,
        f"key long, doc_id {kind}, th long, place long, llen int, rlen int, twin boolean, context binary",
    )
    dealt = contexts.repartition(parts(docs.sparkSession), "key").sortWithinPartitions("key")
    found = by_runs(
        dealt,
        ["key"],
        _match(hot_run),
        f"doc_id {kind}, th long, start long, stop long, hot boolean, w1 long, w2 long",
        hot_run,
        _hot_windows,
    )
    found = keep(found, "suffix-stretches")
    direct, hot = found.filter("NOT hot"), found.filter("hot")
    stretches = direct.select("doc_id", "th", "start", "stop")
    if not hot.isEmpty():
        twice = hot.groupBy("w1", "w2").agg(F.count("*").alias("n")).filter("n > 1")
        stretches = stretches.unionByName(hot.join(twice, ["w1", "w2"]).select("doc_id", "th", "start", "stop"))
    if some:
        whole = again.filter(F.col("size") >= SPAN)
        stretches = stretches.unionByName(whole.select("doc_id", "th", F.lit(0).cast("long").alias("start"), F.col("size").cast("long").alias("stop")))
    return texts, stretches


def without_repeats(docs: DataFrame, hot_run: int = HOT_RUN) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    Null text is empty; texts under 200 bytes lose nothing. Rows that repeat another, null
    doc_ids too, lose all bytes if they are long enough, at a cost that grows with their number. An empty table gives no rows; other columns
    are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts, found = repeats(docs, hot_run)
    stretches = found.groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "stop")).alias("stretches"))
    rows = texts.alias("t").join(stretches.alias("s"), _same("t", "s"), "left").select("t.doc_id", "t.text", "s.stretches")
    return by_batch(rows, _kept, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
