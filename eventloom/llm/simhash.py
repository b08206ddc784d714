"""SimHash near-duplicates by a self-join of the binary trie of all fingerprints.

Equal fingerprints are one leaf, so a group of copies of any size is one row before any join. The 64
bits are dealt into one block more than the budget; two fingerprints within it agree in some block. So
there is a trie per block, over the fingerprints turned so that the block stands first, and only
pairs of a node with itself need be walked at the block's depth: a leaf is copied once per block.

A trie is walked as pairs of nodes: a pair keeps the number of bits in which its two prefixes
differ and is dropped when that exceeds the budget. Nodes go to tasks in bundles of about ``most``
leaves; a walk works on sorted arrays, several bits a step, and compares the remaining bits
when a pair of nodes holds a handful of leaves. A node too heavy for a task is first walked as a
table in Spark: pairs of nodes are expanded a few bits at a time by masks of few bits and equi-joins.
A pair of nodes whose leaves are already linked to each other is dropped too, so a dense cluster
gives a spanning tree and not all its pairs.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.common import stored
from eventloom.llm.components import components

SEED = 42
BITS = 64
NO_ID = -(1 << 63)
STEP = 4  # bits a walk in a task descends at once
LEAVES = 1024  # a pair of nodes with so many leaf pairs is compared leaf by leaf
ROOT_BITS = 16  # a trie has at most 2^16 nodes at the depth where its walk begins
FRONTIER = 1 << 20  # node or leaf pairs in memory at once


def fingerprint(text: str | None, words: int) -> int:
    """64-bit SimHash over word shingles with repeats; 0 for a text without words."""
    tokens = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(tokens) > words:
        spans = zip(starts[: len(tokens) - words + 1].tolist(), ends[words - 1 :].tolist())
        shingles = [joined[s:e] for s, e in spans]
    else:
        shingles = [joined]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(shingles))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        block = hashes[at : at + 4096].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes)).view(">u8")[0])


def fingerprints(docs: DataFrame, words: int = 4, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``fp`` (the 64 bits as a signed long) for every row."""

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            prints = np.fromiter((fingerprint(t.as_py(), words) for t in texts), np.uint64, batch.num_rows)
            columns = [*batch.columns[:-1], pa.array(prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "fp"])

    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField("fp", T.LongType())])
    return docs.select(*keep, "text").mapInArrow(run, schema)


# --- the walk inside a task -------------------------------------------------------------------


class _Trie:
    """The trie below ``depth`` of sorted distinct values: per level, where each node's leaves start."""

    def __init__(self, values: np.ndarray, depth: int):
        self.values = values
        self.starts, self.bits, self.child = [], [], []
        for d in [*range(depth, BITS, STEP), BITS]:
            prefix = values >> np.uint64(BITS - d) if d else np.zeros(len(values), np.uint64)
            starts = np.concatenate(([0], np.flatnonzero(prefix[1:] != prefix[:-1]) + 1))
            if self.starts:
                self.child.append(np.append(np.searchsorted(starts, self.starts[-1]), len(starts)))
            width = d - (self.depths[-1] if self.starts else d)
            self.bits.append((prefix[starts] & np.uint64((1 << width) - 1)).astype(np.uint8))
            self.starts.append(starts)
            self.depths = [*getattr(self, "depths", []), d]
        self.ends = [np.append(s[1:], len(values)) for s in self.starts]


def _pairs(sizes_a: np.ndarray, sizes_b: np.ndarray):
    """For pairs of ranges: the pair, and the offsets in its two ranges, of every combination."""
    n = sizes_a * sizes_b
    of = np.repeat(np.arange(len(n)), n)
    offset = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    return of, offset // sizes_b[of], offset % sizes_b[of]


def _compared(a, b, su, eu, sv, ev, budget):
    """Yields the leaf pairs within the budget, for pairs of leaf ranges. Ranges are padded to
    powers of two, so that ranges of like size are compared as one dense block."""
    wide = [np.ceil(np.log2(e - s)).astype(int) for s, e in ((su, eu), (sv, ev))]
    kind = wide[0] * BITS + wide[1]
    for k in np.unique(kind):
        mine = np.flatnonzero(kind == k)
        m, n = 1 << (k // BITS), 1 << (k % BITS)
        for at in range(0, len(mine), max(1, FRONTIER // (m * n))):
            part = mine[at : at + max(1, FRONTIER // (m * n))]
            i = su[part][:, None] + np.arange(m)
            j = sv[part][:, None] + np.arange(n)
            in_i, in_j = i < eu[part][:, None], j < ev[part][:, None]
            i, j = np.minimum(i, len(a) - 1), np.minimum(j, len(b) - 1)
            near = np.bitwise_count(a[i][:, :, None] ^ b[j][:, None, :]) <= budget
            p, x, y = np.nonzero(near)
            real = in_i[p, x] & in_j[p, y]
            p, x, y = p[real], x[real], y[real]
            yield i[p, x], j[p, y]


class _Labels:
    """Components of the leaves of one task."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self._count()

    def _count(self):
        self.changes = np.concatenate(([0], np.cumsum(self.label[1:] != self.label[:-1])))

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.label[i], self.label[j]
            open_ = a != b
            if not open_.any():
                break
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            parent = np.arange(len(self.label))
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
            while (parent[parent] != parent).any():
                parent = parent[parent]
            self.label = parent[self.label]
        self._count()

    def one(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.changes[end - 1] == self.changes[start]


def linked(a: np.ndarray, b: np.ndarray | None, depth: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links between values at most ``budget`` bits apart: pairs from ``a`` x ``b``, each of
    which shares ``depth`` bits, or pairs within ``a`` that share them if ``b`` is None. Both are
    sorted and distinct."""
    same = b is None
    ta = _Trie(a, depth)
    tb = ta if same else _Trie(b, depth)
    shift = 0 if same else len(a)
    values = a if same else np.concatenate((a, b))
    labels = _Labels(len(values))
    used = 0 if same or not depth else int(np.bitwise_count((a[0] ^ b[0]) >> np.uint64(BITS - depth)))
    roots = np.arange(len(ta.starts[0])) if same else np.zeros(1, np.int64)
    stack = [(0, roots, roots, np.full(len(roots), used))]
    while stack:
        level, u, v, used_ = stack.pop()
        su, eu, sv, ev = ta.starts[level][u], ta.ends[level][u], tb.starts[level][v], tb.ends[level][v]
        done = labels.one(su, eu) & labels.one(sv + shift, ev + shift) & (labels.label[su] == labels.label[sv + shift])
        size = (eu - su) * (ev - sv)
        few = ~done & ((size <= LEAVES) | (level == len(ta.starts) - 1))
        deep = ~done & ~few
        if few.any():
            for i, j in _compared(ta.values, tb.values, su[few], eu[few], sv[few], ev[few], budget):
                if same:
                    i, j = i[i < j], j[i < j]
                labels.link(i, j + shift)
        if deep.any():
            u, v, used_ = u[deep], v[deep], used_[deep]
            cu, cv = ta.child[level], tb.child[level]
            n = (cu[u + 1] - cu[u]) * (cv[v + 1] - cv[v])
            for part in np.split(np.arange(len(n)), np.searchsorted(np.cumsum(n), np.arange(FRONTIER, n.sum(), FRONTIER))):
                if not len(part):
                    continue
                p, q = u[part], v[part]
                of, x, y = _pairs(cu[p + 1] - cu[p], cv[q + 1] - cv[q])
                x, y = cu[p][of] + x, cv[q][of] + y
                now = used_[part][of] + np.bitwise_count(ta.bits[level + 1][x] ^ tb.bits[level + 1][y])
                ok = now <= budget
                if same:
                    ok &= x <= y
                if ok.any():
                    stack.append((level + 1, x[ok], y[ok], now[ok]))
    own = np.flatnonzero(labels.label != np.arange(len(values)))
    return values[own], values[labels.label[own]]


# --- the walk over the table of nodes ---------------------------------------------------------


def _prefix(value: Column, depth: int) -> Column:
    """The first ``depth`` bits in place, the others 0."""
    keep = 0 if depth == 0 else -(1 << (BITS - depth)) if depth < BITS else -1
    return value.bitwiseAND(F.lit(keep).cast("long"))


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >= 1 << (BITS - 1) else x


def _masks(start: int, end: int, budget: int) -> Column:
    """All ways to differ in at most ``budget`` of the bits from ``start`` to ``end``."""
    found = [
        _signed(sum(1 << (BITS - 1 - bit) for bit in bits))
        for n in range(budget + 1) for bits in combinations(range(start, end), n)
    ]
    return F.array(*[F.lit(x).cast("long") for x in found])


def _turned(leaves: DataFrame, blocks: int) -> DataFrame:
    """``turn, fp``: every fingerprint once per block, turned left so that the block stands first."""
    offsets = [BITS * k // blocks for k in range(blocks)]

    def left(k: int) -> Column:
        whole = F.col("fp")
        return whole if k == 0 else F.shiftleft(whole, k).bitwiseOR(F.shiftrightunsigned(whole, BITS - k))

    return leaves.select(F.inline(F.array(*[F.struct(F.lit(k).alias("turn"), left(k).alias("fp")) for k in offsets])))


def _node_pairs(leaves: DataFrame, heavy: DataFrame, depth: int, budget: int, most: int, stride: int) -> DataFrame:
    """``turn, u, v, depth``: node pairs within the budget that hold at most ``most`` leaves together.

    All leaf pairs within the budget below the ``heavy`` nodes are below exactly one of them.
    """
    heavy = heavy.select("turn", F.col("node").alias("u"), F.col("node").alias("v"))
    light, nxt = None, min(BITS, depth + stride)
    while True:
        nodes = leaves.groupBy("turn", _prefix(F.col("fp"), nxt).alias("node")).agg(F.count(F.lit(1)).alias("size"))
        nodes = stored(nodes.withColumn("above", _prefix(F.col("node"), depth)), "trie-nodes")
        left = nodes.select("turn", F.col("above").alias("u"), F.col("node").alias("nu"), F.col("size").alias("size_u"))
        right = nodes.select("turn", F.col("node").alias("nv"), F.col("size").alias("size_v"))
        # v's child: v's prefix, and below it u's bits with a few of them flipped.
        seg = _prefix(F.lit(-1).cast("long"), nxt).bitwiseXOR(_prefix(F.lit(-1).cast("long"), depth))
        paired = (
            heavy.join(left, ["turn", "u"]).withColumn("mask", F.explode(_masks(depth, nxt, budget)))
            .withColumn("nv", F.col("v").bitwiseOR(F.col("nu").bitwiseAND(seg)).bitwiseXOR(F.col("mask")))
            .filter(F.bit_count(F.col("nu").bitwiseXOR(F.col("nv"))) <= budget)
            .filter((F.col("u") != F.col("v")) | (F.col("nu") <= F.col("nv")))
        )
        frontier = stored(
            paired.join(right, ["turn", "nv"]).select(
                "turn", F.col("nu").alias("u"), F.col("nv").alias("v"), (F.col("size_u") + F.col("size_v")).alias("n")
            ),
            "trie-pairs",
        )
        depth, nxt = nxt, min(BITS, nxt + stride)
        at_bottom = depth == BITS
        kept = frontier.filter(F.lit(at_bottom) | (F.col("n") <= most)).select("turn", "u", "v", F.lit(depth).alias("depth"))
        light = kept if light is None else light.union(kept)
        heavy = frontier.filter(F.col("n") > most).select("turn", "u", "v")
        if at_bottom or heavy.limit(1).count() == 0:
            return light


def _links(a: np.ndarray, b: np.ndarray, turn: int) -> pd.DataFrame:
    """Links between turned values, turned back."""
    back = [x if turn == 0 else x >> np.uint64(turn) | x << np.uint64(BITS - turn) for x in (a, b)]
    return pd.DataFrame({"a": back[0].view(np.int64), "b": back[1].view(np.int64)})


def near_links(leaves: DataFrame, budget: int = 4, most: int = 1 << 15, stride: int = 3) -> DataFrame:
    """Links ``a, b`` that connect all fingerprints ``fp`` (distinct) at most ``budget`` bits apart.

    ``most`` bounds the leaves a task walks at once. A pair that agrees in several blocks may be linked once per block.
    """
    blocks = budget + 1
    depth = min(ROOT_BITS, BITS // blocks)
    turned = _turned(leaves, blocks)
    node = _prefix(F.col("fp"), depth).alias("node")
    # At most blocks x 2^ROOT_BITS rows, of which the heavy ones are broadcast.
    nodes = stored(turned.groupBy("turn", node).agg(F.count(F.lit(1)).alias("size")), "trie-roots")
    heavy = nodes.filter(F.col("size") * 2 > most)
    rooted = turned.withColumn("node", node)
    light = rooted.join(F.broadcast(heavy), ["turn", "node"], "left_anti")
    bundles = nodes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] // (blocks * most) + 1

    def walk_nodes(group: pd.DataFrame) -> pd.DataFrame:
        values = np.sort(group["fp"].to_numpy(np.int64).view(np.uint64))
        return _links(*linked(values, None, depth, budget), int(group["turn"].iloc[0]))

    bundled = light.select("turn", "fp", F.pmod(F.xxhash64("node"), F.lit(bundles)).alias("bundle"))
    links = bundled.groupBy("turn", "bundle").applyInPandas(walk_nodes, "a long, b long")
    if heavy.limit(1).count() == 0:
        return links

    below = rooted.join(F.broadcast(heavy), ["turn", "node"], "left_semi").select("turn", "fp")
    below = stored(below, "heavy-leaves")
    pairs = stored(_node_pairs(below, heavy, depth, budget, most, stride), "trie-light")
    sides = None
    for (at_depth,) in pairs.select("depth").distinct().collect():  # at most 64 numbers
        at = below.withColumn("node", _prefix(F.col("fp"), at_depth))
        here = pairs.filter(F.col("depth") == at_depth)
        u = here.withColumn("node", F.col("u")).join(at, ["turn", "node"]).select("turn", "u", "v", "depth", "fp")
        v = here.filter("u <> v").withColumn("node", F.col("v")).join(at, ["turn", "node"]).select("turn", "u", "v", "depth", "fp")
        sides = u.union(v) if sides is None else sides.union(u).union(v)

    def walk_pair(group: pd.DataFrame) -> pd.DataFrame:
        at_depth, turn = int(group["depth"].iloc[0]), int(group["turn"].iloc[0])
        ends = group[["u", "v"]].iloc[0].to_numpy(np.int64).view(np.uint64)
        values = np.sort(group["fp"].to_numpy(np.int64).view(np.uint64))
        if ends[0] == ends[1]:
            return _links(*linked(values, None, at_depth, budget), turn)
        mine = (values >> np.uint64(BITS - at_depth)) == (ends[0] >> np.uint64(BITS - at_depth))
        return _links(*linked(values[mine], values[~mine], at_depth, budget), turn)

    return links.union(sides.groupBy("turn", "u", "v", "depth").applyInPandas(walk_pair, "a long, b long"))


def near_groups(prints: DataFrame, budget: int = 4) -> DataFrame:
    """``fp, label, component_id`` for every distinct fingerprint of ``doc_id, fp``: the smallest id
    of the fingerprints linked by steps of at most ``budget`` bits (null if none has an id)."""
    leaves = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    label = components(near_links(leaves.select("fp"), budget))
    named = leaves.join(label, leaves["fp"] == label["node"], "left").select(
        "fp", "first_id", F.coalesce("label", "fp").alias("label")
    )
    smallest = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    return named.join(smallest, "label").select("fp", "label", "component_id")


def simhash_components(docs: DataFrame, words: int = 4, budget: int = 4) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row.

    A null text has no words and the fingerprint zero, which links like any other. A null id is
    passed over for the smallest id. Repeated rows are kept. An empty table gives an empty result.
    """
    prints = stored(fingerprints(docs, words), "doc-fingerprints")
    return prints.join(near_groups(prints, budget), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, words: int = 4, budget: int = 4) -> DataFrame:
    """The documents that stay when each group keeps one; columns unchanged.

    The one with the smallest id stays (a null id only where no other is), of rows with that id
    the one whose content, then all of whose columns, hash smallest.
    """
    columns = docs.columns
    keyed = docs.withColumns({
        "_loom_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
        "_loom_content": F.coalesce(F.xxhash64("text"), F.lit(0)),
    })
    prints = stored(fingerprints(keyed, words, ("doc_id", "_loom_content")), "doc-fingerprints")
    stay = (
        prints.join(near_groups(prints, budget), "fp")
        .filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("label", "component_id").agg(F.min("_loom_content").alias("_loom_content"))
        .select(F.coalesce("component_id", F.lit(NO_ID)).alias("_loom_id"), "_loom_content")
    )
    nth = F.row_number().over(W.partitionBy("_loom_id", "_loom_content").orderBy(F.xxhash64(*columns)))
    kept = keyed.join(stay, ["_loom_id", "_loom_content"], "left_semi")
    return kept.withColumn("_loom_nth", nth).filter("_loom_nth = 1").select(*columns)
