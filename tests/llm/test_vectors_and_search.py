"""Whitening, lexical search and nearest neighbours against brute force, and their odd cases."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import lexical, neighbors, whitening

VEC = "vec_id bigint, embedding array<float>, label int"
DOC = "doc_id bigint, text string, lang string"
ITEM = "item_id bigint, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def clashing(df, *names):
    return df.withColumns({n: F.lit("mine") for n in names})


def vectors(spark, data, kind=VEC):
    return spark.createDataFrame([(i, v, 0) for i, v in data], kind).repartition(3)


NAN, INF = float("nan"), float("inf")
# Null, empty, of nulls, not finite, of another dimension, zero, repeated, without an id.
ODD = [
    (1, None), (2, []), (3, [1.0, None, 2.0]), (4, [1.0, NAN, 2.0]), (5, [INF, 0.0, 0.0]), (6, [1.0, 2.0]),
    (7, [0.0, 0.0, 0.0]), (8, [1.0, 2.0, 3.0]), (8, [1.0, 2.0, 3.0]), (9, [1.0, 2.0, 3.0]), (None, [2.0, -1.0, 0.5]),
    (10, [-1.0, 0.25, 4.0]), (11, [0.5, 0.5, 0.5]), (12, [3.0, 0.1, -2.0]),
]


# --- whitening --------------------------------------------------------------------------------


def brute_whitening(data, components=8):
    fit = [v for _, v in data]
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in fit]
    n, d = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(d)]
    gap = [[n * r[i] - sums[i] for i in range(d)] for r in x]
    cov = np.array([[sum(g[i] * g[j] for g in gap) / n**3 for j in range(d)] for i in range(d)])
    values, basis = np.linalg.eigh(cov)
    order = np.argsort(-values)[:components]
    z = (np.array(gap, dtype=float) / n) @ basis[:, order] / np.sqrt(values[order])
    return n, [sum(c * c for c in g) for g in gap], z, values[order] / np.trace(cov), values[order]


def test_whitening_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    mix = rng.normal(size=(12, 12)) * np.linspace(3, 0.1, 12)
    data = [(i, [float(np.float32(c)) for c in rng.normal(size=12) @ mix + 40]) for i in range(300)]
    rows = whitening.whiten(vectors(spark, data)).collect()
    n, deviation, z, explained, _ = brute_whitening(data)
    assert len(rows) == 300 * 8
    for r in rows:
        c = r["component"] - 1
        assert (r["n"], int(r["deviation"])) == (n, deviation[r["vec_id"]])
        assert abs(r["whitened"]) == pytest.approx(abs(z[r["vec_id"], c]), rel=1e-9, abs=1e-9)
        assert r["explained"] == pytest.approx(explained[c], rel=1e-9)
        assert 0 <= r["identity_error"] < 1e-9
    # One sign for all rows of a component.
    for c in range(8):
        ratio = {round(r["whitened"] / z[r["vec_id"], c]) for r in rows if r["component"] == c + 1 and abs(z[r["vec_id"], c]) > 1e-3}
        assert len(ratio) == 1


def test_covariance_is_exact_beyond_doubles(spark):
    """A mean of 2^40 and spreads of a few units: squares that are not centred lose everything."""
    rng = random.Random(2)
    big = float(2**40)
    data = [(i, [big + rng.randrange(-3, 4) / 1024, big + rng.randrange(-3, 4) / 1024, rng.random()]) for i in range(50)]
    df = spark.createDataFrame([(i, v, 0) for i, v in data], VEC.replace("float", "double"))
    model = whitening.fit(df, "embedding", 3)
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in data]
    n, sums = len(x), [sum(r[i] for r in x) for i in range(3)]
    cov = np.array([[sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in x) / n**3 for j in range(3)] for i in range(3)])
    assert model.sums == tuple(sums)
    want = np.sort(np.linalg.eigvalsh(cov))[::-1]
    assert model.values == pytest.approx(want, rel=1e-12, abs=1e-14 * want[0])
    huge = spark.createDataFrame([(1, [1e300, 1.0], 0), (2, [-1e300, 2.0], 0), (3, [0.0, 5.0], 0)], VEC.replace("float", "double"))
    rows = whitening.whiten(huge).collect()
    assert len(rows) == 6 and all(math.isfinite(r["whitened"]) for r in rows if r["component"] == 1)


def test_whitening_odd_rows(spark):
    df = clashing(vectors(spark, ODD), "component", "n", "i", "dims")
    rows = whitening.whiten(df)
    kept = [(i, v) for i, v in ODD if v and len(v) == 3 and all(c is not None and math.isfinite(c) for c in v)]
    assert got(rows.where("component = 1"), "vec_id") == sorted([(i,) for i, _ in kept], key=repr)
    assert {r["n"] for r in rows.collect()} == {len(kept)} and rows.count() == 3 * len(kept)
    assert got(rows, "vec_id", "component", "deviation") == got(whitening.whiten(df.repartition(7)), "vec_id", "component", "deviation")
    flat = whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 4.0])])).collect()
    assert {(r["component"], r["whitened"]) for r in flat} == {(1, -1.0), (1, 1.0), (2, None)}
    alone = whitening.whiten(vectors(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r["whitened"], r["explained"], int(r["deviation"])) for r in alone] == [(None, 0.0, 0)] * 2
    assert whitening.whiten(vectors(spark, [])).collect() == whitening.whiten(vectors(spark, [(1, None)])).collect() == []


# --- lexical search ---------------------------------------------------------------------------


def brute_rank(docs, items, k):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = [(i, Counter(TERM.findall((t or "").translate(low)))) for i, t, *_ in docs]
    held = [c for _, c in counts if c]
    n_docs, n_terms = len(held), sum(c.total() for c in held)
    df = Counter(term for c in held for term in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(TERM.findall((t or "").translate(low)))
    out = []
    for item, terms in asked.items():
        scored = []
        for doc, c in counts:
            m = 100 - 50 + ((50 * c.total() * n_docs) // n_terms) if c else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in terms if c[t]
            )
            if score > 0:
                scored.append((-score, doc is None, doc))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, at + 1, doc, -score) for at, (score, _, doc) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def text_of(rng, words, n):
    return "".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "-", "\x00", "_"]) for _ in range(n))


def test_lexical_ranks_equal_brute_force(spark, monkeypatch):
    rng = random.Random(11)
    words = ["Straße", "ÄRGER", "ärger", "alpha", "Beta", "x1", "東京", "a", "İ", "ﬁn", *[f"w{i}" for i in range(60)]]
    docs = [(i, text_of(rng, words, rng.randrange(0, 60)), None) for i in range(400)]
    docs += [(i + 400, docs[i % 7][1], None) for i in range(120)]  # ties
    items = [(i, text_of(rng, words, rng.randrange(0, 25))) for i in range(30)]
    df, ask = spark.createDataFrame(docs, DOC).repartition(5), spark.createDataFrame(items, ITEM)
    want = brute_rank(docs, items, 20)
    assert got(lexical.rank(df, ask, 20), "item_id", "rank", "doc_id", "score") == want
    # Blocks of items, tiles of terms and documents, and chunks of a text change nothing.
    monkeypatch.setattr(lexical, "ITEMS", 7)
    assert got(lexical.rank(df, ask, 20), "item_id", "rank", "doc_id", "score") == want


def test_tiles_are_exact_and_terms_cross_chunks(monkeypatch):
    rng = np.random.default_rng(3)
    weights = rng.integers(0, 22_000, 500)
    of_item, of_term = np.repeat(np.arange(4), 500), np.tile(np.arange(500), 4)
    row, term, impact = np.repeat(np.arange(50), 500), np.tile(np.arange(500), 50), rng.integers(0, 10**6, 50 * 500)
    want = (impact.reshape(50, 500).astype(object) @ weights.astype(object))
    monkeypatch.setattr(lexical, "TERMS_TILE", 37)
    scores = lexical.tile_scores(weights, of_item, of_term, 4, row, term, impact, 50)
    assert (scores == want.astype(np.int64)).all()
    assert lexical._tile_terms(np.array([1 << 40])) == 1  # a sum of one product still fits
    text = "Ä1 bc " * 1000 + "z" * 5000
    whole = lexical.term_counts(text.encode())
    monkeypatch.setattr(lexical, "CHUNK", 11)
    assert lexical.term_counts(text.encode()) == whole == Counter({"Ä1".encode(): 1000, b"bc": 1000, b"z" * 5000: 1})


def test_lexical_odd_rows(spark):
    docs = [(1, "one two", None), (2, None, None), (3, "", None), (4, " !?", None), (5, "two", None), (5, "two", None), (None, "two", None), (6, "word " * 30_000 + "two", None)]
    items = [(1, "two TWO"), (1, "one"), (2, None), (3, "absent"), (None, "word"), (4, "")]
    df = clashing(spark.createDataFrame(docs, DOC), "score", "n", "ids", "item_id", "term")
    ask = clashing(spark.createDataFrame(items, ITEM), "rank", "doc_id", "at")
    want = brute_rank(docs, items, 50)
    assert got(lexical.rank(df, ask), "item_id", "rank", "doc_id", "score") == want and len(want) == 6
    assert lexical.rank(df.where("false"), ask).collect() == lexical.rank(df, ask.where("false")).collect() == []


# --- nearest neighbours -----------------------------------------------------------------------


def brute_nearest(data, queries, k):
    out = {}
    for q, v in queries:
        near = sorted((float(np.sqrt(((np.array(v) - np.array(u)) ** 2).sum())), i) for i, u in data if i != q and len(u) == len(v))
        out[q] = near[:k]
    return out


def test_recall_over_several_shards(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(25, 16))
    data = [(i, [float(np.float32(c)) for c in centres[i % 25] * 2 + rng.normal(size=16)]) for i in range(3000)]
    df = vectors(spark, data)
    index = neighbors.build_index(df, shard_rows=800)
    shards = index.collect()
    assert len(shards) == 4 and sum(len(r["first_ids"]) for r in shards) == 3000
    for r in shards:  # flat arrays: nodes x degree places of each level
        assert len(r["neighbours"]) == 4 * sum(n * d for n, d in zip(r["level_nodes"], r["level_degrees"]))
    asked = df.where("vec_id % 100 = 0")
    rows = neighbors.top_k(df, asked, 10, index=index).collect()
    truth = brute_nearest(data, [data[i] for i in range(0, 3000, 100)], 10)
    found = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        found[r["query_id"]].append((r["score"], r["vec_id"]))
        v, u = np.array(data[r["query_id"]][1]), np.array(data[r["vec_id"]][1])
        assert r["score"] == pytest.approx(np.sqrt(((v - u) ** 2).sum()), rel=1e-12)
    assert all(f == sorted(f) and len(f) == 10 for f in found.values()) and len(found) == 30
    hits = sum(len({i for _, i in truth[q]} & {i for _, i in found[q]}) for q in truth)
    assert hits >= 0.95 * 300
    again = got(neighbors.top_k(df.repartition(2), asked, 10), "query_id", "rank", "vec_id", "score")
    assert again == got(neighbors.top_k(df, asked, 10), "query_id", "rank", "vec_id", "score")


def test_graph_reaches_every_node():
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.normal(size=(600, 8)) * 0.01 + rng.normal(size=8) * 9 for _ in range(4)])  # clusters far apart
    points = points[rng.permutation(len(points))]
    graph = neighbors.build_graph(points)
    met = neighbors.search_graph(graph, points)
    assert np.mean([i in row for i, row in enumerate(met)]) > 0.99
    assert all((row[row >= 0] < len(links)).all() for links in graph.links for row in links)
    assert neighbors.build_graph(points[:1]).links[0].tolist() == [[-1] * 32]


def test_equal_vectors_and_odd_rows(spark):
    common = [(i, [1.0, 0.0, 0.0, 2.0]) for i in range(500)]  # one vector holds most rows
    rng = np.random.default_rng(6)
    others = [(i, [float(np.float32(c)) for c in rng.normal(size=4)]) for i in range(500, 700)]
    rows = neighbors.top_k(vectors(spark, common + others), vectors(spark, [common[3], common[400], others[0]])).collect()
    truth = brute_nearest(common + others, [common[3], common[400], others[0]], 10)
    for q, near in truth.items():
        mine = [(r["score"], r["vec_id"]) for r in sorted(rows, key=lambda r: r["rank"]) if r["query_id"] == q]
        assert [i for _, i in mine] == [i for _, i in near]
    df = clashing(vectors(spark, ODD), "rank", "score", "shard", "ids", "dim", "id")
    usable = list({(i, tuple(v)) for i, v in ODD if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)})
    truth = brute_nearest(usable, usable, 10)
    mine = neighbors.top_k(df, df)
    assert got(mine, "query_id", "rank", "vec_id") == sorted([(q, n + 1, i) for q, near in truth.items() for n, (_, i) in enumerate(near)], key=repr)
    assert neighbors.top_k(df.where("false"), df).collect() == neighbors.top_k(df, df.where("false")).collect() == []
