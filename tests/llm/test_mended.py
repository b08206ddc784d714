"""Tied segmentations, covering radii, copies of trie leaves, outliers and the pipeline, by brute force."""

import random
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventloom.llm import common, hamming, lines, pieces, quality, simhash
from eventloom.llm.queries import ORACLES
from eventloom.session import checkpoint_root
from test_operators import DOC, SHARED, brute_fingerprint, brute_labels, brute_lines, brute_segmentations

SF = "/root/testdata/sf0.001"

# --- pieces ---


@pytest.mark.parametrize("char", ["a", "-", "=", "."])
def test_tied_segmentations_against_all(char):
    v = pieces.vocabulary(pieces.MODEL)
    text = char * 12
    want = brute_segmentations(v, " " + text)
    encoded = next(pieces.Encoder(n=4).encode([text]))
    ids, others = encoded.ids.tolist(), encoded.others[0]
    assert [encoded.score[0], *(s for s, _ in others)] == pytest.approx([s for s, _ in want[:4]])
    paths = {tuple(ids), *(tuple(pieces.edited(ids, e)) for _, e in others)}
    assert len(paths) == 4 and paths <= {p for _, p in want}


def test_long_runs_are_linear():
    v = pieces.vocabulary(pieces.MODEL)
    for char in "-.=a#é漢":
        text = char * 20_000
        begun = time.perf_counter()
        encoded = next(pieces.Encoder(n=4).encode([text]))
        assert time.perf_counter() - begun < 15  # some two seconds; ties in breadth never ended
        assert pieces.decodes(v, text, encoded.ids, encoded.others[0])


def test_long_chunks_are_not_remembered():
    encoder = pieces.Encoder(n=2)
    texts = ["short words here", "x" * 5000, "short " + "y" * 400, "words"]
    found = next(encoder.encode(texts))
    assert max(map(len, encoder.memo)) <= pieces.WORTH
    again = next(encoder.encode(texts))
    assert (found.ids == again.ids).all() and (found.score == again.score).all()


# --- Hamming search ---


def test_every_query_is_covered_by_its_radius(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), hamming.sign_code("embedding").alias("code")
    )
    codes = [(r["id"], r["code"] % (1 << 64)) for r in rows.collect()]
    n, k = len({c for _, c in codes}), 10
    segments = max(2, min(16, round(64 / np.log2(n))))
    _, wanted, found = hamming._covered(rows, rows.where("id % 50 = 0"), k, None)
    radii = {r["query"] % (1 << 64): r["radius"] for r in found.select("query", "radius").distinct().collect()}
    assert len(radii) == wanted.select("code").distinct().count()
    for query, radius in radii.items():
        reach = sorted(bin(query ^ c).count("1") for _, c in codes)[k]
        assert radius == reach // segments  # the smallest r with reach < segments * (r + 1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


# --- SimHash ---


def test_a_leaf_is_copied_once_per_block(spark):
    rng = random.Random(3)
    values = sorted({rng.getrandbits(64) for _ in range(2000)})
    leaves = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp bigint")
    turned = simhash._turned(leaves, 5)
    assert turned.count() == 5 * len(values)
    back = {0: 0, 1: 12, 2: 25, 3: 38, 4: 51}
    for r in turned.limit(500).collect():
        x, k = r["fp"] % (1 << 64), back[0] if r["turn"] == 0 else r["turn"]
        assert ((x >> k | x << (64 - k)) % (1 << 64)) in set(values)
    counted = []
    real = simhash.linked

    def counting(a, b, depth, budget):
        counted.append(len(a) + (0 if b is None else len(b)))
        return real(a, b, depth, budget)

    # The same bundles, walked here instead of in tasks.
    depth = 64 // 5
    for turn, part in turned.toPandas().groupby("turn"):
        counting(np.sort(part["fp"].to_numpy(np.int64).view(np.uint64)), None, depth, 4)
    assert sum(counted) == 5 * len(values)


def test_pairs_that_agree_in_one_block_only(spark):
    """Four bits apart, one in each of four blocks: only the fifth block finds them."""
    base = 0x0123456789ABCDEF
    starts, others = [0, 12, 25, 38, 51], []
    for free in range(5):
        x = base
        for block in range(5):
            if block != free:
                x ^= 1 << (63 - starts[block] - 3)
        others.append(x)
    values = [base, *others, base ^ 0b11111]  # the last is five bits off
    leaves = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp bigint")
    for most in (1 << 15, 2):  # light roots, and heavy ones split down to the last bit
        links = {(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.near_links(leaves, 4, most=most).collect()}
        label = {v: v for v in values}
        for a, b in links:
            old, new = label[a], label[b]
            label = {v: new if x == old else x for v, x in label.items()}
        want = brute_labels(values, 4)
        assert {frozenset(v for v in values if label[v] == label[w]) for w in values} == {
            frozenset(v for v in values if want[v] == want[w]) for w in values
        }


# --- lines ---


def test_a_failed_run_leaves_no_table(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"{SHARED}\nown {i}", "en", "a", 0) for i in range(20)], DOC)
    before = {t.name for t in spark.catalog.listTables()}
    folder = common._FOLDER.get()
    merged = lines.LineRuns.merged

    def fail(self):
        merged(self)
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(lines.LineRuns, "merged", fail)
        with pytest.raises(OSError):
            lines.dedup_lines(docs)
    assert {t.name for t in spark.catalog.listTables()} == before
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(f"{checkpoint_root(spark)}/{folder}")
    names = [s.getPath().getName() for s in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)]
    assert not [n for n in names if n.startswith("loom_line_run")]


# --- quality ---


def brute_mcd(x, seed=0):
    """Minimum covariance determinant by many random starts and exact halves, reweighted."""
    rng = np.random.default_rng(seed)
    n, p = x.shape
    h = (n + p + 1) // 2
    floors = np.diag(np.array(quality.FLOORS) ** 2)
    half = quality._consistency(h / n)
    best = None
    for _ in range(60):
        rows = rng.choice(n, p + 1, replace=False)
        for _ in range(20):
            mean, cov = x[rows].mean(0), np.cov(x[rows].T, bias=True) * half + floors
            d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
            rows = np.argsort(d, kind="stable")[:h]
        det = np.linalg.slogdet(np.cov(x[rows].T, bias=True) * half + floors)[1]
        if best is None or det < best[0]:
            best = det, rows
    rows = best[1]
    mean, cov = x[rows].mean(0), np.cov(x[rows].T, bias=True) * half + floors
    d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
    near = d <= quality._quantile(quality.REWEIGHT)
    mean, cov = x[near].mean(0), np.cov(x[near].T, bias=True) * quality._consistency(quality.REWEIGHT) + floors
    return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)


def test_verdicts_equal_a_straightforward_estimate(spark):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(900)]
    rows = []
    for i in range(400):
        words = rng.choices(vocabulary, k=rng.randint(80, 300))
        if i % 5 >= 3:  # two fifths are junk of one kind
            words = [w + rng.choice(["#", "$$", "|<>", "%&*"]) if rng.random() < 0.6 else w for w in words]
        elif i % 7 == 0:
            words[3] += "#"
        rows.append((i, " ".join(words), "en", "hot", 0))
    judged = quality.judge(spark.createDataFrame(rows, DOC)).toPandas().sort_values("doc_id")
    n = judged["n_words"].to_numpy(float)
    x = np.stack([
        np.log((judged["word_chars"] + 1) / (n + 1)), np.sqrt(judged["n_symbols"] / n),
        np.sqrt(judged["n_dup_lines"] * 10 / (n + quality.STEADY)), np.sqrt(judged["n_repeat_words"] / (n + quality.STEADY)),
    ], axis=1)
    assert not judged["base_failed"].any()
    want = brute_mcd(x) <= quality.CUTOFF
    assert (judged["kept"].to_numpy() == want).all()
    assert 200 <= want.sum() <= 260 and not judged["kept"].to_numpy()[3::5].any()


def test_a_group_is_spread_over_tasks(spark):
    rows = spark.range(6400).select(
        F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit("hot").alias("source"),
        *[(F.col("id") % 97 + 60).alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
    )
    parts = quality._vector(rows).groupBy(*quality.GROUP, "_loom_salt").count().collect()
    assert len(parts) == quality.SALTS and max(r["count"] for r in parts) < 2 * 6400 / quality.SALTS


# --- the pipeline ---


def brute_score(v, text):
    """Score of the best segmentation, by a plain dynamic programme over all pieces."""
    if not text:
        return 0.0
    text = " " + text
    marked = text.replace(" ", pieces.MARK)
    best = [0.0] + [-np.inf] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - v.longest), end):
            if (k := v.ids.get(marked[start:end])) is not None and pieces.MARK not in text[start:end]:
                best[end] = max(best[end], best[start] + float(v.score[k]))
        if marked[end - 1] not in v.ids or text[end - 1] == pieces.MARK:
            best[end] = max(best[end], best[end - 1] + v.unknown)
    return best[-1]


def pipeline_fixture():
    rng = random.Random(12)
    languages = {"en": "the of and to in is that for was with".split(), "de": "der die und das ist nicht ein von mit auch".split()}
    rows = []
    for i in range(90):
        lang, words = list(languages.items())[i % 2]
        body = [" ".join(rng.choices(words, k=14)) for _ in range(rng.randint(2, 5))]
        if i % 9 == 0:
            body.insert(1, SHARED)
        rows.append((i, "\n".join(body), lang, "hot" if i % 3 else "s", 0))
    rows += [(100 + i, rows[4][1], "en", "copies", 0) for i in range(6)]  # exact copies
    rows += [(120 + i, rows[6][1] + f" extra{i}" * (i % 2), "en", "near", 0) for i in range(6)]
    rows += [(130, None, "en", "a", 0), (131, "", "en", "a", 0), (132, "1234 !!", None, "a", 0), (133, "ж", None, "a", 0), (134, "z" * 3000, None, "a", 0)]
    return rows


def test_pipeline_equals_a_brute_force_pipeline(spark, tmp_path):
    rows = pipeline_fixture()
    spark.createDataFrame(rows, DOC).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    v = pieces.vocabulary(pieces.MODEL)

    stay = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    assert {r[0] for r in rows} - {r[0] for r in stay} == {130, 131, 132}
    texts = {i: text for i, _, _, text in brute_lines(stay)}
    stay = [(i, texts[i], lang, source) for i, _, lang, source, _ in stay]
    prints = {r[0]: brute_fingerprint(r[1]) for r in stay}
    label = brute_labels(list(prints.values()), 4)
    first = {}
    for i in sorted(prints):
        first.setdefault(label[prints[i]], i)
    stay = [r for r in stay if first[label[prints[r[0]]]] == r[0]]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", stay)
    mixed = con.execute(ORACLES["op1_mix_sources"])
    columns = [c[0] for c in mixed.description]
    want = []
    for row in mixed.fetchall():
        r = dict(zip(columns, row))
        copies = r["taken"] // r["size"] if r["size"] else 0
        want += [(r["doc_id"], texts[r["doc_id"]])] * copies
    assert sorted((r["doc_id"], pieces.decode(v, r["ids"])) for r in out) == sorted(want)
    assert all(r["round_trip"] and r["n_chars"] == len(texts[r["doc_id"]]) for r in out)
    for r in out:
        assert r["score"] == pytest.approx(brute_score(v, texts[r["doc_id"]]))


def test_stages_leave_only_their_results(spark, tmp_path):
    with common.working_folder(spark, "gone"):
        kept = common.stored(spark.range(3), "kept", folder="llm")
        path = f"{checkpoint_root(spark)}/{common._FOLDER.get()}"
        common.stored(spark.range(3), "work")
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    assert not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    assert kept.count() == 3 and common._FOLDER.get() == "llm"


def test_stages_carry_columns_with_the_operators_names(spark, tmp_path):
    docs = spark.createDataFrame(pipeline_fixture(), DOC).withColumns(
        {n: F.lit("mine") for n in ("score", "fp", "size", "start", "bin", "d2", "batch", "coverage", "label", "node")}
    )
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert set(docs.columns) >= {"fp", "size", "start", "bin", "d2", "batch", "label", "node"}
        assert all(r["fp"] == r["size"] == r["label"] == "mine" for r in docs.collect())
