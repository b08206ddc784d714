"""The training-data operators on small tables: brute force, edge cases, repeated runs."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from eventloom.llm import hamming, html, language, lines, mixing, pieces, pii, quality, sharding, simhash
from eventloom.llm.components import components

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SHARED = "This very long line stands in a good many documents."

# Nulls in every column, empty and blank texts, ties, repeated rows, a long text.
ODD = [
    (1, "one two three four five", "en", "a", 23),
    (2, None, "en", "a", None),
    (3, "", None, "b", 0),
    (4, " \n\t ", "de", None, 4),
    (5, "one two three four five", "en", "a", 23),
    (5, "one two three four five", "en", "a", 23),
    (None, "no id here", None, None, None),
    (None, "no id here", None, None, None),
    (6, "1234 !!", "fr", "b", 7),
    (7, "word " * 30_000, "en", "a", 150_000),
    (8, f"x\n{SHARED}\n{SHARED}", "en", "c", None),
    (9, f"  {SHARED.upper()}\ny", "en", "c", None),
    (10, SHARED, "en", "c", None), (11, SHARED, "en", "c", None), (12, f"{SHARED}\n", "en", "c", None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOC).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def clashing(df, *names):
    """The table with extra columns that have an operator's result names."""
    return df.withColumns({n: F.lit("mine") for n in names})


# --- mixing -----------------------------------------------------------------------------------


def test_mix_odd_rows(odd, empty):
    mixed = mixing.mix(clashing(odd, "size", "target", "copies"))
    rows = mixed.collect()
    assert len(rows) == len(ODD) and {"lang", "n_chars"} <= set(mixed.columns)
    assert sorted(r["size"] for r in rows) == sorted(len(WORDS.findall(t or "")) for _, t, *_ in ODD)
    assert all(0 <= r["copies"] <= 3 for r in rows)
    assert {r["source"] for r in rows} == {"a", "b", "c", None}
    assert got(mixed, "doc_id", "copies") == got(mixing.mix(odd.repartition(7)), "doc_id", "copies")
    assert mixing.mix(empty).collect() == []
    assert mixing.emit(mixed).count() == sum(r["copies"] for r in rows)


def test_targets_stop_at_the_cap_and_share_the_rest(spark):
    sizes = {"a": 10, "b": 1000, "c": 5000, None: 30}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    found = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    weights = dict(zip(["a", "b", "c", None], [5, 2, 1, 5]))
    capped = set()
    while True:  # cap, share what is left by weight, until none is above
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        free = {s: rest * weights[s] / sum(weights[x] for x in sizes if x not in capped) for s in sizes if s not in capped}
        over = {s for s in free if free[s] > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    want = free | {s: 3 * sizes[s] for s in capped}
    assert found == pytest.approx(want) and sum(found.values()) == pytest.approx(sum(sizes.values()))


def test_taken_words_come_near_the_target(spark):
    rng = random.Random(3)
    rows = [(i, "w " * int(rng.lognormvariate(4, 1) + 1), "en", "hot" if i % 3 else f"s{i % 4}", 0) for i in range(4000)]
    mixed = mixing.mix(spark.createDataFrame(rows, DOC))
    taken = mixed.groupBy("source", "target").agg(F.sum(F.col("copies") * F.col("size")).alias("taken")).collect()
    assert all(abs(r["taken"] - r["target"]) < 0.03 * r["target"] for r in taken)


# --- shards -----------------------------------------------------------------------------------


def test_shards(spark, odd, empty):
    rows = sharding.assign_shards(odd, 4, ("doc_id", "text")).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        data = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 16, zlib.crc32(data))
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assign_shards(empty).collect() == []
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 90).cast("int")).alias("text"))
    size = [r[1] for r in sharding.assign_shards(many, 7).groupBy("shard").agg(F.sum("size")).collect()]
    assert len(size) == 7 and max(size) - min(size) <= 2 * (89 + 16)


def test_written_shards_hold_every_row(spark, odd, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(clashing(odd, "shard", "size"), path, 3)
    back = spark.read.parquet(path)
    assert got(back, "doc_id", "text") == got(odd, "doc_id", "text")


# --- lines ------------------------------------------------------------------------------------


def brute_lines(rows, min_chars=40, min_docs=5):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(" \t\n\x0b\f\r").translate(low)
    number = lambda i: -(1 << 63) if i is None else i
    holders = defaultdict(set)
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(number(i))
    out = []
    for i, text, *_ in rows:
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == number(i)]
        out.append((i, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_lines(spark, odd, empty, batches):
    columns = ("doc_id", "n_lines", "n_dropped", "text")
    found = lines.dedup_lines(clashing(odd, "n_lines"), batches=batches)
    assert got(found, *columns) == brute_lines(ODD)
    assert any(r[2] for r in brute_lines(ODD))
    if batches == 2:
        assert lines.dedup_lines(empty).collect() == []


def test_lines_across_batches(spark):
    rng = random.Random(5)
    pool = [f"{k} " + "É shared line of more than forty characters" for k in range(12)]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.5 else f"own {i}" for _ in range(6)), "en", "a", 0) for i in range(60)]
    found = lines.dedup_lines(spark.createDataFrame(rows, DOC), min_docs=9, batches=7)
    assert got(found, "doc_id", "n_lines", "n_dropped", "text") == brute_lines(rows, min_docs=9)


# --- SimHash ----------------------------------------------------------------------------------


def brute_fingerprint(text, words=4):
    tokens = WORDS.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_labels(values, budget):
    values = np.array(sorted(set(values)), np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= budget
    label = np.arange(len(values))
    while True:
        new = np.where(near, label[None, :], len(values)).min(axis=1)
        if (new == label).all():
            return {int(v): int(values[k]) for v, k in zip(values, label)}
        label = new


def clustered(n, seed):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(6)]
    out = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(n):
        x = rng.choice(centres)
        for bit in rng.sample(range(64), rng.randint(0, 6)):
            x ^= 1 << bit
        out.append(x)
    return sorted(set(out))


def grouped(links, values):
    label = {v: v for v in values}
    for a, b in links:
        old, new = label[a], label[b]
        label = {v: new if x == old else x for v, x in label.items()}
    groups = defaultdict(set)
    for v, x in label.items():
        groups[x].add(v)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("seed", [1, 2])
def test_walk_in_a_task(seed):
    values = np.array(clustered(300, seed), np.uint64)
    want = defaultdict(set)
    for v, x in brute_labels(values.tolist(), 4).items():
        want[x].add(v)
    a, b = simhash.linked(values, None, 0, 4)
    assert grouped(zip(a.tolist(), b.tolist()), values.tolist()) == sorted(map(sorted, want.values()))
    low, high = values[values < 1 << 63], values[values >= 1 << 63]
    links = [simhash.linked(low, None, 1, 4), simhash.linked(high, None, 1, 4), simhash.linked(low, high, 1, 4)]
    joined = [(int(x), int(y)) for a, b in links for x, y in zip(a, b)]
    assert grouped(joined, values.tolist()) == sorted(map(sorted, want.values()))


def test_walk_over_nodes_splits_heavy_pairs(spark):
    values = clustered(150, 9)
    leaves = spark.createDataFrame([(v - (1 << 64) if v >= 1 << 63 else v,) for v in values], "fp bigint")
    links = simhash.near_links(leaves, 4, most=40).collect()
    want = defaultdict(set)
    for v, x in brute_labels(values, 4).items():
        want[x].add(v)
    joined = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in links]
    assert grouped(joined, values) == sorted(map(sorted, want.values()))


def test_simhash(odd, empty):
    ids = defaultdict(list)
    fingerprint = {i: brute_fingerprint(t) for i, t, *_ in ODD}
    label = brute_labels([brute_fingerprint(t) for _, t, *_ in ODD], 4)
    for i, t, *_ in ODD:
        ids[label[brute_fingerprint(t)]] += [i] if i is not None else []
    want = [(i, f"{brute_fingerprint(t):016x}", min(ids[label[brute_fingerprint(t)]], default=None)) for i, t, *_ in ODD]
    assert fingerprint[2] == fingerprint[3] == fingerprint[4] == 0
    assert got(simhash.simhash_components(odd), "doc_id", "fingerprint", "component_id") == sorted(want, key=repr)
    assert simhash.simhash_components(empty).collect() == []
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert [r[0] for r in got(kept, "doc_id")].count(5) == 0
    assert kept.count() == len(set(label[brute_fingerprint(t)] for _, t, *_ in ODD))


def test_components_of_a_long_chain(spark):
    order = list(range(60))
    random.Random(4).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:])) + [(100, 101)], "a bigint, b bigint")
    assert got(components(edges), "node", "label") == sorted([(i, 0) for i in range(60)] + [(100, 100), (101, 100)], key=repr)


# --- language ---------------------------------------------------------------------------------


def test_language(spark, odd, empty):
    syllables = {"en": ["the", "ing", "and"], "de": ["sch", "ung", "der"], "fr": ["eau", "que", "é"]}
    rng = random.Random(2)
    rows = [
        (i, " ".join(rng.choice(s) + rng.choice(s) for _ in range(40)), lang, "a", 0)
        for i, (lang, s) in enumerate(itertools.islice(itertools.cycle(syllables.items()), 240))
    ]
    docs = spark.createDataFrame(rows, DOC)
    model = language.fit(docs)
    assert sorted(model.languages) == ["de", "en", "fr"]
    named = language.identify(docs.withColumn("held_out", language.held_out()), model).collect()
    held = [r for r in named if r["held_out"]]
    assert 20 < len(held) < 90 and all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in held)
    assert all(r["lang_pred"] == r["lang"] and 0 <= r["score"] <= 1 for r in held)
    strange = language.identify(clashing(odd, "score", "lang_pred"), model).collect()
    unknown = [r["text"] for r in strange if r["lang_pred"] == "und"]
    assert sorted(unknown, key=repr) == sorted([None, "", " \n\t ", "1234 !!"], key=repr)
    assert language.identify(empty, model).collect() == []
    assert language.fit(empty).languages == []
    nothing = language.identify(docs, language.fit(empty)).select("lang_pred").distinct().collect()
    assert [r[0] for r in nothing] == ["und"]
    assert language.keep_identified(odd, model).columns == odd.columns


def test_more_languages_than_a_mask_word_has_bits(spark):
    rng, letters = random.Random(3), "abcdefghijklmnopqrstuvwxyz"
    syllables = {f"l{k:02}": ["".join(rng.choices(letters, k=4)) for _ in range(6)] for k in range(70)}
    rows = [
        (i, " ".join(rng.choice(s) + rng.choice(s) for _ in range(30)), lang, "a", 0)
        for i, (lang, s) in enumerate(itertools.islice(itertools.cycle(syllables.items()), 70 * 12))
    ]
    docs = spark.createDataFrame(rows, DOC)
    model = language.fit(docs)
    assert sorted(model.languages) == sorted(syllables) and model.masks.shape == (2, 1 << language.SLOT_BITS)
    named = language.identify(docs.filter(language.held_out()), model).collect()
    assert {model.languages.index(r["lang"]) for r in named} & set(range(64, 70))
    assert all(r["lang_pred"] == r["lang"] and r["coverage"] > 0.9 for r in named)


def test_filters_return_all_languages_of_a_trigram():
    model = language.Model(["a", "b"], np.zeros(1 << language.SLOT_BITS, np.uint8))
    for bit, word in ((1, "shared"), (2, "shared"), (2, "other")):
        for slot in language.slots(language.trigrams([word])[0]):
            model.masks[slot] |= bit
    evidence, total = model.evidence(["shared", "other", "", "7", "\U0001d49c"])
    assert total.tolist() == [6, 5, 0, 0, 1]
    assert np.allclose(evidence[:3], [[6, 6], [0, 5], [0, 0]], atol=1e-3)


# --- pieces -----------------------------------------------------------------------------------


def brute_segmentations(v, text):
    marked, found = text.replace(" ", pieces.MARK), []

    def walk(at, score, ids):
        if at == len(text):
            found.append((score, tuple(ids)))
            return
        for end in range(at + 1, len(text) + 1):
            if (k := v.ids.get(marked[at:end])) is not None and pieces.MARK not in text[at:end]:
                walk(end, score + float(v.score[k]), [*ids, k])
        if marked[at] not in v.ids or text[at] == pieces.MARK:
            walk(at + 1, score + v.unknown, [*ids, *v.spelled(text[at])])

    walk(0, 0.0, [])
    return sorted(found, key=lambda x: -x[0])


def test_n_best_against_all_segmentations():
    v = pieces.vocabulary(pieces.MODEL)
    rng = random.Random(1)
    for _ in range(80):
        text = "".join(rng.choice("the anouéß\n☃ ing▁") for _ in range(rng.randint(1, 9)))
        encoded = next(pieces.Encoder(n=4).encode([text]))
        ids, others = encoded.ids.tolist(), encoded.others[0]
        want = brute_segmentations(v, " " + text)
        assert [encoded.score[0], *(s for s, _ in others)] == pytest.approx([s for s, _ in want[:4]])
        paths = {tuple(ids), *(tuple(pieces.edited(ids, e)) for _, e in others)}
        assert len(paths) == 1 + len(others) and paths <= {p for _, p in want}
        assert all(pieces.decode(v, p) == text for p in paths)


def test_encode(odd, empty):
    encoded = pieces.encode(clashing(odd, "ids", "score"))
    rows = encoded.collect()
    v = pieces.vocabulary(pieces.MODEL)
    assert len(rows) == len(ODD) and all(r["round_trip"] for r in rows)
    texts = sorted((pieces.decode(v, r["ids"]) for r in rows))
    assert texts == sorted(t or "" for _, t, *_ in ODD)
    assert pieces.encode(empty).collect() == []


# --- personal data ----------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    digits = [int(c) for c in value if c.isdigit()]
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        even = sum(digits[-1::-2]) + sum(sum(divmod(2 * d, 10)) for d in digits[-2::-2])
        return 12 <= len(digits) <= 19 and even % 10 == 0
    return True


def test_plain_spans_match_the_patterns():
    rng = random.Random(2)
    for _ in range(20_000):
        text = "".join(rng.choice("a.@1-2 +(5") for _ in range(rng.randint(0, 40)))
        want = {k: [m.span() for m in re.finditer(p, text) if passes(k, m[0])] for k, p in PLAIN.items()}
        assert pii.plain_spans(text) == want


@pytest.mark.parametrize("text, kind, hidden", [
    ("mail john.doe [at] example [dot] com now", "email", "john.doe [at] example [dot] com"),
    ("so jane at mail dot example dot org.", "email", "jane at mail dot example dot org"),
    ("a.b (dot) c (at) d (dot) e", "email", "a.b (dot) c (at) d (dot) e"),
    ("аlice@exаmple.com x", "email", "аlice@exаmple.com"),
    ("at １９２.168.０.1 it", "ip", "１９２.168.０.1"),
    ("ip 10 dot 0 dot 0 dot 1.", "ip", "10 dot 0 dot 0 dot 1"),
    ("call plus four nine one seven one two three four five", "phone", "plus four nine one seven one two three four five"),
    ("card four" + " one" * 15 + " end", "card", "four" + " one" * 15),
    ("zero​width bob@exam​ple.com", "email", "bob@exam​ple.com"),
])
def test_disguises_map_back(text, kind, hidden):
    spans = [(k, text[s:e]) for k, s, e, plain in pii.find(text) if not plain]
    assert (kind, hidden) in spans


def test_no_disguise_no_span(odd, empty):
    for text in ("look at example.com at dot", "one two three go", "", None, "größer als drei", "m² 10³"):
        assert pii.find(text) == []
    found = pii.detect(clashing(odd, "spans")).collect()
    assert len(found) == len(ODD) and not any(r["spans"] for r in found)
    assert pii.detect(empty).collect() == []
    assert pii.find("9" * 100_000 + "@" * 1000 + "a" * 100_000) == []


# --- pages ------------------------------------------------------------------------------------

PAGE = """<html><head><title>t</title></head><body class="has-sidebar"><header><h2>Site</h2></header>
<nav><a href=x>Menu</a></nav><div id="cookie-notice">We use cookies</div><div class="wrap"><div class="post-{n} entry">
<h1>Title &amp; more</h1><p>First   para <a href="#">link</a> text, long enough &eacute; to count {n}.<p>Second para.
<script>var x = "</p>";</script><ul><li>one<li>two</ul><form>mail <input></form><div class="related"><a>x</a></div></div>
<div class="sidebar">side</div><div class="comments"><p>nice post, a long comment on the post by a reader {n}</div></div>
<footer>&copy; f</footer></body>"""
BODY = "Title & more\n\nFirst para link text, long enough é to count {n}.\n\nSecond para.\n\none\n\ntwo"


def test_pages(spark):
    rows = [(n, f"https://Host.example/{n}", PAGE.format(n=n)) for n in range(5)]
    # On a page whose comment outweighs its article, the host's other pages decide.
    loud = PAGE.format(n=7).replace('<div class="comments">', '<div class="talk">').replace("nice post", "nice post " * 40)
    rows += [(7, "http://host.example:80/7", loud), (8, None, None), (9, "x", ""), (10, "http://h2/", "<p>alone"), (0, rows[0][1], rows[0][2])]
    df = clashing(spark.createDataFrame(rows, "page_id int, url string, html string"), "text")
    found = {(r["page_id"], r["text"]) for r in html.main_text(df).collect()}
    assert found == {(n, BODY.format(n=n)) for n in (0, 1, 2, 3, 4, 7)} | {(8, ""), (9, ""), (10, "alone")}
    assert html.main_text(df).count() == len(rows)
    assert html.main_text(df.limit(0)).collect() == []


@pytest.mark.parametrize("markup, text", [
    ("<", "<"), ("<p", ""), ("just text", "just text"), ("<b>t</b><script>no", "t"), ("a<br>b", "a b"),
    ("<table><tr><td>a<td>b</table>", "a\n\nb"), ("<p>x</div></p>y", "x\n\ny"), ("<!-- <p>no</p> -->yes", "yes"),
])
def test_broken_markup(markup, text):
    assert html.extract(html.parse(markup), []) == text


LONG = "A long paragraph of the article. " * 20


@pytest.mark.parametrize("markup, text", [
    ("<body><article><h1>T</h1><p>Standfirst.<div class=body><p>{0}</div></article>", "T\n\nStandfirst.\n\n{0}"),
    ("<body><div class=post><h1><a href=x>T</a></h1><div class=body><p>{0}</div></div>", "T\n\n{0}"),
    ("<body><div class=head><h1>T</h1></div><div class=lead>Lead.</div><div class=body><p>{0}</div>", "T\n\nLead.\n\n{0}"),
    ("<body><article><section>{0}</section><section class=b>Two.</section></article>", "{0}\n\nTwo."),
    ("<body><div class=x><div class=part1>{0}</div><div class=part2>Two.</div></div>", "{0}\n\nTwo."),
    ("<body><article class=a>{0}</article><article class=a>Two.</article>", "{0}\n\nTwo."),
    ("<body><div class=x><div class=body>{0}</div><div class=more><a>Other page</a></div></div><div>Tagline</div>", "{0}"),
])
def test_text_around_the_best_container(markup, text):
    page = html.parse(markup.format(LONG))
    assert html.extract(page, []) == text.format(LONG.strip())
    assert html.extract(page, [page.containers[page.best()].path]) == text.format(LONG.strip())


@pytest.mark.parametrize("markup, text", [
    ("<div class=has-sidebar><p>{0}</div>", "{0}"), ("<div class='with-header no-sidebar ad-free'>{0}</div>", "{0}"),
    ("<div><p>{0}<h2 id='related-work'>Work</h2><p class='notice'>N.<section id='social-impact'>S.</section></div>",
     "{0}\n\nWork\n\nN.\n\nS."),
    ("<div style='overflow:hidden' data-id=ad title='hidden gem' aria-hidden='false'>{0}</div>", "{0}"),
    ("<div>{0}<div aria-hidden=true>a</div><div hidden>b</div><p hidden>c</p></div>", "{0}"),
    ("<div>{0}<div class=sidebar>a</div><div id=site-footer>b</div><div class='ad-slot'>c</div></div>", "{0}"),
    ("<body><form id=aspnetForm><div class=x>{0}</div><div class=nav>a</div></form><footer>f</footer>", "{0}"),
    ("<body><div class=widget><form><div class=x>{0}</div></form></div><nav>n</nav>", "{0}"),
    ("<body><div class=x>Short.</div><div class=comments>{0}</div><footer>{0}</footer>", "Short."),
    ("<body><article>Short.</article><div class=ad>{0}</div>", "Short."),
    ("<body><div class=x>Short.</div><div hidden><form>{0}</form></div>", "Short."),
])
def test_furniture_by_name(markup, text):
    assert html.extract(html.parse(markup.format(LONG)), []) == text.format(LONG.strip())


@pytest.mark.parametrize("markup, text", [
    ("<svg class=i viewBox='0 0 1 1'/><p>{0}<p>b<svg><title>i</title><text>no</text></svg>", "{0}\n\nb"),
    ("<div><button class=menu>Menu</div><article>{0}</article>", "{0}"),
    ("<button>Menu<article>{0}</article><p>b<button>no</button> c", "{0}\n\nb c"),
    ("<div><svg><path d='M0'></div><p>{0}</p>y<svg><p>z", "{0}\n\ny\n\nz"),
    ("<p>a <svg><foreignObject><div>no</div></foreignObject></svg>b</p>{0}", "a b\n\n{0}"),
    ("<p>a <button><div>no</div><p>no</button>b</p><p>{0}", "a b\n\n{0}"),
    ("<div><select><option>no</div><div><object data=x>no</div><div>{0}</div>", "{0}"),
    ("<p>a<textarea>no <p>no</textarea><p>{0}<iframe src=x /><p>b<iframe>", "a\n\n{0}\n\nb"),
    ("<p>{0}<template><p>no</template><noscript>no</noscript><math><mi>x</math> end", "{0} end"),
])
def test_skipped_elements_end_with_what_holds_them(markup, text):
    assert html.extract(html.parse(markup.format(LONG)), []) == text.format(LONG.strip())


# --- quality ----------------------------------------------------------------------------------


def brute_statistics(text):
    words = WORDS.findall(text or "")
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    covered = {p for i, w in enumerate(windows) if often[w] > 1 for p in (i, i + 1, i + 2)}
    full = [x for x in (text or "").split("\n") if WORDS.search(x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(full) - len(set(full)), len(covered)


def test_quality(spark, odd, empty):
    rng = random.Random(8)
    rows = list(ODD)
    for i in range(100, 300):
        words = [f"w{rng.randrange(10 ** 6)}" for _ in range(rng.randint(60, 200))]
        junk = i % 20 == 0
        rows.append((i, " ".join(w + "###" if junk else w for w in words), "en", "a" if i % 2 else "b", 0))
    rows.append((400, "a b c d\na b c d\n\n \nz a b c" + " u" * 60, "en", "lonely", 0))
    judged = quality.judge(spark.createDataFrame(rows, DOC)).collect()
    texts = defaultdict(list)
    for i, t, *_ in rows:
        texts[i].append(t)
    assert len(judged) == len(rows)
    for r in judged:
        n = brute_statistics(texts[r["doc_id"]][0])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == n
        assert r["base_failed"] == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        if r["doc_id"] and 100 <= r["doc_id"] < 300:
            assert r["kept"] == (r["doc_id"] % 20 != 0)
        assert not (r["kept"] and r["base_failed"])
    assert quality.judge(empty).collect() == []


def test_quality_finds_junk_that_is_two_fifths_of_a_source(spark):
    rng = random.Random(9)
    rows = []
    for i in range(600):
        words = [f"w{rng.randrange(10 ** 6)}" for _ in range(rng.randint(60, 200))]
        junk = i % 5 < 2 and i < 400
        rows.append((i, " ".join(w + "###" if junk else w for w in words), "en", "hot" if i < 400 else "b", 0))
    judged = quality.judge(spark.createDataFrame(rows, DOC)).collect()
    assert len(judged) == 600 and all(r["kept"] == (r["doc_id"] >= 400 or r["doc_id"] % 5 >= 2) for r in judged)


# --- search -----------------------------------------------------------------------------------


def test_search_is_exact(spark):
    rng = random.Random(6)
    near = rng.getrandbits(64)
    codes = [near] * 30 + [near ^ (1 << rng.randrange(64)) for _ in range(60)] + [rng.getrandbits(64) for _ in range(120)]
    rows = [(i, c - (1 << 64) if c >= 1 << 63 else c) for i, c in enumerate(codes)]
    df = spark.createDataFrame([*rows, rows[3], (None, 5), (900, None)], "id bigint, code bigint")
    found = got(hamming.top_k(df, df.filter("id % 20 = 0"), k=5), "query_id", "rank", "neighbor_id", "distance")
    want = []
    for q in range(0, len(codes), 20):
        order = sorted((bin(codes[q] ^ c).count("1"), i) for i, c in enumerate(codes) if i != q)[:5]
        want += [(q, n, i, d) for n, (d, i) in enumerate(order, 1)]
    assert found == sorted(want, key=repr)
    few = df.limit(2)
    assert hamming.top_k(few, few, k=5).count() <= 2
    assert hamming.top_k(df.limit(0), df.limit(0)).collect() == []


def test_sign_code(spark):
    vector = [1.0, -1.0, None, 2.0] + [0.0] * 60 + [-5.0]
    df = spark.createDataFrame([(vector,), (None,), ([],)], "v array<double>")
    assert [r[0] for r in df.select(hamming.sign_code("v")).collect()] == [8, None, 0]


# --- pipeline ---------------------------------------------------------------------------------


def test_pipeline_stages(spark, odd, tmp_path):
    folder = str(tmp_path)
    odd.write.parquet(f"{folder}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == odd.columns
    out = corpus_pipeline.run(spark, folder)
    assert out.count() > 0 and all(r["round_trip"] for r in out.collect())


def test_pipeline_on_an_empty_table(spark, empty, tmp_path):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_digest_of_kept_lines(spark, odd):
    row = lines.dedup_lines(odd).filter("doc_id = 2").select(F.sha2(F.col("text").cast("binary"), 256)).first()
    assert row[0] == hashlib.sha256(b"").hexdigest()
