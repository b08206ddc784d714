"""Page furniture by the votes of a host's pages, whatever its names; hidden elements; deep nesting."""

import random
import tracemalloc

import pytest
from pyspark.sql import functions as F

from eventloom.llm import html

WORDS = "river stone window garden letter morning winter paper silver orange planet copper violin shadow harbor meadow".split()


def prose(rng, n):
    return " ".join(rng.choices(WORDS, k=n)).capitalize() + "."


def page(rng, furniture, number):
    title, paragraphs = prose(rng, 5), [prose(rng, 30) for _ in range(rng.randint(2, 5))]
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    markup = (
        f"<html><body><div class=wrap><nav><a href=/>home</a></nav><div class=story><h1>{title}</h1>"
        f"<div class=text>{body}</div></div>{furniture(rng, number)}</div></body></html>"
    )
    return markup, "\n\n".join([title, *paragraphs])


def block(name, text):
    return lambda rng, number: f"<div class='{name}'><p>{text}</p></div>"


def thread(name):
    def build(rng, number):
        items = "".join(
            f"<div class=entry><p>{rng.choice(WORDS).capitalize()} {rng.choice(WORDS)}, 3 May 20{rng.randint(10, 24)}</p><p>{prose(rng, 12)}</p></div>"
            for _ in range(rng.randint(2, 4))
        )
        return f"<div class='{name}'>{items}</div>"

    return build


CASES = {
    "cookie-banner-v2": block("cookie-banner-v2", "We use cookies to make this site better for every reader. Accept or decline."),
    "newsletter-signup-inline": block("newsletter-signup-inline", "Get our weekly letter with the best stories of the week."),
    "werbung": block("werbung", "Jetzt kaufen: die besten Angebote des Monats warten auf Sie."),
    "unnamed": block("x7", "Subscribe today and read everything that we write without limits."),
    "article-comments-thread": thread("article-comments-thread"),
    "post-comments-123": thread("post-comments-123"),
    "reader-discussion": thread("reader-discussion"),
    "kommentare": thread("kommentare"),
    "hidden": lambda rng, number: f"<div style='color:red; display:none'><p>{prose(rng, 40)}</p></div>",
    "invisible": lambda rng, number: f"<section style=\"visibility: hidden\"><p>{prose(rng, 40)}</p></section>",
}


def extracted(spark, pages):
    df = spark.createDataFrame([(i, f"https://h{i % 2}.example/{i}", h) for i, h in enumerate(pages)], "page_id bigint, url string, html string")
    return {r["page_id"]: r["text"] for r in html.main_text(df.repartition(3)).collect()}


def test_votes_name_furniture(spark):
    rng = random.Random(4)
    every, wanted = [], []
    for build in CASES.values():
        # Five pages on each of two hosts, whose furniture is of one kind.
        made = [page(rng, build, i) for i in range(10)]
        found = extracted(spark, [m for m, _ in made])
        every += [found[i] for i in range(10)]
        wanted += [text for _, text in made]
    assert every == wanted


def test_two_pages_are_no_consensus_and_copies_are_one_voter(spark):
    rng = random.Random(9)
    note = block("x7", "A remark of the author that belongs to this text and to its copies alone, as all may read.")
    one, _ = page(rng, note, 0)
    copies = extracted(spark, [one] * 12)
    assert all("A remark of the author" in t for t in copies.values())
    two = [page(rng, note, i)[0] for i in range(4)]  # two pages a host
    assert all("A remark of the author" in t for t in extracted(spark, two).values())


def test_sections_of_an_article_are_no_furniture(spark):
    rng = random.Random(5)

    def sectioned(i):
        parts = [(f"Part {k}", prose(rng, 40)) for k in range(3)]
        body = "".join(f"<section class=part><h2>{h}</h2><p>{p}</p></section>" for h, p in parts)
        return f"<html><body><main>{body}</main></body></html>", "\n\n".join(x for part in parts for x in part)

    made = [sectioned(i) for i in range(10)]
    found = extracted(spark, [m for m, _ in made])
    assert [found[i] for i in range(10)] == [t for _, t in made]


def test_generated_pages_against_an_independent_parser(spark):
    """The article, cut out of well-formed pages by the standard library's XML parser."""
    from xml.etree import ElementTree

    rng = random.Random(21)
    builders = list(CASES.values())
    pages = []
    for i in range(40):
        furniture = builders[i % 2](rng, i) + (builders[4](rng, i) if i % 4 < 2 else "")
        markup, _ = page(rng, lambda *_: furniture, i)
        pages.append(markup.replace("class=wrap", "class='wrap'").replace("class=story", "class='story'").replace("class=text", "class='text'").replace("class=entry", "class='entry'").replace("href=/", "href='/'"))
    found = extracted(spark, pages)
    for i, markup in enumerate(pages):
        story = next(e for e in ElementTree.fromstring(markup).iter("div") if e.get("class") == "story")
        assert found[i] == "\n\n".join(" ".join(x.text.split()) for x in story.iter() if x.tag in ("h1", "p"))


@pytest.mark.parametrize("levels", [20_000])
def test_memory_is_linear_in_nesting(levels):
    markup = "<div class='some-class another-class'>" * levels + f"<p>{'long text here ' * 40}</p>"
    tracemalloc.start()
    found = html.parse(markup)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found.containers) == levels + 1 and peak < 40_000_000
    assert html.extract(found, [found.containers[found.best()].path]).startswith("long text here")


def test_votes_of_odd_tables(spark):
    schema = "page_id bigint, url string, html string"
    odd = spark.createDataFrame([(1, None, None), (2, None, ""), (None, "x", "<p>a</p>"), (3, "http://a", "<div>" * 50)], schema)
    clashing = odd.withColumns({n: F.lit("mine") for n in ("host", "path", "furniture", "kind", "main", "score")})
    rows = html.main_text(clashing).collect()
    assert len(rows) == 4 and all(r["host"] == r["furniture"] == r["kind"] == "mine" for r in rows)
    assert html.main_text(odd.where("false")).collect() == []
