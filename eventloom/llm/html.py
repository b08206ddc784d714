"""Main text of web pages by consensus host paths.

Each page's containers are scored by the text of the blocks in them, less link text, halving with
the distance between block and container. A container's path is its ancestors' tags and
classes with digits generalised. Spark counts, per host, the pages that each path wins and their
scores; every page is then extracted again at the host's winning paths, in rank order, and only a
page that has none of them falls back on its own best container. The halving favours the innermost
container, so from the containers found the extraction climbs and adds what belongs to them: the
ancestors' own text and sibling containers, unless they are mostly links.

The host's pages vote on furniture too, whatever its name: a container whose text stands word for word in
at least half of those pages that have its path, and in three with different main texts, goes; so do
containers that hold a list of like items, each with a short line that has a date or time, on as many pages.
A container that holds a page's best one is never furniture.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.common import stored

# What HTML calls these elements, and words that name page furniture.
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())  # end at their end tags only
CODE = frozenset("script style".split())  # without an end tag they take the rest of the page
SKIPPED = frozenset("button math noscript object select svg template".split())
EMPTY = frozenset("iframe math object svg template".split())  # "/>" closes these
FOREIGN_ROOTS = frozenset("math svg".split())
FOREIGN = "foreignobject"  # HTML inside svg
FURNITURE = frozenset("nav header footer aside form menu dialog".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
CONTAINERS = frozenset("article body div main section td".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
PLAIN = frozenset("html body main article".split())  # never furniture by class
FURNITURE_WORDS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer header login masthead menu modal nav navbar navigation newsletter notice notification overlay "
    "pagination popup promo promoted promotion related recommended respond share sharing sidebar signup social "
    "sponsor sponsored subscribe toolbar widget widgets".split()
)
# With one of the words above these make a compound name of furniture: "site-footer", "ad-slot".
ROLE_WORDS = frozenset(
    "area bar block bottom box col column container global inner left list main notice outer page primary right "
    "secondary section side site slot top unit wrap wrapper".split()
)
ARTICLE_WORDS = frozenset("comment comments promo sponsored related".split())
COMMENT_WORDS = frozenset("comment comments consent cookie cookies disqus respond".split())  # not spared, however long
TEXTS = frozenset("h1 h2 h3 h4 h5 h6 p".split())  # furniture only if hidden
CLOSES = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dd", ("dl",)), "dd": ("dt", ("dl",)),
          "tr": ("tr", ("table",)), "td": ("td", ("tr", "table")), "th": ("th", ("tr", "table"))}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^\"'<>]|\"[^\"]*\"|'[^']*')*+)(?:/?>|(?=<)|\Z)"
    r"|</?[a-zA-Z][^<>]*(?:>|(?=<)|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAMES = frozenset("class id role hidden aria-hidden style".split())
_UNSEEN = re.compile(r"(?i)(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b")
# A year, a time of day, or a count of units ago.
_DATED = re.compile(r"(?i)\b(?:19|20)[0-9]{2}\b|\b[0-9]{1,2}[:.][0-9]{2}\b|\b[0-9]+ [a-z]+ ago\b|\b(?:vor|il y a|hace) [0-9]+ ")
SHORT = 80  # characters of a line that tells who and when
_PRIME, _BASE = (1 << 61) - 1, 0x1F3A5C7D9B2E4 | 1
VOTERS = 3  # pages with different main texts that must agree on furniture
_END = {tag: re.compile(rf"(?i)</{tag}\b[^>]*(?:>|\Z)") for tag in RAW}
_OPEN = {tag: re.compile(rf"(?i)<(/?){tag}\b") for tag in SKIPPED}
_SPACE = re.compile(r"\s+")
_PARTS = re.compile(r"[^a-z]+")
_NUMBER = re.compile(r"[0-9]+")
LINKED = 2.0  # a character of link text takes away as much as two others give
DECAY = 0.5
BONUS = {"article": 1.5, "main": 1.25}
BESIDE = 0.2  # a container directly in the body counts beside one of at most five times its text


@dataclass(slots=True)
class Container:
    """``path`` is a hash of the steps (tag and classes) from the body down, so deep nesting costs no more."""

    path: str
    own: str
    parent: int
    tag: str
    first: int = 0  # the number of blocks before it
    score: float = 0.0

    def step(self) -> str:
        return self.own

    def below(self, step: str) -> str:
        return xxhash.xxh3_64_hexdigest(f"{self.path}/{step}")


@dataclass
class Block:
    container: int
    text: str
    linked: float  # characters of link text
    title: bool  # stands in an h1

    def unlinked(self) -> float:
        return len(self.text) - self.linked


@dataclass
class Page:
    """Containers and text blocks in page order. A container's descendants follow it directly."""

    containers: list[Container] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)

    def best(self) -> int:
        return max(range(len(self.containers)), key=lambda k: (self.containers[k].score, -k), default=-1)

    def ends(self) -> list[int]:
        """For every container the number after its last descendant."""
        end = [k + 1 for k in range(len(self.containers))]
        for k in range(len(end) - 1, 0, -1):
            above = self.containers[k].parent
            end[above] = max(end[above], end[k])
        return end

    def hashes(self) -> list[int]:
        """A hash of every container's whole text, 0 where it has none; linear in containers and blocks."""
        inside = [0] * len(self.containers)  # blocks
        for block in self.blocks:
            inside[block.container] += 1
        for k in range(len(inside) - 1, 0, -1):
            inside[self.containers[k].parent] += inside[k]
        so_far, power = [0], [1]
        for block in self.blocks:
            so_far.append((so_far[-1] * _BASE + xxhash.xxh3_64_intdigest(block.text)) % _PRIME)
            power.append(power[-1] * _BASE % _PRIME)
        return [
            (so_far[c.first + n] - so_far[c.first] * power[n]) % _PRIME or 1 if n else 0
            for c, n in zip(self.containers, inside)
        ]

    def lists(self) -> set[int]:
        """Containers whose child containers are at least two of one step, each with a short line that has a
        date or time: lists of comments, of teasers and the like."""
        dated = [False] * len(self.containers)
        for block in self.blocks:
            if len(block.text) <= SHORT and _DATED.search(block.text):
                at = block.container
                while at >= 0 and not dated[at]:
                    dated[at] = True
                    at = self.containers[at].parent
        steps: dict[int, list[str]] = {}
        undated = set()
        for k, c in enumerate(self.containers):
            if c.parent >= 0:
                steps.setdefault(c.parent, []).append(c.own)
                if not dated[k]:
                    undated.add(c.parent)
        return {k for k, below in steps.items() if len(below) > 1 and len(set(below)) == 1 and k not in undated}

    def around_best(self) -> set[int]:
        found, at = set(), self.best()
        while at >= 0:
            found.add(at)
            at = self.containers[at].parent
        return found

    def gone(self, furniture: set[str]) -> bytearray:
        """Marks the containers that the host's votes (``path`` or ``path:hash``) take for furniture."""
        end, hashes, keep = self.ends(), self.hashes(), self.around_best()
        marks = bytearray(len(self.containers))
        lists = self.lists()
        for k, c in enumerate(self.containers):
            if k not in keep and (f"{c.path}:{hashes[k]}" in furniture or k in lists and c.path in furniture):
                marks[k:end[k]] = b"\x01" * (end[k] - k)
        return marks

    def text(self, seeds: list[int], gone: bytearray | None = None) -> str:
        """The text of the containers ``seeds`` and of what belongs to them, without the marked ones.

        At every ancestor its own blocks belong, and the sibling containers, unless they are mostly
        links. A sibling outside articles and main parts that outweighs all taken so far is another
        part of the page, if it has other classes. Directly in the body a sibling must be like the
        container beside it, hold the title, stand between the title and the rest, or have a
        fifth of the text.
        """
        n = len(self.containers)
        end = self.ends()
        gone = gone or bytearray(n)
        unlinked, linked, titles = [0.0] * n, [0.0] * n, [0] * n
        within = [False] * n  # in an article or main part
        own: list[list[int]] = [[] for _ in range(n)]
        below: list[list[int]] = [[] for _ in range(n)]
        for i, block in enumerate(self.blocks):
            if gone[block.container]:
                continue
            own[block.container].append(i)
            unlinked[block.container] += block.unlinked()
            linked[block.container] += block.linked
            titles[block.container] += block.title
        for k, container in enumerate(self.containers):
            within[k] = container.tag in ("article", "main") or (container.parent >= 0 and within[container.parent])
            if container.parent >= 0:
                below[container.parent].append(k)
        for k in range(n - 1, 0, -1):
            above = self.containers[k].parent
            unlinked[above] += unlinked[k]
            linked[above] += linked[k]
            titles[above] += titles[k]

        taken, single, climbed = bytearray(n), set(), set()

        def take(k: int):
            taken[k:end[k]] = b"\x01" * (end[k] - k)

        for seed in seeds:
            take(seed)
        core, titled = sum(unlinked[k] for k in seeds), any(titles[k] for k in seeds)
        for at in seeds:
            above = self.containers[at].parent
            while above >= 0 and above not in climbed and not taken[above]:
                climbed.add(above)
                here = self.containers[at]
                heads = [i for i in own[above] if self.blocks[i].title]
                heads += [self.containers[k].first for k in below[above] if titles[k] and k != at]
                head = min(heads, default=len(self.blocks)) if not titled else len(self.blocks)
                single.update(i for i in own[above] if self.blocks[i].title or self.blocks[i].unlinked() > self.blocks[i].linked)
                more = sum(self.blocks[i].unlinked() for i in own[above])
                for k in below[above]:
                    if taken[k] or k == at:
                        continue
                    other = self.containers[k]
                    if other.first == head and titles[k]:
                        belongs = True
                    elif unlinked[k] <= linked[k]:
                        belongs = False
                    elif other.step() == here.step() or within[above] or head <= other.first < here.first:
                        belongs = True
                    elif self.containers[above].tag == "body":
                        belongs = core * BESIDE <= unlinked[k] <= core
                    else:
                        belongs = unlinked[k] <= core
                    if belongs:
                        take(k)
                        more += unlinked[k]
                core, titled = core + more, titled or bool(heads)
                at, above = above, self.containers[above].parent
        return "\n\n".join(b.text for i, b in enumerate(self.blocks) if not gone[b.container] and (taken[b.container] or i in single))


def _names(attrs: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attrs):
        name = m[1].lower()
        if name in NAMES and name not in found:  # the first of repeated attributes counts
            found[name] = unescape(m[2] or m[3] or m[4] or "")
    return found


def _is_hidden(names: dict[str, str]) -> bool:
    unseen = "style" in names and _UNSEEN.search(names["style"])
    return "hidden" in names or names.get("aria-hidden", "").strip().lower() == "true" or bool(unseen)


def _named(names: dict[str, str], words: frozenset[str]) -> bool:
    """Whether a class or id is one of the words, or put together from them and role words alone."""
    for name in f"{names.get('class', '')} {names.get('id', '')}".lower().split():
        parts = [x for x in _PARTS.split(name) if x]
        if any(x in words for x in parts) and all(x in words or x in FURNITURE_WORDS or x in ROLE_WORDS for x in parts):
            return True
    return False


def _is_furniture(tag: str, names: dict[str, str]) -> bool:
    if tag in FURNITURE:
        return True
    if tag in PLAIN and tag != "article" or not names:
        return False
    if tag in TEXTS:
        return False
    if names.get("role", "").lower() in ("navigation", "banner", "contentinfo", "complementary", "search"):
        return True
    if tag == "article":  # a reader's comment may be an article, a heading's class is none
        return _named(names, ARTICLE_WORDS)
    return _named(names, FURNITURE_WORDS)


def _may_be_spared(tag: str, names: dict[str, str]) -> bool:
    return tag == "form" or tag not in FURNITURE and not _named(names, COMMENT_WORDS)


def _step(tag: str, names: dict[str, str]) -> str:
    classes = sorted(set(_NUMBER.sub("#", names.get("class", "")).split()))
    return ".".join([tag, *classes])


def parse(html: str | None) -> Page:
    """Blocks outside page furniture and the containers around them, from markup that may be cut
    off or wrongly nested. A form that holds most of the page's unlinked text is no furniture, nor
    is a container that is furniture by its names, if no article or main part stands outside."""
    page, most = _parse(html or "", {})
    if any(c.tag in BONUS and c.score > 0 for c in page.containers):
        most = {place: tag for place, tag in most.items() if tag == "form"}
    return _parse(html or "", most)[0] if most else page


def _parse(html: str, spared: dict[int, str]) -> tuple[Page, dict[int, str]]:
    """The page, and where the furniture begins that holds most of the unlinked text and may be
    spared, with its tag.

    Furniture that begins at a place in ``spared`` is taken as an ordinary element."""
    page = Page([Container("", "", -1, "body")])
    stack: list[tuple[str, int, int]] = []  # tag, container, furniture depth
    seen = 0  # characters of unlinked text so far, of hidden elements too
    dark = 0  # those that no sparing brings back
    open_furniture: list[tuple[int, int, str, int, int]] = []  # stack depth, place, tag, seen and dark before
    breaks: list[int] = []  # stack depths of skipped elements that a block ends
    endless: set[str] = set()  # tags without an end tag in the rest of the page
    held: list[tuple[int, str, int]] = []  # place, tag and unlinked text of furniture that may be spared
    here, skip, links = 0, 0, 0
    parts: list[str] = []
    linked = plain = 0

    def flush():
        nonlocal linked, plain
        text = _SPACE.sub(" ", unescape("".join(parts))).strip() if parts else ""
        parts.clear()
        if text:
            part = linked / max(1, linked + plain)
            page.blocks.append(Block(here, text, len(text) * part, any(above[0] == "h1" for above in stack[-3:])))
            worth = max(0.0, len(text) * (1 - LINKED * part))
            at, part = here, 1.0
            while at >= 0 and worth:
                page.containers[at].score += worth * part * BONUS.get(page.containers[at].tag, 1.0)
                at, part = page.containers[at].parent, part * DECAY
        linked = plain = 0

    def leave():
        nonlocal dark
        _, place, tag, seen_before, dark_before = open_furniture.pop()
        if place >= 0:
            held.append((place, tag, seen - seen_before - (dark - dark_before)))
        else:
            dark = dark_before + seen - seen_before

    def pop(depth: int):
        nonlocal here, skip
        if stack[depth][0] not in SKIPPED and stack[depth][2] == 0:
            flush()  # also where it ends a skipped element in it
        _, here, skip = stack[depth]
        del stack[depth:]
        while open_furniture and open_furniture[-1][0] >= depth:
            leave()
        while breaks and breaks[-1] >= depth:
            breaks.pop()

    at, size = 0, len(html)
    while at < size:
        token = _TOKEN.search(html, at)
        end = token.start() if token else size
        if end > at and not links:
            seen += len(html[at:end].strip())
        if end > at and not skip:
            parts.append(html[at:end])
            if links:
                linked += end - at
            else:
                plain += end - at
        if not token:
            break
        at = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        if token["close"]:
            if tag == "a":
                links = 0
            if tag in SKIPPED or tag == FOREIGN:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == tag:
                        pop(depth)
                        break
            if tag in BLOCKS:
                if not skip:
                    flush()
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == tag:
                        pop(depth)
                        break
            continue
        if tag in EMPTY and token[0].endswith("/>"):
            parts.append(" ")
            continue
        if tag in RAW:
            close = None if tag in endless else _END[tag].search(html, at)
            if close:
                at = close.end()
            elif tag in CODE:
                at = size
            else:  # without an end tag, its text is the page's
                endless.add(tag)
            parts.append(" ")
            continue
        if tag in SKIPPED or tag == FOREIGN and skip:
            # One that is not closed before the next of its kind, and svg, ends where a block begins.
            again = _OPEN[tag].search(html, at) if tag in _OPEN and tag not in FOREIGN_ROOTS and tag not in endless else None
            if not again and tag in _OPEN and tag not in FOREIGN_ROOTS:
                endless.add(tag)
            loose = tag in FOREIGN_ROOTS or tag in _OPEN and not (again and again[1])
            parts.append(" ")
            stack.append((tag, here, skip))
            open_furniture.append((len(stack) - 1, -1, tag, seen, dark))
            skip += 1
            if loose:
                breaks.append(len(stack) - 1)
            continue
        if tag == "br":
            parts.append(" ")
        if tag == "a":
            links = 1
        if tag not in BLOCKS:
            continue
        while breaks and breaks[-1] == len(stack) - 1:
            pop(breaks[-1])
        if not skip:
            flush()
        links = 0
        # A new block ends an open paragraph; items and cells end the one before.
        for depth in range(len(stack) - 1, -1, -1):
            above = stack[depth][0]
            if above == "p":
                pop(depth)
                break
            if above in CONTAINERS or above in FURNITURE or above in SKIPPED:
                break
        if tag in CLOSES:
            other, within = CLOSES[tag]
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in (tag, other):
                    pop(depth)
                    break
                if stack[depth][0] in within:
                    break
        if tag in VOID:
            continue
        names = _names(token["attrs"] or "")
        stack.append((tag, here, skip))
        hidden = _is_hidden(names) and (tag not in PLAIN or tag == "article")
        furniture = hidden or token.start() not in spared and _is_furniture(tag, names)
        if furniture:
            may = not hidden and _may_be_spared(tag, names)
            open_furniture.append((len(stack) - 1, token.start() if may else -1, tag, seen, dark))
        if skip or furniture:
            skip += 1
        elif tag in CONTAINERS:
            parent = page.containers[here]
            step = _step(tag, names)
            page.containers.append(Container(parent.below(step), step, here, tag, len(page.blocks)))
            here = len(page.containers) - 1
    flush()
    while open_furniture:
        leave()
    return page, {place: tag for place, tag, n in held if 2 * n > seen - dark}


def extract(page: Page, paths: list[str], furniture: list[str] | None = None) -> str:
    """The text at the first of the paths that the page has, else of its own best container."""
    gone = page.gone(set(furniture)) if furniture else bytearray(len(page.containers))
    for path in paths:
        found = [k for k, c in enumerate(page.containers) if c.path == path and c.score > 0 and not gone[k]]
        if found:
            return page.text(found, gone)
    best = page.best()
    return page.text([best], gone) if best >= 0 else ""


def _host():
    return F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)", 1)), F.lit(""))


def _votes(pages: DataFrame) -> DataFrame:
    """``host, kind, path, hash, main, score``: each page's vote for its best container (``best``), the
    containers it has (``has``), their texts (``text``) and its lists of dated items (``list``).

    ``main`` is the hash of the page's main text: copies of a page are one voter on furniture.
    """

    def vote(batches):
        for batch in batches:
            rows: list[tuple] = []
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                page = parse(html)
                best = page.best()
                if best < 0 or page.containers[best].score <= 0:
                    continue
                hashes, keep, lists = page.hashes(), page.around_best(), page.lists()
                main = hashes[best]
                rows.append((host, "best", page.containers[best].path, 0, main, page.containers[best].score))
                seen = set()
                for k, c in enumerate(page.containers):
                    if k in keep or not hashes[k]:
                        continue
                    seen |= {("has", c.path, 0), ("text", c.path, hashes[k])}
                    if k in lists:
                        seen.add(("list", c.path, 0))
                rows += [(host, kind, path, h, main, 0.0) for kind, path, h in sorted(seen)]
            columns = list(zip(*rows)) if rows else [[]] * 6
            types = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["host", "kind", "path", "hash", "main", "score"]
            )

    return pages.select(_host().alias("host"), "html").mapInArrow(
        vote, "host string, kind string, path string, hash long, main long, score double"
    )


def host_paths(pages: DataFrame, ranks: int = 3) -> DataFrame:
    """``host, paths, furniture``: the paths that most of a host's pages vote for, best first, and the
    containers (``path`` of lists, ``path:hash`` of texts) that at least half of the pages with that path, and
    ``VOTERS`` of them, have in common. Pages with one main text are one voter on furniture."""
    votes = stored(_votes(pages), "page-votes")
    counted = votes.filter("kind = 'best'").groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("host").orderBy(F.desc("n"), F.desc(F.round("score", 3)), "path"))
    top = counted.withColumn("rank", rank).filter(F.col("rank") <= ranks)
    paths = top.groupBy("host").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "path"))), lambda x: x["path"]).alias("paths")
    )
    voters = votes.filter("kind <> 'best'").select("host", "kind", "path", "hash", "main").distinct()
    agreed = voters.groupBy("host", "kind", "path", "hash").agg(F.count(F.lit(1)).alias("n"))
    having = agreed.filter("kind = 'has'").select("host", "path", F.col("n").alias("pages"))
    common = agreed.filter((F.col("kind") != "has") & (F.col("n") >= VOTERS)).join(having, ["host", "path"])
    name = F.when(F.col("kind") == "list", F.col("path")).otherwise(F.concat_ws(":", "path", "hash"))
    # At most two texts of a path can stand on half of its pages each, so the list has the size of a page.
    furniture = common.filter(F.col("n") * 2 >= F.col("pages")).groupBy("host").agg(F.sort_array(F.collect_set(name)).alias("furniture"))
    return paths.join(furniture, "host", "left")


def main_text(pages: DataFrame) -> DataFrame:
    """``pages`` without ``html`` but with ``text``: the main text's blocks joined by empty lines.

    A null or empty page, and one without text outside page furniture, gives an empty text; a null
    url belongs to the host without a name. Rows are independent but for the votes, in which
    repeated pages count as often as they stand. Other columns travel along; a column named
    ``text`` is replaced. An empty table gives an empty result.
    """
    winners = stored(host_paths(pages), "host-paths").withColumnsRenamed(
        {"host": "_loom_host", "paths": "_loom_paths", "furniture": "_loom_furniture"}
    )
    kept = [c for c in pages.columns if c not in ("html", "text")]
    with_paths = pages.withColumn("_loom_host", _host()).join(winners, "_loom_host", "left")

    def run(batches):
        for batch in batches:
            n = batch.num_columns
            texts = [
                extract(parse(html), paths or [], furniture)
                for html, paths, furniture in zip(*(batch.column(k).to_pylist() for k in (n - 3, n - 2, n - 1)))
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-3], pa.array(texts, pa.string())], [*kept, "text"])

    schema = T.StructType([*pages.select(*kept).schema.fields, T.StructField("text", T.StringType())])
    return with_paths.select(*kept, "html", "_loom_paths", "_loom_furniture").mapInArrow(run, schema)
