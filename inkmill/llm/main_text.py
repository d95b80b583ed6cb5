"""The main text of web pages, found by the consensus of the pages of a host.

1. Every page is read into its containers (body, main, article, section, div, table cell). A container's path is the sequence of tags and classes
   that leads to it, numbers in them left out; its score is the text in it, less the text that is mostly links, with a
   premium on what its tag or classes call an article. Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments count for nothing:
   they are told by tag, role, class and id, and lists of nothing but links are menus.
2. In Spark, pages and texts are counted by host and path. A path whose text hardly changes from page to page, while the pages do, is a notice or the like, and counts as such; what
   the tags call an article isn't.
3. Every page votes for the path of its best container, less those. The paths with at least WINNING of a host's votes win, and the one with the most does in any case.
4. Every page is read again: the text is that of the best of the winning paths that it has, less what hardly changes; of its own best container if it has none of them.

A block is what stands between the borders of block-level elements; a line break within one is white space. White space, also the non-breaking one, becomes
one space, character references are decoded as HTML 5 says, blocks without text are left out, the others are joined by line ends in page order. Nothing else
is dropped. Pages without a single container are read as if they were one.

Bounds: a host has at most 1 / WINNING winning paths and, as each page has a few, a bounded number of paths that hardly change; votes and texts by
path are summed within each task before they are sent. Votes are cast from a table of the containers' sizes, not from the pages. A page goes to Python with the lists of its host. Where the hosts' lists are small by
a count, they are broadcast; else pages are joined by host and one of SALTS numbers, so that a host with a third of all pages is dealt out.

Edge cases: null and empty html give the empty text; a page whose url has no host keeps to its own best container; a container without
text has no vote; repeated rows and ids are read each; an unclosed element ends with the one around it, an unclosed comment, script or tag with the page; pages of any length and
depth are read in one pass; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import map_in_arrow
from .common import small_side, staged, table

#: Of a host's votes, for a path to win.
WINNING = 0.2
#: A path's text hardly changes if it is on so many pages at least, on this share of the host's, and has a text for so many pages only.
REPEATED_PAGES, REPEATED_SHARE, PAGES_A_TEXT = 5, 0.2, 4
SALTS = 32
#: Of a page's text, and so many blocks, for an element to be the page's frame, whatever its class says.
FRAME, FRAME_BLOCKS = 0.8, 3

_MASK = (1 << 64) - 1
#: The path of the page itself, and the weight of what its tag calls an article.
ROOT, ARTICLE = xxhash.xxh3_64_intdigest("page"), 1.3

VOID = frozenset("area base br col embed hr img input link meta param source track wbr keygen frame basefont bgsound".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("body main article section div td center".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold no article text, wherever they stand.
DROPPED = frozenset("head nav footer aside form script style noscript template iframe svg object applet canvas audio video map button select textarea dialog menu search noembed noframes title xmp datalist".split())
#: What may stand in a head.
IN_HEAD = frozenset("meta link script style title base noscript template".split())
#: Elements that end where one of the same kind begins, and what they don't reach across.
CLOSED_BY = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
CLOSED_BY |= {x: ({"thead", "tbody", "tfoot"}, {"table"}) for x in ("thead", "tbody", "tfoot")} | {x: ({"option"}, {"select"}) for x in ("option", "optgroup")}
#: Words of classes, ids and roles that tell what isn't the article: always, or unless it holds most of the page.
NEVER = frozenset("comment comments commentlist disqus respond".split())
SELDOM = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot adsbygoogle adbox sponsor sponsored sponsors cookie cookies consent gdpr nav navbar navi navigation menu menus "
    "breadcrumb breadcrumbs sidebar sidebars aside complementary footer contentinfo masthead topbar toolbar banner banners promo promos promotion notice notices notification notifications alert alerts popup modal overlay newsletter subscribe subscription signup signin login share sharing social sociable related recommended recommendations replies widget "
    "widgets search pagination pager".split()
)
#: Before such a word, the next one tells what is not there or what the element goes round.
UNSAID = frozenset("no non not without has with hide show".split())
GOOD = frozenset("article articlebody body content entry main post story text".split())
#: Classes of the head of an article, which is kept as far as it is a heading.
OF_ARTICLE = frozenset("article content entry post story".split())

_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+)>""")
_COMMENT = re.compile(r"<!--(?:-?>|.*?--!?>)", re.DOTALL)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_NUMBER = re.compile(r"\d\d+")
_END = {x: re.compile(rf"</{x}(?=[\s/>])[^>]*>?", re.IGNORECASE) for x in RAW}


@dataclass
class _Drop:
    """An element that may not be part of the article."""

    kind: str  # hard: never is; soft: is if it holds nearly all of the page; head: its headings are; list: isn't if it is all links
    up: int
    in_article: bool = False
    chars: int = 0
    links: int = 0
    items: int = 0
    blocks: int = 0
    holds_main: bool = False
    gone: bool = False


@dataclass
class _Container:
    """Of its own text, without that of the containers in it: characters of text, of text that is mostly links, and the sum of its blocks' hashes."""

    path: int
    up: int
    weight: float
    good: int = 0
    junk: int = 0
    mark: int = 0


@dataclass
class Page:
    """What reading a page gives: containers in page order, the first being the page itself, and blocks (container, text)."""

    containers: list[_Container] = field(default_factory=list)
    blocks: list[tuple[int, str]] = field(default_factory=list)

    def totals(self, gone: frozenset[int] = frozenset()) -> list[list[int]]:
        """Of each container with all in it, but for containers at a path in gone: good, junk, mark."""
        out = [[c.good, c.junk, c.mark] for c in self.containers]
        for i in range(len(out) - 1, 0, -1):  # what is within comes later
            c = self.containers[i]
            if c.path in gone:
                out[i] = [0, 0, 0]
            up = out[c.up]
            up[0], up[1], up[2] = up[0] + out[i][0], up[1] + out[i][1], (up[2] + out[i][2]) & _MASK
        return out

    def scores(self, gone: frozenset[int] = frozenset()) -> dict[int, float]:
        """The score of each path with text: of all its containers together."""
        out: dict[int, float] = {}
        for c, (good, junk, _) in zip(self.containers, self.totals(gone)):
            if good or junk:
                out[c.path] = out.get(c.path, 0.0) + c.weight * good - junk
        return out

    def best(self, gone: frozenset[int] = frozenset()) -> int | None:
        """The path with the largest score, the innermost of equals; None for a page without text."""
        scores = self.scores(gone)
        return max(reversed(scores), key=scores.get) if scores else None

    def text(self, winning: list[int] = (), repeated: frozenset[int] = frozenset()) -> str:
        """The text at the best of the winning paths, without that at repeated ones, unless nothing else is left."""
        scores = self.scores(repeated)
        if not scores:
            scores, repeated = self.scores(), frozenset()
        had = [p for p in winning if p in scores]
        path = max(had, key=scores.get) if had else self.best(repeated)
        inside: list[bool] = []
        for c in self.containers:
            inside.append(c.path not in repeated and (c.path == path or (c.up >= 0 and inside[c.up])))
        return "\n".join(text for at, text in self.blocks if inside[at])


def _said(attributes: str) -> tuple[str, list[str], str]:
    """A label of an element's classes or id without numbers, the words of classes, id and role, and the role."""
    found = {}
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), a or b or c)
    label = ".".join(sorted(found.get("class", "").split())) or "#" + found.get("id", "")
    words = [w.lower() for x in ("class", "id", "role") for w in _WORD.findall(found.get(x, ""))]
    if found.get("itemprop", "").lower() == "articlebody":
        words.append("articlebody")
    return _NUMBER.sub("#", label), words, found.get("role", "").lower()


def _kind(tag: str, words: list[str], role: str, in_article: bool) -> str | None:
    """The kind of drop that an element is, if any."""
    if tag in DROPPED:
        return "hard"
    if tag == "header":
        return "head"
    told = [w for before, w in zip(["", *words], words) if before not in UNSAID]
    if tag in ("html", "body", "main") or (tag == "article" and not in_article and "comment" not in told) or role == "main":
        return None
    if not NEVER.isdisjoint(told):
        return "hard"
    if "header" in told:
        return "head" if not OF_ARTICLE.isdisjoint(told) else "soft"
    if not SELDOM.isdisjoint(told):
        return "soft"
    return "list" if tag in ("ul", "ol") else None


def read(html: str) -> Page:
    """A page's containers and blocks, in one pass."""
    page = Page([_Container(ROOT, -1, 0.9)])
    containers, drops = page.containers, []
    # open elements: tag, container, drop, whether in a link, in an article, in a heading
    stack: list[tuple[str, int, int, bool, bool, bool]] = [("", 0, -1, False, False, False)]
    opened: Counter[str] = Counter()
    found: list[tuple[int, int, str, int, int, bool]] = []  # container, drop, text, its characters without spaces, those in links, whether a heading
    parts: list[tuple[str, bool]] = []

    def close_block() -> None:
        if parts:
            words = "".join(p for p, _ in parts).split()
            if words:
                n, links = sum(map(len, words)), sum(len(x) for p, link in parts if link for x in p.split())
                _, container, drop, _, _, heading = stack[-1]
                found.append((container, drop, " ".join(words), n, links, heading))
                if drop >= 0:
                    drops[drop].chars += n
                    drops[drop].links += links
                    drops[drop].blocks += 1
            parts.clear()

    def say(text: str) -> None:
        top = stack[-1]
        if top[2] < 0 or drops[top[2]].kind != "hard":
            parts.append((entities.unescape(text) if "&" in text else text, top[3]))

    def leave(place: int) -> None:
        for element in stack[place:]:
            opened[element[0]] -= 1
        del stack[place:]

    def pop_to(place: int) -> None:
        close_block()
        leave(place)

    def open_element(tag: str, attributes: str) -> None:
        if tag in BLOCKS:
            close_block()
            if opened["p"] or (tag in HEADINGS and any(opened[h] for h in HEADINGS)):
                for i in range(len(stack) - 1, 0, -1):  # the innermost block element, if it is a paragraph or a heading before a heading
                    if stack[i][0] in BLOCKS:
                        if stack[i][0] == "p" or (tag in HEADINGS and stack[i][0] in HEADINGS):
                            pop_to(i)
                        break
            if tag in CLOSED_BY:
                same, borders = CLOSED_BY[tag]
                if any(opened[x] for x in same):
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i][0] in same:
                            pop_to(i)
                            break
                        if stack[i][0] in borders:
                            break
        if tag == "a" and opened["a"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == "a":
                    leave(i)
                    break
                if stack[i][0] in BLOCKS:
                    break
        if opened["head"] and tag not in IN_HEAD and tag != "head":
            for i in range(1, len(stack)):
                if stack[i][0] == "head":
                    pop_to(i)
                    break
        if tag == "body" and opened["body"] or tag == "html" and opened["html"]:
            return
        _, container, drop, link, in_article, heading = stack[-1]
        label, words, role = _said(attributes) if attributes and "=" in attributes else ("#", [], "")
        kind = _kind(tag, words, role, in_article)
        is_article = tag in ("article", "main") or role == "main" or "articlebody" in words
        at = drop if tag == "main" or role == "main" else -1
        while at >= 0 and not drops[at].holds_main:
            drops[at].holds_main = True
            at = drops[at].up
        if kind and not (drop >= 0 and drops[drop].kind == "hard"):
            drops.append(_Drop(kind, drop, in_article or kind == "head" and not OF_ARTICLE.isdisjoint(words)))
            drop = len(drops) - 1
        if tag == "li" and drop >= 0:
            drops[drop].items += 1
        if tag in CONTAINERS:
            weight = ARTICLE if is_article else 0.9 if tag == "body" else 1.2 if not GOOD.isdisjoint(words) else 1.0
            path = xxhash.xxh3_64_intdigest(f"{tag}.{label}", containers[container].path)
            containers.append(_Container(path, container, weight))
            container = len(containers) - 1
        if tag in BLOCKS:
            heading = tag in HEADINGS or (heading and tag not in CONTAINERS)
        stack.append((tag, container, drop, link or tag == "a", in_article or is_article, heading))
        opened[tag] += 1

    def close_element(tag: str) -> None:
        if tag in BLOCKS:
            close_block()
        if not opened[tag] or tag in ("body", "html"):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] == tag:
                leave(i)  # what was said up to here is a block by now, if tag ends one
                return
            if tag not in BLOCKS and stack[i][0] in BLOCKS:  # an inline element that was left open around blocks
                for k in range(i - 1, 0, -1):
                    if stack[k][0] == tag:
                        del stack[k]
                        opened[tag] -= 1
                        return

    at, end = 0, len(html)
    while at < end:
        lt = html.find("<", at)
        if lt < 0:
            say(html[at:])
            break
        after = html[lt + 1 : lt + 2]
        if not (after.isascii() and (after.isalpha() or after in ("/", "!", "?"))) or after == "":
            say(html[at : lt + 1])
            at = lt + 1
            continue
        if lt > at:
            say(html[at:lt])
        if after == "!" and html.startswith("<!--", lt):
            m = _COMMENT.match(html, lt)
            at = m.end() if m else end
            continue
        m = _TAG.match(html, lt)
        if m is None:
            if after.isalpha() or after == "/" and html[lt + 2 : lt + 3].isalpha():  # a tag without an end
                break
            close = html.find(">", lt)  # a declaration or the like
            at = close + 1 if close >= 0 else end
            continue
        at = m.end()
        closing, tag, attributes = m[1], m[2].lower(), m[3]
        if tag == "br" or tag == "hr":
            close_block() if tag == "hr" else say(" ")
        elif closing:
            close_element(tag)
        elif tag in VOID:
            continue
        elif tag in RAW:
            m = _END[tag].search(html, at)
            at = m.end() if m else end
        else:
            open_element(tag, attributes)
    close_block()

    # which elements are not the article, from the inside out, then from the outside in
    whole = sum(n for _, _, _, n, _, _ in found)  # hard ones have no text here
    for d in reversed(drops):
        if d.up >= 0 and d.kind != "hard":
            up = drops[d.up]
            up.chars, up.links, up.items, up.blocks = up.chars + d.chars, up.links + d.links, up.items + d.items, up.blocks + d.blocks
    for d in drops:
        frame = d.holds_main or (d.chars > FRAME * whole and d.blocks >= FRAME_BLOCKS)
        d.gone = d.kind == "hard" or (d.kind == "soft" and not frame) or (d.kind == "list" and d.items >= 3 and d.links >= 0.9 * d.chars)
        d.gone |= d.up >= 0 and drops[d.up].gone
    for container, drop, text, n, links, heading in found:
        up, gone = drop, False
        while up >= 0 and not gone:
            d = drops[up]
            gone = d.gone or (d.kind == "head" and not (heading and d.in_article) and not d.holds_main)
            up = d.up
        if gone:
            continue
        page.blocks.append((container, text))
        c = containers[container]
        if 2 * links > n:
            c.junk += n
        else:
            c.good += n - links
        c.mark = (c.mark + xxhash.xxh3_64_intdigest(text)) & _MASK
    return page


def host_of(url: Column) -> Column:
    """The host of a url in lower case, without user and port; null where there is none."""
    return F.nullif(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def containers(pages: DataFrame, html_col: str = "html", url_col: str = "url") -> DataFrame:
    """A row for each page with a host: host, found (its containers in page order)."""
    source = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html")).where("host is not null and html is not null")
    kinds = {"path": pa.int64(), "up": pa.int32(), "weight": pa.float64(), "good": pa.int64(), "junk": pa.int64(), "mark": pa.int64(), "total": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[list[dict]] = []
            for html in batch.column("html"):
                page = read(html.as_py())
                totals = page.totals()
                made.append([{"path": _signed(c.path), "up": c.up, "weight": c.weight, "good": c.good, "junk": c.junk, "mark": _signed(t[2]), "total": t[0] + t[1]} for c, t in zip(page.containers, totals)])
            kind = pa.list_(pa.struct(list(kinds.items())))
            yield pa.RecordBatch.from_pydict({"host": batch.column("host"), "found": pa.array(made, kind)})

    return map_in_arrow(source, run, "host string, found array<struct<path:bigint,up:int,weight:double,good:bigint,junk:bigint,mark:bigint,total:bigint>>")


def repeated_paths(read_pages: DataFrame) -> DataFrame:
    """host, repeated (the paths whose text hardly changes), where there are any."""
    told = read_pages.select("host", F.explode(F.filter("found", lambda c: c["total"] > 0)).alias("c")).select("host", "c.path", "c.mark", (F.col("c.weight") == ARTICLE).alias("article"))
    texts = told.groupBy("host", "path", "article", "mark").agg(F.count("*").alias("pages"))
    paths = staged(texts.groupBy("host", "path", "article").agg(F.sum("pages").alias("pages"), F.count("*").alias("texts")))
    whole = paths.where(F.col("path") == _signed(ROOT)).select("host", F.col("pages").alias("all"), (F.col("texts") / F.col("pages")).alias("change"))
    same = (F.col("pages") >= REPEATED_PAGES) & (F.col("pages") >= F.col("all") * REPEATED_SHARE) & ~F.col("article")
    same &= (F.col("pages") >= F.col("texts") * PAGES_A_TEXT) & (F.col("texts") / F.col("pages") * PAGES_A_TEXT <= F.col("change"))
    return paths.join(whole, "host").where(same).groupBy("host").agg(F.collect_list("path").alias("repeated"))


def votes(read_pages: DataFrame, repeated: DataFrame) -> DataFrame:
    """host, path: a vote of each page with text."""
    rows = read_pages.join(small_side(repeated), "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = []
            for found, repeated in zip(batch.column("found").to_pylist(), batch.column("repeated").to_pylist()):
                best.append(Page([_Container(c["path"], c["up"], c["weight"], c["good"], c["junk"]) for c in found]).best(frozenset(repeated or ())))
            yield pa.RecordBatch.from_pydict({"host": batch.column("host"), "path": pa.array(best, pa.int64())})

    return map_in_arrow(rows, run, "host string, path long").where("path is not null")


def host_paths(pages: DataFrame, html_col: str = "html", url_col: str = "url") -> DataFrame:
    """host, winning (paths, the one with the most votes first), repeated (paths whose text hardly changes)."""
    found = staged(containers(pages, html_col, url_col))
    repeated = staged(repeated_paths(found))
    paths = votes(found, repeated).groupBy("host", "path").agg(F.count("*").alias("votes"))
    place = F.row_number().over(Window.partitionBy("host").orderBy(F.col("votes").desc(), "path"))
    paths = paths.withColumn("place", place).withColumn("all", F.sum("votes").over(Window.partitionBy("host")))
    wins = paths.where((F.col("place") == 1) | (F.col("votes") >= F.col("all") * WINNING))
    wins = wins.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "path"))), lambda x: x["path"]).alias("winning"))
    return wins.join(repeated, "host", "full")


def extract(pages: DataFrame, hosts: DataFrame | None = None, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """One row a page: page_id, url, text, n_chars (code points). hosts: of host_paths(), where it is known already."""
    hosts = staged(host_paths(pages, html_col, url_col) if hosts is None else hosts)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"), host_of(F.col(url_col)).alias("host"))
    side = small_side(hosts)
    if side is hosts:  # too many for every task: by shuffle, a host's pages dealt out
        hosts = hosts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("url", F.length("html"), "page_id"), F.lit(SALTS)).cast("int")).join(hosts, ["host", "salt"], "left")
    else:
        rows = rows.join(side, "host", "left")
    rows = rows.select("page_id", "url", "html", "winning", "repeated")
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("page_id", "url")) + ", text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html, winning, repeated in zip(batch.column("html"), batch.column("winning").to_pylist(), batch.column("repeated").to_pylist()):
                unsigned = [[p & _MASK for p in x or ()] for x in (winning, repeated)]
                texts.append(read(html.as_py()).text(unsigned[0], frozenset(unsigned[1])) if html.is_valid else "")
            kept = {c: batch.column(c) for c in ("page_id", "url")}
            yield pa.RecordBatch.from_pydict(kept | {"text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())})

    return map_in_arrow(rows, run, schema)


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
