"""Main text of pages, clicks in expiring windows, and ranked search: against hand-made pages, a plain replay and a plain ranking."""

import datetime
import hashlib
import html
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpora import edge_rows, random_texts
from inkmill.llm import clicks, lexical, main_text

SF = "/root/testdata/sf0.001"

# --- op11

PROSE = "This sentence is part of the article, and says something that a reader may want to know."
PAGES = {
    "tags": (
        f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><header><h1>Site</h1></header><nav><a href=/>Home</a></nav><main><article><header><h1>A &amp; B</h1><p>by line</p></header><p>{PROSE}"
        f"<p>Two\n lines&nbsp;here<br>and on<script>var x = '<p>no</p>'</script>.</p><aside>Aside</aside><section id=comments><article><p>{PROSE} I think.</p></article></section></article></main><footer>F</footer></body></html>",
        f"A & B\n{PROSE}\nTwo lines here and on.",
    ),
    "classes": (
        f"<body><div class='site-header'><h1>Site</h1></div><div id='main-menu'><p>{PROSE}</p></div><div class=wrap><div class='post-body'><h2>Head</h2><p>{PROSE}</p><div class='cookieNotice'>We use cookies.</div><p>End <b>bold</b><i>er</i> text.</p></div>"
        f"<div class=sidebar>{PROSE}</div><div class='ad-slot'>Buy!</div><form><p>Your name</p></form><div id=disqus_thread>{PROSE} Yes. {PROSE} No.</div></div><div class=footer>F</div>",
        f"Head\n{PROSE}\nEnd bolder text.",
    ),
    "unclosed": (f"<p>One <b>two<p>{PROSE}<ul><li>a<li>b</ul><div>last", f"One two\n{PROSE}\na\nb\nlast"),
    "links": (f"<div><ul><li><a href=a>One</a><li><a href=b>Two</a><li><a href=c>Three</a></ul><p>{PROSE}</p><table><tr><td>x<td>y</table></div>", f"{PROSE}\nx\ny"),
    "not what it says": (f"<body class='has-sidebar'><div class='content with-ads'><p>{PROSE}</p><h2>More</h2><p class=no-comment>{PROSE}</p></div></body>", None),
    "frame": (f"<div class='menu-layout'><h1>Title</h1><p>{PROSE}</p><p>{PROSE}</p></div>", f"Title\n{PROSE}\n{PROSE}"),
    "broken": (f"<p>{PROSE}</p><p class='a' title='<b>'>1 < 2 &am & 3</p></nav></b><!-- <p>gone</p> --><!><?x y><p>x<!-- open", f"{PROSE}\n1 < 2 &am & 3\nx"),
    "cut": (f"<p>{PROSE}</p><a href='", PROSE),
    "markup alone": ("<html><head></head><body><nav>Menu</nav></body></html>", ""),
}


@pytest.mark.parametrize("name", [n for n in PAGES if PAGES[n][1] is not None])
def test_pages_alone(name):
    source, wanted = PAGES[name]
    assert main_text.read(source).text() == wanted


def test_words_that_say_what_is_not_there():
    assert main_text.read(PAGES["not what it says"][0]).text().startswith(PROSE)


def test_long_and_deep_pages():
    deep = "<div>" * 20_000 + PROSE + "</div>" * 20_000
    assert main_text.read(deep).text() == PROSE
    many = "<body><article>" + f"<p>{PROSE}</p>" * 20_000
    assert main_text.read(many).text() == "\n".join([PROSE] * 20_000)
    for odd in ("<" * 50_000, "<a " * 50_000, "<a b='" * 20_000, "&" * 50_000, "</b>" * 50_000, "<b>" * 20_000 + "x", "<!--" * 20_000):
        main_text.read(odd).text()


def page(body: str, note: str, more: str = "") -> str:
    return f"<body><div class=top>{note}</div><div class=mid12>{body}</div><div class=low>{more}</div></body>"


def test_hosts_agree(spark):
    """Pages whose own look misleads are read by their host's path, and what all pages of a host say alike goes."""
    notice = "By reading on you agree to our terms, which are long and dull, and to much else besides. " * 3
    rows = []
    for i in range(12):
        own = " ".join(f"<p>{PROSE} Number {i} {k}.</p>" for k in range(3 + i % 4))
        rows.append((i, "https://u:p@One.example:80/a", page(own, notice)))
    odd = page("<p>Short one.</p>", notice, f"<p>{PROSE} Elsewhere.</p>" * 5)
    rows += [(100, "https://one.example/b", odd), (101, None, odd), (102, "no url", odd), (103, "https://one.example/c", None), (None, "https://two.example", f"<p>{PROSE}</p>"), (None, "https://two.example", "")]
    rows += [(i, "https://two.example/", f"<p>{PROSE}</p>") for i in (104, 104)]
    schema = "page_id long, url string, html string, text string, host string, winning int, path string"
    made = spark.createDataFrame([(*r, "x", "y", 1, "z") for r in rows], schema)
    results = []
    for n in (1, 5):
        results.append(sorted(map(tuple, main_text.extract(made.repartition(n)).collect()), key=repr))
    assert results[0] == results[1]
    texts = {r[0]: r[2] for r in results[0] if r[0] is not None}
    for i in range(12):
        assert texts[i] == "\n".join(f"{PROSE} Number {i} {k}." for k in range(3 + i % 4))
    assert texts[100] == "Short one."
    assert "Elsewhere" in texts[101] and texts[101] == texts[102]
    assert texts[103] == "" and len(results[0]) == len(rows) and [r[2] for r in results[0] if r[0] == 104] == [PROSE] * 2
    assert all(r[3] == len(r[2]) for r in results[0])
    assert main_text.extract(made.where("false")).collect() == []


def test_many_hosts_are_joined(spark, monkeypatch):
    rows = [(i, f"https://h{i % 9}.example/", page(f"<p>{PROSE} {i}</p>", "note")) for i in range(60)]
    made = spark.createDataFrame(rows, "page_id long, url string, html string")
    wanted = sorted(map(tuple, main_text.extract(made).collect()))
    monkeypatch.setattr(main_text, "small_side", lambda df: df)
    assert sorted(map(tuple, main_text.extract(made).collect())) == wanted


def test_pages_of_the_table(spark):
    """The table's articles stand in an article element, whose blocks a plain pattern finds."""
    source = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in main_text.op11_main_text(spark, SF).collect():
        inside = re.search(r"<article>(.*)</article>", source[r.page_id], re.DOTALL)[1].replace("<br>", " ")
        parts = re.sub(r"<(?:p|/p|h1|/h1)>", "\0", re.sub(r"</?b>", "", inside)).split("\0")
        assert r.text == "\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)


# --- op12

EPOCH = datetime.datetime(1970, 1, 1)
CLICKS = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, props string, hour int, batch string, grp string"


def micros(t) -> int:
    d = t - EPOCH
    return (d.days * 86400 + d.seconds) * 10**6 + d.microseconds


def replay(rows, batches=12, window=72, lateness=48) -> list[tuple]:
    """The windows, by a plain loop."""
    made = []
    for click_id, ts, arrived, client, kind, value, props in rows:
        if click_id is None or arrived is None:
            continue
        for j in range(click_id % 3 + 1):
            c = zlib.crc32(f"{click_id}:{j}".encode())
            hour = micros(arrived) // 3_600_000_000 + 6 * j * (c % 10)
            told = (client, kind, None if value is None else math.floor(100 * value + 0.5), None if ts is None else micros(ts), props, c % 3)
            made.append((hour + c // 10 % 200, click_id, hour, hashlib.sha256("|".join("" if x is None else str(x) for x in told).encode()).hexdigest()))
    if not made:
        return []
    low, high = min(m[0] for m in made), max(m[0] for m in made)
    dealt = defaultdict(list)
    for place, *rest in made:
        dealt[(place - low) * batches // (high - low + 1)].append(tuple(rest))
    most, opened, out = None, {}, []
    for b in range(batches):
        for click_id, hour, digest in sorted(x for x in dealt[b] if most is None or x[1] >= most - lateness):
            w = opened.get(click_id)
            if w and hour <= w[0] + window:
                w[1] += 1
                if digest != w[4]:
                    w[2], w[3] = w[2] + 1, w[3] + zlib.crc32(digest.encode())
                continue
            if w:
                out.append((click_id, w[0], b, *w[1:]))
            opened[click_id] = [hour, 0, 0, 0, digest]
        most = max([x[1] for x in dealt[b]] + ([] if most is None else [most]), default=None)
        for click_id in [i for i, w in opened.items() if b == batches - 1 or (most is not None and w[0] + window < most - lateness)]:
            w = opened.pop(click_id)
            out.append((click_id, w[0], b, *w[1:]))
    return sorted(out)


def click_rows(n: int, seed: int, ids: int, days: int) -> list[tuple]:
    r = random.Random(seed)
    out = []
    for _ in range(n):
        at = datetime.datetime(1969, 12, 1) + datetime.timedelta(seconds=r.randrange(days * 86400), microseconds=r.randrange(10**6))
        out.append((r.randrange(-2, ids), r.choice([None, at]), at, r.choice([None, 1]), r.choice([None, "a|b", ""]), r.choice([None, 0.125, -3.5, 1e9]), r.choice([None, '{"a": 1}'])))
    return out + out[:20]


def test_windows_are_those_of_a_plain_replay(spark):
    rows = click_rows(400, 5, 40, 60)
    odd = [(None, *rows[0][1:]), (7, rows[0][1], None, 1, "x", 1.0, "p")]
    made = spark.createDataFrame([(*r, 1, "b", "g") for r in rows + odd], CLICKS)
    wanted = replay(rows)
    for partitions, groups, crowded in ((1, 3, 10_000), (5, None, 10_000), (4, 2, 5)):
        got = clicks.run_batches(spark, made.repartition(partitions), groups=groups, crowded=crowded)
        assert sorted(map(tuple, got.collect())) == wanted


def test_one_crowded_click(spark):
    """A click with nearly all rows comes reduced: a number of rows by hours, not by clicks."""
    rows = [(2, *r[1:]) for r in click_rows(3000, 6, 5, 20)] + click_rows(50, 7, 9, 20)
    made = spark.createDataFrame([(*r, 1, "b", "g") for r in rows], CLICKS)
    got = clicks.run_batches(spark, made.repartition(3), batches=3, crowded=200)
    assert sorted(map(tuple, got.collect())) == replay(rows, batches=3)
    copies = clicks.copies(made).withColumn("batch", F.lit(0))
    many = copies.where("click_id = 2")
    assert clicks._reduced(many).count() < many.count() / 3


def test_clicks_without_rows_or_with_gaps(spark):
    none = spark.createDataFrame([], CLICKS)
    assert clicks.run_batches(spark, none).collect() == []
    at = datetime.datetime(2024, 1, 1)
    rows = [(i, at, at + datetime.timedelta(hours=h), 1, "k", 1.0, "p") for i, h in ((0, 0), (3, 5), (0, 400), (6, 2000), (3, 2001))]
    made = spark.createDataFrame([(*r, 1, "b", "g") for r in rows], CLICKS).withColumns({c: F.col(c).cast("timestamp") for c in ("ts", "arrived_at")})
    assert sorted(map(tuple, clicks.run_batches(spark, made).collect())) == replay(rows)


# --- op13


def ranking(docs, items, k=50) -> list[tuple]:
    terms = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    counts = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    counts = [(doc_id, c) for doc_id, c in counts if c]
    n, length = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in items:
        found = []
        for doc_id, c in counts:
            m = 50 + 50 * c.total() * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, i, x[3], -x[0]) for i, x in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def test_search_is_a_plain_ranking(spark):
    docs = [(i, t) for i, t in enumerate(random_texts(300, 11))] + [(r[0], r[1]) for r in edge_rows()] + [(1, "Twice, TWICE; twice"), (1, "Twice, TWICE; twice")]
    items = [(i, t) for i, t in enumerate(random_texts(70, 12))] + [(900, None), (901, ""), (902, "... ;"), (903, "twice neverseen"), (903, "HÉLLO wörld\xa0x"), (904, "neverseen"), (None, "a b c")]
    made = spark.createDataFrame([(*d, 1, "x", 2, 3.5) for d in docs], "doc_id long, text string, item int, term string, block int, score double")
    asked = spark.createDataFrame([(*i, "x", 1) for i in items], "item_id long, text string, term string, rank int")
    for partitions, block, k in ((1, 64, 50), (5, lexical.BLOCK, 50), (3, 16, 3)):
        got = lexical.search(made.repartition(partitions), asked, k=k, block=block)
        assert sorted(map(tuple, got.collect()), key=repr) == ranking(docs, items, k)


def test_search_of_ties_and_nothing(spark):
    docs = [(f"d{i:03}", "same words here") for i in range(200)] + [("e", "other words"), (None, "same words here")]
    items = [("x", "same here"), ("y", "none")]
    made, asked = spark.createDataFrame(docs, "doc_id string, text string"), spark.createDataFrame(items, "item_id string, text string")
    got = lexical.search(made.repartition(4), asked, block=30).collect()
    assert sorted((r.rank, r.doc_id) for r in got) == [(i + 1, f"d{i:03}") for i in range(50)]
    for a, b in ((made.where("false"), asked), (made, asked.where("false"))):
        assert lexical.search(a, b).collect() == []


def test_long_texts_are_cut_between_terms():
    data = ("Abc déf,ghi " * 2000 + "x" * 5000).encode()
    assert lexical.terms_of(data, 64) == lexical.terms_of(data) == Counter({b"abc": 2000, "déf".encode(): 2000, b"ghi": 2000, b"x" * 5000: 1})


def test_search_of_the_table(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    assert sorted(map(tuple, lexical.op13_lexical(spark, SF).collect())) == sorted(con.execute(lexical.OP13_SQL).fetchall())
