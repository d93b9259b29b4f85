import html
import random
import re

import pytest
from pyspark.sql import functions as F

from loginwatch.llm import html_text as h

from .cases import bag, table

PAGES = "page_id long, url string, html string"


def slow(page):
    """The article of the given pages, by its only element of that name."""
    found = re.search(r"<article>(.*?)(</article>|\Z)", page or "", re.S)
    parts = re.split(r"</?(?:p|h1)>", found[1].replace("<br>", " ")) if found else []
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in parts]
    return "\n\n".join(x for x in blocks if x)


def test_given_pages(spark):
    pages = table(spark, "pages")
    got = bag(h.page_texts(pages), "page_id", "url", "text", "n_chars")
    want = [(r.page_id, r.url, slow(r.html), len(slow(r.html))) for r in pages.collect()]
    assert got == sorted(want, key=repr) and all(w[3] for w in want)


FULL = """<!DOCTYPE html><html><head><title>T {n}</title><style>p>a{{}}</style></head><body class="has-sidebar">
<header class="site"><a href="/">Site</a> slogan</header>
<div id="nav-menu"><ul><li><a href=1>Home</a></li><li><a href=2>News</a></li></ul></div>
<div class="cookie-notice">We use cookies &amp; more</div>
<div class="page"><div class="content"><h1>Head {n}</h1><!-- <p>not this</p> -->
<p>First   para {n} with <b>bo</b>ld &lt;tags&gt; &eacute; and <a href="x>y">link</a>.</p>
<p class="ad-slot">Buy {n}!</p><aside>Aside {n}</aside>
<script>if (a < b) document.write("<p>no</p>")</script>
<ul><li>item a{n}<li>item b{n}</ul><table><tr><td>c1 {n}</td><td>c2</td></tr></table>
Loose text {n}<form><input name=q>Search</form><p hidden>Hidden</p><p style="display: none">None</p></div>
<div class="comments"><article class="comment"><p>Comment {n}</p></article></div></div>
<footer>Foot {n}</footer></body></html>"""


def full_text(n):
    return "\n\n".join([
        f"Head {n}", f"First para {n} with bold <tags> é and link.", f"item a{n}", f"item b{n}", f"c1 {n}", "c2", f"Loose text {n}",
    ])


def test_everything_around_an_article_goes(spark):
    rows = [(n, "http://Full.example/x", FULL.format(n=n)) for n in range(150)]
    got = bag(h.page_texts(spark.createDataFrame(rows, PAGES).repartition(3)), "page_id", "text")
    assert got == sorted(((n, full_text(n)) for n in range(150)), key=repr)


def test_odd_pages(spark):
    rows = [
        (1, "http://a/1", None), (2, "http://a/2", ""), (3, None, "<p>no url</p>"), (4, "", "just text &amp; more"),
        (5, "nonsense", "<p>open <b>never closed"), (None, "http://a/3", "<article>x<p>y<article>"), (6, "http://a/4", "<" * 3000),
        (7, "http://b/1", "<article>" + "<p>para</p>" * 5000 + "</article>"), (7, "http://b/1", "<article>" + "<p>para</p>" * 5000 + "</article>"),
        (8, "http://c/1", "<article><p>a < b & c \"<a href='u\">z"), (9, "http://c/2", "<div " * 2000), (10, "http://c/3", "<script>x"),
        (11, "http://d/1", "<form><article><p>in a form</p></article></form>"),
        (12, "http://e/1", "<main><article><p>one " + "w" * 50 + "</p></article><article><p>two " + "w" * 50 + "</p></article></main>"),
    ]
    pages = spark.createDataFrame(rows, PAGES).withColumn("host", F.lit(3)).withColumn("text", F.lit("mine"))
    got = h.page_texts(pages).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got}
    assert by[1] == by[2] == "" and by[3] == "no url" and by[4] == "just text & more" and by[5] == "open never closed"
    assert by[None] == "x\n\ny" and by[7] == "\n\n".join(["para"] * 5000) and by[10] == "" and by[11] == "in a form"
    assert by[8].startswith("a < b & c") and by[12].count("\n\n") == 1
    assert h.page_texts(pages.where("false")).count() == 0


def test_wrapper_has_groups_options_and_slots():
    pages = [
        "<body><ul>" + "<li>m</li>" * k + "</ul>" + (f"<h2>{k}</h2>" if k % 2 else "") + f"<p>same</p><p>text {k}</p></body>"
        for k in (1, 2, 3, 4)
    ]
    wrapper = h.stream(pages[0])
    for p in pages[1:]:
        wrapper = h.merged(wrapper, h.stream(p))
    keys = [h._key(x) for x in wrapper]
    assert "+(<li> #body>ul </li>)" in keys and "?(<h2>)" in keys
    assert ["#", "body>ul", 1 + 2 + 3 + 4, h.stream("<body><ul><li>m")[3][3]] in list(h._slots(wrapper))


def test_merging_is_independent_of_partitions(spark, monkeypatch):
    monkeypatch.setattr(h, "FAN", 3)
    rng = random.Random(2)
    rows = [
        (i, f"http://h{i % 2}/", "<body><div class=x>" + "".join(rng.choice(["<p>p</p>", "<h2>h</h2>", "<ul><li>i</ul>"]) for _ in range(8))
         + f"{i}</div><div>menu</div>") for i in range(60)
    ]
    frame = spark.createDataFrame(rows, PAGES)
    one, two = (bag(h.page_texts(f), "page_id", "text") for f in (frame.coalesce(1), frame.repartition(7)))
    assert one == two and not any("menu" in t for _, t in one)


def test_time_is_linear_on_hostile_pages():
    for page in ("<a \"" * 50_000, "<!--" * 50_000, "<p>" * 50_000, "<" * 200_000, "<b x='" * 30_000, "<div>" * 3000 + "</p>" * 3000, "&" * 100_000):
        h.text_of(page, None)


def texts_of(spark, htmls, host="one.example"):
    rows = [(n, f"http://{host}/{n}", x) for n, x in enumerate(htmls)]
    return [t for _, t in bag(h.page_texts(spark.createDataFrame(rows, PAGES)), "page_id", "text")]


def words(n, count):
    return " ".join(f"w{n}x{i}" for i in range(count))


def test_headline_and_lead_beside_an_article_stay(spark):
    for before, after in (("<main>", "</main>"), ("<div>", "</div>")):
        inner = ("<article>", "</article>") if before == "<main>" else ("<div class=body>", "</div>")
        pages = [f"<body><nav>menu {n}</nav>{before}<h1>Head {n}</h1><p>lead {n}</p>{inner[0]}<p>{words(n, 120)}</p>{inner[1]}{after}</body>" for n in range(4)]
        assert texts_of(spark, pages) == [f"Head {n}\n\nlead {n}\n\n{words(n, 120)}" for n in range(4)]


def test_a_page_built_otherwise_keeps_its_text(spark):
    pages = [f"<body><article><h1>Head {n}</h1><p>{words(n, 60)}</p></article></body>" for n in range(1, 4)]
    pages.insert(0, f"<body><main><p>{words(0, 120)}</p><article>card 0</article></main></body>")
    got = texts_of(spark, pages)
    assert words(0, 120) in got[0] and got[1:] == [f"Head {n}\n\n{words(n, 60)}" for n in range(1, 4)]


def test_text_of_the_template_goes(spark):
    pages = [
        f"<body><article><h1>Head {n}</h1><p>{words(n, 30)}</p><p>Follow us on all channels today.</p><p>{words(n + 50, 30)}</p></article></body>"
        for n in range(4)
    ]
    assert texts_of(spark, pages) == [f"Head {n}\n\n{words(n, 30)}\n\n{words(n + 50, 30)}" for n in range(4)]
    # Copies of one page share all they have, which says nothing.
    assert texts_of(spark, [pages[0]] * 6)[0].count("Follow us") == 1
    # Nor do two pages that quote the same line.
    assert all("Follow us" in t for t in texts_of(spark, pages[:2]))


def test_near_copies_keep_what_they_share(spark):
    base = [words(900 + k, 25) for k in range(6)]
    pages = []
    for n in range(8):
        parts = list(base)
        parts[n % 6] += f" edit{n}"
        pages.append("<body><article>" + "".join(f"<p>{p}</p>" for p in parts) + "</article></body>")
    got = texts_of(spark, pages)
    assert all(t.count("\n\n") == 5 for t in got)


def test_names_that_only_contain_a_mark_are_content(spark):
    pages = [
        f"<body><article><p>{words(n, 20)}</p><p class=reply>answer {n}</p><div class=comment-policy><p>policy {n}</p></div>"
        f"<section class=related-work><p>work {n}</p></section><div class='comment-list'><p>reader {n}</p></div>"
        f"<p class=ad-slot>buy {n}</p><ol class=comments><li>says {n}</li></ol></article></body>" for n in range(4)
    ]
    assert texts_of(spark, pages) == [f"{words(n, 20)}\n\nanswer {n}\n\npolicy {n}\n\nwork {n}" for n in range(4)]


def test_literals_are_told_from_slots_in_the_wrapper():
    items = h.token_stream("<body><p>a</p><p>b</p><p>fixed</p><p>c</p></body>")
    place = next(f"{x[1]}={x[3]}" for x in items if not isinstance(x, str) and x[3] == h.digest("fixed"))
    wrapper = h.with_literals(items, frozenset([place]))
    assert [x for x in wrapper if not isinstance(x, str) and x[0] == "="] == [["=", "body", h.digest("fixed")]]
    assert sum(1 for _ in h._slots(wrapper)) == 2


def test_clashing_columns(spark):
    rows = [(n, f"http://c.example/{n}", f"<article><p>{words(n, 9)}</p></article>", "x", 7, "y", "z") for n in range(3)]
    frame = spark.createDataFrame(rows, PAGES + ", host string, n_chars int, region string, literals string")
    assert bag(h.page_texts(frame), "page_id", "text") == [(n, words(n, 9)) for n in range(3)]
