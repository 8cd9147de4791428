from __future__ import annotations

import html
import re

from llm_support import SF_SMALL, make  # noqa: F401

from sleeper.llm import html_template as H
from sleeper.llm import queries

PAGES = "page_id long, url string, html string"


def texts(df, **kw):
    return {r["page_id"]: r["text"] for r in H.extract(df, **kw).collect()}


def brute(page):
    """For the given pages, which all have one article: its blocks by plain search."""
    a, b = page.find("<article>"), page.rfind("</article>")
    inner = re.sub(r"</?(?:p|h1)>", "\0", page[a + 9:b])
    blocks = (" ".join(html.unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in inner.split("\0"))
    return "\n".join(x for x in blocks if x)


def test_query_matches_brute_force(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    got = queries.op1_html_template(spark, SF_SMALL).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == brute(pages[r["page_id"]]) and r["n_chars"] == len(r["text"])


def test_parts_that_are_no_text(spark, make):
    page = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="home">
    <header><h1>Site</h1></header><nav><a href="/">Home</a></nav><div class="cookie-notice">We use cookies</div>
    <main><article class="post"><header><h2>Head  line</h2></header><p>One&nbsp;&amp; two<br>three</p>
    <script>if (a < b) document.write("<p>no</p>")</script><!-- <p>no</p> --><div class="ad-slot">Buy</div>
    <p title="a > b">x < y &lt;z&gt; &#169;&#x41; caf&eacute;</p><ul><li>i<b>te</b>m</li><li>two</li></ul>
    <form><p>Your mail</p><input></form><section id="comments"><p>First!</p></section><table><tr><td>c1<td>c2</table>
    <div>tail</div></article></main><aside><p>Also read</p></aside><footer><p>(c)</p></footer></body></html>"""
    assert texts(make([(1, "http://a.b/c", page)], PAGES))[1] == \
        "Head line\nOne & two three\nx < y <z> ©A café\nitem\ntwo\nc1\nc2\ntail"


def test_template_drops_what_each_page_repeats(spark, make):
    def page(i):
        return (f"<html><body><div class='x1'><ul><li>Everywhere the same</li></ul></div>"
                f"<div class='x2'><p>Story {i} begins.</p><p>Its end, {i * i}.</p></div>"
                f"<div class='x3'><span>Printed daily</span></div></body></html>")
    rows = [(i, "https://Host.example/" + str(i), page(i)) for i in range(6)]
    rows += [(100 + i, f"https://single{i}.example/", page(i)) for i in range(3)]  # read by the template of all
    got = texts(make(rows, PAGES))
    for i, _, _ in rows:
        assert got[i] == f"Story {i % 100} begins.\nIts end, {(i % 100) ** 2}."


def test_copies_of_one_article_keep_their_text(spark, make):
    page = "<html><body><nav>Menu</nav><article><h1>T</h1><p>Same words.</p></article></body></html>"
    assert set(texts(make([(i, "http://a.b/", page) for i in range(9)], PAGES)).values()) == {"T\nSame words."}


def test_classes_are_equal_vectors(spark, make):
    rows = [(i, "http://h/", f"<html><body><div>{'<ul><li>x</ul>' * (i + 1)}</div></body></html>") for i in range(4)]
    df = make(rows, PAGES).selectExpr("page_id _row", "0L _file", "'h' host", "html")
    found = {r["host"]: r for r in H.templates(df).collect()}
    classes = {}
    for t in found["h"]["template"]:
        classes.setdefault(t["class"], set()).add(t["token"].rpartition("/")[2].rpartition(">")[2])
    assert {frozenset(x) for x in classes.values()} == {frozenset({"html", "body", "div"}), frozenset({"ul", "li"})} or \
        any({"ul", "li"} <= x for x in classes.values())
    assert [t["place"] for t in found["h"]["template"]] == sorted(t["place"] for t in found["h"]["template"])


def test_odd_rows(spark, make):
    rows = [(1, None, None), (2, "", ""), (3, "x", "plain  text\nonly"), (4, "http://h/", "<p>open<p>cut &am"),
            (5, "http://h/", "<script>never closed <p>a"), (6, "http://h/", "</div></p>>< <"), (None, "http://h/", "<b>n</b>"),
            (7, "http://h/", "<div>" * 500 + "deep" + "</div>" * 500), (8, "http://h/", "<p>" + "w " * 200_000),
            (8, "http://h/", "<p>" + "w " * 200_000), (9, "http://h/", "<p a='" + "<p>q " * 3000)]
    df = make([(*r, "z", "z") for r in rows], PAGES + ", host string, template string")
    got = H.extract(df).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r["text"] for r in got}
    assert [by[i] for i in (1, 2, 3, 4, 5, 7, None)] == ["", "", "plain text only", "open\ncut &am", "", "deep", "n"]
    assert by[8] == " ".join(["w"] * 200_000)
    assert H.extract(df.where("false")).collect() == []


def test_host():
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    urls = ["https://A.b:80/c?d", "//x.y/z", "http://u:p@h.i#f", "mailto:a@b", None]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string")
    assert [r["h"] for r in df.select("i", H.host(df.u).alias("h")).orderBy("i").collect()] == ["a.b", "x.y", "h.i", "", ""]


def test_slots_inside_the_article_decide_too(spark, make):
    def page(i):
        return (f"<html><body><article><h1>Story {i}</h1><div class='x9'>Printed daily</div><p>Body {i * i}.</p>"
                f"<div class='x9'>All rights reserved</div></article></body></html>")
    got = texts(make([(i, "http://h.example/", page(i)) for i in range(6)], PAGES))
    assert got == {i: f"Story {i}\nBody {i * i}." for i in range(6)}
    same = "<html><body><div><p>Menu</p></div><div><p>Words</p></div></body></html>"  # copies, no article
    assert set(texts(make([(i, "http://c.example/", same) for i in range(4)], PAGES)).values()) == {"Menu\nWords"}


def test_classes_without_containers_are_no_template():
    tokens = [("/html", 1), ("//html", 1), ("/html/ul/li", 2), ("//html/ul/li", 2), ("/html>p", 3), ("/html/ul>p", 3)]
    assert H.nest([{"token": t, "class": c} for t, c in tokens]) == {"/html", "//html"}


def test_names_around_the_article_drop_nothing(spark, make):
    pages = ["<body class='right-sidebar'><article>A</article></body>", "<body class='no-sidebar ad'><p>A</p></body>",
             "<html class='cookie'><body><main class='has-sidebar widget'>A</main></body></html>",
             "<div class='content with-sidebar'><p>A</p></div>", "<article class='post social'>A</article>",
             "<div class='widget'><article>A</article><div class='post-comments'>no</div></div><div class='ad'>no</div>",
             "<div id='sidebar'><p>no</p></div><article role='article'>A<div class='ad-slot'>no</div></article>"]
    rows = [(i, f"http://h{i}.example/", p.replace("A<", f"A {i}<")) for i, p in enumerate(pages)]
    assert texts(make(rows, PAGES)) == {i: f"A {i}" for i in range(len(rows))}


def test_names_and_article_far_below(spark, make):
    def page(i, inner):
        return "<div>" * 40 + inner.format(i) + "</div>" * 40
    bare = "<nav>Menu {0}</nav><div class='ad'>Buy {0}</div><p>Text {0}</p><footer>(c) {0}</footer>"
    whole = "<p>Lead {0}</p><article><p>Text {0}</p></article><p>Tail {0}</p>"
    rows = [(i, f"http://h{i % 2}.example/", page(i, (bare, whole)[i % 2])) for i in range(12)]
    assert texts(make(rows, PAGES)) == {i: f"Text {i}" for i in range(12)}
    names = [t for _, t, _, _ in H.Page(page(0, whole)).tokens if t]
    assert len({t for t in names if "/p" not in t}) == 84 and max(map(len, names)) < 200


def test_slots_far_below(spark, make):
    rows = [(i, "http://h.example/", "<div>" * 40 + f"<section>Daily</section><ul>Text {i}</ul>" + "</div>" * 40)
            for i in range(6)]
    assert texts(make(rows, PAGES)) == {i: f"Text {i}" for i in range(6)}


def test_articles_keep_their_headings_and_copies_vouch_for_nothing(spark, make):
    def page(i, body):
        return f"<html><body><article><h1>Story {i}</h1>{body}</article></body></html>"
    rows = [(i, "http://h.example/", page(i, f"<h2>Introduction</h2><p>Intro {i}.</p><h2>Results</h2><p>Found {i}.</p>"))
            for i in range(6)]
    rows += [(10 + i, "http://d.example/", f"<html><body><article><h2>Daily report</h2><p>Day {i}</p></article></body></html>")
             for i in range(4)]
    copy = page(9, "<h3>Only here</h3><p>Some words.</p>")
    rows += [(20 + i, "http://c.example/", copy if i < 3 else page(i, f"<p>Words {i}.</p>")) for i in range(6)]
    got = texts(make(rows, PAGES))
    assert [got[i] for i in range(6)] == [f"Story {i}\nIntroduction\nIntro {i}.\nResults\nFound {i}." for i in range(6)]
    assert [got[10 + i] for i in range(4)] == [f"Daily report\nDay {i}" for i in range(4)]
    assert [got[20 + i] for i in range(6)] == ["Story 9\nOnly here\nSome words."] * 3 + [f"Story {i}\nWords {i}." for i in (3, 4, 5)]


def test_names_of_adverts_and_comments(spark, make):
    gone = ("reader-comments", "user-comments", "readerComments", "ad-300x250", "adsbygoogle", "google-ad", "signup-box",
            "more-stories", "AdSlot2", "cookie_bar", "comment-list-17", "mostRead")
    kept = ("no-comments", "with-sidebar", "content", "post", "commentary", "ad-free", "adder", "story", "address-book")
    assert [n for n in gone if not H.boilerplate(n)] == [] and [n for n in kept if H.boilerplate(n)] == []
    rows = [(i, f"http://h{i}.example/", f"<article><p>Text {i}</p><div class='{n}'>Box {i}</div></article>")
            for i, n in enumerate(gone + kept)]
    rows += [(100 + i, f"http://n{i}.example/", f"<p>Text {i}</p><div id='{n}'>Box {i}</div>") for i, n in enumerate(gone)]
    got = texts(make(rows, PAGES))
    assert got == {i: f"Text {i}" if i < len(gone) else f"Text {i}\nBox {i}" for i in range(len(gone) + len(kept))} | {
        100 + i: f"Text {i}" for i in range(len(gone))}
