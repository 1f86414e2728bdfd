from __future__ import annotations

import html
import re
import time

import pytest

from flowledger.llm import html_template as ht
from flowledger.llm.common import table
from flowledger.llm.queries import queries

SCHEMA = "page_id bigint, url string, html string"


def extracted(spark, rows, schema=SCHEMA):
    got = ht.extract(spark.createDataFrame(rows, schema)).collect()
    for r in got:
        assert r["n_chars"] == len(r["text"])
    return {r["page_id"]: r["text"] for r in got}


def test_whole_table_against_plain_version(spark, sf_dir):
    got = {r["page_id"]: r for r in queries()["op1_html_template"](spark, sf_dir).collect()}
    rows = table(spark, sf_dir, "pages").collect()
    assert len(got) == len(rows)
    for r in rows:  # these pages mark their article, so a pattern finds it
        article = re.search("<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        parts = re.split(r"</?(?:p|h1|br)>", article)
        plain = [" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in parts]
        text = " ".join(p for p in plain if p)
        assert tuple(got[r["page_id"]]) == (r["page_id"], r["url"], text, len(text))


PAGE = """<!doctype html><html><head><title>T{i}</title><script>x = "<p>no</p>"</script></head><body>
<header><h2>The site</h2></header><ul class="menu"><li><a href="/">Home</a><li>News {i}</ul>
<{box}><h1>Story&nbsp;{i} &lt;b&gt;</h1><p>First   <b>bo</b>ld {i}
<p class=lead>Second &eacute;{i}<br>line<form><label>Mail</label><input></form>
<div class="cookie-notice">We use cookies</div><section id="comments"><p>I like {i}</p></section></{end}>
<div class="side"><p>Always the same words here</p></div>
<div id="right-sidebar">Side {i}</div><footer>&copy; host {i}</footer></body></html>"""
STORY = "Story {i} <b> First bold {i} Second é{i} line"


@pytest.mark.parametrize("box", ["article", "main", "div role=main", "div class=story"])
def test_what_does_not_belong_to_the_article(spark, box):
    rows = [(i, f"http://h.example/{i}", PAGE.format(i=i, box=box, end=box.split()[0])) for i in range(6)]
    got = extracted(spark, rows)
    assert got == {i: STORY.format(i=i) for i in range(6)}


def test_template_without_names(spark):
    page = (
        "<html><body><div><p>Same top line</p></div><div><div><p>Text {i} of the page, quite long, {i}{i}"
        "</p><p>Subscribe today</p><p>More text {i} below it</p></div></div><div>Contact us</div></body></html>"
    )
    rows = [(i, "https://a.example:80/x?y", page.format(i=i)) for i in range(8)]
    got = extracted(spark, rows)
    assert got == {i: f"Text {i} of the page, quite long, {i}{i} More text {i} below it" for i in range(8)}


def test_copies_of_one_article_are_no_template(spark):
    page = "<html><body><div><p>Always here</p><h1>Title {i}</h1><p>Words of story {i}, and some more</p></div></body></html>"
    stories = [0, 1, 2, 3, *[4] * 7]  # most urls of the host are copies of one article
    rows = [(n, f"http://c.example/{n}", page.format(i=i)) for n, i in enumerate(stories)]
    got = extracted(spark, rows)
    assert got == {n: f"Title {i} Words of story {i}, and some more" for n, i in enumerate(stories)}
    assert extracted(spark, rows[:1] * 6) == {0: "Always here Title 0 Words of story 0, and some more"}


def test_template_text_inside_a_marked_article(spark):
    page = (
        "<html><body><article><h1>Title {i}</h1><p>First {i}<p>Read our magazine<p>Second {i}</article>"
        "<p>Not marked {i}</body></html>"
    )
    got = extracted(spark, [(i, f"http://t.example/{i}", page.format(i=i)) for i in range(5)])
    assert got == {i: f"Title {i} First {i} Second {i}" for i in range(5)}


def test_classes_of_equal_vectors_make_the_frame():
    def found(pages, total, vector, only, *tokens):
        return dict(host_pages=4, pages=pages, total=total, vector=str(vector), set=str(only), tokens=[{"token": t} for t in tokens])

    everywhere = found(4, 4, 100, 100, ">html", ">html>body")
    twice = found(4, 8, 200, 100, ">html>body>div")  # twice on each page
    uneven = found(4, 8, 230, 100, ">html>body>p")  # eight times, but not twice on each
    small = found(2, 2, 40, 40, ">html>body>h2")
    large = found(2, 2, 60, 60, ">html>body>ul", ">html>body>ul>li", ">html>body>ul>li>a")
    loose = found(4, 4, 100, 100, ">html>body>p>b")  # below no token of the frame
    frame = ht.frame_of([everywhere, twice, uneven, small, large, loose])
    assert frame == {"", ">html", ">html>body", ">html>body>div", ">html>body>ul", ">html>body>ul>li", ">html>body>ul>li>a"}


@pytest.mark.parametrize(
    "box",
    [
        "<article class='post has-sidebar'>{}</article>",
        "<main class='no-header'>{}</main>",
        "<div class='content-with-sidebar'>{}</div>",
        "<div id=comment-free><div class='no-menu'><article>{}</article></div></div>",
        "<main><div class='content-with-sidebar'><article>{}</article></div></main>",
    ],
)
def test_class_words_do_not_overrule_the_article(spark, box):
    story = (
        "<header class='entry-header'><h1>Title {i}</h1></header><p>Words of story {i}, and more</p>"
        if "article" in box
        else "<h1>Title {i}</h1><p>Words of story {i}, and more</p>"
    )
    page = f"<body>{box.format(story + '<div class=share>Share {i}</div>')}<div class=sidebar>Side {{i}}</div></body>"
    got = extracted(spark, [(i, f"http://w.example/{i}", page.format(i=i)) for i in range(5)])
    assert got == {i: f"Title {i} Words of story {i}, and more" for i in range(5)}


@pytest.mark.parametrize("pages", [1, 2, 6])
def test_all_differing_slots_are_taken(spark, pages):
    page = (
        "<html><body><p>Always on top</p><div class=story><h1>Title {i}</h1><div class=text><div class=a><p>{long}</p></div>"
        "<div class=b><p>The rest of {i}</p></div></div></div></body></html>"
    )
    long = [f"Words of story {i} " * 5 for i in range(pages)]
    got = extracted(spark, [(i, f"http://s.example/{i}", page.format(i=i, long=long[i])) for i in range(pages)])
    top = "Always on top " if pages == 1 else ""  # one page does not tell
    assert got == {i: f"{top}Title {i} {long[i]}The rest of {i}" for i in range(pages)}


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article><p>One<svg><path d=x><p>Two</article>", "One Two"),
        ("<article>One<select><option>No<option>None<p>Two</article>", "One Two"),
        ("<article>One<svg><path d=x></svg> two<select><option>No</select> three</article>", "One two three"),
        ("<article>" + "<div>" * 1000 + "One" + "</div>" * 1000 + "<p>Two</article>", "One Two"),
        ("<div><article>" + "<div>" * 600 + "One" + "</div>" * 600 + "<p>Two</article></div>Beside", "One Two"),
        ("<div>" * 600 + "<article>One" + "</article>" + "</div>" * 600 + "<p>Beside", "One"),
        ("<article>One" + "<article>" * 600 + "</article>" * 600 + " two</article>Beside", "One two"),
        ("<b>" * 50000 + "<p>One" * 2000, " ".join(["One"] * 2000)),
    ],
)
def test_unclosed_and_deep_elements(page, text):
    assert ht.main_text(page, None, None, None, None) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article><h2 id='related-work'>Related work</h2><p>Body text</p></article>", "Related work Body text"),
        ("<article><section id=search>A long body</section><p>x</p></article>", "A long body x"),
        ("<article><ul><li class='menu-item'>Soup</ul></article>", "Soup"),
        ("<p title=it's>Hello</p>", "Hello"),
        ("<p title=a\"b>Hello</p><p title='>'>you</p><p x = \">\" y>there", "Hello you there"),
        ('<p>One<a href="x>two</a><p>three', "Onetwo three"),  # a quote that never closes ends with its tag
        ("<body><form><h1>Title</h1><p>Text</p></form></body>", "Title Text"),
        ("<form><article>Text<form><p>Your name</form></article><p>Beside</form>", "Text"),
        ("<p>Text<form><p>Mail</form>", "Text"),
        ("<p>a < b <c", "a < b <c"),
        ("<p>One<a x='>' <a x='>' y", "One' ' y"),  # quotes that hide all tag ends do not count
    ],
)
def test_quotes_forms_and_words_of_single_pages(page, text):
    assert ht.main_text(page, None, None, None, None) == text


@pytest.mark.parametrize("part", ["<a ", "<a x=\">\" ", "<svg><p>", "</svg ", "<!-", "<a x='"])
def test_broken_markup_takes_linear_time(part):
    began = time.perf_counter()
    ht.main_text("<p>One" + part * (1_000_000 // len(part)), None, None, None, None)
    assert time.perf_counter() - began < 10


def test_words_inside_a_marked_article(spark):
    chapter = "<section id={id}><h2>{title}</h2><p>Words {i} of {title}</p></section>"
    page = (
        "<article id=post-{i} class='post tag-{i}'><h1>Title {i}</h1>{chapter}<div class='share-{i}'>Share {i}</div>"
        "{once}<div id=related><h3>More</h3><p>Story {j}</p></div><section id=comments><h2>Comments</h2><p>I like {i}</p>"
        "</section></article>"
    )
    chapters = {"search": "Search", "related-work": "Related work", "notices": "Notices", "reply": "Reply"}
    rows, want = [], {}
    for i in range(8):
        name = list(chapters)[i % 3]  # every chapter stands on several pages
        once = "<div class=banner>The banner of Rome</div>" if i == 5 else ""
        told = chapter.format(id=name, title=chapters[name], i=i)
        rows.append((i, f"http://p.example/{i}", page.format(i=i, j=i + 1, chapter=told, once=once)))
        want[i] = f"Title {i} {chapters[name]} Words {i} of {chapters[name]}" + (" The banner of Rome" if once else "")
    assert extracted(spark, rows) == want
    few = {i: text.replace(" The banner of Rome", "") for i, text in want.items() if i < 2}
    got = extracted(spark, rows[:2])
    assert got == few
    assert extracted(spark, rows[5:6])[5] == want[5].replace(" The banner of Rome", "") + " More Story 6"


def test_equivalence_classes(spark):
    rows = [(f"<html><body><h1>a</h1><ul>{'<li>x' * n}</ul></body></html>", n) for n in (1, 2, 3, 2)]
    pages = spark.createDataFrame([("h", n, i, p) for i, (p, n) in enumerate(rows)], "host string, n int, page bigint, html string")
    found = ht.deduce_templates(pages).collect()
    classes = sorted(([t["token"] for t in r["tokens"]] for r in found), key=len)
    assert classes == [
        [">html>body>ul>li"],
        [">html", ">html>body", ">html>body>h1", ">html>body>ul"],
    ]


def test_odd_rows_empty_tables_and_clashing_names(spark):
    rows = [
        (0, None, None),
        (1, "", ""),
        (2, "no url", "just text"),
        (3, "http://x", "<p>open <b>never closed"),
        (4, "http://x", "</div></p>&amp &bogus; &#233; <"),
        (5, "http://x", "<article>" + "<p>long text " * 20000),
        (None, "http://y", "<!-- only a comment"),
        (2, "no url", "just text"),
        (6, "http://z", "<nav>menu</nav>"),
        (7, "http://z", "<article>" * 3000 + "deep"),
    ]
    got = extracted(spark, rows)
    want = {0: "", 1: "", 2: "just text", 3: "open never closed", 4: "& &bogus; é <", 6: "", None: "", 7: "deep"}
    assert {k: v for k, v in got.items() if k != 5} == want
    assert got[5] == " ".join(["long text"] * 20000)
    df = spark.createDataFrame(rows, SCHEMA)
    extra = df.selectExpr("*", "1 as text", "2 as host", "3 as page", "4 as container")
    full = ht.extract(extra)
    assert full.columns == ["page_id", "url", "html", "host", "page", "container", "text", "n_chars"]
    assert full.count() == len(rows)
    assert ht.extract(df.limit(0)).collect() == []
