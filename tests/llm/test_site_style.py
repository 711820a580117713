import html
import math
import re
import time
from collections import Counter, defaultdict

import pytest

from shelfmark.llm import site_style as s
from shelfmark.llm.queries import QUERIES

PAGES = "page_id long, url string, html string"


def test_parts_that_are_no_article():
    page = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="no-ads">
    <header><h1>Site</h1></header><nav>menu</nav><div class="cookie-notice">We use cookies</div>
    <!-- <p>comment</p> --><main><div class=sidebar>side</div><article class="post ad-free"><header><h1>Caf&eacute; &amp; <i>co</i></h1></header>
    <p>One<br>two   <b>three<p>Fo<span>ur</span> &#8364; &copy x &am;</p><ul><li>a<li>b</ul>
    <div hidden>no</div><span class="ad">buy</span><form><input value=x>send</form><script>if (a<b) x("</p>")</script>
    <table><tr><td>c<td>d</table><section id="comments"><p>nice!</p></section><aside>see also</aside><footer>by me</footer>
    </article><div>outside</div></main><footer>end</footer></body></html>"""
    assert s.Page(page).text() == "Café & co One two three Four € © x &am; a b c d"


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain  text", "plain text"), ("<p>a</p><p>b", "a b"), ("a < b <1> <", "a < b <1> <"),
    ("<script>x", ""), ("<div>a<!-- b", "a"), ("<main>m</main>o", "m"), ("<div role=main>m</div>", "m"),
    ("<nav>all</nav>", ""), ("<article><nav>x</nav></article><p>y</p>", "y"), ("<p a='>'>x</p>", "x"),
    ("<textarea><p>x</textarea>y", "y"), ("<TITLE>t</TITLE><P CLASS=x>y", "y"), ("</div></p>z<div", "z<div"),
])
def test_small_pages(page, text):
    assert s.Page(page).text() == text


def test_article_cards_beside_the_main_text():
    """Teasers in article elements don't displace a main text that is longer than they are."""
    main = "<p>" + "The main text goes on. " * 9 + "</p>"
    cards = "<article><h3>Read this</h3></article><article><h3>And that</h3></article>"
    text = "The main text goes on. " * 8 + "The main text goes on."
    assert s.Page(f"<div>{main}</div>{cards}").text() == f"{text} Read this And that"
    assert s.Page(f"<i>x</i><main>{main}{cards}</main><p>out</p>").text() == f"{text} Read this And that"
    assert s.Page(f"<article>{main}</article><article>{main}</article><p>out</p>").text() == f"{text} {text}"


def test_long_and_deep_pages():
    assert s.Page("<div>" * 3000 + "x" + "</div>" * 3000).text() == "x"
    assert s.Page("<p>w " * 50000).text() == " ".join(["w"] * 50000)
    assert s.Page("<a <b " * 20000).text().startswith("<a <b")
    assert len(s.Page("<div>" * 3000 + "x").style_rows()) < 3 * s.DEPTH


def brute_importance(pages):
    """Composite and content importance by path, from the rows of each page of one host."""
    looks, texts, lines, count = defaultdict(Counter), defaultdict(Counter), {}, Counter()
    for page in pages:
        for path, line, kind, feature in s.Page(page).style_rows():
            lines[path] = line
            (texts if kind else looks)[path][feature] += 1
    out = {}
    for path, found in looks.items():
        m = sum(found.values())
        shape = -sum(c / m * math.log(c / m) for c in found.values()) / math.log(m) if m > 1 else 1.0
        n = total = 0
        most = None
        for leaf, words in texts.items():
            if path in lines[leaf]:
                pages_of = sum(looks[leaf].values())
                k = sum(words.values())
                content = 1.0 if pages_of == 1 else max(
                    0.0, 1 - sum(c * math.log(c) for c in words.values()) / k / math.log(pages_of))
                n, total = n + k, total + k * content
                most = content if most is None else max(most, content)
        own = 1 - s.GAMMA ** len(found)
        out[path] = (m, own * shape + (1 - own) * (total / n if n else 0.0), most)
    return out


def site(n):
    """Pages without telling tags: a line and a block that are the same everywhere, and an own text."""
    return [
        f"<div class='top{i}'><p>Always the same line</p></div><div class=body><p>Own text {i}</p><p>More of {i}</p></div>"
        f"<div class=low><p>All rights reserved</p><p>Call us</p></div>" for i in range(n)
    ]


def test_importance_equals_brute_force(spark):
    hosts = {"http://a.org/": site(12), "http://b.org/": ["<p>x</p>"] * 9 + ["<p>x</p><p>y</p>", "<div>z</div>"],
             "http://c.org/": ["<p>one</p>"]}
    rows = [(i, u + str(i), h) for u, many in hosts.items() for i, h in enumerate(many)]
    nodes = s.style_nodes(spark.createDataFrame(rows, PAGES)).collect()
    got = defaultdict(dict)
    for r in nodes:
        got[r["host"]][r["path"]] = (r["pages"], r["importance"], r["content"])
    want = [brute_importance(many) for many in hosts.values()]
    for own in want:
        match = [g for g in got.values() if g.keys() == own.keys() and g[0][0] == own[0][0]]
        assert any(all(g[p] == pytest.approx(own[p]) for p in own) for g in match)


def test_repeated_branches_go(spark):
    rows = [(i, f"http://A.org/{i}", h) for i, h in enumerate(site(12))]
    rows += [(100 + i, f"http://few.org/{i}", h) for i, h in enumerate(site(3))]
    rows += [(200 + i, "http://same.org/", "<p>one page, many copies</p>") for i in range(20)]
    got = {r["page_id"]: r["text"] for r in s.extract(spark.createDataFrame(rows, PAGES)).collect()}
    for i in range(12):
        assert got[i] == f"Own text {i} More of {i}"
    assert got[100] == "Always the same line Own text 0 More of 0 All rights reserved Call us"
    assert got[200] == "one page, many copies"


def test_copies_count_once(spark):
    """A host that is 95 % copies of one page keeps the headings of all its pages."""
    def page(i, n):
        return f"<article><h1>Title {i}</h1>" + "".join(f"<p>Line {j} of {i}</p>" for j in range(n)) + "</article>"

    rows = [(0, f"http://copies.org/{i}", page(0, 3)) for i in range(190)]
    rows += [(i, f"http://copies.org/own{i}", page(i, 20)) for i in range(1, 11)]
    got = s.extract(spark.createDataFrame(rows, PAGES).repartition(5)).collect()
    assert len(got) == 200
    for r in got:
        i = r["page_id"]
        assert r["text"] == " ".join([f"Title {i}", *(f"Line {j} of {i}" for j in range(20 if i else 3))])


def test_near_copies_count_once(spark):
    """Copies that differ in a comment are one page, and an article keeps what its site repeats."""
    def page(i, n, note=0):
        return (f"<!-- {note} --><article><h1>Title {i}</h1><p>In all articles</p>"
                + "".join(f"<p>Line {j} of {i}</p>" for j in range(n)) + "</article><p>Imprint</p>")

    rows = [(0, f"http://copies.org/{i}", page(0, 3, i)) for i in range(500)]
    rows += [(i, f"http://copies.org/own{i}", page(i, 5)) for i in range(1, 31)]
    assert s.different_pages(spark.createDataFrame(rows, PAGES)).count() == 31
    for r in s.extract(spark.createDataFrame(rows, PAGES).repartition(5)).collect():
        i = r["page_id"]
        assert r["text"] == " ".join([f"Title {i}", "In all articles", *(f"Line {j} of {i}" for j in range(5 if i else 3))])


@pytest.mark.parametrize("page, text", [
    ('<body class="page has-sidebar"><h1>T</h1><p>x</p></body>', "T x"),
    ('<div class="social-sciences"><p>x</p></div>', "x"),
    ('<div class="social"><p>share</p></div><div class=in><p>the text of it</p></div>', "the text of it"),
    ('<form id="aspnetForm"><div class="ad">buy</div><article><p>x</p><form>send</form></article></form>', "x"),
    ('<form><p>the whole text of the page</p><div class=nav>menu</div></form>', "the whole text of the page"),
    ("<p data-x=it's>Text</p>", "Text"), ('<p title="5" tall">Text', "Text"), ("<p a=\"b'>c\">x", "x"),
    ('<div class="comments-open"><article>a</article></div><div class="comment-list">' + "long " * 90 + "</div>", "a"),
])
def test_noise_names_lose_no_article(page, text):
    assert s.Page(page).text() == text


def test_hostile_nesting_takes_linear_time():
    def seconds(n):
        began = time.process_time()
        s.Page("<td><table>" + "<div>" * n + "<td>x</td>" * n)
        return time.process_time() - began

    small = min(seconds(4000) for _ in range(3))
    assert min(seconds(16000) for _ in range(2)) < 8 * small


def test_query_over_whole_pages(spark):
    folder = "/root/testdata/sf0.1"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = QUERIES["op2_html_extraction"](spark, folder).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*)</article>", pages[r["page_id"]]["html"], re.S).group(1)
        want = " ".join(" ".join(html.unescape(t) for t in re.split(r"<[^>]*>", article)).split())
        assert r["text"] == want and r["n_chars"] == len(want) and r["url"] == pages[r["page_id"]]["url"]


def test_edge_cases(spark):
    rows = [(1, None, None), (2, "no host", ""), (None, None, "<p>a</p>"), (3, "http://x/", "<p>b</p>"), (3, "http://x/", "<p>b</p>"),
            (4, "http://x/", "<p>" + "w" * 400000)]
    pages = spark.createDataFrame(rows, PAGES).selectExpr("*", "'mine' as Text", "1 as host", "2 as rows", "3 as noise", "4 as given")
    got = s.extract(pages)
    assert got.columns == ["page_id", "url", "html", "host", "rows", "noise", "given", "text"]
    assert sorted((str(r["page_id"]), r["text"][:5], r["host"]) for r in got.collect()) == [
        ("1", "", 1), ("2", "", 1), ("3", "b", 1), ("3", "b", 1), ("4", "wwwww", 1), ("None", "a", 1)]
    assert s.extract(pages.where("false")).count() == 0
    assert s.extract(pages, name="html").columns == ["page_id", "url", "Text", "host", "rows", "noise", "given", "html"]
