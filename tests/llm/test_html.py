"""HTML extraction: matching against the plain recurrence, templates, broken and odd pages."""

import random
import re
from html import unescape
from pathlib import Path

import pytest
from surveyloom.llm import html_extract as hx

SF_DIR = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, host string, template string"


def text_of(html):
    page = hx.parse(html)
    return hx.content(page, frozenset(), [-1] * len(page.labels))


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b<b>c</b>", "a bc"),
        ("<p>one <i>t</i>wo<br>three</p>", "one two three"),
        ("a&nbsp;b &#65;&lt;p&gt;", "a b A<p>"),
        ("<nav>menu</nav><div>x</div><footer>f</footer>", "x"),
        ("<div>out</div><article><h1>T</h1><p>in</p></article>", "T in"),
        ("<article><header><h1>T</h1></header>in</article><header>page</header>", "T in"),
        ("<script>var t='</p><p>';</script>x<style>p{}</style><!-- <p>no</p> -->y", "x y"),
        ("<article>a<section class='comments'><p>no</p></section></article>", "a"),
        ("<div class='cookie-notice'>c</div><div id='sidebar'>s</div><form>f</form>t", "t"),
        ("<div class='ad'>a</div><div role=navigation>n</div><div class=gradient>g</div>", "g"),
        ("<ul><li>a<li>b</ul><table><tr><td>1<td>2</table>", "a b 1 2"),
        ("1 < 2 and 3 <4 <", "1 < 2 and 3 <4 <"), ("<p title='a>b'>x</p>", "x"),
        ("<a href='q\">x", "<a href='q\">x".replace("<a href='q\">", "")), ("<!-- open", ""),
        ("x<script>open", "x"), ("</div></p>z", "z"), ("<div hidden>h</div>s", "s"),
    ],
)
def test_pages(html, text):
    assert text_of(html) == text


def test_broken_markup_takes_linear_time():
    import time

    start = time.perf_counter()
    for html in ('<a "' * 50_000, "<" * 200_000, "<div>" * 100_000, "<!--" * 50_000, "</" * 99_999):
        page = hx.parse(html)
        hx.collapse(page)
    assert time.perf_counter() - start < 15


def brute_match(a, b, x=0, y=0):
    if a.labels[x] != b.labels[y]:
        return 0
    left = [i for i, p in enumerate(a.parents) if p == x]
    right = [i for i, p in enumerate(b.parents) if p == y]
    table = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    for i, m in enumerate(left, 1):
        for j, n in enumerate(right, 1):
            table[i][j] = max(table[i - 1][j], table[i][j - 1],
                              table[i - 1][j - 1] + brute_match(a, b, m, n))
    return 1 + table[-1][-1]


def test_alignment_matches_as_many_nodes_as_possible():
    rng = random.Random(2)

    def tree():
        labels, parents = ["r"], [-1]
        for _ in range(rng.randint(0, 14)):
            parents.append(rng.randrange(len(labels)))
            labels.append(rng.choice("abc"))
        order, todo = [], [0]
        while todo:
            node = todo.pop()
            order.append(node)
            todo += [i for i, p in reversed(list(enumerate(parents))) if p == node]
        place = {n: i for i, n in enumerate(order)}
        return hx.Tree([labels[n] for n in order],
                       [place.get(parents[n], -1) for n in order], [0] * len(order))

    for _ in range(300):
        a, b = tree(), tree()
        pairs = hx.align(a, b)
        assert len(pairs) == brute_match(a, b)
        assert len({x for x, _ in pairs}) == len(pairs) == len({y for _, y in pairs})
        assert all(a.labels[x] == b.labels[y] for x, y in pairs)


def page(notice, head, *paragraphs):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return f"<body><div class=x1>{notice}</div><div class=x2><h1>{head}</h1>{body}</div></body>"


def test_constant_slots_are_template_and_varying_ones_content(spark):
    rows = [(i, f"http://h.x/{i}", page("We use crumbs.", "Head", f"Text {i}", f"more {i}"))
            for i in range(12)]
    # The same notice twice only, and a page alone on its host: nothing to tell it is one.
    rows += [(100 + i, f"http://two.x/{i}", page("Notice", "H", f"t{i}")) for i in range(2)]
    rows += [(200, "http://one.x/", page("Notice", "H", "t"))]
    # Copies of one page say nothing about its template.
    rows += [(300 + i, f"http://copy.x/{i}", page("Intro", "H", "same")) for i in range(9)]
    rows += [(None, None, None), (400, "http://h.x/1", ""), (401, "no url", "<p>x</p>"), rows[0]]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES)
    found = {r.page_id: r for r in hx.extract_text(pages).collect()}
    assert hx.extract_text(pages).count() == len(rows)
    for i in range(12):
        assert found[i].text == f"Head Text {i} more {i}"
    assert found[100].text == "Notice H t0" and found[200].text == "Notice H t"
    assert found[303].text == "Intro H same"
    assert (found[None].text, found[400].text, found[401].text) == ("", "", "x")
    assert all(r.n_chars == len(r.text) for r in found.values())
    assert hx.extract_text(pages.where("false")).count() == 0


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    found = {r.page_id: r.text for r in hx.extract_text(pages).collect()}
    for row in pages.collect():
        article = re.search(r"<article>(.*?)</article>", row.html, re.S).group(1)
        expected = " ".join(unescape(re.sub(r"<[^>]*>", " ", article)).split())
        assert found[row.page_id] == expected


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<div style='overflow:hidden'>t</div>", "t"), ("<div class='overflow-hidden'>t</div>", "t"),
        ("<div aria-hidden='false'>t</div>", "t"), ("<div data-x='hidden'>t</div>", "t"),
        ("<body class='no-sidebar comments-open modal-open header-fixed search'>t</body>", "t"),
        ("<main class='has-sidebar with-banner'>t</main>", "t"), ("<div id=content-sidebar>t</div>", "t"),
        ("<article class='comments-open has-header'>t</article>", "t"),
        ("<div aria-hidden=true>h</div><p style='color:red; display: none'>h</p>t", "t"),
        ("<div class='x main-nav'>n</div><div class='site-footer'>f</div><div HIDDEN=''>h</div>t", "t"),
    ],
)
def test_states_and_real_attributes(html, text):
    assert text_of(html) == text


def test_deep_elements_close_themselves_only():
    deep = "<div>" * 200 + "deep" + "</div>" * 200
    assert text_of(f"<div id=page><article>{deep}after</article></div>out") == "deep after"
    left_out = "<div>" * 200 + "<nav>menu</nav>t" + "</div>" * 200
    assert text_of(left_out + "z") == "t z"
    tree = hx.collapse(hx.parse("<div>" * 5000 + "x"))[0]
    assert len(hx.align(tree, tree)) == 5001


@pytest.mark.parametrize("rowwise", [4096, 0])
def test_wide_nodes_are_aligned_exactly(rowwise, monkeypatch):
    monkeypatch.setattr(hx, "ROWWISE", rowwise, raising=False)
    parts = [f"<{tag}><h2>x</h2></{tag}>" for tag in ("div", "section")] * 250
    a = hx.collapse(hx.parse("".join(parts)))[0]
    b = hx.collapse(hx.parse("<p>new</p>" + "".join(parts)))[0]
    assert len(hx.align(a, b)) == len(a.labels) == len(b.labels) - 1
    test_alignment_matches_as_many_nodes_as_possible()


def test_two_layouts_of_one_host(spark):
    def one(i):
        side = f"<div class=layout-a><div>Notice of A</div><p>A {i}</p><p>x{i}</p></div>"
        other = f"<div class=layout-b><h2>B {i}</h2><p>b{i}</p><div>Notice of B</div></div>"
        return f"<body class=category-{i % 7}>{side if i % 2 else other}</body>"

    rows = [(i, f"http://h.x/{i}", one(i), "", "") for i in range(24)]
    found = {r.page_id: r.text for r in hx.extract_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert found == {i: f"A {i} x{i}" if i % 2 else f"B {i} b{i}" for i in range(24)}


def test_names_that_follow_sections_do_not_hide_the_template(spark):
    rows = [
        (i, f"http://h.x/{i}", f"<div class='section-{'abcdefgh'[i % 8]}{'klm'[i % 3]}'><p>Text {i}</p>"
         f"<div class=x{'pqrst'[i % 5]}>Subscribers only.</div></div>", "", "")
        for i in range(20)
    ]
    found = {r.page_id: r.text for r in hx.extract_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert found == {i: f"Text {i}" for i in range(20)}


def test_template_inside_articles_goes(spark):
    rows = [
        (i, f"http://h.x/{i}", f"<article><p>Text {i}</p><div>Reprints need our leave.</div></article>", "", "")
        for i in range(9)
    ]
    found = {r.page_id: r.text for r in hx.extract_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert found == {i: f"Text {i}" for i in range(9)}


def test_slots_missing_in_the_first_page_are_grown(spark):
    rows = [
        (i, f"http://h.x/{i}", f"<div><p>T{i}</p>"
         + ("<div>We use crumbs.</div>" if i % 3 else "") + f"<h3>s{i}</h3><p>U{i}</p></div>", "", "")
        for i in range(30)
    ]
    found = {r.page_id: r.text for r in hx.extract_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert found == {i: f"T{i} s{i} U{i}" for i in range(30)}


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<form id=f><input type=hidden><div>menu</div><article><p>t</p><input></article></form>", "t"),
        ("<form><input type=hidden name=v><p>a long text</p></form><p>b</p>", "a long text b"),
        ("<form>b</form><p>a</p>", "a"), ("<form></form>", ""),
        ("<form><input><p>whole page of text</p></form><p>b</p>", "whole page of text b"),
        ("<p>a long text of a page</p><form>Name <input type=text></form>", "a long text of a page"),
        ("<p>long enough text</p><form>say <textarea></textarea></form>", "long enough text"),
        ("<p>long enough text</p><form><main><p>m</p></main><select></select></form>", "m"),
    ],
)
def test_forms(html, text):
    assert text_of(html) == text


def test_wide_pages_take_little_memory():
    import time
    import tracemalloc

    parts = [f"<{t}><h2>x</h2><p>{i}</p></{t}>" for i in range(17_000) for t in ("div", "section")]
    html = "".join(parts)
    assert len(html) > 1_000_000
    other = html.replace("<section><h2>x</h2><p>77</p></section>", "<ul><li>new</ul>") + "<ol><li>z</ol>"
    start = time.perf_counter()
    tracemalloc.start()
    a, b = hx.collapse(hx.parse(html))[0], hx.collapse(hx.parse("<p>first</p>" + other))[0]
    tracemalloc.reset_peak()
    pairs = hx.align(a, b)
    peak = tracemalloc.get_traced_memory()[1] - 0
    tracemalloc.stop()
    assert len(pairs) == len(a.labels) - 3
    assert peak < 400e6 and time.perf_counter() - start < 120


def test_divided_lists_match_as_well(monkeypatch):
    monkeypatch.setattr(hx, "TABLE", 1)
    test_alignment_matches_as_many_nodes_as_possible()


def test_growing_keeps_both_trees():
    a = hx.collapse(hx.parse("<div>1</div><p>2</p><ul><li>3</ul>"))[0]
    b = hx.collapse(hx.parse("<h1>0</h1><div>1<section>5</section></div><ul><li>4</ul><ol><li>6</ol>"))[0]
    both = hx.grow(a, b)
    assert both.labels == ["#", "h1", "div", "section", "p", "ul", "li", "ol", "li"]
    assert len(hx.align(both, a)) == len(a.labels) and len(hx.align(both, b)) == len(b.labels)


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
def test_given_pages_without_their_articles(spark):
    """The mark-up alone gives the text away; most pages must come out right without it."""
    from pyspark.sql import functions as F

    pages = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/pages.parquet")
    bare = pages.withColumn("html", F.regexp_replace("html", r"<(/?)article", "<$1div"))
    with_articles = {r.page_id: r.text for r in hx.extract_text(pages).collect()}
    found = {r.page_id: r.text for r in hx.extract_text(bare).collect()}
    right = sum(found[i] == text for i, text in with_articles.items())
    assert right >= 0.95 * len(found)
