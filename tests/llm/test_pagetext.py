import html as h
import re
import time
from collections import Counter, defaultdict

import pytest

from tallygraph.llm.pagetext import PageParams, candidates, extract_text, host_of, main_text, page_record, parse


def text_of(html):
    return main_text(parse(html)[0])


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        (None, ""),
        ("plain text", "plain text"),
        ("<p>a<p>b", "a b"),
        ("<p>a <b>b<br>c<p>d</b>e", "a b c de"),
        ("<p>foo<i>bar</i>\n\t baz&nbsp;&amp;&#233;&lt;p&gt;</p>", "foobar baz &é<p>"),
        ("<title>t</title><nav>n</nav><article><h1>A</h1><p>b</p></article><footer>f</footer>", "A b"),
        ("<article><p>x</p><script>var a='<p>';</script><style>p{}</style><!-- c --><aside>y</aside></article>", "x"),
        ("<article><header><h1>T</h1><span>by me</span></header><p>x</p><footer>f</footer></article>", "T x"),
        ("<header><h1>Site</h1></header><main><p>x</p><form>name <input></form></main><div>out</div>", "x"),
        ('<body><div class="cookie-notice">c</div><div id="comments">z</div><div class="content">x</div></body>', "x"),
        ('<article>a</article><article class="comment">b</article>', "a"),
        ("<article>a</article><article>b</article>", "a b"),
        ('<body class="has nav"><p hidden>h</p><p style="display: none">i</p><p>x</p>', "x"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>", "a b c d e"),
        ("<article><p>cut off <b>here &am", "cut off here &am"),
        ("</p></div></article>x</html>", "x"),
        ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep"),
        ("<script>never closed <p>x", ""),
    ],
)
def test_main_text(html, text):
    assert text_of(html) == text


def test_equal_subtrees_have_equal_hashes():
    _, nodes = parse("<body><div> a <b>b</b></div><p>x</p><div>a<b> b</b> </div><div>a<i>b</i></div></body>")
    divs = [n.digest for n in nodes if n.tag == "div"]
    assert divs[0] == divs[1] != divs[2]


def test_candidates_leave_prose_and_most_of_the_page():
    root, nodes = parse("<body><div><div>menu</div><article><p>prose here</p><div>box</div></article></div></body>")
    found = candidates(root, nodes, PageParams())
    assert {n.tag for n in nodes if n.digest in found} == {"div"} and len(found) == 2


def page(host, i, body, box="Buy our<br>things"):
    html = f"<body><div>{box}</div><article><h1>Title {i}</h1><p>{body}</p><div>Join the club</div><p>Said often.</p></article></body>"
    return (i, f"http://{host}/p{i}", html)


def test_site_templates_go(spark):
    rows = [page("a.example.com", i, f"Own text {i}.") for i in range(6)]
    rows += [page("b.example.com", 10 + i, f"Own text {i}.") for i in range(2)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in extract_text(docs).collect()}
    # On many pages of its host the box goes; on few it stays. Prose stays however often it occurs.
    assert all(got[i] == f"Title {i} Own text {i}. Said often." for i in range(6))
    assert all(got[10 + i] == f"Title {10 + i} Own text {i}. Join the club Said often." for i in range(2))


def test_blocks_of_an_article_stay(spark):
    lists = "<ul><li>Salt</li></ul><table><tr><td>12</td></tr></table><figure>Map</figure><section>Note</section><div>Figure 1</div>"
    rows = [
        (i, "http://d.example.com/", f"<p>Said twice</p><article><h1>T {i}</h1><p>Own text {i}.</p><p>Said twice</p>{lists if i < 12 else lists[:-19]}</article>")
        for i in range(40)
    ]
    got = {r.page_id: r.text for r in extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    # Lists and tables stay on any number of pages, a box on 12 pages out of 40.
    for i, text in got.items():
        assert text == f"T {i} Own text {i}. Said twice Salt 12 Map Note" + " Figure 1" * (i < 12)


def test_templates_are_shares_of_a_host(spark):
    rows = [(i, "http://e.example.com/", f"<div>Top {i < 6}</div><div>Body {i} with more words</div>") for i in range(40)]
    got = {r.page_id: r.text for r in extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == ("Top True " if i < 6 else "") + f"Body {i} with more words" for i in range(40))


def test_templates_outside_of_articles(spark):
    rows = [(i, "//H.example.com:80/x", f"<div>Top stuff</div><div>Body {i} with more words</div>") for i in range(5)]
    got = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(r.text for r in got) == [f"Body {i} with more words" for i in range(5)]


def test_copies_of_a_page_make_no_template(spark):
    html = "<div>One part</div><div>Other part</div><div>Third part</div>"
    rows = [(i, "http://c.example.com/", html) for i in range(8)] + [(None, None, None), (1, None, ""), (9, "odd", html)]
    got = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(r.text for r in got) == ["", ""] + ["One part Other part Third part"] * 9
    assert all(r.n_chars == len(r.text) for r in got)


@pytest.mark.parametrize(
    "body",
    [
        "<article><h1>Title</h1><div>One part of it</div><div>Other part</div><div>Third part</div></article>",
        "<div><article><div>One part of it</div><div>Other part</div></article></div>",
        "<div><p>One part of it</p><p>Other part</p></div><p>Third part</p>",
        "<main><div><p>One part of it</p><p>Other part</p></div></main>",
    ],
)
@pytest.mark.parametrize(
    "differing",
    [
        "<script>var long = 'longer than all of the text of this page, again and again'; track({})</script>",
        "<nav><ul><li>Home</li><li>Menu {}</li></ul></nav>",
        "<title>Page {}</title>",
        "<ul><li>Menu {}</li></ul>",
    ],
)
def test_near_copies_stay_whole(spark, body, differing):
    rows = [(i, "http://f.example.com/", f"<body>{differing.format(i)}{body}</body>") for i in range(8)]
    got = {r.page_id: r.text for r in extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: text_of(html) for i, _, html in rows}


def test_scripts_are_no_share_of_the_text():
    root, nodes = parse(f"<script>{'x' * 99}</script><div>most of the text</div><div>rest</div>")
    assert len(candidates(root, nodes, PageParams())) == 1


def test_what_is_around_an_article_is_no_template():
    root, nodes = parse(f"<div><div><article>short</article></div></div><div>box</div><div>{'long ' * 9}</div>")
    found = candidates(root, nodes, PageParams())
    assert [n.parts for n in nodes if n.digest in found] == [["box"]]


def test_long_page_and_empty_table(spark):
    long = "<article>" + "<p>word</p>" * 20_000 + "</article>"
    pages = spark.createDataFrame([(1, "u", long)], "page_id long, url string, html string")
    assert extract_text(pages).first().n_chars == 5 * 20_000 - 1
    assert extract_text(pages.limit(0)).collect() == []


def test_hosts(spark):
    urls = ["http://A.b:8/x", "https://u:p@c.d?q", "//e.f#g", "no url", "", None]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(host_of(df.u)).collect()] == ["a.b", "c.d", "e.f", "no url", "", ""]


def article_text(source):
    inner = re.search(r"<article>(.*?)</article>", source, re.S).group(1)
    inner = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", " ", inner))
    return " ".join(h.unescape(inner).split())


def test_frames_go_by_shape_alone(spark):
    """Without any list of names: menus, adverts and footers whose texts all differ."""
    body = "<h1>Title {0}</h1><p>The text of page {0} is longer than what is around it.</p><p>Second paragraph {0}</p>"
    frame = "<nav><ul>" + "<li><a href='/{0}'>To {0}</a></li>" * 3 + "</ul></nav><div class='box b{0}'>Buy {0}</div><div>{1}</div><footer>Site {0}</footer>"
    rows = [(i, "http://a.example.com/", frame.format(i, body.format(i))) for i in range(8)]
    rows += [(10 + i, "http://b.example.com/", frame.format(i, body.format(i))) for i in range(3)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in extract_text(docs, params=PageParams(by_name=False)).collect()}
    for i in range(8):
        assert got[i].text == text_of(body.format(i)) and (got[i].n_by_text, got[i].n_by_shape, got[i].n_by_name) == (0, 3, 0)
    # Three pages are too few to tell.
    assert all(got[10 + i].text == text_of(f"To {i} " * 3 + f"Buy {i} " + body.format(i) + f" Site {i}") for i in range(3))


def test_named_boxes_of_text_stay(spark):
    """Where the article is made of named boxes that stand in no other, their shape takes none of them."""
    rows = [(i, "u", "".join(f"<div class=para>Own text {i} {k}</div>" for k in range(i % 5 + 2))) for i in range(20)]
    got = {r.page_id: r.text for r in extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: text_of(source) for i, _, source in rows}


@pytest.mark.parametrize("by_name", [True, False])
def test_counts_of_the_table_by_brute_force(spark, by_name):
    """Templates found again by plain counting in Python, and the blocks that they take."""
    params = PageParams(by_name=by_name)
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = {r.page_id: (r.url.split("/")[2].lower(), page_record(r.html, params), r.html) for r in pages.collect()}
    mains, seen = defaultdict(set), defaultdict(set)
    for host, (main, marks, _), _ in rows.values():
        mains[host].add(main)
        for m in marks:
            for digest in {m.by_text, m.by_shape} - {None}:
                seen[host, digest].add(main)
    often = {key for key, on in seen.items() if len(on) >= 5 and len(on) >= 0.5 * len(mains[key[0]])}
    assert often
    got = {r.page_id: r for r in extract_text(pages, params=params).collect()}
    assert len(got) == len(rows)
    for i, (host, (_, marks, _), source) in rows.items():
        gone = []
        for m in marks:
            around = m.up >= 0 and gone[m.up]
            gone.append(around or ("shape" if (host, m.by_shape) in often else "text" if (host, m.by_text) in often else ""))
        outer = Counter(g for g, m in zip(gone, marks) if g and not (m.up >= 0 and gone[m.up]))
        assert (got[i].n_by_shape, got[i].n_by_text) == (outer["shape"], outer["text"])
        assert got[i].text == article_text(source)


@pytest.mark.parametrize(
    "source",
    [
        "<div>" * 50_000 + "deep" + "</div>" * 50_000,
        "<nav>menu" + "<div>x" * 50_000,
        "<b>" * 50_000 + "</i>" * 50_000 + "<p>deep",
        "<article>" + "<section>a" * 50_000,
    ],
    ids=["closed", "open", "inline", "sections"],
)
def test_deep_pages(source):
    start = time.perf_counter()
    _, marks, parts = page_record(source, PageParams())
    assert time.perf_counter() - start < 10
    assert len(marks) <= 50_001 and len(parts) <= 50_001


def test_clashing_columns_and_repeated_rows(spark):
    row = (1, "http://a/x", "<p>one</p>", 7, "often", [1], 3)
    docs = spark.createDataFrame([row, row, (1, None, None, 7, None, None, None)], "page_id long, url string, html string, host long, often string, up array<int>, main_key long")
    got = extract_text(docs).collect()
    assert sorted((r.page_id, r.text) for r in got) == [(1, ""), (1, "one"), (1, "one")]


def test_articles_of_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in extract_text(pages).collect()}
    for r in pages.collect():
        assert got[r.page_id] == article_text(r.html)
