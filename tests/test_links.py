import pytest

from tallygraph.operators import links_to_edges, out_degree, page_links, page_nodes, parse_lines, parse_pages

LINES = [
    '<title> A&amp;B </title><text xml:space="preserve">x [[C]] [[ D|lbl ]] [[]] [[ ]] [[C]] [[F:[[G]] z]]</text>',
    "no title [[Z]]",
    "",
    "<title>C</title><text>[[A]]</text>",
]


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame([(line,) for line in LINES], "value string")


def links_of(spark, line):
    (page,) = parse_pages(spark.createDataFrame([(line,)], "value string")).collect()
    return page.title, page.links


def test_pages(lines):
    assert {(p.title, tuple(p.links)) for p in parse_pages(lines).collect()} == {
        ("A&amp;B", ("C", "D|lbl", "C", "F:G")),
        ("null", ()),
        ("C", ("A",)),
    }


def test_blank_lines_stay_countable(lines):
    parsed = parse_lines(lines)
    assert parsed.count() == 4
    assert parsed.where("title IS NULL").count() == 1


@pytest.mark.parametrize(
    ("line", "title", "links"),
    [
        ("<title>one</title><title>two</title>", "one", []),
        ("<title></title><text>[[x]]</text>", "null", ["x"]),
        ("<title>  </title>", "", []),
        ("<title>\t\x01t \x1f</title>", "t", []),
        ("[[out]] <title>t</title><text>[[in]]</text><text>[[second]]</text>", "t", ["in"]),
        ("<title>t</title><text [[attr]]>[[in]]</text>", "t", ["attr", "in"]),
        ("<title>t</title><text>[[open", "t", []),
        ("<title>t</title><text>[[a]b]] [[c]]]</text>", "t", ["a]b", "c"]),
        ("<title>t</title><text>[[a###b]] [[c&&&d]] [[e\tf]]</text>", "t", ["a###b", "c&&&d", "e\tf"]),
        ("<title>t</title><text>[[\t]] [[[[x]]]] [[t]] [[t]]</text>", "t", ["x", "t", "t"]),
        ("   ", "null", []),
    ],
)
def test_line_forms(spark, line, title, links):
    assert links_of(spark, line) == (title, links)


def test_edges_pool_equal_titles(spark, rows):
    lines = ["<title>a</title><text>[[b]] [[b]] [[a]]</text>", "<title>a</title><text>[[b]] [[red]]</text>"]
    pages = parse_pages(spark.createDataFrame([(line,) for line in lines], "value string"))
    edges = links_to_edges(pages)
    assert rows(edges) == [("a", "a", 1), ("a", "b", 3), ("a", "red", 1)]
    assert rows(out_degree(edges)) == [("a", 5)]
    assert rows(page_nodes(pages)) == [("a",)]


def test_titles_are_parsed_once_a_line(spark, lines, executed_plan, rows):
    """Not in every row of a link, above the explode."""
    found = page_links(lines)
    assert rows(found) == [("A&amp;B", "C"), ("A&amp;B", "C"), ("A&amp;B", "D|lbl"), ("A&amp;B", "F:G"), ("C", "A")]
    above = executed_plan(found).split("Generate explode")
    assert len(above) == 2 and "regexp_extract" not in above[0] and above[1].count("<title>") == 1
