"""Page lines to graph tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygraph.functions import page_title, wiki_links


def parse_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """``(title, links)`` for every line; blank lines have a null title.

    Blank lines are kept because they count in the number of lines that sets the
    initial rank, so one parsed table serves for that number, the pages and the links.
    """
    line = F.col(line_col)
    return lines.select(
        F.when(line != "", page_title(line)).alias("title"),
        F.when(line != "", wiki_links(line)).alias("links"),
    )


def parse_pages(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """``(title, links)`` of the non-blank lines; a title may occur on several lines."""
    return parse_lines(lines.where(F.col(line_col) != ""), line_col)


def page_links(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """``(title, link)``, one row per link of the non-blank lines.

    Title and links are parsed once a line, before the explode. Next to the explode, Spark would
    search the title in every row of a link; a plain explode of the parsed column would make it
    parse the links again in a filter on their number. No link is null.
    """
    pages = parse_pages(lines, line_col)
    return pages.select("title", F.explode_outer("links").alias("link")).where(F.col("link").isNotNull())


def page_nodes(pages: DataFrame) -> DataFrame:
    """``(id)``: the distinct titles."""
    return pages.where(F.col("title").isNotNull()).select(F.col("title").alias("id")).distinct()


def links_to_edges(pages: DataFrame) -> DataFrame:
    """``(src, dst, multiplicity)``.

    Links of equal titles are pooled, repeated links counted, links to unknown
    pages and to the page itself kept.
    """
    return count_links(pages.select("title", F.explode("links").alias("link")))


def count_links(links: DataFrame) -> DataFrame:
    """``links_to_edges`` for the rows of ``page_links``."""
    ends = links.select(F.col("title").alias("src"), F.col("link").alias("dst"))
    return ends.groupBy("src", "dst").agg(F.count("*").alias("multiplicity"))


def out_degree(edges: DataFrame) -> DataFrame:
    """``(src, out_degree)``: links per page, repeats and unknown targets included."""
    return edges.groupBy("src").agg(F.sum("multiplicity").alias("out_degree"))
