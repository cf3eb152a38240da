from pyspark.sql import Column
from pyspark.sql import functions as F

from tallygraph.functions.strings import trim_controls

# The tags of a page line, the link brackets, the name of untitled pages.
TITLE_TAG = r"<title>(.+?)</title>"
TEXT_TAG = r"<text.*?>.*?</text>"
LINK_SPAN = r"\[\[.*?]\]"
LINK_OPEN, LINK_CLOSE = "[[", "]]"
UNTITLED = "null"


def page_title(line: Column) -> Column:
    """First title of the line, trimmed; entities stay encoded.

    The tag body cannot be empty, so an empty extract means "no title"; a title
    of blanks is a title and trims to the empty string. The line is searched once, as its
    extract is an argument.
    """

    def named(title: Column) -> Column:
        return F.when(title == "", F.lit(UNTITLED)).otherwise(trim_controls(title))

    return F.transform(F.array(F.regexp_extract(line, TITLE_TAG, 1)), named)[0]


def wiki_links(line: Column) -> Column:
    """Link targets inside the first text element, in order, repeats kept.

    ``[[A|label]]`` gives ``A|label``; all bracket pairs inside a span go, so
    ``[[F:[[G]]`` gives ``F:G``. Links that are blank after trimming are dropped
    wherever they stand.
    """
    body = F.regexp_extract(line, TEXT_TAG, 0)
    spans = F.regexp_extract_all(body, F.lit(LINK_SPAN), F.lit(0))

    def target(span: Column) -> Column:
        opened = F.replace(span, F.lit(LINK_OPEN), F.lit(""))
        return trim_controls(F.replace(opened, F.lit(LINK_CLOSE), F.lit("")))

    return F.filter(F.transform(spans, target), lambda link: link != "")
