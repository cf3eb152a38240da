from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygraph.operators import links_to_edges, page_nodes, pagerank, parse_lines
from tallygraph.operators.rank import DAMPING, ITERATIONS
from tallygraph.operators.skew import HEAVY_ROWS
from tallygraph.staging import staging


def rank_lines(
    lines: DataFrame,
    n: int | None = None,
    damping: float = DAMPING,
    iterations: int = ITERATIONS,
    line_col: str = "value",
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """``(id, rank)`` of the pages in a dump with one page per line.

    ``n`` defaults to the number of lines, blank ones included. The dump is parsed
    once, into a staged table that gives the line count, the pages and the links.
    """
    with staging(lines.sparkSession) as area:
        parsed = area.table(parse_lines(lines, line_col), "parsed", "zstd")
        pages = parsed.where(F.col("title").isNotNull())
        start = parsed.count() if n is None else n
        return pagerank(page_nodes(pages), links_to_edges(pages), start, damping, iterations, heavy_rows)
