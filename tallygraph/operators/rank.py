"""PageRank with a fixed number of steps, and ranking."""

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph.operators.blocks import BLOCK, TILE_LINKS, constant_vector, number_pages, step, values_of, write_tiles
from tallygraph.operators.skew import (
    HEAVY_ROWS,
    heavy_keys,
    join_salted,
    join_split,
    join_spread,
    key_salts,
    shuffle_partitions,
)
from tallygraph.staging import Staging, checkpoint_root, staging

# Fixed values of the ranking model.
DAMPING = 0.85
ITERATIONS = 10

# Steps run as one job before the ranks are stored.
STEPS_PER_VECTOR = 5


def _received(sent: DataFrame) -> DataFrame:
    """Sums per target, started before the shuffle: a much-linked page arrives as one
    row per task."""
    return sent.groupBy("dst").agg(F.sum(F.col("share") * F.col("multiplicity")).alias("received"))


def _next_ranks(
    pages: DataFrame, contributions: DataFrame, damping: float, key: str = "page"
) -> DataFrame:
    """``rank = (1 - d) + d * sum``; pages without incoming links get ``1 - d``."""
    received = F.coalesce(F.col("received"), F.lit(0.0))
    rank = F.lit(1.0 - damping) + F.lit(damping) * received
    joined = pages.join(contributions.hint("merge"), pages[key] == contributions["dst"], "left")
    return joined.select(*(pages[name] for name in pages.columns), rank.alias("rank"))


def initial_ranks(nodes: DataFrame, n: int) -> DataFrame:
    """``rank = 1 / n`` for every page; ``n`` is the number of input lines, not of pages."""
    return nodes.withColumn("rank", F.lit(1.0 / max(n, 1)))


def pagerank_step(
    ranks: DataFrame,
    nodes: DataFrame,
    edges: DataFrame,
    damping: float = DAMPING,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """One step on plain tables: ``(id, rank)`` to ``(id, rank)``, in one lazy plan.

    Every page splits its rank evenly over its links. Shares for unknown pages are
    lost, and so is the rank of pages without links; ranks are not divided by N.
    The links of a page with very many of them are split over salts.
    """
    # The null checks of both joins are made here, and ``dst`` is read in the sums, so
    # that the two branches scan the same columns and rows.
    links = edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    out_degree = F.sum(F.when(F.col("dst").isNotNull(), F.col("multiplicity"))).alias("out_degree")
    degree = key_salts(links.groupBy("src").agg(out_degree, F.count("*").alias("targets")), "targets", heavy_rows)
    shares = degree.join(ranks, F.col("src") == F.col("id")).select(
        "src", "salts", (F.col("rank") / F.col("out_degree")).alias("share")
    )
    contributions = _received(join_salted(links, shares, degree, "src", "dst"))
    return _next_ranks(nodes.select("id").distinct(), contributions, damping, "id")


def _loop_session(spark: SparkSession) -> SparkSession:
    """A session for the steps, with settings of its own. Their plan is known beforehand, so each job
    runs it whole instead of one job per shuffle; their rows are wide, so few go to Python at once."""
    session = spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        session.conf.set(name, spark.conf.get(name))
    session.conf.set("spark.sql.adaptive.enabled", "false")
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    return session


class _Graph(NamedTuple):
    """A stored graph: pages by number, tiles of links, and the parts of each block's links."""

    pages: DataFrame
    tiles: DataFrame
    parts: DataFrame
    size: int
    table: str


def _lay_out(nodes: DataFrame, edges: DataFrame, area: Staging, heavy_rows: int, session: SparkSession) -> _Graph:
    """Number the pages and store the links as a table of tiles, bucketed for the steps.

    Each link weighs its share of its page's rank. Links to unknown pages count in that share
    but carry rank nowhere, so they are left out. Heavy pages take no shuffle by their id here.
    """
    pages, size = number_pages(nodes, area)
    edges = area.table(edges.select("src", "dst", "multiplicity"), "edges", "zstd")
    total = edges.count()
    degree = edges.groupBy("src").agg(F.sum("multiplicity").alias("out_degree"), F.count("*").alias("targets"))
    sources = area.table(
        degree.join(pages, F.col("src") == F.col("id")).select("src", "page", "out_degree", "targets"), "sources"
    )
    heavy, _ = heavy_keys(sources, "targets", total, heavy_rows)
    known = join_spread(edges, pages.toDF("dst", "dst_page"), "dst", "inner", heavy_rows, total)
    source = sources.select("src", F.col("page").alias("src_page"), "out_degree")
    linked = join_split(known, source, "src", "inner", None if heavy is None else heavy.select("src"))
    links = linked.select(
        F.col("src_page").alias("src"),
        F.col("dst_page").alias("dst"),
        (F.col("multiplicity") / F.col("out_degree")).alias("weight"),
    )
    limit = max(TILE_LINKS, total // shuffle_partitions(edges.sparkSession))
    blocks = sources.groupBy((F.col("page") / BLOCK).cast("long").alias("block")).agg(F.sum("targets").alias("links"))
    # One row per block of pages: a 65,536th of their number.
    parts = [(row["block"], -(-row["links"] // limit)) for row in blocks.collect()]
    buckets = max(1, min(shuffle_partitions(edges.sparkSession), sum(n for _, n in parts)))
    kind, table = "block long, parts int", f"tiles_{uuid.uuid4().hex}"
    write_tiles(links, edges.sparkSession.createDataFrame(parts, kind), buckets, area.path("tiles"), table)
    # As many partitions as buckets, so that the tiles stay where they are.
    session.conf.set("spark.sql.shuffle.partitions", str(buckets))
    return _Graph(pages, session.table(table), session.createDataFrame(parts, kind), size, table)


def pagerank(
    nodes: DataFrame,
    edges: DataFrame,
    n: int | None = None,
    damping: float = DAMPING,
    iterations: int = ITERATIONS,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """``(id, rank)`` after ``iterations`` steps from ``1 / n``.

    ``nodes(id)`` are the known pages, ``edges(src, dst, multiplicity)`` all links.
    ``n`` defaults to the number of known pages. Runs its jobs when called: the graph is staged
    once as a bucketed table of tiles, each step then moves the ranks and the received sums as
    arrays, and the result is a checkpoint that needs none of the working tables. Nothing lives in
    executors alone: a lost one costs the steps since the last stored vector.
    """
    if iterations < 0:
        raise ValueError("iterations must not be negative")
    spark = nodes.sparkSession
    checkpoint_root(spark)
    session = _loop_session(spark)
    with staging(spark) as area:
        graph = _lay_out(nodes, edges, area, heavy_rows, session)
        try:
            ranks = constant_vector(session, graph.size, 1.0 / max(graph.size if n is None else n, 1))
            for done in range(1, iterations + 1):
                ranks = step(graph.tiles, graph.parts, ranks, graph.size, damping)
                if done % STEPS_PER_VECTOR == 0 or done == iterations:
                    ranks = area.table(ranks, f"ranks{done}")
            # In the caller's session, where the result belongs.
            start = constant_vector(spark, graph.size, 1.0 / max(graph.size if n is None else n, 1))
            values = values_of(area.read(f"ranks{iterations}") if iterations else start)
            return graph.pages.join(values, "page").select("id", F.col("x").alias("rank")).checkpoint()
        finally:
            session.sql(f"DROP TABLE IF EXISTS {graph.table}")


def rank_order(ranks: DataFrame) -> DataFrame:
    """Highest rank first, ties by ``id``: a range-partitioned sort in which the
    ``id`` also splits the many pages that share one rank."""
    return ranks.orderBy(F.col("rank").desc(), F.col("id"))


def top_pages(ranks: DataFrame, k: int = 100) -> DataFrame:
    return rank_order(ranks).limit(k)
