"""Inputs that Spark derives from the test tables."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygraph.operators.skew import shuffle_partitions
from tallygraph.sources import read_table, spread_small

# Order lines of a task, on average.
TASK_LINES = 250_000


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", *columns)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_small(table(spark, sf_dir, "documents", "doc_id", "text"))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many rows per document: the turns of a conversation are one text."""
    return spread_small(table(spark, sf_dir, "conversations", "conv_id", "text"))


def html_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "html")
    return pages.select("page_id", F.explode(F.split("html", "\n")).alias("value"))


def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order line with the part on the next line of its order."""
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    lines = table(
        spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus"
    )
    # These rows are short, but the pages made of them are not: a task gets few, whatever the size of
    # the table and of a shuffle partition. Their number is in the footers of the files.
    tasks = max(shuffle_partitions(spark), -(-lines.count() // TASK_LINES))
    return lines.repartition(tasks, "l_orderkey").withColumn("next_part", F.lead("l_partkey").over(order))


def basket_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(src, dst, multiplicity)``: which part follows which in an order."""
    steps = baskets(spark, sf_dir).where(F.col("next_part").isNotNull())
    pairs = steps.select(F.col("l_partkey").alias("src"), F.col("next_part").alias("dst"))
    return pairs.groupBy("src", "dst").agg(F.count("*").alias("multiplicity"))


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part", "p_partkey").withColumnRenamed("p_partkey", "id")


def wiki_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page dump made of the tables, one page per line.

    A part's page is split over its order lines and links to suppliers, to the next
    part and to order pages that do not exist. Suppliers link to nations, nations to
    themselves and to missing pages, customers to nothing. Regions have no title,
    orders are blank lines.
    """
    followed = F.when(
        F.col("next_part").isNotNull(), F.concat(F.lit("[[Part "), F.col("next_part"), F.lit("]] "))
    ).otherwise("")
    part = F.concat(
        F.lit("<page><title> Part "),
        F.col("l_partkey"),
        F.lit(' </title><text xml:space="preserve">of [[Supplier '),
        F.col("l_suppkey"),
        F.lit("]] "),
        followed,
        F.lit("[[]] [[ ]] [[ Order "),
        F.col("l_orderkey"),
        F.lit("|"),
        F.col("l_linestatus"),
        F.lit(" ]]</text></page>"),
    )
    supplier = F.concat(
        F.lit("<title>Supplier "),
        F.col("s_suppkey"),
        F.lit("</title><text>[[Nation "),
        F.col("s_nationkey"),
        F.lit("]]</text> [[Part 1]]"),
    )
    nation = F.concat(
        F.lit("<title>Nation "),
        F.col("n_nationkey"),
        F.lit("</title><text>[[Nation "),
        F.col("n_nationkey"),
        F.lit("]] [[Region:[["),
        F.col("n_regionkey"),
        F.lit("]] x]] [[Part "),
        F.col("n_nationkey"),
        F.lit("]]</text>"),
    )
    region = F.concat(F.lit("untitled <text>[[Nation "), F.col("r_regionkey"), F.lit("]]</text>"))
    customer = F.concat(F.lit("<title>Customer "), F.col("c_custkey"), F.lit("</title>"))
    sources = [
        baskets(spark, sf_dir).select(part.alias("value")),
        table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey").select(supplier.alias("value")),
        table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey").select(nation.alias("value")),
        table(spark, sf_dir, "region", "r_regionkey").select(region.alias("value")),
        table(spark, sf_dir, "customer", "c_custkey").select(customer.alias("value")),
        table(spark, sf_dir, "orders", "o_orderkey").select(F.lit("").alias("value")),
    ]
    lines = sources[0]
    for source in sources[1:]:
        lines = lines.unionAll(source)
    return lines


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem", "l_extendedprice", "l_quantity", "l_discount", "l_tax")
