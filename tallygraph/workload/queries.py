"""One entry per operator. Doubles are rounded here, never in the library, so that
the last digits of a sum do not decide a comparison."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph import operators as op
from tallygraph.functions import page_title
from tallygraph.operators.skew import join_spread
from tallygraph.plans import count_words, fit_csv, rank_lines, score_documents, search_documents
from tallygraph.sources import (
    bad_csv_rows,
    read_betas,
    read_documents,
    read_lines,
    read_ranked,
    read_scores,
    write_betas,
    write_named,
    write_ranked,
    write_scores,
    write_tsv,
)
from tallygraph.staging import checkpoint_root, staging
from tallygraph.workload.inputs import (
    basket_edges,
    conversations,
    documents,
    html_lines,
    parts,
    prices,
    table,
    wiki_lines,
)

# Terms of the search queries.
TERMS = ["the", "With", "der", "the"]
FEATURES = ["l_quantity", "l_discount", "l_tax"]
GROUPS = 15


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def rounded(name: str, digits: int = 6) -> Column:
    return F.round(F.col(name), digits).alias(name)


def rounded_ranks(ranks: DataFrame) -> DataFrame:
    return ranks.select("id", rounded("rank"))


def one_row(spark: SparkSession, name: str, value: int) -> DataFrame:
    return spark.createDataFrame([(value,)], f"{name} bigint")


# Text retrieval


@query
def corpus_size(spark, sf_dir):
    return one_row(spark, "n_docs", op.corpus_size(table(spark, sf_dir, "documents", "doc_id")))


@query
def tokenize(spark, sf_dir):
    return op.tokenize(documents(spark, sf_dir))


@query
def doc_word_count(spark, sf_dir):
    return count_words(documents(spark, sf_dir), one_row_per_doc=True)


@query
def conversation_word_count(spark, sf_dir):
    return op.word_count(op.tokenize(conversations(spark, sf_dir), "conv_id"))


@query
def term_frequency(spark, sf_dir):
    return op.term_frequency(count_words(documents(spark, sf_dir), one_row_per_doc=True)).select("word", "doc_id", rounded("tf"))


@query
def document_frequency(spark, sf_dir):
    return op.document_frequency(count_words(documents(spark, sf_dir), one_row_per_doc=True))


@query
def inverse_document_frequency(spark, sf_dir):
    docs = documents(spark, sf_dir)
    frequencies = op.document_frequency(count_words(docs, one_row_per_doc=True))
    return op.inverse_frequency(frequencies, op.corpus_size(docs)).select("word", "df", rounded("idf"))


@query
def tfidf(spark, sf_dir):
    return score_documents(documents(spark, sf_dir), one_row_per_doc=True).select("word", "doc_id", rounded("tfidf"))


@query
def conversation_tfidf(spark, sf_dir):
    scores = score_documents(conversations(spark, sf_dir), id_col="conv_id")
    return scores.select("word", "doc_id", rounded("tfidf"))


@query
def search_any(spark, sf_dir):
    return search_documents(documents(spark, sf_dir), TERMS).select("doc_id", rounded("score"))


@query
def search_by_document(spark, sf_dir):
    docs = conversations(spark, sf_dir)
    counts = op.word_count(op.tokenize(docs, "conv_id"))
    hits = op.search_counts(counts, ["que", "la"], op.corpus_size(docs, "conv_id"))
    return hits.select("doc_id", rounded("score")).orderBy("doc_id")


@query
def search_top(spark, sf_dir):
    hits = search_documents(documents(spark, sf_dir), TERMS).select("doc_id", rounded("score"))
    return hits.orderBy(F.col("score").desc(), "doc_id").limit(10)


@query
def search_term_table(spark, sf_dir):
    """The terms are the words of another table."""
    terms = op.tokenize(table(spark, sf_dir, "benchmark", "item_id", "text"), "item_id")
    hits = op.search(score_documents(documents(spark, sf_dir), one_row_per_doc=True), terms.select(F.upper("word").alias("term")))
    return hits.select("doc_id", rounded("score"))


@query
def search_stored_scores(spark, sf_dir):
    """Scores written to a table once, then searched there."""
    checkpoint_root(spark)
    with staging(spark) as area:
        write_scores(score_documents(documents(spark, sf_dir), one_row_per_doc=True), area.path("scores"))
        hits = op.search(read_scores(spark, area.path("scores"), "bigint"), ["les", "und", "that"])
        return hits.select("doc_id", rounded("score")).checkpoint()


# Link analysis


@query
def page_titles(spark, sf_dir):
    titles = html_lines(spark, sf_dir).select("page_id", page_title(F.col("value")).alias("title"))
    return titles.where(F.col("title") != "null")


@query
def line_count(spark, sf_dir):
    return wiki_lines(spark, sf_dir).agg(F.count("*").alias("n_lines"))


@query
def page_links(spark, sf_dir):
    return op.page_links(wiki_lines(spark, sf_dir))


@query
def page_nodes(spark, sf_dir):
    return op.page_nodes(op.parse_pages(wiki_lines(spark, sf_dir)))


@query
def link_edges(spark, sf_dir):
    return op.count_links(op.page_links(wiki_lines(spark, sf_dir)))


@query
def link_out_degree(spark, sf_dir):
    return op.out_degree(op.count_links(op.page_links(wiki_lines(spark, sf_dir))))


@query
def known_links(spark, sf_dir):
    """Links whose target is a page of the dump."""
    checkpoint_root(spark)
    with staging(spark) as area:
        pages = area.table(op.parse_pages(wiki_lines(spark, sf_dir)), "pages")
        edges = area.table(op.links_to_edges(pages), "edges")
        known = join_spread(edges, op.page_nodes(pages).toDF("dst"), "dst", "left_semi")
        return known.select("src", "dst", "multiplicity").checkpoint()


@query
def initial_rank(spark, sf_dir):
    lines = wiki_lines(spark, sf_dir)
    return op.initial_ranks(op.page_nodes(op.parse_pages(lines)), lines.count()).select("id", rounded("rank", 12))


@query
def edge_multiplicity(spark, sf_dir):
    return basket_edges(spark, sf_dir)


@query
def out_degree(spark, sf_dir):
    return op.out_degree(basket_edges(spark, sf_dir))


@query
def pagerank_one_step(spark, sf_dir):
    nodes = parts(spark, sf_dir)
    start = op.initial_ranks(nodes, nodes.count())
    return rounded_ranks(op.pagerank_step(start, nodes, basket_edges(spark, sf_dir)))


@query
def pagerank_10(spark, sf_dir):
    return rounded_ranks(op.pagerank(parts(spark, sf_dir), basket_edges(spark, sf_dir)))


@query
def pagerank_top100(spark, sf_dir):
    return op.top_pages(rounded_ranks(op.pagerank(parts(spark, sf_dir), basket_edges(spark, sf_dir))), 100)


@query
def wiki_pagerank(spark, sf_dir):
    return rounded_ranks(rank_lines(wiki_lines(spark, sf_dir)))


@query
def wiki_pagerank_ranked(spark, sf_dir):
    return op.rank_order(rounded_ranks(rank_lines(wiki_lines(spark, sf_dir))))


@query
def wiki_pagerank_text_files(spark, sf_dir):
    """Text in, text out: the dump is read from two folders and the ranking written to files."""
    checkpoint_root(spark)
    with staging(spark) as area:
        lines = wiki_lines(spark, sf_dir)
        linking = F.contains("value", F.lit("[["))
        write_tsv(lines.where(linking), area.path("linking"), compression="gzip")
        write_tsv(lines.where(~linking), area.path("others"), compression="gzip")
        both = read_lines(spark, f"{area.path('linking')},{area.path('others')}")
        write_ranked(rank_lines(both), area.path("ranked"))
        return rounded_ranks(read_ranked(spark, area.path("ranked"))).checkpoint()


# Least squares


@query
def normal_matrix(spark, sf_dir):
    """Per row, as the sums themselves have more digits than a comparison can hold."""
    rows = prices(spark, sf_dir)
    cells = op.normal_matrix(rows, "l_extendedprice", FEATURES)
    return cells.select("row_term", "col_term", F.round(F.col("value") / rows.count(), 4).alias("mean"))


@query
def ols_simple(spark, sf_dir):
    return op.fit_ols(prices(spark, sf_dir), "l_extendedprice", FEATURES[:1]).select("term", rounded("beta"))


@query
def ols_two_features(spark, sf_dir):
    return op.fit_ols(prices(spark, sf_dir), "l_extendedprice", FEATURES[:2]).select("term", rounded("beta"))


@query
def ols_three_features(spark, sf_dir):
    return op.fit_ols(prices(spark, sf_dir), "l_extendedprice", FEATURES).select("term", rounded("beta"))


@query
def ols_from_csv(spark, sf_dir):
    """The response and its features written as plain rows and fitted from the files."""
    with staging(spark) as area:
        rows = prices(spark, sf_dir).select("l_extendedprice", "l_quantity", "l_discount")
        rows.write.csv(area.path("rows"))
        return fit_csv(spark, area.path("rows")).select("term", rounded("beta"))


@query
def ols_stored_betas(spark, sf_dir):
    """Coefficients written to a text file and read back."""
    checkpoint_root(spark)
    with staging(spark) as area:
        write_betas(op.fit_ols(prices(spark, sf_dir), "l_extendedprice", FEATURES), area.path("betas"))
        return read_betas(spark, area.path("betas")).select("term", rounded("beta")).checkpoint()


@query
def ols_group_indicators(spark, sf_dir):
    """Fourteen features, one for each group but the first."""
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_extendedprice")
    marks = [f"g{k}" for k in range(1, GROUPS)]
    design = rows.select(
        "l_extendedprice",
        *[(F.col("l_orderkey") % GROUPS == k).cast("double").alias(name) for k, name in enumerate(marks, 1)],
    )
    return op.fit_ols(design, "l_extendedprice", marks).select("term", rounded("beta", 4))


@query
def ols_nearly_dependent(spark, sf_dir):
    """The quantity far from zero, and the quantity again with a trace of the price: a fit that
    squares the features loses what tells them apart. In units of 1e8, and 1e14 for the intercept."""
    quantity, price = F.col("l_quantity").cast("double"), F.col("l_extendedprice").cast("double")
    rows = prices(spark, sf_dir).select(
        (price * (1 - F.col("l_discount").cast("double"))).alias("revenue"),
        (quantity + 1e6).alias("shifted"),
        (quantity + price * 1e-8).alias("traced"),
    )
    unit = F.when(F.col("term") == "intercept", 1e14).otherwise(1e8)
    found = op.fit_ols(rows, "revenue", ["shifted", "traced"])
    return found.select("term", F.round(F.col("beta") / unit, 6).alias("beta"))


# Files


@query
def bad_csv_records(spark, sf_dir):
    """Rows written as text, some with too few fields or a word among the numbers, and found again."""
    checkpoint_root(spark)
    with staging(spark) as area:
        rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        written = (
            F.when(F.col("l_linenumber") == 2, F.concat_ws(",", "l_orderkey", "l_linenumber"))
            .when(F.col("l_linenumber") == 3, F.concat_ws(",", "l_orderkey", F.lit("none"), "l_linenumber"))
            .otherwise(F.concat_ws(",", "l_orderkey", "l_partkey", "l_suppkey"))
        )
        rows.select(written.alias("value")).write.text(area.path("rows"))
        return bad_csv_rows(spark, area.path("rows"), ["a", "b", "c"]).select("record").checkpoint()


@query
def documents_from_files(spark, sf_dir):
    """Documents written as files in two folders and read back by the names of the files. Files
    of one name in both folders are one document, so the lines of a text come together again."""
    checkpoint_root(spark)
    with staging(spark) as area:
        docs = table(spark, sf_dir, "documents", "lang", "text").where("text IS NOT NULL AND lang IS NOT NULL")
        lines = docs.select("lang", F.posexplode(F.split(F.regexp_replace("text", "\r", " "), "\n")).alias("at", "value"))
        folders = []
        for folder, odd in (("even", 0), ("odd", 1)):
            folders += write_named(lines.where(F.col("at") % 2 == odd), area.path(folder), "lang", "value")
        found = read_documents(spark, folders)
        counts = found.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.sum(F.length("text")).alias("n_chars"))
        return counts.checkpoint()
