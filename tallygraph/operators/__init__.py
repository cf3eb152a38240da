"""DataFrame operators. Each takes and returns DataFrames with typed columns."""

from tallygraph.operators.links import (
    count_links,
    links_to_edges,
    out_degree,
    page_links,
    page_nodes,
    parse_lines,
    parse_pages,
)
from tallygraph.operators.rank import initial_ranks, pagerank, pagerank_step, rank_order, top_pages
from tallygraph.operators.regression import fit_ols, normal_equations, normal_matrix
from tallygraph.operators.retrieval import (
    Corpus,
    corpus_size,
    describe_corpus,
    document_frequency,
    inverse_frequency,
    matching_terms,
    search,
    search_counts,
    term_frequency,
    tfidf,
    tfidf_of_rows,
    tokenize,
    word_count,
    word_count_of_rows,
)

__all__ = [
    "Corpus",
    "corpus_size",
    "count_links",
    "describe_corpus",
    "document_frequency",
    "fit_ols",
    "initial_ranks",
    "inverse_frequency",
    "links_to_edges",
    "matching_terms",
    "normal_equations",
    "normal_matrix",
    "out_degree",
    "page_links",
    "page_nodes",
    "pagerank",
    "pagerank_step",
    "parse_lines",
    "parse_pages",
    "rank_order",
    "search",
    "search_counts",
    "term_frequency",
    "tfidf",
    "tfidf_of_rows",
    "tokenize",
    "top_pages",
    "word_count",
    "word_count_of_rows",
]
