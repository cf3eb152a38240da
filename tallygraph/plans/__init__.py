"""Whole pipelines, composed from the operators."""

from tallygraph.plans.links import rank_lines
from tallygraph.plans.regression import fit_csv
from tallygraph.plans.retrieval import count_words, score_documents, search_documents

__all__ = ["count_words", "fit_csv", "rank_lines", "score_documents", "search_documents"]
