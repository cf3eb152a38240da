"""Column expressions; every one is a composition of built-in Spark functions."""

from tallygraph.functions.scoring import inverse_document_frequency, log_term_frequency
from tallygraph.functions.strings import trim_controls
from tallygraph.functions.wiki import page_title, wiki_links
from tallygraph.functions.words import plain_words

__all__ = [
    "inverse_document_frequency",
    "log_term_frequency",
    "page_title",
    "plain_words",
    "trim_controls",
    "wiki_links",
]
