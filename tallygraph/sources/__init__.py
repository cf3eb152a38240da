"""File sources and sinks."""

from tallygraph.sources.files import count_files, read_documents, read_lines, split_paths
from tallygraph.sources.numeric import bad_csv_rows, numeric_columns, read_numeric_csv
from tallygraph.sources.sinks import (
    read_betas,
    read_ranked,
    read_scores,
    write_betas,
    write_named,
    write_ranked,
    write_scores,
    write_tsv,
)
from tallygraph.sources.tables import read_table, spread_small

__all__ = [
    "bad_csv_rows",
    "count_files",
    "numeric_columns",
    "read_betas",
    "read_documents",
    "read_lines",
    "read_numeric_csv",
    "read_ranked",
    "read_scores",
    "read_table",
    "split_paths",
    "spread_small",
    "write_betas",
    "write_named",
    "write_ranked",
    "write_scores",
    "write_tsv",
]
