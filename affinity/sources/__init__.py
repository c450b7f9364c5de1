"""Readers for the input shapes the analyses consume.  Every reader is a
distributed Spark scan; the parsing is column expressions, never per-line
Python."""

from affinity.sources.delimited import (  # noqa: F401
    read_delimited, parse_delimited, malformed_lines, read_split_lines, split_lines,
    read_partitioned, union_all, normalize_id, pad_id,
)
from affinity.sources.sectioned import read_sections, parse_sections  # noqa: F401
from affinity.sources.results import read_results, parse_results_lines, malformed_results  # noqa: F401
from affinity.sources.tables import read_table  # noqa: F401
