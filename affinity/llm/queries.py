"""The checked queries: each applies one operator, with its production
parameters, to its whole table.  ``ORACLES`` (see oracles.py) holds the
DuckDB statements of those that SQL can express; the others are tested
against brute force in tests/llm."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.llm import ann, bpe, html, jaccard, licenses, merkle, mixing, phrases, quality, rules, substring, voronoi, warc
from affinity.llm.common import table_query
from affinity.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": quality.quality_query,
    "op2_jaccard": table_query("documents", jaccard.near_duplicates),
    "op3_substring": table_query("documents", substring.substring_dedup),
    "op4_mix_sources": table_query("documents", lambda d: mixing.mix_sources(d).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")),
    "op5_bpe": table_query("documents", bpe.encode_and_decode),
    "op6_warc": table_query("pages", warc.round_trip),
    "op7_licenses": table_query("documents", licenses.scan_licenses),
    "op8_rules": table_query("documents", lambda d: rules.quality_rules(d).withColumn(
        "host_rate", F.round("host_rate", 9))),
    "op9_html": table_query("pages", html.extract),
    "op10_ann": table_query("embeddings", ann.nearest_neighbours),
    "op11_phrases": table_query("documents", phrases.collocations),
    "op12_top_k": table_query("embeddings", voronoi.top_k),
    "op13_merkle": table_query("documents", merkle.merkle_manifest),
}
