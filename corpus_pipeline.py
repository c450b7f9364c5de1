"""Corpus pipeline: quality, near duplicates, repeated passages, mixture,
tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the
next one's ``docs``.  All but the last keep the columns of ``documents``.
``run`` applies them to the documents table and returns the last one's rows.

Every stage takes null ids, texts, languages and sources, empty and very long
texts, repeated rows, empty tables (no rows come out) and further columns of
any name, which stay as they are.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.llm import bpe, jaccard, mixing, quality, substring
from affinity.llm.common import prepare
from affinity.operators.lineage import delete_folder
from affinity.session import ensure_checkpoint_dir
from affinity.sources.tables import read_table

# Not to be said in SQL: the trees, the seeded shuffle and the tokenizer.
# tests/llm holds the stages against brute force.
ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from
    the labels of the rows it is given.  Null and empty texts get a score
    like any other; without labels nothing is rejected."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8), that of the
    smallest doc_id; of repeated rows one.  Texts without a word, null ones
    among them, all stay."""
    return jaccard.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words and more that also start earlier (smaller doc_id,
    a null one last) are cut out; a text that loses none stays as it is, null
    or empty ones too."""
    cut = F.col("n_removed") > 0
    new = {"text": F.when(cut, F.col("kept_text")).otherwise(F.col("doc.text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(cut, F.length("kept_text").cast(kind)).otherwise(F.col("doc.n_chars"))
    return substring.marked(docs).select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture by source weights; a document taken twice is two rows.  A
    null source is one of its own; texts without a word have no size and are
    not taken."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of the decoded bytes per row; null
    and empty texts have no token."""
    return bpe.encode_and_decode(docs)


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", one_of_each),
    ("repeated_passages", without_repeats),
    ("mixture", mixed),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is kept as Parquet in
    a folder of this run under the shared checkpoint folder until the next
    stage is written; only the result's stays."""
    prepare(spark)
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
        if k:
            delete_folder(spark, f"{folder}/{k - 1}-{STAGES[k - 1][0]}")
    return docs
