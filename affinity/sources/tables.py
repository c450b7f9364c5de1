"""Parquet tables: one file or folder per table under a root folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Lazily scan ``{root}/{name}.parquet``.  Column pruning and filter
    pushdown reach the scan because callers select/filter afterwards."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
