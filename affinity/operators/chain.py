"""A chain of estimators, fitted one after the other, saved and loaded.

Each stage is fitted to what the stages before it make of the training
rows.  A fitted chain is a folder: one line of JSON with the stages' states,
and a Parquet table for each table of a stage (dictionaries of labels),
written by Spark, so it can lie wherever the cluster reads and writes.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from affinity.operators.prep import ImputerModel, IndexToString, StringIndexerModel, VectorIndexer, VectorIndexerModel
from affinity.operators.tree import DecisionTree, Node, TreeModel


class ChainModel:
    def __init__(self, stages: list):
        self.stages = stages

    def transform(self, df: DataFrame) -> DataFrame:
        for s in self.stages:
            df = s.transform(df)
        return df

    def save(self, spark: SparkSession, folder: str) -> None:
        """Write the chain to a folder that does not exist yet."""
        states = []
        for i, s in enumerate(self.stages):
            for name, table in s.tables().items():
                table.coalesce(1).write.parquet(f"{folder}/tables/{i}-{name}")
            states.append({"kind": s.kind, "state": s.state(), "tables": sorted(s.tables())})
        spark.createDataFrame([(json.dumps(states),)], "value string").coalesce(1).write.text(f"{folder}/stages")


def load(spark: SparkSession, folder: str) -> ChainModel:
    """A chain that was saved."""
    states = json.loads(spark.read.text(f"{folder}/stages", wholetext=True).first().value)
    stages = []
    for i, s in enumerate(states):
        tables = {name: spark.read.parquet(f"{folder}/tables/{i}-{name}") for name in s["tables"]}
        stages.append(_KINDS[s["kind"]](**s["state"], **tables))
    return ChainModel(stages)


def _tree(nodes: list[dict], **state) -> TreeModel:
    return TreeModel(nodes={t["node"]: Node(**t) for t in nodes}, **state)


_KINDS = {"imputer": ImputerModel, "string_indexer": StringIndexerModel, "index_to_string": IndexToString,
          "vector_indexer": VectorIndexerModel, "tree": _tree}


class Chain:
    """``fit`` gives a :class:`ChainModel`.  A tree takes as categorical the
    features that a vector indexer before it found to be so; a string
    indexer's index is categorical through that one, too."""

    def __init__(self, stages: list):
        self.stages = stages

    def fit(self, df: DataFrame) -> ChainModel:
        fitted, cats = [], None
        for s in self.stages:
            if isinstance(s, DecisionTree):
                model = s.fit(df, cats)
            else:
                model = s.fit(df) if hasattr(s, "fit") else s
            if isinstance(s, VectorIndexer):
                cats = tuple(model.maps)
            fitted.append(model)
            if s is not self.stages[-1]:
                df = model.transform(df)
        return ChainModel(fitted)
