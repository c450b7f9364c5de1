"""Decision tree for two classes, grown level by level.

A level takes two passes over the rows, whatever the number of nodes: the
range of every feature in every open node, then counts of rows and of class
1 by (node, feature, bin), bins being equal parts of the node's own range,
so deeper nodes look at finer parts.  Only these counts reach the driver;
their number is bounded by nodes x features x bins.

A split is the one with the least Gini impurity; ties go to the earlier
feature and the lower border.  Its threshold is the largest value on its
left side, so rows go where they were counted.  Categories are put in order
of their share of class 1 (then of their index), and a prefix of that order
goes left: for two classes the best subset is among these.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.operators.prep import present

BINS = 32
MAX_DEPTH = 4
MIN_ROWS = 2
LEAST_GAIN = 1e-9          # of the parent's purity: above the rounding of equal ones


@dataclass
class Node:
    node: int                              # root 1, children 2n and 2n + 1
    n: int
    n1: int
    feature: str | None = None             # none in a leaf
    threshold: float | None = None         # numeric: left if not above
    categories: list[float] | None = None  # categorical: these go left

    def left(self) -> Column:
        c = F.col(f"`{self.feature}`").cast("double")
        if self.categories is not None:
            return c.isin([float(v) for v in self.categories])
        return c <= F.lit(self.threshold)


@dataclass
class TreeModel:
    features: list[str]
    label: str
    nodes: dict[int, Node] = field(default_factory=dict)
    prediction: str = "prediction"
    kind = "tree"

    def _at(self, leaf, node: int = 1) -> Column:
        t = self.nodes.get(node)
        if t is None or t.feature is None:
            return leaf(node, t)
        return F.when(t.left(), self._at(leaf, 2 * node)).otherwise(self._at(leaf, 2 * node + 1))

    def node_of(self) -> Column:
        return self._at(lambda node, _: F.lit(node).cast("bigint"))

    def transform(self, df: DataFrame) -> DataFrame:
        """Rows with all features, and their leaf's larger class (0.0 in a tie)."""
        def leaf(_, t: Node) -> Column:
            return F.lit(1.0 if t is not None and 2 * t.n1 > t.n else 0.0)
        return usable(df, self.features).withColumn(self.prediction, self._at(leaf))

    def table(self, spark: SparkSession) -> DataFrame:
        """The tree as rows: node, depth, feature, threshold, categories, n, n1."""
        rows = [(t.node, t.node.bit_length() - 1, t.feature, t.threshold,
                 None if t.categories is None else ",".join(str(int(c)) for c in sorted(t.categories)), t.n, t.n1)
                for t in self.nodes.values()]
        return spark.createDataFrame(rows, "node long, depth int, feature string, threshold double, categories string, n long, n1 long")

    def state(self) -> dict:
        return {"features": self.features, "label": self.label, "prediction": self.prediction,
                "nodes": [vars(t) for t in self.nodes.values()]}

    def tables(self) -> dict[str, DataFrame]:
        return {}


def usable(df: DataFrame, names: list[str]) -> DataFrame:
    """Rows in which all of the columns are there (neither null nor NaN)."""
    return df.where(reduce(lambda a, b: a & b, [present(df, c) for c in names]))


def best_split(bins: list[tuple[float, int, int, float]], categorical: bool, min_rows: int):
    """(score, place, threshold or categories) of one feature's best border
    among bins (bin, rows, rows of class 1, largest value), or None.  The
    score adds up (n0² + n1²) / n of both sides; larger is purer."""
    order = sorted(bins, key=lambda b: (b[2] / b[1] if categorical else 0.0, b[0]))
    n, n1 = sum(b[1] for b in order), sum(b[2] for b in order)
    best, left, left1 = None, 0, 0
    for place, (_, rows, ones, top) in enumerate(order[:-1]):
        left, left1 = left + rows, left1 + ones
        if left < min_rows or n - left < min_rows:
            continue
        score = purity(left, left1) + purity(n - left, n1 - left1)
        if best is None or score > best[0]:
            best = (score, place, [b[0] for b in order[:place + 1]] if categorical else top)
    return best


def purity(n: int, n1: int) -> float:
    return (n1 * n1 + (n - n1) * (n - n1)) / n


@dataclass
class DecisionTree:
    """``categorical``: features whose values are indices.  Rows with a null
    or NaN feature or label take no part.  Without rows the tree predicts
    0.0.  A node is split if both sides keep ``min_rows`` and get purer."""
    features: list[str]
    label: str
    categorical: tuple = ()
    max_depth: int = MAX_DEPTH
    min_rows: int = MIN_ROWS
    bins: int = BINS
    prediction: str = "prediction"

    def fit(self, df: DataFrame, categorical: tuple | None = None) -> TreeModel:
        cats = set(self.categorical if categorical is None else categorical)
        model = TreeModel(list(self.features), self.label, prediction=self.prediction)
        y = F.col(f"`{self.label}`").cast("double")
        d = usable(df, [*self.features, self.label]).select(
            *[F.col(f"`{c}`").cast("double").alias(c) for c in self.features], (y == 1.0).cast("bigint").alias("_y"))
        for depth in range(self.max_depth + 1):
            first = 1 << depth
            rows = d.withColumn("_node", model.node_of()).where(F.col("_node") >= first)
            ends = [f(F.col(f"`{c}`")).alias(f"{name}_{i}") for i, c in enumerate(self.features) for name, f in (("lo", F.min), ("hi", F.max))]
            found = rows.groupBy("_node").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("n1"), *ends).collect()
            for r in found:
                model.nodes[r._node] = Node(r._node, r.n, r.n1)
            ranges = [(r._node, i, r[f"lo_{i}"], r[f"hi_{i}"]) for r in found if 0 < r.n1 < r.n
                      for i in range(len(self.features)) if r[f"lo_{i}"] < r[f"hi_{i}"]]
            if depth == self.max_depth or not ranges:
                break
            splits = self._splits(model, rows, ranges, cats)
            if not splits:
                break
            for node, (f, what) in splits.items():
                t = model.nodes[node]
                t.feature = self.features[f]
                if t.feature in cats:
                    t.categories = what
                else:
                    t.threshold = what
        return model

    def _splits(self, model: TreeModel, rows: DataFrame, ranges: list[tuple], cats: set) -> dict:
        spark = rows.sparkSession
        values = F.array(*[F.struct(F.lit(i).alias("f"), F.lit(c in cats).alias("cat"), F.col(f"`{c}`").alias("x"))
                           for i, c in enumerate(self.features)])
        r = F.broadcast(spark.createDataFrame(ranges, "_node long, f int, lo double, hi double"))
        share = (F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * self.bins
        binned = (rows.select("_node", "_y", F.explode(values).alias("v")).select("_node", "_y", "v.*").join(r, ["_node", "f"])
                  .withColumn("bin", F.when(F.col("cat"), F.col("x")).otherwise(F.least(F.floor(share).cast("double"), F.lit(self.bins - 1.0)))))
        held: dict[tuple[int, int], list] = {}
        for b in binned.groupBy("_node", "f", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("n1"), F.max("x").alias("top")).collect():
            held.setdefault((b._node, b.f), []).append((b.bin, b.n, b.n1, b.top))
        best: dict[int, tuple] = {}
        for (node, f), bins in sorted(held.items()):
            s = best_split(bins, self.features[f] in cats, self.min_rows)
            t = model.nodes[node]
            if s and s[0] > purity(t.n, t.n1) * (1 + LEAST_GAIN) and (node not in best or s[0] > best[node][0]):
                best[node] = (s[0], f, s[2])
        return {node: (f, what) for node, (_, f, what) in best.items()}
