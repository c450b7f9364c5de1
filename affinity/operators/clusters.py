"""K-means and bisecting k-means of units.

Features are brought to 0..1 by their least and largest value, so none
outweighs the others.  Starting centres are rows: the one farthest from the
middle of all, then again and again the one farthest from the centres there
are; ties go to the smaller id.  So a run gives the same clusters whatever
the partitioning, and any engine can repeat it.

A pass over the rows assigns each to its nearest centre (ties to the lower
number) and averages the rows of each centre, combined map-side; only the
centres reach the driver.  Rows are never moved.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.operators.tree import usable

MAX_ITER = 20
STILL = 1e-12              # centres that move no further stand


@dataclass
class Scale:
    """Least and largest value of each feature, and rows brought to 0..1."""
    features: list[str]
    lo: list[float]
    hi: list[float]

    @staticmethod
    def of(df: DataFrame, features: list[str]) -> "Scale | None":
        """None for a table without usable rows."""
        ends = [f(F.col(f"`{c}`").cast("double")) for f in (F.min, F.max) for c in features]
        r = df.agg(*[e.alias(f"e{i}") for i, e in enumerate(ends)]).first()
        return None if r[0] is None else Scale(list(features), list(r[:len(features)]), list(r[len(features):]))

    def columns(self) -> list[Column]:
        """The scaled features; one that does not vary is 0."""
        return [((F.col(f"`{c}`").cast("double") - F.lit(lo)) / F.lit(hi - lo) if hi > lo else F.lit(0.0)).alias(f"x{i}")
                for i, (c, lo, hi) in enumerate(zip(self.features, self.lo, self.hi))]

    def back(self, centre: list[float]) -> list[float]:
        return [lo + x * (hi - lo) for x, lo, hi in zip(centre, self.lo, self.hi)]


def square_distance(centre: list[float]) -> Column:
    return reduce(lambda a, b: a + b, [(F.col(f"x{i}") - F.lit(v)) * (F.col(f"x{i}") - F.lit(v)) for i, v in enumerate(centre)])


def nearest(centres: list[list[float]]) -> Column:
    """Number of the nearest centre, and its squared distance, as a struct."""
    return F.array_min(F.array(*[F.struct(square_distance(c).alias("d"), F.lit(i).alias("cluster")) for i, c in enumerate(centres)]))


def _farthest(d: DataFrame, from_: list[list[float]], f: int) -> tuple[float, list[float]] | None:
    """Squared distance and place of the row farthest from its nearest of
    some points; ties to the smaller id."""
    far = F.struct((-nearest(from_)["d"]).alias("d"), "id", *[f"x{i}" for i in range(f)])
    r = d.agg(F.min(far).alias("r")).first().r
    return None if r is None else (-r.d, [r[f"x{i}"] for i in range(f)])


def _middle(d: DataFrame, f: int) -> list[float] | None:
    r = d.agg(*[F.avg(f"x{i}") for i in range(f)]).first()
    return None if r[0] is None else list(r)


def _starts(d: DataFrame, k: int, f: int) -> list[list[float]]:
    """Up to k rows, each farthest from those before; fewer if rows repeat."""
    middle = _middle(d, f)
    if middle is None:
        return []
    centres = [_farthest(d, [middle], f)[1]]
    while len(centres) < k:
        far, row = _farthest(d, centres, f)
        if far <= 0:
            break
        centres.append(row)
    return centres


def _refined(d: DataFrame, centres: list[list[float]], f: int, max_iter: int) -> list[list[float]]:
    """Centres after assignment and averaging until they stand still.  One
    that loses all its rows stays where it is."""
    for _ in range(max_iter):
        rows = d.groupBy(nearest(centres)["cluster"].alias("c")).agg(*[F.avg(f"x{i}").alias(f"x{i}") for i in range(f)]).collect()
        new = list(centres)
        for r in rows:
            new[r.c] = [r[f"x{i}"] for i in range(f)]
        moved = max(abs(a - b) for x, y in zip(centres, new) for a, b in zip(x, y))
        centres = new
        if moved <= STILL:
            break
    return centres


def _scaled(df: DataFrame, features: list[str], id_: str) -> tuple[DataFrame, Scale | None]:
    d = usable(df, [id_, *features])
    scale = Scale.of(d, features)
    return (d if scale is None else d.select(F.col(f"`{id_}`").alias("id"), *scale.columns())), scale


@dataclass
class KMeansModel:
    scale: Scale | None
    centres: list[list[float]]

    def assign(self, df: DataFrame, id_: str) -> DataFrame:
        """(id, cluster, square_distance) of rows with all features."""
        d = usable(df, [id_, *self.scale.features]) if self.scale else df.limit(0)
        if not self.centres:
            return d.select(F.col(f"`{id_}`"), F.lit(0).alias("cluster"), F.lit(0.0).alias("square_distance"))
        d = d.select(F.col(f"`{id_}`"), *self.scale.columns()).withColumn("n", nearest(self.centres))
        return d.select(id_, F.col("n.cluster").alias("cluster"), F.col("n.d").alias("square_distance"))

    def table(self, df: DataFrame, id_: str) -> DataFrame:
        """(cluster, n, cost, features...): the centres in the features' own
        units; cost is the sum of squared scaled distances."""
        spark = df.sparkSession
        names = self.scale.features if self.scale else []
        rows = [(i, *map(float, self.scale.back(c))) for i, c in enumerate(self.centres)]
        at = spark.createDataFrame(rows, ", ".join(["cluster int", *[f"`{c}` double" for c in names]]))
        sums = self.assign(df, id_).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("square_distance").alias("cost"))
        return at.join(sums, "cluster", "left").select(
            "cluster", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("cost", F.lit(0.0)).alias("cost"), *[f"`{c}`" for c in names])


def k_means(df: DataFrame, features: list[str], k: int, id_: str = "unit", max_iter: int = MAX_ITER) -> KMeansModel:
    """Clusters of the rows with an id and all features (neither null nor
    NaN).  Fewer than ``k`` different rows give as many clusters as those."""
    d, scale = _scaled(df, features, id_)
    if scale is None:
        return KMeansModel(None, [])
    f = len(features)
    return KMeansModel(scale, _refined(d, _starts(d, k, f), f, max_iter))


# ----------------------------------------------------------------- bisecting

@dataclass
class Part:
    node: int                              # root 1, children 2n and 2n + 1
    n: int
    cost: float
    centre: list[float]
    split: list[list[float]] | None = None # centres of its two children's rows


@dataclass
class BisectingModel:
    scale: Scale | None
    parts: dict[int, Part] = field(default_factory=dict)

    def _at(self, node: int = 1) -> Column:
        p = self.parts.get(node)
        if p is None or p.split is None:
            return F.lit(node).cast("bigint")
        first, second = (square_distance(c) for c in p.split)
        return F.when(first <= second, self._at(2 * node)).otherwise(self._at(2 * node + 1))

    def assign(self, df: DataFrame, id_: str) -> DataFrame:
        """(id, node): the leaf of every row with all features."""
        d = usable(df, [id_, *self.scale.features]) if self.scale else df.limit(0)
        cols = self.scale.columns() if self.scale else []
        return d.select(F.col(f"`{id_}`"), *cols).select(id_, self._at().alias("node"))

    def table(self, spark: SparkSession) -> DataFrame:
        """(node, parent, n, cost, leaf, features...) of the tree of splits."""
        names = self.scale.features if self.scale else []
        rows = [(p.node, p.node // 2 or None, p.n, float(p.cost), p.split is None, *map(float, self.scale.back(p.centre)))
                for p in self.parts.values()]
        return spark.createDataFrame(rows, ", ".join(["node long", "parent long", "n long", "cost double", "leaf boolean",
                                                      *[f"`{c}` double" for c in names]]))


def _part(d: DataFrame, node: int, f: int) -> Part | None:
    """Rows, middle and cost of a part: the cost in a second pass, about the
    middle, so it does not suffer from large squares."""
    centre = _middle(d, f)
    if centre is None:
        return None
    r = d.agg(F.count(F.lit(1)).alias("n"), F.sum(square_distance(centre)).alias("cost")).first()
    return Part(node, r.n, r.cost, centre)


def bisecting_k_means(df: DataFrame, features: list[str], k: int, id_: str = "unit", max_iter: int = MAX_ITER) -> BisectingModel:
    """The rows split in two again and again until there are ``k`` leaves: the
    leaf of the largest cost (ties to the lower number) by 2-means that
    starts from the row farthest from its middle and the row farthest from
    that one.  Leaves of equal rows are not split."""
    d, scale = _scaled(df, features, id_)
    model = BisectingModel(scale)
    if scale is None:
        return model
    f, least = len(features), 1e-18
    model.parts[1] = _part(d, 1, f)
    while sum(p.split is None for p in model.parts.values()) < k:
        open_ = [p for p in model.parts.values() if p.split is None and p.cost > least * p.n]
        if not open_:
            break
        p = min(open_, key=lambda p: (-p.cost, p.node))
        rows = d.where(model._at() == p.node)
        first = _farthest(rows, [p.centre], f)[1]
        second = _farthest(rows, [first], f)[1]
        centres = _refined(rows, [first, second], f, max_iter)
        p.split = centres
        for side in (0, 1):
            child = _part(d.where(model._at() == 2 * p.node + side), 2 * p.node + side, f)
            if child is not None:
                model.parts[child.node] = child
    return model
