"""Preparing columns for models: filling gaps, turning labels and small sets
of values into indices and back.

Each estimator is fitted once (``fit``) and gives a model with ``transform``;
``state`` and ``tables`` are what a model is made of, so a chain of them can
be saved and loaded (:mod:`affinity.operators.chain`).  Statistics of all
columns are taken together, and nothing that grows with the rows is
collected: a dictionary of labels is a table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from affinity.operators.lineage import cut
from affinity.operators.ranking import ranked

SELECT_BINS = 256          # of one pass of the selection of medians
POLICIES = ("error", "keep", "skip")


def present(df: DataFrame, name: str) -> Column:
    """Whether a value counts: neither null nor NaN."""
    c = F.col(f"`{name}`")
    floating = isinstance(df.schema[name].dataType, (DoubleType, FloatType))
    return c.isNotNull() & ~F.isnan(c) if floating else c.isNotNull()


# ------------------------------------------------------------------ imputer

def medians(df: DataFrame, names: list[str]) -> dict[str, float | None]:
    """Exact medians (of an even number of values the mean of the middle two)
    of several columns at once, by selection: each pass counts the values
    between two bounds in equal bins and goes on inside the bin that holds
    the wanted rank, until one value is left.  Only the bins' counts and
    bounds reach the driver; no column is sorted or gathered."""
    values = [F.struct(F.lit(i).alias("i"), F.when(present(df, c), F.col(f"`{c}`").cast("double")).alias("x")) for i, c in enumerate(names)]
    d = df.select(F.explode(F.array(*values)).alias("v")).select("v.*").where(F.col("x").isNotNull())
    ends = {r.i: r for r in d.groupBy("i").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()}
    found: dict[tuple[int, int], float] = {}
    todo = {(i, k): (r.lo, r.hi, 0) for i, r in ends.items() for k in {(r.n - 1) // 2, r.n // 2}}
    while todo:
        found.update({key: lo for key, (lo, hi, _) in todo.items() if lo == hi})
        todo = {key: v for key, v in todo.items() if v[0] != v[1]}
        if not todo:
            break
        asked = df.sparkSession.createDataFrame([(i, k, lo, hi) for (i, k), (lo, hi, _) in todo.items()],
                                                "i int, k long, lo double, hi double")
        inside = d.join(F.broadcast(asked), "i").where(F.col("x").between(F.col("lo"), F.col("hi")))
        half = F.col("hi") / 2 - F.col("lo") / 2      # halves cannot overflow, but those of the smallest numbers vanish
        share = F.when(half != 0, (F.col("x") / 2 - F.col("lo") / 2) / half).otherwise(
            (F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")))
        held: dict[tuple[int, int], list] = {}
        for r in inside.groupBy("i", "k", F.least(F.floor(share * SELECT_BINS), F.lit(SELECT_BINS - 1)).alias("bin")).agg(
                F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect():
            held.setdefault((r.i, r.k), []).append((r.bin, r.n, r.lo, r.hi))
        for key, bins in held.items():
            below = todo[key][2]
            for _, n, lo, hi in sorted(bins):
                if key[1] < below + n:
                    todo[key] = (lo, hi, below)
                    break
                below += n
    return {c: None if i not in ends else found[i, (ends[i].n - 1) // 2] / 2 + found[i, ends[i].n // 2] / 2
            for i, c in enumerate(names)}


def modes(df: DataFrame, names: list[str]) -> dict[str, object]:
    """The most frequent value of each column, ties to the smallest."""
    out: dict[str, object] = {}
    for c in names:                        # columns can be of different types
        counts = df.where(present(df, c)).groupBy(F.col(f"`{c}`").alias("x")).agg(F.count(F.lit(1)).alias("n"))
        best = counts.agg(F.min(F.struct((-F.col("n")).alias("n"), "x")).alias("b")).first().b
        out[c] = None if best is None else best.x
    return out


@dataclass
class ImputerModel:
    values: dict[str, object]
    kind = "imputer"

    def transform(self, df: DataFrame) -> DataFrame:
        new = {c: F.when(present(df, c), F.col(f"`{c}`")).otherwise(F.lit(v)).cast(df.schema[c].dataType) for c, v in self.values.items()
               if v is not None}
        return df.withColumns(new)

    def state(self) -> dict:
        return {"values": self.values}

    def tables(self) -> dict[str, DataFrame]:
        return {}


@dataclass
class Imputer:
    """Fills nulls and NaN of each column by its ``mean``, ``median`` or
    ``mode`` (the strategy by column).  Means and medians are of the values
    there are; a column without any stays as it is.  Integral columns get
    the mean or median cut to their type."""
    strategies: dict[str, str]

    def fit(self, df: DataFrame) -> ImputerModel:
        unknown = set(self.strategies.values()) - {"mean", "median", "mode"}
        if unknown:
            raise ValueError(f"no strategy {sorted(unknown)}")
        by = {s: [c for c, x in self.strategies.items() if x == s] for s in ("mean", "median", "mode")}
        values: dict[str, object] = {}
        if by["mean"]:
            row = df.agg(*[F.avg(F.when(present(df, c), F.col(f"`{c}`"))).alias(c) for c in by["mean"]]).first()
            values.update({c: None if row[c] is None else float(row[c]) for c in by["mean"]})
        if by["median"]:
            values.update(medians(df, by["median"]))
        values.update(modes(df, by["mode"]))
        return ImputerModel({c: values[c] for c in self.strategies})


# ----------------------------------------------------------- string indexer

def _policy(df: DataFrame, index: str, instead: Column, policy: str, what: str) -> DataFrame:
    """Rows whose index is null: an error, another index, or left out."""
    c = F.col(f"`{index}`")
    if policy == "skip":
        return df.where(c.isNotNull())
    if policy == "keep":
        return df.withColumn(index, F.coalesce(c, instead))
    return df.withColumn(index, F.when(c.isNull(), F.raise_error(F.lit(what)).cast("double")).otherwise(c))


@dataclass
class StringIndexerModel:
    source: str
    index: str
    policy: str
    labels: DataFrame                      # (label, n, index)
    kind = "string_indexer"

    def transform(self, df: DataFrame) -> DataFrame:
        known = self.labels.select(F.col("label").alias("_label"), F.col("index").alias(self.index))
        d = df.drop(self.index).join(known, F.col(f"`{self.source}`").cast("string") == F.col("_label"), "left").drop("_label")
        if self.policy != "keep":
            return _policy(d, self.index, F.lit(None), self.policy, f"null or unseen label in {self.source}")
        return _policy(d, self.index, F.lit(float(self.labels.count())), "keep", "")

    def inverse(self, index: str | None = None, label: str = "label") -> "IndexToString":
        return IndexToString(index or self.index, label, self.labels)

    def state(self) -> dict:
        return {"source": self.source, "index": self.index, "policy": self.policy}

    def tables(self) -> dict[str, DataFrame]:
        return {"labels": self.labels}


@dataclass
class StringIndexer:
    """Labels as indices 0.0, 1.0, ... in order of frequency, ties by label.
    ``policy`` for null and unseen labels: ``error`` when such a row is read,
    ``keep`` (all get the next index), ``skip`` (the row is left out)."""
    source: str
    index: str
    policy: str = "error"

    def fit(self, df: DataFrame) -> StringIndexerModel:
        if self.policy not in POLICIES:
            raise ValueError(f"no policy {self.policy}")
        label = F.col(f"`{self.source}`").cast("string").alias("label")
        n = df.select(label).where(F.col("label").isNotNull()).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
        table = ranked(n, [F.desc("n"), F.col("label")], "index")
        return StringIndexerModel(self.source, self.index, self.policy, table.withColumn("index", F.col("index").cast("double")))


@dataclass
class IndexToString:
    """The label of an index; null for an index that stands for none."""
    index: str
    label: str
    labels: DataFrame
    kind = "index_to_string"

    def transform(self, df: DataFrame) -> DataFrame:
        known = self.labels.select(F.col("index").alias("_index"), F.col("label").alias(self.label))
        d = df.drop(self.label) if self.label in df.columns else df
        return d.join(known, F.col(f"`{self.index}`") == F.col("_index"), "left").drop("_index")

    def state(self) -> dict:
        return {"index": self.index, "label": self.label}

    def tables(self) -> dict[str, DataFrame]:
        return {"labels": self.labels}


# ----------------------------------------------------------- vector indexer

@dataclass
class VectorIndexerModel:
    maps: dict[str, list[float]]           # values of each categorical feature, ascending
    features: list[str]
    policy: str
    kind = "vector_indexer"

    def transform(self, df: DataFrame) -> DataFrame:
        for c, values in self.maps.items():
            v = F.col(f"`{c}`").cast("double")
            # 0.0 and -0.0 are one value
            lookup = F.create_map(*[F.lit(x) for i, value in enumerate(values) for x in (value, float(i))])
            df = df.withColumn(c, F.try_element_at(lookup, v + F.lit(0.0)))
            df = _policy(df, c, F.lit(float(len(values))), self.policy, f"null or unseen value in {c}")
        return df

    def state(self) -> dict:
        return {"maps": self.maps, "features": self.features, "policy": self.policy}

    def tables(self) -> dict[str, DataFrame]:
        return {}

    def mapping(self, df: DataFrame) -> DataFrame:
        """(feature, categorical, value, index): a row per value of a
        categorical feature, one row with nulls per continuous one."""
        rows = [(c, True, v, float(i)) for c, values in self.maps.items() for i, v in enumerate(values)]
        rows += [(c, False, None, None) for c in self.features if c not in self.maps]
        return df.sparkSession.createDataFrame(rows, "feature string, categorical boolean, value double, index double")


@dataclass
class VectorIndexer:
    """Features with at most ``max_categories`` distinct values are
    categorical: their values, ascending, become 0.0, 1.0, ...; the others
    stay.  Nulls and NaN are no value; ``policy`` as of StringIndexer.

    One pass estimates the distinct values of all features; only those that
    could be within the bound are counted exactly."""
    features: list[str]
    max_categories: int = 20
    policy: str = "error"

    def fit(self, df: DataFrame) -> VectorIndexerModel:
        if self.policy not in POLICIES:
            raise ValueError(f"no policy {self.policy}")
        value = {c: F.when(present(df, c), F.col(f"`{c}`").cast("double") + F.lit(0.0)) for c in self.features}
        about = df.agg(*[F.approx_count_distinct(v, 0.05).alias(c) for c, v in value.items()]).first()
        few = [c for c in self.features if about[c] <= 2 * self.max_categories + 10]
        maps: dict[str, list[float]] = {}
        if few:
            pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), value[c].alias("x")) for i, c in enumerate(few)]))
            d = df.select(pairs.alias("v")).select("v.*").where(F.col("x").isNotNull()).distinct()
            small = cut(d)                 # a few values a feature
            for r in small.groupBy("i").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("x")).alias("xs")).collect():
                if r.n <= self.max_categories:
                    maps[few[r.i]] = list(r.xs)
        return VectorIndexerModel({c: maps[c] for c in self.features if c in maps}, list(self.features), self.policy)
