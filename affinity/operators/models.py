"""Models on unit and pair tables: deterministic split, linear regression,
naive Bayes, and their evaluation, all through MLlib estimators.

Fitting is distributed in MLlib: linear regression with the normal-equation
solver aggregates X'X and X'y in one pass (a (F+1)^2 matrix reaches the
driver), naive Bayes aggregates per-class feature sums (C x F numbers).
Nothing edge-sized is collected, and no vector table is kept.
"""

from __future__ import annotations

from typing import NamedTuple, Sequence

import numpy as np
from pyspark.ml.classification import NaiveBayes, NaiveBayesModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

# Feature sets of the reference's models.
FEATURES_ATTITUDE = ("avg", "level", "result")
FEATURES_CONNECTIVITY = ("level", "never", "rarely", "sometimes", "freq", "always", "result")
FEATURES_PAIR_ONE = ("gap_att",)
FEATURES_PAIR_DISTANCE = ("ln_km",)
FEATURES_PAIR_RESULT = ("gap_result",)
FEATURES_PAIR_FULL = ("ln_km", "gap_rate", "gap_result", "gap_att")

# Feature sets and parameters of the unit tree and clusters, our own choice.
FEATURES_TREE = ("lat", "lon", "avg", "level", "result", "grp_index")
IMPUTED = {"lat": "mean", "lon": "median", "avg": "mean", "level": "median", "result": "mode"}
MAX_CATEGORIES = 25
FEATURES_CLUSTER = ("lat", "lon", "result")
CLUSTERS = 5


# The split mixes the whole id: times a multiplier, modulo a large prime, and
# only then modulo 1000.  All products stay below 2^63.
SPLIT_PRIME = 998_244_353
SPLIT_UNIT = (134_775_813, 104_729)
SPLIT_PAIR = (134_775_813, 630_360_016)
SPLIT_PARTS = 1000


def _key(col: str) -> Column:
    """Integer key for the split, below the prime: the id itself when it is
    numeric (also numeric text such as ``01001``), else a 64-bit hash of it."""
    c = F.col(col)
    return F.pmod(F.coalesce(c.try_cast("bigint"), F.xxhash64(c)), F.lit(SPLIT_PRIME))


def _below(mixed: Column, train_below: int) -> Column:
    """Deterministic train/test flag from integer arithmetic on the ids.

    ``randomSplit`` with a seed depends on the input partitioning; this rule
    does not, and any engine computes the same flag.
    """
    return F.pmod(mixed, F.lit(SPLIT_PRIME)) % SPLIT_PARTS < F.lit(train_below)


def unit_split(unit: str = "unit", train_below: int = 700) -> Column:
    """70/30 by default."""
    return _below(_key(unit) * SPLIT_UNIT[0] + SPLIT_UNIT[1], train_below)


def pair_split(u1: str = "u1", u2: str = "u2", train_below: int = 800) -> Column:
    """80/20 by default."""
    return _below(_key(u1) * SPLIT_PAIR[0] + _key(u2) * SPLIT_PAIR[1], train_below)


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """Feature vector column.  Rows with a null feature are dropped first
    (the assembler would fail on them)."""
    clean = df.dropna(subset=list(features))
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(clean)


# ---------------------------------------------------------------- regression

def fit_linear(train: DataFrame, features: Sequence[str], label: str, max_iter: int = 10,
               prediction_col: str = "prediction") -> LinearRegressionModel:
    """Unregularised least squares with intercept (normal equations)."""
    lr = LinearRegression(featuresCol="features", labelCol=label, predictionCol=prediction_col,
                          maxIter=max_iter, regParam=0.0, elasticNetParam=0.0, solver="normal")
    return lr.fit(assemble(train, features).select("features", label))


def linear_report(model: LinearRegressionModel, train: DataFrame, features: Sequence[str], label: str,
                  digits: int | None = None) -> DataFrame:
    """One row: ``coef_<feature>`` per feature, ``intercept``, training
    ``rmse`` and row count ``n``.  The fit has read the training rows once;
    this reads them once more, as plain columns."""
    def r(c):
        return F.round(c, digits) if digits is not None else c
    scored = predict_linear(model, train, features)
    return rmse(scored, label).select(
        *[r(F.lit(float(c))).alias(f"coef_{f}") for f, c in zip(features, model.coefficients)],
        r(F.lit(float(model.intercept))).alias("intercept"), r(F.col("rmse")).alias("rmse"), "n")


def least_squares(train: DataFrame, features: Sequence[str], label: str) -> tuple[list[float], float, float, int] | None:
    """(coefficients, intercept, training RMSE, rows) of unregularised least
    squares with intercept, from one aggregation of the rows that have all
    features and the label: means, variances and covariances, which Spark
    merges without cancellation.  The RMSE follows from them, so the rows are
    read once.  Features that depend on each other share the coefficient
    (least norm).  None without rows."""
    cols = [*features, label]
    d = train.dropna(subset=cols)
    cov = {(i, j): F.covar_pop(cols[i], cols[j]).alias(f"c{i}_{j}") for i in range(len(cols)) for j in range(i, len(cols))}
    r = d.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)], *cov.values()).first()
    if not r.n:
        return None
    k = len(features)
    c = np.array([[r[f"c{min(i, j)}_{max(i, j)}"] for j in range(k + 1)] for i in range(k + 1)])
    b = np.linalg.lstsq(c[:k, :k], c[:k, k], rcond=None)[0]
    intercept = r[f"m{k}"] - sum(x * r[f"m{i}"] for i, x in enumerate(b))
    left = c[k, k] - 2 * b @ c[:k, k] + b @ c[:k, :k] @ b
    return [float(x) for x in b], float(intercept), float(max(left, 0.0) ** 0.5), r.n


class LinearForm(NamedTuple):
    """Coefficients and intercept, as a fitted model names them."""
    coefficients: list[float]
    intercept: float


def predict_linear(model: LinearRegressionModel | LinearForm, df: DataFrame, features: Sequence[str],
                   prediction: str = "prediction") -> DataFrame:
    """Rows with all features, and the fitted linear form as a column."""
    return df.dropna(subset=list(features)).withColumn(prediction, linear_form(model, features))


def linear_form(model: LinearRegressionModel | LinearForm, features: Sequence[str]) -> Column:
    """``x . coefficients + intercept`` as a plain column expression."""
    expr = F.lit(float(model.intercept))
    for f, c in zip(features, model.coefficients):
        expr = expr + F.col(f) * F.lit(float(c))
    return expr


def rmse(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    return df.agg(F.sqrt(F.avg(F.pow(F.col(label) - F.col(prediction), 2))).alias("rmse"),
                  F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------- naive Bayes

def fit_naive_bayes(train: DataFrame, features: Sequence[str], label: str,
                    smoothing: float = 1.0) -> NaiveBayesModel:
    """Multinomial naive Bayes.  Features must be non-negative; raw
    magnitudes are used as given (large features dominate)."""
    nb = NaiveBayes(featuresCol="features", labelCol=label, predictionCol="prediction",
                    smoothing=smoothing, modelType="multinomial")
    return nb.fit(assemble(train, features).select("features", label))


def naive_bayes_report(spark: SparkSession, model: NaiveBayesModel, features: Sequence[str],
                       digits: int | None = None) -> DataFrame:
    """One row per class: ``label``, log prior ``pi`` and log likelihoods
    ``theta_<feature>``."""
    def r(x):
        return round(float(x), digits) if digits is not None else float(x)
    pi = model.pi.toArray()
    theta = model.theta.toArray()
    rows = [tuple([float(c), r(pi[c])] + [r(t) for t in theta[c]]) for c in range(len(pi))]
    fields = ([StructField("label", DoubleType()), StructField("pi", DoubleType())]
              + [StructField(f"theta_{f}", DoubleType()) for f in features])
    return spark.createDataFrame(rows, StructType(fields))


def classify(model, df: DataFrame, features: Sequence[str]) -> DataFrame:
    out = model.transform(assemble(df, features))
    return out.drop("features", "rawPrediction", "probability")


def accuracy(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Share of rows with ``label == prediction`` (one row, plus count)."""
    hit = (F.col(label) == F.col(prediction)).cast("double")
    return pred.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))
