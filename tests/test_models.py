import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinity.operators import models as M


def test_hash_split_is_partitioning_independent(spark):
    df = spark.range(5000).withColumnRenamed("id", "unit")
    a = {r.unit for r in df.repartition(3).where(M.unit_split()).collect()}
    b = {r.unit for r in df.repartition(7).where(M.unit_split()).collect()}
    assert a == b and 0.65 < len(a) / 5000 < 0.75
    p = M.SPLIT_PRIME
    assert a == {u for u in range(5000) if (u % p * M.SPLIT_UNIT[0] + M.SPLIT_UNIT[1]) % p % 1000 < 700}


def test_split_mixes_the_whole_id(spark):
    """Ids with equal last digits (a county code in 50 states) fall on both sides."""
    df = spark.createDataFrame([(f"{s:02d}{c:03d}",) for s in range(1, 51) for c in (1, 3, 77)], "unit string")
    got = df.groupBy(F.substring("unit", 3, 3).alias("c")).agg(F.avg(M.unit_split().cast("double")).alias("share")).collect()
    assert all(0.4 < r.share < 0.95 for r in got)
    pairs = df.limit(40).crossJoin(df.select(F.col("unit").alias("u2")).limit(40)).withColumnRenamed("unit", "u1")
    assert 0.7 < pairs.agg(F.avg(M.pair_split().cast("double"))).first()[0] < 0.9


def test_ols_matches_normal_equations(spark):
    rnd = np.random.default_rng(1)
    X = rnd.normal(size=(400, 3))
    y = 1.5 + X @ np.array([0.7, -2.0, 0.3]) + rnd.normal(scale=0.1, size=400)
    df = spark.createDataFrame([tuple(map(float, r)) + (float(t),) for r, t in zip(X, y)], "a double, b double, c double, y double")
    model = M.fit_linear(df, ["a", "b", "c"], "y")
    A = np.column_stack([np.ones(400), X])
    beta, *_ = np.linalg.lstsq(A, y, rcond=None)
    assert np.allclose([model.intercept] + list(model.coefficients), beta, atol=1e-9)
    resid = y - A @ beta
    rep = M.linear_report(model, df, ["a", "b", "c"], "y").first()
    assert math.isclose(rep.rmse, math.sqrt(np.mean(resid ** 2)), rel_tol=1e-9)
    assert rep.n == 400 and math.isclose(rep.coef_b, beta[2], rel_tol=1e-9)


def test_ln_score_slope_is_scale_invariant(spark):
    # multiplying every score by c shifts ln(score) by ln(c): slope unchanged
    rnd = random.Random(5)
    rows = [(x, math.exp(2.0 - 0.5 * x + rnd.gauss(0, 0.1))) for x in (rnd.uniform(0, 5) for _ in range(200))]
    df = spark.createDataFrame(rows, "x double, s double")
    m1 = M.fit_linear(df.select("x", F.ln("s").alias("y")), ["x"], "y")
    m2 = M.fit_linear(df.select("x", F.ln(F.col("s") * 1000).alias("y")), ["x"], "y")
    assert math.isclose(m1.coefficients[0], m2.coefficients[0], rel_tol=1e-9)
    assert math.isclose(m2.intercept - m1.intercept, math.log(1000), rel_tol=1e-9)


def nb_closed_form(rows, n_feat):
    labels = sorted({r[-1] for r in rows})
    N, C = len(rows), len(labels)
    pi, theta = [], []
    for c in labels:
        rc = [r for r in rows if r[-1] == c]
        sums = [sum(r[f] for r in rc) for f in range(n_feat)]
        pi.append(math.log(len(rc) + 1) - math.log(N + C))
        theta.append([math.log(s + 1) - math.log(sum(sums) + n_feat) for s in sums])
    return pi, theta


def test_naive_bayes_closed_form_and_planted_signal(spark):
    rnd = random.Random(11)
    rows = []
    for _ in range(300):
        c = float(rnd.random() < 0.4)
        # class 1 puts its mass on feature 0, class 0 on feature 2
        f = [rnd.uniform(0, 1) + (3 * c), rnd.uniform(0, 1), rnd.uniform(0, 1) + 3 * (1 - c)]
        rows.append(tuple(f) + (c,))
    df = spark.createDataFrame(rows, "a double, b double, c double, label double")
    model = M.fit_naive_bayes(df, ["a", "b", "c"], "label")
    pi, theta = nb_closed_form(rows, 3)
    assert np.allclose(model.pi.toArray(), pi, atol=1e-12)
    assert np.allclose(model.theta.toArray(), theta, atol=1e-12)
    acc = M.accuracy(M.classify(model, df, ["a", "b", "c"]), "label").first()
    assert acc.accuracy > 0.95 and acc.n == 300
    # a model trained on flipped labels must fail against the true ones
    flipped = spark.createDataFrame([r[:3] + (1.0 - r[3],) for r in rows], "a double, b double, c double, label double")
    m2 = M.fit_naive_bayes(flipped, ["a", "b", "c"], "label")
    acc2 = M.accuracy(M.classify(m2, df, ["a", "b", "c"]), "label").first().accuracy
    assert acc2 < 0.05


def test_naive_bayes_tie_goes_to_lower_class(spark):
    rows = [(1.0, 1.0, 0.0), (1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, label double")
    model = M.fit_naive_bayes(df, ["a", "b"], "label")
    pred = M.classify(model, df, ["a", "b"]).select("prediction").collect()
    assert {r.prediction for r in pred} == {0.0}


def test_accuracy_in_unit_interval(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)], "label double, prediction double")
    a = M.accuracy(df, "label").first()
    assert 0.0 <= a.accuracy <= 1.0 and math.isclose(a.accuracy, 2 / 3)


def test_assemble_drops_null_features(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0)], "a double, b double")
    assert M.assemble(df, ["a", "b"]).count() == 1


def test_least_squares_in_one_pass_is_the_fit(spark):
    rnd = random.Random(8)
    rows = [(x := rnd.gauss(1e4, 2), z := rnd.gauss(-3, 1), 2 * x - 0.5 * z + rnd.gauss(0, 0.3)) for _ in range(500)]
    df = spark.createDataFrame(rows + [(None, 1.0, 1.0), (1.0, 1.0, None)], "x double, z double, y double").repartition(6)
    coefs, intercept, rmse, n = M.least_squares(df, ["x", "z"], "y")
    # centred, as the values lie far from zero
    m = np.array(rows)
    mean = m.mean(axis=0)
    want = np.linalg.lstsq(m[:, :2] - mean[:2], m[:, 2] - mean[2], rcond=None)[0]
    left = m[:, 2] - mean[2] - (m[:, :2] - mean[:2]) @ want
    assert n == 500 and coefs == pytest.approx(list(want), rel=1e-9)
    assert intercept == pytest.approx(mean[2] - mean[:2] @ want, rel=1e-9)
    assert rmse == pytest.approx(float(np.sqrt((left * left).mean())), rel=1e-9)
    # features that depend on each other, and no rows
    twice = M.least_squares(df.selectExpr("x", "2 * x AS x2", "y"), ["x", "x2"], "y")
    one = M.least_squares(df, ["x"], "y")
    assert twice[2] == pytest.approx(one[2]) and twice[0][0] + 2 * twice[0][1] == pytest.approx(one[0][0])
    assert M.least_squares(df.limit(0), ["x"], "y") is None
