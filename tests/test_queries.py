import duckdb
import pytest

import __spark_entry__ as E
from affinity.plans.catalog import names
from conftest import SF001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["unit", "lon", "lat", "avg_score"]
    assert df.count() == 7  # units inside the box at sf0.001


def test_every_query_has_an_oracle():
    assert set(names()) <= set(E.queries()) and set(names()) <= set(E.oracle_sql())
    assert len(names()) >= 50


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN"}


def _oracle(sql):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    rel = con.sql(sql)
    return rel.columns, [str(t) for t in rel.types], rel.fetchall()


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        out.append(tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("name", sorted(names()))
def test_query_matches_oracle_sf0001(spark, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    cols, types, orows = _oracle(E.oracle_sql()[name])
    assert sorted(cols) == sorted(df.columns)
    assert {c: SPARK_TO_DUCK[t] for c, t in df.dtypes} == dict(zip(cols, types))
    assert _norm(rows, df.columns) == _norm(orows, cols)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(names()))
def test_no_cross_products(spark, name):
    plan = _plan(E.queries()[name](spark, SF001))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_flagship_prunes_and_pushes(spark):
    from affinity.plans.binding import Binding
    from affinity.operators.edges import score_with_coords
    b = Binding(spark, SF001, keep=False)
    text = _plan(score_with_coords(b.edges, b.coords, "avg"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint>" in text  # 2 of 11 columns
    assert "PushedFilters: [IsNotNull(l_orderkey), IsNotNull(l_suppkey)" in text


def test_pair_features_never_shuffles_edges_for_attributes(spark):
    from affinity.plans.catalog import registry
    df = registry()["pair_features"](spark, SF001)
    text = _plan(df)  # the plan as decided before running (no runtime re-plan)
    top = text.split("InMemoryRelation")[0]  # above the cached edge table
    # attributes reach both endpoints through broadcast joins of the unit table
    assert top.count("BroadcastHashJoin") >= 2
    assert "SortMergeJoin" not in top and "Exchange hashpartitioning(u" not in top


def test_command_line_writes_parquet(spark, scratch):
    from affinity.__main__ import main
    out = f"{scratch}/out"
    assert main(["--root", SF001, "--out", out, "avg_connectivity", "bbox_units"]) == 0
    assert spark.read.parquet(f"{out}/avg_connectivity").count() == 10
    assert spark.read.parquet(f"{out}/bbox_units").count() == 7


def test_no_job_runs_while_a_query_is_built(spark):
    """Building a query starts no Spark job, but for model fits and the one
    mean that a model query's label threshold needs."""
    from affinity.plans.binding import Binding
    from affinity.plans.catalog import run
    sc = spark.sparkContext
    for name in sorted(names()):
        if "regression" in name or "nb_" in name or name in ("scatter_series",):
            continue
        b = Binding(spark, SF001, keep=True)
        sc.setJobGroup(f"build-{name}", name)
        run(name, b)
        tracker = sc.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(f"build-{name}") for s in tracker.getJobInfo(j).stageIds]
        b.release()
        # reading a table's schema is a job of its own
        assert not [s.name for s in stages if s and not s.name.startswith("parquet at")], name
    sc.setLocalProperty("spark.jobGroup.id", None)


def test_no_single_task_exchange_before_edge_joins(spark):
    for name in ("pair_features", "border_effect", "edge_level", "title_match", "same_group_pairs"):
        assert "SinglePartition" not in _plan(E.queries()[name](spark, SF001)), name


def test_predictions_read_the_training_pairs_once(spark, monkeypatch):
    """The fit is one aggregation, not a model fit over rows of vectors."""
    from affinity.operators import models as M
    from affinity.plans.binding import Binding
    from affinity.plans.catalog import run
    monkeypatch.setattr(M, "fit_linear", None)
    b = Binding(spark, SF001, keep=False)
    rows = run("regression_predictions", b).collect()
    assert rows and all(r.prediction is not None for r in rows)


def test_tree_accuracy_reads_the_edges_once(spark, monkeypatch):
    from affinity.operators import edges as E
    from affinity.plans.binding import Binding
    from affinity.plans.catalog import run
    calls, plain = [], E.unit_score

    def counted(*args, **kwargs):
        calls.append(args)
        return plain(*args, **kwargs)
    monkeypatch.setattr(E, "unit_score", counted)
    assert run("tree_accuracy", Binding(spark, SF001, keep=False)).first().n > 0
    assert len(calls) == 1


def test_class_counts_read_the_index_once(spark):
    """The threshold (a mean over all edges) and the unit means come from one
    aggregation of the edges that is kept, not from a second read of them."""
    from affinity.plans.binding import Binding
    from affinity.operators import edges as E
    from affinity.plans.catalog import run
    b = Binding(spark, SF001, keep=True)
    df = run("class_counts", b)
    plan = df._jdf.queryExecution().analyzed().toString()
    assert "avg(w" not in plan and "sum(cast(w" in plan       # neither mean reads the edges on its own
    assert b.unit_sums.storageLevel.useMemory
    want = b.edges.groupBy("u1").agg({"w": "avg"}).toDF("unit", "avg")
    assert {r.unit: r.avg for r in E.unit_means(b.unit_sums, "avg").collect()} == {r.unit: r.avg for r in want.collect()}
    assert abs(E.mean_score(b.unit_sums).first().mean - b.edges.selectExpr("avg(w) AS m").first().m) < 1e-6
    assert df.first().n_rows > 0
    b.release()


def test_results_need_no_monthly_rows(spark):
    """Shares come from one aggregation to units; null flags are not counted."""
    from affinity.plans.binding import Binding
    b = Binding(spark, SF001, keep=False)
    plan = b.results._jdf.queryExecution().analyzed().toString()
    assert "month(" not in plan and plan.count("Aggregate") == 1
    got = {r.unit: r.result for r in b.results.collect()}
    m = b.monthly.groupBy("unit").agg({"n_r": "sum", "n_flag": "sum"}).collect()
    assert got == {r.unit: r["sum(n_r)"] / r["sum(n_flag)"] for r in m}
