"""Registered queries: one per operator of the analyses.

Each query body takes an *inputs* object and returns a DataFrame.  Two kinds
of inputs provide the same relations: the binding of the driver's tables
(:class:`affinity.plans.binding.Binding`) and the original file formats
(:class:`affinity.plans.files.FileInputs`).  Analysis parameters (year,
thresholds, fan-out unit, histogram edges) travel with the inputs as
``inputs.params``.

``registry()`` exposes every body as ``(spark, root) -> DataFrame`` over the
test tables under ``root``; ``run(name, inputs)`` runs one on any inputs.

Float results that come from transcendental functions, float sums or model
fits are rounded to ``DIGITS`` decimals so that an order-insensitive value
comparison with another engine is meaningful.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.functions.color import STOPS_MAX, STOPS_MEAN, STOPS_ONE_UNIT
from affinity.operators import chain as chains
from affinity.operators import clusters as K
from affinity.operators import communities as C
from affinity.operators import edges as E
from affinity.operators import models as M
from affinity.operators import pairs as P
from affinity.operators import plotdata as V
from affinity.operators import prep
from affinity.operators import tree as T
from affinity.operators import units as U
from affinity.operators.lineage import Rounds, cut
from affinity.plans.binding import binding_for
from affinity.plans.inputs import Inputs

DIGITS = 6

Body = Callable[[Inputs], DataFrame]
Query = Callable[[SparkSession, str], DataFrame]
_BODIES: dict[str, Body] = {}


def query(fn: Body) -> Body:
    _BODIES[fn.__name__] = fn
    return fn


def run(name: str, inputs: Inputs) -> DataFrame:
    """Run one registered query on any inputs object."""
    return _BODIES[name](inputs)


def names() -> list[str]:
    return list(_BODIES)


def registry() -> dict[str, Query]:
    """Every query as ``(spark, root) -> DataFrame`` over the test tables."""
    def bind(body: Body) -> Query:
        def q(spark: SparkSession, root: str) -> DataFrame:
            return body(binding_for(spark, root))
        q.__name__ = body.__name__
        q.__doc__ = body.__doc__
        return q
    return {name: bind(body) for name, body in _BODIES.items()}


def _r(c, alias=None):
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, DIGITS).alias(alias or (c if isinstance(c, str) else None))


# ------------------------------------------------------------- edges (G, D)

@query
def connectivity_index(b):
    """G1: score from raw links, diagonal included."""
    return b.raw_index


@query
def edges_no_self(b):
    """Self pairs removed on load."""
    return b.edges


@query
def avg_connectivity(b):
    """Mean score per source unit."""
    return E.unit_score(b.edges, "avg")


@query
def max_connectivity(b):
    """Maximum score per source unit."""
    return E.unit_score(b.edges, "max")


@query
def avg_connectivity_coords(b):
    """D5 (flagship): mean score + coordinates inside the box."""
    return E.score_with_coords(b.edges, b.coords, how="avg")


@query
def max_connectivity_coords(b):
    """Maximum score + coordinates inside the box."""
    return E.score_with_coords(b.edges, b.coords, how="max")


@query
def one_unit_fanout(b):
    """Every partner of one unit with coordinates and score."""
    return E.one_unit_fanout(b.edges, b.coords, b.params.fanout_unit)


@query
def bbox_units(b):
    """P8 + S2: text coordinates parsed leniently, strict box."""
    return U.units_in_box(b.coords)


@query
def same_group_pairs(b):
    """Pairs inside one group."""
    return E.same_group_pairs(b.edges, b.names, small=b.small_units)


@query
def same_prefix_pairs(b):
    """Pairs whose ids begin with the same characters."""
    return E.same_prefix_pairs(b.edges, b.params.prefix_chars)


@query
def border_effect(b):
    """Own-group vs. other-group mean score per unit."""
    out = E.border_effect(b.edges, b.names, small=b.small_units)
    return out.select("unit", _r("avg_same"), _r("avg_cross"), "n_same", "n_cross", _r("ratio"))


@query
def border_effect_overall(b):
    """Whole-table own-group vs. other-group mean score."""
    out = E.border_effect_overall(b.edges, b.names, small=b.small_units)
    return out.select(_r("avg_same"), _r("avg_cross"), "n_same", "n_cross", _r("ratio"))


# ------------------------------------------------------ plot data (V, G5)

@query
def map_color_class(b):
    """V1: map points with colour-scale class and position (mean scale)."""
    pts = V.map_points(E.score_with_coords(b.edges, b.coords, how="avg"), "avg_score", STOPS_MEAN)
    return pts.select("unit", "lon", "lat", "avg_score", "color_stop", _r("color_pos"))


@query
def map_color_max(b):
    """V1 with the maximum-score scale (D6 map data)."""
    pts = V.map_points(E.score_with_coords(b.edges, b.coords, how="max"), "max_score", STOPS_MAX)
    return pts.select("unit", "lon", "lat", "max_score", "color_stop", _r("color_pos"))


@query
def fanout_color(b):
    """V1 with the one-unit scale (D4 map data)."""
    pts = V.map_points(E.one_unit_fanout(b.edges, b.coords, b.params.fanout_unit), "w", STOPS_ONE_UNIT)
    return pts.select("u2", "lon", "lat", "w", "color_stop", _r("color_pos"))


@query
def hist_weight(b):
    """Histogram of all pair scores."""
    return V.histogram(b.edges, "w", *b.params.hist_weight)


@query
def hist_max(b):
    """Histogram of per-unit maximum scores."""
    return V.histogram(E.unit_score(b.edges, "max"), "max_score", *b.params.hist_max)


@query
def hist_edges(b):
    """Histogram of all pair scores over explicit edges."""
    return V.histogram_edges(b.edges, "w", b.params.hist_edges)


# ------------------------------------------------------- units (J, P, D8)

def _titled(b) -> DataFrame:
    return b.dictionary.join(b.region_names, "srd").select("sid", "title", "state")


@query
def title_match(b):
    """Equal group and title contains the unit name (multi-matches)."""
    return U.match_titles(_titled(b), b.names, small=b.small_units).select("unit", "sid", "title")


@query
def title_match_longest(b):
    """J4 with match='longest': per title, only the longest matching names."""
    return U.match_titles(_titled(b), b.names, match="longest", small=b.small_units).select("unit", "sid", "title")


@query
def level_by_unit(b):
    """J5 + P6 + P9: annual level per unit through the dictionary chain."""
    return b.level


@query
def rate_by_unit(b):
    """J5 with the rate measure."""
    return b.rate


@query
def edge_level(b):
    """Each edge with the level of its first endpoint."""
    return E.attach_endpoint(b.edges, b.level, "u1", "", cols=["level"], small=b.small_units).select("u1", "u2", "w", "level")


def _unit_sums(b) -> DataFrame:
    kept = getattr(b, "unit_sums", None)  # inputs may keep them for all unit queries
    return kept if kept is not None else E.unit_sums(b.edges)


def _profile(b) -> DataFrame:
    return U.unit_profile(b.edges, b.coords, b.level, b.attitudes, b.results, means=E.unit_means(_unit_sums(b), "avg"))


def _conn_threshold(b):
    t = b.params.conn_threshold
    return E.mean_score(_unit_sums(b)).scalar() if t is None else float(t)


@query
def unit_profile(b):
    """D8 + P3 + P4: per-unit profile."""
    return _profile(b)


def _attitude(b) -> DataFrame:
    return U.attitude_class(_profile(b), b.params.attitude_threshold)


def _connectivity(b) -> DataFrame:
    return U.connectivity_class(_profile(b), _conn_threshold(b))


@query
def attitude_class(b):
    """P13 + P5: attitude label, shares dropped."""
    return _attitude(b)


@query
def connectivity_class(b):
    """P13 + P5: connectivity label, avg dropped."""
    return _connectivity(b)


@query
def class_counts(b):
    """Row count and class counts of the profile."""
    thr = _conn_threshold(b)
    low = F.col("never") + F.col("rarely") + F.col("sometimes") > F.lit(b.params.attitude_threshold)
    weak = F.col("avg") < (thr if not isinstance(thr, float) else F.lit(thr))
    return _profile(b).agg(F.count(F.lit(1)).alias("n_rows"),
                           F.count_if(low).alias("n_attitude_low"),
                           F.count_if(weak).alias("n_conn_weak"))


@query
def split_assignment(b):
    """M2: deterministic 70/30 unit split."""
    return b.names.select("unit", M.unit_split().alias("is_train"))


# ---------------------------------------------------------- pairs

def _units_wide(b) -> DataFrame:
    kept = getattr(b, "units_wide", None)  # inputs may keep it for all pair queries
    return kept if kept is not None else P.wide_units(b.pair_coords, b.rate, b.results, b.attitudes)


def _features(b) -> DataFrame:
    return P.pair_features(b.edges, _units_wide(b), small=b.small_units)


@query
def pair_distance(b):
    """Great-circle km per pair."""
    return P.pair_distance(b.edges, b.pair_coords, small=b.small_units).select("u1", "u2", "w", _r("dist_km"))


@query
def pair_attitude_gap(b):
    """|(never+rarely)(u1) - (never+rarely)(u2)|."""
    att = b.attitudes.select("unit", (F.col("never") + F.col("rarely")).alias("att"))
    return P.pair_gap(b.edges, att, "att", small=b.small_units).select("u1", "u2", "w", _r("gap"))


@query
def pair_result_gap(b):
    """Result-share gap."""
    return P.pair_gap(b.edges, b.results, "result", small=b.small_units).select("u1", "u2", "w", _r("gap"))


@query
def pair_rate_gap(b):
    """Rate gap (rate per unit through the title match)."""
    return P.pair_gap(b.edges, b.rate, "rate", small=b.small_units).select("u1", "u2", "w", _r("gap"))


@query
def pair_features(b):
    """D3: regression table (wide-unit form)."""
    return _features(b).select("u1", "u2", _r("ln_w"), _r("gap_att"), _r("gap_result"), _r("ln_km"), _r("gap_rate"))


@query
def pair_chain(b):
    """The regression table as three joins of pair tables on (u1, u2)."""
    kept = getattr(b, "pair_buckets", None)   # inputs may keep every pair once, bucketed by both ends
    f = P.pair_chain(b.edges if kept is None else kept, b.pair_coords, b.rate, b.results, b.attitudes, small=b.small_units)
    f = f.select("u1", "u2", _r("ln_w"), _r("gap_att"), _r("gap_result"), _r("ln_km"), _r("gap_rate"))
    # distance and gaps are the same from either end
    return f if kept is None else E.both_directions(f)


@query
def gap_correlation(b):
    """Correlation of ln score with each gap."""
    g = P.unit_gap_correlation(b.edges, _units_wide(b), small=b.small_units)
    return g.select(*[_r(c) for c in ("corr_ln_km", "corr_gap_att", "corr_gap_result", "corr_gap_rate")], "n_pairs")


# -------------------------------------------------------- regression (M3-M6)

def _train_pairs(b, same_group: bool = False) -> DataFrame:
    f = _features(b)
    if same_group:
        grp = b.names.select("unit", "grp")
        f = (E.attach_both_endpoints(f, grp, cols=["grp"], small=b.small_units)
             .where(F.col("grp1") == F.col("grp2")).drop("grp1", "grp2"))
    return f.where(M.pair_split())


def _regression(b, feats, same_group: bool = False) -> DataFrame:
    """Coefficients, intercept, training RMSE and row count of ln score on
    some features.  Without training rows (e.g. no same-group pairs) all but
    the count are null."""
    fit = M.least_squares(_train_pairs(b, same_group), feats, "ln_w")
    names = [*[f"coef_{f}" for f in feats], "intercept", "rmse"]
    if fit is None:
        return b.spark.range(1).select(*[F.lit(None).cast("double").alias(c) for c in names], F.lit(0).cast("bigint").alias("n"))
    coefs, intercept, rmse, n = fit
    return b.spark.range(1).select(*[_r(F.lit(v), c) for c, v in zip(names, [*coefs, intercept, rmse])], F.lit(n).cast("bigint").alias("n"))


@query
def regression_one_coef(b):
    """M3 + M5 + G6: ln score on the attitude gap; coefficients, training RMSE."""
    return _regression(b, M.FEATURES_PAIR_ONE)


@query
def regression_distance(b):
    """M3 + M5 + G6: ln score on ln distance, all pairs."""
    return _regression(b, M.FEATURES_PAIR_DISTANCE)


@query
def regression_distance_same_group(b):
    """M3 + M5 + G6 + P11: ln score on ln distance, same-group pairs."""
    return _regression(b, M.FEATURES_PAIR_DISTANCE, same_group=True)


@query
def regression_result(b):
    """M3 + M5 + G6: ln score on the result gap."""
    return _regression(b, M.FEATURES_PAIR_RESULT)


def _predicted(b) -> DataFrame:
    feats = M.FEATURES_PAIR_ONE
    fit = M.least_squares(_train_pairs(b), feats, "ln_w")
    if fit is None:
        raise ValueError("no training pairs to fit the predictions on")
    return M.predict_linear(M.LinearForm(*fit[:2]), _features(b), feats)


@query
def regression_predictions(b):
    """M6 + F11: the one-feature model applied to every pair."""
    return _predicted(b).select("u1", "u2", _r("ln_w"), _r("prediction"))


@query
def scatter_series(b):
    """V2: observed and predicted ln score against the fitted linear form."""
    s = V.scatter_series(_predicted(b), "prediction", {"observed": "ln_w", "predicted": "prediction"})
    return s.select(_r("x"), _r("y"), "series")


@query
def scatter_distance(b):
    """V2: ln distance against ln score, one point per pair."""
    s = V.scatter_series(_features(b), "ln_km", {"observed": "ln_w"})
    return s.select(_r("x"), _r("y"), "series")


@query
def regression_rmse(b):
    """M4 + G6: four-gap regression, training RMSE, all pairs."""
    return _regression(b, M.FEATURES_PAIR_FULL).select("rmse", "n")


@query
def regression_rmse_same_group(b):
    """M4 + G6 + P11: four-gap regression on same-group pairs."""
    return _regression(b, M.FEATURES_PAIR_FULL, same_group=True).select("rmse", "n")


# ------------------------------------------------------- naive Bayes (M7-M9)

def _nb(b, which: str):
    if which == "attitude":
        data, feats, label = _attitude(b), M.FEATURES_ATTITUDE, "attitude_class"
    else:
        data, feats, label = _connectivity(b), M.FEATURES_CONNECTIVITY, "conn_class"
    split = M.unit_split()
    model = M.fit_naive_bayes(data.where(split), feats, label)
    return model, data.where(~split), feats, label


@query
def nb_params(b):
    """M7: naive Bayes log priors and likelihoods, attitude model."""
    model, _, feats, _ = _nb(b, "attitude")
    return M.naive_bayes_report(b.spark, model, feats, DIGITS)


@query
def nb_params_connectivity(b):
    """M7: naive Bayes parameters, connectivity model."""
    model, _, feats, _ = _nb(b, "connectivity")
    return M.naive_bayes_report(b.spark, model, feats, DIGITS)


def _nb_predictions(b, which):
    model, test, feats, label = _nb(b, which)
    return M.classify(model, test, feats).select("unit", label, "prediction")


@query
def attitude_nb_predictions(b):
    """M8: held-out attitude predictions."""
    return _nb_predictions(b, "attitude")


@query
def connectivity_nb_predictions(b):
    """M8: held-out connectivity predictions."""
    return _nb_predictions(b, "connectivity")


@query
def attitude_nb_accuracy(b):
    """M9 + G7: held-out accuracy, attitude model."""
    return M.accuracy(_nb_predictions(b, "attitude"), "attitude_class").select(_r("accuracy"), "n")


@query
def connectivity_nb_accuracy(b):
    """M9 + G7: held-out accuracy, connectivity model."""
    return M.accuracy(_nb_predictions(b, "connectivity"), "conn_class").select(_r("accuracy"), "n")


# ------------------------------------------------------- communities

def _merge_tree(b) -> DataFrame:
    kept = getattr(b, "merge_tree", None)  # inputs may keep it for all community queries
    return kept if kept is not None else C.merge_tree(b.edges)


def _communities(b) -> DataFrame:
    """As many communities as there are known groups, unless a number is given."""
    k = b.params.n_communities or b.names.agg(F.count_distinct("grp")).first()[0]
    return C.cut_tree(b.names, _merge_tree(b), k)


@query
def community_tree(b):
    """All mergers by average linkage."""
    return _merge_tree(b).select("round", "a", "b", "na", "nb", _r("height"))


@query
def communities(b):
    """Units in as many communities as there are known groups."""
    return _communities(b)


@query
def community_groups(b):
    """Units in each pair of a community and a known group."""
    return C.contingency(_communities(b), b.names)


@query
def community_agreement(b):
    """Agreement of the communities with the known groups."""
    a = C.agreement(C.contingency(_communities(b), b.names))
    return a.select("n_units", "n_left", "n_right", "same_both", "same_left", "same_right", _r("rand_index"), _r("adjusted_rand"))


# ------------------------------------- preparation, tree and chain (O2, O3)

def _unit_table(b) -> DataFrame:
    """Every named unit with its group and attributes, null where unknown."""
    level = b.level.groupBy("unit").agg(F.min("level").alias("level"))
    low = F.col("never") + F.col("rarely") + F.col("sometimes") > F.lit(b.params.attitude_threshold)
    label = F.when(low, 0.0).when(~low, 1.0).alias("attitude_class")
    d = b.names.select("unit", "grp")
    for t in (b.coords.select("unit", "lat", "lon"), E.unit_means(_unit_sums(b), "avg"),
              level, b.results.select("unit", "result"), b.attitudes.select("unit", label)):
        d = d.join(t, "unit", "left")
    return d


def _unit_chain(b) -> list:
    feats = list(M.FEATURES_TREE)
    return [prep.Imputer(dict(M.IMPUTED)), prep.StringIndexer("grp", "grp_index", "keep"),
            prep.VectorIndexer(feats, M.MAX_CATEGORIES, "keep"), T.DecisionTree(feats, "attitude_class")]


def _fitted_chain(b, units: DataFrame | None = None):
    """The chain of the training units; ``units`` is the unit table if it is kept already."""
    train = cut(_unit_table(b).where(M.unit_split())) if units is None else units.where(M.unit_split())
    return chains.Chain(_unit_chain(b)).fit(train)


@query
def imputer_values(b):
    """O3: mean, median or mode of each column of the training units."""
    model = prep.Imputer(dict(M.IMPUTED)).fit(cut(_unit_table(b).where(M.unit_split())))
    rows = [(c, M.IMPUTED[c], None if v is None else round(float(v), DIGITS)) for c, v in model.values.items()]
    return b.spark.createDataFrame(rows, "column string, strategy string, value double")


@query
def imputed_units(b):
    """O3: all units, unknown attributes filled from the training units."""
    units = cut(_unit_table(b))
    d = prep.Imputer(dict(M.IMPUTED)).fit(units.where(M.unit_split())).transform(units)
    return d.select("unit", "grp", *[_r(c) for c in M.IMPUTED], "attitude_class")


@query
def string_index(b):
    """O2: groups in order of frequency."""
    return prep.StringIndexer("grp", "grp_index").fit(b.names).labels.select("label", "n", "index")


@query
def string_round_trip(b):
    """O2: index of each unit's group, and the label back from it."""
    model = prep.StringIndexer("grp", "grp_index").fit(b.names)
    return model.inverse(label="back").transform(model.transform(b.names)).select("unit", "grp", "grp_index", "back")


@query
def vector_index(b):
    """O2: features with few values, and those values' indices."""
    train = cut(_unit_table(b).where(M.unit_split()))
    first = chains.Chain(_unit_chain(b)[:2]).fit(train).transform(train)
    model = prep.VectorIndexer(list(M.FEATURES_TREE), M.MAX_CATEGORIES, "keep").fit(first)
    return model.mapping(first).select("feature", "categorical", _r("value"), "index")


@query
def tree_nodes(b):
    """O2: the attitude tree as rows."""
    t = _fitted_chain(b).stages[-1].table(b.spark)
    return t.select("node", "depth", "feature", _r("threshold"), "categories", "n", "n1")


def _tree_predictions(b) -> DataFrame:
    """Held-out units through the chain after it was saved and loaded."""
    units = cut(_unit_table(b))      # the edges are read once for both parts
    with Rounds(b.spark, "chain") as folder:
        _fitted_chain(b, units).save(b.spark, f"{folder.folder}/saved")
        model = chains.load(b.spark, f"{folder.folder}/saved")
        held_out = units.where(~M.unit_split() & F.col("attitude_class").isNotNull())
        return cut(model.transform(held_out).select("unit", "attitude_class", "prediction"))


@query
def tree_predictions(b):
    """O2 + O3: held-out predictions of the saved and loaded chain."""
    return _tree_predictions(b)


@query
def tree_accuracy(b):
    """O2 + G7: held-out accuracy of the attitude tree."""
    return M.accuracy(_tree_predictions(b), "attitude_class").select(_r("accuracy"), "n")


# ------------------------------------------------------------ clusters (O1)

def _place(b) -> DataFrame:
    return cut(_unit_table(b).select("unit", *M.FEATURES_CLUSTER))


@query
def kmeans_centres(b):
    """O1: k-means of units by place and result: centres, sizes, costs."""
    d = _place(b)
    t = K.k_means(d, list(M.FEATURES_CLUSTER), M.CLUSTERS).table(d, "unit")
    return t.select("cluster", "n", _r("cost"), *[_r(c) for c in M.FEATURES_CLUSTER])


@query
def kmeans_clusters(b):
    """O1: cluster of every unit with all features."""
    d = _place(b)
    return K.k_means(d, list(M.FEATURES_CLUSTER), M.CLUSTERS).assign(d, "unit").select("unit", "cluster", _r("square_distance"))


@query
def bisecting_tree(b):
    """O1: bisecting k-means of the same units: the tree of splits."""
    t = K.bisecting_k_means(_place(b), list(M.FEATURES_CLUSTER), M.CLUSTERS).table(b.spark)
    return t.select("node", "parent", "n", _r("cost"), "leaf", *[_r(c) for c in M.FEATURES_CLUSTER])


@query
def bisecting_clusters(b):
    """O1: leaf of every unit with all features."""
    d = _place(b)
    return K.bisecting_k_means(d, list(M.FEATURES_CLUSTER), M.CLUSTERS).assign(d, "unit")


# ------------------------------------------------------------ sources (S)

@query
def edges_from_text(b):
    """S1 + P7: index text read with a fixed schema, self pairs removed."""
    return b.text_edges()


@query
def series_dictionary_rows(b):
    """Tab-split, trimmed dictionary lines, fields 0,1,2,3,5,6."""
    return b.dictionary_rows()


@query
def adjacency_neighbors(b):
    """S3: sectioned adjacency text -> (unit, name, neighbour)."""
    return b.adjacency()


@query
def parse_results_rows(b):
    """Comma rows with quoted thousands and percent signs."""
    return b.parsed_results()


@query
def malformed_rows(b):
    """S1 + S5: lines of the text sources that do not parse, counted."""
    return b.malformed()


@query
def exclude_groups(b):
    """Parsed result rows without the excluded groups."""
    return b.parsed_results(exclude=b.params.excluded_groups)


@query
def union_partitions(b):
    """The long-format series as one relation from its parts."""
    return b.series
