"""Oracle SQL (DuckDB dialect) for the registered queries.

Each statement recomputes the binding from the raw tables with plain SQL
(a CTE prelude) and then the query itself, independently of the Spark
code.  Models are checked through their closed forms: least squares by
``regr_slope``/``regr_intercept`` and, for several features, by modified
Gram-Schmidt residuals; naive Bayes by its counting formulas.
"""

from __future__ import annotations

D = 6  # rounding digits, as in the catalog

K = "(180.0 / pi())"
KM = ("acos(least(1.0, greatest(-1.0, sin({a}.lat / {K}) * sin({b}.lat / {K}) "
      "+ cos({a}.lat / {K}) * cos({b}.lat / {K}) * cos({b}.lon / {K} - {a}.lon / {K})))) * 6378.8")


def km(a: str, b: str) -> str:
    return KM.format(a=a, b=b, K=K)


def _sid(unit: str, measure: str) -> str:
    """Series id: the unit padded with zeros to six digits, longer ids whole."""
    text = f"CAST({unit} AS VARCHAR)"
    return f"(CASE WHEN length({text}) < 6 THEN lpad({text}, 6, '0') ELSE {text} END) || '{measure}'"


# The split: the whole id times a multiplier, modulo a prime, then modulo 1000.
UNIT_TRAIN = "((((unit % 998244353) * 134775813 + 104729) % 998244353) % 1000 < 700)"
PAIR_TRAIN = "((((u1 % 998244353) * 134775813 + (u2 % 998244353) * 630360016) % 998244353) % 1000 < 800)"


def _level_cte(name: str, measure: str, alias: str) -> str:
    return f"""{name} AS (
  SELECT nm.unit, v.value AS {alias}
  FROM b_series v
  JOIN b_dict d ON v.sid = d.sid
  JOIN b_region r ON r.srd = d.srd
  JOIN b_names nm ON nm.grp = r.state AND contains(d.title, nm.name)
  WHERE v.year = 1998 AND v.period = 'M13' AND ends_with(v.sid, '{measure}') AND d.area_type = 'F')"""


PRELUDE = [
    """b_inc AS (SELECT DISTINCT l_orderkey AS g, l_suppkey AS u FROM lineitem
  WHERE l_orderkey IS NOT NULL AND l_suppkey IS NOT NULL)""",
    "b_deg AS (SELECT u, count(*) AS n FROM b_inc GROUP BY u)",
    """b_raw AS (
  SELECT a.u AS u1, b.u AS u2, CAST(floor(1e9 * count(*) / (CAST(da.n AS DOUBLE) * CAST(db.n AS DOUBLE))) AS BIGINT) AS w
  FROM b_inc a JOIN b_inc b ON a.g = b.g
  JOIN b_deg da ON da.u = a.u JOIN b_deg db ON db.u = b.u
  GROUP BY a.u, b.u, da.n, db.n)""",
    "b_edges AS (SELECT u1, u2, w FROM b_raw WHERE u1 <> u2)",
    """b_coords AS (
  SELECT s_suppkey AS unit,
         CASE WHEN s_suppkey % 25 = 24 THEN NULL ELSE 20 + ((s_suppkey * 7919) % 3200) / 100 END AS lat,
         CASE WHEN s_suppkey % 25 = 24 THEN NULL ELSE -132 + ((s_suppkey * 104729) % 7500) / 100 END AS lon
  FROM supplier)""",
    """b_box AS (SELECT unit, lat, lon FROM b_coords
  WHERE lon < -60.0 AND lon > -130.0 AND lat > 20.0 AND lat < 50.0)""",
    """b_att AS (
  SELECT unit,
         avg(CAST(prio = '1' AS DOUBLE)) AS never, avg(CAST(prio = '2' AS DOUBLE)) AS rarely,
         avg(CAST(prio = '3' AS DOUBLE)) AS sometimes, avg(CAST(prio = '4' AS DOUBLE)) AS freq,
         avg(CAST(prio = '5' AS DOUBLE)) AS always
  FROM (SELECT DISTINCT l.l_orderkey AS o, l.l_suppkey AS unit, substr(o.o_orderpriority, 1, 1) AS prio
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
  GROUP BY unit)""",
    """b_res AS (SELECT l_suppkey AS unit, avg(CAST(l_returnflag = 'R' AS DOUBLE)) AS result
  FROM lineitem GROUP BY l_suppkey)""",
    """b_names AS (SELECT s.s_suppkey AS unit, 'Unit ' || CAST(s.s_suppkey AS VARCHAR) AS name, n.n_name AS grp
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey)""",
    "b_region AS (SELECT CAST(n_nationkey AS VARCHAR) AS srd, n_name AS state FROM nation)",
    """b_monthly AS (
  SELECT l_suppkey AS unit, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
         sum(l_quantity) AS qty, count(*) AS n, count_if(l_linestatus = 'O') AS n_open
  FROM lineitem GROUP BY 1, 2, 3)""",
    """b_yearly AS (SELECT unit, year, sum(qty) AS qty, sum(n) AS n, sum(n_open) AS n_open
  FROM b_monthly GROUP BY unit, year)""",
    f"""b_series AS (
  SELECT {_sid('unit', '06')} AS sid, year, 'M' || lpad(CAST(month AS VARCHAR), 2, '0') AS period, qty AS value FROM b_monthly
  UNION ALL SELECT {_sid('unit', '06')}, year, 'M13', qty / 12 FROM b_yearly
  UNION ALL SELECT {_sid('unit', '03')}, year, 'M13', n_open / n FROM b_yearly)""",
    f"""b_dict AS (
  SELECT {_sid('s.s_suppkey', '06')} AS sid, 'F' AS area_type, CAST(s.s_nationkey AS VARCHAR) AS srd,
         'Level: Unit ' || CAST(s.s_suppkey AS VARCHAR) || ', ' || n.n_name AS title
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  UNION ALL
  SELECT {_sid('s.s_suppkey', '03')}, 'F', CAST(s.s_nationkey AS VARCHAR),
         'Rate: Unit ' || CAST(s.s_suppkey AS VARCHAR) || ', ' || n.n_name
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey)""",
    _level_cte("b_level", "06", "level"),
    _level_cte("b_rate", "03", "rate"),
    """b_avg AS (SELECT u1 AS unit, avg(w) AS avg FROM b_edges GROUP BY u1)""",
    """b_profile AS (
  SELECT a.unit, c.lon, c.lat, a.avg, l.level, r.result, t.never, t.rarely, t.sometimes, t.freq, t.always
  FROM b_avg a JOIN b_box c ON c.unit = a.unit JOIN b_level l ON l.unit = a.unit
  JOIN b_att t ON t.unit = a.unit JOIN b_res r ON r.unit = a.unit)""",
    """b_wide AS (
  SELECT c.unit, c.lat, c.lon, r.rate, s.result, a.never + a.rarely AS att
  FROM b_coords c JOIN b_rate r ON r.unit = c.unit JOIN b_res s ON s.unit = c.unit JOIN b_att a ON a.unit = c.unit
  WHERE c.lat IS NOT NULL AND c.lon IS NOT NULL)""",
    f"""b_pf AS (
  SELECT e.u1, e.u2, ln(e.w) AS ln_w, abs(x.att - y.att) AS gap_att, abs(x.result - y.result) AS gap_result,
         ln({km('x', 'y')}) AS ln_km, abs(x.rate - y.rate) AS gap_rate
  FROM b_edges e JOIN b_wide x ON x.unit = e.u1 JOIN b_wide y ON y.unit = e.u2
  WHERE e.w > 0 AND {km('x', 'y')} > 0)""",
    f"b_pf_train AS (SELECT * FROM b_pf WHERE {PAIR_TRAIN})",
]


def sql(select: str, *extra: str) -> str:
    return "WITH " + ",\n".join(PRELUDE + list(extra)) + "\n" + select


def _lines_cte() -> str:
    def scaled(c: str) -> str:
        return f"CASE unit % 3 WHEN 0 THEN {c} // 100 WHEN 1 THEN {c} ELSE {c} * 1000 END"
    return f"""b_lines AS (
  SELECT q.unit AS line_num, q.d AS d_votes, q.r AS r_votes, q.t AS total_votes,
         q.d / q.t AS per_dem, q.r / q.t AS per_rep, abs(q.d - q.r) AS diff,
         ((abs(q.d - q.r) * 10000) // q.t) / 100 AS per_pt_diff,
         nm.grp AS state, nm.name AS county, CAST(q.unit AS VARCHAR) AS fips
  FROM (SELECT unit, {scaled('d')} AS d, {scaled('r')} AS r, {scaled('t')} AS t
        FROM (SELECT l_suppkey AS unit,
                     CAST(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END) AS BIGINT) AS d,
                     CAST(sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity ELSE 0.0 END) AS BIGINT) AS r,
                     CAST(sum(l_quantity) AS BIGINT) AS t
              FROM lineitem GROUP BY l_suppkey)) q
  JOIN b_names nm ON nm.unit = q.unit)"""


def _mgs_rmse(source: str, features: list[str], y: str = "ln_w") -> tuple[str, list[str]]:
    """Training RMSE of least squares with intercept via modified
    Gram-Schmidt: centre, then residualise the remaining columns on each
    orthogonal direction in turn; what is left of y is the residual."""
    cols = features + [y]
    ctes = [f"g_mean AS (SELECT {', '.join(f'avg({c}) AS m_{c}' for c in cols)}, count(*) AS n FROM {source})",
            f"g0 AS (SELECT {', '.join(f'{c} - m_{c} AS {c}' for c in cols)} FROM {source}, g_mean)"]
    prev = "g0"
    for i, f in enumerate(features):
        rest = cols[i + 1:]
        sums = ", ".join([f"sum({f} * {f}) AS ss"] + [f"sum({c} * {f}) AS s_{c}" for c in rest])
        ctes.append(f"a{i} AS (SELECT {sums} FROM {prev})")
        upd = ", ".join(f"{c} - (s_{c} / ss) * {f} AS {c}" for c in rest)
        ctes.append(f"g{i + 1} AS (SELECT {upd} FROM {prev}, a{i})")
        prev = f"g{i + 1}"
    select = f"SELECT round(sqrt(avg({y} * {y})), {D}) AS rmse, count(*) AS n FROM {prev}"
    return select, ctes


def _nb_sql(label_expr: str, label: str, features: list[str], extra_where: str = "") -> list[str]:
    """CTEs nb_data (labelled rows + split flag), nb_par (one row per class),
    nb_pred (held-out rows with prediction)."""
    fsum = " + ".join(f"s_{f}" for f in features)
    data = f"""nb_data AS (SELECT *, {label_expr} AS {label},
  {UNIT_TRAIN} AS is_train FROM b_profile {extra_where})"""
    cls = f"""nb_cls AS (SELECT {label} AS label, count(*) AS n_c, {', '.join(f'sum({f}) AS s_{f}' for f in features)}
  FROM nb_data WHERE is_train GROUP BY {label})"""
    tot = "nb_tot AS (SELECT sum(n_c) AS n_all, count(*) AS n_cls FROM nb_cls)"
    par = f"""nb_par AS (SELECT label, ln(n_c + 1.0) - ln(n_all + n_cls * 1.0) AS pi,
  {', '.join(f'ln(s_{f} + 1.0) - ln({fsum} + {len(features)}.0) AS t_{f}' for f in features)}
  FROM nb_cls, nb_tot)"""
    piv = ", ".join([f"max(CASE WHEN label = {c}.0 THEN pi END) AS pi{c}" for c in (0, 1)]
                    + [f"max(CASE WHEN label = {c}.0 THEN t_{f} END) AS t{c}_{f}" for c in (0, 1) for f in features])
    one = f"nb_par1 AS (SELECT {piv} FROM nb_par)"
    s0 = " + ".join(["pi0"] + [f"d.{f} * t0_{f}" for f in features])
    s1 = " + ".join(["pi1"] + [f"d.{f} * t1_{f}" for f in features])
    # two classes: predict 1.0 only when its score is strictly larger (ties -> lower class)
    pred = f"""nb_pred AS (SELECT d.unit, d.{label}, CASE WHEN ({s1}) > ({s0}) THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS prediction
  FROM nb_data d, nb_par1 WHERE NOT d.is_train)"""
    return [data, cls, tot, par, one, pred]


ATT_LABEL = "CASE WHEN never + rarely + sometimes > 0.6 THEN CAST(0.0 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END"
CONN_LABEL = "CASE WHEN avg < (SELECT avg(w) FROM b_edges) THEN CAST(0.0 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END"
ATT_F = ["avg", "level", "result"]
CONN_F = ["level", "never", "rarely", "sometimes", "freq", "always", "result"]


def _community_ctes() -> list[str]:
    """The rounds of reciprocal mergers as a recursion over (edges, mergers),
    and the groups that are left when the last mergers are undone."""
    tree = """cm(rd, merger, a, b, total, na, nb, height) AS (
  SELECT 0, false, least(u1, u2), greatest(u1, u2), CAST(sum(w) AS BIGINT), CAST(1 AS BIGINT), CAST(1 AS BIGINT), CAST(NULL AS DOUBLE)
  FROM b_edges GROUP BY 3, 4 HAVING sum(w) > 0
  UNION ALL
  (WITH e AS (SELECT rd, a, b, total, na, nb, CAST(total AS DOUBLE) / CAST(na * nb AS DOUBLE) AS s FROM cm WHERE NOT merger),
   ends AS (SELECT a AS node, * FROM e UNION ALL SELECT b AS node, * FROM e),
   best AS (SELECT * FROM ends QUALIFY row_number() OVER (PARTITION BY node ORDER BY s DESC, a, b) = 1),
   m AS (SELECT a, b, any_value(rd) AS rd, any_value(na) AS na, any_value(nb) AS nb, any_value(s) AS s FROM best GROUP BY a, b HAVING count(*) = 2),
   new AS (SELECT a AS old, a AS new, na + nb AS size FROM m UNION ALL SELECT b, a, na + nb FROM m),
   r AS (SELECT e.rd, coalesce(x.new, e.a) AS a, coalesce(y.new, e.b) AS b, e.total,
                coalesce(x.size, e.na) AS na, coalesce(y.size, e.nb) AS nb
         FROM e LEFT JOIN new x ON x.old = e.a LEFT JOIN new y ON y.old = e.b)
   SELECT any_value(rd) + 1, false, least(a, b), greatest(a, b), CAST(sum(total) AS BIGINT),
          any_value(CASE WHEN a < b THEN na ELSE nb END), any_value(CASE WHEN a < b THEN nb ELSE na END), NULL
   FROM r WHERE a <> b GROUP BY 3, 4
   UNION ALL SELECT rd, true, a, b, NULL, na, nb, s FROM m))"""
    return [
        tree, "ct AS (SELECT rd AS round, a, b, na, nb, height FROM cm WHERE merger)",
        "ck AS (SELECT greatest(0, (SELECT count(DISTINCT grp) FROM b_names) - (SELECT count(*) FROM b_names) + (SELECT count(*) FROM ct)) AS undone)",
        """cu AS (SELECT a, b FROM (SELECT *, row_number() OVER (ORDER BY height, round DESC, a DESC, b DESC) AS place FROM ct), ck
  WHERE place > undone)""",
        """cw(node, top) AS (SELECT unit, unit FROM b_names UNION ALL SELECT cw.node, cu.a FROM cw JOIN cu ON cu.b = cw.top)""",
        "cc AS (SELECT node AS unit, min(top) AS community FROM cw GROUP BY node)",
        "cg AS (SELECT community, grp, count(*) AS n FROM cc JOIN b_names ON b_names.unit = cc.unit GROUP BY ALL)",
    ]


def _unit_ctes() -> list[str]:
    """Units with gaps filled, labels and small sets of values indexed (u_x:
    features as a list), from the training units' statistics."""
    imputed = ["lat", "lon", "avg", "level", "result"]
    return [
        f"""u_t AS (SELECT *, {UNIT_TRAIN} AS is_train FROM (
  SELECT nm.unit, nm.grp, CAST(c.lat AS DOUBLE) AS lat, CAST(c.lon AS DOUBLE) AS lon, a.avg, CAST(l.level AS DOUBLE) AS level, r.result,
         CASE WHEN t.never + t.rarely + t.sometimes > 0.6 THEN CAST(0 AS DOUBLE)
              WHEN t.never + t.rarely + t.sometimes <= 0.6 THEN CAST(1 AS DOUBLE) END AS attitude_class
  FROM b_names nm LEFT JOIN b_coords c ON c.unit = nm.unit LEFT JOIN b_avg a ON a.unit = nm.unit
  LEFT JOIN (SELECT unit, min(level) AS level FROM b_level GROUP BY unit) l ON l.unit = nm.unit
  LEFT JOIN b_res r ON r.unit = nm.unit LEFT JOIN b_att t ON t.unit = nm.unit))""",
        """u_im AS (SELECT avg(lat) AS lat, median(lon) AS lon, avg(avg) AS avg, median(level) AS level,
  (SELECT result FROM u_t WHERE is_train AND result IS NOT NULL GROUP BY result ORDER BY count(*) DESC, result LIMIT 1) AS result
  FROM u_t WHERE is_train)""",
        "u_i AS (SELECT u.unit, u.grp, u.is_train, u.attitude_class, "
        + ", ".join(f"coalesce(u.{c}, u_im.{c}) AS {c}" for c in imputed) + " FROM u_t u, u_im)",
        """u_s AS (SELECT grp AS label, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, grp) - 1 AS DOUBLE) AS idx
  FROM u_i WHERE is_train AND grp IS NOT NULL GROUP BY grp)""",
        f"""u_l AS (SELECT unit, is_train, attitude_class, unnest([{', '.join(imputed)}, coalesce(idx, CAST((SELECT count(*) FROM u_s) AS DOUBLE))]) AS v,
  unnest(range({len(imputed) + 1})) AS f FROM u_i LEFT JOIN u_s ON u_s.label = u_i.grp)""",
        "u_n AS (SELECT f, count(DISTINCT v) AS n FROM u_l WHERE is_train GROUP BY f)",
        """u_m AS (SELECT f, v, CAST(row_number() OVER (PARTITION BY f ORDER BY v) - 1 AS DOUBLE) AS idx
  FROM (SELECT DISTINCT f, v FROM u_l WHERE is_train AND v IS NOT NULL) WHERE f IN (SELECT f FROM u_n WHERE n <= 25))""",
        """u_x AS (SELECT unit, is_train, attitude_class AS y,
  list(CASE WHEN u_n.n <= 25 THEN coalesce(u_m.idx, u_n.n) ELSE l.v END ORDER BY l.f) AS x
  FROM u_l l JOIN u_n ON u_n.f = l.f LEFT JOIN u_m ON u_m.f = l.f AND u_m.v = l.v GROUP BY unit, is_train, attitude_class)""",
    ]


TREE_FEATURES = ["lat", "lon", "avg", "level", "result", "grp_index"]


def _tree_ctes(depth: int = 4, bins: int = 32, least: int = 2) -> list[str]:
    """The tree as a recursion over (rows with their node, splits)."""
    pure = "({1} * {1} + ({0} - {1}) * ({0} - {1})) / {0}"
    tree = f"""tr(lv, split, node, y, x, f, t, cats) AS (
  SELECT 0, false, CAST(1 AS BIGINT), CAST(y AS BIGINT), x, CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE[])
  FROM u_x WHERE is_train AND y IS NOT NULL AND len(list_filter(x, lambda v: v IS NULL)) = 0
  UNION ALL
  (WITH d AS (SELECT lv, node, y, x FROM tr WHERE NOT split AND lv < {depth}),
   tot AS (SELECT node, CAST(count(*) AS DOUBLE) AS n, CAST(sum(y) AS DOUBLE) AS n1 FROM d GROUP BY node),
   u AS (SELECT node, y, unnest(x) AS x, unnest(range({len(TREE_FEATURES)})) AS f FROM d),
   rg AS (SELECT node, f, min(x) AS lo, max(x) AS hi FROM u GROUP BY node, f),
   b AS (SELECT u.node, u.f, u.x, u.y, u_n.n <= 25 AS cat,
                CASE WHEN u_n.n <= 25 THEN x ELSE least(floor((x - lo) / (hi - lo) * {bins}), {bins - 1}) END AS bin
         FROM u JOIN rg ON rg.node = u.node AND rg.f = u.f JOIN u_n ON u_n.f = u.f WHERE hi > lo),
   h AS (SELECT node, f, cat, bin, CAST(count(*) AS DOUBLE) AS n, CAST(sum(y) AS DOUBLE) AS n1, max(x) AS t FROM b GROUP BY ALL),
   o AS (SELECT *, row_number() OVER w AS k, sum(n) OVER w AS ln, sum(n1) OVER w AS l1
         FROM h WINDOW w AS (PARTITION BY node, f ORDER BY CASE WHEN cat THEN n1 / n ELSE 0 END, bin ROWS UNBOUNDED PRECEDING)),
   s AS (SELECT o.*, {pure.format('ln', 'l1')} + {pure.format('(tot.n - ln)', '(tot.n1 - l1)')} AS score
         FROM o JOIN tot ON tot.node = o.node
         WHERE ln >= {least} AND tot.n - ln >= {least} AND tot.n1 > 0 AND tot.n1 < tot.n),
   best AS (SELECT s.* FROM s JOIN tot ON tot.node = s.node WHERE score > {pure.format('tot.n', 'tot.n1')} * (1 + 1e-9)
            QUALIFY row_number() OVER (PARTITION BY s.node ORDER BY score DESC, f, k) = 1),
   cs AS (SELECT best.node, list(o.bin ORDER BY o.bin) AS cats FROM best JOIN o ON o.node = best.node AND o.f = best.f AND o.k <= best.k
          WHERE best.cat GROUP BY best.node)
   SELECT d.lv + 1, false, 2 * d.node + CASE WHEN best.cat THEN CAST(NOT list_contains(cs.cats, d.x[best.f + 1]) AS BIGINT)
                                             ELSE CAST(d.x[best.f + 1] > best.t AS BIGINT) END, d.y, d.x, NULL, NULL, NULL
   FROM d JOIN best ON best.node = d.node LEFT JOIN cs ON cs.node = d.node
   UNION ALL SELECT NULL, true, best.node, NULL, NULL, best.f, CASE WHEN NOT best.cat THEN best.t END, cs.cats
   FROM best LEFT JOIN cs ON cs.node = best.node))"""
    nodes = """tn AS (SELECT r.node, count(*) AS n, CAST(sum(r.y) AS BIGINT) AS n1, any_value(s.f) AS f, any_value(s.t) AS t, any_value(s.cats) AS cats
  FROM tr r LEFT JOIN tr s ON s.split AND s.node = r.node WHERE NOT r.split GROUP BY r.node)"""
    walk = """tp(unit, y, x, node) AS (
  SELECT unit, y, x, CAST(1 AS BIGINT) FROM u_x WHERE NOT is_train AND y IS NOT NULL AND len(list_filter(x, lambda v: v IS NULL)) = 0
  UNION ALL
  SELECT tp.unit, tp.y, tp.x, 2 * tp.node + CASE WHEN tn.cats IS NOT NULL THEN CAST(NOT list_contains(tn.cats, tp.x[tn.f + 1]) AS BIGINT)
                                                 ELSE CAST(tp.x[tn.f + 1] > tn.t AS BIGINT) END
  FROM tp JOIN tn ON tn.node = tp.node WHERE tn.f IS NOT NULL)"""
    pred = """tq AS (SELECT tp.unit, tp.y AS attitude_class, CAST(coalesce(2 * tn.n1 > tn.n, false) AS INTEGER)::DOUBLE AS prediction
  FROM (SELECT unit, max(node) AS node, any_value(y) AS y FROM tp GROUP BY unit) tp LEFT JOIN tn ON tn.node = tp.node)"""
    return _unit_ctes() + [tree, nodes, walk, pred]


CLUSTER_FEATURES = ["lat", "lon", "result"]


def _dist(a: str, b: str) -> str:
    return "(" + " + ".join(f"({a}.x{i} - {b}.x{i}) * ({a}.x{i} - {b}.x{i})" for i in range(len(CLUSTER_FEATURES))) + ")"


def _point_ctes() -> list[str]:
    """Units with all features, these brought to 0..1."""
    ok = " AND ".join(f"{c} IS NOT NULL" for c in CLUSTER_FEATURES)
    ends = ", ".join(f"min({c}) AS lo{i}, max({c}) AS hi{i}" for i, c in enumerate(CLUSTER_FEATURES))
    x = ", ".join(f"CASE WHEN hi{i} > lo{i} THEN ({c} - lo{i}) / (hi{i} - lo{i}) ELSE CAST(0 AS DOUBLE) END AS x{i}"
                  for i, c in enumerate(CLUSTER_FEATURES))
    mid = ", ".join(f"avg(x{i}) AS x{i}" for i in range(len(CLUSTER_FEATURES)))
    return _unit_ctes()[:1] + [f"k_e AS (SELECT {ends} FROM u_t WHERE {ok})", f"k_p AS (SELECT unit AS id, {x} FROM u_t, k_e WHERE {ok})",
                               f"k_mid AS (SELECT {mid} FROM k_p)"]


def _xs(table: str = "", wrap: str = "{}") -> str:
    return ", ".join(wrap.format(f"{table}x{i}") for i in range(len(CLUSTER_FEATURES)))


def _back() -> str:
    return ", ".join(f"round(lo{i} + x{i} * (hi{i} - lo{i}), {D}) AS {c}" for i, c in enumerate(CLUSTER_FEATURES))


def _kmeans_ctes(k: int = 5, rounds: int = 20) -> list[str]:
    avg = ", ".join(f"coalesce(avg(a.x{i}), any_value(c.x{i}))" for i in range(len(CLUSTER_FEATURES)))
    return _point_ctes() + [
        f"k_0 AS (SELECT k_p.* FROM k_p, k_mid ORDER BY {_dist('k_p', 'k_mid')} DESC, id LIMIT 1)",
        f"""k_f(i, pick, id, {_xs()}, d) AS (
  SELECT 1, false, k_p.id, {_xs('k_p.')}, {_dist('k_p', 'k_0')} FROM k_p, k_0 UNION ALL SELECT 1, true, id, {_xs()}, NULL FROM k_0
  UNION ALL
  (WITH r AS (SELECT * FROM k_f WHERE NOT pick AND i < {k}), b AS (SELECT * FROM r WHERE d > 0 ORDER BY d DESC, id LIMIT 1)
   SELECT r.i + 1, false, r.id, {_xs('r.')}, least(r.d, {_dist('r', 'b')}) FROM r, b
   UNION ALL SELECT i + 1, true, id, {_xs()}, NULL FROM b))""",
        f"""k_c(it, cluster, {_xs()}) AS (
  SELECT 0, i - 1, {_xs()} FROM k_f WHERE pick
  UNION ALL
  (WITH c AS (SELECT * FROM k_c WHERE it < {rounds}),
   a AS (SELECT p.*, c.cluster FROM k_p p, c QUALIFY row_number() OVER (PARTITION BY p.id ORDER BY {_dist('p', 'c')}, c.cluster) = 1)
   SELECT any_value(c.it) + 1, c.cluster, {avg} FROM c LEFT JOIN a ON a.cluster = c.cluster GROUP BY c.cluster))""",
        f"k_l AS (SELECT cluster, {_xs()} FROM k_c WHERE it = {rounds})",
        f"""k_a AS (SELECT p.id AS unit, l.cluster, {_dist('p', 'l')} AS d FROM k_p p, k_l l
  QUALIFY row_number() OVER (PARTITION BY p.id ORDER BY {_dist('p', 'l')}, l.cluster) = 1)""",
    ]


def _bisecting_ctes(k: int = 5, rounds: int = 20) -> list[str]:
    """Splits one after the other, each ``rounds`` + 1 steps: the first picks
    a leaf and two rows of it, the others average and assign again."""
    steps = rounds + 1
    mean = ", ".join(f"avg(x{i}) AS x{i}" for i in range(len(CLUSTER_FEATURES)))
    return _point_ctes() + [
        f"""h(s, id, {_xs()}, node, side) AS (
  SELECT 0, id, {_xs()}, CAST(1 AS BIGINT), CAST(NULL AS BIGINT) FROM k_p
  UNION ALL
  (WITH d AS (SELECT * FROM h WHERE s < {(k - 1) * steps}),
   st AS (SELECT any_value(s) % {steps} AS t FROM d),
   mid AS (SELECT node, count(*) AS n, {mean} FROM d GROUP BY node),
   cost AS (SELECT d.node, sum({_dist('d', 'mid')}) AS cost, any_value(mid.n) AS n FROM d JOIN mid ON mid.node = d.node GROUP BY d.node),
   pick AS (SELECT node FROM cost, st WHERE t = 0 AND cost > 1e-18 * n ORDER BY cost DESC, node LIMIT 1),
   f1 AS (SELECT d.* FROM d JOIN pick ON pick.node = d.node JOIN mid ON mid.node = d.node ORDER BY {_dist('d', 'mid')} DESC, d.id LIMIT 1),
   f2 AS (SELECT d.* FROM d JOIN pick ON pick.node = d.node, f1 ORDER BY {_dist('d', 'f1')} DESC, d.id LIMIT 1),
   c AS (SELECT CAST(0 AS BIGINT) AS side, {_xs()} FROM f1 UNION ALL SELECT 1, {_xs()} FROM f2
         UNION ALL SELECT side, {mean} FROM d, st WHERE t > 0 AND side IS NOT NULL GROUP BY side),
   c0 AS (SELECT * FROM c WHERE side = 0), c1 AS (SELECT * FROM c WHERE side = 1),
   n AS (SELECT d.s, d.id, {_xs('d.')}, d.node,
                CASE WHEN d.node IN (SELECT node FROM pick) OR d.side IS NOT NULL
                     THEN CASE WHEN {_dist('d', 'c0')} <= {_dist('d', 'c1')} THEN 0 ELSE 1 END END AS side, st.t
         FROM d CROSS JOIN st LEFT JOIN c0 ON true LEFT JOIN c1 ON true)
   SELECT s + 1, id, {_xs()}, CASE WHEN t = {steps - 1} AND side IS NOT NULL THEN 2 * node + side ELSE node END,
          CASE WHEN t = {steps - 1} THEN NULL ELSE CAST(side AS BIGINT) END FROM n))""",
        f"h_a AS (SELECT id AS unit, node FROM h WHERE s = {(k - 1) * steps})",
        f"""h_n AS (SELECT DISTINCT node, id, {_xs()} FROM h WHERE side IS NULL AND s % {steps} = 0)""",
        f"h_m AS (SELECT node, count(*) AS n, {mean} FROM h_n GROUP BY node)",
        f"""h_c AS (SELECT h_n.node, sum({_dist('h_n', 'h_m')}) AS cost FROM h_n JOIN h_m ON h_m.node = h_n.node GROUP BY h_n.node)""",
    ]


def recursive(select: str, *extra: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(PRELUDE + list(extra)) + "\n" + select


def _oracles() -> dict[str, str]:
    o: dict[str, str] = {}
    o["connectivity_index"] = sql("SELECT u1, u2, w FROM b_raw")
    o["edges_no_self"] = sql("SELECT u1, u2, w FROM b_edges")
    o["avg_connectivity"] = sql("SELECT u1 AS unit, avg(w) AS avg_score FROM b_edges GROUP BY u1")
    o["max_connectivity"] = sql("SELECT u1 AS unit, max(w) AS max_score FROM b_edges GROUP BY u1")
    o["avg_connectivity_coords"] = sql(
        "SELECT a.unit, c.lon, c.lat, a.avg AS avg_score FROM b_avg a JOIN b_box c ON c.unit = a.unit")
    o["max_connectivity_coords"] = sql(
        "SELECT c.unit, c.lon, c.lat, m.max_score FROM (SELECT u1 AS unit, max(w) AS max_score FROM b_edges GROUP BY u1) m "
        "JOIN b_box c ON c.unit = m.unit")
    o["one_unit_fanout"] = sql(
        "SELECT e.u2, c.lon, c.lat, e.w FROM b_edges e JOIN b_box c ON c.unit = e.u2 WHERE e.u1 = 1")
    o["bbox_units"] = sql("SELECT unit, lat, lon FROM b_box")
    o["same_group_pairs"] = sql(
        "SELECT e.u1, e.u2, e.w FROM b_edges e JOIN b_names a ON a.unit = e.u1 JOIN b_names b ON b.unit = e.u2 "
        "WHERE a.grp = b.grp")
    o["same_prefix_pairs"] = sql(
        "SELECT u1, u2, w FROM b_edges WHERE substr(CAST(u1 AS VARCHAR), 1, 1) = substr(CAST(u2 AS VARCHAR), 1, 1)")
    be = """SELECT {key} round(avg(CASE WHEN same THEN w END), {D}) AS avg_same,
  round(avg(CASE WHEN NOT same THEN w END), {D}) AS avg_cross,
  CAST(count_if(same) AS BIGINT) AS n_same, CAST(count_if(NOT same) AS BIGINT) AS n_cross,
  round(avg(CASE WHEN same THEN w END) / NULLIF(avg(CASE WHEN NOT same THEN w END), 0), {D}) AS ratio
FROM (SELECT e.u1, e.w, a.grp = b.grp AS same FROM b_edges e
      JOIN b_names a ON a.unit = e.u1 JOIN b_names b ON b.unit = e.u2) {group}"""
    o["border_effect"] = sql(be.format(key="u1 AS unit,", D=D, group="GROUP BY u1"))
    o["border_effect_overall"] = sql(be.format(key="", D=D, group=""))
    o["map_color_class"] = sql(f"""SELECT unit, lon, lat, avg_score,
  CASE WHEN avg_score >= 100000.0 THEN 3 WHEN avg_score >= 10000.0 THEN 2 WHEN avg_score >= 1000.0 THEN 1 ELSE 0 END AS color_stop,
  round(CASE WHEN avg_score >= 100000.0 THEN 1.0
             WHEN avg_score >= 10000.0 THEN (avg_score - 10000.0) / 90000.0
             WHEN avg_score >= 1000.0 THEN (avg_score - 1000.0) / 9000.0
             WHEN avg_score >= 0.0 THEN (avg_score - 0.0) / 1000.0 ELSE 0.0 END, {D}) AS color_pos
FROM (SELECT a.unit, c.lon, c.lat, a.avg AS avg_score FROM b_avg a JOIN b_box c ON c.unit = a.unit)""")

    def colors(value: str, stops) -> tuple[str, str]:
        stop = "CASE " + " ".join(f"WHEN {value} >= {float(s)} THEN {i}" for i, s in reversed(list(enumerate(stops)))
                                  if i > 0) + " ELSE 0 END"
        pos = (f"CASE WHEN {value} >= {float(stops[-1])} THEN 1.0 "
               + " ".join(f"WHEN {value} >= {float(lo)} THEN ({value} - {float(lo)}) / {float(hi - lo)}"
                          for lo, hi in reversed(list(zip(stops[:-1], stops[1:]))))
               + " ELSE 0.0 END")
        return stop, pos
    st, ps = colors("max_score", (50000.0, 1000000.0, 20000000.0, 30000000.0))
    o["map_color_max"] = sql(f"""SELECT unit, lon, lat, max_score, {st} AS color_stop, round({ps}, {D}) AS color_pos
FROM (SELECT c.unit, c.lon, c.lat, m.max_score FROM (SELECT u1 AS unit, max(w) AS max_score FROM b_edges GROUP BY u1) m
      JOIN b_box c ON c.unit = m.unit)""")
    st, ps = colors("w", (1.0, 10000.0, 200000.0, 5000000.0))
    o["fanout_color"] = sql(f"""SELECT u2, lon, lat, w, {st} AS color_stop, round({ps}, {D}) AS color_pos
FROM (SELECT e.u2, c.lon, c.lat, e.w FROM b_edges e JOIN b_box c ON c.unit = e.u2 WHERE e.u1 = 1)""")

    def hist(src: str, col: str, start: float, stop: float, step: float) -> str:
        n = int((stop - start) // step)          # edges that do not pass stop
        last = start + n * step
        return sql(f"""SELECT CAST(k.bucket AS INTEGER) AS bucket,
  CAST({start} AS DOUBLE) + k.bucket * CAST({step} AS DOUBLE) AS lo,
  CAST({start} AS DOUBLE) + (k.bucket + 1) * CAST({step} AS DOUBLE) AS hi, CAST(coalesce(c.cnt, 0) AS BIGINT) AS count
FROM (SELECT range AS bucket FROM range({n})) k
LEFT JOIN (SELECT least(CAST(floor((CAST({col} AS DOUBLE) - {start}) / {step}) AS INTEGER), {n - 1}) AS bucket,
                  count(*) AS cnt
           FROM {src} WHERE {col} >= {start} AND {col} <= {last} GROUP BY 1) c ON c.bucket = k.bucket""")
    o["hist_weight"] = hist("b_edges", "w", 1000.0, 1000000.0, 1000.0)
    o["hist_max"] = hist("(SELECT u1, max(w) AS max_score FROM b_edges GROUP BY u1)", "max_score",
                         0.0, 1004000.0, 10000.0)
    edges = (0.0, 500.0, 20000.0, 300000.0, 1000000000.0)
    rows = ", ".join(f"({i}, CAST({lo} AS DOUBLE), CAST({hi} AS DOUBLE))" for i, (lo, hi) in enumerate(zip(edges, edges[1:])))
    o["hist_edges"] = sql(f"""SELECT CAST(k.bucket AS INTEGER) AS bucket, k.lo, k.hi, CAST(count(e.w) AS BIGINT) AS count
FROM (VALUES {rows}) k(bucket, lo, hi)
LEFT JOIN b_edges e ON e.w >= k.lo AND (e.w < k.hi OR (k.bucket = {len(edges) - 2} AND e.w = k.hi))
GROUP BY k.bucket, k.lo, k.hi""")

    o["title_match"] = sql("""SELECT nm.unit, d.sid, d.title FROM b_dict d JOIN b_region r ON r.srd = d.srd
  JOIN b_names nm ON nm.grp = r.state AND contains(d.title, nm.name)""")
    o["title_match_longest"] = sql("""SELECT unit, sid, title FROM (
  SELECT nm.unit, d.sid, d.title, length(nm.name) AS l,
         max(length(nm.name)) OVER (PARTITION BY d.sid, d.title, r.state) AS best
  FROM b_dict d JOIN b_region r ON r.srd = d.srd
  JOIN b_names nm ON nm.grp = r.state AND contains(d.title, nm.name)) WHERE l = best""")
    o["level_by_unit"] = sql("SELECT unit, level FROM b_level")
    o["rate_by_unit"] = sql("SELECT unit, rate FROM b_rate")
    o["edge_level"] = sql("SELECT e.u1, e.u2, e.w, l.level FROM b_edges e JOIN b_level l ON l.unit = e.u1")
    o["unit_profile"] = sql("SELECT * FROM b_profile")
    o["attitude_class"] = sql(f"""SELECT unit, lon, lat, avg, level, result, {ATT_LABEL} AS attitude_class
FROM b_profile""")
    o["connectivity_class"] = sql(f"""SELECT unit, lon, lat, level, result, never, rarely, sometimes, freq, always,
  {CONN_LABEL} AS conn_class FROM b_profile""")
    o["class_counts"] = sql("""SELECT count(*) AS n_rows,
  CAST(count_if(never + rarely + sometimes > 0.6) AS BIGINT) AS n_attitude_low,
  CAST(count_if(avg < (SELECT avg(w) FROM b_edges)) AS BIGINT) AS n_conn_weak FROM b_profile""")
    o["split_assignment"] = sql(f"SELECT unit, {UNIT_TRAIN} AS is_train FROM b_names")

    o["pair_distance"] = sql(f"""SELECT e.u1, e.u2, e.w, round({km('x', 'y')}, {D}) AS dist_km
FROM b_edges e JOIN b_coords x ON x.unit = e.u1 JOIN b_coords y ON y.unit = e.u2
WHERE x.lat IS NOT NULL AND x.lon IS NOT NULL AND y.lat IS NOT NULL AND y.lon IS NOT NULL""")
    o["pair_attitude_gap"] = sql(f"""SELECT e.u1, e.u2, e.w, round(abs((x.never + x.rarely) - (y.never + y.rarely)), {D}) AS gap
FROM b_edges e JOIN b_att x ON x.unit = e.u1 JOIN b_att y ON y.unit = e.u2""")
    o["pair_result_gap"] = sql(f"""SELECT e.u1, e.u2, e.w, round(abs(x.result - y.result), {D}) AS gap
FROM b_edges e JOIN b_res x ON x.unit = e.u1 JOIN b_res y ON y.unit = e.u2""")
    o["pair_rate_gap"] = sql(f"""SELECT e.u1, e.u2, e.w, round(abs(x.rate - y.rate), {D}) AS gap
FROM b_edges e JOIN b_rate x ON x.unit = e.u1 JOIN b_rate y ON y.unit = e.u2""")
    o["pair_features"] = sql(f"""SELECT u1, u2, round(ln_w, {D}) AS ln_w, round(gap_att, {D}) AS gap_att, round(gap_result, {D}) AS gap_result,
  round(ln_km, {D}) AS ln_km, round(gap_rate, {D}) AS gap_rate FROM b_pf""")
    o["pair_chain"] = o["pair_features"]
    o["gap_correlation"] = sql(f"""SELECT round(corr(ln_w, ln_km), {D}) AS corr_ln_km, round(corr(ln_w, gap_att), {D}) AS corr_gap_att,
  round(corr(ln_w, gap_result), {D}) AS corr_gap_result, round(corr(ln_w, gap_rate), {D}) AS corr_gap_rate, count(*) AS n_pairs FROM b_pf""")

    one = ("b_one AS (SELECT regr_slope(ln_w, gap_att) AS b, regr_intercept(ln_w, gap_att) AS a, count(*) AS n "
           "FROM b_pf_train)")
    def simple(feature: str, source: str, *extra: str) -> str:
        fit = (f"b_fit AS (SELECT regr_slope(ln_w, {feature}) AS b, regr_intercept(ln_w, {feature}) AS a, count(*) AS n "
               f"FROM {source})")
        res = f"(ln_w - (a + b * {feature}))"
        return sql(f"""SELECT round(max(b), {D}) AS coef_{feature}, round(max(a), {D}) AS intercept,
  round(sqrt(avg({res} * {res})), {D}) AS rmse, count(*) AS n FROM {source}, b_fit""", *extra, fit)
    same = """b_pf_same AS (SELECT t.* FROM b_pf_train t JOIN b_names a ON a.unit = t.u1
  JOIN b_names b ON b.unit = t.u2 WHERE a.grp = b.grp)"""
    o["regression_one_coef"] = simple("gap_att", "b_pf_train")
    o["regression_distance"] = simple("ln_km", "b_pf_train")
    o["regression_distance_same_group"] = simple("ln_km", "b_pf_same", same)
    o["regression_result"] = simple("gap_result", "b_pf_train")
    o["regression_predictions"] = sql(f"""SELECT u1, u2, round(ln_w, {D}) AS ln_w, round(a + b * gap_att, {D}) AS prediction
FROM b_pf, b_one""", one)
    o["scatter_series"] = sql(f"""SELECT round(a + b * gap_att, {D}) AS x, round(ln_w, {D}) AS y, 'observed' AS series FROM b_pf, b_one
UNION ALL
SELECT round(a + b * gap_att, {D}) AS x, round(a + b * gap_att, {D}) AS y, 'predicted' AS series FROM b_pf, b_one""", one)
    o["scatter_distance"] = sql(f"SELECT round(ln_km, {D}) AS x, round(ln_w, {D}) AS y, 'observed' AS series FROM b_pf")
    full = ["ln_km", "gap_rate", "gap_result", "gap_att"]
    sel, ctes = _mgs_rmse("b_pf_train", full)
    o["regression_rmse"] = sql(sel, *ctes)
    sel, ctes = _mgs_rmse("b_pf_same", full)
    o["regression_rmse_same_group"] = sql(sel, same, *ctes)

    def nb_params(label_expr, label, feats):
        cols = ", ".join(f"round(t_{f}, {D}) AS theta_{f}" for f in feats)
        return sql(f"SELECT label, round(pi, {D}) AS pi, {cols} FROM nb_par",
                   *_nb_sql(label_expr, label, feats))
    o["nb_params"] = nb_params(ATT_LABEL, "attitude_class", ATT_F)
    o["nb_params_connectivity"] = nb_params(CONN_LABEL, "conn_class", CONN_F)

    def nb_pred(label_expr, label, feats):
        return sql(f"SELECT unit, {label}, prediction FROM nb_pred", *_nb_sql(label_expr, label, feats))

    def nb_acc(label_expr, label, feats):
        return sql(f"SELECT round(avg(CAST({label} = prediction AS DOUBLE)), {D}) AS accuracy, count(*) AS n FROM nb_pred",
                   *_nb_sql(label_expr, label, feats))
    o["attitude_nb_predictions"] = nb_pred(ATT_LABEL, "attitude_class", ATT_F)
    o["connectivity_nb_predictions"] = nb_pred(CONN_LABEL, "conn_class", CONN_F)
    o["attitude_nb_accuracy"] = nb_acc(ATT_LABEL, "attitude_class", ATT_F)
    o["connectivity_nb_accuracy"] = nb_acc(CONN_LABEL, "conn_class", CONN_F)

    units = _tree_ctes()
    o["imputer_values"] = recursive(f"""SELECT * FROM (SELECT unnest(['lat', 'lon', 'avg', 'level', 'result']) AS "column",
  unnest(['mean', 'median', 'mean', 'median', 'mode']) AS strategy, round(unnest([lat, lon, avg, level, result]), {D}) AS value FROM u_im)""", *units[:8])
    o["imputed_units"] = recursive(f"""SELECT unit, grp, round(lat, {D}) AS lat, round(lon, {D}) AS lon, round(avg, {D}) AS avg, round(level, {D}) AS level,
  round(result, {D}) AS result, attitude_class FROM u_i""", *units[:8])
    names = """n_s AS (SELECT grp AS label, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, grp) - 1 AS DOUBLE) AS "index"
  FROM b_names GROUP BY grp)"""
    o["string_index"] = sql('SELECT label, n, "index" FROM n_s', names)
    o["string_round_trip"] = sql('SELECT unit, grp, "index" AS grp_index, grp AS back FROM b_names JOIN n_s ON label = grp', names)
    feature = "([" + ", ".join(f"'{c}'" for c in TREE_FEATURES) + "])[{} + 1]"
    o["vector_index"] = recursive(f"""SELECT {feature.format('f')} AS feature, true AS categorical, round(v, {D}) AS value, idx AS "index" FROM u_m
UNION ALL SELECT {feature.format('f')}, false, NULL, NULL FROM u_n WHERE n > 25""", *units[:8])
    o["tree_nodes"] = recursive(f"""SELECT node, CAST(floor(log2(node)) AS INTEGER) AS depth, {feature.format('f')} AS feature, round(t, {D}) AS threshold,
  array_to_string(list_transform(cats, lambda c: CAST(c AS INTEGER)), ',') AS categories, n, n1 FROM tn""", *units)
    o["tree_predictions"] = recursive("SELECT unit, attitude_class, prediction FROM tq", *units)
    o["tree_accuracy"] = recursive(f"SELECT round(avg(CAST(attitude_class = prediction AS DOUBLE)), {D}) AS accuracy, count(*) AS n FROM tq", *units)
    ctes = _kmeans_ctes()
    o["kmeans_clusters"] = recursive(f"SELECT unit, CAST(cluster AS INTEGER) AS cluster, round(d, {D}) AS square_distance FROM k_a", *ctes)
    o["kmeans_centres"] = recursive(f"""SELECT CAST(l.cluster AS INTEGER) AS cluster, coalesce(a.n, 0) AS n, round(coalesce(a.cost, 0), {D}) AS cost, {_back()}
FROM k_e, k_l l LEFT JOIN (SELECT cluster, count(*) AS n, sum(d) AS cost FROM k_a GROUP BY cluster) a ON a.cluster = l.cluster""", *ctes)
    ctes = _bisecting_ctes()
    o["bisecting_clusters"] = recursive("SELECT unit, node FROM h_a", *ctes)
    o["bisecting_tree"] = recursive(f"""SELECT h_m.node, nullif(h_m.node // 2, 0) AS parent, h_m.n, round(h_c.cost, {D}) AS cost,
  h_m.node IN (SELECT node FROM h_a) AS leaf, {_back()} FROM k_e, h_m JOIN h_c ON h_c.node = h_m.node""", *ctes)
    ctes = _community_ctes()
    o["community_tree"] = recursive(f"SELECT round, a, b, na, nb, round(height, {D}) AS height FROM ct", *ctes)
    o["communities"] = recursive("SELECT unit, community FROM cc", *ctes)
    o["community_groups"] = recursive("SELECT community, grp, n FROM cg", *ctes)
    o["community_agreement"] = recursive(f"""SELECT n_units, n_left, n_right, same_both, same_left, same_right,
  round((p + 2.0 * same_both - same_left - same_right) / p, {D}) AS rand_index,
  round((same_both - (CAST(same_left AS DOUBLE) * same_right) / p) / nullif((same_left + same_right) / 2.0
        - (CAST(same_left AS DOUBLE) * same_right) / p, 0), {D}) AS adjusted_rand
FROM (SELECT *, nullif(CAST(n_units * (n_units - 1) // 2 AS DOUBLE), 0) AS p FROM (
  SELECT CAST((SELECT sum(n) FROM cg) AS BIGINT) AS n_units,
    (SELECT count(DISTINCT community) FROM cg) AS n_left, (SELECT count(DISTINCT grp) FROM cg) AS n_right,
    CAST((SELECT sum(n * (n - 1) // 2) FROM cg) AS BIGINT) AS same_both,
    CAST((SELECT sum(n * (n - 1) // 2) FROM (SELECT sum(n) AS n FROM cg GROUP BY community)) AS BIGINT) AS same_left,
    CAST((SELECT sum(n * (n - 1) // 2) FROM (SELECT sum(n) AS n FROM cg GROUP BY grp)) AS BIGINT) AS same_right))""", *ctes)

    o["edges_from_text"] = sql("SELECT u1, u2, w FROM b_edges")
    o["series_dictionary_rows"] = sql("""SELECT sid, area_type, 'CN' || left(sid, length(sid) - 2) AS area_code,
  right(sid, 2) AS measure_code, srd, title FROM b_dict""")
    o["adjacency_neighbors"] = sql("""SELECT CAST(a.unit AS VARCHAR) AS unit, a.name AS unit_name, CAST(b.unit AS VARCHAR) AS neighbor
FROM (SELECT s_suppkey AS unit, s_nationkey AS nk, 'Unit ' || CAST(s_suppkey AS VARCHAR) AS name FROM supplier) a
JOIN (SELECT s_suppkey AS unit, s_nationkey AS nk FROM supplier) b
  ON b.nk = a.nk AND (b.unit = a.unit - 1 OR b.unit = a.unit + 1)""")
    o["parse_results_rows"] = sql("SELECT * FROM b_lines", _lines_cte())
    o["malformed_rows"] = sql("""SELECT 'index' AS source, count(*) AS n_rows,
  CAST(count_if(u1 = u2 AND u1 % 7 = 0) AS BIGINT) AS n_malformed FROM b_raw
UNION ALL
SELECT 'results', count(*), CAST(count_if(line_num % 7 = 0) AS BIGINT) FROM b_lines""", _lines_cte())
    o["exclude_groups"] = sql("SELECT * FROM b_lines WHERE state <> 'NATION_23' AND state <> 'NATION_24'",
                              _lines_cte())
    o["union_partitions"] = sql("SELECT sid, year, period, value FROM b_series")
    return o


ORACLES = _oracles()
