"""Drift monitoring plans."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from hearth.functions.exprs import rnd
from hearth.operators import drift
from hearth.plans.registry import query
from hearth.plans.sqlparts import EVENTS_CTE, SALES_CTE, hash_sql
from hearth.session import checkpoint_dir
from hearth.sources.bindings import events_split, sales_split

NUM = ["qty", "ext", "disc", "acctbal", "quality"]
CAT = ["nbhd", "segment", "priority", "status"]
SPLIT = f"""WITH {SALES_CTE.strip()},
ref AS (SELECT * FROM sales WHERE yr_built < 1998),
cur AS (SELECT * FROM sales WHERE yr_built >= 1998)"""
EV = f"WITH {EVENTS_CTE.strip()}"


def _side_sql(src: str, p: str, cols) -> str:
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS feature, COUNT({x}) AS {p}_n, AVG({x}) AS {p}_mean, "
            f"coalesce(stddev_samp({x}), 0.0) AS {p}_std, quantile_cont({x}, 0.05) AS {p}_q05, "
            f"quantile_cont({x}, 0.5) AS {p}_q50, quantile_cont({x}, 0.95) AS {p}_q95, "
            f"1.0 - COUNT({x}) / COUNT(*) AS {p}_na FROM {src}")
    return " UNION ALL ".join(parts)


K1_SQL = f"""{SPLIT},
r AS ({_side_sql('ref', 'r', NUM)}),
c AS ({_side_sql('cur', 'c', NUM)})
SELECT r.feature, round(r_mean, 4) AS ref_mean, round(c_mean, 4) AS cur_mean,
       round(CASE WHEN r_n > 1 THEN r_std ELSE 0.0 END, 4) AS ref_std,
       round(CASE WHEN c_n > 1 THEN c_std ELSE 0.0 END, 4) AS cur_std,
       round(r_q05, 4) AS ref_q05, round(c_q05, 4) AS cur_q05, round(r_q50, 4) AS ref_q50,
       round(c_q50, 4) AS cur_q50, round(r_q95, 4) AS ref_q95, round(c_q95, 4) AS cur_q95,
       round(r_na, 9) AS ref_na_rate, round(c_na, 9) AS cur_na_rate,
       CASE WHEN r_n > 0 AND c_n > 0 THEN round(abs(c_mean - r_mean) /
            (abs(CASE WHEN r_n > 1 THEN r_std ELSE 0.0 END) + 1e-9) + 2 * abs(c_na - r_na), 9) END
         AS drift_score
FROM r JOIN c ON r.feature = c.feature
"""


@query("k1_numeric_drift", K1_SQL)
def _k1(spark, sf):
    ref, cur = sales_split(spark, sf)
    d = drift.numeric_drift(ref, cur, NUM)
    four = ["ref_mean", "cur_mean", "ref_std", "cur_std", "ref_q05", "cur_q05", "ref_q50",
            "cur_q50", "ref_q95", "cur_q95"]
    return d.select("feature", *[rnd(c, 4).alias(c) for c in four],
                    rnd("ref_na_rate", 9).alias("ref_na_rate"),
                    rnd("cur_na_rate", 9).alias("cur_na_rate"),
                    rnd("drift_score", 9).alias("drift_score"))


def _cat_sql(ref: str, cur: str, cols, k: int = 10) -> str:
    lv = []
    for c in cols:
        lv.append(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS v, 'r' AS side FROM {ref}")
        lv.append(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS v, 'c' AS side FROM {cur}")
    return f"""
lg AS ({" UNION ALL ".join(lv)}),
tot AS (SELECT feature,
          SUM(CASE WHEN side = 'r' THEN 1 ELSE 0 END) AS r_rows,
          SUM(CASE WHEN side = 'c' THEN 1 ELSE 0 END) AS c_rows,
          SUM(CASE WHEN side = 'r' AND v IS NULL THEN 1 ELSE 0 END) AS r_null,
          SUM(CASE WHEN side = 'c' AND v IS NULL THEN 1 ELSE 0 END) AS c_null
        FROM lg GROUP BY feature),
cnt AS (SELECT feature, v, SUM(CASE WHEN side = 'r' THEN 1 ELSE 0 END) AS r,
               SUM(CASE WHEN side = 'c' THEN 1 ELSE 0 END) AS c
        FROM lg WHERE v IS NOT NULL GROUP BY feature, v),
rk AS (SELECT *, CASE WHEN r > 0 THEN row_number() OVER (PARTITION BY feature ORDER BY
                   CASE WHEN r > 0 THEN 0 ELSE 1 END, r DESC, v) END AS rr,
              CASE WHEN c > 0 THEN row_number() OVER (PARTITION BY feature ORDER BY
                   CASE WHEN c > 0 THEN 0 ELSE 1 END, c DESC, v) END AS cr FROM cnt),
tp AS (SELECT * FROM rk WHERE rr <= {k} OR cr <= {k}),
l1 AS (SELECT feature, SUM(abs(r / (rs + 1e-9) - c / (cs + 1e-9))) AS l1 FROM (
         SELECT *, SUM(r) OVER (PARTITION BY feature) AS rs, SUM(c) OVER (PARTITION BY feature) AS cs
         FROM tp) GROUP BY feature),
un AS (SELECT feature, SUM(CASE WHEN r = 0 THEN c ELSE 0 END) AS unk,
              COUNT(CASE WHEN r > 0 THEN 1 END) AS ref_unique,
              COUNT(CASE WHEN c > 0 THEN 1 END) AS cur_unique FROM cnt GROUP BY feature),
catd AS (
  SELECT t.feature, round(r_null / r_rows, 9) AS ref_na_rate, round(c_null / c_rows, 9) AS cur_na_rate,
         CASE WHEN c_rows - c_null = 0 THEN 0.0 ELSE coalesce(unk, 0) / c_rows END AS unknown_rate,
         coalesce(l1.l1, 0.0) AS l1_top_shift, coalesce(ref_unique, 0) AS ref_unique,
         coalesce(cur_unique, 0) AS cur_unique, r_null / r_rows AS rn, c_null / c_rows AS cn
  FROM tot t LEFT JOIN un ON t.feature = un.feature LEFT JOIN l1 ON t.feature = l1.feature)"""


K2_SQL = f"""{SPLIT},{_cat_sql('ref', 'cur', CAT)}
SELECT feature, ref_na_rate, cur_na_rate, round(unknown_rate, 9) AS unknown_rate,
       round(l1_top_shift, 9) AS l1_top_shift, ref_unique, cur_unique,
       round(l1_top_shift + 3 * unknown_rate + 2 * abs(cn - rn), 9) AS drift_score
FROM catd
"""


def _k2_out(d):
    return d.select("feature", rnd("ref_na_rate", 9).alias("ref_na_rate"),
                    rnd("cur_na_rate", 9).alias("cur_na_rate"),
                    rnd("unknown_rate", 9).alias("unknown_rate"),
                    rnd("l1_top_shift", 9).alias("l1_top_shift"), "ref_unique", "cur_unique",
                    rnd("drift_score", 9).alias("drift_score"))


@query("k2_categorical_drift", K2_SQL)
def _k2(spark, sf):
    ref, cur = sales_split(spark, sf)
    return _k2_out(drift.categorical_drift(ref, cur, CAT, 10))


@query("k2_categorical_drift_top2", f"""{SPLIT},{_cat_sql('ref', 'cur', CAT, 2)}
SELECT feature, ref_na_rate, cur_na_rate, round(unknown_rate, 9) AS unknown_rate,
       round(l1_top_shift, 9) AS l1_top_shift, ref_unique, cur_unique,
       round(l1_top_shift + 3 * unknown_rate + 2 * abs(cn - rn), 9) AS drift_score
FROM catd
""")
def _k2b(spark, sf):
    ref, cur = sales_split(spark, sf)
    return _k2_out(drift.categorical_drift(ref, cur, CAT, 2))


@query("k2_categorical_drift_unknown", f"""{EV},
ref AS (SELECT id, event_type FROM ev_ref WHERE event_type <> 'error' OR event_type IS NULL),
cur AS (SELECT id, event_type FROM ev_cur),{_cat_sql('ref', 'cur', ['event_type'])}
SELECT feature, ref_na_rate, cur_na_rate, round(unknown_rate, 9) AS unknown_rate,
       round(l1_top_shift, 9) AS l1_top_shift, ref_unique, cur_unique,
       round(l1_top_shift + 3 * unknown_rate + 2 * abs(cn - rn), 9) AS drift_score
FROM catd
""")
def _k2u(spark, sf):
    ref, cur = events_split(spark, sf)
    ref = ref.filter((F.col("event_type") != "error") | F.col("event_type").isNull())
    return _k2_out(drift.categorical_drift(ref, cur, ["event_type"], 10))


K3_SQL = f"""{SPLIT},
r AS ({_side_sql('ref', 'r', NUM)}),
c AS ({_side_sql('cur', 'c', ['qty', 'ext', 'acctbal', 'quality'])}),{_cat_sql('ref', 'cur', CAT)},
tab AS (
  SELECT r.feature, 'numeric' AS type, 'ok' AS status,
         abs(c_mean - r_mean) / (abs(CASE WHEN r_n > 1 THEN r_std ELSE 0.0 END) + 1e-9)
           + 2 * abs(c_na - r_na) AS drift_score
  FROM r JOIN c ON r.feature = c.feature
  UNION ALL SELECT feature, 'categorical', 'ok', l1_top_shift + 3 * unknown_rate + 2 * abs(cn - rn)
  FROM catd
  UNION ALL SELECT 'disc', NULL, 'missing_in_current', 10.0)
SELECT feature, type, status, round(drift_score, 9) AS drift_score FROM tab
"""


@query("k3_drift_report", K3_SQL)
def _k3(spark, sf):
    ref, cur = sales_split(spark, sf)
    table, _overall, _rank = drift.drift_report(ref.select(*NUM, *CAT), cur.drop("disc"))
    return table.select("feature", "type", "status", rnd("drift_score", 9).alias("drift_score"))


@query("k3_drift_from_profile", K3_SQL)
def _k3p(spark, sf):
    """The reference is profiled and stored; the report reads the profile and the current window only."""
    ref, cur = sales_split(spark, sf)
    path = f"{checkpoint_dir(spark)}/profiles/{uuid.uuid4().hex}"
    drift.write_profile(*drift.profile_stats(ref.select(*NUM, *CAT)), path)
    report = drift.drift_from_profile(*drift.read_profile(spark, path), cur.drop("disc"))
    drift.write_report(report, f"{path}/report")
    table = spark.read.schema(report[0].schema).json(f"{path}/report/columns")
    return table.select("feature", "type", "status", rnd("drift_score", 9).alias("drift_score"))


@query("k3_drift_report_overall", f"""{SPLIT},
r AS ({_side_sql('ref', 'r', NUM)}),
c AS ({_side_sql('cur', 'c', ['qty', 'ext', 'acctbal', 'quality'])}),{_cat_sql('ref', 'cur', CAT)},
tab AS (
  SELECT abs(c_mean - r_mean) / (abs(CASE WHEN r_n > 1 THEN r_std ELSE 0.0 END) + 1e-9)
           + 2 * abs(c_na - r_na) AS drift_score
  FROM r JOIN c ON r.feature = c.feature
  UNION ALL SELECT l1_top_shift + 3 * unknown_rate + 2 * abs(cn - rn) FROM catd
  UNION ALL SELECT 10.0)
SELECT round(SUM(drift_score) / COUNT(*), 9) AS avg_drift_score, COUNT(*) AS scored_columns FROM tab
""")
def _k3o(spark, sf):
    ref, cur = sales_split(spark, sf)
    _t, overall, _r = drift.drift_report(ref.select(*NUM, *CAT), cur.drop("disc"))
    return overall.select(rnd("avg_drift_score", 9).alias("avg_drift_score"), "scored_columns")


@query("k4_profile_stats", f"""{SPLIT},
p AS ({_side_sql('ref', 'p', NUM)})
SELECT feature, 'numeric' AS dtype, round(p_na, 9) AS null_rate, round(p_mean, 4) AS mean,
       round(p_std, 4) AS std, round(p_q05, 4) AS q05, round(p_q50, 4) AS q50,
       round(p_q95, 4) AS q95 FROM p
""")
def _k4(spark, sf):
    ref, _cur = sales_split(spark, sf)
    p, _levels = drift.profile_stats(ref, NUM)
    return p.select("feature", "dtype", rnd("null_rate", 9).alias("null_rate"),
                    *[rnd(c, 4).alias(c) for c in ("mean", "std", "q05", "q50", "q95")])


@query("k4_profile_levels", f"""{SPLIT}
{" UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS level, COUNT(*) AS count FROM ref WHERE {c} IS NOT NULL GROUP BY {c}" for c in CAT)}
""")
def _k4l(spark, sf):
    ref, _cur = sales_split(spark, sf)
    _p, levels = drift.profile_stats(ref, CAT)
    return levels


PSI_COLS = ["qty", "ext", "disc", "acctbal", "quality", "n_lines"]


def _psi_sql(smoothing: str, bins: int = 10, cols=PSI_COLS, ref="ref", cur="cur") -> str:
    probs = ", ".join(repr(i / bins) for i in range(bins + 1))
    lr = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM {ref} "
                            f"WHERE {c} IS NOT NULL" for c in cols)
    lc = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM {cur} "
                            f"WHERE {c} IS NOT NULL" for c in cols)
    names = " UNION ALL ".join(f"SELECT '{c}' AS feature" for c in cols)
    if smoothing == "floor":
        edges = f"""
e0 AS (SELECT feature, list_sort(list_distinct(quantile_cont(x, [{probs}]))) AS edges FROM lr GROUP BY feature),
du AS (SELECT DISTINCT feature, x FROM lr),
nu AS (SELECT feature, COUNT(*) AS nu FROM du GROUP BY feature),
fb AS (SELECT du.feature, CASE WHEN MAX(nu.nu) <= {bins + 1} THEN list_sort(list(du.x))
              ELSE list_sort(list_distinct(quantile_cont(du.x, [{probs}]))) END AS fb
       FROM du JOIN nu ON du.feature = nu.feature WHERE nu.nu >= 3 GROUP BY du.feature),
e1 AS (SELECT e0.feature, CASE WHEN len(e0.edges) >= 3 THEN e0.edges ELSE fb.fb END AS edges
       FROM e0 LEFT JOIN fb ON e0.feature = fb.feature),
ed AS (SELECT feature, list_transform(edges, lambda e, i: CASE WHEN i = 1 THEN e - 1e-9
                 WHEN i = len(edges) THEN e + 1e-9 ELSE e END) AS edges
       FROM e1 WHERE edges IS NOT NULL AND len(edges) >= 3)"""
        e_share = "CASE WHEN e = 0 THEN 1e-6 ELSE e END"
        a_share = "CASE WHEN a = 0 THEN 1e-6 ELSE a END"
        term = f"({a_share} - {e_share}) * ln(({a_share}) / ({e_share}))"
    else:
        edges = f"""
ed AS (SELECT feature, list_sort(list_distinct(quantile_cont(x, [{probs}]))) AS edges FROM lr GROUP BY feature)"""
        term = "(a - e) * ln((a + 1e-6) / (e + 1e-6))"
    return f"""
lr AS ({lr}),
lc AS ({lc}),{edges},
bins AS (SELECT feature, UNNEST(range(1, len(edges))) AS bin FROM ed),
br AS (SELECT l.feature, least(len(list_filter(ed.edges, lambda e: e <= l.x)), len(ed.edges) - 1) AS bin
       FROM lr l JOIN ed ON l.feature = ed.feature
       WHERE l.x >= ed.edges[1] AND l.x <= ed.edges[len(ed.edges)]),
bc AS (SELECT l.feature, least(len(list_filter(ed.edges, lambda e: e <= l.x)), len(ed.edges) - 1) AS bin
       FROM lc l JOIN ed ON l.feature = ed.feature
       WHERE l.x >= ed.edges[1] AND l.x <= ed.edges[len(ed.edges)]),
cr AS (SELECT feature, bin, COUNT(*) AS n FROM br GROUP BY ALL),
cc AS (SELECT feature, bin, COUNT(*) AS n FROM bc GROUP BY ALL),
j AS (SELECT b.feature, b.bin, coalesce(cr.n, 0) AS en, coalesce(cc.n, 0) AS an
      FROM bins b LEFT JOIN cr ON b.feature = cr.feature AND b.bin = cr.bin
      LEFT JOIN cc ON b.feature = cc.feature AND b.bin = cc.bin),
s AS (SELECT feature, en / greatest(SUM(en) OVER (PARTITION BY feature), 1) AS e,
             an / greatest(SUM(an) OVER (PARTITION BY feature), 1) AS a FROM j),
sc AS (SELECT feature, SUM({term}) AS psi FROM s GROUP BY feature),
has AS (SELECT DISTINCT feature FROM lc),
nm AS ({names}),
out AS (SELECT nm.feature, sc.psi,
              CASE WHEN sc.psi IS NULL OR isnan(sc.psi) THEN 'none' WHEN sc.psi < 0.10 THEN 'stable'
                   WHEN sc.psi <= 0.25 THEN 'watch' ELSE 'action' END AS status
        FROM nm LEFT JOIN (SELECT sc.* FROM sc JOIN has ON sc.feature = has.feature) sc
        ON nm.feature = sc.feature)"""


PSI_SELECT = "\nSELECT feature, round(psi, 9) AS psi, status FROM out"


@query("k5_psi_additive", f"{SPLIT},{_psi_sql('additive')}{PSI_SELECT}")
def _k5a(spark, sf):
    ref, cur = sales_split(spark, sf)
    p = drift.psi(ref, cur, PSI_COLS, 10, "additive")
    return p.select("feature", rnd("psi", 9).alias("psi"), "status")


@query("k5_psi_floor", f"{SPLIT},{_psi_sql('floor')}{PSI_SELECT}")
def _k5f(spark, sf):
    ref, cur = sales_split(spark, sf)
    p = drift.psi(ref, cur, PSI_COLS, 10, "floor")
    return p.select("feature", rnd("psi", 9).alias("psi"), "status")


@query("k5_psi_events", f"""{EV},
ref AS (SELECT * FROM ev_ref), cur AS (SELECT * FROM ev_cur),{_psi_sql('additive', 10, ['value', 'user_id'])}{PSI_SELECT}
""")
def _k5e(spark, sf):
    ref, cur = events_split(spark, sf)
    p = drift.psi(ref, cur, ["value", "user_id"], 10, "additive")
    return p.select("feature", rnd("psi", 9).alias("psi"), "status")


@query("k6_psi_band", f"{SPLIT},{_psi_sql('floor', 4)}\nSELECT status FROM out")
def _k6(spark, sf):
    ref, cur = sales_split(spark, sf)
    p = drift.psi(ref, cur, PSI_COLS, 4, "floor")
    return p.select(drift.psi_band(F.col("psi")).alias("status"))


def _shift_sql(c: str, keep_null: bool, k: int) -> str:
    flt = "" if keep_null else f"WHERE {c} IS NOT NULL"
    return f"""
r AS (SELECT CAST({c} AS VARCHAR) AS category, COUNT(*) / SUM(COUNT(*)) OVER () AS r FROM ref {flt} GROUP BY 1),
i AS (SELECT CAST({c} AS VARCHAR) AS category, COUNT(*) / SUM(COUNT(*)) OVER () AS i FROM cur {flt} GROUP BY 1),
j AS (SELECT coalesce(r.category, i.category) AS category, coalesce(r.r, 0.0) AS r, coalesce(i.i, 0.0) AS i
      FROM r FULL OUTER JOIN i ON r.category IS NOT DISTINCT FROM i.category)
SELECT category, round(r * 100, 2) AS reference_pct, round(i * 100, 2) AS incoming_pct,
       round(abs(r - i) * 100, 2) AS shift
FROM j ORDER BY abs(r - i) DESC, category ASC NULLS FIRST LIMIT {k}"""


@query("k7_category_shift", f"{SPLIT},{_shift_sql('nbhd', True, 8)}")
def _k7(spark, sf):
    ref, cur = sales_split(spark, sf)
    return drift.category_shift(ref, cur, "nbhd", 8, keep_null=True)


@query("k7_category_shift_dropna", f"{SPLIT},{_shift_sql('status', False, 8)}")
def _k7b(spark, sf):
    ref, cur = sales_split(spark, sf)
    return drift.category_shift(ref, cur, "status", 8, keep_null=False)


MISS_COLS = ["yr_sold", "qty", "ext", "nbhd", "status", "segment"]


@query("k8_missing_drift", f"""{SPLIT},
r AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS r FROM ref" for c in MISS_COLS)}),
i AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS i FROM cur" for c in MISS_COLS)})
SELECT r.feature, round(r * 100, 2) AS reference_missing, round(i * 100, 2) AS incoming_missing,
       round(abs(r - i) * 100, 2) AS shift FROM r JOIN i ON r.feature = i.feature
""")
def _k8(spark, sf):
    ref, cur = sales_split(spark, sf)
    return drift.missing_drift(ref.select(*MISS_COLS), cur.select(*MISS_COLS))


K9_COLS = PSI_COLS + ["nbhd", "status"]


@query("k9_drift_summary", f"""{SPLIT},{_psi_sql('floor')}
SELECT COUNT(CASE WHEN psi > 0.25 THEN 1 END) AS action_features,
       COUNT(CASE WHEN psi >= 0.10 AND psi <= 0.25 THEN 1 END) AS watch_features,
       round(MAX(psi), 9) AS max_psi, round(AVG(psi), 9) AS mean_psi, COUNT(psi) AS scored,
       COUNT(*) AS features, (SELECT COUNT(*) FROM ref) AS reference_rows,
       (SELECT COUNT(*) FROM cur) AS incoming_rows,
       round((SELECT ({" + ".join(f"COUNT(*) - COUNT({c})" for c in K9_COLS)}) / greatest(COUNT(*) * {len(K9_COLS)}, 1) FROM cur), 9)
         AS incoming_null_rate,
       {len(K9_COLS)} AS shared_fields
FROM out
""")
def _k9(spark, sf):
    ref, cur = sales_split(spark, sf)
    cols = K9_COLS
    p = drift.psi(ref, cur, PSI_COLS, 10, "floor")
    s = drift.drift_summary(p, ref.select(*cols), cur.select(*cols))
    return s.select("action_features", "watch_features", rnd("max_psi", 9).alias("max_psi"),
                    rnd("mean_psi", 9).alias("mean_psi"), "scored", "features",
                    "reference_rows", "incoming_rows",
                    rnd("incoming_null_rate", 9).alias("incoming_null_rate"), "shared_fields")


def _u(key: str) -> str:
    return f"({hash_sql(key)} / 4294967296.0)"


@query("k10_simulate_shift", f"""{SPLIT},
st AS (SELECT AVG(ext) AS m, stddev_pop(ext) AS s FROM cur),
u AS (SELECT id, ext, greatest({_u("CAST(id AS VARCHAR) || ':ext:n1'")}, 1e-12) AS u1,
             {_u("CAST(id AS VARCHAR) || ':ext:n2'")} AS u2,
             {_u("CAST(id AS VARCHAR) || ':ext:m'")} AS um FROM cur)
SELECT id, CASE WHEN um < 0.12 THEN NULL ELSE round(m + 0.25 * s + (ext - m) * 1.25
         + 0.05 * s * sqrt(-2.0 * ln(u1)) * cos(2 * 3.141592653589793 * u2), 6) END AS ext
FROM u, st
""")
def _k10(spark, sf):
    _ref, cur = sales_split(spark, sf)
    d = drift.simulate_shift(cur.select("id", "ext"), ["ext"], "id", 0.25, 0.12, 42)
    return d.select("id", rnd("ext", 6).alias("ext"))
