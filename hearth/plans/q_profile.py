"""Profiling, distributions, clustering (M) and encoding (E) plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.functions.exprs import rnd
from hearth.operators import cluster, dist, encode, profile
from hearth.plans.registry import query
from hearth.plans.sqlparts import HOUSE_CTE, SALES_CTE
from hearth.sources.bindings import house, sales, sales_split

W = f"WITH {HOUSE_CTE.strip()}"
S = f"WITH {SALES_CTE.strip()}"
HOUSE_COLS = ["Id", "SalePrice", "YrSold", "YearBuilt", "YearRemodAdd", "TotalBsmtSF", "1stFlrSF",
              "2ndFlrSF", "GrLivArea", "OverallQual", "GarageArea", "Fireplaces", "FullBath",
              "HalfBath", "Neighborhood", "LotArea", "LotFrontage", "MasVnrArea", "WoodDeckSF",
              "OpenPorchSF", "EnclosedPorch", "MSZoning", "KitchenQual", "SaleType",
              "FireplaceQu"]
NUM = ["qty", "ext", "n_lines", "disc", "ret_qty", "acctbal", "quality", "yr_built"]


@query("m1_missing_counts", f"""{W},
m AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, COUNT(*) - COUNT(\"{c}\") AS missing FROM house"
                          for c in HOUSE_COLS)})
SELECT feature, missing FROM m WHERE missing > 0
""")
def _m1(spark, sf):
    return profile.missing_counts(house(spark, sf))


@query("m2_melt", f"""{W}
SELECT "Id", 'GrLivArea' AS variable, "GrLivArea" AS value FROM house
UNION ALL SELECT "Id", 'OverallQual', "OverallQual" FROM house
UNION ALL SELECT "Id", 'FullBath', "FullBath" FROM house
""")
def _m2(spark, sf):
    return profile.melt(house(spark, sf), ["GrLivArea", "OverallQual", "FullBath"], ["Id"])


@query("m3_box_summary", f"""{S},
q AS (SELECT segment, COUNT(price) AS n, quantile_cont(price, 0.25) AS q1,
             quantile_cont(price, 0.5) AS median, quantile_cont(price, 0.75) AS q3
      FROM sales GROUP BY segment),
w AS (SELECT s.segment, MIN(CASE WHEN price >= q1 - 1.5 * (q3 - q1) THEN price END) AS lo,
             MAX(CASE WHEN price <= q3 + 1.5 * (q3 - q1) THEN price END) AS hi
      FROM sales s JOIN q ON s.segment = q.segment GROUP BY s.segment)
SELECT q.segment, n, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
       w.lo AS whisker_lo, w.hi AS whisker_hi
FROM q JOIN w ON q.segment = w.segment
""")
def _m3(spark, sf):
    b = profile.box_summary(sales(spark, sf), "price", "segment")
    return b.select("segment", "n", rnd("q1", 4).alias("q1"), rnd("median", 4).alias("median"),
                    rnd("q3", 4).alias("q3"), "whisker_lo", "whisker_hi")


def _hist_sql(xexpr: str, bins: int, with_clause: str = S, src: str = "sales") -> str:
    return f"""{with_clause},
d AS (SELECT {xexpr} AS x FROM {src} WHERE {xexpr} IS NOT NULL),
st AS (SELECT CASE WHEN MIN(x) = MAX(x) THEN MIN(x) - 0.5 ELSE MIN(x) END AS lo,
              CASE WHEN MIN(x) = MAX(x) THEN MAX(x) + 0.5 ELSE MAX(x) END AS hi,
              quantile_cont(x, 0.5) AS median FROM d),
p AS (SELECT x, lo, (hi - lo) / {float(bins)} AS step, median FROM d, st),
i0 AS (SELECT *, least(greatest(CAST(floor((x - lo) / step) AS INTEGER), 0), {bins - 1}) AS i FROM p),
i1 AS (SELECT CASE WHEN x < i * step + lo THEN i - 1
                   WHEN x >= (i + 1) * step + lo AND i <> {bins - 1} THEN i + 1 ELSE i END AS bin
       FROM i0),
c AS (SELECT bin, COUNT(*) AS cnt FROM i1 GROUP BY bin),
b AS (SELECT CAST(range AS INTEGER) AS bin FROM range({bins}))
SELECT b.bin, round(b.bin * ((hi - lo) / {float(bins)}) + lo, 6) AS lo,
       round((b.bin + 1) * ((hi - lo) / {float(bins)}) + lo, 6) AS hi,
       CAST(coalesce(c.cnt, 0) AS BIGINT) AS count, round(median, 6) AS median
FROM b LEFT JOIN c ON b.bin = c.bin, st
"""


def _hist(df, c, bins, log=False):
    h = profile.histogram(df, c, bins, log)
    return h.select("bin", rnd("lo", 6).alias("lo"), rnd("hi", 6).alias("hi"), "count",
                    rnd("median", 6).alias("median"))


@query("m4_histogram", _hist_sql("price", 30))
def _m4(spark, sf):
    return _hist(sales(spark, sf), "price", 30)


@query("m4_histogram_log", _hist_sql("ln(1 + price)", 40))
def _m4l(spark, sf):
    return _hist(sales(spark, sf), "price", 40, log=True)


def _pair_sql(c: str, t: str = "price") -> str:
    return (f"SELECT '{c}' AS feature, CASE WHEN COUNT(*) >= 3 THEN round(corr({c}, {t}), 9) END "
            f"AS pearson, COUNT(*) AS n FROM sales WHERE {c} IS NOT NULL AND {t} IS NOT NULL")


@query("m5_pearson", f"""{S}
{" UNION ALL ".join(_pair_sql(c) for c in NUM)}
""")
def _m5(spark, sf):
    p = profile.pearson(sales(spark, sf), NUM, "price")
    return p.select("feature", rnd("pearson", 9).alias("pearson"), "n")


CM = ["qty", "ext", "disc", "acctbal"]


@query("m5_corr_matrix", f"""{S}
{" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {a} END, CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {b} END), 9) AS r FROM sales" for a in CM for b in CM)}
""")
def _m5m(spark, sf):
    return profile.corr_matrix(sales(spark, sf), CM).select("a", "b", rnd("r", 9).alias("r"))


SP = ["qty", "ext", "disc", "quality", "n_lines"]


def _spearman_sql(c: str, t: str = "price") -> str:
    return f"""SELECT '{c}' AS feature, round(corr(rx, ry), 9) AS spearman, COUNT(*) AS n FROM (
  SELECT rank() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS rx,
         rank() OVER (ORDER BY {t}) + (COUNT(*) OVER (PARTITION BY {t}) - 1) / 2.0 AS ry
  FROM sales WHERE {c} IS NOT NULL AND {t} IS NOT NULL)"""


@query("m6_spearman", f"""{S}
{" UNION ALL ".join(_spearman_sql(c) for c in SP)}
""")
def _m6(spark, sf):
    return profile.spearman(sales(spark, sf), SP, "price").select(
        "feature", rnd("spearman", 9).alias("spearman"), "n")


@query("m7_segment_mean_diff", f"""{S}
{" UNION ALL ".join(f"SELECT '{c}' AS feature, round((AVG(CASE WHEN price >= 200000 THEN coalesce(CAST({c} AS DOUBLE), 0.0) END) - AVG(CASE WHEN price < 200000 THEN coalesce(CAST({c} AS DOUBLE), 0.0) END)) / NULLIF(AVG(CASE WHEN price < 200000 THEN coalesce(CAST({c} AS DOUBLE), 0.0) END), 0), 9) AS difference FROM sales" for c in NUM)}
""")
def _m7(spark, sf):
    d = profile.segment_mean_diff(sales(spark, sf), NUM, "price")
    return d.select("feature", rnd("difference", 9).alias("difference"))


@query("m8_fit_normal", f"""{S}
SELECT 'normal' AS family, round(AVG(price), 6) AS mu, round(stddev_pop(price), 6) AS sigma,
       COUNT(price) AS n FROM sales
""")
def _m8n(spark, sf):
    d = dist.fit_normal(sales(spark, sf), "price")
    return d.select("family", rnd("mu", 6).alias("mu"), rnd("sigma", 6).alias("sigma"), "n")


@query("m8_fit_lognormal", f"""{S}
SELECT 'lognormal' AS family, round(AVG(CASE WHEN price > 0 THEN ln(price) END), 9) AS mu,
       round(stddev_pop(CASE WHEN price > 0 THEN ln(price) END), 9) AS sigma,
       COUNT(CASE WHEN price > 0 THEN ln(price) END) AS n FROM sales
""")
def _m8l(spark, sf):
    d = dist.fit_lognormal(sales(spark, sf), "price")
    return d.select("family", rnd("mu", 9).alias("mu"), rnd("sigma", 9).alias("sigma"), "n")


def _su_probs():
    from statistics import NormalDist
    nd = NormalDist()
    z = dist.SU_Z
    return [nd.cdf(-3 * z), nd.cdf(-z), nd.cdf(z), nd.cdf(3 * z)]


def _su_sql(col: str, src: str) -> str:
    p = ", ".join(repr(v) for v in _su_probs())
    return f"""q AS (SELECT quantile_cont({col}, [{p}]) AS q FROM {src}),
v AS (SELECT q[1] AS a, q[2] AS b, q[3] AS c, q[4] AS d FROM q),
w AS (SELECT *, d - c AS m, b - a AS n, c - b AS p FROM v),
x AS (SELECT *, m * n / (p * p) AS r, m / p + n / p AS s, n / p - m / p AS t FROM w)
SELECT CASE WHEN r > 1 THEN 'johnson_su' ELSE 'not SU' END AS family, round(r, 9) AS "R",
  CASE WHEN r > 1 THEN round({2 * dist.SU_Z} / acosh(s / 2) * asinh(t / (2 * sqrt(r - 1))), 9) END AS gamma,
  CASE WHEN r > 1 THEN round({2 * dist.SU_Z} / acosh(s / 2), 9) END AS eta,
  CASE WHEN r > 1 THEN round((b + c) / 2 + p * t / (2 * (s - 2)), 6) END AS epsilon,
  CASE WHEN r > 1 THEN round(2 * p * sqrt(r - 1) / ((s - 2) * sqrt(s + 2)), 6) END AS lambda
FROM x"""


def _su_out(d):
    return d.select("family", rnd("R", 9).alias("R"), rnd("gamma", 9).alias("gamma"),
                    rnd("eta", 9).alias("eta"), rnd("epsilon", 6).alias("epsilon"),
                    rnd("lambda", 6).alias("lambda"))


@query("m8_fit_johnson_su", f"{S},\n{_su_sql('price', 'sales')}")
def _m8j(spark, sf):
    return _su_out(dist.fit_johnson_su(sales(spark, sf), "price"))


@query("m8_fit_johnson_su_acctbal", f"{S},\n{_su_sql('acctbal * acctbal * acctbal', 'sales')}")
def _m8j2(spark, sf):
    d = sales(spark, sf).withColumn("x", F.pow("acctbal", 3))
    return _su_out(dist.fit_johnson_su(d, "x"))


@query("m9_johnson_transform", f"""{S},
st AS (SELECT AVG(ln(1 + price)) AS mu, stddev_pop(ln(1 + price)) AS sd FROM sales)
SELECT id, round(0.0 + 1.0 * asinh((ln(1 + price) - mu) / sd), 6) AS yt,
       round(sd * sinh((0.0 + 1.0 * asinh((ln(1 + price) - mu) / sd) - 0.0) / 1.0) + mu, 6) AS back
FROM sales, st
""")
def _m9(spark, sf):
    s = sales(spark, sf).withColumn("y", F.log1p("price"))
    st = s.agg(F.avg("y").alias("mu"), F.stddev_pop("y").alias("sd")).first()
    yt = dist.johnson_transform(F.col("y"), 0.0, 1.0, st["mu"], st["sd"])
    back = dist.johnson_inverse(yt, 0.0, 1.0, st["mu"], st["sd"])
    return s.select("id", rnd(yt, 6).alias("yt"), rnd(back, 6).alias("back"))


def _jb_sql(c: str) -> str:
    x = f"coalesce(CAST({c} AS DOUBLE), 0.0)"
    return f"""SELECT '{c}' AS feature, n, round(jb, 6) AS jb, round(exp(-jb / 2), 9) AS p_value,
  coalesce(exp(-jb / 2) < 0.01, false) AS reject_normal FROM (
  SELECT n, n / 6.0 * (s * s + k * k / 4.0) AS jb FROM (
    SELECT COUNT(*) AS n,
           AVG(power({x} - mu, 3)) / power(AVG(power({x} - mu, 2)), 1.5) AS s,
           AVG(power({x} - mu, 4)) / power(AVG(power({x} - mu, 2)), 2) - 3.0 AS k
    FROM sales, (SELECT AVG({x}) AS mu FROM sales)))"""


@query("m10_normality_test", f"""{S}
{" UNION ALL ".join(_jb_sql(c) for c in NUM)}
""")
def _m10(spark, sf):
    d = dist.normality_test(sales(spark, sf), NUM)
    return d.select("feature", "n", rnd("jb", 6).alias("jb"), rnd("p_value", 9).alias("p_value"),
                    "reject_normal")


PCA_COLS = ["qty", "ext", "n_lines", "disc", "ret_qty", "acctbal", "quality", "yr_built"]


@query("m11_pca")
def _m11(spark, sf):
    _proj, var = cluster.pca(sales(spark, sf), PCA_COLS, "id", k=5)
    return var.select("component", rnd("explained_variance", 6).alias("explained_variance"))


@query("m12_kmeans")
def _m12(spark, sf):
    proj, _ = cluster.pca(sales(spark, sf), PCA_COLS, "id", k=5)
    _assigned, sizes = cluster.kmeans(proj, "id", k=5, seed=42)
    return sizes


@query("m13_project_2d")
def _m13(spark, sf):
    proj, _ = cluster.pca(sales(spark, sf), PCA_COLS, "id", k=5)
    assigned, _ = cluster.kmeans(proj, "id", k=5, seed=42)
    return cluster.project_2d(assigned, "id")


@query("m14_data_overview", f"""{S}
SELECT (SELECT COUNT(*) FROM sales WHERE yr_built < 1998) AS train_rows,
       (SELECT COUNT(*) FROM sales WHERE yr_built >= 1998) AS test_rows,
       CAST(16 AS BIGINT) AS columns, CAST(10 AS BIGINT) AS quantitative,
       CAST(4 AS BIGINT) AS qualitative
""")
def _m14(spark, sf):
    tr, te = sales_split(spark, sf)
    return profile.data_overview(tr, te.drop("price"), "price", "id")


@query("e1_population_scaler", f"""{S},
st AS (SELECT AVG(ext) AS m1, stddev_pop(ext) AS s1, AVG(CAST(quality AS DOUBLE)) AS m2,
              stddev_pop(quality) AS s2 FROM sales)
SELECT id, round((ext - m1) / s1, 6) AS ext, round((quality - m2) / s2, 6) AS quality
FROM sales, st
""")
def _e1(spark, sf):
    d = sales(spark, sf).select("id", "ext", "quality")
    m = encode.PopulationScaler(inputCols=["ext", "quality"]).fit(d)
    out = m.transform(d)
    return out.select("id", rnd("ext", 6).alias("ext"), rnd("quality", 6).alias("quality"))


@query("e2_one_hot_all", f"""{S},
ref AS (SELECT * FROM sales WHERE yr_built < 1998),
cur AS (SELECT * FROM sales WHERE yr_built >= 1998),
lv AS (SELECT (SELECT list_sort(list(DISTINCT segment)) FROM ref WHERE segment IS NOT NULL) AS ls,
              (SELECT list_sort(list(DISTINCT status)) FROM ref WHERE status IS NOT NULL) AS lt)
SELECT id,
       list_transform(ls, x -> CASE WHEN segment = x THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS segment_ohe,
       list_transform(lt, x -> CASE WHEN status = x THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS status_ohe
FROM cur, lv
""".replace("x -> ", "lambda x: "))
def _e2(spark, sf):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    tr, te = sales_split(spark, sf)
    p = Pipeline(stages=encode.one_hot_all(["segment", "status"])).fit(tr)
    out = p.transform(te)
    return out.select("id", vector_to_array("segment_ohe").alias("segment_ohe"),
                      vector_to_array("status_ohe").alias("status_ohe"))


@query("e3_assembler", f"""{S}
SELECT id, CAST(10 + (SELECT COUNT(DISTINCT segment) FROM sales)
                   + (SELECT COUNT(DISTINCT priority) FROM sales)
                   + (SELECT COUNT(DISTINCT status) FROM sales) AS INTEGER) AS slots
FROM sales
""")
def _e3(spark, sf):
    from pyspark.ml.functions import vector_to_array
    s = sales(spark, sf).drop("nbhd")
    pipe = encode.assembler(s, exclude=["id", "price"], linear=True)
    out = pipe.fit(s).transform(s)
    return out.select("id", F.size(vector_to_array("features")).alias("slots"))


@query("e4_dummies", f"""{S}
SELECT id, coalesce(CAST(quality AS DOUBLE), 0.0) AS quality,
       {", ".join(f"CAST(coalesce(segment = '{v}', false) AS INTEGER) AS \"segment_{v}\"" for v in ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"])},
       CAST(segment IS NULL AS INTEGER) AS segment_nan,
       {", ".join(f"CAST(coalesce(status = '{v}', false) AS INTEGER) AS \"status_{v}\"" for v in ["F", "O", "P"])},
       CAST(status IS NULL AS INTEGER) AS status_nan
FROM sales
""")
def _e4(spark, sf):
    d = sales(spark, sf).select("id", "quality", "segment", "status")
    return encode.dummies(d, exclude=["id"])
