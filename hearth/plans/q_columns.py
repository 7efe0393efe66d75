"""Column work: projections/predicates (B), imputation (C), features (D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.functions.exprs import rnd
from hearth.operators import align, features, impute
from hearth.plans.registry import query
from hearth.plans.sqlparts import HOUSE_CTE, SALES_CTE
from hearth.sources.bindings import house, sales, table

W = f"WITH {HOUSE_CTE.strip()}"


# ---------------------------------------------------------------- B ----
@query("b1_align_schema", f"""{W}
SELECT "Id", "OverallQual", "GrLivArea", CAST(0 AS INTEGER) AS "PoolArea", "LotArea" FROM house
""")
def _b1(spark, sf):
    d, _missing, _extra = align.align_schema(
        house(spark, sf), ["OverallQual", "GrLivArea", "PoolArea", "LotArea"], "Id")
    return d


@query("b2_to_numeric", """
SELECT event_id AS id,
       TRY_CAST(CASE WHEN event_id % 5 = 0 THEN 'k' || regexp_extract(props, '([0-9]+)', 1)
                ELSE regexp_extract(props, '([0-9]+)', 1) END AS DOUBLE) AS k
FROM events
""")
def _b2(spark, sf):
    e = table(spark, sf, "events")
    digits = F.regexp_extract("props", "([0-9]+)", 1)
    raw = e.select(F.col("event_id").alias("id"), F.when(F.col("event_id") % 5 == 0, F.concat(
        F.lit("k"), digits)).otherwise(digits).alias("k"))
    return align.to_numeric(raw, ["k"])


@query("b3_log_target", f"""{W}
SELECT "Id", round(ln(1 + "SalePrice"), 6) AS label,
       round(greatest(exp(ln(1 + "SalePrice")) - 1, 0.0), 4) AS back FROM house
""")
def _b3(spark, sf):
    d = align.log_target(house(spark, sf), "SalePrice")
    d = align.unlog_pred(d, "label", "back")
    return d.select("Id", rnd("label", 6).alias("label"), rnd("back", 4).alias("back"))


@query("b4_trim_quantiles", f"""WITH {SALES_CTE.strip()},
b AS (SELECT quantile_cont(acctbal, 0.01) AS lo, quantile_cont(acctbal, 0.99) AS hi FROM sales)
SELECT id, acctbal FROM sales, b WHERE acctbal BETWEEN lo AND hi
""")
def _b4(spark, sf):
    return align.trim_quantiles(sales(spark, sf).select("id", "acctbal"), "acctbal", 0.01, 0.99)


def _seg_sql(cond: str, stat: str = "") -> str:
    frm = f"FROM sales{', t' if stat else ''}"
    pre = f",\nt AS (SELECT {stat} AS t FROM sales)" if stat else ""
    return f"""WITH {SALES_CTE.strip()}{pre}
SELECT CASE WHEN {cond} THEN 'high' ELSE 'low' END AS segment, COUNT(*) AS n, CAST(SUM(id) AS BIGINT) AS id_sum
{frm} GROUP BY 1"""


@query("b5_segment_median", _seg_sql("price > t", "quantile_cont(price, 0.5)"))
def _b5m(spark, sf):
    d = align.segment_by_threshold(sales(spark, sf), "price", "median")
    return d.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum"))


@query("b5_segment_top_quartile", _seg_sql("price >= t", "quantile_cont(price, 0.75)"))
def _b5q(spark, sf):
    d = align.segment_by_threshold(sales(spark, sf), "price", "top_quartile")
    return d.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum"))


@query("b5_segment_fixed", _seg_sql("price > 200000"))
def _b5f(spark, sf):
    d = align.segment_by_threshold(sales(spark, sf), "price", "fixed", 200000.0)
    return d.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum"))


@query("b6_flag_top_share", f"""WITH {SALES_CTE.strip()},
t AS (SELECT quantile_cont(price, 0.95) AS t FROM sales)
SELECT CAST(coalesce(price >= t, false) AS INTEGER) AS is_top, COUNT(*) AS n, CAST(SUM(id) AS BIGINT) AS id_sum
FROM sales, t GROUP BY 1
""")
def _b6(spark, sf):
    d = align.flag_top_share(sales(spark, sf), "price", 0.95)
    return d.groupBy("is_top").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum"))


@query("b7_drop_missing", f"""{W}
SELECT COUNT(*) AS n, CAST(SUM("Id") AS BIGINT) AS id_sum FROM house
WHERE TRY_CAST("TotalBsmtSF" AS DOUBLE) IS NOT NULL AND TRY_CAST("Neighborhood" AS DOUBLE) IS NULL
  AND TRY_CAST("LotFrontage" AS DOUBLE) IS NOT NULL
""")
def _b7(spark, sf):
    d = align.drop_missing(house(spark, sf), ["TotalBsmtSF", "LotFrontage"])
    return d.agg(F.count(F.lit(1)).alias("n"), F.sum("Id").alias("id_sum"))


@query("b8_schema_diff")
def _b8(spark, sf):
    return align.schema_diff(spark, house(spark, sf), sales(spark, sf), target="SalePrice")


@query("b9_with_default_columns", f"""{W}
SELECT "Id", 0 AS "PoolArea", 0 AS "ScreenPorch", "OverallQual" FROM house
""")
def _b9(spark, sf):
    d = align.with_default_columns(house(spark, sf), ["PoolArea", "ScreenPorch", "OverallQual"])
    return d.select("Id", "PoolArea", "ScreenPorch", "OverallQual")


# ---------------------------------------------------------------- C ----
@query("c1_fill_constant", f"""{W}
SELECT "Id", coalesce("Neighborhood", 'None') AS "Neighborhood",
       coalesce("FireplaceQu", 'None') AS "FireplaceQu" FROM house
""")
def _c1(spark, sf):
    d = impute.fill_constant(house(spark, sf), ["Neighborhood", "FireplaceQu", "PoolQC"])
    return d.select("Id", "Neighborhood", "FireplaceQu")


@query("c2_fill_zero", f"""{W}
SELECT "Id", coalesce("TotalBsmtSF", 0) AS "TotalBsmtSF", coalesce("MasVnrArea", 0) AS "MasVnrArea",
       coalesce("GarageArea", 0) AS "GarageArea" FROM house
""")
def _c2(spark, sf):
    d = impute.fill_zero(house(spark, sf), ["TotalBsmtSF", "MasVnrArea", "GarageArea", "GarageCars"])
    return d.select("Id", "TotalBsmtSF", "MasVnrArea", "GarageArea")


@query("c3_group_median_imputer", f"""{W},
tr AS (SELECT * FROM house WHERE "YearBuilt" < 1998),
g AS (SELECT "Neighborhood" AS nb, quantile_cont("LotFrontage", 0.5) AS m FROM tr
      WHERE "Neighborhood" IS NOT NULL GROUP BY 1),
a AS (SELECT quantile_cont("LotFrontage", 0.5) AS m FROM tr)
SELECT h."Id", round(coalesce(h."LotFrontage", g.m, a.m), 6) AS "LotFrontage"
FROM house h LEFT JOIN g ON h."Neighborhood" = g.nb, a
""")
def _c3(spark, sf):
    h = house(spark, sf)
    m = impute.GroupMedianImputer(inputCol="LotFrontage", groupCol="Neighborhood").fit(
        h.filter(F.col("YearBuilt") < 1998))
    return m.transform(h).select("Id", rnd("LotFrontage", 6).alias("LotFrontage"))


@query("c3_group_median_fill_plan", f"""{W},
g AS (SELECT "Neighborhood" AS nb, quantile_cont("LotFrontage", 0.5) AS m FROM house
      WHERE "Neighborhood" IS NOT NULL GROUP BY 1),
a AS (SELECT quantile_cont("LotFrontage", 0.5) AS m FROM house)
SELECT h."Id", round(coalesce(h."LotFrontage", g.m, a.m), 6) AS "LotFrontage"
FROM house h LEFT JOIN g ON h."Neighborhood" = g.nb, a
""")
def _c3p(spark, sf):
    d = impute.group_median_fill(house(spark, sf), "LotFrontage", "Neighborhood")
    return d.select("Id", rnd("LotFrontage", 6).alias("LotFrontage"))


@query("c4_fill_from_column", f"""{W}
SELECT "Id", coalesce(CAST("YrSold" AS DOUBLE), CAST("YearBuilt" AS DOUBLE)) AS "YrSold" FROM house
""")
def _c4(spark, sf):
    return impute.fill_from_column(house(spark, sf), "YrSold", "YearBuilt").select("Id", "YrSold")


def _mode_sql(cols):
    parts = []
    for c in cols:
        parts.append(f"""(SELECT "{c}" FROM tr WHERE "{c}" IS NOT NULL GROUP BY 1
            ORDER BY COUNT(*) DESC, 1 ASC LIMIT 1) AS "{c}\"""")
    return ",\n".join(parts)


MODE_COLS = ["MSZoning", "KitchenQual", "SaleType", "Neighborhood"]


@query("c5_mode_imputer", f"""{W},
tr AS (SELECT * FROM house WHERE "YearBuilt" < 1998),
m AS (SELECT {_mode_sql(MODE_COLS)})
SELECT h."Id", {", ".join(f'coalesce(h."{c}", m."{c}") AS "{c}"' for c in MODE_COLS)}
FROM house h, m
""")
def _c5(spark, sf):
    h = house(spark, sf)
    m = impute.ModeImputer(inputCols=MODE_COLS).fit(h.filter(F.col("YearBuilt") < 1998))
    return m.transform(h).select("Id", *MODE_COLS)


MED_COLS = ["TotalBsmtSF", "LotFrontage", "YrSold", "GrLivArea"]


@query("c6_median_imputer", f"""{W},
m AS (SELECT {", ".join(f'quantile_cont("{c}", 0.5) AS "{c}"' for c in MED_COLS)} FROM house)
SELECT h."Id", round(coalesce(h."TotalBsmtSF", m."TotalBsmtSF"), 6) AS "TotalBsmtSF",
       round(coalesce(h."LotFrontage", m."LotFrontage"), 6) AS "LotFrontage",
       coalesce(CAST(h."YrSold" AS DOUBLE), m."YrSold") AS "YrSold",
       coalesce(CAST(h."GrLivArea" AS DOUBLE), m."GrLivArea") AS "GrLivArea"
FROM house h, m
""")
def _c6(spark, sf):
    h = house(spark, sf)
    m = impute.MedianImputer(inputCols=MED_COLS).fit(h)
    d = m.transform(h)
    return d.select("Id", rnd("TotalBsmtSF", 6).alias("TotalBsmtSF"),
                    rnd("LotFrontage", 6).alias("LotFrontage"), "YrSold", "GrLivArea")


OTHER_COLS = ["Neighborhood", "MSZoning", "KitchenQual", "SaleType", "FireplaceQu"]


@query("c7_most_frequent_imputer", f"""{W},
tr AS (SELECT * FROM house),
m AS (SELECT {_mode_sql(OTHER_COLS)})
SELECT h."Id", {", ".join(f'coalesce(h."{c}", m."{c}") AS "{c}"' for c in OTHER_COLS)}
FROM house h, m
""")
def _c7(spark, sf):
    h = house(spark, sf)
    cols = impute.other_columns(h, exclude=["Id"])
    m = impute.ModeImputer(inputCols=cols).fit(h)
    return m.transform(h).select("Id", *OTHER_COLS)


@query("c8_fill_level", f"""{W}
SELECT coalesce("Neighborhood", 'MISSING') AS "Neighborhood", COUNT(*) AS n FROM house GROUP BY 1
""")
def _c8(spark, sf):
    d = impute.fill_level(house(spark, sf), ["Neighborhood"])
    return d.groupBy("Neighborhood").agg(F.count(F.lit(1)).alias("n"))


C9_COLS = ["GrLivArea", "LotFrontage", "Neighborhood", "KitchenQual", "PoolQC"]


@query("c9_defaults_profile", f"""{W}
SELECT 'GrLivArea' AS feature, CAST(quantile_cont("GrLivArea", 0.5) AS VARCHAR) AS "default" FROM house
UNION ALL SELECT 'LotFrontage', CAST(round(quantile_cont("LotFrontage", 0.5), 6) AS VARCHAR) FROM house
UNION ALL SELECT 'Neighborhood', (SELECT "Neighborhood" FROM house WHERE "Neighborhood" IS NOT NULL
  GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)
UNION ALL SELECT 'KitchenQual', (SELECT "KitchenQual" FROM house WHERE "KitchenQual" IS NOT NULL
  GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)
UNION ALL SELECT 'PoolQC', NULL
""")
def _c9(spark, sf):
    h = house(spark, sf).withColumn("LotFrontage", F.round("LotFrontage", 6))
    return impute.defaults_profile(h, C9_COLS)


@query("c10_apply_defaults", f"""{W},
inc AS (SELECT "Id", CASE WHEN "Id" % 3 = 0 THEN NULL ELSE "GrLivArea" END AS "GrLivArea",
               CASE WHEN "Id" % 4 = 0 THEN NULL ELSE "KitchenQual" END AS "KitchenQual"
        FROM house WHERE "YearBuilt" >= 1998),
ref AS (SELECT * FROM house WHERE "YearBuilt" < 1998),
d AS (SELECT quantile_cont("GrLivArea", 0.5) AS g,
             (SELECT "KitchenQual" FROM ref WHERE "KitchenQual" IS NOT NULL GROUP BY 1
              ORDER BY COUNT(*) DESC, 1 LIMIT 1) AS k FROM ref)
SELECT "Id", coalesce(CAST("GrLivArea" AS DOUBLE), d.g) AS "GrLivArea",
       coalesce("KitchenQual", d.k) AS "KitchenQual" FROM inc, d
""")
def _c10(spark, sf):
    h = house(spark, sf)
    ref = h.filter(F.col("YearBuilt") < 1998)
    prof = {r["feature"]: r["default"] for r in
            impute.defaults_profile(ref, ["GrLivArea", "KitchenQual"]).collect()}
    inc = h.filter(F.col("YearBuilt") >= 1998).select(
        "Id", F.when(F.col("Id") % 3 == 0, F.lit(None)).otherwise(F.col("GrLivArea"))
        .alias("GrLivArea"),
        F.when(F.col("Id") % 4 == 0, F.lit(None)).otherwise(F.col("KitchenQual"))
        .alias("KitchenQual"))
    return impute.apply_defaults(inc, prof)


# ---------------------------------------------------------------- D ----
def _flag(cond):
    return f"CAST(coalesce({cond}, false) AS INTEGER)"


def _log(c):
    x = f'CAST("{c}" AS DOUBLE)'
    return f'round(ln(1 + CASE WHEN {x} < 0 THEN 0.0 ELSE {x} END), 6) AS "{c}_log"'


FEAT_SQL = f"""{W},
f0 AS (
  SELECT h.*,
    CASE WHEN CAST("YrSold" AS DOUBLE) - CAST("YearBuilt" AS DOUBLE) < 0 THEN 0.0
         ELSE CAST("YrSold" AS DOUBLE) - CAST("YearBuilt" AS DOUBLE) END AS "HouseAge",
    CASE WHEN CAST("YrSold" AS DOUBLE) - CAST("YearRemodAdd" AS DOUBLE) < 0 THEN 0.0
         ELSE CAST("YrSold" AS DOUBLE) - CAST("YearRemodAdd" AS DOUBLE) END AS "RemodAge",
    {_flag('CAST("YearBuilt" AS DOUBLE) <> CAST("YearRemodAdd" AS DOUBLE)').replace('false', 'true')} AS "IsRemodeled",
    "TotalBsmtSF" + "1stFlrSF" + "2ndFlrSF" AS "TotalSF",
    "FullBath" + 0.5::DOUBLE * "HalfBath" + 0 + 0.5::DOUBLE * 0 AS "TotalBathrooms",
    "OpenPorchSF" + "EnclosedPorch" + 0 + 0 AS "TotalPorchSF"
  FROM house h),
feat AS (
  SELECT "Id", "HouseAge", {_flag('"HouseAge" <= 5')} AS "IsNewHouse", "RemodAge", "IsRemodeled",
    "TotalSF", "TotalBathrooms", "TotalPorchSF",
    {_flag('"TotalBsmtSF" > 0')} AS "HasBasement", {_flag('"GarageArea" > 0')} AS "HasGarage",
    {_flag('"Fireplaces" > 0')} AS "HasFireplace", {_flag('0 > 0')} AS "HasPool",
    {_flag('"TotalPorchSF" > 0')} AS "HasPorch", {_flag('"WoodDeckSF" > 0')} AS "HasDeck",
    {_flag('"MasVnrArea" > 0')} AS "HasMasonryVeneer",
    {_flag('0 > 0')} + {_flag('"MasVnrArea" > 0')} + {_flag('"WoodDeckSF" > 0')}
      + {_flag('"TotalPorchSF" > 0')} + {_flag('"Fireplaces" > 0')} AS "LuxuryAmenityScore",
    "OverallQual" * "GrLivArea" AS "QualGrLiv", "OverallQual" * "TotalSF" AS "QualTotalSF",
    "OverallQual" * "GarageArea" AS "QualGarage",
    {_flag('"OverallQual" >= 7')} AS "IsHighQuality", {_flag('"GrLivArea" >= 2000')} AS "IsLargeHouse",
    {_flag('"OverallQual" >= 8 AND "GrLivArea" >= 2500')} AS "IsLuxury",
    CASE WHEN "GrLivArea" IS NULL THEN 'missing' WHEN "GrLivArea" <= 1200 THEN 'small'
         WHEN "GrLivArea" <= 2000 THEN 'mid' ELSE 'large' END AS "GrLivAreaBin",
    {", ".join(_log(c) for c in features.LOG_COLS)},
    coalesce("Neighborhood", 'nan') || '_' ||
      CASE WHEN "OverallQual" IS NULL THEN 'nan' ELSE CAST("OverallQual" AS VARCHAR) END
      AS "Neighborhood_Qual"
  FROM f0)
"""

LOG_OUT = [f"{c}_log" for c in features.LOG_COLS]


def _feat(spark, sf):
    d = features.engineer(house(spark, sf))
    return d.select(*[rnd(F.col(f"`{c}`"), 6).alias(c) if c in LOG_OUT else F.col(f"`{c}`")
                      for c in d.columns])


def _dq(name, cols):
    q = ", ".join(f'"{c}"' for c in cols)

    @query(name, f'{FEAT_SQL}SELECT "Id", {q} FROM feat')
    def _fn(spark, sf):
        return _feat(spark, sf).select("Id", *[F.col(f"`{c}`") for c in cols])
    return _fn


_dq("d1_age_features", ["HouseAge", "RemodAge"])
_dq("d2_is_new_house", ["IsNewHouse"])
_dq("d3_is_remodeled", ["IsRemodeled"])
_dq("d4_sum_columns", ["TotalSF", "TotalPorchSF"])
_dq("d5_weighted_sum", ["TotalBathrooms"])
_dq("d6_positive_flags", ["HasBasement", "HasGarage", "HasFireplace", "HasPool", "HasPorch",
                          "HasDeck", "HasMasonryVeneer"])
_dq("d7_flag_score", ["LuxuryAmenityScore"])
_dq("d8_interactions", ["QualGrLiv", "QualTotalSF", "QualGarage"])
_dq("d9_threshold_flags", ["IsHighQuality", "IsLargeHouse", "IsLuxury"])
_dq("d10_bucket", ["GrLivAreaBin"])
_dq("d11_log_features", LOG_OUT)
_dq("d12_cross_category", ["Neighborhood_Qual"])
_dq("d14_feature_engineer", [
    "HouseAge", "IsNewHouse", "RemodAge", "IsRemodeled", "TotalSF", "TotalBathrooms",
    "TotalPorchSF", "HasBasement", "HasGarage", "HasFireplace", "HasPool", "HasPorch", "HasDeck",
    "HasMasonryVeneer", "LuxuryAmenityScore", "QualGrLiv", "QualTotalSF", "QualGarage",
    "IsHighQuality", "IsLargeHouse", "IsLuxury", "GrLivAreaBin", *LOG_OUT, "Neighborhood_Qual"])


@query("d13_derive_missing_fields", f"""{W},
inc AS (SELECT "Id", "YrSold", "YearBuilt", "YearRemodAdd", "GrLivArea", "LotArea",
               CASE WHEN "Id" % 3 = 0 THEN NULL ELSE ln(1 + CASE WHEN "GrLivArea" < 0 THEN 0
                    ELSE "GrLivArea" END) + 1.0 END AS "GrLivArea_log"
        FROM house)
SELECT "Id",
  round(coalesce("GrLivArea_log", ln(1 + CASE WHEN CAST("GrLivArea" AS DOUBLE) < 0 THEN 0.0
        ELSE CAST("GrLivArea" AS DOUBLE) END)), 6) AS "GrLivArea_log",
  round(ln(1 + CASE WHEN "LotArea" < 0 THEN 0.0 ELSE "LotArea" END), 6) AS "LotArea_log",
  CASE WHEN CAST("YrSold" AS DOUBLE) - CAST("YearBuilt" AS DOUBLE) < 0 THEN 0.0
       ELSE CAST("YrSold" AS DOUBLE) - CAST("YearBuilt" AS DOUBLE) END AS "HouseAge"
FROM inc
""")
def _d13(spark, sf):
    h = house(spark, sf)
    base = F.log1p(F.when(F.col("GrLivArea") < 0, 0).otherwise(F.col("GrLivArea")))
    inc = h.select("Id", "YrSold", "YearBuilt", "YearRemodAdd", "GrLivArea", "LotArea",
                   F.when(F.col("Id") % 3 == 0, F.lit(None)).otherwise(base + 1.0)
                   .alias("GrLivArea_log"))
    d = features.derive_missing_fields(inc, variant="demo")
    return d.select("Id", rnd("GrLivArea_log", 6).alias("GrLivArea_log"),
                    rnd("LotArea_log", 6).alias("LotArea_log"), "HouseAge")

