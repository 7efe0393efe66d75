"""Model interpretation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.functions.exprs import hash_key
from hearth.operators.features import FeatureSpec
from hearth.operators.folds import dense_index


def slot_names(df: DataFrame, features_col: str = "features") -> list[str]:
    """Slot names from the vector column's ML attribute metadata (fallback
    x0..x{n-1})."""
    meta = df.schema[features_col].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    slots = []
    for group in attrs.values():
        slots.extend((a["idx"], a["name"]) for a in group)
    if slots:
        return [n for _, n in sorted(slots)]
    n = meta.get("num_attrs", 0)
    return [f"x{i}" for i in range(n)]


def importance(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    """|coefficient| for linear models (mean over outputs), impurity
    importance for tree ensembles, as (feature, importance)."""
    if hasattr(model, "coefficients"):
        vals = [abs(float(v)) for v in model.coefficients.toArray()]
    elif hasattr(model, "coefficientMatrix"):
        m = model.coefficientMatrix.toArray()
        vals = [float(abs(m[:, j]).mean()) for j in range(m.shape[1])]
    else:
        vals = [float(v) for v in model.featureImportances.toArray()]
    names = list(names) if len(names) == len(vals) else [f"x{i}" for i in range(len(vals))]
    return spark.createDataFrame(list(zip(names, vals)), "feature string, importance double")


def signed_coefficients(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    """Coefficient, magnitude and sign per slot."""
    vals = [float(v) for v in model.coefficients.toArray()]
    d = spark.createDataFrame(list(zip(names, vals)), "feature string, coefficient double")
    return d.select("feature", "coefficient", F.abs("coefficient").alias("magnitude"),
                    F.when(F.col("coefficient") > 0, "positive").when(F.col("coefficient") < 0,
                                                                        "negative")
                    .otherwise("zero").alias("sign"))


def voting_importance(imps: DataFrame, weights: DataFrame) -> DataFrame:
    """Weighted average of member importances, weights normalised over
    the members that reported an importance: sum(w * imp) / sum(w)."""
    j = imps.join(F.broadcast(weights), "member")  # one weight per member
    return j.groupBy("feature").agg(
        (F.sum(F.col("weight") * F.col("importance")) / F.sum("weight")).alias("importance"))


def stacking_importance(spark: SparkSession, meta_model, base_names: Sequence[str],
                        base_imps: DataFrame | None = None) -> DataFrame:
    """Meta-model coefficients over the base predictions; without a
    linear meta model, the mean of the base importances."""
    if meta_model is not None and hasattr(meta_model, "coefficients"):
        return importance(spark, meta_model, base_names)
    return base_imps.groupBy("feature").agg(F.avg("importance").alias("importance"))


def top_features(imp: DataFrame, k: int = 30) -> DataFrame:
    """K largest |importance| (TakeOrdered)."""
    return imp.orderBy(F.desc(F.abs("importance")), F.asc("feature")).limit(k)


def newest_reports(reports: DataFrame, by: str = "model") -> DataFrame:
    """Newest stored report per model (max_by over creation time)."""
    return reports.groupBy(by).agg(F.max_by("report", "created_at").alias("report"),
                                   F.max("created_at").alias("created_at"))


def ols_inference(df: DataFrame, features_col: str, label: str) -> DataFrame:
    """Unregularised least squares on the raw target with t statistics
    and p-values per slot (needs a non-singular design: use drop-first
    dummies), sorted by p-value."""
    from pyspark.ml.regression import LinearRegression
    m = LinearRegression(featuresCol=features_col, labelCol=label, regParam=0.0,
                         solver="normal", standardization=False).fit(df)
    s = m.summary
    names = slot_names(df, features_col) + ["intercept"]
    coefs = [float(v) for v in m.coefficients.toArray()] + [float(m.intercept)]
    rows = list(zip(names, coefs, [float(v) for v in s.coefficientStandardErrors],
                    [float(v) for v in s.tValues], [float(v) for v in s.pValues]))
    spark = df.sparkSession
    out = spark.createDataFrame(rows, "feature string, coefficient double, std_error double, "
                                      "t_value double, p_value double")
    return out.orderBy("p_value", "feature")


def permutation_importance(holdout: DataFrame, model, names: Sequence[str], id_col: str,
                           label: str = "label", features_col: str = "features",
                           repeats: int = 8, seed: int = 42) -> DataFrame:
    """Mean and std (ddof 0) over ``repeats`` of the RMSE increase when
    one encoded slot is permuted, for a fitted linear model.

    Each repeat pairs every row with a partner row (two md5 orders of the
    key, joined on the dense index).  The prediction with slot j permuted is
    pred + c_j (x_partner_j - x_j), so SSE_j = See - 2 c_j Sed_j + c_j^2 Sdd_j:
    three vector sums per repeat (Summarizer), no refit and no per-slot pass."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    from hearth.session import cut_lineage
    spark = holdout.sparkSession
    coef = [float(v) for v in model.coefficients.toArray()]
    p = model.transform(holdout).select(id_col, F.col(label).alias("_y"),
                                        F.col("prediction").alias("_p"),
                                        vector_to_array(features_col).alias("_x"))
    p = cut_lineage(p)  # reused by every repeat
    base = p.agg(F.sum(F.pow(F.col("_y") - F.col("_p"), 2)).alias("see"),
                 F.count(F.lit(1)).alias("n")).first()
    n, see = base["n"], base["see"]
    rmse0 = (see / n) ** 0.5
    rows = []
    for r in range(repeats):
        a = dense_index(p.select(id_col), hash_key(id_col, seed * 1000 + 2 * r), [id_col], "_i")
        b = dense_index(p.select(F.col(id_col).alias("_partner")),
                        hash_key("_partner", seed * 1000 + 2 * r + 1), ["_partner"], "_i")
        pairs = a.join(b, "_i").drop("_i")
        j = (p.join(pairs, id_col)
             .join(p.select(F.col(id_col).alias("_partner"), F.col("_x").alias("_xp")),
                   "_partner"))
        e = F.col("_y") - F.col("_p")
        d = F.zip_with("_xp", "_x", lambda u, v: u - v)
        v = j.select(array_to_vector(F.transform(d, lambda t: t * e)).alias("ed"),
                     array_to_vector(F.transform(d, lambda t: t * t)).alias("dd"))
        s = v.select(Summarizer.sum(F.col("ed")).alias("ed"),
                     Summarizer.sum(F.col("dd")).alias("dd")).first()
        ed, dd = s["ed"].toArray(), s["dd"].toArray()
        for k, name in enumerate(names):
            sse = see - 2 * coef[k] * ed[k] + coef[k] ** 2 * dd[k]
            rows.append((name, r, float(max(float(sse), 0.0) ** 0.5 / n ** 0.5 - rmse0)))
    det = spark.createDataFrame(rows, "feature string, repeat int, rmse_increase double")
    return det.groupBy("feature").agg(F.avg("rmse_increase").alias("importance_mean"),
                                      F.stddev_pop("rmse_increase").alias("importance_std")) \
              .orderBy(F.desc("importance_mean"), "feature")


# Level names of ordinal quality codes and yes/no codes.
QUALITY_LEVEL = {"Ex": "Excellent", "Gd": "Good", "TA": "Typical/Average", "Fa": "Fair",
                 "Po": "Poor", "NA": "Not applicable / none"}
YESNO_LEVEL = {"Y": "Yes", "N": "No"}
def _lookup(d: dict, key: Column) -> Column:
    if not d:
        return F.lit(None).cast("string")
    return F.element_at(F.create_map(*[F.lit(x) for kv in d.items() for x in kv]), key)


def describe_features(df: DataFrame, field_desc: dict, col: str = "feature",
                      engineered: dict | None = None) -> DataFrame:
    """A text for each encoded slot name, composed from its parts.

    Parts before a double underscore are cut off from the left, one by one.
    What remains is a derived column (told by its formula in ``FeatureSpec``),
    the log of a column, a level of a column, a column, or else told by its
    name alone.  The dictionaries are small literal maps evaluated per row."""
    formulas = engineered if engineered is not None else FeatureSpec().formulas()
    d = df.withColumn("_s", F.regexp_replace(col, r"^(?:.*?__)+", ""))
    s = F.col("_s")
    source = F.regexp_replace(s, r"_log$", "")
    field, level = F.substring_index(s, "_", 1), F.expr("substr(_s, instr(_s, '_') + 1)")
    named = F.concat(level, F.coalesce(F.concat(F.lit(" ("), F.coalesce(_lookup(QUALITY_LEVEL, level), _lookup(YESNO_LEVEL, level)), F.lit(")")), F.lit("")))
    kind = F.when(s.rlike("^(Has|Is)"), "flag").when(s.endswith("Bin"), "bucket").otherwise("column")
    texts = [
        F.concat(s, F.lit(" = "), _lookup(formulas, s)),
        F.when(s.endswith("_log"), F.concat_ws(": ", F.concat(F.lit("log1p of "), source), _lookup(field_desc, source))),
        F.when(s.contains("_"), F.coalesce(F.concat(field, F.lit(" is "), named, F.lit(": "), _lookup(field_desc, field)), F.concat(F.lit("indicator "), s))),
        _lookup(field_desc, s),
        F.concat(kind, F.lit(" "), s),
    ]
    return d.select(*df.columns, F.coalesce(*texts).alias("description"))
