"""Source / sink plans (A1-A8): round trips through CSV, JSON and Parquet
written under the session's checkpoint directory."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from hearth.functions.exprs import rnd
from hearth.operators.oof import fold_summary
from hearth.plans.q_flagship import PRED_SQL, predictions
from hearth.plans.registry import query
from hearth.plans.sqlparts import RUNS_CTE, SALES_CTE
from hearth.session import checkpoint_dir
from hearth.sources import io
from hearth.sources.bindings import runs as runs_binding
from hearth.sources.bindings import sales, sales_split

S = f"WITH {SALES_CTE.strip()}"
SALES_SCHEMA = ("id bigint, price double, yr_built bigint, yr_sold bigint, yr_remod bigint, "
                "qty double, ext double, n_lines bigint, disc double, ret_qty double, "
                "acctbal double, quality bigint, nbhd string, segment string, priority string, "
                "status string")
SALES_COLS = [c.split()[0] for c in SALES_SCHEMA.split(", ")]


def _dir(spark, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "io", name)


def _write_csv(df, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("nullValue", "NA").csv(path)


@query("a1_read_table_parquet", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
""")
def _a1p(spark, sf):
    schema = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp, o_orderpriority string")
    d = io.read_table(spark, f"{sf}/orders.parquet", schema=schema, na_tokens=["NA", ""])
    return d.drop("o_orderdate")


@query("a1_read_table_csv", f"""{S}
SELECT {", ".join(SALES_COLS)} FROM sales
""")
def _a1c(spark, sf):
    path = _dir(spark, "sales_csv")
    _write_csv(sales(spark, sf), path)
    return io.read_table(spark, path, schema=SALES_SCHEMA, fmt="csv")


@query("a2_load_train_test", f"""{S}
SELECT CASE WHEN yr_built < 1998 THEN 'train' ELSE 'test' END AS split, COUNT(*) AS n,
       CAST(SUM(id) AS BIGINT) AS id_sum, COUNT(CASE WHEN yr_built < 1998 THEN price END) AS with_target
FROM sales GROUP BY 1
""")
def _a2(spark, sf):
    ref, cur = sales_split(spark, sf)
    tr_p, te_p = _dir(spark, "train_csv"), _dir(spark, "test_csv")
    _write_csv(ref, tr_p)
    _write_csv(cur.drop("price"), te_p)
    from pyspark.sql.types import _parse_datatype_string
    schema = _parse_datatype_string(SALES_SCHEMA)
    tr, te = io.load_train_test(spark, tr_p, te_p, "price", schema, fmt="csv")
    agg = [F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum")]
    return (tr.agg(*agg, F.count("price").alias("with_target"))
            .select(F.lit("train").alias("split"), "*")
            .unionByName(te.agg(*agg, F.lit(0).cast("bigint").alias("with_target"))
                         .select(F.lit("test").alias("split"), "*")))


@query("a3_prepare_features", f"""{S}
SELECT id, qty, nbhd, round(ln(1 + price), 6) AS label FROM sales
""")
def _a3(spark, sf):
    d = io.prepare_features(sales(spark, sf), "id", "price")
    return d.select("id", "qty", "nbhd", rnd("label", 6).alias("label"))


@query("a4_predictions_roundtrip", f"""WITH {PRED_SQL.strip()},
m AS (SELECT * FROM (VALUES ('ridge_ext', 0.5::DOUBLE)) v(model, cv_rmse))
SELECT p.model, p.id, round(p.pred_log, 6) AS pred_log, coalesce(m.cv_rmse, 1.0) AS rmse
FROM preds p LEFT JOIN m ON p.model = m.model WHERE p.model IN ('ridge_ext', 'seg_mean')
""")
def _a4(spark, sf):
    path = _dir(spark, "predictions")
    io.write_predictions(predictions(spark, sf), path)
    metrics = spark.createDataFrame([("ridge_ext", 0.5)], "model string, cv_rmse double")
    d = io.read_predictions(spark, path, ["ridge_ext", "seg_mean"], metrics)
    return d.select("model", "id", rnd("pred_log", 6).alias("pred_log"), "rmse")


@query("a5_write_metrics", f"""WITH {PRED_SQL.strip()},
pe AS (SELECT p.model, p.fold, (p.pred_log - ln(1 + s.price)) AS r FROM preds p JOIN sales s ON p.id = s.id)
SELECT model, fold, round(sqrt(AVG(r * r)), 9) AS rmse FROM pe GROUP BY model, fold
""")
def _a5(spark, sf):
    p = predictions(spark, sf)
    y = sales(spark, sf).select("id", F.log1p("price").alias("y"))
    m = fold_summary(p.join(y, "id"), "y", "pred_log", by=["model"]).select(
        "model", F.col("oof_rmse").alias("cv_rmse"),
        F.transform("fold_rmse", lambda s: s["rmse"]).alias("fold_rmse"))
    path = _dir(spark, "metrics_json")
    io.write_metrics(m, path, "json")
    back = spark.read.json(path)
    return back.select("model", F.posexplode("fold_rmse").alias("fold", "rmse")).select(
        "model", F.col("fold").cast("int").alias("fold"), rnd("rmse", 9).alias("rmse"))


@query("a6_write_submission", f"""WITH {PRED_SQL.strip()}
SELECT id, round(greatest(exp(pred_log) - 1, 0.0), 2) AS "SalePrice" FROM preds WHERE model = 'ridge_ext'
""")
def _a6(spark, sf):
    p = predictions(spark, sf).filter(F.col("model") == "ridge_ext")
    path = _dir(spark, "submission_csv")
    io.write_submission(p, "id", "pred_log", path)
    back = spark.read.schema("id bigint, SalePrice double").option("header", True).csv(path)
    return back.select("id", rnd("SalePrice", 2).alias("SalePrice"))


@query("a7_save_load_model", f"""WITH {SALES_CTE.strip()}
SELECT COUNT(*) AS rows, true AS equal FROM sales WHERE yr_built >= 1998
""")
def _a7(spark, sf):
    from hearth.plans.q_score import _fit_ridge
    ref, cur = sales_split(spark, sf)
    model, _f = _fit_ridge(ref)
    path = io.save_model(model, _dir(spark, "models"), "ridge", "2025-03-01_000000")
    loaded = io.load_model(path)
    a = model.transform(cur).select("id", F.col("prediction").alias("a"))
    b = loaded.transform(cur).select("id", F.col("prediction").alias("b"))
    return a.join(b, "id").agg(F.count(F.lit(1)).alias("rows"),
                               (F.max(F.abs(F.col("a") - F.col("b"))) <= 1e-12).alias("equal"))


@query("a8_read_summary", f"""WITH {RUNS_CTE.strip()}
SELECT CASE WHEN size % 2 = 0 THEN 'Stage1' ELSE 'Stage2' END AS stage, model, run_id AS candidate,
       cv_rmse AS rmse_mean, CASE WHEN size % 3 = 0 THEN 0.0 ELSE size / 1000.0 END AS rmse_std
FROM runs WHERE cv_rmse IS NOT NULL
""")
def _a8(spark, sf):
    r = runs_binding(spark, sf)
    messy = r.select(
        F.when(F.col("size") % 2 == 0, F.lit(" stage 1 ")).otherwise(F.lit("stage2"))
        .alias(" Stage "),
        F.concat(F.lit(" "), F.col("model")).alias("Model "),
        F.col("run_id").alias(" candidate"),
        F.coalesce(F.col("cv_rmse").cast("string"), F.lit("n/a")).alias("RMSE_MEAN"),
        F.when(F.col("size") % 3 == 0, F.lit(None)).otherwise(
            (F.col("size") / 1000.0).cast("string")).alias("rmse_std"))
    path = _dir(spark, "summary_csv")
    messy.write.mode("overwrite").option("header", True).csv(path)
    return io.read_summary(spark, path)
