"""One small literal-table test per semantic trap (missing values, binning,
quantiles, modes, casts) so the pandas-equivalent behaviour is pinned."""

import math

import pytest
from pyspark.sql import functions as F

from hearth.functions import exprs as X
from hearth.operators import align, drift, errors, features, impute, profile


def test_flag_missing_is_false(spark):  # T1
    d = spark.createDataFrame([(1.0,), (None,), (9.0,)], "x double")
    got = [r[0] for r in d.select(X.flag(F.col("x") <= 5)).collect()]
    assert got == [1, 0, 0]


def test_ne_flag_missing_is_true(spark):  # T2
    d = spark.createDataFrame([(1, 1), (1, None), (None, None), (1, 2)], "a int, b int")
    got = [r[0] for r in d.select(X.ne_flag("a", "b")).collect()]
    assert got == [0, 1, 1, 1]


def test_clip_keeps_null(spark):  # T3
    d = spark.createDataFrame([(-2.0,), (None,), (3.0,)], "x double")
    got = [r[0] for r in d.select(X.clip_lower("x", 0)).collect()]
    assert got == [0.0, None, 3.0]


def test_to_numeric_coerces(spark):  # T4
    d = spark.createDataFrame([("1.5",), ("abc",), (None,)], "x string")
    got = [r[0] for r in align.to_numeric(d, ["x"]).collect()]
    assert got == [1.5, None, None]


def test_nan_to_null_in_mean(spark):  # T5
    d = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double")
    assert d.agg(F.avg(X.nan_to_null("x"))).first()[0] == 2.0


def test_na_tokens(spark):  # T6
    d = spark.createDataFrame([("NA",), ("",), ("None",), ("Gd",)], "x string")
    got = [r[0] for r in d.select(X.na_tokens_to_null("x")).collect()]
    assert got == [None, None, None, "Gd"]


def test_mode_lowest_tie(spark):  # T7
    d = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)],
                              "c string")
    assert impute.modes(d, ["c"]) == {"c": "a"}


def test_linear_quantile(spark):  # T8
    d = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    from hearth.operators.quantiles import exact_quantiles
    assert exact_quantiles(d, "x", [0.25]).first()["q"] == [pytest.approx(1.75)]


def test_qcut_right_closed_with_ties(spark):  # T9
    vals = [1.0, 1.0, 1.0, 1.0, 2.0, 3.0, 4.0, 5.0]
    d = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, x double")
    b = errors.quantile_bins(d, "x", 4, label=None)
    got = {r["id"]: r["bin"] for r in b.collect()}
    # pandas: edges [1, 1, 1.75, 3.25, 5] -> unique [1, 1.75, 3.25, 5]
    assert [got[i] for i in range(8)] == [1, 1, 1, 1, 2, 2, 3, 3]


def test_histogram_left_closed_last_closed(spark):  # T10
    d = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (2.0,)], "x double")
    h = {r["bin"]: r["count"] for r in profile.histogram(d, "x", 2).collect()}
    assert h == {0: 1, 1: 3}  # [0,1) and [1,2]


def test_population_std_scaler(spark):  # T11
    from hearth.operators.encode import PopulationScaler
    d = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    out = [r[0] for r in PopulationScaler(inputCols=["x"]).fit(d).transform(d).collect()]
    assert out == [-1.0, 1.0]


def test_one_hot_unknown_is_zero(spark):  # T12
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    from hearth.operators.encode import one_hot_all
    tr = spark.createDataFrame([("a",), ("b",)], "c string")
    te = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    m = Pipeline(stages=one_hot_all(["c"])).fit(tr)
    got = [list(r[0]) for r in m.transform(te).select(vector_to_array("c_ohe")).collect()]
    assert got == [[1.0, 0.0], [0.0, 0.0], [0.0, 0.0]]


def test_ridge_matches_closed_form(spark):  # T13
    import numpy as np
    from pyspark.ml.feature import VectorAssembler
    from hearth.operators.models import Ridge
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3))
    y = x @ np.array([1.0, -2.0, 0.5]) + 3 + rng.normal(scale=0.1, size=200)
    d = spark.createDataFrame([tuple(map(float, r)) + (float(t),) for r, t in zip(x, y)],
                              "a double, b double, c double, label double")
    v = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(d)
    m = Ridge(alpha=12.0).fit(v)
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + 12.0 * np.eye(3), xc.T @ yc)
    assert np.allclose(m.coefficients.toArray(), w, atol=1e-9)
    assert m.intercept == pytest.approx(y.mean() - x.mean(0) @ w, abs=1e-9)


def test_error_frame_joins_by_key(spark):  # T14
    p = spark.createDataFrame([(2, math.log1p(110.0)), (1, math.log1p(90.0))],
                              "id int, pred_log double")
    t = spark.createDataFrame([(1, 100.0), (2, 100.0)], "id int, price double")
    e = {r["id"]: r["residual_raw"] for r in errors.error_frame(p, t, "id", "price").collect()}
    assert e[1] == pytest.approx(-10.0) and e[2] == pytest.approx(10.0)
    bad = spark.createDataFrame([(3, 1.0)], "id int, pred_log double")
    with pytest.raises(ValueError):
        errors.error_frame(bad, t, "id", "price", check_keys=True)


def test_md5_folds_match_sql(spark):  # T15
    import duckdb
    from hearth.plans.sqlparts import fold_sql
    d = spark.range(200).withColumn("f", X.hash_bucket("id", 42, 5))
    got = {r["id"]: r["f"] for r in d.collect()}
    con = duckdb.connect()
    want = dict(con.execute(f"SELECT range AS id, {fold_sql('range')} FROM range(200)").fetchall())
    assert got == want


def test_cross_category_nan(spark):  # T16
    d = spark.createDataFrame([("A", 5), (None, 7), ("B", None)], "Neighborhood string, q int")
    got = [r[0] for r in d.select(features.cross_category("Neighborhood", "q")).collect()]
    assert got == ["A_5", "nan_7", "B_nan"]


def test_fingerprint_order_independent(spark):  # T17
    from hearth.operators.registry import fingerprint
    d = spark.createDataFrame([(i, f"v{i}") for i in range(50)], "id int, v string")
    a = fingerprint(d, "id").first()
    b = fingerprint(d.orderBy(F.desc("id")).repartition(7), "id").first()
    assert (a["head_md5"], a["table_hash"]) == (b["head_md5"], b["table_hash"])


def test_all_null_and_constant_columns(spark):
    d = spark.createDataFrame([(None, 1.0), (None, 1.0), (None, 1.0)], "a double, b double")
    p = drift.psi(d, d, ["a", "b"], 10, "floor")
    assert {r["feature"]: r["psi"] for r in p.collect()} == {"a": None, "b": None}


def test_negative_under_log(spark):
    d = spark.createDataFrame([(-5.0,), (0.0,), (None,), (1.0,)],
                              "x double")
    got = [r[0] for r in d.select(X.log1p0("x")).collect()]
    assert got[:3] == [0.0, 0.0, None] and got[3] == pytest.approx(math.log(2.0))


def test_single_row_statistics(spark):
    d = spark.createDataFrame([(1, 5.0, "a")], "id int, x double, c string")
    nd = drift.numeric_drift(d, d, ["x"]).first()
    assert nd["ref_std"] == 0.0 and nd["drift_score"] == 0.0
    assert errors.quantile_bins(d, "x", 10, label=None).first()["bin"] == 1


def test_level_on_one_side_only(spark):
    ref = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    cur = spark.createDataFrame([("a",), ("z",), ("z",), (None,)], "c string")
    r = drift.categorical_drift(ref, cur, ["c"], 10).first()
    assert r["unknown_rate"] == pytest.approx(0.5)  # 2 of 4 current rows, NULL included
    shift = {x["category"]: x["shift"] for x in drift.category_shift(ref, cur, "c", 10).collect()}
    assert shift["z"] == 50.0 and shift["b"] == 25.0 and shift[None] == 0.0


def test_quantile_edge_ties_psi(spark):
    # heavily tied column: floor PSI falls back to distinct values
    ref = spark.createDataFrame([(float(v),) for v in [1] * 80 + [2] * 10 + [3] * 10], "x double")
    cur = spark.createDataFrame([(float(v),) for v in [1] * 50 + [2] * 25 + [3] * 25], "x double")
    p = drift.psi(ref, cur, ["x"], 10, "floor").first()["psi"]
    assert p is not None and p > 0
