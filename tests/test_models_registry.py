"""Model artifacts, contracts, gates and save/load consistency, modelled on
the reference's own unit tests (artifact, golden contract, performance gate,
prediction consistency for linear and tree models, registry artifact)."""

import math
import os
import tempfile

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from hearth.operators import contract, models, search
from hearth.operators.folds import holdout_split
from hearth.plans.q_models import model_frame, pipe
from hearth.sources import io

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def frame(spark):
    return model_frame(spark, SF).cache()


def _root():
    return tempfile.mkdtemp(prefix="hearth-test-", dir="/tmp")


def test_train_run_artifact(spark, frame):
    root = _root()
    rec = search.train_run(spark, frame, pipe(frame, lambda: models.ridge(12.0)), "ridge", "id",
                           "label", 3, 42, root, "2025-01-01_000000", list(frame.columns))
    r = rec.first()
    assert os.path.isdir(r["artifact"]) and len(r["fold_rmse"]) == 3
    m = io.load_model(r["artifact"])
    p = m.transform(frame.limit(20)).select("prediction").collect()
    assert len(p) == 20 and all(math.isfinite(x[0]) for x in p)
    runs = spark.read.parquet(os.path.join(root, "runs"))
    assert runs.count() == 1


def test_golden_contract_passes_on_same_model(spark, frame):
    m = pipe(frame, lambda: models.ridge(12.0))().fit(frame)
    gold = contract.pick_golden_rows(frame, "id", 12, 42)
    preds = m.transform(gold).select("id", F.col("prediction").alias("pred"))
    bounds = contract.contract_bounds(preds, "pred", "ridge")
    rescored = m.transform(gold).select("id", "prediction")
    _rows, summary = contract.check_contract(bounds, rescored, "id", "prediction")
    s = summary.first()
    assert s["rows"] == 12 and s["pass_rate"] == 1.0 and s["verdict"] == "pass"


def test_performance_gate(spark):
    from hearth.sources.bindings import sales
    d = sales(spark, SF).select("id", "price", "qty", "ext", "quality", "segment", "status")
    r = search.perf_baseline(spark, d, "id", "price", 3, 42, 10.0).first()
    base = spark.createDataFrame([("m", r["rmse"])], "model string, rmse double")
    new = spark.createDataFrame([("m", r["rmse"] + 0.005)], "model string, rmse double")
    assert contract.rmse_gate(new, base, tolerance=0.01).first()["passed"]
    worse = spark.createDataFrame([("m", r["rmse"] + 0.02)], "model string, rmse double")
    assert not contract.rmse_gate(worse, base, tolerance=0.01).first()["passed"]


@pytest.mark.parametrize("kind,tol", [("linear", 1e-12), ("trees", 1e-6)])
def test_save_load_consistency(spark, frame, kind, tol):
    est = (lambda: models.ridge(12.0)) if kind == "linear" else \
        (lambda: models.extra_trees(5, max_depth=4))
    m = pipe(frame, est, kind == "linear")().fit(frame)
    path = io.save_model(m, _root(), kind, "2025-01-01_000000")
    loaded = io.load_model(path)
    r = contract.reload_consistency(m.transform(frame), loaded.transform(frame), "id",
                                    "prediction", tol).first()
    assert r["consistent"] and r["rows"] == frame.count()


def test_voting_and_stacking_fit(spark, frame):
    from hearth.operators.folds import assign_folds
    d = assign_folds(frame, "id", 3, 42)
    tr, ho = holdout_split(d, "id", 0.2, 42)
    v = models.VotingMean([pipe(d, lambda: models.ridge(6.0)),
                           pipe(d, lambda: models.boosted_depth(5, step=0.1), False)]).fit(tr)
    assert v.transform(ho).filter(F.col("prediction").isNull()).count() == 0
    s = models.Stacking([pipe(d, lambda: models.ridge(12.0))], "id", "fold", 3).fit(tr)
    out = s.transform(ho)
    assert out.count() == ho.count() and "prediction" in out.columns
    loaded = {}
    for name, model in (("voting", v), ("stacking", s)):
        for _ in range(2):  # the second time over the first
            path = io.save_model(model, _root(), name, "2025-01-01_000000")
        loaded[name] = io.load_model(path)
        assert type(loaded[name]) is type(model) and loaded[name].uid == model.uid
        r = contract.reload_consistency(model.transform(ho), loaded[name].transform(ho), "id", "prediction", 1e-9).first()
        assert r["consistent"] and r["rows"] == ho.count()
    assert len(loaded["voting"].members) == 2
    assert loaded["stacking"].folds == {"id_col": "id", "fold_col": "fold", "k": 3, "meta_alpha": 1.0} and loaded["stacking"].base_cols == s.base_cols


def test_early_stopping_iterations(spark, frame):
    from hearth.operators.folds import assign_folds
    from hearth.plans.q_models import prep
    d = assign_folds(frame, "id", 3, 42)
    x = Pipeline(stages=prep(d, False)).fit(d).transform(d)
    per = models.early_stopping_cv(x, lambda: models.boosted_depth(20, step=0.3), "fold", 3)
    assert per.count() == 3
    assert all(1 <= r["best_iteration"] <= 20 for r in per.collect())


def test_early_stopping_by_rounds(spark, frame):
    from hearth.operators.folds import assign_folds
    from hearth.plans.q_models import prep
    assert models.best_round([3.0, 2.0, 2.5, 1.0, 1.2, 1.1, 0.5], 2) == 4
    assert models.best_round([3.0, 2.0, 2.5, 2.4, 0.1], 2) == 2 and models.best_round([1.0], 5) == 1
    d = assign_folds(frame, "id", 2, 42)
    x = Pipeline(stages=prep(d, False)).fit(d).transform(d)
    rows = models.early_stopping_cv(x, lambda: models.boosted_depth(6, step=0.3), "fold", 2, rounds=3).collect()
    assert [r["fold"] for r in rows] == [0, 1] and all(1 <= r["best_iteration"] <= 6 and r["rmse"] > 0 for r in rows)


def test_score_requests(spark):
    """Runs with different features, every kind of request, clashing column names, NULL keys, repeated rows, no rows."""
    from hearth.operators import registry, score
    from hearth.plans.q_models import one_feature
    train = spark.range(200).select((F.col("id") % 17).cast("double").alias("x"), (F.col("id") % 23).cast("double").alias("z"),
                                    (F.col("id") % 17 * 0.5 + 1).alias("label"))
    root, fitted, recs = _root(), {}, []
    for family, run, col in (("a", "2025-01-01_000000", "x"), ("b", "2025-01-02_000000", "z")):
        fitted[family] = one_feature(1.0, col)().fit(train)
        recs.append((family, run, 0.2, [col], io.save_model(fitted[family], root, family, run)))
    runs = spark.createDataFrame(recs, "model string, run_id string, cv_rmse double, features array<string>, artifact string").withColumn("ts", registry.run_ts(F.col("run_id")))
    aliases = spark.createDataFrame([("global", "b", "best", "2025-01-02_000000", 0.2), ("family", "a", "latest", "2025-01-01_000000", 0.2),
                                     ("family", "a", "staging", "2024-01-01_000000", 0.2)],
                                    "scope string, model string, alias string, run_id string, cv_rmse double")
    asks = ["global/best", "a/latest", "a/2025-01-01_000000", "a/staging", "a/best", "b/none", "bad", None]
    rows = [(i, float(i), float(-i), asks[i % 8], "r", "s", "k", 7) for i in range(40)] + [(None, 1.0, 2.0, "a/latest", "r", "s", "k", 7)] * 3
    df = spark.createDataFrame(rows, "id int, x double, z double, ask string, _row string, status string, _key string, _run int")
    told, lineage = score.score_requests(df, "id", "ask", runs, aliases)
    got = told.collect()
    assert len(got) == 43 and sum(r["id"] is None for r in got) == 3
    want = {f: {r["id"]: r["prediction"] for r in m.transform(df.filter("id is not null")).collect()} for f, m in fitted.items()}
    status = {"global/best": "ok", "a/latest": "ok", "a/2025-01-01_000000": "ok", "a/staging": "no_artifact", "a/best": "unset", "b/none": "unknown_run", "bad": "malformed", None: "malformed"}
    for r in got:
        ask = r["requested_model_id"]
        assert r["status"] == status[ask]
        if r["status"] != "ok":
            assert r["pred_log"] is None and r["model_id"] is None
        elif r["id"] is not None:
            family = "b" if ask == "global/best" else "a"
            assert r["model_id"].startswith(family + "/") and abs(r["pred_log"] - want[family][r["id"]]) < 1e-12
    line = {r["requested_model_id"]: r for r in lineage.collect()}
    assert set(line) == set(asks) and line["a/latest"]["input_rows"] == 8 and line["a/staging"]["resolved_model_id"] is None
    one = registry.fingerprint(df.filter("ask = 'global/best'"), "id").first()
    assert (line["global/best"]["input_table_hash"], line["global/best"]["input_head_md5"]) == (one["table_hash"], one["head_md5"])
    told, lineage = score.score_requests(df.limit(0), "id", "ask", runs, aliases)
    assert told.count() == 0 and lineage.count() == 0 and told.columns == ["id", "requested_model_id", "model_id", "pred_price", "pred_log", "status"]
