"""Frames that many passes read are written once: no pass joins or aggregates its input again."""

from conftest import SF_SMALL
from pyspark.sql import functions as F


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def joined(spark):
    left = spark.range(60).select("id", (F.col("id") % 7).cast("double").alias("x"))
    right = spark.range(60).select("id", F.log1p(F.col("id") * 3 + 1).alias("label"))
    return left.hint("merge").join(right, "id")


def test_training_frame_is_written(spark):
    from hearth.plans.q_models import model_frame
    assert "Join" not in plan(model_frame(spark, SF_SMALL))


def test_projection_input_is_written(spark):
    from hearth.operators import cluster
    df = joined(spark)
    assert "Join" in plan(df)
    vectors = cluster._vectors(df, ["x", "label"], "id")
    assert "Join" not in plan(vectors) and vectors.count() == 60


def test_training_job_reads_its_input_once(spark, tmp_path, monkeypatch):
    from hearth.operators import registry, search
    from hearth.plans.q_models import one_feature
    seen = []
    whole, fits = registry.fingerprint, search.oof_predict

    def fingerprint(df, *rest):
        seen.append(plan(df))
        return whole(df, *rest)

    def predict(df, *rest, **named):
        seen.append(plan(df))
        return fits(df, *rest, **named)

    monkeypatch.setattr(registry, "fingerprint", fingerprint)
    monkeypatch.setattr(search, "oof_predict", predict)
    df = joined(spark)
    rec = search.train_run(spark, df, one_feature(1.0), "ridge", "id", "label", 3, 42, str(tmp_path), "2025-06-01_120000", ["x"]).first()
    assert len(seen) == 2 and not any("Join" in p for p in seen)
    assert (rec["rows"], rec["table_hash"]) == (60, whole(df, "id").first()["table_hash"])
