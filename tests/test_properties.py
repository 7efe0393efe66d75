"""Invariants: folds partition the keys, blends are convex, PSI of a
distribution with itself is 0, Johnson inverse undoes the transform,
stratified allocation sums to n, results do not depend on partitioning."""

import math

import pytest
from pyspark.sql import functions as F

from hearth.operators import dist, drift, folds, models, score
from hearth.operators.profile import spearman
from hearth.session import cut_lineage as cut
from hearth.operators.ranks import edges_of, number, with_average_rank, with_buckets
from hearth.session import cut_lineage
from hearth.sources.bindings import events_split, sales

SF = "/root/testdata/sf0.001"


def test_each_id_in_one_fold(spark):
    d = folds.assign_folds(spark.range(1000), "id", 5, 42)
    g = d.groupBy("id").agg(F.countDistinct("fold").alias("n"))
    assert g.filter("n != 1").count() == 0
    assert {r[0] for r in d.select("fold").distinct().collect()} == set(range(5))


def test_balanced_folds_sizes(spark):
    d = folds.assign_balanced_folds(spark.range(1003).repartition(4), "id", 5, 42)
    sizes = sorted(r[1] for r in d.groupBy("fold").count().collect())
    assert sizes[-1] - sizes[0] <= 1 and sum(sizes) == 1003


def test_blend_weights_are_convex(spark):
    p = spark.createDataFrame([("a", 1, 10.0), ("b", 1, 12.0), ("c", 1, 14.0)],
                              "model string, id int, pred_log double")
    m = spark.createDataFrame([("a", 0.1), ("b", 0.2)], "model string, rmse double")
    v = models.blend_weighted(p, m).first()["pred_log"]
    w = [10.0, 5.0, 1.0]
    assert v == pytest.approx((10 * 10 + 12 * 5 + 14 * 1) / sum(w))
    assert 10.0 <= v <= 14.0


def test_psi_self_is_zero(spark):
    ref, _cur = events_split(spark, SF)
    for smoothing in ("additive", "floor"):
        p = drift.psi(ref, ref, ["value", "user_id"], 10, smoothing).collect()
        assert all(abs(r["psi"]) < 1e-12 for r in p)


def test_johnson_roundtrip(spark):
    d = spark.range(100).select((F.col("id") * 1.7 - 20).alias("x"))
    t = dist.johnson_transform(F.col("x"), -1.5, 1.2, 3.0, 2.0)
    back = dist.johnson_inverse(t, -1.5, 1.2, 3.0, 2.0)
    assert d.select(F.max(F.abs(back - F.col("x")))).first()[0] < 1e-9


def test_johnson_su_recovers_parameters(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    z = rng.normal(size=200_000)
    x = 3 + 2 * np.sinh((z + 1.5) / 1.2)  # gamma=-1.5, eta=1.2, eps=3, lambda=2
    d = spark.createDataFrame([(float(v),) for v in x], "x double")
    r = dist.fit_johnson_su(d, "x").first()
    assert r["family"] == "johnson_su"
    assert r["gamma"] == pytest.approx(-1.5, abs=0.1)
    assert r["eta"] == pytest.approx(1.2, abs=0.1)


def test_stratified_sample_size(spark):
    s = sales(spark, SF)
    n_rows = s.filter("price is not null").count()
    out = folds.stratified_sample(s, "id", "price", 120, 10, 42)
    assert out.count() == min(120, n_rows)
    assert out.select("id").distinct().count() == out.count()


def test_partition_invariance(spark):
    s = sales(spark, SF).select("id", "price", "qty")
    a = spearman(s.repartition(1), ["qty"], "price").first()["spearman"]
    b = spearman(s.repartition(13), ["qty"], "price").first()["spearman"]
    assert a == pytest.approx(b, abs=1e-12)
    pa = score.percentile_rank(s.repartition(1), "price", s.select("id", "price"), "price")
    pb = score.percentile_rank(s.repartition(13), "price", s.select("id", "price"), "price")
    ra = {r["id"]: r["pct_rank"] for r in pa.collect()}
    rb = {r["id"]: r["pct_rank"] for r in pb.collect()}
    assert ra == pytest.approx(rb)


@pytest.mark.parametrize("edges", [1, 4, 50])
def test_average_rank_hot_value(spark, edges):
    # one value holds a third of the rows; others are tied or alone, infinite or negative zero
    vals = [5.0] * 60 + [float(i % 37) for i in range(100)] + [0.1 * i for i in range(20)] + [float("inf"), float("-inf"), -0.0, 0.0]
    d = spark.createDataFrame([(f, v) for f in "fg" for v in vals if f == "f" or v < 9], "feature string, x double").repartition(5)
    d = d.withColumn("x", number("x"))
    got = with_average_rank(with_buckets(d, edges_of(d, ["x"], edges)), ["feature"], "x", "_bx", "rank").collect()
    for f in "fg":
        s = sorted(v for v in vals if f == "f" or v < 9)
        want = {v: sum(i + 1 for i, t in enumerate(s) if t == v) / s.count(v) for v in set(s)}
        mine = [r for r in got if r["feature"] == f]
        assert len(mine) == len(s) and all(r["rank"] == want[r["x"]] for r in mine)


def test_percentile_rank_of_odd_probes(spark):
    ref = spark.createDataFrame([(v,) for v in [1.0, 2.0, 2.0, 2.0, 3.0, None, float("nan")]], "v double")
    probes = spark.createDataFrame([(i, v) for i, v in enumerate([0.0, 1.0, 2.0, 2.5, 3.0, 9.0, None, 2.0])], "id int, p double")
    got = {r["id"]: r["pct_rank"] for r in score.percentile_rank(ref, "v", probes, "p").collect()}
    assert got == {0: 0.0, 1: 0.0, 2: 20.0, 3: 80.0, 4: 80.0, 5: 100.0, 6: None, 7: 20.0}


def _percentiles(df, col, probs, by):
    good = df.filter(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double")))
    rows = good.groupBy(*by).agg(F.percentile(col, F.array(*[F.lit(p) for p in probs]))).collect()
    return {tuple(r[:-1]): r[-1] for r in rows}


def test_quantiles_equal_spark_percentile(spark):
    from hearth.operators.quantiles import exact_quantiles
    s = sales(spark, SF)
    probs = [0.0, 0.05, 0.1, 0.25, 0.333, 0.5, 0.9, 1.0]
    for col, by in (("price", []), ("acctbal", []), ("qty", ["nbhd"]), ("price", ["nbhd", "segment"])):
        got = {tuple(r[:-1]): r[-1] for r in exact_quantiles(s, col, probs, by).collect() if r[-1] is not None}
        assert got == _percentiles(s, col, probs, by)


def test_quantiles_on_tied_null_and_skewed_groups(spark):
    from hearth.operators.quantiles import exact_quantiles
    # a null group, a hot group with ties, groups of one and two rows, NaN, infinities, no values
    d = spark.range(60_000, numPartitions=7).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit("hot"))
        .otherwise(F.concat(F.lit("g"), (F.col("id") % 4001).cast("string"))).alias("g"),
        F.when(F.col("id") % 10 == 0, F.lit(None)).when(F.col("id") % 10 < 6, F.lit(5.0))
        .when(F.col("id") == 11, F.lit(float("nan"))).when(F.col("id") == 17, F.lit(float("inf")))
        .otherwise(F.rand(3) * 1000).alias("x"))
    d = d.unionByName(spark.createDataFrame([("none", None), ("one", 1.0), ("two", 1.0), ("two", 4.0)], "g string, x double"))
    d = cut_lineage(d)
    probs = [0.0, 0.001, 0.25, 0.5, 0.777, 0.999, 1.0]
    for by in ([], ["g"]):
        got = {tuple(r[:-1]): r[-1] for r in exact_quantiles(d, "x", probs, by).collect()}
        want = _percentiles(d, "x", probs, by)
        assert {k: v for k, v in got.items() if v is not None} == want
        assert by == [] or got[("none",)] is None


def test_group_medians_over_many_levels(spark, tmp_path):
    from hearth.operators.impute import GroupMedianImputer, GroupMedianImputerModel
    d = spark.range(300_000, numPartitions=8).select(
        (F.col("id") % 120_000).cast("string").alias("level"), F.when(F.col("id") >= 240_000, F.lit(None)).otherwise(F.col("id") % 7).alias("v"))
    model = GroupMedianImputer(inputCol="v", groupCol="level").fit(d)
    model.write().overwrite().save(str(tmp_path / "m"))
    back = GroupMedianImputerModel.load(str(tmp_path / "m"))
    assert back.medians().count() == 120_000
    want = d.filter("v is not null").groupBy("level").agg(F.percentile("v", F.lit(0.5)).alias("m"))
    filled = back.transform(d.filter("v is null")).join(want, "level")
    assert filled.count() == 60_000 and filled.filter("v <> m").count() == 0


def test_medians_of_integers_stay_fractional(spark):
    from hearth.operators.impute import MedianImputer, apply_defaults
    d = spark.createDataFrame([(1,), (2,), (None,)], "a bigint")
    assert sorted(r["a"] for r in MedianImputer(inputCols=["a"]).fit(d).transform(d).collect()) == [1.0, 1.5, 2.0]
    assert sorted(r["a"] for r in apply_defaults(d, {"a": "1.5"}).collect()) == [1.0, 1.5, 2.0]


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_dense_index_and_balanced_folds_keep_every_row(spark, coalesce):
    n = 1_000_000
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
        d = spark.range(n, numPartitions=11).withColumn("payload", F.md5(F.col("id").cast("string")))
        i = cut_lineage(folds.dense_index(d, folds.hash_key("id", 7), ["id"], "i"))
        r = i.agg(F.count("*").alias("n"), F.countDistinct("i").alias("d"), F.min("i").alias("lo"), F.max("i").alias("hi"),
                  F.countDistinct("id").alias("ids"), F.sum((F.md5(F.col("id").cast("string")) != F.col("payload")).cast("int")).alias("bad")).first()
        assert tuple(r) == (n, n, 0, n - 1, n, 0)
        sizes = [r["count"] for r in folds.assign_balanced_folds(d, "id", 7, 42).groupBy("fold").count().collect()]
        assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_table_hash_counts_repeated_rows(spark):
    from hearth.operators.registry import fingerprint
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "id int, v string")
    b = spark.createDataFrame([(1, "x"), (3, "z"), (3, "z")], "id int, v string")
    assert fingerprint(a, "id").first()["table_hash"] != fingerprint(b, "id").first()["table_hash"]


def test_contract_verdict_variants(spark):
    from hearth.operators.contract import verdict
    d = spark.createDataFrame([(0.7,), (0.71,), (1.0,)], "r double")
    got = d.select(verdict(F.col("r"), 0.7), verdict(F.col("r"), 0.7, strict=True)).collect()
    assert [tuple(r) for r in got] == [("partial", "fail"), ("partial", "partial"), ("pass", "pass")]


def test_typicality_without_usable_input(spark):
    prof = spark.createDataFrame([("a", 1.0, 2.0, 3.0, 2.0)], "feature string, p05 double, p50 double, p95 double, iqr double")
    d = spark.createDataFrame([(1, None), (2, 9.0), (3, 2.0)], "id int, a double")
    got = {r["id"]: [(x["feature"], x["side"], x["bound"]) for x in r["reasons"]] for r in score.typicality_score(d, prof, ["a"], "id").collect()}
    assert got == {1: [(None, "no usable input", None)], 2: [("a", "over p95", 3.0)], 3: []}


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace as N
    from hearth.session import checkpoint_dir
    conf = N(get=lambda key, default=None: default)
    far = N(conf=conf, sparkContext=N(master="spark://host:7077", getConf=lambda: conf, getCheckpointDir=lambda: None))
    with pytest.raises(ValueError):
        checkpoint_dir(far)


def test_later_reads_take_only_their_columns(spark):
    from hearth.sources.bindings import sales_split
    ref, _cur = sales_split(spark, SF)
    plan = ref.select("price")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<price:double,yr_built:bigint>" in plan


def test_event_split_independent_of_session_zone(spark):
    before = [d.count() for d in events_split(spark, SF)]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        after = [d.count() for d in events_split(spark, SF)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert before == after


def test_quantiles_narrow_until_bounded(spark, monkeypatch):
    from hearth.operators import quantiles
    # 150,000 different values, a hot tie right at the median, a null group, two columns, many positions
    d = spark.range(300_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 5 == 0, F.lit(0.5)).otherwise(F.rand(7)).alias("x"), (F.col("id") * 7919 % 299_993).cast("double").alias("y"))
    d = cut(d)
    probs = [0.0, 0.001, 0.25, 0.4999, 0.5, 0.75, 0.75, 0.999, 1.0]
    want = {}
    for col in ("x", "y"):
        for by in ([], ["g"]):
            want[col, tuple(by)] = _percentiles(d, col, probs, by)
    sizes = []
    ranked = quantiles._ranked

    def seen(cells, by, *order):
        if order == ("place", "x"):
            sizes.append(cells.filter("open").groupBy(*by, "i", "place").count().agg(F.max("count")).first()[0] or 0)
        return ranked(cells, by, *order)

    monkeypatch.setattr(quantiles, "MOST", 40)
    monkeypatch.setattr(quantiles, "_ranked", seen)
    for by in ([], ["g"]):
        got = quantiles.with_quantiles(d, by, [F.count(F.lit(1)).alias("n")], [("x", probs, "qx"), ("y", probs, "qy")]).collect()
        assert {tuple(r[k] for k in by): r["qx"] for r in got} == want["x", tuple(by)]
        assert {tuple(r[k] for k in by): r["qy"] for r in got} == want["y", tuple(by)]
        assert sizes[-1] <= 40 < max(sizes)  # the last step, and the first look before narrowing


def test_quantiles_widen_a_bracket_that_missed(spark, monkeypatch):
    from hearth.operators import quantiles
    d = cut(spark.range(50_000).select(F.rand(5).alias("x")))
    monkeypatch.setattr(quantiles, "MOST", 5)
    monkeypatch.setattr(quantiles, "SKETCH_ACCURACY", 20)
    real = quantiles._found
    tries = []
    monkeypatch.setattr(quantiles, "_found", lambda *a: tries.append(1) or real(*a))
    monkeypatch.setattr(quantiles, "BRACKET", 0.001)
    assert quantiles.exact_quantiles(d, "x", [0.3, 0.5]).first()["q"] == _percentiles(d, "x", [0.3, 0.5], [])[()]
    assert len(tries) > 2


@pytest.mark.parametrize("levels", [1, 2])
def test_ranks_by_edges_of_edges(spark, monkeypatch, levels):
    from hearth.operators import ranks
    monkeypatch.setattr(ranks, "MOST_EDGES", 7)
    d = cut(spark.range(30_000, numPartitions=5).select(
        F.when(F.col("id") % 2 == 0, "f").otherwise("g").alias("feature"),
        number(F.when(F.col("id") % 6 < 2, F.lit(0.25)).when(F.col("id") % 6 == 3, F.round(F.rand(3), 2)).otherwise(F.rand(4))).alias("x")))
    got = with_average_rank(with_buckets(d, edges_of(d, ["x"], 7)), ["feature"], "x", "_bx", "rank", levels)
    import pandas as pd
    want = d.toPandas()
    want["rank"] = want.groupby("feature")["x"].rank()
    both = pd.concat([f.sort_values(["feature", "x"])[["feature", "x", "rank"]].reset_index(drop=True) for f in (want, got.toPandas())], axis=1)
    assert len(both) == 30_000 and (both.iloc[:, :3].to_numpy() == both.iloc[:, 3:].to_numpy()).all()


def test_rank_tasks_follow_the_rows(spark, monkeypatch):
    # a task sorts a bounded number of rows, once, however many rows there are
    from hearth.operators import ranks
    monkeypatch.setattr(ranks, "TASK_ROWS", 1_000, raising=False)
    real, tasks, sorts = ranks.with_places, [], []

    def watched(*args):
        placed = real(*args)
        tasks.append(placed.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first())
        plan = placed._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
        sorts.append(sum("Sort [" in line and f"{args[2]}#" in line for line in plan.splitlines()))
        return placed

    monkeypatch.setattr(ranks, "with_places", watched)
    monkeypatch.setattr(score, "with_places", watched)
    d = cut(spark.range(40_000, numPartitions=5).select("id", F.rand(1).alias("a"), F.when(F.col("id") % 7 > 0, F.rand(2)).alias("b"), F.rand(3).alias("y")))
    got = {r["feature"]: r for r in spearman(d, ["a", "b"], "y").collect()}
    want = d.toPandas().corr("spearman")["y"]
    assert all(got[c]["spearman"] == pytest.approx(want[c], abs=1e-12) for c in "ab") and got["b"]["n"] == 34_285
    ranked = score.percentile_rank(d, "y", d, "y")
    assert ranked.agg(F.countDistinct("pct_rank")).first()[0] == 40_000
    assert len(tasks) == 5 and all(total > 30_000 and 8 * most < total for most, total in tasks), tasks  # more than the session's 8 partitions
    assert sorts == [1] * 5


def test_average_rank_of_infinite_ties_in_a_bucket(spark):
    vals = [math.inf, math.inf, -math.inf, -math.inf, 0.0, -0.0, 1.5, 1.5, 1.5, 2.0]
    d = spark.createDataFrame([(v,) for v in vals], "x double").select(number("x").alias("x"), F.lit(0).alias("_bx"))
    got = sorted((r["x"], r["rank"]) for r in with_average_rank(d, [], "x", "_bx", "rank", count=len(vals)).collect())
    assert [r for _, r in got] == [1.5, 1.5, 3.5, 3.5, 6.0, 6.0, 6.0, 8.0, 9.5, 9.5]


def test_rank_levels_bound_buckets():
    from hearth.operators.ranks import MOST_EDGES, MOST_ROWS, edge_count, levels_for
    for rows in (0, 1, 10**5, 10**7, 10**9, 10**10, 10**11, 10**13):
        held = 1.2 * rows / (edge_count(rows) + 1)
        for _ in range(levels_for(rows)):
            held = 1.2 * held / (MOST_EDGES + 1)
        assert held <= MOST_ROWS


def test_halving_search(spark):
    from hearth.functions.exprs import at_or_below
    edges = [-3.0, 0.0, 0.5, 0.5, 9.0]
    d = spark.createDataFrame([(v,) for v in (-4.0, -3.0, 0.2, 0.5, 8.0, 9.0, 10.0, None)], "v double")
    e = F.array(*map(F.lit, edges))
    got = d.select("v", at_or_below(e, F.col("v")).alias("a"), at_or_below(e, F.col("v"), strict=True).alias("b")).collect()
    for r in got:
        want = (None, None) if r["v"] is None else (sum(x <= r["v"] for x in edges), sum(x < r["v"] for x in edges))
        assert (r["a"], r["b"]) == want
