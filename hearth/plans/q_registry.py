"""Registry plans (H1-H10) over run records derived from ``part``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.functions.exprs import rnd
from hearth.operators.impute import medians
from hearth.operators import registry as reg
from hearth.plans.registry import query
from hearth.plans.sqlparts import RUNS_CTE, SALES_CTE
from hearth.sources.bindings import runs as runs_binding
from hearth.sources.bindings import sales, table

R = f"""WITH {RUNS_CTE.strip()},
runs2 AS (SELECT *, try_strptime(run_id, '%Y-%m-%d_%H%M%S') AS ts FROM runs)"""
PAT = r"^\d{4}-\d{2}-\d{2}_\d{6}$"


def runs_ts(spark, sf) -> DataFrame:
    return reg.register_run(runs_binding(spark, sf))


def alias_events(runs: DataFrame) -> DataFrame:
    """Alias history derived from the runs: every well-formed run moved
    'latest'; runs with size % 5 == 0 were promoted to 'production'; the
    family and global best/latest are recorded as events too."""
    ok = runs.filter(F.col("run_id").rlike(reg.RUN_ID_PATTERN))
    latest = ok.select(F.lit("family").alias("scope"), "model", F.lit("latest").alias("alias"),
                       "run_id", "cv_rmse", "ts")
    prod = ok.filter(F.col("size") % 5 == 0).select(
        F.lit("family").alias("scope"), "model", F.lit("production").alias("alias"), "run_id",
        "cv_rmse", "ts")
    best = reg.family_best(runs).join(runs.select("model", "run_id", "ts"), ["model", "run_id"])
    best = best.select(F.lit("family").alias("scope"), "model", F.lit("best").alias("alias"),
                       "run_id", "cv_rmse", "ts")
    gb = reg.global_best(runs).join(runs.select("model", "run_id", "ts"), ["model", "run_id"])
    gl = reg.global_latest(runs).join(runs.select("model", "run_id", "ts"), ["model", "run_id"])
    g = gb.select(F.lit("global").alias("scope"), "model", F.lit("best").alias("alias"),
                  "run_id", "cv_rmse", "ts").unionByName(
        gl.select(F.lit("global").alias("scope"), "model", F.lit("latest").alias("alias"),
                  "run_id", "cv_rmse", "ts"))
    return latest.unionByName(prod).unionByName(best).unionByName(g)


ALIAS_SQL = f"""{R},
ok AS (SELECT * FROM runs2 WHERE regexp_matches(run_id, '{PAT}')),
fb AS (SELECT model, run_id, cv_rmse, ts FROM (
         SELECT *, row_number() OVER (PARTITION BY model ORDER BY cv_rmse, ts NULLS FIRST, run_id) AS rn
         FROM runs2 WHERE cv_rmse IS NOT NULL AND NOT isnan(cv_rmse)) WHERE rn = 1),
gb AS (SELECT model, run_id, cv_rmse, ts FROM runs2 WHERE cv_rmse IS NOT NULL
       ORDER BY cv_rmse, ts NULLS FIRST, model, run_id LIMIT 1),
gl AS (SELECT model, run_id, cv_rmse, ts FROM runs2 WHERE ts IS NOT NULL
       ORDER BY ts DESC, model DESC, run_id DESC LIMIT 1),
ev AS (
  SELECT 'family' AS scope, model, 'latest' AS alias, run_id, cv_rmse, ts FROM ok
  UNION ALL SELECT 'family', model, 'production', run_id, cv_rmse, ts FROM ok WHERE size % 5 = 0
  UNION ALL SELECT 'family', model, 'best', run_id, cv_rmse, ts FROM fb
  UNION ALL SELECT 'global', model, 'best', run_id, cv_rmse, ts FROM gb
  UNION ALL SELECT 'global', model, 'latest', run_id, cv_rmse, ts FROM gl),
cur AS (SELECT scope, model, alias, run_id, cv_rmse FROM (
          SELECT *, row_number() OVER (PARTITION BY scope, model, alias
                                       ORDER BY ts DESC NULLS LAST, run_id DESC) AS rn FROM ev)
        WHERE rn = 1)"""


@query("h1_register_run", f"""{R}
SELECT model, run_id, cv_rmse, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM runs2
""")
def _h1(spark, sf):
    r = runs_ts(spark, sf)
    return r.select("model", "run_id", "cv_rmse",
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


@query("h2_fingerprint", """
WITH t AS (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) || '|' || CAST(o_custkey AS VARCHAR) || '|' ||
                  coalesce(o_orderstatus, '') || '|' || coalesce(o_orderpriority, '') AS txt
           FROM orders ORDER BY o_orderkey LIMIT 200)
SELECT (SELECT COUNT(*) FROM orders) AS rows, CAST(4 AS BIGINT) AS cols,
       md5(string_agg(txt, chr(10) ORDER BY o_orderkey)) AS head_md5 FROM t
""")
def _h2(spark, sf):
    o = table(spark, sf, "orders")
    fp = reg.fingerprint(o, "o_orderkey", ["o_orderkey", "o_custkey", "o_orderstatus",
                                           "o_orderpriority"])
    return fp.select("rows", "cols", "head_md5")


@query("h2_fingerprint_table_hash")
def _h2b(spark, sf):
    return reg.fingerprint(table(spark, sf, "orders"), "o_orderkey").select(
        "rows", "cols", "table_hash", "head_md5")


@query("h3_list_runs", f"""{R}
SELECT model, run_id FROM runs2 WHERE regexp_matches(run_id, '{PAT}')
""")
def _h3(spark, sf):
    return reg.list_runs(runs_ts(spark, sf)).select("model", "run_id")


@query("h4_current_aliases", f"""{ALIAS_SQL}
SELECT scope, model, alias, run_id, cv_rmse FROM cur
""")
def _h4(spark, sf):
    return reg.current_aliases(alias_events(runs_ts(spark, sf)))


@query("h5_family_best", f"""{R}
SELECT model, run_id, cv_rmse FROM (
  SELECT *, row_number() OVER (PARTITION BY model ORDER BY cv_rmse, ts NULLS FIRST, run_id) AS rn
  FROM runs2 WHERE cv_rmse IS NOT NULL AND NOT isnan(cv_rmse)) WHERE rn = 1
""")
def _h5(spark, sf):
    return reg.family_best(runs_ts(spark, sf))


@query("h6_global_best", f"""{R}
SELECT model, run_id, cv_rmse FROM runs2 WHERE cv_rmse IS NOT NULL
ORDER BY cv_rmse, ts NULLS FIRST, model, run_id LIMIT 1
""")
def _h6(spark, sf):
    return reg.global_best(runs_ts(spark, sf))


@query("h6_global_latest", f"""{R}
SELECT model, run_id, cv_rmse FROM runs2 WHERE ts IS NOT NULL
ORDER BY ts DESC, model DESC, run_id DESC LIMIT 1
""")
def _h6l(spark, sf):
    return reg.global_latest(runs_ts(spark, sf))


def _requests(runs: DataFrame) -> DataFrame:
    m = runs.select("model").distinct()
    first = runs.groupBy("model").agg(F.min("run_id").alias("r"))
    parts = [m.select(F.concat("model", F.lit("/" + a)).alias("model_id"))
             for a in reg.ALIASES]
    parts.append(first.select(F.concat_ws("/", "model", "r").alias("model_id")))
    parts.append(m.select(F.concat("model", F.lit("/")).alias("model_id")))
    parts.append(m.select(F.concat("model", F.lit("/nope")).alias("model_id")))
    parts.append(m.limit(1).select(F.lit("global/best").alias("model_id")))
    parts.append(m.limit(1).select(F.lit("global/latest").alias("model_id")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("h7_resolve", f"""{ALIAS_SQL},
m AS (SELECT DISTINCT model FROM runs2),
req AS (
  SELECT model || '/' || a AS model_id FROM m, (VALUES ('latest'), ('best'), ('production'), ('staging')) v(a)
  UNION ALL SELECT model || '/' || MIN(run_id) FROM runs2 GROUP BY model
  UNION ALL SELECT model || '/' FROM m
  UNION ALL SELECT model || '/nope' FROM m
  UNION ALL SELECT 'global/best' UNION ALL SELECT 'global/latest'),
p AS (SELECT model_id AS request, split_part(model_id, '/', 1) AS fam,
             CASE WHEN len(string_split(model_id, '/')) = 2 THEN split_part(model_id, '/', 2) END AS ref
      FROM req),
j AS (
  SELECT p.*, CASE WHEN fam = 'global' THEN g.model ELSE fam END AS model,
         coalesce(CASE WHEN fam = 'global' THEN g.run_id END, a.run_id, k.run_id) AS run_id,
         (ref IS NULL OR ref = '' OR fam = '') AS bad,
         (ref IN ('latest', 'best', 'production', 'staging') OR fam = 'global') AS alias_like
  FROM p
  LEFT JOIN (SELECT * FROM cur WHERE scope = 'family') a ON p.fam = a.model AND p.ref = a.alias
  LEFT JOIN (SELECT * FROM cur WHERE scope = 'global') g ON p.fam = 'global' AND p.ref = g.alias
  LEFT JOIN runs2 k ON p.fam = k.model AND p.ref = k.run_id)
SELECT request, CASE WHEN NOT bad THEN model END AS model, CASE WHEN NOT bad THEN run_id END AS run_id,
       CASE WHEN bad THEN 'malformed' WHEN run_id IS NOT NULL THEN 'ok'
            WHEN alias_like THEN 'unset' ELSE 'unknown_run' END AS status
FROM j
""")
def _h7(spark, sf):
    r = runs_ts(spark, sf)
    return reg.resolve(_requests(r), "model_id", reg.current_aliases(alias_events(r)), r)


@query("h8_registry_status", f"""{ALIAS_SQL},
m AS (SELECT DISTINCT model FROM runs2),
g AS (SELECT model, a AS alias FROM m, (VALUES ('latest'), ('best'), ('production'), ('staging')) v(a)),
j AS (SELECT g.model, g.alias, c.run_id, r.cv_rmse AS rmse FROM g
      LEFT JOIN (SELECT * FROM cur WHERE scope = 'family') c ON g.model = c.model AND g.alias = c.alias
      LEFT JOIN runs2 r ON g.model = r.model AND c.run_id = r.run_id)
SELECT model, alias, run_id, rmse,
       CASE WHEN run_id IS NULL THEN 'not set' WHEN rmse IS NULL THEN 'unknown'
            WHEN rmse < 0.13 THEN 'Excellent' WHEN rmse < 0.14 THEN 'Strong' ELSE 'Standard' END AS label
FROM j
""")
def _h8(spark, sf):
    r = runs_ts(spark, sf)
    return reg.registry_status(reg.current_aliases(alias_events(r)), r)


@query("h9_run_bundle", f"""{R},
gb AS (SELECT model, run_id, cv_rmse FROM runs2 WHERE cv_rmse IS NOT NULL
       ORDER BY cv_rmse, ts NULLS FIRST, model, run_id LIMIT 1)
SELECT model, run_id, cv_rmse, 3 * (SELECT COUNT(*) FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                                    JOIN nation n ON c.c_nationkey = n.n_nationkey) AS predictions
FROM gb
""")
def _h9(spark, sf):
    from hearth.plans.q_flagship import predictions
    r = runs_ts(spark, sf)
    best = reg.global_best(r).first()
    preds = predictions(spark, sf).withColumn("model", F.lit(best["model"])) \
        .withColumn("run_id", F.lit(best["run_id"]))
    b = reg.run_bundle(r, preds, best["model"], best["run_id"])
    return b.groupBy("model", "run_id", "cv_rmse").agg(F.count("id").alias("predictions"))


SUMMARY_SQL = f"""{R},
sm AS (SELECT CASE WHEN size % 2 = 0 THEN 'Stage1' ELSE 'Stage2' END AS stage, model,
              run_id AS candidate, cv_rmse AS rmse_mean, size / 1000.0 AS rmse_std
       FROM runs2 WHERE cv_rmse IS NOT NULL)"""


def _summary(spark, sf) -> DataFrame:
    r = runs_binding(spark, sf).filter(F.col("cv_rmse").isNotNull())
    return r.select(F.when(F.col("size") % 2 == 0, F.lit("Stage1")).otherwise(F.lit("Stage2"))
                    .alias("stage"), "model", F.col("run_id").alias("candidate"),
                    F.col("cv_rmse").alias("rmse_mean"), (F.col("size") / 1000.0).alias("rmse_std"))


@query("h10_stage_summary_best", f"""WITH {SALES_CTE.strip()},
{SUMMARY_SQL[5:]},
med AS (SELECT quantile_cont(price, 0.5) AS med FROM sales)
SELECT stage, model, candidate, rmse_mean, rmse_std, round(med * (exp(rmse_mean) - 1), 4) AS money_error
FROM (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY rmse_mean, rmse_std, model, candidate) AS rn
      FROM sm), med WHERE rn = 1
""")
def _h10(spark, sf):
    med = medians(sales(spark, sf).select("price"), ["price"])["price"]
    best, _ranked = reg.stage_summary(_summary(spark, sf), med)
    return best.select("stage", "model", "candidate", "rmse_mean", "rmse_std",
                       rnd("money_error", 4).alias("money_error"))


@query("h10_stage_summary_top", f"""{SUMMARY_SQL}
SELECT stage, model, candidate, rmse_mean, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY stage ORDER BY rmse_mean, rmse_std, model, candidate) AS rank
  FROM sm) WHERE rank <= 30
""")
def _h10t(spark, sf):
    _best, ranked = reg.stage_summary(_summary(spark, sf), None, 30)
    return ranked.select("stage", "model", "candidate", "rmse_mean", "rank")
