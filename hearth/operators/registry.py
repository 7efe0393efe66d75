"""Run registry as tables.

Runs and alias changes are append-only Parquet tables; "current" aliases are
derived with ``max_by`` over event time, so concurrent writers never rewrite a
shared document and a failed job leaves no half-written state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RUN_ID_PATTERN = r"^\d{4}-\d{2}-\d{2}_\d{6}$"
RUN_ID_FORMAT = "yyyy-MM-dd_HHmmss"
# Stability labels by CV RMSE.
LABEL_EXCELLENT, LABEL_STRONG = 0.13, 0.14
ALIASES = ["latest", "best", "production", "staging"]


def new_run_id() -> Column:
    """H1: run id from the current timestamp."""
    return F.date_format(F.current_timestamp(), RUN_ID_FORMAT)


def run_ts(run_id: Column) -> Column:
    return F.try_to_timestamp(run_id, F.lit(RUN_ID_FORMAT))


def register_run(runs: DataFrame, path: str | None = None) -> DataFrame:
    """H1: append run records (model, run_id, cv_rmse, fold_rmse, args,
    features, fingerprint, ...) to the ``runs`` table; ts is derived from the
    run id when absent."""
    out = runs if "ts" in runs.columns else runs.withColumn("ts", run_ts(F.col("run_id")))
    if path:
        out.write.mode("append").parquet(path)
    return out


def fingerprint(df: DataFrame, id_col: str, cols: Sequence[str] | None = None,
                head: int = 200) -> DataFrame:
    """H2: rows, columns, names, dtypes, md5 of the first ``head`` rows in
    key order (TakeOrdered, bounded), and an order-independent hash of the
    whole table (decimal sum of per-row xxhash64, so repeated rows count;
    one partial aggregate)."""
    cols = list(cols or df.columns)
    txt = F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in cols])
    top = (df.select(F.col(id_col).alias("_k"), txt.alias("_t")).orderBy("_k").limit(head)
           .agg(F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_k", "_t"))),
                                                lambda s: s["_t"]), "\n")).alias("head_md5")))
    whole = df.agg(F.count(F.lit(1)).alias("rows"),
                   F.coalesce(F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in cols]).cast("decimal(20,0)")), F.lit(0))
                   .cast("string").alias("table_hash"))
    spark = df.sparkSession
    meta = spark.createDataFrame(
        [(len(cols), cols, {f.name: f.dataType.simpleString() for f in df.schema.fields
                            if f.name in cols})],
        "cols bigint, columns array<string>, dtypes map<string,string>")
    return whole.join(top, how="inner").join(meta, how="inner")


def fingerprint_by(df: DataFrame, by: str, id_col: str, cols: Sequence[str], head: int = 200) -> DataFrame:
    """H2 per group: the fingerprint of the rows in struct column ``_row`` for
    every value of ``by`` (NULL is a group): rows, md5 of the first ``head``
    rows in key and text order, hash of all rows.  The first rows are cut
    before the shuffle, so a hot group costs each task ``head`` rows."""
    val = [F.col(f"_row.`{c}`") for c in cols]
    txt = F.concat_ws("|", *[F.coalesce(v.cast("string"), F.lit("")) for v in val])
    top = df.select(by, F.col(f"_row.`{id_col}`").alias("_k"), txt.alias("_t"))
    first = Window.partitionBy(by).orderBy("_k", "_t")
    top = top.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= head).groupBy(F.col(by).alias("_by")).agg(
        F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", "_t"))), lambda s: s["_t"]), "\n")).alias("head_md5"))
    whole = df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*val).cast("decimal(20,0)")).cast("string").alias("table_hash"))
    return whole.join(top, F.col(by).eqNullSafe(F.col("_by")), "inner").drop("_by")


def list_runs(runs: DataFrame, model: str | None = None) -> DataFrame:
    """H3: well-formed run ids (timestamp pattern), sorted."""
    d = runs.filter(F.col("run_id").rlike(RUN_ID_PATTERN))
    if model is not None:
        d = d.filter(F.col("model") == model)
    return d.orderBy("model", "run_id")


EVENTS = "scope string, model string, alias string, run_id string, cv_rmse double, ts timestamp, event string"


def write_part(df: DataFrame, path: str) -> None:
    """Write one part of a table, replacing what an earlier try left there."""
    df.write.mode("overwrite").parquet(path)


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    """All run records of a training folder."""
    return spark.read.option("basePath", f"{root}/runs").parquet(f"{root}/runs/run=*").drop("run")


def read_events(spark: SparkSession, root: str) -> DataFrame:
    """All alias events of a training folder; empty before the first run."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/events")
    if not path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path):
        return spark.createDataFrame([], EVENTS)
    return spark.read.schema(EVENTS).parquet(f"{root}/events")


def promote(runs: DataFrame, aliases: DataFrame, model: str, run_id: str) -> DataFrame:
    """H4-H6: alias events of a new run: it becomes ``latest``, and ``best``
    where no run was or where its CV RMSE is strictly lower, for its family
    and over all models.  Event time is the run's, so a replay changes nothing."""
    new = runs.filter((F.col("model") == model) & (F.col("run_id") == run_id)).select(
        F.explode(F.array(F.lit("family"), F.lit("global"))).alias("scope"), "model", "run_id", "cv_rmse", "ts")
    best = aliases.filter((F.col("alias") == "best") & ((F.col("scope") == "global") | (F.col("model") == model)))
    best = best.select("scope", F.col("cv_rmse").alias("_best"))  # at most two rows
    better = new.join(best, "scope", "left").filter(F.col("cv_rmse").isNotNull() & (F.col("_best").isNull() | (F.col("cv_rmse") < F.col("_best"))))
    cols = ["scope", "model", "alias", "run_id", "cv_rmse", "ts"]
    return new.withColumn("alias", F.lit("latest")).select(cols).unionByName(better.withColumn("alias", F.lit("best")).select(cols))


def alias_event(spark: SparkSession, scope: str, model: str, alias: str, run_id: str,
                cv_rmse: float | None, path: str | None = None) -> DataFrame:
    """H4 set_alias / promote: one appended event row."""
    ev = spark.createDataFrame([(scope, model, alias, run_id, cv_rmse)],
                               "scope string, model string, alias string, run_id string, "
                               "cv_rmse double").withColumn("ts", F.current_timestamp())
    if path:
        ev.write.mode("append").parquet(path)
    return ev


def current_aliases(events: DataFrame) -> DataFrame:
    """H4: current alias = the latest event per (scope, model, alias); the
    global aliases have one holder over all models."""
    family = F.when(F.col("scope") == "global", F.lit("global")).otherwise(F.col("model"))
    if "event" in events.columns:
        return events.groupBy("scope", family.alias("_family"), "alias").agg(
            F.max_by(F.struct("model", "run_id", "cv_rmse"), F.struct("ts", "run_id")).alias("_cur")).select(
            "scope", F.col("_cur.model").alias("model"), "alias", F.col("_cur.run_id").alias("run_id"), F.col("_cur.cv_rmse").alias("cv_rmse"))
    return events.groupBy("scope", "model", "alias").agg(
        F.max_by(F.struct("run_id", "cv_rmse"), F.struct("ts", "run_id")).alias("_cur")
    ).select("scope", "model", "alias", F.col("_cur.run_id").alias("run_id"),
             F.col("_cur.cv_rmse").alias("cv_rmse"))


def get_alias(aliases: DataFrame, model: str, alias: str) -> str:
    """H4: resolve one alias; unknown aliases are an error."""
    if alias not in ALIASES:
        raise ValueError(f"unknown alias {alias!r}; expected one of {ALIASES}")
    row = aliases.filter((F.col("model") == model) & (F.col("alias") == alias)).first()
    if row is None or row["run_id"] is None:
        raise LookupError(f"alias {model}/{alias} is not set")
    return row["run_id"]


def family_best(runs: DataFrame) -> DataFrame:
    """H5: lowest CV RMSE per model; the earliest run wins ties (replace only
    on strictly lower); runs without a metric are ignored."""
    d = runs.filter(F.col("cv_rmse").isNotNull() & ~F.isnan("cv_rmse"))
    return d.groupBy("model").agg(
        F.min_by("run_id", F.struct("cv_rmse", "ts", "run_id")).alias("run_id"),
        F.min("cv_rmse").alias("cv_rmse"))


def global_best(runs: DataFrame) -> DataFrame:
    """H6: best run over all models."""
    d = runs.filter(F.col("cv_rmse").isNotNull() & ~F.isnan("cv_rmse"))
    return d.agg(F.min_by(F.struct("model", "run_id", "cv_rmse"),
                          F.struct("cv_rmse", "ts", "model", "run_id")).alias("b")).select("b.*")


def global_latest(runs: DataFrame) -> DataFrame:
    """H6: most recent run over all models."""
    d = runs.filter(F.col("ts").isNotNull())
    return d.agg(F.max_by(F.struct("model", "run_id", "cv_rmse"),
                          F.struct("ts", "model", "run_id")).alias("b")).select("b.*")


def resolve(requests: DataFrame, id_col: str, aliases: DataFrame, runs: DataFrame) -> DataFrame:
    """H7: a column of model ids -> explicit (model, run_id).

    Forms: 'global/best', 'global/latest', 'family/alias', 'family/run_id'.
    Unset aliases and malformed ids are reported in ``status``."""
    parts = F.split(F.col(id_col), "/")
    r = requests.select(F.col(id_col).alias("request"), parts[0].alias("_fam"),
                        F.when(F.size(parts) == 2, parts[1]).alias("_ref"))
    is_global = F.col("_fam") == "global"
    a = aliases.select(F.col("scope").alias("_s"), F.col("model").alias("_am"),
                       F.col("alias").alias("_al"), F.col("run_id").alias("_arun"),
                       F.col("model").alias("_amodel"))
    g = aliases.filter(F.col("scope") == "global").select(
        F.col("alias").alias("_gal"), F.col("model").alias("_gm"),
        F.col("run_id").alias("_grun"))
    known = runs.select(F.col("model").alias("_rm"), F.col("run_id").alias("_rr"))
    j = (r.join(a.filter(F.col("_s") == "family"),
                (F.col("_fam") == F.col("_am")) & (F.col("_ref") == F.col("_al")), "left")
         .join(g, is_global & (F.col("_ref") == F.col("_gal")), "left")
         .join(known, (F.col("_fam") == F.col("_rm")) & (F.col("_ref") == F.col("_rr")), "left"))
    model = F.when(is_global, F.col("_gm")).otherwise(F.col("_fam"))
    run = F.coalesce(F.when(is_global, F.col("_grun")), F.col("_arun"), F.col("_rr"))
    malformed = F.col("_ref").isNull() | (F.col("_ref") == "") | (F.col("_fam") == "")
    alias_like = F.col("_ref").isin(ALIASES) | is_global
    status = (F.when(malformed, F.lit("malformed"))
              .when(run.isNotNull(), F.lit("ok"))
              .when(alias_like, F.lit("unset")).otherwise(F.lit("unknown_run")))
    return j.select("request", F.when(~malformed, model).alias("model"),
                    F.when(~malformed, run).alias("run_id"), status.alias("status"))


def stability_label(rmse: Column) -> Column:
    return (F.when(rmse.isNull(), F.lit("unknown")).when(rmse < LABEL_EXCELLENT, F.lit("Excellent"))
            .when(rmse < LABEL_STRONG, F.lit("Strong")).otherwise(F.lit("Standard")))


def registry_status(aliases: DataFrame, runs: DataFrame) -> DataFrame:
    """H8: alias x model table with the referenced run's RMSE (unknown when
    the run has no metric) and its stability label."""
    spark = aliases.sparkSession
    models = runs.select("model").distinct()
    names = spark.createDataFrame([(a,) for a in ALIASES], "alias string")
    grid = models.join(F.broadcast(names), how="inner")  # models x 4 aliases
    fam = aliases.filter(F.col("scope") == "family").select("model", "alias", "run_id")
    j = grid.join(fam, ["model", "alias"], "left").join(
        runs.select("model", "run_id", F.col("cv_rmse").alias("rmse")), ["model", "run_id"], "left")
    return j.select("model", "alias", "run_id", "rmse",
                    F.when(F.col("run_id").isNull(), F.lit("not set"))
                    .otherwise(stability_label(F.col("rmse"))).alias("label"))


def run_bundle(runs: DataFrame, preds: DataFrame, model: str, run_id: str) -> DataFrame:
    """H9: everything about one run: its record joined with its predictions
    (partition-pruned by model)."""
    r = runs.filter((F.col("model") == model) & (F.col("run_id") == run_id))
    p = preds.filter((F.col("model") == model) & (F.col("run_id") == run_id))
    return r.join(p.drop("model"), "run_id", "left")


def stage_summary(summary: DataFrame, median_price: Column | float | None = None,
                  top: int = 30) -> tuple[DataFrame, DataFrame]:
    """Best candidate per stage (mean, then std), ordered comparison with
    the top-``top`` candidates per stage and the money intuition
    median * expm1(rmse)."""
    best = summary.groupBy("stage").agg(
        F.min_by(F.struct("model", "candidate", "rmse_mean", "rmse_std"),
                 F.struct("rmse_mean", "rmse_std", "model", "candidate")).alias("b")
    ).select("stage", "b.*")
    w = Window.partitionBy("stage").orderBy("rmse_mean", "rmse_std", "model", "candidate")
    ranked = summary.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
    if median_price is not None:
        mp = median_price if isinstance(median_price, Column) else F.lit(float(median_price))
        ranked = ranked.withColumn("money_error", mp * F.expm1("rmse_mean"))
        best = best.withColumn("money_error", mp * F.expm1("rmse_mean"))
    return best, ranked
