"""Spark result == DuckDB oracle for registered queries.

By default a representative subset runs on sf0.001; set HEARTH_ORACLE_ALL=1
to run every query that has an oracle (the driver does this at sf0.01)."""

import os

import pytest

SUBSET = [
    "l6_segment_errors_decile", "g2_oof_ridge1_fold_rmse", "b4_trim_quantiles",
    "c3_group_median_imputer", "c5_mode_imputer", "d14_feature_engineer", "e4_dummies",
    "k1_numeric_drift", "k2_categorical_drift", "k5_psi_floor", "k7_category_shift",
    "l8_risk_table", "m6_spearman", "m10_normality_test", "h7_resolve", "i4_typicality_score",
    "i7_percentile_rank", "j3_check_contract", "o1_stratified_sample", "g7_weight_sweep",
    "n8_describe_features", "a8_read_summary", "c6_median_imputer", "c10_apply_defaults",
    "g1_balanced_folds", "g1_dense_index", "g3_fold_avg_one_feature", "g6_two_stage_search", "g9_train_aliases",
    "i1_score_one_feature", "m11_pca_two_columns", "n5_signed_one_feature", "n6_ols_one_regressor", "n7_permutation_one_feature",
    "l13_error_correlates", "m3_box_summary", "k9_drift_summary",
]


def _names():
    import __spark_entry__ as e
    o = e.oracle_sql()
    if os.environ.get("HEARTH_ORACLE_ALL"):
        return sorted(o)
    return [n for n in SUBSET if n in o]


@pytest.fixture(scope="module")
def duck():
    import duckdb
    from tools.oracle_check import TABLES
    sf = os.environ.get("HEARTH_ORACLE_SF", "/root/testdata/sf0.001")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    con.execute("SET TimeZone='UTC'")
    return con, sf


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as e
    from tools.oracle_check import compare
    con, sf = duck
    df = e.queries()[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(e.oracle_sql()[name])
    verdict = compare(rows, df.columns, res.fetchall(), [d[0] for d in res.description])
    assert verdict.startswith("OK"), verdict
