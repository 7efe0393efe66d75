"""Reusable SQL fragments for the DuckDB oracle statements.

They restate the bindings of ``hearth.sources.bindings`` in plain SQL so the
oracle is computed independently of the Spark code path.
"""

SALES_CTE = """
li AS (
  SELECT l_orderkey,
         SUM(l_quantity) AS qty,
         SUM(l_extendedprice) AS ext,
         COUNT(*) AS n_lines,
         AVG(l_discount) AS disc,
         SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END) AS ret_qty,
         CAST(year(MAX(l_shipdate)) AS BIGINT) AS yr_sold,
         CAST(year(MIN(l_shipdate)) AS BIGINT) AS yr_remod
  FROM lineitem GROUP BY l_orderkey),
sales AS (
  SELECT o.o_orderkey AS id,
         o.o_totalprice AS price,
         CAST(year(o.o_orderdate) AS BIGINT) AS yr_built,
         li.yr_sold, li.yr_remod,
         CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE li.qty END AS qty,
         li.ext, li.n_lines, li.disc, li.ret_qty,
         c.c_acctbal AS acctbal,
         CAST(1 + o.o_custkey % 10 AS BIGINT) AS quality,
         CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE n.n_name END AS nbhd,
         c.c_mktsegment AS segment,
         o.o_orderpriority AS priority,
         CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE o.o_orderstatus END AS status
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN li ON o.o_orderkey = li.l_orderkey)
"""

EVENTS_CTE = """
ev AS (
  SELECT event_id AS id, ts, user_id,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS event_type,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value
  FROM events),
ev_ref AS (SELECT * FROM ev WHERE ts < TIMESTAMP '2024-01-16 00:00:00'),
ev_cur AS (SELECT * FROM ev WHERE ts >= TIMESTAMP '2024-01-16 00:00:00')
"""

RUNS_CTE = """
runs AS (
  SELECT p_brand AS model,
         CASE WHEN p_size % 17 = 0 THEN 'tmp_' || CAST(p_size AS VARCHAR)
              ELSE printf('2025-%02d-%02d_%06d', (p_size % 12) + 1, (p_size % 28) + 1,
                          p_size * 100) END AS run_id,
         CASE WHEN p_size % 19 = 0 THEN NULL
              ELSE round(AVG(p_retailprice) / 10000.0, 6) END AS cv_rmse,
         CAST(p_size AS BIGINT) AS size
  FROM part GROUP BY p_brand, p_size)
"""


def fold_sql(id_expr: str, k: int = 5, seed: int = 42) -> str:
    return (f"CAST((('0x' || substr(md5(CAST({id_expr} AS VARCHAR) || ':{seed}'), 1, 8))"
            f"::BIGINT) % {k} AS INTEGER)")


def hash_sql(id_expr: str, seed: int = 42) -> str:
    return f"(('0x' || substr(md5(CAST({id_expr} AS VARCHAR) || ':{seed}'), 1, 8))::BIGINT)"


def ridge1_sql(src: str, x: str, y: str, alpha: float = 12.0, fold: str = "fold") -> str:
    """OOF one-feature ridge: per fold, statistics of the other folds."""
    return f"""
tr_{src} AS (
  SELECT k.{fold} AS {fold}, COUNT(*) AS n, AVG(d.{x}) AS mx, AVG(d.{y}) AS my,
         stddev_pop(d.{x}) AS sdx, covar_pop(d.{x}, d.{y}) AS cxy
  FROM (SELECT DISTINCT {fold} FROM {src}) k
  JOIN {src} d ON d.{fold} <> k.{fold}
  WHERE d.{x} IS NOT NULL AND d.{y} IS NOT NULL
  GROUP BY k.{fold}),
oof_{src} AS (
  SELECT d.*, t.my + (t.n * t.cxy / (CASE WHEN t.sdx > 0 THEN t.sdx ELSE 1.0 END)
                      / (t.n + {float(alpha)}))
                   * (d.{x} - t.mx) / (CASE WHEN t.sdx > 0 THEN t.sdx ELSE 1.0 END) AS pred_log
  FROM {src} d JOIN tr_{src} t ON d.{fold} = t.{fold})
"""


def quantiles_sql(col: str, q: int) -> str:
    probs = ", ".join(repr(i / q) for i in range(q + 1))
    return f"list_sort(list_distinct(quantile_cont({col}, [{probs}])))"


def rc_bin_sql(x: str, edges: str) -> str:
    """Right-closed bin index (qcut)."""
    return (f"CASE WHEN {x} IS NULL THEN NULL ELSE "
            f"greatest(1, len(list_filter({edges}, lambda e: e < {x}))) END")

HOUSE_CTE = SALES_CTE.rstrip() + """,
house AS (
  SELECT id AS "Id", price AS "SalePrice", yr_sold AS "YrSold", yr_built AS "YearBuilt",
         yr_remod AS "YearRemodAdd", qty AS "TotalBsmtSF", ret_qty AS "1stFlrSF",
         CAST(n_lines AS DOUBLE) AS "2ndFlrSF", CAST(floor(ext / 100) AS BIGINT) AS "GrLivArea",
         quality AS "OverallQual", acctbal AS "GarageArea", n_lines - 4 AS "Fireplaces",
         n_lines AS "FullBath", quality % 3 AS "HalfBath", nbhd AS "Neighborhood",
         ext AS "LotArea", disc * 100 AS "LotFrontage", ret_qty AS "MasVnrArea",
         acctbal AS "WoodDeckSF", ret_qty AS "OpenPorchSF", qty AS "EnclosedPorch",
         segment AS "MSZoning", status AS "KitchenQual", priority AS "SaleType",
         status AS "FireplaceQu"
  FROM sales)
"""
