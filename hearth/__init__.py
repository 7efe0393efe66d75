"""hearth: Spark-native tabular regression and monitoring operators.

Every operator is a function from DataFrame to DataFrame (or a Spark ML
Estimator/Model) that takes column names as arguments.  The heavy work is
expressed with the DataFrame API so that Catalyst plans it and the executors
run it; the driver only ever sees bounded statistics (per-fold sums, quantile
edges, model coefficients).
"""

from hearth.session import checkpoint_dir, cut_lineage, drop_tables, get_spark

__all__ = ["get_spark", "checkpoint_dir", "cut_lineage", "drop_tables"]
