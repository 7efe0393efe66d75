"""PCA, K-means and a 2-D projection (M11-M13) with Spark ML.

Inputs are filled with 0 and standardised with population std (E1) before
the projection, as in the reference notebook.  t-SNE is quadratic and
single-machine; the 2-D view uses the first two principal components.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.operators.encode import PopulationScaler
from hearth.session import cut_lineage


def _vectors(df: DataFrame, cols: Sequence[str], id_col: str) -> DataFrame:
    # read by the scaler, every pass of the fits and the projection: written once
    filled = cut_lineage(df.select(id_col, *[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(c)
                                             for c in cols]))
    scaled = PopulationScaler(inputCols=list(cols)).fit(filled).transform(filled)
    return VectorAssembler(inputCols=list(cols), outputCol="features").transform(scaled)


def pca(df: DataFrame, cols: Sequence[str], id_col: str, k: int = 30):
    """Returns (projected frame with ``pcs``, explained-variance frame)."""
    k = min(k, len(cols))
    v = _vectors(df, cols, id_col)
    model = PCA(k=k, inputCol="features", outputCol="pcs").fit(v)
    spark = df.sparkSession
    ev = [float(x) for x in model.explainedVariance.toArray()]
    var = spark.createDataFrame([(i + 1, e) for i, e in enumerate(ev)],
                                "component int, explained_variance double")
    return model.transform(v).select(id_col, "pcs"), var


def kmeans(projected: DataFrame, id_col: str, k: int = 5, seed: int = 42,
           features: str = "pcs") -> tuple[DataFrame, DataFrame]:
    """K-means in PCA space; returns (assignments, cluster sizes)."""
    model = KMeans(k=k, seed=seed, featuresCol=features, predictionCol="cluster").fit(projected)
    assigned = model.transform(projected).select(id_col, "cluster", features)
    sizes = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    return assigned, sizes


def project_2d(assigned: DataFrame, id_col: str, features: str = "pcs") -> DataFrame:
    """First two components with the cluster label."""
    from pyspark.ml.functions import vector_to_array
    arr = vector_to_array(F.col(features))
    return assigned.select(id_col, arr[0].alias("x"), arr[1].alias("y"), "cluster")
