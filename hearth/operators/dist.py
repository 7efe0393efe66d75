"""Distribution fitting and tests (M8-M10), all single-aggregate plans.

Johnson SU is fitted by the Slifker & Shapiro (1980) four-quantile method
rather than by maximum likelihood, and normality
is tested with Jarque-Bera from the moments (Shapiro-Wilk is a single-machine
test); both are stated in the README.
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.operators.quantiles import exact_quantiles

SU_Z = 0.524  # Slifker-Shapiro z


def fit_normal(df: DataFrame, c: str) -> DataFrame:
    """M8: normal parameters (mean, population std)."""
    x = F.col(c).cast("double")
    return df.agg(F.lit("normal").alias("family"), F.avg(x).alias("mu"),
                  F.stddev_pop(x).alias("sigma"), F.count(x).alias("n"))


def fit_lognormal(df: DataFrame, c: str) -> DataFrame:
    """M8: log-normal parameters from the moments of ln(x), x > 0."""
    x = F.col(c).cast("double")
    lx = F.when(x > 0, F.log(x))
    return df.agg(F.lit("lognormal").alias("family"), F.avg(lx).alias("mu"),
                  F.stddev_pop(lx).alias("sigma"), F.count(lx).alias("n"))


def fit_johnson_su(df: DataFrame, c: str, z: float = SU_Z) -> DataFrame:
    """M8: Johnson SU (gamma, eta, epsilon, lambda) by the four-quantile rule.
    R = m*n/p^2 <= 1 means the data are not SU: family 'not SU', NULLs."""
    nd = NormalDist()
    probs = [nd.cdf(-3 * z), nd.cdf(-z), nd.cdf(z), nd.cdf(3 * z)]
    q = exact_quantiles(df, c, probs, out="q")
    a, b, cc, d = (F.col("q")[i] for i in range(4))
    m, n, p = d - cc, b - a, cc - b
    r = m * n / (p * p)
    s = m / p + n / p
    t = n / p - m / p
    eta = F.lit(2 * z) / F.acosh(s / 2)
    gamma = eta * F.asinh(t / (2 * F.sqrt(r - 1)))
    lam = 2 * p * F.sqrt(r - 1) / ((s - 2) * F.sqrt(s + 2))
    eps = (b + cc) / 2 + p * t / (2 * (s - 2))
    ok = r > 1
    return q.select(
        F.when(ok, F.lit("johnson_su")).otherwise(F.lit("not SU")).alias("family"),
        r.alias("R"),
        F.when(ok, gamma).alias("gamma"), F.when(ok, eta).alias("eta"),
        F.when(ok, eps).alias("epsilon"), F.when(ok, lam).alias("lambda"))


def johnson_transform(x: Column, gamma: float, eta: float, epsilon: float, lam: float) -> Column:
    """M9: gamma + eta * asinh((x - epsilon) / lambda)."""
    return F.lit(gamma) + F.lit(eta) * F.asinh((x - F.lit(epsilon)) / F.lit(lam))


def johnson_inverse(y: Column, gamma: float, eta: float, epsilon: float, lam: float) -> Column:
    """M9: lambda * sinh((y - gamma) / eta) + epsilon."""
    return F.lit(lam) * F.sinh((y - F.lit(gamma)) / F.lit(eta)) + F.lit(epsilon)


def normality_test(df: DataFrame, cols: Sequence[str], alpha: float = 0.01) -> DataFrame:
    """Jarque-Bera per column (NULL counted as 0); p = exp(-JB/2);
    rejected when p < alpha.  One aggregate for all columns."""
    aggs = []
    for c in cols:
        x = F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0))
        aggs.append(F.struct(F.count(F.lit(1)).alias("n"), F.skewness(x).alias("s"),
                             F.kurtosis(x).alias("k")).alias(c))
    long = df.agg(*aggs).unpivot([], list(cols), "feature", "m")
    jb = F.col("m.n") / 6.0 * (F.pow(F.col("m.s"), 2) + F.pow(F.col("m.k"), 2) / 4.0)
    return long.select("feature", F.col("m.n").alias("n"), jb.alias("jb")).select(
        "feature", "n", "jb", F.exp(-F.col("jb") / 2).alias("p_value"),
        F.coalesce(F.exp(-F.col("jb") / 2) < alpha, F.lit(False)).alias("reject_normal"))
