"""Empirical-Bayes rates: beta-binomial priors by moments, posterior bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The pseudo-count of a prior stays within these, also where the moments give no usable value.
STRENGTH_RANGE = (1.0, 1000.0)


def beta_prior(groups: DataFrame, n: str, k: str) -> tuple[Column, Column]:
    """(mean, strength) of ``beta_moments``, worked out now, for use in other tables.

    Two numbers come to the driver. As literals they keep plans short: subqueries would be
    repeated wherever a formula names them.
    """
    row = beta_moments(groups, n, k).first()
    return F.lit(row["mean"]), F.lit(row["strength"])


def beta_moments(groups: DataFrame, n: str, k: str) -> DataFrame:
    """One row (mean, strength) of the beta prior behind ``k`` events in ``n`` trials per group.

    The strength comes from the analysis-of-variance estimate of the correlation within
    groups. No trials: mean 0.5 and the weakest prior. One group, or no more spread than
    chance gives: the strongest prior.
    """
    n_, k_ = F.col(n).cast("double"), F.col(k).cast("double")
    sums = groups.where(F.col(n) > 0).agg(
        F.count(F.lit(1)).cast("double").alias("h"), F.sum(n_).alias("w"), F.sum(k_).alias("e"),
        F.sum(n_ * n_).alias("nn"), F.sum(k_ * k_ / n_).alias("kkn"))
    h, w, e = F.col("h"), F.col("w"), F.col("e")
    mean = e / w
    noise = mean * (1 - mean)
    spread = F.col("kkn") - e * e / w - noise * (h - 1)
    room = noise * (w - F.col("nn") / w - (h - 1))
    low, high = STRENGTH_RANGE
    strength = (
        F.when(h == 0, low).when((spread <= 0) | (room <= 0), high)
        .otherwise(F.greatest(F.lit(low), F.least(F.lit(high), room / spread - 1))))
    return sums.select(F.coalesce(mean, F.lit(0.5)).alias("mean"), strength.alias("strength"))


def posterior_mean(n: Column, k: Column, mean: Column, strength: Column) -> Column:
    return (mean * strength + k) / (strength + n)


def lower_bound(n: Column, k: Column, mean: Column, strength: Column, z: float) -> Column:
    """``z`` standard deviations below the mean of the posterior beta distribution."""
    m = posterior_mean(n, k, mean, strength)
    return m - z * F.sqrt(m * (1 - m) / (strength + n + 1))


def moments_sql(groups: str, n: str, k: str, prefix: str = "") -> str:
    """``beta_moments`` as a SELECT over the relation ``groups``."""
    low, high = STRENGTH_RANGE
    return f"""
  select coalesce(e / w, 0.5) as {prefix}mean,
    case when h = 0 then {low} when spread <= 0 or room <= 0 then {high}
         else greatest({low}, least({high}, room / spread - 1)) end as {prefix}strength
  from (
    select *, kkn - e * e / w - (e / w) * (1 - e / w) * (h - 1) as spread,
      (e / w) * (1 - e / w) * (w - nn / w - (h - 1)) as room
    from (
      select cast(count(*) as double) as h, sum(cast({n} as double)) as w,
        sum(cast({k} as double)) as e, sum(cast({n} as double) * {n}) as nn,
        sum(cast({k} as double) * {k} / {n}) as kkn
      from {groups} where {n} > 0))"""
