"""Balance and audit tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapair.functions.columns import finite
from terrapair.functions.quantiles import with_quantiles


def difference(mean_p: Column, var_p: Column, mean_r: Column, var_r: Column) -> Column:
    """Standardised mean difference from moments; 0 where neither side varies."""
    pooled = F.sqrt((var_p + var_r) / 2)
    return F.when(pooled == 0, F.lit(0.0)).otherwise(F.abs(mean_p - mean_r) / pooled)


def smd(project: DataFrame, reference: DataFrame, covs: Sequence[str], threshold: float = 0.1) -> DataFrame:
    """Standardised mean difference of each covariate; `passed` judges the unrounded value.

    One scan a side, in one aggregate. An empty side gives null and not passed.
    """
    sides = [df.agg(*[f(F.col(c).cast("double")).alias(f"{s}{k}_{c}") for c in covs for k, f in (("m", F.avg), ("v", F.var_pop))]) for s, df in (("p", project), ("r", reference))]
    wide = sides[0].crossJoin(sides[1])  # one row each
    rows = ", ".join(f"'{c}', `pm_{c}`, `pv_{c}`, `rm_{c}`, `rv_{c}`" for c in covs)
    long = wide.selectExpr(f"stack({len(covs)}, {rows}) as (covariate, proj_mean, pv, ref_mean, rv)")
    out = long.withColumn("_smd", difference(F.col("proj_mean"), F.col("pv"), F.col("ref_mean"), F.col("rv")))
    return out.select("covariate", F.round("_smd", 4).alias("smd"), "proj_mean", "ref_mean", F.coalesce(F.col("_smd") < threshold, F.lit(False)).alias("passed"))


def audit(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """n, passed_n and passed_pct of each boolean column, in one scan."""
    wide = df.agg(*[x for f in flags for x in (F.count(f).alias(f"n_{f}"), F.count_if(f).alias(f"t_{f}"))])
    rows = ", ".join(f"'{f}', `n_{f}`, `t_{f}`" for f in flags)
    long = wide.selectExpr(f"stack({len(flags)}, {rows}) as (criterion, n, passed_n)")
    return long.withColumn("passed_pct", F.when(F.col("n") > 0, F.col("passed_n") / F.col("n") * 100))


def covariate_summary(df: DataFrame, covs: Sequence[str], decimals: int = 6) -> DataFrame:
    """n, mean, median, sample deviation, 2nd and 98th percentile; covariates without values are left out.

    The quantile search runs its jobs at once, two or three scans of `df`: store it first if it is costly.
    """
    v = {c: finite(F.col(f"`{c}`").cast("double")) for c in covs}
    aggs = [f(v[c]).alias(f"{k}_{c}") for c in covs for k, f in (("n", F.count), ("m", F.avg), ("s", F.stddev_samp))]
    if not covs:
        return df.sparkSession.createDataFrame([], "covariate string, n long, mean double, median double, std double, q02 double, q98 double")
    marks, row = with_quantiles(df, covs, [0.02, 0.5, 0.98], aggs)
    rows = [(c, row[f"n_{c}"], row[f"m_{c}"], marks[c][1], row[f"s_{c}"], marks[c][0], marks[c][2]) for c in covs if marks.get(c)]
    r = lambda c: F.round(c, decimals).alias(c)
    out = df.sparkSession.createDataFrame(rows, "covariate string, n long, mean double, median double, std double, q02 double, q98 double")
    return out.select("covariate", "n", r("mean"), r("median"), r("std"), r("q02"), r("q98"))
