"""Baseline change with confidence intervals: control and project summaries, credits, hand-off.

Every summary is a one-row frame, so that runs can be grouped: with `by`, the same
aggregates give a row for each group in one job.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapair.config import TC_TO_TCO2E, Z90, BaselineConfig
from terrapair.functions.columns import finite
from terrapair.functions.quantiles import exact_quantiles, grouped_quantiles


def control_rows(df: DataFrame, unique: bool = False, lon: str = "ref_lon", lat: str = "ref_lat", decimals: int = 7, order: Sequence[str] = ()) -> DataFrame:
    """All matched rows, or for diagnosis one a position (the first by `order`)."""
    if not unique:
        return df
    keyed = df.withColumns({"_lon": F.round(lon, decimals), "_lat": F.round(lat, decimals)})
    by = F.struct(*(order or df.columns))
    return keyed.groupBy("_lon", "_lat").agg(F.min_by(F.struct(*df.columns), by).alias("_r")).select("_r.*")


def block_interval(df: DataFrame, delta: str, block: str = "block_id", z: float = Z90, by: Sequence[str] = ()) -> DataFrame:
    """n_blocks, the deviation of block means and the interval it gives; null below two blocks."""
    rows = df.select(*by, block, finite(F.col(delta).cast("double")).alias("_d")).where(F.col("_d").isNotNull() & F.col(block).isNotNull())
    means = rows.groupBy(*by, block).agg(F.avg("_d").alias("m"))
    out = means.groupBy(*by).agg(F.count(F.lit(1)).alias("n_blocks"), F.stddev_samp("m").alias("block_sd"))
    enough = F.col("n_blocks") >= 2
    return out.withColumns({"ci_block": F.when(enough, F.lit(z) * F.col("block_sd") / F.sqrt("n_blocks")), "block_status": F.when(enough, "computed").otherwise("not_enough_blocks")})


def control_interval(df: DataFrame, delta: str = "delta_tC_ha_yr", lon: str = "ref_lon", lat: str = "ref_lat", cfg: BaselineConfig = BaselineConfig(), block: str = "block_id", by: Sequence[str] = (), median: bool = True, store: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Mean change of the controls with its 90 % interval and the uncertainty ratio.

    Mean and deviation are over all rows; the standard error uses the distinct positions
    if there are two at least. The wider of the pixel and the block interval counts. A null group is a
    group. The median is exact and found by jobs that run at once over `df` (store it first if it is costly);
    with groups, `store` cuts the lineage between their rounds, checkpoint() by default.
    """
    d = finite(F.col(delta).cast("double"))
    key = F.struct(F.round(lon, cfg.decimals), F.round(lat, cfg.decimals))
    rows = df.select("*", d.alias("_d")).where("_d is not null")
    middle = []
    if median and not by:
        half = exact_quantiles(rows, ["_d"], [0.5])["_d"]
        middle = [F.lit(half[0] if half else None).cast("double").alias("median")]
    agg = rows.groupBy(*by).agg(F.count("_d").alias("n_rows"), F.avg("_d").alias("mean"), *middle, F.stddev_samp("_d").alias("sd"), F.count_distinct(key).alias("n_unique"))
    if median and by:
        agg = _with_groups(agg, grouped_quantiles(rows, by, "_d", {"median": 0.5}, store=store), by)
    out = agg.withColumn("n_eff", F.when(F.col("n_unique") >= 2, F.col("n_unique")).otherwise(F.col("n_rows")))
    out = out.where(F.col("n_rows") >= cfg.min_controls)
    out = out.withColumns({"se": F.col("sd") / F.sqrt("n_eff"), "ci_pixel": F.lit(cfg.z) * F.col("sd") / F.sqrt("n_eff"), "ci_naive": F.lit(cfg.z) * F.col("sd") / F.sqrt("n_rows")})
    if cfg.use_blocks:
        blocks = block_interval(rows.withColumn("_delta", F.col("_d")).drop("_d"), "_delta", block, cfg.z, by)
        out = _with_groups(out, blocks, by) if by else out.crossJoin(blocks)
    else:
        out = out.withColumns({"n_blocks": F.lit(0).cast("long"), "block_sd": F.lit(None).cast("double"), "ci_block": F.lit(None).cast("double"), "block_status": F.lit("off")})
    out = out.withColumn("ci", F.greatest("ci_pixel", "ci_block"))  # greatest leaves nulls out
    source = F.when(F.coalesce(F.col("ci_block") > F.col("ci_pixel"), F.lit(False)), "block").otherwise("pixel")
    return out.withColumns({"ci_source": source, "lower": F.col("mean") - F.col("ci"), "upper": F.col("mean") + F.col("ci"), **_ratio()})


def _with_groups(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Left join of two frames with a row a group, null equal to null."""
    other = right.withColumnsRenamed({c: f"_g_{c}" for c in by})
    same = reduce(and_, [left[c].eqNullSafe(other[f"_g_{c}"]) for c in by])
    return left.join(other, same, "left").drop(*[f"_g_{c}" for c in by])


def _ratio() -> dict[str, Column]:
    positive = F.col("mean") > 0
    return {"uncbsl": F.when(positive, F.col("ci") / F.col("mean")), "uncbsl_status": F.when(positive, "computed").otherwise("not_applicable_non_positive_mean")}


def unique_interval(df: DataFrame, delta: str = "delta_tC_ha_yr", lon: str = "ref_lon", lat: str = "ref_lat", z: float = Z90, decimals: int = 7, order: Sequence[str] = ()) -> DataFrame:
    """The older rule: controls deduplicated by position, n the number of positions."""
    one = control_rows(df, True, lon, lat, decimals, order)
    d = finite(F.col(delta).cast("double"))
    out = one.select(d.alias("_d")).where("_d is not null").agg(F.count("_d").alias("n"), F.avg("_d").alias("mean"), F.stddev_samp("_d").alias("sd"))
    out = out.withColumns({"se": F.col("sd") / F.sqrt("n"), "ci": F.lit(z) * F.col("sd") / F.sqrt("n")})
    return out.withColumns({"lower": F.col("mean") - F.col("ci"), "upper": F.col("mean") + F.col("ci"), **_ratio()})


def crediting_baseline(interval: DataFrame, area_ha: float, years: float, daf: float = 0.0125, br_gov: float = 0.0, safeguard: bool = True) -> DataFrame:
    """The older extended baseline: mean at least 0, uncertainty 0 where it doesn't apply, credits
    BR = max(BR_unadj (1 + DAF) (1 + UNC), BR_gov) in tCO2e."""
    r = F.greatest(F.col("mean"), F.lit(0.0)) if safeguard else F.col("mean")
    out = interval.withColumn("rate", r).withColumn("unc", F.when(F.col("rate") > 0, F.col("ci") / F.col("rate")).otherwise(F.lit(0.0)))
    out = out.withColumn("br_unadj", F.col("rate") * (area_ha * years * TC_TO_TCO2E))
    return out.withColumn("br_crediting", F.greatest(F.col("br_unadj") * (1 + daf) * (F.lit(1.0) + F.col("unc")), F.lit(float(br_gov))))


def project_summary(df: DataFrame, area_ha: float, delta: str = "delta_tC_ha_yr", lon: str = "proj_lon", lat: str = "proj_lat", decimals: int = 7, by: Sequence[str] = ()) -> DataFrame:
    """Mean change of the project, the area a row stands for, and the total."""
    d = finite(F.col(delta).cast("double"))
    key = F.struct(F.round(lon, decimals), F.round(lat, decimals))
    rows = df.select("*", d.alias("_d")).where("_d is not null")
    out = rows.groupBy(*by).agg(F.count("_d").alias("project_rows"), F.count_distinct(key).alias("project_unique"), F.avg("_d").alias("project_mean"))
    return out.withColumns({"project_area_ha": F.lit(float(area_ha)), "row_area_ha": F.when(F.col("project_rows") > 0, F.lit(float(area_ha)) / F.col("project_rows")), "project_total_yr": F.col("project_mean") * float(area_ha)})


def project_area(df: DataFrame, given: float | None, pixel_ha: float, fallback: bool = False, col: str = "pixel_area_ha") -> float:
    """The given area; only if allowed, the sum of pixel areas (or rows times the pixel's) as a fallback."""
    if given is not None:
        return float(given)
    if not fallback:
        raise ValueError("no project area")
    v = df.agg(F.sum(col)).first()[0] if col in df.columns else None
    return float(v) if v else df.count() * pixel_ha


def find_area(obj, keys: Sequence[str] = ("project_area_ha", "PROJECT_AREA_HA", "area_ha")) -> float | None:
    """The first positive number under one of the keys in nested dicts and lists."""
    if isinstance(obj, dict):
        for k in keys:
            if isinstance(obj.get(k), (int, float)) and obj[k] > 0:
                return float(obj[k])
        obj = list(obj.values())
    if isinstance(obj, list):
        for x in obj:
            if (v := find_area(x, keys)) is not None:
                return v
    return None


def unadjusted_baseline(control: DataFrame, project: DataFrame, years: float | Column, cfg: BaselineConfig = BaselineConfig(), by: Sequence[str] = ()) -> DataFrame:
    """Raw and creditable baseline by year and period, with the interval added, and the surplus.

    Both inputs are one row (or one a group of `by`).
    """
    both = control.join(project, list(by)) if by else control.crossJoin(project)
    y = years if isinstance(years, Column) else F.lit(float(years))
    area, mean = F.col("project_area_ha"), F.col("mean")
    rate = mean if cfg.allow_negative else F.greatest(mean, F.lit(0.0))
    out = both.withColumns({"period_years": y, "rate_raw": mean, "rate": rate})
    positive, negative = F.col("rate") > 0, F.lit(cfg.allow_negative) & (F.col("rate") != 0)
    adjusted = F.when(positive | negative, F.col("rate") + F.col("ci")).otherwise(F.lit(0.0))
    status = F.when(positive, "computed_positive_baseline").when(negative, "computed_negative_baseline_pm_override").otherwise("zeroed_non_positive_baseline")
    out = out.withColumns({
        "bl_raw_yr": F.col("rate_raw") * area,
        "bl_yr": F.col("rate") * area,
        "bl_period": F.col("rate") * area * F.col("period_years"),
        "bl_raw_period": F.col("rate_raw") * area * F.col("period_years"),
        "ci_total_yr": F.col("ci") * area,
        "ci_total_period": F.col("ci") * area * F.col("period_years"),
        "rate_adjusted": adjusted,
        "adjusted_yr": adjusted * area,
        "adjusted_period": adjusted * area * F.col("period_years"),
        "baseline_status": status,
        "project_total_period": F.col("project_total_yr") * F.col("period_years"),
    })
    return out.withColumns({
        "bl_yr_tco2e": F.col("bl_yr") * TC_TO_TCO2E,
        "bl_period_tco2e": F.col("bl_period") * TC_TO_TCO2E,
        "bl_raw_yr_tco2e": F.col("bl_raw_yr") * TC_TO_TCO2E,
        "surplus_yr": F.col("project_total_yr") - F.col("bl_yr"),
        "surplus_period": F.col("project_total_period") - F.col("bl_period"),
        "surplus_raw_yr": F.col("project_total_yr") - F.col("bl_raw_yr"),
        "surplus_raw_period": F.col("project_total_period") - F.col("bl_raw_period"),
    })


def handoff(baseline: DataFrame, daf: float = 0.0125) -> DataFrame:
    """What crediting needs, in tCO2e, with the illustrative BL (1 + DAF) (1 + UNC).

    The unadjusted baseline enters, never the adjusted one, which holds the same uncertainty.
    """
    c = TC_TO_TCO2E
    return baseline.select(
        F.lit(c).alias("tc_to_tco2e"),
        "project_area_ha",
        "period_years",
        F.col("rate").alias("bl_mean"),
        (F.col("rate") * c).alias("bl_mean_tco2e"),
        "bl_period",
        "bl_period_tco2e",
        "uncbsl",
        (F.col("uncbsl") * 100).alias("uncbsl_percent"),
        "uncbsl_status",
        F.col("ci"),
        (F.col("ci") * c).alias("ci_tco2e"),
        "ci_source",
        "project_total_period",
        (F.col("project_total_period") * c).alias("project_total_period_tco2e"),
        F.lit(float(daf)).alias("daf"),
        (F.col("bl_period_tco2e") * (1 + daf) * (F.lit(1.0) + F.coalesce("uncbsl", F.lit(0.0)))).alias("br_illustrative_tco2e"),
    )
