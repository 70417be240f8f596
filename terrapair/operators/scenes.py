"""Satellite scenes to covariates: quality bits, reflectance, index, yearly composites, trend, masks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapair.config import Grid, SceneConfig
from terrapair.functions.columns import is_finite
from terrapair.functions.ols import grouped_ols

#: Quality bits that must be clear: fill, cloud and cloud shadow.
QA_BITS = (0, 3, 4)
SCALE, OFFSET = 0.0000275, -0.2


def clear(qa: Column, saturation: Column, bits: Sequence[int] = QA_BITS) -> Column:
    """All quality bits clear and nothing saturated."""
    mask = reduce(lambda a, b: a | b, (1 << b for b in bits))
    return (qa.bitwiseAND(mask) == 0) & (saturation == 0)


def reflectance(raw: Column) -> Column:
    return raw * SCALE + OFFSET


def index(nir: Column, red: Column, floor: float = 1e-6) -> Column:
    """(nir - red) / (nir + red), null where the sum is almost 0."""
    return F.when(F.abs(nir + red) > floor, (nir - red) / (nir + red))


def collection(scenes: DataFrame, ts: str, first: str, last: str, box: tuple[float, float, float, float], at: tuple[str, str] = ("x", "y"), cfg: SceneConfig = SceneConfig()) -> DataFrame:
    """Scenes from `first` to before `last`, in a box, with little cloud: literals that reach the scan."""
    dated = scenes.where((F.col(ts) >= F.lit(first).cast("timestamp")) & (F.col(ts) < F.lit(last).cast("timestamp")))
    return dated.where(F.col(at[0]).between(box[0], box[2]) & F.col(at[1]).between(box[1], box[3]) & (F.col("cloud_cover") <= cfg.max_cloud))


def prepare(scenes: DataFrame, cfg: SceneConfig = SceneConfig()) -> DataFrame:
    """Cloud-free observations with their index: filters by scene come first and reach the scan."""
    few = scenes.where(F.col("cloud_cover") <= cfg.max_cloud).where(clear(F.col("qa"), F.col("saturation")))
    return few.withColumn("ndvi", index(reflectance(F.col("nir")), reflectance(F.col("red")))).where("ndvi is not null")


def merge_sensors(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.unionByName(second, allowMissingColumns=True)


def season_year(ts: Column, start_month: int = 4) -> Column:
    """Year of the 12 months that begin in start_month and hold ts."""
    return F.year(F.add_months(F.to_date(ts), 1 - start_month))


def annual_composite(obs: DataFrame, keys: Sequence[str], ts: str, value: str, cfg: SceneConfig = SceneConfig()) -> DataFrame:
    """Median by key and season year."""
    return obs.groupBy(*keys, season_year(F.col(ts), cfg.start_month).alias("season")).agg(F.median(value).alias("median"), F.count(value).alias("n"))


def yearly_counts(scenes: DataFrame, ts: str) -> DataFrame:
    """Scenes by calendar year."""
    return scenes.groupBy(F.year(ts).alias("year")).agg(F.count(F.lit(1)).alias("n_scenes"))


def trend(composite: DataFrame, keys: Sequence[str], value: str = "median", season: str = "season") -> DataFrame:
    """Regression slope and number of valid years by key."""
    return composite.groupBy(*keys).agg(*grouped_ols(season, value)).select(*keys, F.col("slope").alias("slope"), F.col("n").alias("valid_years"))


def wide_years(composite: DataFrame, keys: Sequence[str], years: Sequence[int], value: str = "median", season: str = "season", prefix: str = "NDVI_") -> DataFrame:
    """One column a year: conditional aggregates over known years, no discovery pass."""
    cols = [F.max(F.when(F.col(season) == y, F.col(value))).alias(f"{prefix}{y}") for y in years]
    return composite.groupBy(*keys).agg(*cols)


def valid_years(columns: Sequence[str]) -> Column:
    """Number of present and finite yearly bands of a row."""
    return reduce(lambda a, b: a + b, (F.when(is_finite(F.col(c).cast("double")), 1).otherwise(0) for c in columns))


def not_water(occurrence: Column, least: float = 60.0) -> Column:
    """Not permanent water; no observation counts as dry."""
    return F.coalesce(occurrence, F.lit(0)) < least


def valid_covariates(df: DataFrame, covs: Sequence[str], cfg: SceneConfig = SceneConfig(), code: str = "WRB2_CODE", years: str = "ndvi_valid_years") -> DataFrame:
    """Cells with all covariates, enough valid years and a mapped soil group."""
    every = reduce(and_, (is_finite(F.col(c).cast("double")) for c in covs))
    return df.where(every & (F.col(years) >= cfg.min_valid_years) & (F.col(code) > 0) & (F.col(code) != 31))


def flag_sides(df: DataFrame, project: Column, donor: Column, cell_ha: float) -> DataFrame:
    """Constant bands of an export: both side flags and the cell's area."""
    return df.withColumns({"is_project": project.cast("double"), "is_donor": donor.cast("double"), "pixel_area_ha": F.lit(cell_ha)})


def donor_domain(cells: DataFrame, project: DataFrame, regions: DataFrame | None, region_values: dict[str, Sequence[str]], box: tuple[float, float, float, float], buffer_km: float, exclusion_km: float) -> DataFrame:
    """Cells within buffer_km of the project's box, in the wanted regions, and not within
    exclusion_km: intersection as a semi-join, difference as a predicate."""
    from terrapair.operators.sweep import extent_of

    d = extent_of(F.col("x_utm"), F.col("y_utm"), box)
    out = cells.where((d <= buffer_km) & (d > exclusion_km))
    if regions is not None:
        wanted = reduce(and_, (F.col(k).isin(list(v)) for k, v in region_values.items()))
        out = out.join(regions.where(wanted).select("grid_row", "grid_col"), ["grid_row", "grid_col"], "left_semi")
    return out.join(project.select("grid_row", "grid_col"), ["grid_row", "grid_col"], "left_anti")


def donor_ring(cells: DataFrame, project: DataFrame, grid: Grid, regions: DataFrame | None, region_values: dict[str, Sequence[str]], buffer_km: float, exclusion_km: float) -> DataFrame:
    """`cells` within buffer_km of the project's cells, in the wanted regions, and farther than exclusion_km.

    The true buffer of an area of any shape, less the one that is excluded; adds `distance` in metres.
    """
    from terrapair.operators.raster import distance_to_cells

    # only cells in the buffer of the project's box can be in it: literals that reach the scan of either table
    low_row, high_row, low_col, high_col = project.agg(F.min("grid_row"), F.max("grid_row"), F.min("grid_col"), F.max("grid_col")).first()
    down, across = (int(buffer_km * 1000 / size) + 1 for size in (grid.dy, grid.dx))
    inside = F.lit(False) if low_row is None else F.col("grid_row").between(low_row - down, high_row + down) & F.col("grid_col").between(low_col - across, high_col + across)
    cells, regions = cells.where(inside), None if regions is None else regions.where(inside)
    d = distance_to_cells(cells, project, grid, buffer_km * 1000).where((F.col("distance") > exclusion_km * 1000) & (F.col("distance") > 0))
    out = cells.join(d, ["grid_row", "grid_col"])
    if regions is not None:
        wanted = reduce(and_, (F.col(k).isin(list(v)) for k, v in region_values.items()))
        out = out.join(regions.where(wanted).select("grid_row", "grid_col"), ["grid_row", "grid_col"], "left_semi")
    return out


def mask_area(df: DataFrame, mask: Column, area: str = "pixel_area_ha") -> DataFrame:
    return df.agg(F.coalesce(F.sum(F.when(mask, F.col(area))), F.lit(0.0)).alias("area_ha"))


def type_histogram(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
