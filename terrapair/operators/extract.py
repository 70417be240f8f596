"""Pixel tables: valid cells, geometry columns, filters, clips, deduplication and sampling."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapair.config import NOT_COVARIATES, WRB_TO_TEXTURE, ExtractConfig, Grid
from terrapair.functions.columns import all_finite, expect_columns, is_finite
from terrapair.functions.quantiles import exact_quantiles

_YEAR = re.compile(r"^NDVI_(\d{4})$")


def series_columns(names: Sequence[str]) -> list[tuple[int, str]]:
    """(year, column) of the yearly bands, in order."""
    return sorted((int(m[1]), n) for n in names if (m := _YEAR.match(n)))


def t0_year(names: Sequence[str]) -> int:
    years = series_columns(names)
    if not years:
        raise ValueError("no yearly bands")
    return years[-1][0] + 1


def covariates(bands: Sequence[str]) -> list[str]:
    """Continuous covariates among the bands of a stack."""
    return [b for b in bands if b not in NOT_COVARIATES and not _YEAR.match(b) and not re.match(r"^band_\d+$", b)]


def valid_cells(df: DataFrame, bands: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """Cells whose bands are all present and finite; `optional` bands may be missing."""
    return df.where(all_finite([b for b in bands if b not in optional]))


#: Rows that are looked at first to tell whether masks leave any.
PROBE = 1000


def with_geometry(df: DataFrame, grid: Grid, tile: Column | None = None, row: str = "grid_row", col: str = "grid_col") -> DataFrame:
    """Adds cell centre, bounds and pixel_id. Rows and columns are those of the whole raster,
    so ids mean the same for every extent."""
    x, y = F.lit(grid.x0) + (F.col(col) + 0.5) * grid.dx, F.lit(grid.y0) - (F.col(row) + 0.5) * grid.dy
    out = df.withColumns({"x_utm": x, "y_utm": y})
    half_x, half_y = grid.dx / 2, grid.dy / 2
    out = out.withColumns({"cell_xmin": F.col("x_utm") - half_x, "cell_ymin": F.col("y_utm") - half_y, "cell_xmax": F.col("x_utm") + half_x, "cell_ymax": F.col("y_utm") + half_y})
    tile = F.col("source_tile") if tile is None else tile
    return out.withColumn("pixel_id", F.format_string("%s::r%d::c%d", tile, F.col(row), F.col(col)))


def bbox(df: DataFrame, x: str = "x_utm", y: str = "y_utm") -> tuple[float, float, float, float] | None:
    """(xmin, ymin, xmax, ymax): one partial aggregate, then literals that reach the scan."""
    r = df.agg(F.min(x), F.min(y), F.max(x), F.max(y)).first()
    return None if r is None or r[0] is None else tuple(map(float, r))


def exclude_bbox_edges(df: DataFrame, grid: Grid, n_pixels: int = 1) -> DataFrame:
    """Without the cells closer than n_pixels to the bounding box of the table's centres."""
    box = bbox(df)
    if box is None:
        return df
    mx, my = n_pixels * grid.dx, n_pixels * grid.dy
    return df.where(F.col("x_utm").between(box[0] + mx, box[2] - mx) & F.col("y_utm").between(box[1] + my, box[3] - my))


def clip_to_extent(donors: DataFrame, box: tuple[float, float, float, float], extent_km: float | str) -> DataFrame:
    """Donors within extent_km of the project's box; "full" keeps all. Literal bounds prune row groups."""
    if extent_km == "full":
        return donors
    m = float(extent_km) * 1000
    return donors.where(F.col("x_utm").between(box[0] - m, box[2] + m) & F.col("y_utm").between(box[1] - m, box[3] + m))


def mask_keys(df: DataFrame, grid: Grid, x: str = "x_utm", y: str = "y_utm") -> DataFrame:
    """Adds the mask cell (mask_row, mask_col) of a position."""
    return df.withColumns({"mask_row": F.floor((F.lit(grid.y0) - F.col(y)) / grid.dy).cast("int"), "mask_col": F.floor((F.col(x) - grid.x0) / grid.dx).cast("int")})


def filter_by_mask(df: DataFrame, mask: DataFrame, grid: Grid, inside: bool) -> DataFrame:
    """Rows inside (or outside) a mask of distinct (mask_row, mask_col); off the grid is outside."""
    keyed = mask_keys(df, grid)
    kept = keyed.join(mask.select("mask_row", "mask_col"), ["mask_row", "mask_col"], "left_semi" if inside else "left_anti")
    return kept.select(*df.columns)


def _any_left(keyed: DataFrame, masks: Sequence[tuple[DataFrame, bool]]) -> bool:
    """Whether rows with their mask cells pass all masks: a few rows tell it mostly, else all do."""
    few = keyed.select("mask_row", "mask_col").limit(PROBE).distinct().collect()
    if not few:
        return False
    some = keyed.sparkSession.createDataFrame(few, keyed.select("mask_row", "mask_col").schema)
    for mask, inside in masks:
        here = mask.select("mask_row", "mask_col").join(F.broadcast(some), ["mask_row", "mask_col"], "left_semi")
        some = some.join(here, ["mask_row", "mask_col"], "left_semi" if inside else "left_anti")
    return not some.isEmpty() or not _masked(keyed, masks).isEmpty()


def _masked(keyed: DataFrame, masks: Sequence[tuple[DataFrame, bool]]) -> DataFrame:
    for mask, inside in masks:
        keyed = keyed.join(mask.select("mask_row", "mask_col"), ["mask_row", "mask_col"], "left_semi" if inside else "left_anti")
    return keyed


def apply_masks(df: DataFrame, kind: str, grid: Grid, forest: DataFrame | None, eligible: DataFrame | None, cfg: ExtractConfig) -> DataFrame:
    """Mask chain: donors inside the eligible area, then both sides by the forest rule.

    Mask cells are found once, so that all masks meet the rows in one exchange.
    """
    masks = [(eligible, True)] if kind == "donor" and eligible is not None else []
    masks += [(forest, cfg.forest_mode == "keep_inside")] if forest is not None else []
    keyed = mask_keys(df, grid)
    if not _any_left(keyed, masks):
        raise ValueError(f"no {kind} pixels are left after the masks")
    return _masked(keyed, masks).select(*df.columns) if masks else df


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row a key, the first by `order`: a partial aggregate of structs, no sort of groups."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_row")) if rest or order else df.dropDuplicates(list(keys))
    return picked.select("_row.*")


def stratified_sample(df: DataFrame, cell_m: float, key: Sequence[str], seed: int | None = 42) -> DataFrame:
    """One pixel a sampling cell; by a seeded hash of `key`, or by `key` itself with no seed."""
    cells = df.withColumns({"_gx": F.floor(F.col("x_utm") / cell_m), "_gy": F.floor(F.col("y_utm") / cell_m)})
    order = F.struct(*([F.xxhash64(F.lit(seed), *key)] if seed is not None else []), *key)
    return cells.groupBy("_gx", "_gy").agg(F.min_by(F.struct(*df.columns), order).alias("_row")).select("_row.*")


def spatial_sample(df: DataFrame, cfg: ExtractConfig, key: Sequence[str]) -> DataFrame:
    """The optional project sample: only if enabled and above its size."""
    if not cfg.sample_spatially or df.count() <= cfg.sample_above:
        return df
    return stratified_sample(df, cfg.sample_cell_m, key, cfg.seed)


def assign_texture(df: DataFrame, code: str = "WRB2_CODE", out: str = "texture_class", classes: dict[int, str] | None = None) -> DataFrame:
    """Class of a code by a literal map; rows without a class go."""
    pairs = [F.lit(x) for kv in (classes or dict(WRB_TO_TEXTURE)).items() for x in kv]
    return df.withColumn(out, F.create_map(*pairs)[F.col(code).cast("int")]).where(F.col(out).isNotNull())


def quantile_bounds(project: DataFrame, covs: Sequence[str], low: float = 0.01, high: float = 0.99, share: float = 0.2, floor: float = 1e-6) -> dict[str, tuple[float, float]]:
    """[q_low - buffer, q_high + buffer] of each covariate over the project, by exact quantiles."""
    out = {}
    for c, found in exact_quantiles(project, covs, [low, high]).items():
        if found is None:
            continue
        lo, hi = found
        buffer = max(share * (hi - lo), floor)
        out[c] = (lo - buffer, hi + buffer)
    return out


def prefilter(donors: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Donors within all bounds: one conjunction of literals that reaches the scan."""
    for c, (lo, hi) in bounds.items():
        donors = donors.where(F.col(c).between(lo, hi))
    return donors


def stratified_cap(donors: DataFrame, target: int, strata: str, key: Sequence[str], seed: int | None = 42) -> DataFrame:
    """At most `target` donors with every stratum's share kept: max(1, round(n * share)) a stratum.

    Rows of a stratum are taken in the order of a seeded hash of `key` (of `key` itself
    without a seed); then the whole is trimmed by the same order. With a seed, only rows whose hash
    is below a threshold a little above their stratum's quota are sorted, a quota's worth
    and not the stratum; the trim is a top-k by partitions.
    """
    sizes = {r[0]: r[1] for r in donors.groupBy(strata).count().collect()}  # a handful of classes
    total = sum(sizes.values())
    if total <= target:
        return donors
    quotas = {s: min(n, max(1, round(n * target / total))) for s, n in sizes.items()}
    pick = lambda of: F.coalesce(*[F.when(F.col(strata).eqNullSafe(F.lit(s)), F.lit(of(s))) for s in sizes])
    order = [F.col(k) for k in key]
    near = donors
    if seed is not None:
        hash_ = F.xxhash64(F.lit(seed), *key)
        order = [hash_, *order]
        # of n hashes, at least a quota lies below this but for one case in 10**12
        share = {s: min(1.0, (q + 8 * math.sqrt(q) + 40) / sizes[s]) for s, q in quotas.items()}
        near = donors.where(hash_ <= pick(lambda s: min((1 << 63) - 1, int(-(1 << 63) + share[s] * (1 << 64)))))
    w = Window.partitionBy(strata).orderBy(*order)
    kept = near.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= pick(lambda s: quotas[s]))
    over = sum(quotas.values()) > target
    kept = kept.orderBy(*order).limit(target) if over else kept
    return kept.drop("_rank")


def valid_year_histogram(df: DataFrame, col: str = "ndvi_valid_years") -> DataFrame:
    return df.groupBy(col).count().orderBy(col)


def histogram_2d(df: DataFrame, x: str, y: str, size: float) -> DataFrame:
    """Counts of square bins, densest first; the densest cell is the first row."""
    bins = df.where(is_finite(x) & is_finite(y)).groupBy(F.floor(F.col(x) / size).alias("bin_x"), F.floor(F.col(y) / size).alias("bin_y")).agg(F.count(F.lit(1)).alias("n"))
    return bins.orderBy(F.desc("n"), "bin_x", "bin_y")


def histogram(df: DataFrame, c: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Counts over equal bins of [lo, hi]; the last one is closed, values outside are left out."""
    width = (hi - lo) / bins
    inside = df.where(is_finite(F.col(c).cast("double")) & F.col(c).between(lo, hi))
    b = F.least(F.floor((F.col(c) - lo) / width), F.lit(bins - 1))
    return inside.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def area_ratio(project: DataFrame, donors: DataFrame, project_ha: float, donor_ha: float, least: float = 3.0) -> DataFrame:
    """One row: counts, areas, their ratio and whether the donor area reaches `least` times the project's."""
    p, d = project.agg(F.count(F.lit(1)).alias("project_n")), donors.agg(F.count(F.lit(1)).alias("donor_n"))
    out = p.crossJoin(d).withColumns({"project_ha": F.col("project_n") * project_ha, "donor_ha": F.col("donor_n") * donor_ha})
    return out.withColumns({"ratio_area": F.when(F.col("project_ha") > 0, F.col("donor_ha") / F.col("project_ha")), "meets_ratio": F.col("donor_ha") >= least * F.col("project_ha")})


def band_summary(df: DataFrame, bands: Sequence[str]) -> DataFrame:
    """min, max, mean and valid count of each band, in one scan."""
    aggs = []
    for b in bands:
        v = F.when(is_finite(F.col(b).cast("double")), F.col(b).cast("double"))
        aggs += [F.min(v).alias(f"{b}_min"), F.max(v).alias(f"{b}_max"), F.avg(v).alias(f"{b}_mean"), F.count(v).alias(f"{b}_n")]
    rows = ", ".join(f"'{b}', `{b}_min`, `{b}_max`, `{b}_mean`, `{b}_n`" for b in bands)
    return df.agg(*aggs).selectExpr(f"stack({len(bands)}, {rows}) as (band, min, max, mean, valid)")


def require(df: DataFrame, names: Sequence[str], step: str) -> DataFrame:
    expect_columns(df, names, step)
    return df
