"""Carbon change: units, sampling of carbon tables, and columns of prepared tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapair.config import BaselineConfig, CarbonSpec, Grid
from terrapair.functions.columns import expect_columns, finite, number

# Names that prepared tables use for carbon change and for stocks at both dates.
DELTA_COLUMNS = ("deltaC_control_tC_ha_yr", "deltaC_ref_tC_ha_yr", "deltaC_tC_ha_yr", "delta_C_tC_ha_yr", "dC_tC_ha_yr")
CARBON_PAIRS = (
    ("C_ref_t0_tC_ha", "C_ref_y_tC_ha"), ("C_control_t0_tC_ha", "C_control_y_tC_ha"),
    ("carbon_t0_tC_ha", "carbon_y_tC_ha"), ("C_t0_tC_ha", "C_y_tC_ha"),
)
BIOMASS_PAIRS = (
    ("AGB_ref_t0_Mg_ha", "AGB_ref_y_Mg_ha"), ("AGB_control_t0_Mg_ha", "AGB_control_y_Mg_ha"),
    ("agb_t0_Mg_ha", "agb_y_Mg_ha"), ("AGB_t0_Mg_ha", "AGB_y_Mg_ha"),
)


def conversion_factor(units: str, carbon_fraction: float = 0.47, root_shoot: float = 0.4) -> float:
    """Factor from a stock's units to tC/ha."""
    if units == "tC_ha":
        return 1.0
    if units == "AGB_Mg_ha":
        return carbon_fraction * (1 + root_shoot)
    raise ValueError(f"unknown stock units: {units}")


def monitoring_period(cfg: BaselineConfig) -> int:
    """Years between the dates, which must be later, agree with an explicit period and be long enough."""
    years = cfg.monitoring_year - cfg.t0_year
    if years <= 0:
        raise ValueError("the monitoring year must be after the start")
    if cfg.period_years is not None and cfg.period_years != years:
        raise ValueError(f"period of {cfg.period_years} years, but the dates are {years} apart")
    if years < cfg.min_period:
        raise ValueError(f"a period of {years} years is below the minimum of {cfg.min_period}")
    return years


def cell_of(df: DataFrame, grid: Grid, x: str, y: str) -> DataFrame:
    """Adds grid_row and grid_col of a position, null where it isn't finite."""
    return df.withColumns({"grid_row": F.floor((F.lit(grid.y0) - finite(y)) / grid.dy).cast("int"), "grid_col": F.floor((finite(x) - grid.x0) / grid.dx).cast("int")})


def sample(points: DataFrame, raster: DataFrame, value: str, out: str) -> DataFrame:
    """Adds a raster's value at each point's cell; null off the raster or where it has none.

    A left equi-join on the cell. Cells are distinct in a raster, so no point is repeated;
    whether a side is broadcast is for the planner, by its statistics.
    """
    cells = raster.select("grid_row", "grid_col", finite(F.col(value).cast("double")).alias(out))
    return points.join(cells, ["grid_row", "grid_col"], "left")


def stock_change(points: DataFrame, at_start: DataFrame, at_end: DataFrame, years: float, spec: CarbonSpec = CarbonSpec(), value: str = "value", prefix: str = "C") -> DataFrame:
    """Adds both converted stocks, their raw values, and delta_tC_ha_yr = (end - start) / years."""
    f = conversion_factor(spec.units, spec.carbon_fraction, spec.root_shoot)
    out = sample(sample(points, at_start, value, f"{prefix}_t0_raw"), at_end, value, f"{prefix}_y_raw")
    out = out.withColumns({f"{prefix}_t0_tC_ha": F.col(f"{prefix}_t0_raw") * f, f"{prefix}_y_tC_ha": F.col(f"{prefix}_y_raw") * f})
    return out.withColumn("delta_tC_ha_yr", (F.col(f"{prefix}_y_tC_ha") - F.col(f"{prefix}_t0_tC_ha")) / float(years))


def direct_change(points: DataFrame, delta: DataFrame, value: str = "value") -> DataFrame:
    """Adds delta_tC_ha_yr from a table of yearly change."""
    return sample(points, delta, value, "delta_tC_ha_yr")


def change(points: DataFrame, spec: CarbonSpec, years: float, delta: DataFrame | None = None, start: DataFrame | None = None, end: DataFrame | None = None, stack: DataFrame | None = None, t0: int | None = None, t1: int | None = None) -> DataFrame:
    """Carbon change by the specification's mode: "delta", "two_stock" or "stack" (with a year column)."""
    if spec.mode == "delta" and delta is not None:
        return direct_change(points, delta)
    if spec.mode == "stack" and stack is not None:
        start, end = stack.where(F.col("year") == t0), stack.where(F.col("year") == t1)
    if spec.mode in ("two_stock", "stack") and start is not None and end is not None:
        return stock_change(points, start, end, years, spec)
    raise ValueError(f"tables for mode {spec.mode} are missing")


def position_key(df: DataFrame, lon: str, lat: str, decimals: int = 7) -> DataFrame:
    """Adds key_lon and key_lat, rounded numbers; rows without them go."""
    return df.withColumns({"key_lon": F.round(number(lon), decimals), "key_lat": F.round(number(lat), decimals)}).where("key_lon is not null and key_lat is not null")


def join_by_position(locked: DataFrame, table: DataFrame, lon: str = "ref_lon", lat: str = "ref_lat", order: Sequence[str] = ()) -> DataFrame:
    """The locked controls with a carbon table's columns; of repeated positions the first row counts.

    Columns that the table supplies replace those of the controls.
    """
    t_lon, t_lat = (lon, lat) if lon in table.columns else ("lon", "lat")
    supplied = [c for c in table.columns if c not in (t_lon, t_lat)]
    right = position_key(table, t_lon, t_lat).select("key_lon", "key_lat", *supplied)
    by = F.struct(*(order or supplied))
    right = right.groupBy("key_lon", "key_lat").agg(F.min_by(F.struct(*supplied), by).alias("_t"))
    left = position_key(locked, lon, lat).drop(*[c for c in supplied if c in locked.columns])
    joined = left.join(right, ["key_lon", "key_lat"], "left")
    return joined.select("*", *[F.col(f"_t.{c}").alias(c) for c in supplied]).drop("_t")


def delta_column(df: DataFrame, years: float, carbon_fraction: float = 0.47, root_shoot: float = 0.0) -> Column:
    """Carbon change of a prepared table: a direct column, else a pair of carbon stocks, else of biomass.

    Chosen when the plan is made, from the columns there are. Stocks are also taken under their names
    without the units, which the method itself doesn't do; names with units win.
    """
    have = set(df.columns)
    for c in DELTA_COLUMNS:
        if c in have:
            return number(c)
    for pairs, suffix, factor in ((CARBON_PAIRS, "_tC_ha", 1.0), (BIOMASS_PAIRS, "_Mg_ha", conversion_factor("AGB_Mg_ha", carbon_fraction, root_shoot))):
        for a, b in pairs:
            for cut in (0, len(suffix)):  # with or without the units in their names
                first, last = a[: len(a) - cut], b[: len(b) - cut]
                if first in have and last in have:
                    return (number(last) - number(first)) * factor / float(years)
    raise ValueError("no carbon change, carbon stock or biomass columns")


def with_blocks(df: DataFrame, size: float, x: str | None = None, y: str | None = None) -> DataFrame:
    """Adds block_id ``floor(x / size)_floor(y / size)``, null without a finite position.

    Without names, the first pair of position columns there is: ref_x_utm, donor_x_utm, x_utm,
    cell bounds.
    """
    if x is None:
        options = [("ref_x_utm", "ref_y_utm"), ("donor_x_utm", "donor_y_utm"), ("x_utm", "y_utm"), ("ref_cell_xmin", "ref_cell_ymin"), ("cell_xmin", "cell_ymin")]
        found = next((o for o in options if o[0] in df.columns and o[1] in df.columns), None)
        if found is None:
            raise ValueError("no position columns for blocks")
        x, y = found
    expect_columns(df, [x, y], "blocks")
    fx, fy = finite(F.col(x).cast("double")), finite(F.col(y).cast("double"))
    name = F.concat_ws("_", F.floor(fx / size).cast("string"), F.floor(fy / size).cast("string"))
    return df.withColumn("block_id", F.when(fx.isNotNull() & fy.isNotNull(), name))
