"""Reference area: support cells, their union, monitoring points, vector text and the lock."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapair.config import AreaConfig, Grid
from terrapair.functions.columns import is_finite
from terrapair.functions.projection import to_utm, utm_zone
from terrapair.functions.ranking import global_rank
from terrapair.operators import raster

BOUNDS = ("ref_cell_xmin", "ref_cell_ymin", "ref_cell_xmax", "ref_cell_ymax")


def reference_points(pairs: DataFrame, lon: str = "ref_lon", lat: str = "ref_lat") -> DataFrame:
    """Distinct finite positions of the matched cells; falls back to lon / lat."""
    if lon not in pairs.columns:
        lon, lat = "lon", "lat"
    return pairs.where(is_finite(lon) & is_finite(lat)).select(F.col(lon).alias("lon"), F.col(lat).alias("lat"), *[c for c in (*BOUNDS, "ref_pixel_id", "ref_grid_row", "ref_grid_col") if c in pairs.columns]).dropDuplicates(["lon", "lat"])


def auto_utm(points: DataFrame) -> str:
    r = points.agg(F.avg("lon"), F.avg("lat")).first()
    if r is None or r[0] is None:
        raise ValueError("no finite positions")
    return utm_zone(r[0], r[1])


def with_utm(points: DataFrame, epsg: str | None = None) -> tuple[DataFrame, str]:
    epsg = epsg or auto_utm(points)
    x, y = to_utm(F.col("lon"), F.col("lat"), epsg)
    return points.withColumns({"x": x, "y": y}), epsg


def support_cells(points: DataFrame, cfg: AreaConfig = AreaConfig()) -> DataFrame:
    """Square supports with bounds, area_ha and support_mode.

    ``pixel``: native bounds where a point has them, else half a pixel around it; ``block``:
    distinct blocks of block_m with the number of points in each.
    """
    if cfg.mode == "block":
        b = cfg.block_m
        blocks = points.groupBy(F.floor(F.col("x") / b).alias("bx"), F.floor(F.col("y") / b).alias("by")).agg(F.count(F.lit(1)).alias("n_matched_pts"))
        out = blocks.select((F.col("bx") * b).alias("xmin"), (F.col("by") * b).alias("ymin"), ((F.col("bx") + 1) * b).alias("xmax"), ((F.col("by") + 1) * b).alias("ymax"), "n_matched_pts")
        return _with_area(out.withColumns({"support_mode": F.lit("block"), "support_m": F.lit(float(b))}))
    half = cfg.pixel_m / 2
    centre = [F.col("x") - half, F.col("y") - half, F.col("x") + half, F.col("y") + half]
    if all(c in points.columns for c in BOUNDS):
        native = is_finite(BOUNDS[0]) & is_finite(BOUNDS[1]) & is_finite(BOUNDS[2]) & is_finite(BOUNDS[3])
        edges = [F.when(native, F.col(c)).otherwise(f) for c, f in zip(BOUNDS, centre)]
        mode = F.when(native, "native_bounds").otherwise("centroid")
    else:
        edges, mode = centre, F.lit("centroid")
    out = points.select(*[e.alias(n) for e, n in zip(edges, ("xmin", "ymin", "xmax", "ymax"))], *[c for c in ("ref_pixel_id", "ref_grid_row", "ref_grid_col") if c in points.columns], mode.alias("support_mode"), F.lit(cfg.pixel_m).alias("support_m"))
    return _with_area(out)


def _with_area(df: DataFrame) -> DataFrame:
    return df.withColumn("area_ha", (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin")) / 1e4)


def numbered(df: DataFrame, name: str, first: str, *ties: str) -> DataFrame:
    """1-based ids in a stable order of values."""
    return global_rank(df, first, *ties, out=name)


def reference_cells(cells: DataFrame, grid: Grid, cfg: AreaConfig = AreaConfig(), store: Callable | None = None) -> DataFrame:
    """The reference area as distinct grid cells: union, optional buffer, closing and minimum polygon."""
    out = cells.select(F.col("grid_row").cast("int"), F.col("grid_col").cast("int")).distinct()
    if cfg.buffer_cells > 0:
        out = raster.dilate(out, cfg.buffer_cells)
    elif cfg.buffer_cells < 0:
        out = raster.erode(out, -cfg.buffer_cells)
    if cfg.closing_cells:
        out = raster.close(out, cfg.closing_cells)
    return raster.keep_large_components(out, grid, cfg.min_polygon_ha, store)


def area_summary(points: DataFrame, cells: DataFrame, grid: Grid) -> DataFrame:
    """One row: number of cells, their area, points and how many of them are in the area."""
    area = cells.select(*raster.CELL).distinct()
    inside = points.join(area, list(raster.CELL), "left_semi").agg(F.count(F.lit(1)).alias("n_in"))
    out = area.agg(F.count(F.lit(1)).alias("n_cells")).crossJoin(points.agg(F.count(F.lit(1)).alias("n_points"))).crossJoin(inside)
    return out.withColumns({"total_ha": F.col("n_cells") * grid.cell_ha, "pct_in": F.when(F.col("n_points") > 0, F.col("n_in") / F.col("n_points") * 100)})


def monitoring_lattice(cells: DataFrame, grid: Grid, spacing: float) -> DataFrame:
    """Lattice points (x, y) over the area's box whose cell belongs to the area.

    Only the lattice columns that a row's run of cells can hold are generated, so that the
    lattice of the box is never made.
    """
    box = cells.agg(F.min("grid_col"), F.max("grid_col"), F.min("grid_row"), F.max("grid_row")).first()
    if box is None or box[0] is None:
        return cells.sparkSession.createDataFrame([], "x double, y double, grid_row int, grid_col int")
    xmin, ymin = grid.x0 + box[0] * grid.dx, grid.y0 - (box[3] + 1) * grid.dy
    # lattice indices whose point falls into the cell: index * spacing in [left, right)
    left, low = F.lit(grid.x0) + F.col("grid_col") * grid.dx - xmin, F.lit(grid.y0) - (F.col("grid_row") + 1) * grid.dy - ymin

    def index(start: Column, size: float) -> Column:
        a, b = F.ceil(start / spacing), F.ceil((start + size) / spacing) - 1
        return F.explode(F.when(b >= a, F.sequence(a, b)).otherwise(F.array().cast("array<bigint>")))

    out = cells.select(*raster.CELL).distinct().withColumn("i", index(left, grid.dx)).withColumn("j", index(low, grid.dy))
    return out.select((F.col("i") * spacing + xmin).alias("x"), (F.col("j") * spacing + ymin).alias("y"), *raster.CELL)


def monitoring_points(points: DataFrame, cells: DataFrame, grid: Grid, cfg: AreaConfig = AreaConfig()) -> DataFrame:
    """Matched centres, or a lattice inside the area; an empty lattice falls back to the centres."""
    centres = points.select("x", "y").distinct().withColumn("method", F.lit("matched_pixels"))
    if cfg.monitoring == "matched_pixels":
        return centres
    lattice = monitoring_lattice(cells, grid, cfg.spacing_m).select("x", "y").withColumn("method", F.lit("grid"))
    return centres if lattice.isEmpty() else lattice


def box_wkt(xmin: str = "xmin", ymin: str = "ymin", xmax: str = "xmax", ymax: str = "ymax") -> Column:
    """A square as WKT."""
    p = lambda x, y: F.concat_ws(" ", F.col(x).cast("string"), F.col(y).cast("string"))
    ring = F.concat_ws(", ", p(xmin, ymin), p(xmax, ymin), p(xmax, ymax), p(xmin, ymax), p(xmin, ymin))
    return F.concat(F.lit("POLYGON (("), ring, F.lit("))"))


def geojson(geometry_type: str, coordinates: Column, properties: list[str]) -> Column:
    """A GeoJSON feature as text."""
    geometry = F.struct(F.lit(geometry_type).alias("type"), coordinates.alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*properties).alias("properties")))


def check_twin(compliant: bool, allow: bool = False) -> str:
    """The lock status; refuses a reference area whose twin test isn't compliant."""
    if not compliant and not allow:
        raise ValueError("the twin test is not compliant; allow it explicitly to lock")
    return "LOCKED"


def check_lock(manifest: dict | None) -> None:
    """The baseline needs a locked reference area; a missing manifest is an error."""
    if not manifest or manifest.get("lock_status") != "LOCKED":
        raise ValueError("the reference area is not locked")
