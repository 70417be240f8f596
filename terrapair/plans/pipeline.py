"""The whole run: extract, match, test trends, lock the reference area, compute the baseline."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapair.config import RunConfig
from terrapair.operators import area, balance, baseline, carbon, extract, matching, polygons, sweep, trend
from terrapair.sources import tables


def shared_store(spark: SparkSession, name: str = "stage") -> Callable[[DataFrame], DataFrame]:
    """A function that writes a frame into the folder of spark.checkpoint.dir and reads it back,
    which cuts lineage with files that outlive executors."""
    root = tables.shared_dir(spark)

    def store(df: DataFrame) -> DataFrame:
        path = f"{root}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return store


@dataclass
class Inputs:
    """Pixel tables and masks of a run, and the carbon tables of its last step."""

    project: DataFrame
    donors: DataFrame
    forest: DataFrame | None = None
    eligible: DataFrame | None = None
    carbon_start: DataFrame | None = None
    carbon_end: DataFrame | None = None
    carbon_delta: DataFrame | None = None


@dataclass
class Run:
    """Frames and figures of a run; later parts are None if it stopped before them."""

    config: RunConfig
    project: DataFrame
    donors: DataFrame
    ratio: DataFrame
    matching: matching.Matching | None = None
    pairs: DataFrame | None = None
    smd: DataFrame | None = None
    audit: DataFrame | None = None
    covariates: DataFrame | None = None
    selection: trend.Selection | None = None
    cells: DataFrame | None = None
    manifest: dict | None = None
    baseline: DataFrame | None = None


def extraction(inputs: Inputs, cfg: RunConfig, store: Callable) -> Run:
    """Step 1: edges, sampling and masks of the project; clip and masks of the donors; textures."""
    p, grid, x = inputs.project, cfg.grid, cfg.extract
    n_raw = p.count()
    if x.exclude_edges:
        p = extract.exclude_bbox_edges(p, grid, x.edge_pixels)
    p = extract.spatial_sample(p, x, ["pixel_id"])
    p = store(extract.apply_masks(p, "project", grid, inputs.forest, None, x))
    box = extract.bbox(p)
    d = extract.clip_to_extent(inputs.donors, box, x.extent_km)
    d = store(extract.apply_masks(d, "donor", grid, inputs.forest, inputs.eligible, x))
    ratio = extract.area_ratio(p.sparkSession.range(n_raw), d, grid.cell_ha, grid.cell_ha)
    return Run(cfg, p, d, ratio)


def matched(run: Run, store: Callable) -> Run:
    """Step 2: textures, prefilter, cap, pairs, balance and audit."""
    m = run.config.match
    matching.validate_mandatory(run.project, run.donors, m)
    covs = extract.covariates([c for c, t in run.project.dtypes if t in ("double", "float") and c in run.donors.columns and c not in ("lon", "lat", "x_utm", "y_utm", "cell_xmin", "cell_ymin", "cell_xmax", "cell_ymax")])
    p = extract.assign_texture(run.project).na.drop(subset=covs)
    d = extract.assign_texture(run.donors).na.drop(subset=covs)
    d = extract.prefilter(d, extract.quantile_bounds(p, covs, m.low_quantile, m.high_quantile, m.buffer_fraction, m.buffer_floor))
    if m.donor_cap is not None:
        d = extract.stratified_cap(d, m.donor_cap, "texture_class", ["pixel_id"], m.seed)
    key = F.xxhash64("pixel_id")
    p, d = store(p.withColumn("proj_idx", key)), store(d.withColumn("donor_idx", key))
    limits = matching.calipers(p, m)
    run.matching = matching.match(p, d, covs, limits, "texture_class", m)
    run.project, run.donors = p, d
    run.pairs = store(matching.pair_table(run.matching.pairs, p, d, run.config.effective_id))
    # the matched rows, so a donor counts as often as it was used
    run.smd = balance.smd(p, run.pairs, covs, m.smd_threshold)
    run.audit = balance.audit(run.pairs, ["texture_exact", "all_calipers_passed"])
    run.covariates = balance.covariate_summary(run.pairs, covs)
    return run


def tested(run: Run, store: Callable) -> Run:
    """Step 3: slopes of both sides and the pairs with parallel trends."""
    years = [y for y, _ in extract.series_columns(run.project.columns)]
    pairs = trend.attach_series(run.pairs, run.project, years)
    pairs = store(trend.pair_slopes(pairs, years, run.config.trend))
    run.selection = trend.select_parallel(pairs, years, run.config.trend, "proj_idx")
    run.pairs = store(run.selection.pairs)
    return run


def locked(run: Run, store: Callable) -> Run:
    """Step 4: the reference area of the selected pairs, behind the gate of the trend test."""
    cfg = run.config
    status = area.check_twin(run.selection.compliant, cfg.allow_noncompliant_twin)
    chosen = run.pairs.where("selected")
    cells = chosen.select(F.col("ref_grid_row").alias("grid_row"), F.col("ref_grid_col").alias("grid_col"))
    run.cells = store(area.reference_cells(cells, cfg.grid, cfg.area, store))
    total = run.cells.count() * cfg.grid.cell_ha
    run.manifest = {"run_id": cfg.effective_id, "lock_status": status, "total_ha": total, "twin_mode": run.selection.mode, "twin_compliant": run.selection.compliant, "crs": cfg.grid.crs, "config": asdict(cfg.area)}
    if cfg.root:
        tables.save(run.cells, f"{cfg.root}/{cfg.effective_id}/reference_area")
        outlines = polygons.mask_polygons(run.cells, cfg.grid, store)
        edges = polygons.simplify(polygons.to_edges(outlines, "part"), cfg.area.simplify_m, store)
        tables.save(edges, f"{cfg.root}/{cfg.effective_id}/reference_outlines")
        sums = tables.checksums(run.cells.sparkSession, f"{cfg.root}/{cfg.effective_id}/reference_area.parquet", "*.parquet")
        run.manifest["sha256"] = {r["path"].rsplit("/", 1)[1]: r["sha256"] for r in sums.collect()}  # one row a file
        tables.write_json(run.cells.sparkSession, f"{cfg.root}/{cfg.effective_id}/manifest.json", run.manifest)
    return run


def baselined(run: Run, inputs: Inputs) -> Run:
    """Step 5: carbon change at both sides of the selected pairs, intervals and the baseline."""
    cfg = run.config
    area.check_lock(run.manifest)
    years = carbon.monitoring_period(cfg.baseline)
    tables_ = {"delta": inputs.carbon_delta, "start": inputs.carbon_start, "end": inputs.carbon_end}
    chosen = run.pairs.where("selected")
    ref = chosen.select("ref_lon", "ref_lat", "ref_cell_xmin", "ref_cell_ymin", F.col("ref_grid_row").alias("grid_row"), F.col("ref_grid_col").alias("grid_col"))
    control = carbon.with_blocks(carbon.change(ref, cfg.carbon, years, **tables_), cfg.baseline.block_m)
    cell = run.project.select("proj_idx", "grid_row", "grid_col")
    proj = chosen.select("proj_idx", "proj_lon", "proj_lat").join(cell, "proj_idx")
    project = carbon.change(proj, cfg.carbon, years, **tables_)
    ha = baseline.project_area(project, cfg.project_area_ha, cfg.grid.cell_ha, fallback=cfg.project_area_ha is None)
    run.baseline = baseline.unadjusted_baseline(baseline.control_interval(control, cfg=cfg.baseline), baseline.project_summary(project, ha), years, cfg.baseline)
    return run


def run(inputs: Inputs, cfg: RunConfig, with_baseline: bool = True) -> Run:
    """All steps, each from the stored result of the one before."""
    store = shared_store(inputs.project.sparkSession, cfg.effective_id)
    out = locked(tested(matched(extraction(inputs, cfg, store), store), store), store)
    return baselined(out, inputs) if with_baseline else out


def metrics(out: Run, extent: float | str) -> dict:
    """The figures of one run that the comparison of extents needs."""
    s = out.ratio.first()
    smd = out.smd.agg(F.max("smd")).first()[0]
    return {
        "extent": str(extent), "n_project": out.project.count(), "n_donor": s["donor_n"], "ratio_area": s["ratio_area"], "n_matched": out.pairs.count(), "n_pairs": out.pairs.count(),
        "n_selected": out.pairs.where("selected").count(), "smd_max": float(smd) if smd is not None else None, "twin_compliant": out.selection.compliant, "reference_area_ha": out.manifest["total_ha"],
    }


def compare_extents(inputs: Inputs, cfg: RunConfig, extents=None) -> tuple[DataFrame, list[sweep.Failure]]:
    """A run for each extent; errors become failures and the others go on. Criteria of all."""
    names = extents or ("full", 5, 10, 20, 30)

    def one(extent):
        c = replace(cfg, extract=replace(cfg.extract, extent_km=extent), allow_noncompliant_twin=True)
        return metrics(run(inputs, c, with_baseline=False), extent)

    done, failed = sweep.run_each(names, one)
    schema = "extent string, n_project long, n_donor long, ratio_area double, n_matched long, n_pairs long, n_selected long, smd_max double, twin_compliant boolean, reference_area_ha double"
    rows = [tuple(m[f.split()[0]] for f in schema.split(", ")) for m in done.values()]
    return sweep.extent_criteria(inputs.project.sparkSession.createDataFrame(rows, schema)), failed
