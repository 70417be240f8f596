"""Sweeps: extents and source-by-period batches as single plans, with an extra group key."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapair.config import BaselineConfig, SweepConfig, TrendConfig
from terrapair.operators import balance, baseline, matching, trend
from terrapair.operators.extract import bbox as extract_bbox

FULL = float("inf")


def extent_of(x: Column, y: Column, box: tuple[float, float, float, float]) -> Column:
    """Kilometres by which the project's box must grow to hold a position."""
    zero = F.lit(0.0)
    return F.greatest(F.lit(box[0]) - x, x - F.lit(box[2]), F.lit(box[1]) - y, y - F.lit(box[3]), zero) / 1000


def tag_extents(donors: DataFrame, box: tuple[float, float, float, float], extents: Sequence[float | str], x: str = "x_utm", y: str = "y_utm") -> DataFrame:
    """A row for each extent that holds a donor: one scan answers all extents (`extent`, `extent_km`)."""
    known = F.array(*[F.struct(F.lit(str(e)).alias("extent"), F.lit(FULL if e == "full" else float(e)).alias("extent_km")) for e in extents])
    need = extent_of(F.col(x), F.col(y), box)
    tagged = donors.withColumn("_need", need).withColumn("_e", F.explode(known)).where(F.col("_e.extent_km") >= F.col("_need"))
    return tagged.select(*donors.columns, F.col("_e.extent").alias("extent"), F.col("_e.extent_km").alias("extent_km"))


def match_extents(
    project: DataFrame, donors: DataFrame, limits: Sequence[matching.Caliper], cls: str, metric: matching.Metric, extents: Sequence[float | str], balanced: Sequence[str],
    years: Sequence[int] = (), trends: TrendConfig = TrendConfig(), prefix: str = "NDVI_", store: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Metrics of every extent from one matching: n_project, n_donor, n_matched, n_pairs, n_selected, smd_max, twin_compliant.

    Candidates of the same class and, where both sides have it, tenure within all calipers are found once, each
    with the extent that it needs; an extent's pairs are the nearest candidates that it holds. With
    `years`, n_selected and twin_compliant are those of the parallel-trend selection of each extent's pairs
    from both sides' yearly columns; without, both are null, and criteria that need them fail.
    """
    store = store or (lambda df: df.checkpoint())
    box = extract_bbox(project)
    spark = project.sparkSession
    known = spark.createDataFrame([(str(e), FULL if e == "full" else float(e)) for e in extents], "extent string, extent_km double")
    donors = donors.withColumn("need", extent_of(F.col("x_utm"), F.col("y_utm"), box))
    tenure = matching.tenure_column(project, donors)
    cand = matching.candidates_by_bins(project, donors, limits, cls, tenure=tenure).withColumn("distance", matching.whitened_distance(metric))
    series = [F.col(f"{side}_{prefix}{y}").alias(f"{name}_{prefix}{y}") for y in years for side, name in (("p", "proj"), ("d", "ref"))]
    kept = [f"d_{c}" for c in balanced]
    held = cand.join(F.broadcast(known), F.col("d_need") <= F.col("extent_km"))
    best = held.groupBy("extent", F.col("p_proj_idx").alias("proj_idx")).agg(F.min_by(F.struct(*kept, *series), F.struct("distance", "d_donor_idx")).alias("pair")).select("extent", "proj_idx", "pair.*")
    judged = None
    if years:
        best = store(trend.pair_slopes(best, years, trends, prefix))
        found = trend.group_verdicts(best, "extent", years, trends, "proj_idx", prefix)
        judged = spark.createDataFrame([(e, v.compliant, v.n_selected) for e, v in found.items()], "extent string, twin_compliant boolean, n_selected long")
    moments = [f(c).alias(f"{k}_{c}") for c in kept for k, f in (("m", F.avg), ("v", F.var_pop))]
    pairs = best.groupBy("extent").agg(F.count(F.lit(1)).alias("n_matched"), *moments)
    side = project.agg(F.count(F.lit(1)).alias("n_project"), *[f(c).alias(f"{k}_{c}") for c in balanced for k, f in (("pm", F.avg), ("pv", F.var_pop))])
    count = donors.join(F.broadcast(known), F.col("need") <= F.col("extent_km")).groupBy("extent").agg(F.count(F.lit(1)).alias("n_donor"))
    out = count.join(pairs, "extent", "left").crossJoin(side)  # one row
    if judged is not None:
        out = out.join(judged, "extent", "left").fillna({"n_selected": 0, "twin_compliant": False})
    else:
        out = out.withColumns({"n_selected": F.lit(None).cast("long"), "twin_compliant": F.lit(None).cast("boolean")})
    smd = [balance.difference(F.col(f"pm_{c}"), F.col(f"pv_{c}"), F.col(f"m_d_{c}"), F.col(f"v_d_{c}")) for c in balanced]
    largest = F.round(F.greatest(*smd) if len(smd) > 1 else smd[0], 4)
    matched = F.coalesce("n_matched", F.lit(0))
    return out.select("extent", "n_project", "n_donor", matched.alias("n_matched"), matched.alias("n_pairs"), "n_selected", largest.alias("smd_max"), "twin_compliant")


def comparison_table(criteria: DataFrame, names: Sequence[str]) -> DataFrame:
    """(criterion, extent, cell): PASS or FAIL of each criterion in each extent."""
    rows = ", ".join(f"'{c}', `{c}`" for c in names)
    long = criteria.selectExpr("extent", f"stack({len(names)}, {rows}) as (criterion, ok)")
    return long.select("criterion", "extent", F.when(F.col("ok"), "PASS").otherwise("FAIL").alias("cell"))


def extent_criteria(metrics: DataFrame, cfg: SweepConfig = SweepConfig()) -> DataFrame:
    """Adds the sufficiency criteria of each extent and their conjunction.

    Needs n_project, n_matched, n_pairs, n_selected, smd_max and twin_compliant, and n_donor or
    ratio_area; missing ones fail.
    """
    have = set(metrics.columns)
    get = lambda c, kind: F.col(c) if c in have else F.lit(None).cast(kind)
    ratio = F.coalesce(get("ratio_area", "double"), get("n_donor", "double") / F.greatest(get("n_project", "double"), F.lit(1.0)))
    out = metrics.withColumns({
        "ratio": F.round(ratio, 2),
        "match_coverage_pct": F.round(get("n_matched", "double") / F.greatest(get("n_project", "double"), F.lit(1.0)) * 100, 2),
        "twin_pct": F.round(get("n_selected", "double") / F.greatest(get("n_pairs", "double"), F.lit(1.0)) * 100, 2),
        "_ratio": ratio,
    })
    exact = {
        "ok_ratio": F.col("_ratio") >= cfg.ratio,
        "ok_match": get("n_matched", "double") / F.greatest(get("n_project", "double"), F.lit(1.0)) * 100 >= cfg.coverage_pct,
        "ok_twin": get("n_selected", "double") / F.greatest(get("n_pairs", "double"), F.lit(1.0)) * 100 >= cfg.twin_pct,
        "ok_smd": get("smd_max", "double") <= cfg.smd,
        "ok_compliant": get("twin_compliant", "boolean"),
    }
    out = out.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in exact.items()})
    every = F.col("ok_ratio") & F.col("ok_match") & F.col("ok_twin") & F.col("ok_smd") & F.col("ok_compliant")
    return out.withColumn("all_sufficient", every).drop("_ratio")


def minimum_extent(criteria: DataFrame) -> DataFrame:
    """The smallest sufficient extent ("full" is the largest); no row if there is none."""
    km = F.when(F.col("extent") == "full", F.lit(FULL)).otherwise(F.col("extent").try_cast("double"))
    return criteria.where("all_sufficient").withColumn("_km", km).orderBy("_km").limit(1).drop("_km")


@dataclass(frozen=True)
class Failure:
    name: str
    error: str


def run_each(names: Sequence, run: Callable) -> tuple[dict, list[Failure]]:
    """Run for each name; an error is recorded and the others go on."""
    done, failed = {}, []
    for name in names:
        try:
            done[name] = run(name)
        except Exception as e:  # an extent that fails is a row of the comparison
            failed.append(Failure(str(name), f"{type(e).__name__}: {e}"))
    return done, failed


def periods(spark, sources: Sequence[str], years: Sequence[tuple[int, int]]) -> DataFrame:
    """The plan of a batch: one row a source and period (a dry run shows it)."""
    rows = [(s, a, b) for s in sources for a, b in years]
    return spark.createDataFrame(rows, "source string, t0_year int, monitoring_year int")


def plan_status(plan: DataFrame, carbon: DataFrame) -> DataFrame:
    """The plan with a status for each item: ready, or which carbon table is missing.

    `source_period_batch` has rows for ready items only; this says what became of the others.
    """
    have = carbon.select("source", "year").distinct()
    for name, col in (("start", "t0_year"), ("end", "monitoring_year")):
        plan = plan.join(have.select("source", F.col("year").alias(col), F.lit(True).alias(f"_{name}")), ["source", col], "left")
    status = F.when(F.col("_start").isNull(), "missing_start").when(F.col("_end").isNull(), "missing_end").otherwise("ready")
    return plan.select("source", "t0_year", "monitoring_year", status.alias("status"))


def source_period_batch(points: DataFrame, carbon: DataFrame, plan: DataFrame, factor: Column, area_ha: float, cfg: BaselineConfig = BaselineConfig(), side: str = "side") -> DataFrame:
    """Curated baseline row of every (source, t0_year, monitoring_year) in one job.

    `points` are cells with `side` "control" or "project", positions lon / lat and block_id;
    `carbon` has (grid_row, grid_col, source, year, value). Carbon of the points is joined once;
    both years of a period are taken from a map by year, so nothing is sampled again
    for a period. Sources or years without carbon give no row.
    """
    keys = ["source", "t0_year", "monitoring_year"]
    used = plan.select("source", F.explode(F.array("t0_year", "monitoring_year")).alias("year")).distinct()
    stock = carbon.join(F.broadcast(used), ["source", "year"], "left_semi")
    per = stock.groupBy("source", "grid_row", "grid_col").agg(F.map_from_entries(F.collect_list(F.struct("year", "value"))).alias("stocks"))
    at = points.join(per, ["grid_row", "grid_col"])
    rows = at.join(F.broadcast(plan), "source")
    delta = (F.try_element_at("stocks", F.col("monitoring_year")) - F.try_element_at("stocks", F.col("t0_year"))) * factor / (F.col("monitoring_year") - F.col("t0_year"))
    rows = rows.withColumn("delta_tC_ha_yr", delta).drop("stocks")
    control = baseline.control_interval(rows.where(F.col(side) == "control"), "delta_tC_ha_yr", "lon", "lat", cfg, by=keys, median=False)
    project = baseline.project_summary(rows.where(F.col(side) == "project"), area_ha, "delta_tC_ha_yr", "lon", "lat", cfg.decimals, by=keys)
    out = baseline.unadjusted_baseline(control, project, (F.col("monitoring_year") - F.col("t0_year")).cast("double"), cfg, by=keys)
    return curated(out, keys)


def curated(out: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The comparison columns of a batch row."""
    c = F.lit(44.0 / 12.0)
    return out.select(
        *keys, "period_years", "rate_raw", "rate", "bl_period", "bl_period_tco2e", "project_total_period", (F.col("project_total_period") * c).alias("project_total_period_tco2e"),
        "surplus_period", (F.col("surplus_period") * c).alias("surplus_period_tco2e"), "uncbsl", (F.col("uncbsl") * 100).alias("uncbsl_percent"), "ci", "ci_total_period", "ci_source",
        "n_rows", "n_eff", "project_unique", "project_area_ha", "baseline_status",
    )


@dataclass(frozen=True)
class Batch:
    """What a batch gave: `master` by falling surplus, and a `status` row for every item of the plan."""

    master: DataFrame
    status: DataFrame


def run_batch(points: DataFrame, sources: dict[str, str], years: Sequence[tuple[int, int]], factor: Column, area_ha: float, folder: str | None = None, cfg: BaselineConfig = BaselineConfig(), side: str = "side", store: Callable[[DataFrame], DataFrame] | None = None) -> Batch:
    """`source_period_batch` over carbon tables at paths, where one bad source doesn't end the others.

    An item's status is done, empty (no row for lack of values), missing_table, missing_start, missing_end, or failed with the
    error's text. All readable sources go through one plan; only if that fails is each run on its own to find out
    which one it is. With `folder` the master table (CSV), its records and a summary of every item (JSON) are saved.
    """
    from terrapair.sources import tables

    spark = points.sparkSession
    store = store or (lambda df: df.checkpoint())
    need = ("grid_row", "grid_col", "year", "value")
    ready: dict[str, DataFrame] = {}
    status: dict[tuple[str, int, int], tuple[str, str | None]] = {}

    def failed(source: str, kind: str, error: str | None) -> None:
        status.update({(source, a, b): (kind, error) for a, b in years})

    for name, path in sources.items():
        if not tables.exists(spark, path):
            failed(name, "missing_table", None)
            continue
        try:
            df = tables.load(spark, path)
            if missing := [c for c in need if c not in df.columns]:
                raise ValueError(f"missing columns {missing}")
            have = {r[0] for r in df.select("year").distinct().collect()}  # a handful of years
        except Exception as e:  # a source that can't be read is a row of the status
            failed(name, "failed", f"{type(e).__name__}: {str(e).splitlines()[0]}")
            continue
        ready[name] = df.select(*need).withColumn("source", F.lit(name))
        for a, b in years:
            lack = "missing_start" if a not in have else "missing_end" if b not in have else None
            if lack:
                status[name, a, b] = (lack, None)

    def rows(names: Sequence[str]) -> DataFrame | None:
        todo = [(n, a, b) for n in names for a, b in years if (n, a, b) not in status]
        if not todo:
            return None
        carbon = ready[names[0]]
        for n in names[1:]:
            carbon = carbon.unionByName(ready[n])
        plan = spark.createDataFrame(todo, "source string, t0_year int, monitoring_year int")
        return store(source_period_batch(points, carbon, plan, factor, area_ha, cfg, side))

    parts: list[DataFrame] = []
    if ready:
        try:
            parts = [x for x in [rows(list(ready))] if x is not None]
        except Exception:  # one of the sources: each on its own
            for n in ready:
                try:
                    parts += [x for x in [rows([n])] if x is not None]
                except Exception as e:
                    failed(n, "failed", f"{type(e).__name__}: {str(e).splitlines()[0]}")
    keys = ["source", "t0_year", "monitoring_year"]
    if parts:
        master = parts[0]
        for x in parts[1:]:
            master = master.unionByName(x)
    else:
        master = source_period_batch(points.limit(0), spark.createDataFrame([], "grid_row int, grid_col int, year int, value double, source string"), periods(spark, [], []), factor, area_ha, cfg, side)
    done = {tuple(r) for r in master.select(*keys).collect()}  # a row an item
    items = [(n, a, b, *status.get((n, a, b), ("done" if (n, a, b) in done else "empty", None))) for n in sources for a, b in years]
    told = spark.createDataFrame(items, "source string, t0_year int, monitoring_year int, status string, error string")
    master = master.orderBy(F.desc_nulls_last("surplus_period"), *keys)
    if folder:
        tables.save(master.coalesce(1), f"{folder}/master", "csv")
        records = {(r["source"], r["t0_year"], r["monitoring_year"]): r.asDict() for r in master.collect()}
        tables.write_json(spark, f"{folder}/master.json", {"records": list(records.values())})
        for n, a, b, state, error in items:
            tables.write_json(spark, f"{folder}/{n}_{a}_{b}.json", {"source": n, "t0_year": a, "monitoring_year": b, "status": state, "error": error, **records.get((n, a, b), {})})
    return Batch(master, told)
