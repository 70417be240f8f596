"""Matching and balance queries: parts as pixels, every tenth one a project pixel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapair.config import MatchConfig
from terrapair.operators import balance, extract, matching
from terrapair.plans.extract_queries import CLASS_SQL
from terrapair.plans.registry import query, r6, table

COVS = ("p_retailprice", "p_size", "elev")
_PARTS = f"select * from (select p_partkey, p_retailprice, p_size, (p_partkey * 7919) % 101 as elev, {CLASS_SQL} as cls from part) where cls is not null"
_SIDES = f"parts as ({_PARTS}), proj as (select * from parts where p_partkey % 10 = 3), don as (select * from parts where p_partkey % 10 <> 3 and cls <> 'sand'), pool as (select * from proj union all select * from don)"
_STATS = ", ".join(f"avg({c}) m_{c}, stddev_pop({c}) s_{c}" for c in COVS)
_DIST = "round(sqrt(" + " + ".join(f"power((p.{c} - m_{c}) / s_{c} - (d.{c} - m_{c}) / s_{c}, 2)" for c in COVS) + "), 9)"
_RANKED = f"""
stats as (select {_STATS} from pool),
pairs as (select p.p_partkey as proj_idx, d.p_partkey as donor_idx, {_DIST} as distance from proj p, don d, stats),
top as (select *, row_number() over (partition by proj_idx order by distance, donor_idx) as rank from pairs qualify rank <= {{k}})"""
_CAND = f"""
{_RANKED.format(k="greatest(150, least(150, floor(0.95 * (select count(*) from don)), (select count(*) from don)))")},
quota as (select cls, count(*) donor_n, greatest(1, least(150, floor(0.95 * count(*)), count(*))) q from don group by 1),
tol as (select greatest(avg(p_retailprice) * 2e-2, 1e-9) t from proj),
cand0 as (select t.*, p.cls, abs(d.p_retailprice - p.p_retailprice) <= tol.t as ok_price, abs(d.p_size - p.p_size) <= 10 as ok_size, abs(d.elev - p.elev) <= 20 as ok_elev,
          row_number() over (partition by t.proj_idx order by distance, t.donor_idx) as match_rank
          from top t join proj p on t.proj_idx = p.p_partkey join don d on t.donor_idx = d.p_partkey and d.cls = p.cls, tol),
cand as (select c.*, ok_price and ok_size and ok_elev as passed from cand0 c join quota on c.cls = quota.cls where match_rank <= q),
won as (select proj_idx, min(match_rank) filter (where passed) as best, sum((not passed)::int)::bigint as rejected, min(distance) as nearest from cand group by 1),
matched as (select c.proj_idx, c.donor_idx, c.cls, c.distance, c.match_rank, w.rejected from cand c join won w on c.proj_idx = w.proj_idx and c.match_rank = w.best)"""


def sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_size", (F.col("p_partkey") * 7919 % 101).alias("elev"), (F.col("p_partkey") % 33).alias("code"))
    p = extract.assign_texture(p, "code", "cls").drop("code")
    return p.where("p_partkey % 10 = 3").withColumnRenamed("p_partkey", "proj_idx"), p.where("p_partkey % 10 <> 3 and cls <> 'sand'").withColumnRenamed("p_partkey", "donor_idx")


def limits(project: DataFrame) -> list[matching.Caliper]:
    mean = project.agg(F.avg("p_retailprice")).first()[0] or 0.0
    return [matching.Caliper("p_retailprice", max(mean * 0.02, 1e-9)), matching.Caliper("p_size", 10.0), matching.Caliper("elev", 20.0)]


def run(spark: SparkSession, sf_dir: str, mode: str = "reference") -> matching.Matching:
    project, donors = sides(spark, sf_dir)
    metric = matching.fit_metric(project, donors, COVS, whitening="standard")
    return matching.match(project, donors, COVS, limits(project), "cls", MatchConfig(mode=mode), metric)


@query(f"with {_SIDES} select c.covariate, round(c.m, 6) as mean, round(c.s, 6) as std from (select {_STATS} from pool), lateral (values " + ", ".join(f"('{c}', m_{c}, s_{c})" for c in COVS) + ") c(covariate, m, s)")
def standardize_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = matching.moments(matching.pooled(*sides(spark, sf_dir), COVS, None, 0), COVS)
    rows = [(c, float(a), float(b)) for c, a, b in zip(COVS, m.mean, m.std)]
    return spark.createDataFrame(rows, "covariate string, mean double, std double").select("covariate", r6("mean"), r6("std"))


_PAIRS = [(COVS[i], COVS[j]) for i in range(3) for j in range(i, 3)]


@query(f"with {_SIDES} select c.a, c.b, round(c.v, 6) + 0 as cov from (select " + ", ".join(f"covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})) v{i}" for i, (a, b) in enumerate(_PAIRS)) + " from pool), lateral (values " + ", ".join(f"('{a}', '{b}', v{i})" for i, (a, b) in enumerate(_PAIRS)) + ") c(a, b, v)")
def covariance_gram(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = matching.moments(matching.pooled(*sides(spark, sf_dir), COVS, None, 0), COVS)
    rows = [(a, b, float(m.cov[COVS.index(a), COVS.index(b)])) for a, b in _PAIRS]
    return spark.createDataFrame(rows, "a string, b string, cov double").select("a", "b", r6("cov"))


_Z = ", ".join(f"({c} - m_{c}) / s_{c} as z{i}" for i, c in enumerate(COVS))
_S = {(i, j): f"avg(z{i} * z{j})" for i in range(3) for j in range(3)}


@query(f"""
with {_SIDES}, stats as (select {_STATS} from pool), z as (select {_Z} from pool, stats),
s as (select count(*) n, sum(power(z0 * z0 + z1 * z1 + z2 * z2, 2)) f, {" + ".join(f"power({v}, 2)" for v in _S.values())} s2, {" + ".join(_S[i, i] for i in range(3))} tr from z),
e as (select *, tr / 3 mu, (s2 - 2 * (tr / 3) * tr + 3 * power(tr / 3, 2)) / 3 delta, (f / n - s2) / (n * 3) b0 from s)
select n, round(case when least(b0, delta) <= 0 then 0 else least(b0, delta) / delta end, 6) as shrinkage from e""")
def ledoit_wolf_shrinkage(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = matching.moments(matching.pooled(*sides(spark, sf_dir), COVS, None, 0), COVS)
    return spark.createDataFrame([(m.n, float(matching.ledoit_wolf(m)[1]))], "n long, shrinkage double").select("n", r6("shrinkage"))


@query(f"with {_SIDES}, {_RANKED.format(k=5)} select proj_idx, donor_idx, rank::int as rank, round(distance, 6) as distance from top")
def whitened_knn_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    project, donors = sides(spark, sf_dir)
    metric = matching.fit_metric(project, donors, COVS, whitening="standard")
    return matching.knn(project, donors, metric, 5).select("proj_idx", "donor_idx", "rank", r6("distance"))


@query(f"with {_SIDES}, {_CAND} select proj_idx, donor_idx, match_rank::int as match_rank, round(distance, 6) as match_distance, rejected from matched")
def caliper_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir).pairs.select(F.col("p_proj_idx").alias("proj_idx"), F.col("d_donor_idx").alias("donor_idx"), "match_rank", r6("match_distance"), "rejected")


@query(f"""
with {_SIDES}, stats as (select {_STATS} from pool), tol as (select greatest(avg(p_retailprice) * 2e-2, 1e-9) t from proj),
c as (select p.p_partkey as proj_idx, d.p_partkey as donor_idx, {_DIST} as distance from proj p join don d on p.cls = d.cls, stats, tol where abs(d.p_retailprice - p.p_retailprice) <= t and abs(d.p_size - p.p_size) <= 10 and abs(d.elev - p.elev) <= 20)
select proj_idx, donor_idx, round(distance, 6) as match_distance from c qualify row_number() over (partition by proj_idx order by distance, donor_idx) = 1""")
def caliper_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, "caliper_first").pairs.select(F.col("p_proj_idx").alias("proj_idx"), F.col("d_donor_idx").alias("donor_idx"), r6("match_distance"))


_REASON = "case when q.cls is null then 'no_texture_donor' when w.proj_idx is null then 'no_texture_compatible_in_knn' when w.best is null then 'no_candidate_passed_hard_calipers' end"


@query(f"""
with {_SIDES}, {_CAND}
select * from (select p.p_partkey as proj_idx, p.cls as proj_texture, {_REASON} as reason, case when w.proj_idx is not null and w.best is null then q.q::int end as queried_n
from proj p left join quota q on p.cls = q.cls left join won w on p.p_partkey = w.proj_idx) where reason is not null""")
def caliper_unmatched_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir).unmatched


@query(f"""
with {_SIDES}, {_CAND}
select proj_idx, donor_idx, (row_number() over (partition by donor_idx order by cls, proj_idx))::int as donor_use, row_number() over (partition by donor_idx order by cls, proj_idx) > 1 as reuse_exceeded from matched""")
def donor_reuse_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir).pairs.select(F.col("p_proj_idx").alias("proj_idx"), F.col("d_donor_idx").alias("donor_idx"), "donor_use", "reuse_exceeded")


@query(f"""
with {_SIDES}, {_CAND}
select p.cls, count(*) as proj_n, coalesce(any_value(q.donor_n), 0) as donor_n, any_value(q.q)::int as k_query, count(q.cls) > 0 as exact_texture, count(w.best) as matched_n, count(*) - count(w.best) as unmatched_n, coalesce(sum(w.rejected), 0)::bigint as rejected_total, round(avg(w.nearest), 6) as mean_nn_dist
from proj p left join quota q on p.cls = q.cls left join won w on p.p_partkey = w.proj_idx group by 1""")
def class_match_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir).summary.withColumn("mean_nn_dist", r6("mean_nn_dist"))


@query(f"""
with {_SIDES}, {_CAND}
select c.criterion, count(*) as n, sum(c.ok::int)::bigint as passed_n, round(sum(c.ok::int) / count(*)::double * 100, 6) as passed_pct from cand, lateral (values ('ok_price', ok_price), ('ok_size', ok_size), ('ok_elev', ok_elev), ('passed', passed)) c(criterion, ok) group by 1""")
def caliper_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    project, _ = sides(spark, sf_dir)
    names = dict(zip(("ok_price", "ok_size", "ok_elev"), limits(project)))
    cand = run(spark, sf_dir).candidates.withColumns({k: matching.within(c, f"p_{c.column}", f"d_{c.column}") for k, c in names.items()})
    return balance.audit(cand, [*names, "passed"]).withColumn("passed_pct", r6("passed_pct"))


@query(None)
def enforced_reuse_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terrapair.plans.pipeline import shared_store

    project, donors = sides(spark, sf_dir)
    metric = matching.fit_metric(project, donors, COVS, whitening="standard")
    out = matching.enforce_reuse_within(project, donors, limits(project), "cls", metric, 1, store=shared_store(spark))
    return out.select(F.col("p_proj_idx").alias("proj_idx"), F.col("d_donor_idx").alias("donor_idx"), r6("distance", "match_distance"))


@query("""
with s as (select c_mktsegment = 'BUILDING' as p, c_acctbal::double a, c_nationkey::double b from customer),
w as (select 'c_acctbal' as covariate, avg(a) filter (where p) mp, avg(a) filter (where not p) mr, var_pop(a) filter (where p) vp, var_pop(a) filter (where not p) vr from s
      union all select 'c_nationkey', avg(b) filter (where p), avg(b) filter (where not p), var_pop(b) filter (where p), var_pop(b) filter (where not p) from s)
select covariate, round(abs(mp - mr) / sqrt((vp + vr) / 2), 4) as smd, round(mp, 6) as proj_mean, round(mr, 6) as ref_mean, abs(mp - mr) / sqrt((vp + vr) / 2) < 1e-1 as passed from w""")
def smd_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_mktsegment", "c_acctbal", "c_nationkey")
    out = balance.smd(c.where("c_mktsegment = 'BUILDING'"), c.where("c_mktsegment <> 'BUILDING'"), ["c_acctbal", "c_nationkey"])
    return out.select("covariate", "smd", r6("proj_mean"), r6("ref_mean"), "passed")


@query(" union all ".join(f"select '{c}' as covariate, count({c}) as n, round(avg({c}), 6) as mean, round(quantile_cont({c}, 0.5), 6) as median, round(stddev_samp({c}), 6) as std, round(quantile_cont({c}, 0.02), 6) as q02, round(quantile_cont({c}, 0.98), 6) as q98 from lineitem" for c in ("l_quantity", "l_extendedprice", "l_tax")))
def covariate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balance.covariate_summary(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"])
