"""Mixing sources to target weights by Poisson replication.

Each document's number of copies is the inverse of a Poisson distribution at a uniform
number that a seeded hash of its id gives; the mean is its source's target repetition
rate. Copies are exploded and put into a global order by a hash. JVM expressions only:
one count per source (partial sums before the shuffle), one join, one range exchange.

The table of sources is broadcast only if it has at most MAX_SOURCES rows (counted);
beyond that the join is by (source, salt), so that a source with a third of all rows is
dealt over SALTS tasks.

Defined cases: a null source is a source of its own; a null doc_id hashes as the empty
string; repeated rows are replicated alike; a source of weight 0 gets no copies;
a null text is replicated like any other; an empty table gives an empty result. The
result's own columns are named by parameters, so that extra columns can't clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_SOURCES = 10_000
SALTS = 64
#: A Poisson mean above this is split into a sum of equal parts, each inverted on its own.
MAX_MEAN = 32
SEED = "mix-1"


def rates(docs: DataFrame, source_col: str = "source", weights: dict[str, float] | None = None, rate: float = 1.0) -> DataFrame:
    """(source, n, mean): the mean repetitions of a document of each source.

    `weights` are relative target weights by source (absent: 0); by default the square
    root of a source's share, which evens out large sources. `rate` is the mean over all.
    """
    per = docs.groupBy(F.col(source_col).alias("_source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        w = F.sqrt(F.col("n").cast("double"))
    elif not weights:
        w = F.lit(0.0)
    else:
        pairs = [F.when(F.col("_source") == k, F.lit(float(v))) for k, v in weights.items()]
        w = F.coalesce(*pairs, F.lit(0.0))
    per = per.withColumn("w", w)
    total = per.agg(F.sum("n").alias("all_n"), F.sum("w").alias("all_w"))
    mean = F.lit(float(rate)) * F.col("all_n") * F.col("w") / F.col("all_w") / F.col("n")
    return per.crossJoin(F.broadcast(total)).select("_source", "n", F.round(F.coalesce(mean, F.lit(0.0)), 9).alias("mean"))  # one row of totals


def _with_cdf(per: DataFrame) -> DataFrame:
    """Adds the parts a mean is split into and the cumulative probabilities of one part."""
    per = per.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("mean") / MAX_MEAN)).cast("int"))
    return per.selectExpr(
        "_source",
        "parts",
        """aggregate(
             sequence(1, cast(ceil(mean / parts + 12 * sqrt(mean / parts)) as int) + 24),
             named_struct('p', exp(-mean / parts), 'c', exp(-mean / parts), 'a', array(exp(-mean / parts))),
             (s, k) -> named_struct('p', s.p * (mean / parts) / k, 'c', s.c + s.p * (mean / parts) / k, 'a', concat(s.a, array(s.c + s.p * (mean / parts) / k)))
           ).a as cdf""",
    )


def poisson_mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", weights: dict[str, float] | None = None, rate: float = 1.0, seed: str = SEED, copy_col: str | None = "copy", order_col: str | None = "mix_key") -> DataFrame:
    """`docs` with each row repeated, in a global hash order.

    `copy_col` counts a row's copies from 0 and `order_col` is the hash that orders the
    result; either is left out if None.
    """
    names = docs.columns
    rows = docs.toDF(*(f"c{i}" for i in range(len(names))))
    key, source = f"c{names.index(id_col)}", f"c{names.index(source_col)}"
    per = _with_cdf(rates(docs, source_col, weights, rate))
    few = per.count() <= MAX_SOURCES
    if few:
        joined = rows.join(F.broadcast(per), rows[source].eqNullSafe(per["_source"]))
    else:
        salted = per.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("_s", F.pmod(F.xxhash64(*rows.columns[:1], key), F.lit(SALTS)).cast("int"))
        joined = rows.join(salted, rows[source].eqNullSafe(salted["_source"]) & (rows["_s"] == salted["_salt"]))
    text = f"coalesce(cast({key} as string), '')"
    uniform = f"cast(conv(substr(md5(concat('{seed}:', {text}, ':', j)), 1, 13), 16, 10) as double) / 4503599627370496D"
    count = f"aggregate(sequence(0, parts - 1), 0, (n, j) -> n + size(filter(cdf, x -> x <= {uniform})))"
    out = joined.withColumn("_n", F.expr(count)).where("_n > 0")
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    out = out.withColumn("_key", F.expr(f"md5(concat('{seed}/', {text}, '/', _copy))"))
    shown = [F.col(f"c{i}").alias(x) for i, x in enumerate(names)]
    shown += [F.col(c).alias(x) for c, x in (("_copy", copy_col), ("_key", order_col)) if x]
    # ties, which only repeated ids can make, are ordered by the hash of the whole row
    ties = F.xxhash64(*(f"c{i}" for i in range(len(names))))
    return out.withColumn("_tie", ties).orderBy("_key", "_tie").select(*shown)


#: DuckDB: the same replication of `documents` with the defaults above.
MIX_SQL = f"""
with per as (select source, count(*) n, sqrt(count(*)::double) w from documents group by source),
rate as (select source, round(coalesce(1.0 * (select sum(n) from per) * w / (select sum(w) from per) / n, 0.0), 9) as mean from per),
part as (select source, mean, greatest(1, ceil(mean / {MAX_MEAN}))::int as parts from rate),
term as (select source, parts, k, exp(-mean / parts + k * ln(mean / parts) - lgamma(k + 1)) as p
         from part, lateral (select unnest(generate_series(0, ceil(mean / parts + 12 * sqrt(mean / parts))::int + 24)) as k)),
cdf as (select source, parts, list(c order by k) as cdf from (select source, parts, k, sum(p) over (partition by source order by k) as c from term) group by source, parts),
counted as (select d.*, list_sum(list_transform(range(0, parts), lambda j: len(list_filter(cdf, lambda x: x <= ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::varchar, '') || ':' || j::varchar), 1, 13))::bigint / 4503599627370496.0))))::int as n
            from documents d join cdf c on d.source is not distinct from c.source)
select doc_id, text, lang, source, n_chars, copy::int as copy, md5('{SEED}/' || coalesce(doc_id::varchar, '') || '/' || copy::varchar) as mix_key
from (select doc_id, text, lang, source, n_chars, unnest(range(0, n)) as copy from counted)
"""
