"""Centroid clustering: delta Lloyd over integer vectors.

Vectors become integers, so that sums, means and distances are exact and no result depends on the
order in which tasks finish. A round reads the table of the round before (vector, owner, distance)
and writes the next one:

* a vector whose owner's centroid stayed is compared only with the centroids that changed;
* a vector whose owner's centroid changed is compared with all of them;
* vectors that got another owner are marked, and only they are read again: each takes its components from
  the old owner's sum and adds them to the new one's. Those signed transfers are partial sums of
  Spark aggregates, a row a cluster, and update the global sums that the driver keeps.

No vector is ever shuffled, so equal or crowded vectors make no task larger. The driver holds
k centroids and k sums, and its seeds are the k first rows of an ordering.

Defined cases: vectors of another length, null ones and those with a null, NaN or infinite component
are left out, as are those with a component of more than LARGEST after scaling, whose squared
distances need not fit into a long; with fewer than k vectors each is a centroid; rows of
equal ids are vectors of their own (seeds of equal ids in the order of their components); a null
id is kept, and a seed only after all others; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapair.llm import _store
from terrapair.llm import _text as T

#: 64 * (2 * LARGEST)**2 is below 2**63.
LARGEST = 1 << 27
#: Distances of a slice that are computed at once.
SLICE_ROWS = 1 << 14
_STATE = "vec_id long, q array<int>, cluster int, distance long, was int"


def integer_vectors(df: DataFrame, dims: int = 64, scale: int = 64, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, q) of the usable vectors; q holds floor(scale * x) of every component x."""
    x = F.transform(F.col(vec_col), lambda v: F.floor(v.cast("double") * scale))
    fine = F.forall(F.col(vec_col), lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double") * scale) < LARGEST))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col)).where((F.size(vec_col) == dims) & F.coalesce(fine, F.lit(False)))
    return rows.select("vec_id", F.when(fine, x).cast("array<int>").alias("q"))


def seeds(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """Components of the k vectors with the smallest hash of their id."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = vectors.select(h.alias("h"), "q").orderBy(F.asc_nulls_last("h"), "q").limit(k)
    rows = [r["q"] for r in first.collect()]
    return np.array(rows, np.int64)


def _rows(col: pa.Array, dims: int) -> np.ndarray:
    """A list column of `dims` values each as a matrix."""
    off = np.asarray(col.offsets)
    return np.asarray(col.values)[off[0] : off[-1]].reshape(-1, dims)


def squared(q: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances; in floating point where every intermediate is below 2**53."""
    most = max(int(np.abs(q).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    kind = np.float64 if 4 * q.shape[1] * most * most < 1 << 53 else np.int64
    a, b = q.astype(kind), centroids.astype(kind)
    return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)


def _assign(centroids: np.ndarray, changed: np.ndarray | None):
    """The next state; `changed` marks centroids that moved (None: no vector has an owner yet)."""
    dims = centroids.shape[1]

    def nearest(q: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = squared(q, centroids[which])
        at = d.argmin(1)  # the first of equals, and `which` ascends
        return which[at], d[np.arange(len(q)), at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                q = _rows(T.column(batch, "q"), dims)
                if changed is None:
                    was = np.full(len(q), -1, np.int32)
                    owner, far = nearest(q, np.arange(len(centroids)))
                else:
                    was = T.column(batch, "cluster").to_numpy()
                    owner, far = was.astype(np.int64), T.column(batch, "distance").to_numpy().copy()
                    lost = changed[owner]
                    moved = np.flatnonzero(changed)
                    stay, go = np.flatnonzero(~lost), np.flatnonzero(lost)
                    if len(stay) and len(moved):
                        other, d = nearest(q[stay], moved)
                        closer = (d < far[stay]) | ((d == far[stay]) & (other < owner[stay]))
                        owner[stay[closer]], far[stay[closer]] = other[closer], d[closer]
                    if len(go):
                        owner[go], far[go] = nearest(q[go], np.arange(len(centroids)))
                yield pa.record_batch([T.column(batch, "vec_id"), T.column(batch, "q"), pa.array(owner.astype(np.int32)), pa.array(far), pa.array(was.astype(np.int32))], names=["vec_id", "q", "cluster", "distance", "was"])

    return run


def transfers(state: DataFrame, dims: int) -> DataFrame:
    """(cluster, n, s0, s1, ...): what each cluster gains or loses through vectors with another owner."""
    ends = F.array(F.struct(F.col("was").alias("cluster"), F.lit(-1).alias("sign")), F.struct(F.col("cluster"), F.lit(1).alias("sign")))
    moved = state.where("cluster <> was").select("q", F.explode(ends).alias("e")).where("e.cluster >= 0")
    part = lambda i: F.sum(F.get("q", F.lit(i)).cast("long") * F.col("e.sign")).alias(f"s{i}")
    return moved.groupBy(F.col("e.cluster").alias("cluster")).agg(F.sum("e.sign").alias("n"), *map(part, range(dims)))


def _stored(df: DataFrame) -> DataFrame:
    return _store.stored(df, "clusters", "zstd")


def lloyd(vectors: DataFrame, start: np.ndarray, rounds: int) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, q, cluster, distance) after `rounds` updates and a last assignment, final centroids)."""
    centroids, changed = start.copy(), None
    k, dims = centroids.shape
    sums, sizes = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
    state = vectors
    for at in range(rounds + 1):
        if changed is not None and not changed.any():
            break
        now = _stored(state.mapInArrow(_assign(centroids, changed), _STATE))
        _store.drop_stored(state)
        state = now
        if at == rounds:
            break
        for r in transfers(state, dims).collect():  # at most k rows
            sizes[r["cluster"]] += r["n"]
            sums[r["cluster"]] += [r[f"s{i}"] for i in range(dims)]
        means = np.where(sizes[:, None] > 0, sums // np.maximum(sizes, 1)[:, None], centroids)
        changed = (means != centroids).any(1)
        centroids = means
    return state.select("vec_id", "q", "cluster", "distance"), centroids


def _number(values: list, at: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), at)


def clusters(df: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Per usable vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    k is a parameter, so that k centroids fit into the driver and into every task's code.
    """
    vectors = _stored(integer_vectors(df, dims, scale, id_col, vec_col))
    start = seeds(vectors, k, seed)
    if not len(start):
        return vectors.select("vec_id", *(F.lit(None).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))))
    state, centroids = lloyd(vectors, start, rounds)
    each = dict(state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())  # at most k rows
    top = (1 << 63) - 1
    of = [min(top, int(each.get(i, 0))) for i in range(len(centroids))]
    total = min(top, int(sum(each.values())))
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    return state.select("vec_id", "cluster", "distance", _number(of, F.col("cluster")).cast("long").alias("cluster_inertia"), F.lit(total).cast("long").alias("inertia"), _number(names, F.col("cluster")).alias("centroid_sha256"))


#: Full Lloyd rounds: every vector against every centroid, sums from scratch.
CLUSTERS_SQL = """
with v as materialized (
  select vec_id, row_number() over (order by vec_id, q) as r, q from (
    select vec_id, list_transform(embedding, lambda x: floor(x::double * 64)::bigint) as q from embeddings
    where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64)),
vd as materialized (select r, unnest(q) as x, unnest(range(64)) as d from v),
c0 as materialized (select row_number() over (order by h, q) - 1 as c, q from (select sha256('1:' || vec_id) as h, q from v order by 1, 2 limit 16)),
m0 as materialized (select c, unnest(q) as x, unnest(range(64)) as d from c0),
{rounds}
one as materialized (select r, c as cluster, dist from a3),
per as (select cluster, sum(dist) as s from one group by 1),
names as (select c, sha256(string_agg(x::varchar, ',' order by d)) as h from m3 group by 1)
select v.vec_id, one.cluster::int as cluster, one.dist::bigint as distance, per.s::bigint as cluster_inertia, (select sum(dist) from one)::bigint as inertia, names.h as centroid_sha256
from v join one using (r) join per using (cluster) join names on names.c = one.cluster
"""
_ASSIGN_SQL = "a{i} as materialized (select r, arg_min(c, dist * 16 + c) as c, min(dist) as dist from (select r, c, sum((vd.x - m{i}.x) * (vd.x - m{i}.x))::bigint as dist from vd join m{i} using (d) group by 1, 2) group by 1)"
_MEANS_SQL = """m{j} as materialized (select m.c, m.d, coalesce(((s - ((s % n) + n) % n) // n)::bigint, m.x) as x from m{i} m left join
  (select a.c, vd.d, sum(vd.x)::bigint as s, count(*) as n from a{i} a join vd using (r) group by 1, 2) t on t.c = m.c and t.d = m.d)"""
CLUSTERS_SQL = CLUSTERS_SQL.replace("{rounds}", "\n".join([*(f"{_ASSIGN_SQL.format(i=i)},\n{_MEANS_SQL.format(i=i, j=i + 1)}," for i in range(3)), _ASSIGN_SQL.format(i=3) + ","]))
