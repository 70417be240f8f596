"""Pairing project pixels with control pixels: covariance, whitening, nearest candidates, calipers.

Three ways to find candidates give the same pairs where their semantics agree:

* ``reference``: the k nearest donors over all classes, then class and caliper filters;
* ``caliper_first``: an equi-join on class and caliper-wide bins, exact caliper predicates, then the
  nearest; no candidate limit, no pairs outside the calipers' neighbourhood. The nearest are searched within
  the bins (`nearest_within`); all pairs are `Matching.candidates`, a frame that is as long as there are pairs;
* ``exact``: `reference` semantics as one SQL plan, for small donor sides.

A donor matrix is broadcast up to a bounded number of rows (`BLOCK_ROWS`); more donors are dealt
to the boxes of a k-d tree, and a project row is searched in the boxes that it can reach.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from terrapair.config import MANDATORY_COLUMNS, TENURE_COLUMNS, TEXTURE_FALLBACK, MatchConfig
from terrapair.functions.columns import all_finite, finite

#: Donor rows that are broadcast at most; with 8 covariates they have about 20 MB.
BLOCK_ROWS = 300_000
#: Donors that the boxes of more are made from, and boxes at most.
SAMPLE = 50_000
MAX_LEAVES = 4096
#: Donors of a ball, about.
BALL = 256
#: Distances are rounded to this, so that equal ones don't depend on the order of additions.
DIGITS = 9
#: Distances computed at once, in cells.
CELLS = 4_000_000
#: Neighbours that a task of a box search gives back at most, about.
FOUND = 1_000_000
#: Rows of either side that a task of `nearest_within` holds of one bin, about.
BIN_ROWS = 100_000
#: Project rows that are searched together.
TOGETHER = 512
#: Candidates that a project has in `enforce_reuse_within` at first, and their growth where they are used up.
FIRST_CANDIDATES, MORE_CANDIDATES = 8, 4
#: Open pairs that a round of `enforce_reuse` goes through one by one.
REUSE_CHUNK = 200_000


@dataclass(frozen=True)
class Metric:
    """Standardisation and whitening: distance = |(z_p - z_d) L|."""

    covariates: tuple[str, ...]
    mean: np.ndarray
    std: np.ndarray
    lower: np.ndarray
    shrinkage: float = 0.0

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.std @ self.lower


@dataclass(frozen=True)
class Moments:
    """Pooled first, second and fourth-order sums of covariates, from one aggregate each pass."""

    n: int
    mean: np.ndarray
    std: np.ndarray
    cov: np.ndarray  # population covariance of the standardised columns
    fourth: float  # sum of |z|^4


def pooled(project: DataFrame, donors: DataFrame, covs: Sequence[str], fit_rows: int | None, seed: int) -> DataFrame:
    """Rows to fit on: all, or at most fit_rows of each side by a seeded hash (a sampling operator)."""
    sides = []
    for df in (project, donors):
        df = df.select(*[F.col(c).cast("double").alias(c) for c in covs])
        if fit_rows is not None:
            df = df.orderBy(F.xxhash64(F.lit(seed), *covs)).limit(fit_rows)
        sides.append(df)
    return sides[0].unionByName(sides[1])


def moments(rows: DataFrame, covs: Sequence[str]) -> Moments:
    """Two narrow aggregates: mean and deviation, then the Gram matrix of standardised values."""
    first = rows.agg(F.count(F.lit(1)), *[f(c) for c in covs for f in (F.avg, F.stddev_pop)]).first()
    n = first[0]
    if not n:
        raise ValueError("no rows to fit on")
    mean, std = np.array(first[1::2], float), np.array(first[2::2], float)
    std = np.where(std > 0, std, 1.0)
    z = [(F.col(c) - float(m)) / float(s) for c, m, s in zip(covs, mean, std)]
    p = len(covs)
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    norm = reduce(lambda a, b: a + b, (v * v for v in z))
    second = rows.agg(*[F.avg(z[i] * z[j]) for i, j in pairs], F.sum(norm * norm)).first()
    cov = np.zeros((p, p))
    for (i, j), v in zip(pairs, second):
        cov[i, j] = cov[j, i] = v
    return Moments(n, mean, std, cov, float(second[-1]))


def ledoit_wolf(m: Moments) -> tuple[np.ndarray, float]:
    """(shrunk covariance, shrinkage) by the formula of Ledoit & Wolf (2004)."""
    p = len(m.mean)
    s2, trace = float((m.cov**2).sum()), float(np.trace(m.cov))
    mu = trace / p
    delta = (s2 - 2 * mu * trace + p * mu * mu) / p
    beta = min((m.fourth / m.n - s2) / (m.n * p), delta)
    shrink = 0.0 if beta <= 0 or delta <= 0 else beta / delta
    return (1 - shrink) * m.cov + shrink * mu * np.eye(p), shrink


def fit_metric(project: DataFrame, donors: DataFrame, covs: Sequence[str], cfg: MatchConfig = MatchConfig(), whitening: str = "mahalanobis") -> Metric:
    """Standardiser and whitener from pooled moments; "standard" leaves correlations alone."""
    m = moments(pooled(project, donors, covs, cfg.fit_rows, cfg.seed), covs)
    if whitening == "standard":
        return Metric(tuple(covs), m.mean, m.std, np.eye(len(covs)))
    sigma, shrink = ledoit_wolf(m)
    eye = cfg.ridge * np.eye(len(covs))
    inverse = np.linalg.inv(sigma + eye) + eye
    least = np.linalg.eigvalsh(inverse).min()
    if least < 1e-10:  # made positive definite by a multiple of the identity
        inverse = inverse + (abs(least) + 1e-8) * np.eye(len(covs))
    return Metric(tuple(covs), m.mean, m.std, np.linalg.cholesky(inverse), shrink)


def whitened(metric: Metric) -> list[Column]:
    """The whitened coordinates as Column expressions."""
    z = [(F.col(c).cast("double") - float(m)) / float(s) for c, m, s in zip(metric.covariates, metric.mean, metric.std)]
    out = []
    for j in range(metric.lower.shape[1]):
        terms = [z[i] * float(metric.lower[i, j]) for i in range(len(z)) if metric.lower[i, j] != 0]
        out.append(reduce(lambda a, b: a + b, terms))
    return out


def adaptive_k(n: Column, cfg: MatchConfig) -> Column:
    """Candidates that a class of n donors gets: nearly all of a small class."""
    return F.greatest(F.lit(cfg.matches_per_pixel), F.least(F.lit(cfg.candidates), F.floor(F.lit(0.95) * n).cast("int"), n.cast("int")))


def validate_mandatory(project: DataFrame, donors: DataFrame, cfg: MatchConfig = MatchConfig(), columns: Sequence[str] = MANDATORY_COLUMNS) -> None:
    """Fails if a caliper column is missing on either side; a texture class stands for its code."""
    if not cfg.require_mandatory:
        return
    for side, df in (("project", project), ("donor", donors)):
        have = set(df.columns) | ({"WRB2_CODE"} if "texture_class" in df.columns else set())
        if missing := [c for c in columns if c not in have]:
            raise ValueError(f"{side}: mandatory caliper columns missing: {missing}")


def tenure_column(project: DataFrame, donors: DataFrame) -> str | None:
    return next((c for c in TENURE_COLUMNS if c in project.columns and c in donors.columns), None)


@dataclass(frozen=True)
class Caliper:
    """|donor - project| <= tolerance; a project without a value isn't restricted."""

    column: str
    tolerance: float


def calipers(project: DataFrame, cfg: MatchConfig = MatchConfig()) -> list[Caliper]:
    """The method's calipers, two of them relative to the project's means.

    Fails if such a mean is missing: without it the caliper would let nothing, or anything, through.
    """
    have = set(project.columns)
    relative = [(c, f) for c, f in (("SOC_g_kg", cfg.soc_fraction), ("NDVI_t0", cfg.ndvi_fraction)) if c in have]
    means = project.agg(*[F.avg(finite(F.col(c).cast("double"))) for c, _ in relative]).first() if relative else []
    if missing := [c for (c, _), m in zip(relative, means) if m is None]:
        raise ValueError(f"no project mean for relative calipers: {missing}")
    out = [Caliper(c, max(abs(m) * f, 1e-9)) for (c, f), m in zip(relative, means)]
    fixed = (("elevation", cfg.elevation_m), ("slope_deg", cfg.slope_deg), ("dist_roads_km", cfg.roads_km))
    return out + [Caliper(c, t) for c, t in fixed if c in have]


def within(caliper: Caliper, p: str, d: str) -> Column:
    """A caliper over columns p (project) and d (donor); a missing donor value fails."""
    return F.col(p).isNull() | F.coalesce(F.abs(F.col(d) - F.col(p)) <= caliper.tolerance, F.lit(False))


def _side(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(f"{prefix}{c}") for c in df.columns])


def _least_of_equals(k: int, donor_ids: np.ndarray, donor_z: np.ndarray) -> np.ndarray:
    """Rows without those that have k equal vectors of smaller ids before them."""
    order = np.lexsort((donor_ids, *donor_z.T))
    z = donor_z[order]
    new = np.ones(len(z), bool)
    new[1:] = (z[1:] != z[:-1]).any(1)
    first = np.flatnonzero(new)
    return np.sort(order[np.arange(len(z)) - first[np.cumsum(new) - 1] < k])


class Balls:
    """Donors in balls of about BALL: the triangle inequality tells which ones can hold a row's nearest donors."""

    def __init__(self, z: np.ndarray):
        good = np.flatnonzero(np.isfinite(z).all(1))
        tree = Leaves.of(z[good], BALL)
        leaf = tree.home(z[good])
        order = np.argsort(leaf, kind="stable")
        #: Donors without a place are in a ball of their own that is always searched.
        self.rest = np.setdiff1d(np.arange(len(z)), good)
        self.order, self.z = good[order], z
        sizes = np.bincount(leaf, minlength=len(tree.low))
        self.off = np.concatenate([[0], np.cumsum(sizes)])[np.append(sizes > 0, True)]
        self.size = np.diff(self.off)
        start = self.off[:-1]
        self.centre = np.add.reduceat(z[self.order], start, axis=0) / self.size[:, None] if len(start) else np.zeros((0, z.shape[1]))
        away = np.sqrt(((z[self.order] - np.repeat(self.centre, self.size, axis=0)) ** 2).sum(1))
        self.radius = np.maximum.reduceat(away, start) * (1 + 1e-12) + 1e-12 if len(start) else np.zeros(0)

    def donors(self, balls: np.ndarray) -> np.ndarray:
        return np.concatenate([*(self.order[self.off[b] : self.off[b + 1]] for b in balls.tolist()), self.rest])

    def searched(self, z: np.ndarray, keep: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, donors) of rows that share a nearest ball, with every donor that may be among their `keep` nearest.

        The balls around theirs that hold `keep` donors bound the keep-th distance; then all balls within
        that bound are searched.
        """
        lost = ~np.isfinite(z).all(1)
        everything = np.arange(len(self.z))
        if lost.any() or len(self.size) < 2:
            yield np.flatnonzero(lost) if len(self.size) >= 2 else np.arange(len(z)), everything
        if len(self.size) < 2:
            return
        rows = np.flatnonzero(~lost)
        step = max(1, CELLS // len(self.size))
        for a in range(0, len(rows), step):
            some = rows[a : a + step]
            d = np.sqrt(np.maximum((z[some] ** 2).sum(1)[:, None] + (self.centre**2).sum(1) - 2 * z[some] @ self.centre.T, 0))
            home = d.argmin(1)
            for g in np.unique(home).tolist():
                mine = np.flatnonzero(home == g)
                around = np.argsort(((self.centre - self.centre[g]) ** 2).sum(1))
                first = self.donors(around[: int(np.searchsorted(np.cumsum(self.size[around]), keep)) + 1])
                at = z[some[mine]]
                reach = np.zeros(len(mine))
                for b in range(0, len(mine), max(1, CELLS // (len(first) * z.shape[1]))):
                    piece = slice(b, b + max(1, CELLS // (len(first) * z.shape[1])))
                    far = ((at[piece, None, :] - self.z[first]) ** 2).sum(2)
                    far[np.isnan(far)] = np.inf
                    reach[piece] = np.sqrt(np.partition(far, min(keep, len(first)) - 1, axis=1)[:, min(keep, len(first)) - 1])
                # the product form may be off by a share of the squares
                slack = 1e-6 * (1 + np.sqrt((at**2).sum(1)) + np.abs(self.centre).max()) + 4 * 10.0**-DIGITS
                may = (d[mine] - self.radius <= (reach + slack)[:, None]).any(0)
                yield some[mine], self.donors(np.flatnonzero(may))


def _nearest(k: int, donor_ids: np.ndarray, donor_z: np.ndarray, tally: list[tuple[int, int]] | None = None):
    """The k nearest of the donors; `tally` is told how many pairs were measured of how many."""
    few = _least_of_equals(k, donor_ids, donor_z)
    donor_ids, donor_z = donor_ids[few], donor_z[few]
    norms = (donor_z**2).sum(1)
    # rounding of the product form, as a share of the squared norms of both sides
    unit = 8 * (donor_z.shape[1] + 4) * np.finfo(float).eps
    longest = float(np.nan_to_num(norms).max(initial=0.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = Balls(donor_z)
        keep = min(k, len(donor_ids))
        for batch in batches:
            names = batch.schema.names
            ids = batch.column(names.index("proj_idx")).to_numpy()
            z = np.stack([batch.column(i).to_numpy() for i in range(1, batch.num_columns)], axis=1)
            for rows, there in balls.searched(z, keep):
                step = max(1, CELLS // max(1, len(there)))
                their_ids, their_z, their_norms = donor_ids[there], donor_z[there], norms[there]
                if tally is not None:
                    tally.append((len(rows) * len(there), len(rows) * len(donor_ids)))
                for a in range(0, len(rows), step):
                    part = z[rows[a : a + step]]
                    square = (part**2).sum(1)
                    rough = square[:, None] + their_norms - 2 * part @ their_z.T
                    rough[np.isnan(rough)] = np.inf
                    # every donor that may have the rounded distance of the k-th one or less is measured exactly
                    slack = unit * (square + longest)
                    rim = np.sqrt(np.maximum(np.partition(rough, keep - 1, axis=1)[:, keep - 1], 0) + slack) + 2 * 10.0**-DIGITS
                    row, near = np.nonzero(~(rough > (rim**2 + slack)[:, None]))
                    dist = np.zeros(len(row))
                    for j in range(z.shape[1]):
                        dist += (part[row, j] - their_z[near, j]) ** 2
                    dist = np.round(np.sqrt(dist), DIGITS)
                    order = np.lexsort((their_ids[near], dist, row))
                    start = np.searchsorted(row, np.arange(len(part)))
                    order = order[(start[:, None] + np.arange(keep)).reshape(-1)]
                    yield pa.record_batch(
                        [pa.array(np.repeat(ids[rows[a : a + step]], keep)), pa.array(their_ids[near[order]]), pa.array(dist[order]), pa.array(np.tile(np.arange(1, keep + 1), len(part)).astype(np.int32))],
                        names=["proj_idx", "donor_idx", "distance", "rank"],
                    )

    return run


@dataclass(frozen=True)
class Leaves:
    """A k-d tree over whitened space: inner nodes split a coordinate at a value, leaves are boxes."""

    axis: np.ndarray  # of each node, -1 for a leaf
    value: np.ndarray
    child: np.ndarray  # the lower child, the upper one follows; a leaf's number for a leaf
    low: np.ndarray  # [leaves, coordinates]
    high: np.ndarray

    @classmethod
    def of(cls, z: np.ndarray, rows: int) -> Leaves:
        """Split the widest coordinate at its median until a leaf holds at most `rows` of z."""
        axis, value, child, boxes = [-1], [0.0], [0], []
        stack = [(0, z, np.full(z.shape[1], -np.inf), np.full(z.shape[1], np.inf))]
        while stack:
            node, part, low, high = stack.pop()
            spread = part.max(0) - part.min(0) if len(part) else np.zeros(z.shape[1])
            j = int(spread.argmax())
            cut = float(np.median(part[:, j])) if len(part) > rows and spread[j] > 0 else np.nan
            below = part[:, j] < cut
            if np.isnan(cut) or not below.any():
                cut = float(part[:, j].max()) if not np.isnan(cut) else cut  # the median is the least value
                below = part[:, j] < cut
            if np.isnan(cut) or not below.any():
                child[node] = len(boxes)
                boxes.append((low, high))
                continue
            axis[node], value[node], child[node] = j, cut, len(axis)
            axis += [-1, -1]
            value += [0.0, 0.0]
            child += [0, 0]
            upper, lower = high.copy(), low.copy()
            upper[j], lower[j] = cut, cut
            stack += [(child[node], part[below], low, upper), (child[node] + 1, part[~below], lower, high)]
        return cls(np.array(axis), np.array(value), np.array(child), np.array([x for x, _ in boxes]), np.array([x for _, x in boxes]))

    def home(self, z: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        node = np.zeros(len(z), np.int64)
        while len(on := np.flatnonzero(self.axis[node] >= 0)):
            at = node[on]
            node[on] = self.child[at] + ~(z[on, self.axis[at]] < self.value[at])
        return self.child[node]

    def near(self, z: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of the boxes that a ball around a row touches."""
        gap = np.maximum(np.maximum(self.low - z[:, None], z[:, None] - self.high), 0.0)
        # what rounding may hide
        return np.nonzero(~(np.sqrt((gap**2).sum(2)) > (radius + 4 * 10.0**-DIGITS + 1e-9 * np.abs(radius))[:, None]))


def _coordinates(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return np.stack([batch.column(batch.schema.names.index(f"z{i}")).to_numpy(zero_copy_only=False) for i in range(dims)], axis=1).astype(float)


def _dealt(tree: Leaves, dims: int, beyond: bool):
    """Rows with their leaf; with `beyond` a row for each other leaf that the row's radius reaches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            step = max(1, CELLS // max(1, len(tree.low) * dims)) if beyond else max(1, whole.num_rows)
            for a in range(0, whole.num_rows, step):
                batch = whole.slice(a, step)
                z = _coordinates(batch, dims)
                home = tree.home(z)
                row, leaf = np.arange(len(z)), home
                if beyond:
                    row, leaf = tree.near(z, batch.column(batch.schema.names.index("radius")).to_numpy(zero_copy_only=False))
                    other = leaf != home[row]
                    row, leaf = row[other], leaf[other]
                names = [c for c in batch.schema.names if c != "radius"]
                yield pa.record_batch([*(batch.column(batch.schema.names.index(c)).take(pa.array(row)) for c in names), pa.array(leaf.astype(np.int32))], names=[*names, "leaf"])

    return run


def _leaf_search(queries: DataFrame, donors: DataFrame, k: int, dims: int, rows: int) -> DataFrame:
    """The k nearest donors of each query's leaf. A leaf with many queries is searched in several tasks."""
    parts = queries.groupBy("leaf").agg(F.expr(f"cast(ceil(count(1) / {rows}) as int)").alias("parts"))
    asked = queries.join(parts, "leaf").withColumn("part", F.pmod(F.xxhash64("proj_idx"), F.col("parts")).cast("int")).drop("parts")
    there = donors.join(parts, "leaf").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            right = right.combine_chunks().to_batches()[0]
            ids, z = right.column(right.schema.names.index("donor_idx")).to_numpy(), _coordinates(right, dims)
            plain = left.select(["proj_idx", *(f"z{i}" for i in range(dims))]).combine_chunks()
            out = list(_nearest(k, ids, z)(iter(plain.to_batches())))
        schema = pa.schema([("proj_idx", pa.int64()), ("donor_idx", pa.int64()), ("distance", pa.float64()), ("rank", pa.int32())])
        return pa.Table.from_batches(out, schema) if out else schema.empty_table()

    return asked.groupBy("leaf", "part").cogroup(there.groupBy("leaf", "part")).applyInArrow(search, "proj_idx long, donor_idx long, distance double, rank int")


def _placed(df: DataFrame, metric: Metric) -> DataFrame:
    return df.where(all_finite(metric.covariates))


def knn(project: DataFrame, donors: DataFrame, metric: Metric, k: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(proj_idx, donor_idx, distance, rank): the k nearest donors, ties by donor_idx.

    Up to block_rows donors are broadcast, a bound that is checked. More are dealt to the boxes of a
    k-d tree that a bounded sample of them gives: a project row searches its own box, and then
    the others that its k-th distance there still reaches. No donors come to the driver but the sample.
    A row with a missing or infinite covariate has no place: it has no neighbours and is nobody's.
    """
    coords = [c.alias(f"z{i}") for i, c in enumerate(whitened(metric))]
    left = _placed(project, metric).select(F.col("proj_idx").cast("long").alias("proj_idx"), *coords)
    right = _placed(donors, metric).select(F.col("donor_idx").cast("long").alias("donor_idx"), *coords)
    n, dims = right.count(), len(coords)
    out = "proj_idx long, donor_idx long, distance double, rank int"
    if not n:
        return left.select("proj_idx", F.lit(0).cast("long").alias("donor_idx"), F.lit(0.0).alias("distance"), F.lit(0).alias("rank")).where("false")
    if n <= block_rows:
        table = right.toArrow()
        z = np.stack([table.column(i).to_numpy() for i in range(1, table.num_columns)], axis=1)
        return left.mapInArrow(_nearest(k, table.column(0).to_numpy(), z), out)
    # of equal vectors only the k smallest ids can be among the nearest; salted, as one may be very frequent
    names = [f"z{i}" for i in range(dims)]
    for by in ([*names, F.pmod(F.xxhash64("donor_idx"), F.lit(64))], names):
        w = Window.partitionBy(*by).orderBy("donor_idx")
        right = right.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")
    sample = right.orderBy(F.xxhash64("donor_idx")).limit(SAMPLE).toArrow()
    z = np.stack([sample.column(c).to_numpy() for c in names], axis=1)
    z = z[np.isfinite(z).all(1)]
    # boxes of about half of block_rows donors, but not so many that they don't fit into a task
    tree = Leaves.of(z, max(int(len(z) * block_rows / 2 / n), len(z) // MAX_LEAVES, 1))
    dealt = ", ".join(f"{c} double" for c in names)
    right = right.mapInArrow(_dealt(tree, dims, False), f"donor_idx long, {dealt}, leaf int")
    home = left.mapInArrow(_dealt(tree, dims, False), f"proj_idx long, {dealt}, leaf int")
    asked_rows = max(1, min(block_rows, FOUND // k))  # what a task gives back grows with k
    first = _leaf_search(home, right, k, dims, asked_rows)
    reach = first.groupBy("proj_idx").agg(F.when(F.count(F.lit(1)) >= k, F.max("distance")).alias("radius"))
    again = left.join(reach, "proj_idx", "left").select("proj_idx", *names, F.coalesce("radius", F.lit(float("inf"))).alias("radius"))
    again = again.mapInArrow(_dealt(tree, dims, True), f"proj_idx long, {dealt}, leaf int")
    every = first.unionByName(_leaf_search(again, right, k, dims, asked_rows)).drop("rank")
    w = Window.partitionBy("proj_idx").orderBy("distance", "donor_idx")
    return every.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def knn_sql(project: DataFrame, donors: DataFrame, metric: Metric, k: int, most_donors: int = 20_000) -> DataFrame:
    """`knn` as a broadcast theta join with a group limit, for donor sides of a checked size."""
    project, donors = _placed(project, metric), _placed(donors, metric)
    if donors.count() > most_donors:
        raise ValueError("too many donors for a theta join; use knn")
    coords = whitened(metric)
    left = project.select("proj_idx", *[c.alias(f"p{i}") for i, c in enumerate(coords)])
    right = donors.select("donor_idx", *[c.alias(f"d{i}") for i, c in enumerate(coords)])
    dist = F.round(F.sqrt(reduce(lambda a, b: a + b, [F.pow(F.col(f"p{i}") - F.col(f"d{i}"), F.lit(2)) for i in range(len(coords))])), DIGITS)
    w = Window.partitionBy("proj_idx").orderBy("distance", "donor_idx")
    pairs = left.crossJoin(F.broadcast(right)).select("proj_idx", "donor_idx", dist.alias("distance"))
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def allowed_classes(available: Sequence[str], fallback: bool) -> dict[str, list[str]]:
    """Donor classes that are candidates for each project class.

    A class that has donors takes only those; one without takes, with fallback, the classes in its
    list that have donors. Candidates of another class still fail the exact class caliper.
    """
    out = {c: [c] for c in available}
    if fallback:
        out |= {c: near for c, names in TEXTURE_FALLBACK.items() if c not in out and (near := [x for x in names if x in out])}
    return out


def same_tenure(tenure: str | None) -> Column:
    """Equal tenure of a p_ and a d_ side, as strings; two missing values are equal."""
    return F.lit(True) if tenure is None else F.col(f"p_{tenure}").cast("string").eqNullSafe(F.col(f"d_{tenure}").cast("string"))


@dataclass
class Matching:
    """Results of a matching run."""

    pairs: DataFrame
    unmatched: DataFrame
    summary: DataFrame
    candidates: DataFrame


def candidates_by_bins(project: DataFrame, donors: DataFrame, limits: Sequence[Caliper], cls: str, bins: int = 2, tenure: str | None = None) -> DataFrame:
    """Donor candidates within all calipers by an equi-join on class, tenure and caliper-wide bins.

    |p - d| <= tolerance puts d's bin within one of p's, so the project side is repeated 3 times
    per binned column; the first `bins` calipers are binned and all are checked exactly. A project
    row without a value in one of these is binned by the first caliper that it has a value for;
    one without any has no candidates here (see `unrestricted`).
    """
    left, right = _side(project, "p_"), _side(donors, "d_")
    exact = reduce(and_, [within(c, f"p_{c.column}", f"d_{c.column}") for c in limits], F.lit(True))
    same = [F.col(f"p_{cls}") == F.col(f"d_{cls}"), same_tenure(tenure)]

    def joined(rows: DataFrame, used: Sequence[Caliper]) -> DataFrame:
        there, keys = right, [*same]
        for i, c in enumerate(used):
            rows = rows.withColumn(f"b{i}", F.explode(F.array(*[F.floor(F.col(f"p_{c.column}") / c.tolerance) + k for k in (-1, 0, 1)])))
            there = there.withColumn(f"e{i}", F.floor(F.col(f"d_{c.column}") / c.tolerance))
            keys.append(F.col(f"b{i}") == F.col(f"e{i}"))
        return rows.join(there, reduce(and_, keys)).where(exact).select(*left.columns, *right.columns)

    has = [F.col(f"p_{c.column}").isNotNull() for c in limits]
    used = list(limits[:bins])
    whole = reduce(and_, has[: len(used)], F.lit(True))
    parts = [joined(left.where(whole), used) if used else left.where("false").join(right, reduce(and_, same))]
    # the other bins are for project rows that lack a value: most tables have none
    if len(used) > 1 and not left.where(~whole).isEmpty():
        for i, c in enumerate(limits):
            first = reduce(and_, [~x for x in has[:i]], has[i])
            parts.append(joined(left.where(~whole & first), [c]))
    return reduce(DataFrame.unionByName, parts)


def _passing(k: int, dims: int, tolerances: Sequence[float], names: Sequence[str], empty: pa.Schema):
    """Of one bin's rows, each project row with its k nearest donors within all calipers, and those as far as the k-th.

    Donors are in the boxes of a k-d tree. Boxes are searched from the nearest one on, until the next is beyond the k-th
    distance of all rows at hand; boxes that the calipers don't reach are left out.
    """
    tol = np.array(tolerances, float)

    def numbers(t: pa.Table, prefix: str, n: int) -> np.ndarray:
        return np.stack([t.column(f"{prefix}{i}").to_numpy() for i in range(n)], axis=1).astype(float) if n else np.zeros((t.num_rows, 0))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return empty.empty_table()
        dz, dc, pz, pc = numbers(right, "_z", dims), numbers(right, "_c", len(tol)), numbers(left, "_z", dims), numbers(left, "_c", len(tol))
        free = np.stack([left.column(f"_c{i}").is_null().to_numpy() for i in range(len(tol))], axis=1) if len(tol) else np.zeros((len(pz), 0), bool)
        few = _least_of_equals(k, right.column("d_donor_idx").to_numpy(), np.concatenate([dz, np.nan_to_num(dc, nan=np.inf)], axis=1))
        tree = Leaves.of(dz[few], BALL)
        leaf = tree.home(dz[few])
        few = few[np.argsort(leaf, kind="stable")]
        dz, dc = dz[few], dc[few]
        sizes = np.bincount(leaf, minlength=len(tree.low))
        off = np.concatenate([[0], np.cumsum(sizes)])[np.append(sizes > 0, True)]
        (low, high), (least, most) = ((np.fmin.reduceat(x, off[:-1]), np.fmax.reduceat(x, off[:-1])) for x in (dz, dc))
        slack = 2 * 10.0**-DIGITS + 1e-12 * max(np.abs(dz).max(initial=0.0), np.abs(pz).max(initial=0.0))
        home = tree.home(pz)
        order = np.argsort(home, kind="stable")
        cuts = np.flatnonzero(np.diff(home[order])) + 1
        rows_out, donors_out = [], []
        for of_leaf in np.split(order, cuts):
            for a in range(0, len(of_leaf), TOGETHER):
                rows = of_leaf[a : a + TOGETHER]
                gap = np.sqrt((np.maximum(np.maximum(low - pz[rows].max(0), pz[rows].min(0) - high), 0.0) ** 2).sum(1))
                about = tol + 1e-9 * (tol + np.abs(np.nan_to_num(pc[rows])).max(0, initial=0.0))
                within_reach = (least <= np.fmax.reduce(pc[rows], axis=0) + about) & (most >= np.fmin.reduce(pc[rows], axis=0) - about)
                boxes = np.flatnonzero((within_reach | free[rows].any(0)).all(1))
                boxes = boxes[np.argsort(gap[boxes], kind="stable")]
                best = np.full((len(rows), k), np.inf)
                found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
                i, step, kth = 0, 1, np.full(len(rows), np.inf)
                while i < len(boxes) and gap[boxes[i]] <= kth.max() + slack:
                    some = boxes[i : i + step]
                    there = np.concatenate([np.arange(off[b], off[b + 1]) for b in some.tolist()])
                    far = np.zeros((len(rows), len(there)))
                    for j in range(dims):
                        far += (pz[rows, j][:, None] - dz[there, j]) ** 2
                    far = np.sqrt(far)
                    for j in range(len(tol)):
                        ok = np.abs(dc[there, j] - pc[rows, j][:, None]) <= tol[j]
                        far[~(ok | free[rows, j][:, None])] = np.inf
                    best = np.partition(np.concatenate([best, far], axis=1), k - 1, axis=1)[:, :k]
                    kth = best.max(1)
                    row, near = np.nonzero((far <= (kth + slack)[:, None]) & (far < np.inf))
                    found.append((row, there[near], far[row, near]))
                    i, step = i + len(some), min(2 * step, 16)
                for row, donor, far in found:
                    keep = far <= kth[row] + slack
                    rows_out.append(rows[row[keep]])
                    donors_out.append(few[donor[keep]])
        if not rows_out:
            return empty.empty_table()
        left, right = left.take(pa.array(np.concatenate(rows_out))), right.take(pa.array(np.concatenate(donors_out)))
        return pa.table([(left if c.startswith("p_") else right).column(c) for c in names], names=list(names))

    return search


def nearest_within(project: DataFrame, donors: DataFrame, limits: Sequence[Caliper], cls: str, metric: Metric, k: int, bins: int = 2, tenure: str | None = None, bin_rows: int = BIN_ROWS) -> DataFrame:
    """The k nearest donors of each project row within class, tenure and all calipers: p_ and d_ columns, distance, match_rank.

    The bins are those of `candidates_by_bins`, but a bin's pairs are not written out: tasks search them
    (`_passing`), and what leaves a task is k rows a project row and bin. A bin of more than
    `bin_rows` rows of a side is dealt to several tasks. As in `knn`, a row with a missing or infinite covariate has no place.
    """
    coords = whitened(metric)
    extra = [*(c.alias(f"_z{i}") for i, c in enumerate(coords)), *(F.col(c.column).cast("double").alias(f"_c{i}") for i, c in enumerate(limits))]

    def side(df: DataFrame, prefix: str) -> DataFrame:
        kind = F.coalesce(F.concat(F.lit("="), F.col(tenure).cast("string")), F.lit("")) if tenure else F.lit("")
        same = [F.col(cls).alias("_k"), kind.alias("_t"), *extra]
        return _placed(df, metric).where(F.col(cls).isNotNull()).select(*[F.col(f"`{c}`").alias(f"{prefix}{c}") for c in df.columns], *same)

    left, right = side(project, "p_"), side(donors, "d_")
    names = [*(c for c in left.columns if c.startswith("p_")), *(c for c in right.columns if c.startswith("d_"))]
    schema = StructType([(left if c.startswith("p_") else right).schema[c] for c in names])
    keys = ["_k", "_t", *(f"_b{i}" for i in range(bins))]

    def parts(df: DataFrame, name: str) -> DataFrame:
        many = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > bin_rows)
        return F.broadcast(many.select(*keys, F.ceil(F.col("_n") / bin_rows).cast("int").alias(name)))  # few: each has bin_rows rows

    def searched(rows: DataFrame, used: Sequence[tuple[int, Caliper]]) -> DataFrame:
        there = right
        for i in range(bins):
            if i < len(used):
                j, c = used[i]
                at = F.floor(F.col(f"_c{j}") / c.tolerance)
                rows = rows.withColumn(f"_b{i}", F.explode(F.array(*[at + n for n in (-1, 0, 1)])))
                there = there.withColumn(f"_b{i}", at).where(F.col(f"_b{i}").isNotNull())
            else:
                rows, there = rows.withColumn(f"_b{i}", F.lit(0).cast("long")), there.withColumn(f"_b{i}", F.lit(0).cast("long"))
        mine, theirs = parts(rows, "_pn"), parts(there, "_dn")
        rows, there = (df.join(mine, keys, "left").join(theirs, keys, "left").fillna(1, ["_pn", "_dn"]) for df in (rows, there))
        dealt = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        rows = rows.withColumn("_pp", dealt("p_proj_idx", "_pn")).withColumn("_dp", every("_dn"))
        there = there.withColumn("_dp", dealt("d_donor_idx", "_dn")).withColumn("_pp", every("_pn"))
        by = [*keys, "_pp", "_dp"]
        return rows.groupBy(*by).cogroup(there.groupBy(*by)).applyInArrow(_passing(k, len(coords), [c.tolerance for c in limits], names, empty), schema)

    empty = to_arrow_schema(schema)
    used = list(enumerate(limits))
    has = [F.col(f"_c{i}").isNotNull() for i, _ in used]
    whole = reduce(and_, has[:bins], F.lit(True))
    found = [searched(left.where(whole), used[:bins])]
    # the other bins are for project rows that lack a value: most tables have none
    if used and not left.where(~whole).isEmpty():
        for i, c in used:
            found.append(searched(left.where(~whole & reduce(and_, [~x for x in has[:i]], has[i])), [(i, c)]))
        found.append(searched(left.where(reduce(and_, [~x for x in has])), []))
    w = Window.partitionBy("p_proj_idx").orderBy("distance", "d_donor_idx")
    near = reduce(DataFrame.unionByName, found).withColumn("distance", whitened_distance(metric))
    return near.withColumn("match_rank", F.row_number().over(w)).where(F.col("match_rank") <= k)


def unrestricted(project: DataFrame, donors: DataFrame, limits: Sequence[Caliper], cls: str, classes: Sequence[str], metric: Metric, k: int, tenure: str | None = None) -> DataFrame | None:
    """Candidates of project rows that no caliper restricts: the k nearest donors of their class, by `knn`."""
    free = project.where(reduce(and_, [F.col(c.column).isNull() for c in limits], F.lit(True)))
    if free.isEmpty():
        return None
    left, right = _side(project, "p_"), _side(donors, "d_")
    found = [knn(free.where(F.col(cls) == c), donors.where(F.col(cls) == c), metric, k) for c in classes]  # a handful of classes
    near = reduce(DataFrame.unionByName, found).select("proj_idx", "donor_idx")
    out = near.join(left, F.col("proj_idx") == F.col("p_proj_idx")).join(right, F.col("donor_idx") == F.col("d_donor_idx"))
    return out.where(same_tenure(tenure)).select(*left.columns, *right.columns)


def match(project: DataFrame, donors: DataFrame, covs: Sequence[str], limits: Sequence[Caliper], cls: str = "texture_class", cfg: MatchConfig = MatchConfig(), metric: Metric | None = None) -> Matching:
    """Pair each project row (proj_idx) with its nearest donor (donor_idx) within all calipers.

    The class and, if both sides have one, the tenure column are calipers too: they must be equal,
    also where a class without donors of its own falls back on candidates of others.
    """
    metric = metric or fit_metric(project, donors, covs, cfg)
    counts = donors.groupBy(cls).agg(F.count(F.lit(1)).alias("donor_n"))
    have = {r[0]: r[1] for r in counts.where(F.col(cls).isNotNull()).collect()}  # a row a class
    allowed = allowed_classes(list(have), cfg.fallback)
    spark = project.sparkSession
    lists = spark.createDataFrame([(c, names, sum(have[x] for x in names), c in have) for c, names in allowed.items()], "_cls string, _allowed array<string>, donor_n long, texture_exact boolean")
    lists = lists.withColumn("k_query", adaptive_k(F.col("donor_n"), cfg))
    tenure = tenure_column(project, donors)
    more = [c.column for c in limits] + ([tenure] if tenure else [])
    keep_p = list(dict.fromkeys(["proj_idx", cls, *covs, *more]))
    keep_d = list(dict.fromkeys(["donor_idx", cls, *covs, *more]))
    left, right = _side(project.select(*keep_p), "p_"), _side(donors.select(*keep_d), "d_")
    passes = reduce(and_, [within(c, f"p_{c.column}", f"d_{c.column}") for c in limits], (F.col(f"p_{cls}") == F.col(f"d_{cls}")) & same_tenure(tenure))
    sides = project.select(*keep_p), donors.select(*keep_d)
    if cfg.mode == "caliper_first":
        near = candidates_by_bins(*sides, limits, cls, tenure=tenure)
        free = unrestricted(*sides, limits, cls, list(have), metric, max(cfg.matches_per_pixel, cfg.candidates), tenure)
        near = near if free is None else near.unionByName(free)
        cand = near.withColumns({"distance": whitened_distance(metric), "passed": F.lit(True)})
    else:
        k = max(cfg.matches_per_pixel, cfg.candidates)
        found = knn(project, donors, metric, k)
        cand = found.join(left, F.col("proj_idx") == F.col("p_proj_idx")).join(right, F.col("donor_idx") == F.col("d_donor_idx")).drop("proj_idx", "donor_idx", "rank")
    cand = cand.join(F.broadcast(lists), F.col(f"p_{cls}") == F.col("_cls")).where(F.array_contains("_allowed", F.col(f"d_{cls}")))
    if cfg.mode != "caliper_first":
        cand = cand.withColumn("passed", passes)
    w = Window.partitionBy("p_proj_idx").orderBy("distance", "d_donor_idx")
    cand = cand.withColumn("match_rank", F.row_number().over(w))
    if cfg.mode != "caliper_first":
        cand = cand.where(F.col("match_rank") <= F.col("k_query"))
    cand = cand.drop("_cls", "_allowed", "donor_n", "k_query")
    won = Window.partitionBy("p_proj_idx").orderBy(F.desc("passed"), "match_rank")
    cand = cand.withColumn("_won", F.row_number().over(won))
    per = Window.partitionBy("p_proj_idx")
    cand = cand.withColumn("rejected", F.sum((~F.col("passed")).cast("int")).over(per))
    every = cand
    if cfg.mode == "caliper_first":  # all of them pass: the nearest ones are enough for all but the candidates
        cand = nearest_within(*sides, limits, cls, metric, cfg.matches_per_pixel, tenure=tenure)
        near = cand.join(F.broadcast(lists), F.col(f"p_{cls}") == F.col("_cls"))
        cand = near.select(*cand.columns, "texture_exact", F.lit(True).alias("passed"), F.col("match_rank").alias("_won"), F.lit(0).cast("long").alias("rejected"))
    pairs = cand.where(F.col("passed") & (F.col("_won") <= cfg.matches_per_pixel)).drop("_won", "passed")
    pairs = flag_reuse(pairs.withColumn("match_distance", F.col("distance")).drop("distance"), cls, cfg.max_reuse)
    tested = cand.groupBy("p_proj_idx").agg(F.max("passed").alias("any_passed"), F.first("rejected").alias("rejected"), F.min("distance").alias("nearest"))
    base = project.select("proj_idx", cls).join(F.broadcast(lists), F.col(cls) == F.col("_cls"), "left").join(tested, F.col("proj_idx") == F.col("p_proj_idx"), "left").drop("p_proj_idx", "_cls", "_allowed")
    reason = F.when(F.col("donor_n").isNull(), "no_texture_donor").when(F.col("any_passed").isNull(), "no_texture_compatible_in_knn").when(~F.col("any_passed"), "no_candidate_passed_hard_calipers")
    unmatched = base.withColumn("reason", reason).where(F.col("reason").isNotNull())
    unmatched = unmatched.select("proj_idx", F.col(cls).alias("proj_texture"), "reason", F.when(F.col("reason") == "no_candidate_passed_hard_calipers", F.col("k_query")).alias("queried_n"))
    summary = base.groupBy(cls).agg(
        F.count(F.lit(1)).alias("proj_n"),
        F.coalesce(F.first("donor_n"), F.lit(0)).alias("donor_n"),
        F.first("k_query").alias("k_query"),
        F.coalesce(F.first("texture_exact"), F.lit(False)).alias("exact_texture"),
        F.count_if(F.coalesce("any_passed", F.lit(False))).alias("matched_n"),
        F.count_if(~F.coalesce("any_passed", F.lit(False))).alias("unmatched_n"),
        F.coalesce(F.sum("rejected"), F.lit(0)).alias("rejected_total"),
        F.avg("nearest").alias("mean_nn_dist"),
    )
    return Matching(pairs, unmatched, summary, every)


def whitened_distance(metric: Metric) -> Column:
    """Whitened distance between p_ and d_ columns of one row."""
    diff = [(F.col(f"p_{c}").cast("double") - F.col(f"d_{c}").cast("double")) / float(s) for c, s in zip(metric.covariates, metric.std)]
    out = []
    for j in range(metric.lower.shape[1]):
        out.append(F.pow(reduce(lambda a, b: a + b, [diff[i] * float(metric.lower[i, j]) for i in range(len(diff))]), F.lit(2)))
    return F.round(F.sqrt(reduce(lambda a, b: a + b, out)), DIGITS)


def flag_reuse(pairs: DataFrame, cls: str, max_reuse: int, donor: str = "d_donor_idx", proj: str = "p_proj_idx") -> DataFrame:
    """Adds the ordinal of a donor's use, in the order of class and project, and whether it is
    beyond max_reuse. A flag, not a rejection."""
    w = Window.partitionBy(donor).orderBy(f"p_{cls}", proj)
    use = F.row_number().over(w)
    return pairs.withColumn("donor_use", use).withColumn("reuse_exceeded", F.col("donor_use") > max_reuse)


def _in_order(max_reuse: int):
    """Pairs of one partition, gone through by distance, project and donor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if not batches:
            return
        t = pa.Table.from_batches(batches)
        proj, donor, used = (t.column(c).to_numpy() for c in ("p_proj_idx", "d_donor_idx", "used"))
        order = np.lexsort((donor, proj, t.column("distance").fill_null(-np.inf).to_numpy()))
        done: set[int] = set()
        uses: dict[int, int] = {}
        won = []
        for i, p, d, u in zip(order.tolist(), proj[order].tolist(), donor[order].tolist(), used[order].tolist()):
            if p not in done and (n := uses.get(d, u)) < max_reuse:
                done.add(p)
                uses[d] = n + 1
                won.append(i)
        yield from t.select(["p_proj_idx", "d_donor_idx", "distance"]).take(pa.array(won, pa.int64())).to_batches()

    return run


def enforce_reuse(cand: DataFrame, max_reuse: int, store=None, chunk: int = REUSE_CHUNK) -> DataFrame:
    """Pairs from passing candidates with no donor used more than max_reuse times.

    Greedy: in the order of distance, project and donor a pair is taken if its project is open
    and its donor has a free place. A round takes two parts of that result at once: pairs that
    come first for their project and within the free places of their donor, and those
    of the first `chunk` open pairs, gone through in order, which carries a group that
    shares one donor order over many donors. A round decides its whole chunk, so the rounds
    end by themselves, and only when no open pair is left. `store` cuts the lineage of a round,
    for instance with checkpoint().
    """
    store = store or (lambda df: df.checkpoint())
    names = ["p_proj_idx", "d_donor_idx", "distance"]
    open_ = store(cand.where("passed").select(*names))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in open_.schema.fields)
    best = Window.partitionBy("p_proj_idx").orderBy("distance", "d_donor_idx")
    win = Window.partitionBy("d_donor_idx").orderBy("distance", "p_proj_idx")
    taken: DataFrame | None = None
    while True:
        if taken is not None:
            used = taken.groupBy("d_donor_idx").agg(F.count(F.lit(1)).alias("used"))
            rest = open_.join(taken.select("p_proj_idx"), "p_proj_idx", "left_anti").join(used, "d_donor_idx", "left")
            rest = rest.select(*names, F.coalesce("used", F.lit(0).cast("long")).alias("used")).where(F.col("used") < max_reuse)
        else:
            rest = open_.withColumn("used", F.lit(0).cast("long"))
        asked = rest.withColumn("_r", F.row_number().over(best)).where("_r = 1").select(*names)
        first = rest.withColumn("_a", F.row_number().over(win)).where(F.col("_a") <= max_reuse).where(F.col("_a") + F.col("used") <= max_reuse)
        mutual = asked.join(first.select("p_proj_idx", "d_donor_idx"), ["p_proj_idx", "d_donor_idx"], "left_semi").select(*names)
        early = rest.orderBy("distance", "p_proj_idx", "d_donor_idx").limit(chunk).coalesce(1).mapInArrow(_in_order(max_reuse), schema)
        won = store(mutual.unionByName(early).distinct())
        if won.isEmpty():
            return won if taken is None else taken
        taken = won if taken is None else store(taken.unionByName(won))


def enforce_reuse_within(
    project: DataFrame, donors: DataFrame, limits: Sequence[Caliper], cls: str, metric: Metric, max_reuse: int, store=None,
    tenure: str | None = None, first: int = FIRST_CANDIDATES, growth: int = MORE_CANDIDATES,
) -> DataFrame:
    """`enforce_reuse` over all pairs within class, tenure and calipers, without writing all of them out.

    Projects bring their nearest `first` donors. One that all its donors refused and that may have more brings `growth` times
    as many, and the greedy pass is made again. What it gives is the pairing in which no pair prefers each other to what they
    have, which is unique where both sides go by the order of pairs; lists that begin with a project's nearest
    donors, and are complete for whoever got none, give the same one as all pairs.
    """
    store = store or (lambda df: df.checkpoint())

    def nearest(some: DataFrame, k: int) -> DataFrame:
        near = nearest_within(some, donors, limits, cls, metric, k, tenure=tenure)
        return store(near.select("p_proj_idx", "d_donor_idx", "distance", F.lit(True).alias("passed"), F.lit(k).alias("asked")))

    k = first
    lists = nearest(project, k)
    while True:
        taken = enforce_reuse(lists, max_reuse, store)
        full = lists.groupBy("p_proj_idx").agg(F.count(F.lit(1)).alias("n"), F.max("asked").alias("asked")).where("n >= asked")
        open_ = store(full.join(taken, "p_proj_idx", "left_anti").select("p_proj_idx"))
        if open_.isEmpty():
            return taken
        k *= growth
        more = nearest(project.join(open_.withColumnRenamed("p_proj_idx", "proj_idx"), "proj_idx", "left_semi"), k)
        lists = store(lists.join(open_, "p_proj_idx", "left_anti").unionByName(more.select(*lists.columns)))


def pair_table(pairs: DataFrame, project: DataFrame, donors: DataFrame, run_id: str = "run", shown: Sequence[str] = ("SOC_g_kg", "NDVI_t0", "elevation", "slope_deg", "dist_roads_km")) -> DataFrame:
    """The matched donor rows with proj_, ref_ and diff_ columns and the donor's native bounds."""
    p = project.select(F.col("proj_idx").alias("p_proj_idx"), *[F.col(c).alias(f"proj_{c}") for c in ("lon", "lat", "texture_class", *shown) if c in project.columns])
    keep = [c for c in donors.columns if c not in ("lon", "lat")]
    d = donors.select(*[F.col(c).alias("d_donor_idx" if c == "donor_idx" else c) for c in keep], *[F.col(c).alias(f"ref_{c}") for c in ("lon", "lat", "cell_xmin", "cell_ymin", "cell_xmax", "cell_ymax", "pixel_id", "grid_row", "grid_col", *shown) if c in donors.columns])
    out = pairs.select("p_proj_idx", "d_donor_idx", "match_distance", "match_rank", "rejected", "donor_use", "reuse_exceeded", "texture_exact")
    out = out.join(p, "p_proj_idx").join(d, "d_donor_idx").withColumns({"run_id": F.lit(run_id), "all_calipers_passed": F.lit(True)})
    for c in shown:
        if f"proj_{c}" in out.columns and f"ref_{c}" in out.columns:
            out = out.withColumn(f"diff_{c}", F.col(f"ref_{c}") - F.col(f"proj_{c}"))
    return out.withColumnsRenamed({"p_proj_idx": "proj_idx", "d_donor_idx": "donor_idx", "rejected": "hard_caliper_rejected_before_selected", "proj_texture_class": "proj_texture"})
