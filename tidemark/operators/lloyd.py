"""Many k-means fits at once: each pass over the points moves all of them one step.

A grid search is settings x folds x starts of one algorithm on one table. Here the driver
holds the centres of all fits, and Spark reads the points once per step: every task adds up
its points per fit and cluster, and one small aggregation merges the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.names import quoted
from tidemark.sources.layout import shared_folder
from tidemark.sources.writers import write_parquet

# Doubles that a task holds at once for the distances of some points to all centres.
DISTANCES = 2_000_000
# Distances that fit the caches of a core, points measured at once at least, and centres that
# are compared one by one, for all models of that size together.
NEAR_DISTANCES, LEAST_ROWS, FEW_CENTRES = 131_072, 64, 64
# Values of centres that travel with the tasks of a pass: 16 MB of doubles.
CENTRE_VALUES = 2_000_000
# Rounds of oversampling when centres are seeded, and candidates of a round per cluster.
SEED_ROUNDS, OVERSAMPLE = 2, 2
# The fold of a fit that leaves no point out.
EVERYTHING = -1


@dataclass(frozen=True)
class Fit:
    """One fit: ``fold`` is left out of it and scored, ``tol`` is relative to the variance."""

    n_clusters: int
    fold: int = EVERYTHING
    start: int = 0
    init: str = "k-means++"
    max_iter: int = 200
    tol: float = 1e-4


@dataclass
class Fitted:
    """What a fit ends with. ``cost`` is the inertia of its points, ``held_out`` that of the
    fold it left out, None without points there."""

    fit: Fit
    centres: np.ndarray
    cost: float = math.nan
    held_out: float | None = None
    steps: int = 0
    settled: bool = field(default=False, repr=False)


def as_rows(df: DataFrame, features: Sequence[str], fold: Column, key: str) -> DataFrame:
    """(fold, u, x): the points as arrays of doubles, with a hash of their key. A NULL or NaN
    feature is an error."""
    x = F.array(*[quoted(c).cast("double") for c in features])
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v))
    x = F.when(whole, x).otherwise(F.raise_error(F.lit("a feature is NULL or NaN")))
    return df.select(fold.cast("int").alias("fold"), F.xxhash64(key).alias("u"), x.alias("x"))


class Points:
    """Points (fold, u, x) ready for many passes: stored, cached, and read in a session in
    which each pass is one job. Use as a context, which drops the cache."""

    def __init__(self, rows: DataFrame):
        spark = rows.sparkSession
        path = shared_folder(spark)
        write_parquet(rows, path)
        # A pass ends in a few rows; there is nothing to adapt between its two stages.
        self.session: SparkSession = spark.newSession()
        self.session.conf.set("spark.sql.adaptive.enabled", "false")
        self.session.conf.set(
            "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
        )
        self.rows = self.session.read.parquet(path).persist(StorageLevel.MEMORY_AND_DISK)

    def __enter__(self) -> Points:
        self.measure()
        return self

    def __exit__(self, *_) -> None:
        self.rows.unpersist()

    def measure(self) -> None:
        """Number, mean and mean variance of the points, in one pass."""
        first = self.rows.select(F.size("x").alias("dims")).first()
        if first is None:
            raise ValueError("no rows to cluster")
        self.dims = first["dims"]
        each = [F.get("x", F.lit(i)) for i in range(self.dims)]
        row = self.rows.agg(F.count("*"), *map(F.avg, each), *map(F.var_pop, each)).first()
        self.count = row[0]
        self.origin = np.array(row[1 : 1 + self.dims], float)
        self.variance = float(np.mean(row[1 + self.dims :]))


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


class _Models:
    """Centres of several models, those of one size side by side."""

    def __init__(self, centres: Sequence[np.ndarray], folds: Sequence[int], origin: np.ndarray):
        self.origin = origin
        order = sorted(range(len(centres)), key=lambda i: len(centres[i]))
        self.ids = np.array(order)
        self.folds = np.array([folds[i] for i in order])
        self.sizes = np.array([len(centres[i]) for i in order])
        self.all = np.concatenate([centres[i] - origin for i in order])
        self.squares = (self.all**2).sum(1)
        self.offsets = np.cumsum([0, *self.sizes])
        # Runs of models of one size: the first model, the one past the last, the size.
        cuts = [0, *(np.flatnonzero(np.diff(self.sizes)) + 1), len(order)]
        self.runs = [(a, b, int(self.sizes[a])) for a, b in zip(cuts, cuts[1:])]

    def chunks(self, x: np.ndarray) -> Iterator[slice]:
        rows = max(1, DISTANCES // len(self.all))
        return (slice(i, i + rows) for i in range(0, len(x), rows))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place in ``all`` of each point's nearest centre of each model, and its squared
        distance; ``x`` is relative to the origin."""
        gaps = (x**2).sum(1)[:, None] - 2 * (x @ self.all.T) + self.squares
        places = np.empty((len(x), len(self.ids)), np.int64)
        least = np.empty((len(x), len(self.ids)))
        for a, b, size in self.runs:
            block = gaps[:, self.offsets[a] : self.offsets[b]].reshape(len(x), b - a, size)
            best = block.argmin(2)
            places[:, a:b] = best + self.offsets[a:b]
            least[:, a:b] = np.take_along_axis(block, best[:, :, None], 2)[:, :, 0]
        return places, np.maximum(least, 0.0)

    def added(self, a: int, b: int, size: int, x: np.ndarray, fold: np.ndarray) -> np.ndarray:
        """For a run of models of one size: numbers, costs and sums of components of the points
        at each centre of each model, and behind these of the points of its fold."""
        models, dims = b - a, x.shape[1]
        own = slice(self.offsets[a], self.offsets[b])
        # The first centres of all models, the second ones, and so on, less the square of x.
        sides = np.column_stack([-2 * self.all[own], self.squares[own]])
        sides = sides.reshape(models, size, dims + 1).swapaxes(0, 1).reshape(-1, dims + 1)
        first = np.arange(models)[:, None] * (size + 1)
        slots = models * (size + 1)
        out = np.zeros((2 + dims, slots))
        rows = max(1, min(DISTANCES // len(sides), max(LEAST_ROWS, NEAR_DISTANCES // len(sides))))
        for i in range(0, len(x), rows):
            part = np.vstack([x[i : i + rows].T, np.ones(len(x[i : i + rows]))])
            gaps = (sides @ part).reshape(size, models, -1)
            if size > FEW_CENTRES:
                place = gaps.argmin(0)
                least = np.take_along_axis(gaps, place[None], 0)[0]
            else:
                least, place = gaps[0].copy(), np.zeros(gaps.shape[1:], np.int8)
                for c in range(1, size):
                    np.maximum(place, (gaps[c] < least) * np.int8(c), out=place)
                    np.minimum(least, gaps[c], out=least)
            least = np.maximum(least + (part[:dims] ** 2).sum(0), 0.0)
            place[self.folds[a:b, None] == fold[i : i + rows]] = size
            flat = (first + place).ravel()
            out[0] += np.bincount(flat, minlength=slots)
            out[1] += np.bincount(flat, least.ravel(), slots)
            for d in range(dims):
                out[2 + d] += np.bincount(flat, np.tile(part[d], models), slots)
        return out


def step_sums(
    rows: DataFrame,
    centres: Sequence[np.ndarray],
    folds: Sequence[int],
    origin: np.ndarray | None = None,
) -> DataFrame:
    """One step of many models in one pass: (model, cluster, n, cost, sums).

    Every point outside a model's fold counts at its nearest centre, the first of equally near
    ones: how many, their squared distances, and the sums of their components. Points of the
    model's fold count under cluster -1, where the sums are not used. Clusters without points
    are missing.
    """
    dims = centres[0].shape[1]
    models = _Models(centres, folds, np.zeros(dims) if origin is None else origin)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = len(models.all)
        n, cost, sums = np.zeros(total), np.zeros(total), np.zeros((total, dims))
        held_n, held_cost = np.zeros(len(models.ids)), np.zeros(len(models.ids))
        for batch in batches:
            whole = _matrix(batch, dims) - models.origin
            fold = batch.column("fold").to_numpy(zero_copy_only=False)
            for a, b, size in models.runs:
                own = slice(models.offsets[a], models.offsets[b])
                shape = b - a, size + 1
                found = models.added(a, b, size, whole, fold)
                n[own] += found[0].reshape(shape)[:, :size].ravel()
                cost[own] += found[1].reshape(shape)[:, :size].ravel()
                for d in range(dims):
                    sums[own, d] += found[2 + d].reshape(shape)[:, :size].ravel()
                held_n[a:b] += found[0].reshape(shape)[:, size]
                held_cost[a:b] += found[1].reshape(shape)[:, size]
        sums += n[:, None] * models.origin
        owner = np.repeat(np.arange(len(models.ids)), models.sizes)
        some, apart = np.flatnonzero(n), np.flatnonzero(held_n)
        nothing = np.zeros((len(apart), dims))
        lists = np.concatenate([sums[some], nothing])
        offsets = np.arange(0, lists.size + 1, dims, dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([models.ids[owner[some]], models.ids[apart]]), pa.int32()),
                pa.array(
                    np.concatenate([some - models.offsets[owner[some]], np.full(len(apart), -1)]),
                    pa.int32(),
                ),
                pa.array(np.concatenate([n[some], held_n[apart]]).astype(np.int64)),
                pa.array(np.concatenate([cost[some], held_cost[apart]])),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(lists.ravel())),
            ],
            names=["model", "cluster", "n", "cost", "sums"],
        )

    schema = "model int, cluster int, n long, cost double, sums array<double>"
    merged = rows.mapInArrow(add_up, schema).groupBy("model", "cluster").agg(
        F.sum("n").alias("n"),
        F.sum("cost").alias("cost"),
        F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(dims)]).alias("sums"),
    )
    return merged


def _spread(u: np.ndarray, seed: int) -> np.ndarray:
    """Numbers evenly in (0, 1), from the hashes of the points and a seed."""
    x = u.astype(np.uint64) ^ np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)) + 0.5) / 2.0**53


def _sampled(
    points: Points, found: list[np.ndarray], folds: Sequence[int], seeds: Sequence[int], count: int
) -> list[np.ndarray]:
    """``count`` more points for every set of centres, drawn without replacement with weights
    of squared distance to the set, or evenly where it is empty.

    A point's key is an exponential variate over its weight; the least keys are the sample.
    Keys come from the point's hash, so a sample does not depend on how the points are
    split, and tasks merge by keeping the least of their keys.
    """
    dims, origin = points.dims, points.origin
    some = [i for i, c in enumerate(found) if len(c)]
    models = _Models([found[i] for i in some], [folds[i] for i in some], origin) if some else None
    slot = {i: j for j, i in enumerate(models.ids)} if some else {}

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [(np.zeros(0), np.zeros((0, dims))) for _ in found]
        for batch in batches:
            whole = _matrix(batch, dims)
            u = batch.column("u").to_numpy(zero_copy_only=False)
            fold = batch.column("fold").to_numpy(zero_copy_only=False)
            for part in models.chunks(whole) if models else [slice(None)]:
                x = whole[part]
                weights = models.nearest(x - origin)[1] if models else None
                for i, seed in enumerate(seeds):
                    key = -np.log(_spread(u[part], seed))
                    if i in slot:
                        with np.errstate(divide="ignore"):
                            key = key / weights[:, slot[i]]
                    key[fold[part] == folds[i]] = np.inf
                    good = np.flatnonzero(np.isfinite(key))
                    if len(good) > count:
                        good = good[np.argpartition(key[good], count - 1)[:count]]
                    keys = np.concatenate([kept[i][0], key[good]])
                    both = np.concatenate([kept[i][1], x[good]])
                    least = np.argsort(keys, kind="stable")[:count]
                    kept[i] = keys[least], both[least]
        each = [np.full(len(k), i) for i, (k, _) in enumerate(kept)]
        lists = np.concatenate([v for _, v in kept])
        offsets = np.arange(0, lists.size + 1, dims, dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(each).astype(np.int32)),
                pa.array(np.concatenate([k for k, _ in kept])),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(lists.ravel())),
            ],
            names=["set", "key", "x"],
        )

    drawn = points.rows.mapInArrow(draw, "set int, key double, x array<double>")
    order = Window.partitionBy("set").orderBy("key", "x")
    drawn = drawn.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
    out: list[list] = [[] for _ in found]
    for r in sorted(drawn.collect(), key=lambda r: r["rank"]):
        out[r["set"]].append(r["x"])
    return [np.array(x, float).reshape(-1, dims) for x in out]


def _plus_plus(candidates: np.ndarray, weights: np.ndarray, k: int, rng) -> np.ndarray:
    """k of the weighted candidates, each with a chance of its weight times its squared
    distance to those before it; fewer if fewer differ."""
    chosen = [int(rng.choice(len(candidates), p=weights / weights.sum()))]
    gaps = ((candidates - candidates[chosen[0]]) ** 2).sum(1)
    while len(chosen) < k and (gaps * weights).sum() > 0:
        chance = gaps * weights
        chosen.append(int(rng.choice(len(candidates), p=chance / chance.sum())))
        gaps = np.minimum(gaps, ((candidates - candidates[chosen[-1]]) ** 2).sum(1))
    return candidates[chosen]


def seed_centres(
    points: Points, fits: Sequence[Fit], seed: int, most: int | None = None
) -> list[np.ndarray]:
    """First centres of all fits. Fits of one fold and start share their candidates, whatever
    their number of clusters, so seeding takes four passes for any grid. There are candidates
    enough for ``most`` clusters, by default as many as the largest fit has.

    The candidates of ``k-means++`` are oversampled by distance in a few rounds, weighted by
    the points nearest to them, and thinned out on the driver (k-means||); ``random`` takes
    the first of an even sample.
    """
    sets = sorted({(f.fold, f.start) for f in fits})
    folds = [fold for fold, _ in sets]
    most = most or max(f.n_clusters for f in fits)

    def seeds(turn: int) -> list[int]:
        return [(seed + start) * 101 + turn for _, start in sets]

    even = _sampled(points, [np.zeros((0, points.dims))] * len(sets), folds, seeds(0), most)
    found = [x[:1] for x in even]
    weights: dict[int, np.ndarray] = {}
    if any(f.init != "random" for f in fits):
        for turn in range(1, SEED_ROUNDS + 1):
            more = _sampled(points, found, folds, seeds(turn), OVERSAMPLE * most)
            found = [np.concatenate(pair) for pair in zip(found, more)]
        some = [i for i, c in enumerate(found) if len(c)]
        sums = step_sums(points.rows, [found[i] for i in some], [folds[i] for i in some], points.origin)
        weights = {i: np.zeros(len(found[i])) for i in some}
        for r in sums.where("cluster >= 0").select("model", "cluster", "n").collect():
            weights[some[r["model"]]][r["cluster"]] = r["n"]
    out = []
    for f in fits:
        i = sets.index((f.fold, f.start))
        if f.init == "random" or not len(found[i]):
            out.append(np.unique(even[i][: f.n_clusters], axis=0))
        else:
            rng = np.random.default_rng([seed, f.start, f.n_clusters])
            out.append(_plus_plus(found[i], weights[i], f.n_clusters, rng))
    return out


def _together(fits: Sequence[Fit], dims: int) -> Iterator[list[int]]:
    """Fits whose centres, and the candidates for them, have a bounded number of values."""
    part, room = [], CENTRE_VALUES
    for i, f in enumerate(fits):
        size = f.n_clusters * (1 + OVERSAMPLE * SEED_ROUNDS) * dims
        if part and size > room:
            yield part
            part, room = [], CENTRE_VALUES
        part.append(i)
        room -= size
    yield part


def fit_all(points: Points, fits: Sequence[Fit], seed: int = 42) -> list[Fitted]:
    """All fits, by Lloyd's steps that they take together.

    A fit settles when the squared shifts of its centres sum to at most ``tol`` times the mean
    variance of the features, or after ``max_iter`` steps; the pass after that scores it, on its
    own points and on the fold it left out. A cluster that loses all its points keeps its
    centre. There are as many passes as the slowest fit has steps, one more to score it, and
    four to seed; each is one job. Fits whose centres have more values than may travel with a
    task go in several turns, with the same results.
    """
    out: list[Fitted | None] = [None] * len(fits)
    most = max(f.n_clusters for f in fits)
    for part in _together(fits, points.dims):
        some = [fits[i] for i in part]
        found = [Fitted(f, c) for f, c in zip(some, seed_centres(points, some, seed, most))]
        active = [f for f in found if len(f.centres)]
        while active:
            _advance(points, active)
            active = [f for f in active if math.isnan(f.cost)]
        for i, f in zip(part, found):
            out[i] = f
    return out


def _advance(points: Points, active: list[Fitted]) -> None:
    """One pass: settled fits get their scores, the others their next centres."""
    sums = step_sums(
        points.rows, [f.centres for f in active], [f.fit.fold for f in active], points.origin
    )
    new = [f.centres.copy() for f in active]
    cost = [0.0] * len(active)
    held: list[float | None] = [None] * len(active)
    for r in sums.collect():
        model = r["model"]
        if r["cluster"] < 0:
            held[model] = r["cost"]
        else:
            cost[model] += r["cost"]
            new[model][r["cluster"]] = np.array(r["sums"]) / r["n"]
    for i, f in enumerate(active):
        if f.settled or f.fit.max_iter <= f.steps:
            f.cost, f.held_out = cost[i], held[i]
            continue
        shift = ((new[i] - f.centres) ** 2).sum()
        f.centres, f.steps = new[i], f.steps + 1
        f.settled = bool(shift <= f.fit.tol * points.variance) or f.steps >= f.fit.max_iter
