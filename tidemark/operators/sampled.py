"""Silhouette with plain distances in linear time, from weighted samples of the clusters.

The exact measure needs the distances of all pairs. Here the sum of a point's distances to a
cluster is estimated from some points of the cluster, drawn with known chances, so every
point is scored and the error is known as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.lookup import lookup_join
from tidemark.operators.quality import CENTRE_ROWS, cluster_count, cluster_spread
from tidemark.sources.layout import shared_folder
from tidemark.sources.writers import write_parquet

# Points drawn from a cluster, as an expectation, and the groups they are dealt into.
PER_CLUSTER, GROUPS = 256, 8
# Values of sampled points that travel with the tasks of a pass, and distances of a step.
SAMPLE_VALUES, DISTANCES = 4_000_000, 2_000_000


def cluster_samples(
    points: DataFrame, n_clusters: int, per_cluster: int = PER_CLUSTER, seed: int = 42
) -> DataFrame:
    """(label, size, x, chance, grp): some points (key, label, x) of every cluster.

    A point enters by itself with the chance ``per_cluster`` times half its share of the
    points plus half its share of the distances to the centre of its cluster, at most 1: far
    points count for more in a sum of distances. A cluster of up to half as many points as
    ``per_cluster`` enters whole. The draw is a hash of key and point, so it is the same for
    any split of the rows. The points are dealt into groups, from which errors are estimated.
    """
    facts = cluster_spread(points, n_clusters).select("label", F.struct("n", "centre", "mean_distance").alias("of"))
    if n_clusters > CENTRE_ROWS:
        known = lookup_join(points, facts, "label", "key")
    else:
        whole = facts.agg(F.map_from_entries(F.collect_list(F.struct("label", "of"))))
        known = points.withColumn("of", F.try_element_at(whole.scalar(), F.col("label")))
    gap = F.sqrt(F.aggregate(F.zip_with("x", "of.centre", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, d: s + d))
    size = F.col("of.n").cast("double")
    share = F.coalesce(F.try_divide(gap, size * F.col("of.mean_distance")), 1 / size)
    chance = F.least(F.lit(1.0), per_cluster * (1 / size + share) / 2)
    draw = F.xxhash64("key", "x", F.lit(seed))
    even = (F.shiftrightunsigned(draw, 11) + 0.5) / 2.0**53
    drawn = known.withColumn("chance", chance).where(even < F.col("chance"))
    group = F.pmod(F.xxhash64(draw), F.lit(GROUPS)).cast("int")
    return drawn.select("label", F.col("of.n").alias("size"), "x", "chance", group.alias("grp"))


class _Sample:
    """Sampled points of some clusters, sorted by cluster, with what they stand for."""

    def __init__(self, rows: list, dims: int, squared: bool):
        self.labels = sorted({r["label"] for r in rows})
        codes = {label: i for i, label in enumerate(self.labels)}
        rows = sorted(rows, key=lambda r: codes[r["label"]])
        self.x = np.array([r["x"] for r in rows], float).reshape(-1, dims)
        self.squared = squared
        chance = np.array([r["chance"] for r in rows])
        group = np.array([r["grp"] for r in rows])
        # Without a group the others stand for it; less so the more of the cluster is drawn,
        # and not at all where everything is.
        part = np.sqrt(1 - chance)
        change = [np.where(group == g, -part, part / (GROUPS - 1)) for g in range(GROUPS)]
        self.weights = np.stack([np.ones(len(rows)), *(1 + c for c in change)]) / chance
        codes_of = np.array([codes[r["label"]] for r in rows])
        self.starts = np.searchsorted(codes_of, np.arange(len(self.labels)))
        self.sizes = np.array([rows[s]["size"] for s in self.starts], float)
        # How many points the sample stands for; near the size, and in a ratio to the sums of
        # distances what is off cancels out.
        self.stands_for = np.add.reduceat(self.weights, self.starts, axis=1)

    def means(self, x: np.ndarray) -> np.ndarray:
        """Estimated mean distances to all points of a cluster, of shape (estimates, points,
        clusters): with all groups, and without each."""
        squares = np.zeros((len(x), len(self.x)))
        for i in range(x.shape[1]):
            squares += (x[:, i, None] - self.x[None, :, i]) ** 2
        far = squares if self.squared else np.sqrt(squares)
        sums = np.stack([np.add.reduceat(far * w, self.starts, axis=1) for w in self.weights])
        with np.errstate(divide="ignore", invalid="ignore"):
            return sums / self.stands_for[:, None]


def _against(points: DataFrame, sample: _Sample) -> DataFrame:
    """Adds to ``a`` and ``b``, the estimates of a point's mean distance to its own cluster and
    to the nearest other one, what the sampled clusters give."""
    types = dict(points.dtypes)
    known = "a" in types

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = {label: i for i, label in enumerate(sample.labels)}
        shape = 1 + GROUPS
        for batch in batches:
            n = batch.num_rows
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1))
            own = np.array([codes.get(v, -1) for v in batch.column("label").to_pylist()], np.int64)
            a, b = np.full((n, shape), np.nan), np.full((n, shape), np.inf)
            if known:
                a = batch.column("a").flatten().to_numpy(zero_copy_only=False).reshape(n, shape).copy()
                b = batch.column("b").flatten().to_numpy(zero_copy_only=False).reshape(n, shape).copy()
            step = max(1, DISTANCES // len(sample.x))
            for begin in range(0, n, step):
                rows = slice(begin, begin + step)
                means = sample.means(x[rows])
                at = np.flatnonzero(own[rows] >= 0)
                code = own[rows][at]
                with np.errstate(divide="ignore", invalid="ignore"):
                    # The distance of a point to itself is 0, and not among the others.
                    others = sample.sizes[code] / (sample.sizes[code] - 1)
                    a[begin + at] = (means[:, at, code] * others).T
                means[:, at, code] = np.inf
                b[rows] = np.fmin(b[rows], means.min(2).T)
            offsets = pa.array(np.arange(0, n * shape + 1, shape, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("label"),
                    batch.column("x"),
                    pa.ListArray.from_arrays(offsets, pa.array(a.ravel())),
                    pa.ListArray.from_arrays(offsets, pa.array(b.ravel())),
                ],
                names=["key", "label", "x", "a", "b"],
            )

    schema = f"key {types['key']}, label {types['label']}, x array<double>, a array<double>, b array<double>"
    return points.mapInArrow(measure, schema)


def _turns(labels: list, sizes: dict, dims: int) -> Iterator[list]:
    """Labels whose samples have a bounded number of values together."""
    part, room = [], SAMPLE_VALUES
    for label in labels:
        values = sizes[label] * dims
        if part and values > room:
            yield part
            part, room = [], SAMPLE_VALUES
        part.append(label)
        room -= values
    if part:
        yield part


def silhouette_estimates(
    points: DataFrame, per_cluster: int = PER_CLUSTER, squared: bool = False, seed: int = 42
) -> DataFrame:
    """(key, label, silhouette, error, without): the silhouette of every point (key, label, x).

    Mean distances come from :func:`cluster_samples`; with clusters that enter whole the
    silhouette is exact. ``error`` is its standard error by the jackknife over the groups of
    the sample, and ``without`` holds the silhouettes without each group. A point alone in its
    cluster has 0, and so has every point if there is one cluster. ``squared`` takes squared
    distances.

    The work is points times clusters times ``per_cluster``; no pair of points is a row. Samples
    travel with the tasks as long as they have few values; more clusters take more passes.
    """
    n_clusters = cluster_count(points)
    folder = shared_folder(points.sparkSession)
    write_parquet(cluster_samples(points, n_clusters, per_cluster, seed), folder)
    drawn = points.sparkSession.read.parquet(folder)
    counted = {r["label"]: r["count"] for r in drawn.groupBy("label").count().collect()}
    first = drawn.select(F.size("x")).first()
    dims = first[0] if first else 1
    state = points
    turns = list(_turns(sorted(counted), counted, dims))
    for i, labels in enumerate(turns):
        rows = drawn if len(turns) == 1 else drawn.where(F.col("label").isin(labels))
        state = _against(state, _Sample(rows.collect(), dims, squared))
        if i < len(turns) - 1:
            folder = shared_folder(points.sparkSession)
            write_parquet(state, folder)
            state = points.sparkSession.read.parquet(folder)
    if not turns:
        nothing = F.lit(None).cast("array<double>")
        state = points.withColumns({"a": nothing, "b": nothing})

    def width(a, b):
        good = ~F.isnan(a) & (b < F.lit(float("inf")))
        return F.when(good, F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0))).otherwise(0.0)

    widths = state.select("key", "label", F.zip_with("a", "b", width).alias("widths"))
    whole = F.get("widths", F.lit(0))
    without = F.slice("widths", 2, GROUPS)
    off = F.aggregate(without, F.lit(0.0), lambda s, w: s + (w - whole) * (w - whole))
    return widths.select(
        "key",
        "label",
        whole.alias("silhouette"),
        F.sqrt(off * ((GROUPS - 1) / GROUPS)).alias("error"),
        without.alias("without"),
    )


def silhouette_of_sample(
    points: DataFrame, per_cluster: int = PER_CLUSTER, squared: bool = False, seed: int = 42
) -> DataFrame:
    """One row (n, silhouette, standard_error, bound): the mean over all points, each of them
    scored. By the jackknife, its bias is taken off and its standard error known; ``bound`` is
    three standard errors and the bias, as much as the mean may be off."""
    each = silhouette_estimates(points, per_cluster, squared, seed)
    means = [F.avg(F.get("without", F.lit(g))) for g in range(GROUPS)]
    row = each.agg(F.count("*").alias("n"), F.avg("silhouette").alias("silhouette"), F.array(*means).alias("means"))
    total = F.aggregate("means", F.lit(0.0), lambda s, m: s + m)
    centre = total / GROUPS
    off = F.aggregate("means", F.lit(0.0), lambda s, m: s + (m - centre) * (m - centre))
    # The nearest of several estimates is too near; what leaving a group out changes on
    # average tells by how much, nearly.
    bias = (GROUPS - 1) * (centre - F.col("silhouette"))
    error = F.sqrt(off) * sqrt((GROUPS - 1) / GROUPS)
    return row.select(
        "n",
        (F.col("silhouette") - bias).alias("silhouette"),
        error.alias("standard_error"),
        (3 * error + F.abs(bias) + 1e-12).alias("bound"),
    )
