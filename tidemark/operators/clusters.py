"""k-means: grid search, single fits on Spark ML, assignment, and data for the cluster charts."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations, product
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.names import quoted
from tidemark.functions.numbers import squared_distance
from tidemark.operators.lloyd import EVERYTHING, Fit, Fitted, Points, as_rows, fit_all
from tidemark.operators.ordering import contiguous_parts
from tidemark.operators.shape import union_by_position
from tidemark.params import ClusterParams

# Names of the starting methods, and what Spark ML calls them.
START_METHODS = {"k-means++": "k-means||", "k-means||": "k-means||", "random": "random"}

VECTOR = "_features"

# Values of centres that are broadcast together: 16 MB of doubles.
BROADCAST_VALUES = 2_000_000


@dataclass(frozen=True)
class GridPoint:
    """One setting of the grid."""

    n_clusters: int
    init: str
    max_iter: int
    tol: float


@dataclass(frozen=True)
class GridResult:
    """What the grid search gives: the refitted model and small report tables."""

    model: KMeansModel
    scores: DataFrame
    curve: DataFrame
    best_params: DataFrame
    eval_params: DataFrame


def grid_points(params: ClusterParams) -> list[GridPoint]:
    """All settings, k first."""
    return [
        GridPoint(k, init, max_iter, tol)
        for k, init, max_iter, tol in product(
            range(2, params.max_n_cluster),
            params.starting_point_method,
            params.max_iter,
            params.distortion_tol,
        )
    ]


def with_vector(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add the feature vector."""
    return VectorAssembler(inputCols=list(features), outputCol=VECTOR).transform(df)


def fold_of(key: str, folds: int) -> Column:
    """The fold of a row, 0 .. folds-1, by a hash of its key."""
    return F.pmod(F.xxhash64(key), F.lit(folds)).cast("int")


def with_fold(df: DataFrame, key: str, folds: int) -> DataFrame:
    """Add ``fold``, 0 .. folds-1, by a hash of the key."""
    return df.withColumn("fold", fold_of(key, folds))


def mean_variance(vectors: DataFrame) -> float:
    """Mean over the features of their variance; the scale of a tolerance."""
    row = vectors.agg(
        F.count("*").alias("n"),
        vector_to_array(Summarizer.variance(F.col(VECTOR))).alias("v"),
    ).first()
    if not row["n"]:
        raise ValueError("no rows to cluster")
    return sum(row["v"]) / len(row["v"]) * (row["n"] - 1) / row["n"]


def _estimator(k: int, init: str, max_iter: int, shift: float, seed: int) -> KMeans:
    return KMeans(
        k=k,
        initMode=START_METHODS[init],
        maxIter=max_iter,
        tol=shift,
        seed=seed,
        featuresCol=VECTOR,
        predictionCol="cluster_labels",
    )


def fit_kmeans(
    vectors: DataFrame,
    point: GridPoint,
    seed: int,
    variance: float | None = None,
    n_init: int = 1,
) -> KMeansModel:
    """k-means with one setting on a frame that has the feature vector: of ``n_init`` starts,
    with seeds counted on from ``seed``, the fit of the lowest cost.

    ``tol`` is relative, as usual for k-means: the fit ends when the squared shifts of all
    centres sum to ``tol`` times the mean variance of the features. Spark ML bounds the
    shift of each centre, so it is given each centre's share of that sum. Without a
    known ``variance`` it takes a pass of its own, and rows read more than once are cached.
    """
    cached = vectors.storageLevel != StorageLevel.NONE
    own_cache = not cached and (variance is None or n_init > 1)
    if own_cache:
        vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if variance is None:
            variance = mean_variance(vectors)
        shift = math.sqrt(point.tol * variance / point.n_clusters)
        starts = (
            _estimator(point.n_clusters, point.init, point.max_iter, shift, seed + i)
            for i in range(n_init)
        )
        fits = (start.fit(vectors) for start in starts)
        return min(fits, key=lambda model: model.summary.trainingCost)
    finally:
        if own_cache:
            vectors.unpersist()


def centre_lists(model: KMeansModel) -> list[list[float]]:
    """The cluster centres as plain lists."""
    return [[float(x) for x in c] for c in model.clusterCenters()]


def held_out_inertia(
    folded: DataFrame, fitted: Sequence[tuple[int, int, list[list[float]]]]
) -> DataFrame:
    """(point, fold, inertia): sum of squared distances of a fold's rows to their nearest
    centre, for centres given as (point, fold, centres). One pass scores as many of them as
    fit in a broadcast of bounded size; a longer grid takes more passes.
    """
    spark = folded.sparkSession
    x = F.col("_x")
    nearest = F.array_min(F.transform("centres", lambda c: squared_distance(x, c)))
    rows = folded.select("fold", vector_to_array(VECTOR).alias("_x"))
    parts = []
    for some in _within_broadcast(fitted):
        table = spark.createDataFrame(
            some, "point int, fold int, centres array<array<double>>"
        )
        scored = rows.join(F.broadcast(table), "fold").groupBy("point", "fold")
        parts.append(scored.agg(F.sum(nearest).alias("inertia")))
    return union_by_position(parts)


def _within_broadcast(fitted: Sequence[tuple[int, int, list[list[float]]]]) -> list[list]:
    """The fits cut into lists whose centres have a bounded number of values in all."""
    parts: list[list] = [[]]
    room = BROADCAST_VALUES
    for fit in fitted:
        size = sum(len(c) for c in fit[2])
        if parts[-1] and size > room:
            parts.append([])
            room = BROADCAST_VALUES
        parts[-1].append(fit)
        room -= size
    return parts


def _held_out_silhouette(
    folded: DataFrame, fitted: Sequence[tuple[int, int, list[list[float]]]], threads: int
) -> dict[tuple[int, int], float]:
    def score(item):
        p, fold, centres = item
        rows = folded.filter(F.col("fold") == fold)
        x = vector_to_array(VECTOR)
        rows = rows.select(VECTOR, nearest_centre(x, centres).alias("cluster_labels"))
        if rows.select("cluster_labels").distinct().limit(2).count() < 2:
            # All rows of the fold in one cluster: the lowest value there is.
            return (p, fold), None if rows.isEmpty() else -1.0
        value = ClusteringEvaluator(
            featuresCol=VECTOR, predictionCol="cluster_labels"
        ).evaluate(rows)
        return (p, fold), float(value)

    with ThreadPool(threads) as pool:
        return {key: value for key, value in pool.map(score, fitted) if value is not None}


def model_of(
    spark: SparkSession, centres: Sequence[Sequence[float]], point: GridPoint, shift: float
) -> KMeansModel:
    """A stored-model type with given centres and the settings that led to them.

    Started at random from as many points as clusters, k-means takes each of them. A model has
    two centres at least.
    """
    if len(centres) < 2:
        raise ValueError("all rows are equal: there is nothing to cluster")
    rows = spark.createDataFrame([(DenseVector(c),) for c in centres], [VECTOR])
    fit = _estimator(len(centres), "random", 1, 0.0, 0).fit(rows.coalesce(1))
    return fit.copy(
        {fit.initMode: START_METHODS[point.init], fit.maxIter: point.max_iter, fit.tol: shift}
    )


def kmeans_grid(
    df: DataFrame,
    features: Sequence[str],
    params: ClusterParams = ClusterParams(),
    key: str = "player_id",
) -> GridResult:
    """Cross-validated grid search: fit each setting without each fold, score it on the
    fold, keep the setting with the best mean and refit it on all rows.

    Of ``params.n_init`` starts of a fit the one of the lowest cost counts. All fits of the
    grid advance together, one pass over the rows per step (:mod:`tidemark.operators.lloyd`),
    and are scored in the same passes. ``metric='inertia'`` prefers the lowest held-out inertia,
    ``'silhouette'`` the highest held-out silhouette, which takes a few jobs per fit,
    ``params.parallelism`` at a time. A fold without rows has no score and stays out of the
    mean; one whose rows fall into a single cluster has the lowest silhouette.
    """
    spark = df.sparkSession
    points, starts = grid_points(params), range(params.n_init)
    folds = range(params.cross_validations)
    fold_column = fold_of(key, len(folds))
    if params.folds == "contiguous":
        df = contiguous_parts(df, key, len(folds), "_fold")
        fold_column = F.col("_fold")
    with Points(as_rows(df, features, fold_column, key)) as ready:

        def fits(i: int, fold: int) -> list[Fit]:
            p = points[i]
            return [Fit(p.n_clusters, fold, s, p.init, p.max_iter, p.tol) for s in starts]

        def best_of(found: Sequence[Fitted]) -> Fitted:
            return min(found, key=lambda f: (math.isnan(f.cost), f.cost))

        jobs = [(i, fold) for i in range(len(points)) for fold in folds]
        found = fit_all(ready, [f for job in jobs for f in fits(*job)], params.random_state)
        best = {
            job: best_of(found[n * len(starts) : (n + 1) * len(starts)])
            for n, job in enumerate(jobs)
        }
        if params.metric == "inertia":
            values = {job: f.held_out for job, f in best.items() if f.held_out is not None}
        else:
            folded = with_vector(df, features).select(fold_column.alias("fold"), VECTOR)
            centres = [(*job, f.centres.tolist()) for job, f in best.items() if len(f.centres)]
            values = _held_out_silhouette(folded, centres, params.parallelism)
        means = {
            i: sum(own) / len(own)
            for i in range(len(points))
            if (own := [v for (j, _), v in values.items() if j == i])
        }
        pick = min if params.metric == "inertia" else max
        chosen = pick(means, key=lambda i: means[i])
        refit = best_of(fit_all(ready, fits(chosen, EVERYTHING), params.random_state))
        point = points[chosen]
        shift = math.sqrt(point.tol * ready.variance / point.n_clusters)
        model = model_of(spark, refit.centres.tolist(), point, shift)

    scores = spark.createDataFrame(
        [
            (p.n_clusters, p.init, p.max_iter, p.tol, fold, float(values[i, fold]))
            for i, p in enumerate(points)
            for fold in folds
            if (i, fold) in values
        ],
        "n_clusters int, init string, max_iter int, tol double, fold int, "
        f"{params.metric} double",
    )
    return GridResult(
        model=model,
        scores=scores,
        curve=score_curve(scores, params.metric),
        best_params=spark.createDataFrame(
            [_texts(point)],
            "n_clusters string, init string, max_iter string, tol string",
        ),
        eval_params=spark.createDataFrame(
            [
                (
                    str(list(range(2, params.max_n_cluster))),
                    str(list(params.starting_point_method)),
                    str(list(params.max_iter)),
                    str(list(params.distortion_tol)),
                    params.random_state,
                )
            ],
            "n_clusters string, init string, max_iter string, tol string, "
            "random_state int",
        ),
    )


def _texts(point: GridPoint) -> tuple[str, str, str, str]:
    return str(point.n_clusters), point.init, str(point.max_iter), str(point.tol)


def score_curve(scores: DataFrame, metric: str = "inertia") -> DataFrame:
    """Mean score over the folds per setting, in order of k."""
    keys = ["n_clusters", "init", "max_iter", "tol"]
    return (
        scores.groupBy(*keys)
        .agg(F.avg(metric).alias(f"mean_{metric}"))
        .orderBy("n_clusters", "init", "max_iter", "tol")
    )


def best_point(curve: DataFrame, metric: str = "inertia") -> DataFrame:
    """The setting with the best mean: lowest inertia or highest silhouette."""
    mean = F.col(f"mean_{metric}")
    order = mean.asc() if metric == "inertia" else mean.desc()
    return curve.orderBy(order, "n_clusters").limit(1)


def assign_clusters(
    df: DataFrame,
    model: KMeansModel,
    features: Sequence[str],
    key: str = "player_id",
) -> DataFrame:
    """(key, cluster_labels, features): the nearest centre of each row."""
    return model.transform(with_vector(df, features)).select(
        key, "cluster_labels", *[quoted(c) for c in features]
    )


def assign_to_centres(
    df: DataFrame,
    centres: Sequence[Sequence[float]],
    features: Sequence[str],
    key: str = "player_id",
) -> DataFrame:
    """(key, cluster_labels, features): as :func:`assign_clusters`, for given centres; the
    first of equally near ones."""
    x = F.array(*[quoted(c).cast("double") for c in features])
    return df.select(
        key, nearest_centre(x, centres).alias("cluster_labels"), *[quoted(c) for c in features]
    )


def nearest_centre(x: Column, centres: Sequence[Sequence[float]]) -> Column:
    """The number of the nearest centre, the first of equally near ones."""
    points = [F.array(*[F.lit(float(v)) for v in c]) for c in centres]
    gaps = F.array(*[squared_distance(x, c) for c in points])
    return (F.array_position(gaps, F.array_min(gaps)) - 1).cast("int")


def _pair_rows(
    labelled: DataFrame,
    model: KMeansModel,
    features: Sequence[str],
    pairs: Sequence[tuple[int, int]],
) -> DataFrame:
    """Points and centroids of some pairs of features, from one labelled frame."""
    points = [
        F.struct(
            F.lit(features[i]).alias("feature_x"),
            F.lit(features[j]).alias("feature_y"),
            F.lit("point").alias("kind"),
            F.col("cluster_labels"),
            quoted(features[i]).cast("double").alias("x"),
            quoted(features[j]).cast("double").alias("y"),
        )
        for i, j in pairs
    ]
    centroids = labelled.sparkSession.createDataFrame(
        [
            (features[i], features[j], "centroid", label, centre[i], centre[j])
            for i, j in pairs
            for label, centre in enumerate(centre_lists(model))
        ],
        "feature_x string, feature_y string, kind string, cluster_labels int, "
        "x double, y double",
    )
    return labelled.select(F.inline(F.array(*points))).union(centroids)


def _fit_on_noise(
    df: DataFrame,
    model: KMeansModel,
    features: Sequence[str],
    noise: float,
    seed: int,
) -> tuple[DataFrame, KMeansModel]:
    """The rows labelled by a new fit, with the model's settings, on noisy features."""
    noisy = {
        f"_noisy{i}": quoted(c) + F.randn(seed + i) * noise
        for i, c in enumerate(features)
    }
    # Seeded noise is the same in every pass over a stored table.
    vectors = with_vector(df.withColumns(noisy), list(noisy))
    again = _estimator(
        model.getK(),
        model.getInitMode(),
        model.getMaxIter(),
        model.getTol(),
        seed,
    ).fit(vectors)
    return again.transform(vectors), again


def centroid_pairs(
    df: DataFrame,
    model: KMeansModel,
    features: Sequence[str],
    noise: float = 0.0,
    seed: int = 42,
) -> DataFrame:
    """(feature_x, feature_y, kind, cluster_labels, x, y): points and centroids for every
    pair of features.

    With ``noise`` the model's settings are fitted again, per pair, on features with
    seeded normal noise of that deviation; the points shown stay the clean ones.
    """
    pairs = list(combinations(range(len(features)), 2))
    if not noise:
        labelled = model.transform(with_vector(df, features))
        return _pair_rows(labelled, model, features, pairs)
    parts = []
    for n, pair in enumerate(pairs):
        labelled, again = _fit_on_noise(
            df, model, features, noise, seed + n * len(features)
        )
        parts.append(_pair_rows(labelled, again, features, [pair]))
    return union_by_position(parts)
