"""Cluster quality of labelled points: inertia, Calinski-Harabasz, Davies-Bouldin and
silhouette. Points are (label, x) rows with x an array of doubles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import quoted
from tidemark.functions.numbers import squared_distance
from tidemark.operators.lookup import lookup_join
from tidemark.operators.neighbours import stored, worst_ratios
from tidemark.operators.pairs import packed, pair_sums

# Centres that may be shared with every task; at 4,096 dimensions they take 32 MB.
CENTRE_ROWS = 1_000

# Points of a cluster that one task may join.
LARGE_ROWS = 1_000_000

# Rows of one block of a measure over all pairs; a task measures two blocks at a time.
BLOCK_ROWS = 2_048

# Slices of a measure over all pairs, and values that a task may hold of one: 32 MB of doubles.
SLICES, SLICE_VALUES = 16, 4_000_000


def as_points(
    df: DataFrame,
    features: str | Sequence[str],
    label: str = "cluster_labels",
    key: str | None = None,
) -> DataFrame:
    """([key,] label, x) from an array column or from a list of columns. A row without a
    label is left out."""
    if isinstance(features, str):
        x = quoted(features).cast("array<double>")
    else:
        x = F.array(*[quoted(c).cast("double") for c in features])
    keys = [quoted(key).alias("key")] if key else []
    points = df.select(*keys, quoted(label).alias("label"), x.alias("x"))
    return points.dropna(subset=["label"])


def centres(points: DataFrame) -> DataFrame:
    """(label, n, centre): size and mean of each cluster."""
    return points.groupBy("label").agg(
        F.count("*").alias("n"),
        vector_to_array(Summarizer.mean(array_to_vector(F.col("x")))).alias("centre"),
    )


def cluster_count(points: DataFrame) -> int:
    """Number of clusters, by one aggregation. It decides how centres reach the points."""
    return points.select("label").distinct().count()


def with_own_centre(points: DataFrame, n_clusters: int) -> DataFrame:
    """Add the centre of each point's own cluster.

    Up to a bounded number of clusters the centres are one map, used as a scalar subquery,
    and no point is moved. Beyond it they are joined, with salted labels if any cluster is large.
    """
    table = centres(points).select("label", "centre")
    if n_clusters > CENTRE_ROWS:
        large = points.groupBy("label").count().where(F.col("count") > LARGE_ROWS)
        if large.isEmpty():
            return points.join(table, "label")
        spread_by = "key" if "key" in points.columns else "x"
        return lookup_join(points, table, "label", spread_by)
    whole = table.agg(F.map_from_entries(F.collect_list(F.struct("label", "centre"))))
    return points.withColumn("centre", F.try_element_at(whole.scalar(), F.col("label")))


def cluster_spread(points: DataFrame, n_clusters: int) -> DataFrame:
    """(label, n, centre, sse, mean_distance) per cluster: squared and plain distances of
    its points to its centre. Points are summed as numbers; centres come back per cluster."""
    d2 = squared_distance(F.col("x"), F.col("centre"))
    spread = (
        with_own_centre(points, n_clusters)
        .select("label", d2.alias("d2"))
        .groupBy("label")
        .agg(
            F.count("*").alias("n"),
            F.sum("d2").alias("sse"),
            F.avg(F.sqrt("d2")).alias("mean_distance"),
        )
    )
    return spread.join(centres(points).select("label", "centre"), "label").select(
        "label", "n", "centre", "sse", "mean_distance"
    )


def block_pairs(df: DataFrame, key: str, blocks: int) -> DataFrame:
    """Rows cut into blocks by a hash of ``key`` and copied once per pair of blocks they
    take part in: adds ``block``, ``lo`` and ``hi``. A pair holds two blocks, or one with
    itself."""
    block = F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    return (
        df.withColumn("block", block)
        .withColumn("_other", other)
        .withColumns(
            {"lo": F.least("block", "_other"), "hi": F.greatest("block", "_other")}
        )
        .drop("_other")
    )


def _calinski_harabasz(spread: DataFrame) -> DataFrame:
    """One row (total_inertia, calinski_harabasz_score)."""
    weight = F.col("n").cast("double")
    grand = spread.agg(
        vector_to_array(
            Summarizer.mean(array_to_vector(F.col("centre")), weightCol=weight)
        )
    ).scalar()
    off_grand = squared_distance(F.col("centre"), F.col("grand"))
    totals = spread.withColumn("grand", grand).agg(
        F.sum("sse").alias("within"),
        F.sum(weight * off_grand).alias("between"),
        F.sum(weight).alias("n"),
        F.count("*").alias("k"),
    )
    k, n, within = F.col("k"), F.col("n"), F.col("within")
    score = F.when(within == 0, F.lit(1.0)).otherwise(
        F.try_divide(F.col("between") / (k - 1), within / (n - k))
    )
    return totals.select(
        within.alias("total_inertia"),
        _for_clusters(score, k, n).alias("calinski_harabasz_score"),
    )


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))


def _for_clusters(score: Column, k: Column, n: Column) -> Column:
    """The score of 2 .. n-1 clusters; any other number raises."""
    wrong = F.raise_error(F.lit("needs 2 .. n-1 clusters for n points"))
    return F.when((k >= 2) & (k < n), score).otherwise(wrong)


def _davies_bouldin(spread: DataFrame, n_clusters: int) -> DataFrame:
    """One row (davies_bouldin_score): mean over the clusters of their largest
    (spread + spread) / distance to another cluster; 0 for an equal centre.

    Up to a bounded number of clusters each is held against one array of all, by direct
    differences of the centres. Beyond it the largest ratio is searched for in blocks of near
    centres, by the same differences.
    """
    if n_clusters > CENTRE_ROWS:
        worst = worst_ratios(spread, n_clusters).agg(F.avg("worst").alias("mean")).scalar()
        totals = spread.agg(F.count("*").alias("k"), F.sum("n").alias("n")).withColumn("mean", worst)
        score = _for_clusters(F.col("mean"), F.col("k"), F.col("n"))
        return totals.select(score.alias("davies_bouldin_score"))
    others = spread.agg(F.collect_list(F.struct("centre", "mean_distance"))).scalar()

    def ratio(other: Column) -> Column:
        gap = F.sqrt(squared_distance(F.col("centre"), other["centre"]))
        both = F.col("mean_distance") + other["mean_distance"]
        return F.when(gap == 0, F.lit(0.0)).otherwise(both / gap)

    worst = spread.withColumn("others", others).select(
        "n", F.array_max(F.transform("others", ratio)).alias("worst")
    )
    score = _for_clusters(F.avg("worst"), F.count("*"), F.sum("n"))
    return worst.agg(score.alias("davies_bouldin_score"))


def separation(points: DataFrame, n_clusters: int | None = None) -> DataFrame:
    """One row (total_inertia, calinski_harabasz_score, davies_bouldin_score).

    Two passes over the points, for centres and for spreads; after that there is one row per
    cluster. The two scores need at least two clusters and fewer clusters than points, each
    by itself. Without a known number of clusters they are counted first; the number decides
    how the work is cut, not what comes out.
    """
    if n_clusters is None:
        n_clusters = cluster_count(points)
    spread = cluster_spread(points, n_clusters)
    if n_clusters > CENTRE_ROWS:
        spread = stored(spread)
    davies_bouldin = _davies_bouldin(spread, n_clusters).scalar()
    return _calinski_harabasz(spread).withColumn("davies_bouldin_score", davies_bouldin)


def silhouette(points: DataFrame) -> float:
    """Mean silhouette with squared Euclidean distance, in linear time by Spark ML."""
    vectors = points.select(
        F.col("label").cast("double").alias("label"),
        array_to_vector(F.col("x")).alias("x"),
    )
    return ClusteringEvaluator(predictionCol="label", featuresCol="x").evaluate(vectors)


def slice_count(n: int, block_rows: int, dims: int, n_clusters: int) -> int:
    """Slices of n points: enough to share the work, more only where a slice would hold too many
    values, or sums of too many clusters."""
    most = max(min(SLICE_VALUES // dims, SLICE_VALUES // max(n_clusters, 1)), block_rows)
    return max(1, min(SLICES, -(-n // block_rows)), -(-n // most))


def distance_sums(points: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(key, label, other, total, n): per point and cluster, the sum of the Euclidean
    distances to the cluster's points (itself left out), and their number.

    Points are cut by a hash of their key into slices; a task measures one pair of slices, tiles of
    ``block_rows`` at most of each at a time, and gives lists of sums. There are a fixed number of
    slices until they would be too large for a task, so each point is copied as often for any
    number of points up to there. The work is quadratic in the number of points, as the measure is;
    ``silhouette`` and ``silhouette_to_centres`` are the linear ones. A repeated ``key`` raises.
    """
    n, dims = points.agg(F.count("*"), F.max(F.size("x"))).first()
    if points.select("key").distinct().count() != n:
        raise ValueError("keys of points must be unique")
    slices = slice_count(n, block_rows, dims or 1, cluster_count(points))
    types = dict(points.dtypes)
    kinds = f"key {types['key']}, label {types['label']}"
    # One pair a task.
    pair = (F.col("hi") * (F.col("hi") + 1) / 2 + F.col("lo")).cast("int").alias("pair")
    sent = points.select("key", "label", "x").mapInArrow(packed, f"{kinds}, wide boolean, x binary")
    copies = block_pairs(sent, "key", slices).select(pair, "block", "key", "label", "wide", "x")
    dealt = copies.repartitionById(slices * (slices + 1) // 2, "pair")

    def measure(batches):
        return pair_sums(batches, block_rows)

    sums = dealt.mapInArrow(
        measure,
        f"{kinds}, others array<{types['label']}>, totals array<double>, ns array<bigint>",
    )
    # Lists are moved, not their entries: a key's sums come together before they are taken apart.
    together = sums.repartition("key").select(
        "key", "label", F.explode(F.arrays_zip("others", "totals", "ns")).alias("s")
    )
    return together.groupBy("key", "label", F.col("s.others").alias("other")).agg(
        F.sum("s.totals").alias("total"), F.sum("s.ns").alias("n")
    )


def silhouette_values(points: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(key, label, silhouette): exact silhouette of each point with plain Euclidean
    distance; 0 for a point alone in its cluster."""
    mean = F.try_divide("total", "n")
    own = F.col("other") == F.col("label")
    return (
        distance_sums(points, block_rows)
        .groupBy("key", "label")
        .agg(
            F.max(F.when(own & (F.col("n") > 0), mean)).alias("a"),
            F.min(F.when(~own, mean)).alias("b"),
        )
        .select(
            "key",
            "label",
            F.coalesce(
                F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)
            ).alias("silhouette"),
        )
    )


def silhouette_to_centres(points: DataFrame) -> DataFrame:
    """One row (silhouette_to_centres): mean silhouette with the plain distance to centres in
    place of the mean distance to all points of a cluster, in linear time.

    A point's own side is its distance to its own centre, the other side that to the nearest
    other centre. Points are held against arrays of at most a bounded number of centres, and
    are sent again only when there are more clusters than that.
    """
    table = centres(points).select("label", "centre")
    arrays = max(1, -(-cluster_count(points) // CENTRE_ROWS))
    def side(entries: str, own: bool) -> Column:
        kept = F.filter(entries, lambda c: (c["label"] == F.col("label")) == F.lit(own))
        gaps = F.transform(
            kept, lambda c: F.sqrt(squared_distance(F.col("x"), c["centre"]))
        )
        return F.array_min(gaps)

    if arrays == 1:
        whole = table.agg(F.collect_list(F.struct("label", "centre"))).scalar()
        sides = points.withColumn("everyone", whole).select(
            side("everyone", True).alias("a"), side("everyone", False).alias("b")
        )
    else:
        part = F.pmod(F.xxhash64("label"), F.lit(arrays)).alias("part")
        parts = table.groupBy(part).agg(
            F.collect_list(F.struct("label", "centre")).alias("everyone")
        )
        held = points.withColumn("id", F.monotonically_increasing_id()).withColumn(
            "part", F.explode(_numbers(arrays))
        )
        sides = (
            lookup_join(held, parts, "part", "id")
            .select("id", side("everyone", True).alias("a"), side("everyone", False).alias("b"))
            .groupBy("id")
            .agg(F.min("a").alias("a"), F.min("b").alias("b"))
        )
    width = F.coalesce(
        F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)
    )
    return sides.agg(F.avg(width).alias("silhouette_to_centres"))


def cluster_metrics(points: DataFrame, n_clusters: int | None = None) -> DataFrame:
    """One row with the four quality scores; the silhouette is that of squared distances."""
    return separation(points, n_clusters).select(
        F.lit(silhouette(points)).alias("silhouette_score"),
        "davies_bouldin_score",
        "calinski_harabasz_score",
        "total_inertia",
    )
