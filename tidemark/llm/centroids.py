"""Centroid clustering in exact integers, with distances kept up to date by differences."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, store
from tidemark.llm.topk import quantized
from tidemark.sources.layout import shared_folder

_STATE = "vec_id long, v array<int>, square long, dots array<long>, cluster int, distance long"


@dataclass(frozen=True)
class Clustering:
    """``assigned``: ``vec_id, cluster, distance`` of every vector. ``centroids``: ``cluster,
    centroid, size, inertia, total_inertia``, one row per centroid."""

    assigned: DataFrame
    centroids: DataFrame


def _rows(lists: pa.Array, width: int) -> np.ndarray:
    """A list array whose lists all have one length, as a matrix."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _list_array(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel(), kind))


def _moved(state: DataFrame, old: np.ndarray, new: np.ndarray) -> DataFrame:
    """The state after the centroids moved from ``old`` to ``new``.

    A vector's dot product with a centroid changes by its products with the components in
    which the centroid changed; centroids that stay cost nothing.
    """
    changes = []
    for j, delta in enumerate(new - old):
        places = np.flatnonzero(delta)
        if len(places):
            changes.append((j, places, delta[places]))
    squares, count, dims = (new * new).sum(1), len(new), new.shape[1]
    fresh = "dots" not in state.columns

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _rows(batch.column("v"), dims)
            square = batch.column("square").to_numpy()
            if fresh:
                dots = np.zeros((len(v), count), np.int64)
            else:
                dots = _rows(batch.column("dots"), count)
            for j, places, delta in changes:
                dots[:, j] += v[:, places] @ delta
            gaps = square[:, None] - 2 * dots + squares
            # The first of equal gaps, so the smaller number.
            cluster = gaps.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("v"),
                    batch.column("square"),
                    _list_array(dots, pa.int64()),
                    pa.array(cluster.astype(np.int32)),
                    pa.array(gaps[np.arange(len(gaps)), cluster]),
                ],
                names=["vec_id", "v", "square", "dots", "cluster", "distance"],
            )

    return state.mapInArrow(update, _STATE)


def _means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Floors of the component means per cluster; a cluster without vectors keeps its centroid."""
    sums = [F.sum(F.get("v", F.lit(i)).cast("long")) for i in range(centroids.shape[1])]
    out = centroids.copy()
    for cluster, n, *totals in state.groupBy("cluster").agg(F.count("*"), *sums).collect():
        out[cluster] = [total // n for total in totals]
    return out


def largest_component(dims: int) -> int:
    """Components up to this have squared distances that fit in a long with room to spare."""
    return isqrt(2**62 // dims) // 2


def cluster_vectors(
    vectors: DataFrame,
    clusters: int = 40,
    rounds: int = 5,
    dims: int = 64,
    scale: int = 256,
    start: Column | None = None,
) -> Clustering:
    """Lloyd's rounds over ``vec_id, embedding`` in integers, so that every number is exact.

    Components are ``floor(scale * x)``. The first centroids are the vectors with the least
    ``start``, by default the SHA-256 of ``2:<vec_id>`` in hexadecimal; equal ones go by their
    components. Each round assigns every vector to its nearest centroid by squared distance,
    ties to the smaller number, and moves each centroid to the floors of its vectors' means; an
    empty one stays. A last assignment follows.

    Vectors that are NULL, have another number of components, or hold a NULL, NaN or infinite
    one take no part, and neither do those with a component too large for exact longs (beyond
    ``largest_component(dims)``, 2 ** 27 at 64 dimensions). Rows with a NULL ``vec_id`` are
    assigned but are no first centroids. Repeated rows are rows each, and may give equal
    centroids, of which the smaller number takes all. With fewer vectors than ``clusters``
    there are as many centroids as vectors; without any, or with no ``vec_id``, no rows. Other
    columns are not read.

    Every vector is stored with its dot products with all centroids. Moving a centroid changes
    them by the products with those components that changed, and the nearest one is found
    again: squared distances are ``v * v - 2 * (v * c) + c * c``. Each round is one pass that
    writes the state and one that adds up components per cluster, map-side; the driver sees
    centroids only. Rounds are stored, so a lost executor costs tasks, and the state before the
    last is deleted once its successor is written.
    """
    spark = vectors.sparkSession
    text = F.concat(F.lit("2:"), F.col("vec_id").cast("string"))
    first = F.sha2(text, 256) if start is None else start
    v = quantized(F.col("embedding"), scale)
    most = largest_component(dims)
    rows = vectors.where(F.size("embedding") == dims).select(
        F.col("vec_id").cast("long").alias("vec_id"), first.alias("first"), v.alias("v")
    )
    rows = rows.where(F.col("v").isNotNull() & F.forall("v", lambda x: x.between(-most, most)))
    rows = rows.withColumn("v", F.col("v").cast("array<int>"))

    chosen = rows.where(F.col("first").isNotNull()).orderBy("first", "v").limit(clusters)
    new = np.array([r["v"] for r in chosen.select("v").collect()], np.int64).reshape(-1, dims)
    if not len(new):
        nothing = rows.limit(0).select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return Clustering(nothing, _centroid_frame(spark, new, {}))

    square = F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x.cast("long") * x)
    state = rows.select("vec_id", "v", square.alias("square"))
    old, before = np.zeros_like(new), None
    for left in range(rounds, -1, -1):
        folder = shared_folder(spark)
        state = store(_moved(state, old, new), folder)
        if before:
            discard(spark, before)
        before = folder
        if left:
            old, new = new, _means(state, new)
    totals = state.groupBy("cluster").agg(F.count("*"), F.sum("distance")).collect()
    facts = {cluster: (n, inertia) for cluster, n, inertia in totals}
    return Clustering(
        state.select("vec_id", "cluster", "distance"), _centroid_frame(spark, new, facts)
    )


def _centroid_frame(spark, centroids: np.ndarray, facts: dict[int, tuple[int, int]]) -> DataFrame:
    total = sum(inertia for _, inertia in facts.values())
    rows = [
        (j, [int(x) for x in c], *facts.get(j, (0, 0)), total) for j, c in enumerate(centroids)
    ]
    ddl = "cluster int, centroid array<long>, size long, inertia long, total_inertia long"
    return spark.createDataFrame(rows, ddl)
