"""Exact search for the largest inner products, by distances to pivots."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import lookup, store

# Vectors the pivots are chosen from, pivots, and rows of a block of vectors or queries.
SAMPLE, PIVOTS, BLOCK, QUERIES = 4096, 32, 1024, 256
# Steps of distance that are counted to find the bounds of annuli.
STEPS = 4096
# Distances are rounded outwards by this share, far more than doubles are off.
SLACK = 1e-6


def quantized(embedding: Column, scale: int = 64) -> Column:
    """``floor(scale * x)`` of every component; NULL if any is NULL, NaN or infinite."""
    numbers = F.transform(embedding, lambda x: x.cast("double"))
    bad = F.exists(
        numbers,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))),
    )
    good = embedding.isNotNull() & ~bad
    return F.when(good, F.transform(numbers, lambda x: F.floor(x * scale).cast("long")))


def _matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list array, padded with zeros to ``dims``."""
    out = np.zeros((len(vectors), dims), np.int64)
    sizes = np.diff(vectors.offsets.to_numpy())
    rows = np.repeat(np.arange(len(vectors)), sizes)
    starts = np.repeat(vectors.offsets.to_numpy()[:-1], sizes)
    places = np.arange(vectors.offsets[0].as_py(), vectors.offsets[-1].as_py()) - starts
    out[rows, places] = vectors.flatten().to_numpy()
    return out


def _farthest(sample: np.ndarray, count: int) -> np.ndarray:
    """Pivots: each one the sample vector farthest from the pivots before it."""
    chosen = [0]
    near = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(count, len(sample)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


class _Geometry:
    """Vectors with one more coordinate, by which the largest product is the nearest point.

    With ``c * c = longest - v * v`` appended to a vector ``v``, ``longest`` being the largest
    squared length, and 0 appended to a query ``q``, their squared distance is
    ``q * q + longest - 2 * (q * v)``.
    """

    def __init__(self, dims: int, longest: float, kind: str):
        self.dims, self.longest, self.kind, self.pivots = dims, longest, kind, None

    def points(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        x = vectors.astype(np.float64)
        rest = np.maximum(self.longest - (x * x).sum(1), 0) * (not query)
        return np.hstack([x, np.sqrt(rest)[:, None]])

    def to_pivots(self, points: np.ndarray) -> np.ndarray:
        p = self.pivots
        squares = (points**2).sum(1)[:, None] + (p**2).sum(1) - 2 * points @ p.T
        return np.sqrt(np.maximum(squares, 0))

    def pack(self, vectors: pa.Array) -> bytes:
        return _matrix(vectors, self.dims).astype(self.kind).tobytes()

    def unpack(self, packed: bytes) -> np.ndarray:
        return np.frombuffer(packed, self.kind).reshape(-1, self.dims)

    def products(self, queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """As long integers; by way of doubles where those are exact."""
        exact = np.float64 if self.longest < 2.0**53 else np.int64
        return (queries.astype(exact) @ vectors.astype(exact).T).astype(np.int64)


def _placed(rows: DataFrame, geometry: _Geometry, query: bool) -> DataFrame:
    """Adds the nearest pivot, the distance to it, and the step of that distance."""
    widest = 2 * geometry.longest**0.5 + 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = geometry.points(_matrix(batch.column(1), geometry.dims), query)
            distance = geometry.to_pivots(points)
            pivot = distance.argmin(1)
            nearest = distance[np.arange(len(pivot)), pivot]
            step = (nearest / widest * STEPS).astype(np.int64)
            columns = [pa.array(pivot), pa.array(nearest), pa.array(step)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *columns], names=["vec_id", "v", "pivot", "d", "step"]
            )

    return rows.mapInArrow(place, "vec_id long, v array<long>, pivot long, d double, step long")


def _cut(placed: DataFrame, rows: int) -> DataFrame:
    """Adds ``block``: about so many rows of one pivot, next to each other by distance.

    Steps of distance are counted first, and neighbours put together until they fill a block;
    what is more than a block, as of equal vectors, is split by a hash.
    """
    steps = placed.groupBy("pivot", "step").agg(F.count("*").alias("m"))
    before = F.sum("m").over(Window.partitionBy("pivot").orderBy("step")) - F.col("m")
    steps = steps.withColumn("ring", F.floor(before / rows))
    rings = Window.partitionBy("pivot", "ring")
    parts = F.ceil(F.sum("m").over(rings) / rows).cast("long")
    steps = steps.select("pivot", "step", "ring", parts.alias("parts"))
    part = F.pmod(F.xxhash64("vec_id", "v"), F.col("parts"))
    block = F.xxhash64("pivot", "ring", part).alias("block")
    return lookup(placed, steps, ["pivot", "step"], "inner").select("vec_id", "v", "pivot", "d", block)


def _packed(cut: DataFrame, geometry: _Geometry, query: bool) -> DataFrame:
    """One row per block: packed vectors, and their least and greatest distance to each pivot
    (queries) or to their own (vectors, whose other distances are NULL)."""

    def pack(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by("vec_id")
        vectors = group["v"].combine_chunks()
        if query:
            distance = geometry.to_pivots(geometry.points(_matrix(vectors, geometry.dims), True))
            near, far = distance.min(0), distance.max(0)
        else:
            near, far = (np.array([f(group["d"].to_numpy())]) for f in (np.min, np.max))
        return pa.table(
            {
                "block": group["block"][:1],
                "pivot": group["pivot"][:1],
                "near": pa.array([near.tolist()]),
                "far": pa.array([far.tolist()]),
                "n": pa.array([len(group)]),
                "ids": pa.array([group["vec_id"].to_numpy().tobytes()]),
                "packed": pa.array([geometry.pack(vectors)]),
            }
        )

    schema = (
        "block long, pivot long, near array<double>, far array<double>, n long, "
        "ids binary, packed binary"
    )
    return cut.groupBy("block").applyInArrow(pack, schema)


def _searched(pairs: DataFrame, geometry: _Geometry, k: int) -> DataFrame:
    """``chunk, query_id, square, vec_id, score``: the best of each pair of blocks.

    ``pairs`` has the packed queries and vectors, and scores a query has to reach.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, asked, x, ids, y, floors in zip(*(c.to_pylist() for c in batch.columns)):
                asked, ids = np.frombuffer(asked, np.int64), np.frombuffer(ids, np.int64)
                queries = geometry.unpack(x)
                scores = geometry.products(queries, geometry.unpack(y))
                lowest = np.full(len(asked), np.iinfo(np.int64).min + 1)
                if floors:
                    at = np.searchsorted(asked, [f["query_id"] for f in floors])
                    lowest[at] = [f["least"] for f in floors]
                scores[asked[:, None] == ids] = np.iinfo(np.int64).min
                if len(ids) > k:
                    kth = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k]
                    lowest = np.maximum(lowest, kth)
                q, v = np.nonzero(scores >= lowest[:, None])
                q, v = q[scores[q, v] > np.iinfo(np.int64).min], v[scores[q, v] > np.iinfo(np.int64).min]
                # In the order of query, score and id; the first k of each query stay.
                order = np.lexsort((ids[v], -scores[q, v], q))
                q, v = q[order], v[order]
                nth = np.arange(len(q)) - np.searchsorted(q, q)
                q, v = q[nth < k], v[nth < k]
                square = (queries.astype(np.float64) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(q), chunk, np.int64)),
                        pa.array(asked[q]),
                        pa.array(square[q]),
                        pa.array(ids[v]),
                        pa.array(scores[q, v]),
                    ],
                    names=["chunk", "query_id", "square", "vec_id", "score"],
                )

    schema = "chunk long, query_id long, square double, vec_id long, score long"
    return pairs.mapInArrow(search, schema)


def top_products(vectors: DataFrame, queries: Column, k: int = 20, scale: int = 64) -> DataFrame:
    """The ``k`` vectors with the largest integer inner products for every query, exactly.

    ``vectors`` has ``vec_id`` and ``embedding``; ``queries`` is a condition on ``vec_id``.
    Components are ``floor(scale * x)``. Returns ``query_id, rank, vec_id, score``; ties go to
    the smaller ``vec_id``, and a query with fewer than ``k`` candidates gets all of them.

    Vectors that are NULL or hold a NULL, NaN or infinite component take no part, and neither
    do rows with a NULL ``vec_id``. A shorter vector counts as padded with zeros, an empty one
    as zeros. Rows with a query's ``vec_id`` are its own and not its candidates; repeated rows
    of other ids are candidates each, and of repeated queries one is asked. Squared lengths
    must fit in a long, else it raises. Empty tables give no rows. Other columns are not read.

    The index is fitted on at most 4,096 vectors and holds all: pivots lie far apart, each
    vector belongs to its nearest pivot, and the vectors of a pivot are sorted by distance and
    cut into annuli of bounded size with known least and greatest distance. By the triangle
    inequality no vector of an annulus is nearer to a query than the query's distance to the
    pivot misses the annulus. A first pass searches the annuli nearest to each block of
    queries, which bounds the distance of the k-th best; a second one searches all annuli that
    the bound does not exclude. Blocks meet blocks, so a task holds two of them at a time.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        quantized(F.col("embedding"), scale).alias("v"),
    )
    rows = store(rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    facts = rows.agg(
        F.max(F.size("v")).alias("dims"),
        F.max(square).alias("longest"),
        F.max(F.array_max(F.transform("v", F.abs))).alias("largest"),
    ).first()
    if facts["dims"] is None:
        nothing = F.lit(None).cast("int").alias("rank")
        ids = [F.col("vec_id").alias("query_id"), nothing, F.col("vec_id")]
        return rows.select(*ids, F.col("vec_id").alias("score"))
    if facts["longest"] >= 2.0**62:
        raise ValueError("inner products do not fit in a long")
    kinds = {2**15: "<i2", 2**31: "<i4"}
    kind = next((t for top, t in kinds.items() if (facts["largest"] or 0) < top), "<i8")
    geometry = _Geometry(max(facts["dims"], 1), facts["longest"], kind)
    sample = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(SAMPLE).toArrow()
    sample = _matrix(sample["v"].combine_chunks(), geometry.dims)
    geometry.pivots = _farthest(geometry.points(sample, False), PIVOTS)

    annuli = store(_packed(_cut(store(_placed(rows, geometry, False)), BLOCK), geometry, False))
    asked = rows.where(queries).dropDuplicates(["vec_id"])
    chunks = store(_packed(_cut(store(_placed(asked, geometry, True)), QUERIES), geometry, True))

    reached = chunks.select(
        F.col("block").alias("chunk"),
        F.posexplode(F.arrays_zip("near", "far")).alias("pivot", "of"),
    )
    met = reached.withColumn("pivot", F.col("pivot").cast("long")).join(
        annuli.select("block", "pivot", "n", "near", "far"), "pivot"
    )
    gap = F.greatest(
        F.col("of.near") - F.get("far", F.lit(0)), F.get("near", F.lit(0)) - F.col("of.far")
    )
    met = store(met.select("chunk", "block", "n", gap.alias("gap")))

    asking = chunks.select(
        F.col("block").alias("chunk"), F.col("ids").alias("asked"), F.col("packed").alias("x")
    )
    asked_of = annuli.select("block", "ids", F.col("packed").alias("y"))

    def search(pairs: DataFrame) -> DataFrame:
        joined = pairs.join(asking, "chunk").join(asked_of, "block")
        return _searched(joined.select("chunk", "asked", "x", "ids", "y", "floors"), geometry, k)

    # First pass: the nearest annuli by gap, as many as hold a few times k vectors.
    order = Window.partitionBy("chunk").orderBy("gap", "block")
    ahead = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    floors = F.lit(None).cast("array<struct<query_id:long,least:long>>").alias("floors")
    first = met.withColumn("ahead", ahead).where(F.col("ahead") < 8 * k)
    found = search(first.select("chunk", "block", floors))
    found = found.groupBy("chunk", "query_id", "square").agg(
        F.sort_array(F.collect_list("score"), asc=False).alias("scores")
    )
    found = store(found.withColumn("least", F.get("scores", F.lit(k - 1))).drop("scores"))

    # The distance within which a vector of at least that product lies, a little more.
    inside = F.col("square") + F.lit(geometry.longest) - 2 * F.col("least").cast("double")
    reach = F.sqrt(F.greatest(inside, F.lit(0.0))) + SLACK * (1 + 2 * geometry.longest**0.5)
    limits = found.groupBy("chunk").agg(
        F.collect_list(F.when(F.col("least").isNotNull(), F.struct("query_id", "least"))).alias(
            "floors"
        ),
        F.max(reach).alias("reach"),
        F.count("*").alias("known"),
        F.count("least").alias("full"),
    )
    sizes = chunks.select(F.col("block").alias("chunk"), F.col("n").alias("asking"))
    limits = limits.join(sizes, "chunk").withColumn(
        "reach", F.when((F.col("full") == F.col("asking")), F.col("reach"))
    )
    second = met.join(limits.select("chunk", "floors", "reach"), "chunk", "left")
    second = second.where(F.col("reach").isNull() | (F.col("gap") <= F.col("reach")))
    best = search(second.select("chunk", "block", "floors"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
