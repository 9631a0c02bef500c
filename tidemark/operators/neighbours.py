"""The worst ratio of each cluster to any other, by search: clusters lie in blocks of near
centres, and only blocks that may hold a worse one than is known are looked at."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.lookup import lookup_join
from tidemark.sources.layout import shared_folder
from tidemark.sources.readers import read_parquet
from tidemark.sources.writers import write_parquet

# Clusters of a block, about, and blocks into which space is cut at most.
BLOCK_CLUSTERS, MOST_CUTS = 512, 4_096
# A block of many equal centres is cut by a hash beyond this; clusters that ask one block come
# in groups of about this many.
GROUP_CLUSTERS = 8_192
# Centres that choose the cuts, and their values at most.
SAMPLE_ROWS, SAMPLE_VALUES = 65_536, 4_000_000
# A bound is raised by this share against rounding.
SLACK = 1e-9
# Ratios that a task holds at once.
RATIOS = 1_000_000


def stored(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read back."""
    path = shared_folder(df.sparkSession)
    write_parquet(df, path)
    return read_parquet(df.sparkSession, path)


class Cuts:
    """Space cut at medians of a sample, the widest dimension of each part first."""

    def __init__(self, sample: np.ndarray, parts: int):
        self.dim: list[int] = []
        self.at: list[float] = []
        self.next: list[list[int]] = []
        self.parts = 0
        self.depth = 0
        self.root = self._cut(sample, parts, 0)

    def _cut(self, x: np.ndarray, parts: int, depth: int) -> int:
        """The number of an inner node, or -1 less that of a part."""
        self.depth = max(self.depth, depth)
        if parts > 1 and len(x) > 1:
            low, high = x.min(0), x.max(0)
            dim = int(np.argmax(high - low))
            at = float(np.median(x[:, dim]))
            at = at if at < high[dim] else float(np.nextafter(high[dim], low[dim]))
            above = x[:, dim] > at
            if above.any() and not above.all():
                node = len(self.dim)
                self.dim.append(dim)
                self.at.append(at)
                self.next.append([0, 0])
                for side, few in ((0, parts - parts // 2), (1, parts // 2)):
                    self.next[node][side] = self._cut(x[above == bool(side)], few, depth + 1)
                return node
        self.parts += 1
        return -self.parts

    def parts_of(self, x: np.ndarray) -> np.ndarray:
        node = np.full(len(x), self.root)
        dim, at, after = (np.array(v) for v in (self.dim, self.at, self.next))
        for _ in range(self.depth):
            some = np.flatnonzero(node >= 0)
            here = node[some]
            node[some] = after[here, (x[some, dim[here]] > at[here]).astype(int)]
        return -1 - node


def _blocks(spread: DataFrame, n_clusters: int) -> DataFrame:
    """(label, x, s, block): centre and mean distance of each cluster."""
    rows = spread.select("label", F.col("centre").alias("x"), F.col("mean_distance").alias("s"))
    dims = rows.select(F.size("x")).first()[0]
    few = min(n_clusters, SAMPLE_ROWS, SAMPLE_VALUES // dims + 1)
    sample = rows.orderBy(F.xxhash64("label"), "label").limit(few).select("x")
    cuts = Cuts(
        np.array([r["x"] for r in sample.collect()], float),
        min(MOST_CUTS, -(-n_clusters // BLOCK_CLUSTERS)),
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            part = pa.array(cuts.parts_of(x).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, part], names=[*batch.schema.names, "part"])

    kind = dict(rows.dtypes)["label"]
    placed = stored(rows.mapInArrow(place, f"label {kind}, x array<double>, s double, part int"))
    first, table = 0, []
    for r in placed.groupBy("part").count().orderBy("part").collect():
        pieces = -(-r["count"] // GROUP_CLUSTERS)
        table.append((r["part"], first, pieces))
        first += pieces
    pieces = rows.sparkSession.createDataFrame(table, "part int, first int, pieces int")
    block = F.col("first") + F.pmod(F.xxhash64("label"), F.col("pieces"))
    found = lookup_join(placed, pieces, "part", "label", len(table))
    return found.select("label", "x", "s", block.cast("int").alias("block"))


def _gaps(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances by direct differences, one dimension at a time."""
    squares = np.zeros((len(x), len(y)))
    for i in range(x.shape[1]):
        squares += (x[:, i, None] - y[None, :, i]) ** 2
    return np.sqrt(squares)


def _worst(x: np.ndarray, s: np.ndarray, y: np.ndarray, t: np.ndarray) -> np.ndarray:
    """The largest (s + t) / distance of each x to any y; 0 for an equal centre."""
    out = np.zeros(len(x))
    step = max(1, RATIOS // len(y))
    for part in (slice(i, i + step) for i in range(0, len(x), step)):
        gaps = _gaps(x[part], y)
        ratios = np.divide(s[part, None] + t, gaps, out=np.zeros(gaps.shape), where=gaps != 0)
        out[part] = ratios.max(1)
    return out


def _apart(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """Least distances between boxes, each with each."""
    squares = np.zeros((len(low), len(lows)))
    for i in range(low.shape[1]):
        gap = np.maximum(lows[None, :, i] - high[:, i, None], low[:, i, None] - highs[None, :, i])
        squares += np.maximum(gap, 0.0) ** 2
    return np.sqrt(squares)


def _may_be_worse(most: np.ndarray, apart: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Where ``most / apart`` is not surely at most ``known``; also where it is no number."""
    return ~(most * (1 + SLACK) <= known * apart)


def worst_ratios(spread: DataFrame, n_clusters: int) -> DataFrame:
    """(label, worst): the largest (spread + spread) / distance of each cluster to any other, 0
    for an equal centre. The result is that of all pairs.

    The clusters are cut into blocks of near centres. Each cluster first finds its worst ratio
    within its own block. The least distance to the box of another block and the largest spread
    there bound what it can find there, and it asks only those blocks that may hold a worse one.
    Where centres lie apart in few dimensions these are few; at worst, work is quadratic, in
    groups of bounded size.
    """
    spark = spread.sparkSession
    rows = _blocks(spread, n_clusters)
    kind = dict(rows.dtypes)["label"]

    def matrix(pdf: pd.DataFrame, name: str = "x") -> np.ndarray:
        return np.stack(pdf[name].to_numpy()).astype(float)

    def box(pdf: pd.DataFrame) -> pd.DataFrame:
        x = matrix(pdf)
        sides = {"block": [pdf["block"].iloc[0]], "low": [x.min(0)], "high": [x.max(0)]}
        return pd.DataFrame(sides | {"s": [pdf["s"].max()]})

    boxes = rows.groupBy("block").applyInPandas(
        box, "block int, low array<double>, high array<double>, s double"
    )
    # One row per block.
    found = boxes.orderBy("block").collect()
    ids = np.array([r["block"] for r in found], np.int32)
    lows, highs = (np.array([r[c] for r in found], float) for c in ("low", "high"))
    most = np.array([r["s"] for r in found], float)

    def ask(pdf: pd.DataFrame) -> pd.DataFrame:
        """Own worst ratios under block -1, and the clusters under each block that they ask."""
        x, s, here = matrix(pdf), pdf["s"].to_numpy(), pdf["block"].iloc[0]
        own = _worst(x, s, x, s)
        apart = _apart(x.min(0)[None], x.max(0)[None], lows, highs)[0]
        near = np.flatnonzero((ids != here) & _may_be_worse(s.max() + most, apart, own.min()))
        out = [pdf.assign(block=np.int32(-1), worst=own)]
        step = max(1, RATIOS // max(1, len(near)))
        for i in range(0, len(x), step):
            part = slice(i, i + step)
            apart = _apart(x[part], x[part], lows[near], highs[near])
            asks = _may_be_worse(s[part, None] + most[near], apart, own[part, None])
            row, other = np.nonzero(asks)
            out.append(pdf.iloc[row + i].assign(block=ids[near[other]], worst=own[row + i]))
        return pd.concat(out)

    schema = f"label {kind}, x array<double>, s double, block int, worst double"
    asked = stored(rows.groupBy("block").applyInPandas(ask, schema))
    sizes = asked.where("block >= 0").groupBy("block").count().collect()
    if not sizes:
        return asked.select("label", "worst")
    groups = spark.createDataFrame(
        [(r["block"], -(-r["count"] // GROUP_CLUSTERS)) for r in sizes], "block int, groups int"
    )
    salt = F.pmod(F.xxhash64("label"), F.col("groups")).cast("int").alias("salt")
    askers = lookup_join(asked, groups, "block", "label", len(sizes)).select("label", "x", "s", "block", salt)
    salts = F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("salt")
    held = lookup_join(rows, groups, "block", "label", len(sizes)).select("x", "s", "block", salts)

    def answer(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"label": left["label"][:0], "worst": np.zeros(0)})
        worst = _worst(matrix(left), left["s"].to_numpy(), matrix(right), right["s"].to_numpy())
        return pd.DataFrame({"label": left["label"].to_numpy(), "worst": worst})

    answers = (
        askers.groupBy("block", "salt")
        .cogroup(held.groupBy("block", "salt"))
        .applyInPandas(answer, f"label {kind}, worst double")
    )
    own = asked.where("block = -1").select("label", "worst")
    return own.unionByName(answers).groupBy("label").agg(F.max("worst").alias("worst"))
