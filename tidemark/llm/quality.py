"""Quality scores from random-indexing word vectors and a small network."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tokens import CLASSES, mix, owners, words

# Words share 2^14 rows by hash, each row a vector of 64 dimensions: 4 MB in all.
ROW_BITS, DIMS = 14, 64
ROWS = 1 << ROW_BITS
# Neighbours on each side that count, and entries of a word's random index vector.
WINDOW, ENTRIES = 2, 4
# Words that take part in one step of numpy work: counting, and pooling.
BLOCK, POOLED = 1 << 17, 1 << 13


def _rows(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Row of each word. A word that repeats the one before has the last row instead."""
    rows = (hashes >> np.uint64(64 - ROW_BITS)).astype(np.int64)
    rows = np.minimum(rows, ROWS - 2)
    same = np.zeros(len(rows), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[at[:-1][at[:-1] < len(rows)]] = False
    rows[same] = ROWS - 1
    return rows


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries of each row's random index vector."""
    seeds = np.arange(ROWS * ENTRIES, dtype=np.uint64).reshape(ROWS, ENTRIES)
    bits = mix(seeds + np.uint64(1))
    return (bits % np.uint64(DIMS)).astype(np.int64), 1 - 2 * (bits >> np.uint64(63)).astype(np.int64)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the index vectors of each word's neighbours, over one partition."""
    places, signs = _index_vectors()
    sums, counts = np.zeros(ROWS * DIMS), np.zeros(ROWS)
    for batch in batches:
        hashes, at = words(batch.column(0), CLASSES)
        rows, text = _rows(hashes, at), owners(at)
        for begin in range(0, len(rows), BLOCK):
            part = rows[begin : begin + BLOCK + WINDOW]
            own = text[begin : begin + BLOCK + WINDOW]
            counts += np.bincount(part[:BLOCK], minlength=ROWS)
            for gap in range(1, WINDOW + 1):
                m = min(BLOCK, len(part) - gap)
                if m <= 0:
                    continue
                near = own[:m] == own[gap : gap + m]
                a, b = part[:m][near], part[gap : gap + m][near]
                for word, other in ((a, b), (b, a)):
                    cell = word[:, None] * DIMS + places[other]
                    sums += np.bincount(
                        cell.ravel(), signs[other].ravel(), minlength=ROWS * DIMS
                    )
    used = np.flatnonzero(counts)
    vectors = sums.reshape(ROWS, DIMS)[used].astype(np.int64)
    columns = [pa.array(used.astype(np.int32)), pa.array(counts[used].astype(np.int64))]
    columns += [pa.array(vectors[:, i]) for i in range(DIMS)]
    yield pa.RecordBatch.from_arrays(columns, names=["row", "n", *_axes()])


def _axes() -> list[str]:
    return [f"v{i}" for i in range(DIMS)]


def word_vectors(docs: DataFrame) -> np.ndarray:
    """One unit vector per row of words, learned from the neighbours of all words of all texts.

    Partitions sum up on their own; Spark adds the sums. What reaches the driver is bounded by
    the table of rows and dimensions, whatever the corpus.
    """
    schema = "row int, n long, " + ", ".join(f"{a} long" for a in _axes())
    sums = docs.select("text").mapInArrow(_contexts, schema)
    sums = sums.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n", *_axes())])
    got = sums.toArrow()
    out = np.zeros((ROWS, DIMS), np.float32)
    if len(got):
        vectors = np.stack([got[a].to_numpy() for a in _axes()], 1).astype(np.float64)
        length = np.linalg.norm(vectors, axis=1, keepdims=True)
        out[got["row"].to_numpy()] = vectors / np.maximum(length, 1e-9)
    return out


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Per text: mean and spread of its words' vectors; zeros without words."""
    hashes, at = words(texts, CLASSES)
    rows, text = _rows(hashes, at), owners(at)
    # Vectors and their squares side by side: one gather and one sum for both.
    table = np.hstack([vectors, vectors * vectors]).astype(np.float32)
    sums = np.zeros((len(texts), 2 * DIMS))
    for begin in range(0, len(rows), POOLED):
        own = text[begin : begin + POOLED]
        heads = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        sums[own[heads]] += np.add.reduceat(table[rows[begin : begin + POOLED]], heads, axis=0)
    sums /= np.maximum(np.diff(at), 1)[:, None]
    mean, squares = sums[:, :DIMS], sums[:, DIMS:]
    return np.hstack([mean, np.sqrt(np.maximum(squares - mean * mean, 0))])


@dataclass
class QualityModel:
    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    temperature: float

    def logits(self, features: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        hidden = np.maximum((features - self.centre) / self.scale @ w1 + b1, 0)
        return (hidden @ w2 + b2)[:, 0]

    def scores(self, features: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(features) / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _train(x: np.ndarray, y: np.ndarray, hidden: int, epochs: int, decay: float) -> list:
    """Two layers by Adam on shuffled blocks of 256 rows; the seed is fixed."""
    rng = np.random.default_rng(0)
    w = [
        rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)),
        np.zeros(hidden),
        rng.normal(0, np.sqrt(1 / hidden), (hidden, 1)),
        np.zeros(1),
    ]
    first, second, step = [0 * a for a in w], [0 * a for a in w], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for begin in range(0, len(x), 256):
            rows = order[begin : begin + 256]
            inner = np.maximum(x[rows] @ w[0] + w[1], 0)
            error = (_sigmoid((inner @ w[2] + w[3])[:, 0]) - y[rows])[:, None] / len(rows)
            back = error @ w[2].T * (inner > 0)
            slopes = [
                x[rows].T @ back + decay * w[0],
                back.sum(0),
                inner.T @ error + decay * w[2],
                error.sum(0),
            ]
            step += 1
            for i, g in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                up = first[i] / (1 - 0.9**step)
                w[i] = w[i] - 0.003 * up / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return w


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits, out of a fixed grid, with the best likelihood."""
    grid = np.geomspace(0.25, 8, 41)
    sign = np.where(y > 0, 1.0, -1.0)
    losses = [np.logaddexp(0, -sign * logits / t).mean() for t in grid]
    return float(grid[int(np.argmin(losses))])


def labelled_sample(
    docs: DataFrame, labels: DataFrame, mark: str, rows: int, learn: Column | None = None
) -> DataFrame:
    """``text, y`` of at most ``rows`` labelled documents, chosen by a hash of their ids.

    ``labels`` has ``doc_id`` and the mark; NULL marks do not count, and of several marks of
    one document the largest counts. ``learn`` is a condition on the labels' ``doc_id``. The
    chosen ids are at most ``rows``, so they are broadcast, and no text is shuffled.
    """
    chosen = labels if learn is None else labels.where(learn)
    chosen = chosen.where(F.col("doc_id").isNotNull() & F.col(mark).isNotNull())
    chosen = chosen.groupBy("doc_id").agg(F.max(mark).alias("y"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", "text")
    return texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y")


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    rows: int = 12_000,
    hidden: int = 32,
    epochs: int = 30,
    decay: float = 1e-3,
) -> QualityModel | None:
    """A quality model of the corpus; None if no labelled document is there.

    Word vectors come from all texts of ``docs``. The network learns from at most ``rows``
    documents with a ``quality`` label, of which one in five only sets the temperature;
    ``learn`` is a condition on the ``doc_id`` of usable labels. With labels of one class the
    scores are that class's.
    """
    vectors = word_vectors(docs)
    sample = labelled_sample(docs, labels, "quality", rows, learn)
    names = [f"f{i}" for i in range(2 * DIMS)]

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pooled(batch.column(1), vectors).astype(np.float32)
            kept = [batch.column(0), batch.column(2).cast(pa.int32())]
            kept += [pa.array(x[:, i]) for i in range(2 * DIMS)]
            yield pa.RecordBatch.from_arrays(kept, names=["doc_id", "y", *names])

    schema = "doc_id long, y int, " + ", ".join(f"{c} float" for c in names)
    got = sample.mapInArrow(features, schema).toArrow().sort_by(
        [(c, "ascending") for c in ("doc_id", *names[:4])]
    )
    if not len(got):
        return None
    x = np.stack([got[c].to_numpy() for c in names], 1)
    y = (got["y"].to_numpy() > 0).astype(np.float32)
    del got
    centre, scale = x.mean(0), x.std(0) + 1e-6
    part = np.arange(len(x)) % 5 == 0 if len(x) >= 50 else np.zeros(len(x), bool)
    weights = _train((x[~part] - centre) / scale, y[~part], hidden, epochs, decay)
    pa.default_memory_pool().release_unused()
    model = QualityModel(vectors, centre, scale, weights, 1.0)
    if part.any():
        model.temperature = _temperature(model.logits(x[part]), y[part])
    return model


def quality_score(model: QualityModel | None, text: Column) -> Column:
    """Probability that a text is of good quality.

    A NULL or empty text is scored as one without words. Without a model it is 0.5.
    """
    if model is None:
        return F.lit(0.5)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(pooled(texts, model.vectors)))

    return score(text)


def good_documents(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    least: float = 0.5,
    **settings,
) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``least``, with all their columns."""
    model = fit_quality(docs, labels, learn, **settings)
    return docs.where(quality_score(model, docs["text"]) >= least)


def score_quality(
    docs: DataFrame, labels: DataFrame, learn: Column | None = None, **settings
) -> DataFrame:
    """``doc_id, score`` of every row of ``docs``, in one pass after the model is fitted.

    Repeated rows are scored each; a NULL ``doc_id`` is kept and never learned from; an empty
    table gives no rows. Other columns are not read.
    """
    model = fit_quality(docs, labels, learn, **settings)
    return docs.select("doc_id", quality_score(model, F.col("text")).alias("score"))
