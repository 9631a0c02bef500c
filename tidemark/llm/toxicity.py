"""Toxicity scores by FTRL-proximal logistic regression over hashed n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.quality import labelled_sample
from tidemark.llm.tokens import CLASSES, mix, owners, words

BITS = 22
# Words of texts that are turned into features in one step.
BLOCK = 1 << 17


def features(texts: pa.Array, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (text, feature): every word, pair of neighbours, and pair with one word between.

    A feature may come more than once in a text. Blocks overlap by two words, so that all
    pairs are seen; white space and line ends do not separate words, texts do.
    """
    hashes, at = words(texts, CLASSES)
    text = owners(at)
    shift = np.uint64(64 - bits)
    for begin in range(0, len(hashes), BLOCK):
        h, own = hashes[begin : begin + BLOCK + 2], text[begin : begin + BLOCK + 2]
        n = min(BLOCK, len(h))
        parts, texts_of = [h[:n]], [own[:n]]
        for gap, salt in ((1, 0x5851F42D4C957F2D), (2, 0x14057B7EF767814F)):
            m = min(n, len(h) - gap)
            if m > 0:
                near = own[:m] == own[gap : gap + m]
                pair = mix(h[:m] * np.uint64(salt) + h[gap : gap + m])
                parts.append(pair[near])
                texts_of.append(own[:m][near])
        yield np.concatenate(texts_of), (np.concatenate(parts) >> shift).astype(np.int64)


@dataclass
class ToxicityModel:
    """Features with a weight other than 0, their weights, and the constant."""

    places: np.ndarray
    weights: np.ndarray
    constant: float
    bits: int

    def scores(self, texts: pa.Array) -> np.ndarray:
        table = np.zeros(1 << self.bits, np.float32)
        table[self.places] = self.weights
        size, found = 1 << self.bits, [np.zeros(0, np.int64)]
        for text, feature in features(texts, self.bits):
            # A feature counts once per text; most have no weight and are dropped first.
            used = np.flatnonzero(table[feature])
            found.append(text[used] * size + feature[used])
        seen = np.unique(np.concatenate(found))
        logits = np.bincount(seen // size, table[seen % size], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(logits + self.constant, -40, 40)))


def _ftrl(
    docs: list[np.ndarray], y: np.ndarray, bits: int, epochs: int, alpha: float, l1: float
) -> ToxicityModel:
    """One pass per epoch over the documents; each has binary features and a constant.

    ``z`` and ``n`` are the usual sums of gradients and squared gradients per feature. The
    weight of a feature is 0 while ``|z| <= l1``; else its step shrinks with its own ``n``.
    """
    size, beta, l2 = 1 << bits, 1.0, 0.01
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weight(at: np.ndarray) -> np.ndarray:
        zi, limit = z[at], np.where(at == size, 0.0, l1)
        steep = (beta + np.sqrt(n[at])) / alpha + l2
        return np.where(np.abs(zi) <= limit, 0.0, (np.sign(zi) * limit - zi) / steep)

    rng = np.random.default_rng(0)
    for _ in range(epochs):
        for i in rng.permutation(len(docs)):
            at = docs[i]
            w = weight(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -40, 40))) - y[i]
            root = np.sqrt(n[at])
            z[at] += g - (np.sqrt(n[at] + g * g) - root) / alpha * w
            n[at] += g * g
    everything = weight(np.arange(size + 1))
    places = np.flatnonzero(everything[:size])
    return ToxicityModel(places, everything[places], float(everything[size]), bits)


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    rows: int = 16_000,
    epochs: int = 4,
    alpha: float = 3.0,
    l1: float = 5.0,
    bits: int = BITS,
) -> ToxicityModel | None:
    """A toxicity model; None if no labelled document is there.

    It learns from at most ``rows`` documents with a ``toxic`` label, in an order drawn from a
    fixed seed; ``learn`` is a condition on the ``doc_id`` of usable labels. Features are made
    in the tasks, and whole texts stay there. L1 leaves few weights, which go to all tasks.
    """
    sample = labelled_sample(docs, labels, "toxic", rows, learn)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
            for text, feature in features(batch.column(1), bits):
                seen = np.unique(text * (1 << bits) + feature)
                heads = np.searchsorted(seen, np.arange(batch.num_rows + 1) << bits)
                for i in np.flatnonzero(np.diff(heads)):
                    own[i].append((seen[heads[i] : heads[i + 1]] % (1 << bits)).astype(np.int32))
            packed = [
                np.unique(np.concatenate(x)).tobytes() if x else b"" for x in own
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2).cast(pa.int32()), pa.array(packed, pa.binary())],
                names=["doc_id", "y", "seen"],
            )

    got = sample.mapInArrow(found, "doc_id long, y int, seen binary").toArrow()
    if not len(got):
        return None
    got = got.sort_by([("doc_id", "ascending"), ("seen", "ascending")])
    y = (got["y"].to_numpy() > 0).astype(float)
    size = np.array([1 << bits])
    seen = [np.r_[np.frombuffer(x.as_py(), np.int32), size] for x in got["seen"]]
    return _ftrl(seen, y, bits, epochs, alpha, l1)


def toxicity_score(model: ToxicityModel | None, text: Column) -> Column:
    """Probability that a text is toxic; a NULL or empty text has the constant's. 0.5 without a model."""
    if model is None:
        return F.lit(0.5)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(texts))

    return score(text)


def score_toxicity(
    docs: DataFrame, labels: DataFrame, learn: Column | None = None, **settings
) -> DataFrame:
    """``doc_id, score`` of every row of ``docs``.

    Repeated rows are scored each; a NULL ``doc_id`` is kept and never learned from; an empty
    table gives no rows. Other columns are not read.
    """
    model = fit_toxicity(docs, labels, learn, **settings)
    return docs.select("doc_id", toxicity_score(model, F.col("text")).alias("score"))
