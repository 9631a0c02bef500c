"""Sums of distances over all pairs of points, two slices of the points at a time."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Functions of this module travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Points of a tile at most: the distances of two of them stay in cache.
TILE_ROWS = 256
# A square that is no more than this share of the squares of both points, as seen from the middle
# of their slice, is measured again by direct differences. The others are off by less than
# (dims + 2) * 2 ** -52 / NEAR of themselves: in 64 dimensions two parts in 10 ** 9.
NEAR = 1e-5
# Values of differences that are held at once, and sums of a batch of rows.
DIFFERENCES, SUMS = 32_768, 262_144


def _matrix(x: pa.Array) -> np.ndarray:
    """Coordinates of lists of the same length."""
    sizes = x.value_lengths().to_numpy(zero_copy_only=False)
    if x.null_count or len(np.unique(sizes)) > 1:
        raise ValueError("points must have the same number of dimensions")
    return x.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(len(x), int(sizes[0]))


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, label, wide, x) with coordinates as bytes: of doubles where ``wide``, elsewhere of
    single precision, which has the same numbers."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _matrix(batch.column("x"))
        with np.errstate(over="ignore"):
            single = x.astype(np.float32)
        same = ((single == x) | np.isnan(x)).all(1)
        for wide, rows in ((False, same), (True, ~same)):
            if rows.any():
                values = (x if wide else single)[rows]
                ends = np.arange(len(values) + 1, dtype=np.int32) * (values.itemsize * values.shape[1])
                data = [None, pa.py_buffer(ends), pa.py_buffer(values.tobytes())]
                columns = [batch.column(c).filter(pa.array(rows)) for c in ("key", "label")]
                columns += [pa.array(np.full(len(values), wide)), pa.Array.from_buffers(pa.binary(), len(values), data)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "label", "wide", "x"])


def _unpacked(rows: pa.Table, kind: type) -> np.ndarray:
    """Coordinates from bytes."""
    x = rows["x"].combine_chunks()
    sizes = np.unique(pc.binary_length(x).to_numpy())
    if len(sizes) > 1:
        raise ValueError("points must have the same number of dimensions")
    dims = int(sizes[0]) // np.dtype(kind).itemsize
    if not dims:
        return np.zeros((len(x), 0))
    begin = int(np.frombuffer(x.buffers()[1], np.int32)[x.offset])
    return np.frombuffer(x.buffers()[2], kind, len(x) * dims, begin).reshape(-1, dims)


class Side:
    """The points of a slice in the order of their labels, from what :func:`packed` gives."""

    def __init__(self, rows: pa.Table):
        parts = [(rows.filter(pc.equal(rows["wide"], wide)), kind) for wide, kind in ((False, np.float32), (True, float))]
        parts = [(part, kind) for part, kind in parts if part.num_rows]
        found = [_unpacked(part, kind) for part, kind in parts]
        if len({x.shape[1] for x in found}) > 1:
            raise ValueError("points must have the same number of dimensions")
        rows = pa.concat_tables([part.drop_columns("x") for part, _ in parts])
        label = rows["label"].combine_chunks().dictionary_encode()
        codes = label.indices.to_numpy()
        order = np.argsort(codes, kind="stable")
        self.labels = label.dictionary
        self.codes = codes[order]
        self.key = rows["key"].combine_chunks().take(pa.array(order))
        self.label = rows["label"].combine_chunks().take(pa.array(order))
        self.x = np.concatenate(found, dtype=float)[order]
        self.sums = np.zeros((0, 0))

    def tiles(self, rows: int) -> list[tuple[slice, slice, np.ndarray]]:
        """Rows of each tile, the labels that they have, and which of them has which."""
        out = []
        for i in range(0, len(self.x), rows):
            codes = self.codes[i : i + rows]
            first, last = codes[0], codes[-1] + 1
            member = (codes[:, None] == np.arange(first, last)).astype(float)
            out.append((slice(i, i + len(codes)), slice(first, last), member))
        return out


def _middle(x: np.ndarray) -> np.ndarray:
    """The median of each dimension, over points without infinite or missing values."""
    whole = np.isfinite(x).all(1)
    return np.median(x[whole], axis=0) if whole.any() else np.zeros(x.shape[1])


def _measure_again(squares: np.ndarray, x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> None:
    """Put squares of direct differences where two points are near each other; also where a
    square is no number or too large for one."""
    most = NEAR * (nx.max() + ny.max())
    some = np.flatnonzero(~(squares.ravel() > most))
    i, j = np.divmod(some, squares.shape[1])
    near = ~(squares[i, j] > NEAR * (nx[i] + ny[j]))
    i, j = i[near], j[near]
    step = max(1, DIFFERENCES // max(1, x.shape[1]))
    for k in range(0, len(i), step):
        a, b = i[k : k + step], j[k : k + step]
        gaps = x[a] - y[b]
        squares[a, b] = np.einsum("ij,ij->i", gaps, gaps)


def _by_label(gaps: np.ndarray, member: np.ndarray) -> np.ndarray:
    """Sums of each row over the columns of each label; columns lie in the order of labels."""
    sums = gaps @ member
    if not np.isfinite(sums).all():
        # A product takes what is infinite or no number into the sums of all labels.
        sums = np.add.reduceat(gaps, member.argmax(0), axis=1)
    return sums


def add_distances(a: Side, b: Side, rows: int) -> None:
    """Set the sums of distances of each point of ``a`` to the points of each label of ``b``, and
    the other way round; of one side to itself if they are the same.

    A tile of squares is one matrix product, -2xy + |x|^2 + |y|^2 over coordinates from the middle
    of a slice.
    """
    rows = min(rows, TILE_ROWS)
    a.sums = np.zeros((len(a.x), len(b.labels)))
    b.sums = a.sums if a is b else np.zeros((len(b.x), len(a.labels)))
    held = np.empty(rows * rows)
    with np.errstate(all="ignore"):
        middle, dims = _middle(b.x), b.x.shape[1]
        tiles = []
        for two, labels_b, member_b in b.tiles(rows):
            right = np.ones((dims + 2, len(member_b)))
            np.subtract(b.x[two].T, middle[:, None], out=right[:dims])
            ny = right[-1] = np.einsum("ij,ij->j", right[:dims], right[:dims])
            right[:dims] *= -2
            tiles.append((two, labels_b, member_b, right, ny, ny.max()))
        for one, labels_a, member_a in a.tiles(rows):
            left = a.x[one] - middle
            nx = np.einsum("ij,ij->i", left, left)
            left = np.column_stack([left, nx, np.ones(len(nx))])
            most = nx.max()
            for two, labels_b, member_b, right, ny, most_b in tiles:
                if a is b and two.start < one.start:
                    continue
                gaps = held[: len(nx) * len(ny)].reshape(len(nx), len(ny))
                np.matmul(left, right, out=gaps)
                if not gaps.min() > NEAR * (most + most_b):
                    _measure_again(gaps, a.x[one], b.x[two], nx, ny)
                np.sqrt(gaps, out=gaps)
                a.sums[one, labels_b] += _by_label(gaps, member_b)
                if a is not b or two.start > one.start:
                    b.sums[two, labels_a] += _by_label(gaps.T, member_a)


def _lists(values: pa.Array, rows: int) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(rows + 1, dtype=np.int32) * (len(values) // rows), values)


def _rows(side: Side, other: Side) -> Iterator[pa.RecordBatch]:
    """Key, label, and lists of the other side's labels, the sums and the numbers of points."""
    k = len(other.labels)
    sizes = np.bincount(other.codes, minlength=k)
    step = max(1, SUMS // k)
    for i in range(0, len(side.x), step):
        sums = side.sums[i : i + step]
        n = np.tile(sizes, (len(sums), 1))
        if side is other:
            n[np.arange(len(sums)), side.codes[i : i + step]] -= 1
        others = other.labels.take(pa.array(np.tile(np.arange(k), len(sums))))
        columns = [
            side.key.slice(i, step),
            side.label.slice(i, step),
            _lists(others, len(sums)),
            _lists(pa.array(sums.ravel()), len(sums)),
            _lists(pa.array(n.ravel()), len(sums)),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "label", "others", "totals", "ns"])


def pair_sums(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """What :func:`add_distances` finds for each pair of slices, among rows of (pair, block) and
    what :func:`packed` gives."""
    found: dict[int, dict[int, list[pa.RecordBatch]]] = {}
    for batch in batches:
        pair, block = (batch.column(c).to_numpy() for c in ("pair", "block"))
        for p, q in {*zip(pair.tolist(), block.tolist())}:
            own = batch.filter(pa.array((pair == p) & (block == q)))
            found.setdefault(p, {}).setdefault(q, []).append(own)
    while found:
        pair, blocks = found.popitem()
        lo, hi = slices_of(pair)
        if lo not in blocks or hi not in blocks:
            continue
        sides = {q: Side(pa.Table.from_batches(blocks.pop(q))) for q in {lo, hi}}
        a, b = sides[lo], sides[hi]
        add_distances(a, b, rows)
        yield from _rows(a, b)
        if a is not b:
            yield from _rows(b, a)


def slices_of(pair: int) -> tuple[int, int]:
    """The lower and the higher slice of a pair; pairs are numbered from 0 by the higher one."""
    hi = 0
    while (hi + 1) * (hi + 2) // 2 <= pair:
        hi += 1
    return pair - hi * (hi + 1) // 2, hi
