"""Sums of distances over all pairs against direct differences."""

import math
import time

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from tests.oracle import differences, duck
from tidemark.operators import pairs, quality
from tidemark.operators.pairs import Side, add_distances, packed, slices_of
from tidemark.operators.quality import as_points, distance_sums


def side(x, labels):
    rows = {"key": np.arange(len(x)), "label": labels, "x": pa.array(list(x))}
    return Side(pa.Table.from_batches(packed(pa.table(rows).to_batches())))


def by_hand(a, b):
    """Direct differences, one dimension at a time."""
    squares = np.zeros((len(a.x), len(b.x)))
    with np.errstate(all="ignore"):
        for i in range(a.x.shape[1]):
            squares += (a.x[:, i, None] - b.x[None, :, i]) ** 2
        member = (b.codes[:, None] == np.arange(len(b.labels))).astype(bool)
        gaps = np.sqrt(squares)
        return np.stack([gaps[:, m].sum(1) for m in member.T], 1)


def points(kind, n):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, 5))
    if kind == "copies":
        x = x[rng.integers(0, 9, n)]
    if kind == "tight":
        x = x[rng.integers(0, 9, n)] + 1e-9 * x
    if kind == "far":
        x += 1e8
    if kind == "equal":
        x[:] = x[0]
    if kind == "spread":
        x *= np.exp(5 * rng.normal(size=(n, 1)))
    if kind == "no numbers":
        x[:7, 2] = np.inf, -np.inf, np.nan, 1e200, 1e200, -1e200, 1.1e154
    return x, rng.choice(["a", "b", "c"], n)


@pytest.mark.parametrize("kind", ["plain", "copies", "tight", "far", "equal", "spread", "no numbers"])
def test_sums_are_those_of_direct_differences(kind):
    x, labels = points(kind, 90)
    a, b = side(x[:50], labels[:50]), side(x[50:], labels[50:])
    for one, two in ((a, b), (a, a)):
        add_distances(one, two, 16)
        for left, right in ((one, two), (two, one)):
            np.testing.assert_allclose(left.sums, by_hand(left, right), rtol=1e-12)


def test_sums_take_a_fraction_of_the_time_of_direct_differences():
    x, labels = np.random.default_rng(2).normal(size=(3_000, 64)), ["a", "b"] * 1_500
    a, b = side(x[:1_500], labels[:1_500]), side(x[1_500:], labels[1_500:])
    took = []
    for work in (lambda: add_distances(a, b, 256), lambda: by_hand(a, b)):
        begin = time.thread_time()
        work()
        took.append(time.thread_time() - begin)
    assert 3 * took[0] < took[1]


def test_pairs_are_numbered_without_gaps():
    found = [slices_of(p) for p in range(10)]
    assert found == [(lo, hi) for hi in range(4) for lo in range(hi + 1)]


def test_lists_of_sums_are_moved_and_copies_are_not_sorted(spark):
    rows = spark.range(900).selectExpr(
        "concat('k', id) as id", "concat('c', id % 20) as label", "array(cast(id as double), 0.1D, id / 7) as x"
    )
    # Some rows keep their numbers in single precision, others do not.
    sums = distance_sums(as_points(rows, "x", "label", key="id"), 100)
    got = {(r["key"], r["other"]): (r["total"], r["n"]) for r in sums.collect()}
    x = [(float(i), 0.1, i / 7) for i in range(900)]
    for i in (0, 13, 899):
        for c in range(20):
            gaps = [math.dist(x[i], x[j]) for j in range(c, 900, 20) if j != i]
            assert got[f"k{i}", f"c{c}"] == (pytest.approx(sum(gaps), rel=1e-12), len(gaps))
    assert len(got) == 900 * 20
    plan = sums._jdf.queryExecution().executedPlan()
    assert "InPandas" not in plan.toString() and "Sort" not in plan.toString()


def test_single_precision_is_only_used_where_it_is_exact(spark):
    values = [[0.5, -0.0], [0.1, 1.0], [1e100, 1.0], [float("nan"), 2.0], [float(2**24 + 1), 0.0]]
    rows = spark.createDataFrame([(i, 0, v) for i, v in enumerate(values)], "id int, label int, x array<double>")
    got = {r["key"]: r["total"] for r in distance_sums(as_points(rows, "x", "label", "id").where("key != 3")).collect()}
    kept = [v for i, v in enumerate(values) if i != 3]
    for k, v in zip((0, 1, 2, 4), kept):
        assert got[k] == pytest.approx(sum(math.dist(v, w) for w in kept), rel=1e-12)
    everything = distance_sums(as_points(rows, "x", "label", "id")).collect()
    assert all(math.isnan(r["total"]) for r in everything) and {r["n"] for r in everything} == {4}
    ragged = spark.createDataFrame([(1, 0, [1.0]), (2, 0, [1.0, 2.0])], "id int, label int, x array<double>")
    with pytest.raises(Exception, match="same number of dimensions"):
        distance_sums(as_points(ragged, "x", "label", "id")).collect()


def test_batches_of_sums_are_bounded(monkeypatch):
    monkeypatch.setattr(pairs, "SUMS", 12)
    x, labels = points("plain", 40)
    a = side(x, labels)
    add_distances(a, a, quality.BLOCK_ROWS)
    batches = list(pairs._rows(a, a))
    assert {b.num_rows for b in batches} == {4} and sum(b.num_rows for b in batches) == 40
    assert all(sum(n) == 39 for b in batches for n in b.column("ns").to_pylist())


def test_query_matches_sql_where_vectors_hold_no_numbers(spark, tmp_path):
    rng = np.random.default_rng(0)
    x, label = rng.normal(size=(600, 64)).astype(np.float32), np.arange(600, dtype=np.int32) % 10
    label[:4] = 10, 10, 11, 11
    x[0, 3], x[2, 5] = np.nan, np.inf
    x[100:140], x[200:220] = x[100], x[200] + 1e-6
    vectors = pa.array(list(x), pa.list_(pa.float32()))
    pq.write_table(
        pa.table({"vec_id": np.arange(600), "embedding": vectors, "label": label}),
        f"{tmp_path}/embeddings.parquet",
    )
    found = entry.queries()["silhouette_exact"](spark, str(tmp_path))
    assert differences(found, duck(tmp_path), entry.oracle_sql()["silhouette_exact"]) == []
