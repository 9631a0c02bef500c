"""Audit of filters that follow one another: what each removes in every order."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, lookup, store

# The filter that compares whole texts; it has no condition of its own.
COPIES = "E"
# Parts whose rows are made together.
PARTS = 128

_ROWS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def default_filters(text: Column) -> dict[str, Column]:
    """Failure conditions by letter. A: few words; B: few different words; C: many capitals;
    D: a symbol of markup. The text must not be NULL."""
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    # Bound to a variable, so that the words are found once.
    sizes = F.element_at(
        F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d"))),
        1,
    )
    return {
        "A": sizes["n"] < 100,
        "B": 100 * sizes["d"] < 80 * sizes["n"],
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def _never_sent(counts: DataFrame) -> DataFrame:
    """The frame, joined by sorting. Spark goes by the size of its files, and the salted copies of
    a few MB of them can be more than the driver holds."""
    return counts.hint("merge")


def _copies(marked: DataFrame) -> DataFrame:
    """Adds ``copy``: whether a smaller id has the same text."""
    least, most = F.min("doc_id").alias("least"), F.max("doc_id").alias("most")
    firsts = marked.groupBy("h1", "h2").agg(least, most).where("least < most").drop("most")
    joined = lookup(marked, _never_sent(firsts), ["h1", "h2"], "left")
    return joined.withColumn("copy", F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)))


def failure_cells(
    docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column], part: Column
) -> DataFrame:
    """``part, mask, n, good, toxic``: documents, and those labelled so, by what they fail.

    Bit i of ``mask`` stands for the i-th filter; the last bit for copies of earlier texts.
    """
    bits = [F.when(fails, F.lit(1 << i)).otherwise(0) for i, fails in enumerate(filters.values())]
    text = F.coalesce("text", F.lit(""))
    # Narrow rows, stored: texts are read and cut into words once.
    marked = store(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce(part.cast("string"), F.lit("")).alias("part"),
            sum(bits, F.lit(0)).alias("mask"),
            F.xxhash64(text).alias("h1"),
            F.xxhash64(F.lit("text"), text).alias("h2"),
        )
    )
    mask = F.col("mask") + F.when(F.col("copy"), F.lit(1 << len(bits))).otherwise(0)
    placed = _copies(marked).select("doc_id", "part", mask.alias("mask"), "h1")
    ids = F.col("doc_id").cast("long").alias("doc_id")
    flags = labels.select(ids, (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    flags = flags.groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    flags = flags.where(F.col("doc_id").isNotNull() & (F.col("good") | F.col("toxic")))
    marks = lookup(placed, _never_sent(flags), ["doc_id"], "left")
    return marks.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )


def subset_states(cells: np.ndarray) -> np.ndarray:
    """Survivors of every subset of filters, given the counts of every mask, along the last axis.

    The subsets are walked in Gray code, one filter on or off at a time. Each mask cell counts
    its active failures; a cell leaves the survivors when its count rises from 0 and comes back
    when it falls to 0.
    """
    size = cells.shape[-1]
    masks = np.arange(size)
    active = np.zeros(size, np.int64)
    states = np.empty_like(cells)
    survivors, subset = cells.sum(-1), 0
    states[..., 0] = survivors
    for step in range(1, size):
        bit = step & -step
        subset ^= bit
        on, fails = bool(subset & bit), masks & bit > 0
        active[fails] += 1 if on else -1
        turned = fails & (active == (1 if on else 0))
        change = cells[..., turned].sum(-1)
        survivors = survivors - change if on else survivors + change
        states[..., subset] = survivors
    return states


def _step_columns(cells: np.ndarray, letters: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Orders, steps, and counts of shape (parts, orders * steps, 7), for cells of shape
    (parts, 3, masks)."""
    states = subset_states(cells)
    orders = ["".join(o) for o in permutations(letters)]
    bit = {letter: 1 << i for i, letter in enumerate(letters)}
    # Subsets before and after each step, and the bit of its filter.
    before, after, own = [], [], []
    for order in orders:
        subset = 0
        for letter in order:
            before.append(subset)
            subset |= bit[letter]
            after.append(subset)
            own.append(bit[letter])
    everything = (1 << len(letters)) - 1
    own = np.array(own)
    lost = states[..., before] - states[..., after]
    n, removed = states[:, 0], lost[:, 0]
    fails = n[:, :1] - n[:, own]
    unique = n[:, everything ^ own] - n[:, [everything]]
    shapley = np.zeros_like(removed)
    for b in bit.values():
        shapley[:, own == b] = removed[:, own == b].sum(1, keepdims=True)
    columns = [n[:, after], removed, fails - removed, unique, lost[:, 1], lost[:, 2], shapley]
    return orders, np.tile(np.arange(1, len(letters) + 1), len(orders)), np.stack(columns, -1)


def order_steps(cells: DataFrame, letters: str) -> DataFrame:
    """All steps of all orders of the filters, given the cells of each part."""
    size = 1 << len(letters)
    cell = F.struct("mask", "n", "good", "toxic")
    # At most one entry per mask.
    parts = cells.groupBy("part").agg(F.collect_list(cell).alias("cells"))

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, PARTS):
                batch = whole.slice(begin, PARTS)
                counts = np.zeros((batch.num_rows, 3, size), np.int64)
                for row, found in enumerate(batch.column("cells").to_pylist()):
                    for c in found:
                        counts[row, :, c["mask"]] = c["n"], c["good"], c["toxic"]
                orders, at, columns = _step_columns(counts, letters)
                names = pa.array(orders).take(pa.array(np.repeat(np.arange(len(orders)), len(letters))))
                per_part = len(at)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("part").take(pa.array(np.repeat(np.arange(batch.num_rows), per_part))),
                        names.take(pa.array(np.tile(np.arange(per_part), batch.num_rows))),
                        pa.array(np.tile(at, batch.num_rows).astype(np.int32)),
                        *[pa.array(columns[..., i].ravel()) for i in range(columns.shape[-1])],
                    ],
                    names=[c.split()[0] for c in _ROWS.split(", ")],
                )

    return parts.mapInArrow(steps, _ROWS)


def audit_filters(
    docs: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, Column] | None = None,
    part: Column | None = None,
) -> DataFrame:
    """What every filter removes at every step of every order in which filters can be applied.

    ``filters`` gives failure conditions over the columns of ``docs`` by letter, by default
    those of :func:`default_filters`; the filter ``E`` comes on top and fails documents whose
    text a smaller ``doc_id`` has, removed or not. ``part`` splits the documents, by default by
    ``lang``. Returns ``part, filter_order, step`` with ``kept`` (after the step), ``removed``
    (by it), ``redundant`` (failing its filter but removed earlier), ``unique_fails`` (failing
    its filter only), ``good_lost`` and ``toxic_lost`` (removed by it and labelled ``quality``
    or ``toxic`` 1), and ``shapley`` (removed by its filter over all orders, at any step).

    A NULL text is empty, and so a copy of other empty ones; a NULL part is the empty string. A
    row with a NULL ``doc_id`` is no copy and has none, and no label. Repeated rows are rows
    each; equal texts under one id are no copies of each other. A document with several
    labels is good or toxic if any says so. Texts of any length are read whole. An empty
    table gives no rows. Columns with other names may be there.

    Documents are counted by part and by the set of filters they fail, with map-side sums; the
    orders are then read off these counts. Per part the subsets of filters are walked in Gray
    code and the survivors of each stored; every step is a difference of two subsets.
    """
    text = F.coalesce("text", F.lit(""))
    filters = default_filters(text) if filters is None else filters
    cells = failure_cells(docs, labels, filters, F.col("lang") if part is None else part)
    return order_steps(cells, "".join(filters) + COPIES)
