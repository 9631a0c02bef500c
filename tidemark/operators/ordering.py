"""Numbers and cuts by the order of a key, without a sort of all rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import quoted
from tidemark.operators.lookup import lookup_join
from tidemark.sources.layout import shared_folder
from tidemark.sources.writers import write_parquet

# Steps into which a range of the key is cut when a quantile is looked for.
STEPS = 4096
_LOWEST = -(1 << 63)


def with_gapless_id(
    df: DataFrame, key: Sequence[str], name: str = "battlelog_id", start: int = 0
) -> DataFrame:
    """Add a number that counts on from ``start`` in the order of ``key``, without gaps.

    The order is that of the key columns and then of all others, so equal rows only may swap
    numbers: a rerun, or another split of the input, gives the same. Spark sorts the rows into
    ranges of about one size, which are stored; each row is numbered within its range, and
    ranges by the rows of those before. A window sees one row per range.
    """
    spark = df.sparkSession
    ordered = df.orderBy(*map(quoted, key), *[quoted(c) for c in df.columns if c not in key])
    placed = ordered.withColumn("_place", F.monotonically_increasing_id())
    folder = shared_folder(spark)
    write_parquet(placed, folder)
    stored = spark.read.schema(placed.schema).parquet(folder)
    # The number of the range is above bit 33, the place within it below.
    stored = stored.withColumns(
        {
            "_range": F.shiftright("_place", 33),
            "_place": F.col("_place").bitwiseAND((1 << 33) - 1),
        }
    )
    counts = stored.groupBy("_range").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    # As many rows as the sort has ranges.
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = lookup_join(stored, offsets, "_range", "_place", ranges)
    number = (F.col("_before") + F.col("_place") + start).alias(name)
    return numbered.select(*[quoted(c) for c in df.columns], number)


def order_number(df: DataFrame, key: str) -> Column:
    """A key as a long that keeps its order: numbers and times as they are, texts by their
    first seven bytes. A NULL comes first."""
    dtype, column = df.schema[key].dataType, quoted(key)
    if isinstance(dtype, T.IntegralType):
        number = column.cast("long")
    elif isinstance(dtype, T.DateType):
        number = F.unix_date(column).cast("long")
    elif isinstance(dtype, T.TimestampType):
        number = F.unix_micros(column)
    elif isinstance(dtype, T.TimestampNTZType):
        minutes = F.hour(column) * 60 + F.minute(column)
        seconds = F.extract(F.lit("SECOND"), column) + minutes * 60
        days = F.unix_date(column.cast("date")).cast("long") * 86_400_000_000
        number = days + (seconds * 1_000_000).cast("long")
    elif isinstance(dtype, T.StringType):
        start = F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), 1, 7)), 14, "0")
        number = F.conv(start, 16, 10).cast("long")
    else:
        raise ValueError(f"no order number for a key of type {dtype.simpleString()}")
    return F.coalesce(number, F.lit(_LOWEST))


def _ranks(n: int, parts: int) -> list[int]:
    """Rows ahead of each part but the first, where the first parts have a row more."""
    small, more = divmod(n, parts)
    return [i * small + min(i, more) for i in range(1, parts)]


def _flipped(x: int) -> int:
    """A long as a number from 0 on that keeps its order; the bits are those of x with the first
    one turned."""
    return x + (1 << 63)


def _refined(rows: DataFrame, open_cuts: list[dict]) -> None:
    """Narrow the ranges of some cuts by one histogram pass. A row is held by one condition at
    most.

    Cuts of one condition and range share a histogram, and ranges of one condition are equal or
    apart, so each row is counted once. A cell goes from the least to the greatest value in it.
    """
    flipped = F.col("value").bitwiseXOR(F.lit(_LOWEST))
    ranges: dict[tuple, list[dict]] = {}
    for cut in open_cuts:
        ranges.setdefault((cut["held"], cut["low"], cut["high"]), []).append(cut)
    cell = None
    for number, (held, low, high) in enumerate(ranges):
        least, most, bits = _flipped(low), _flipped(high), 0
        while (most >> bits) - (least >> bits) >= STEPS:
            bits += 1
        # What is left of 64 bits after a shift is a long.
        value, first = (F.shiftrightunsigned(flipped, bits), least >> bits) if bits else (F.col("value"), low)
        entry = F.struct(F.lit(number).alias("range"), F.try_subtract(value, F.lit(first)).alias("step"))
        inside = F.col("value").between(low, high)
        inside = inside if held is None else F.col(held) & inside
        cell = F.when(inside, entry) if cell is None else cell.when(inside, entry)
    seen = rows.select("value", cell.alias("h")).where("h is not null")
    # At most STEPS rows per range.
    found = seen.groupBy("h.range", "h.step").agg(
        F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    cells: dict[int, list] = {number: [] for number in range(len(ranges))}
    for r in found.collect():
        cells[r["range"]].append(r)
    for number, cuts in enumerate(ranges.values()):
        for cut in cuts:
            for r in sorted(cells[number], key=lambda r: r["step"]):
                if cut["ahead"] + r["n"] > cut["rank"]:
                    cut["low"], cut["high"] = r["low"], r["high"]
                    break
                cut["ahead"] += r["n"]


def exact_quantiles(
    df: DataFrame,
    number: Column,
    ranks: Sequence[int],
    held: Sequence[Column] | None = None,
    bounds: tuple[int, int] | None = None,
    apart: bool = False,
) -> list[tuple[int, int]]:
    """For each rank the value of the row that so many rows are ahead of in the order of
    ``number``, a long, and how many rows are below that value.

    Each pass cuts the range that holds the value into thousands and counts them, for all ranks
    at once, so a long takes six passes at most, and no rows are sorted or moved. ``held`` may
    restrict each rank to some of the rows; with ``apart`` a row is held by one column object
    at most, else each takes passes of its own. ``bounds`` are those of all values, if known.
    """
    if not ranks:
        return []
    # Columns cannot be compared; the same object is the same condition.
    flags = {id(h): h.alias(f"held{i}") for i, h in enumerate(held or ())}
    names = {key: f"held{i}" for i, key in enumerate(map(id, held or ()))}
    rows = df.select(number.alias("value"), *flags.values())
    low, high = bounds or rows.agg(F.min("value"), F.max("value")).first()
    cuts = [
        {"rank": r, "low": low, "high": high, "ahead": 0, "held": names[id(held[i])] if held else None}
        for i, r in enumerate(ranks)
    ]
    while open_cuts := [c for c in cuts if c["low"] < c["high"]]:
        _refined(rows, [c for c in open_cuts if apart or c["held"] == open_cuts[0]["held"]])
    return [(c["low"], c["ahead"]) for c in cuts]


def contiguous_parts(df: DataFrame, key: str, parts: int, name: str = "fold") -> DataFrame:
    """Add the part, 0 .. parts-1, of a row when the rows in the order of ``key`` are cut into
    parts of one size, the first ones with a row more where it does not come out even.

    The cuts are exact quantiles, found by counting. Rows with one key, or with texts of one
    start, go by a hash of the key and of all columns; equal rows stay together, so that only
    they can make sizes differ by more than one.
    """
    first, second = order_number(df, key), F.xxhash64(*[quoted(c) for c in (key, *df.columns)])
    n, *bounds = df.agg(F.count("*"), F.min(first), F.max(first)).first()
    ranks = [r for r in _ranks(n, parts) if r < n]
    found = exact_quantiles(df, first, ranks, bounds=bounds)
    cuts = [(rank - ahead, value) for rank, (value, ahead) in zip(ranks, found)]
    # Where rows of one key are on both sides of a cut, cut them by the hash.
    split = [(rank, value) for rank, value in cuts if rank]
    tied = {value: first == value for _, value in split}
    held = [tied[value] for _, value in split]
    whole = (_LOWEST, -1 - _LOWEST)
    found = exact_quantiles(df, second, [rank for rank, _ in split], held, whole, apart=True)
    hashes = dict(zip(split, (h for h, _ in found)))
    behind = [
        F.when((first > value) | ((first == value) & (second >= hashes.get((rank, value), _LOWEST))), 1)
        for rank, value in cuts
    ]
    return df.withColumn(name, sum((F.coalesce(b, F.lit(0)) for b in behind), F.lit(0)).cast("int"))
