"""Shaping of records: flattening, key columns, unions, samples and simple checks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import quoted, underscored
from tidemark.params import require_columns


def _leaves(column: Column, path: str, dtype: T.DataType) -> list[Column]:
    if isinstance(dtype, T.StructType):
        return [
            leaf
            for f in dtype.fields
            for leaf in _leaves(column.getField(f.name), f"{path}.{f.name}", f.dataType)
        ]
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        column = F.to_json(column)
    return [column.alias(underscored(path))]


def flatten(df: DataFrame) -> DataFrame:
    """One column per leaf, named by its path with ``_``; a list is kept as JSON text. Two
    leaves of one name, as of ``a.b`` and ``a_b``, are an error."""
    flat = df.select(
        *[
            leaf
            for f in df.schema.fields
            for leaf in _leaves(quoted(f.name), f.name, f.dataType)
        ]
    )
    twice = sorted({c for c in flat.columns if flat.columns.count(c) > 1})
    if twice:
        raise ValueError(f"several leaves are named {', '.join(twice)}")
    return flat


def with_key(df: DataFrame, value: str, name: str = "player_id") -> DataFrame:
    """Add a constant key column."""
    return df.withColumn(name, F.lit(value))


def apply_ddl(df: DataFrame, ddl: str) -> DataFrame:
    """The columns of a DDL schema, in its order and with its types. A missing column or
    a value that cannot be cast is an error."""
    schema = T.StructType.fromDDL(ddl)
    require_columns(df.columns, schema.names)
    return df.select(
        *[quoted(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def empty_like(df: DataFrame) -> DataFrame:
    """A table with the same columns and no row."""
    return df.sparkSession.createDataFrame([], df.schema)


def union_by_position(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of frames that have the same columns in the same order."""
    return reduce(DataFrame.union, frames)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of frames with different columns; what a frame lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def head_of_list(items: DataFrame, n: int | None, position: str = "pos") -> DataFrame:
    """The first ``n`` items by position, or all of them when ``n`` is not given."""
    return items.orderBy(position).limit(n) if n else items


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Raise when a frame has no row. Looks for one row only."""
    if df.isEmpty():
        raise ValueError(f"no rows in {what}")
    return df


def _missing(name: str, dtype: T.DataType) -> Column:
    absent = quoted(name).isNull()
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        absent = absent | F.isnan(quoted(name))
    return absent


def null_profile(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """(column_name, missing): NULL or NaN values per column, in one pass."""
    wanted = set(columns) if columns is not None else set(df.columns)
    fields = [f for f in df.schema.fields if f.name in wanted]
    counts = df.agg(
        *[F.count_if(_missing(f.name, f.dataType)).alias(f.name) for f in fields]
    )
    return counts.unpivot(
        [], [quoted(f.name) for f in fields], "column_name", "missing"
    )


def count_parity(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row (rows_before, rows_after, equal): both counts."""
    sides = before.select(F.lit(0).alias("side")).union(
        after.select(F.lit(1).alias("side"))
    )
    return sides.agg(
        F.count_if(F.col("side") == 0).alias("rows_before"),
        F.count_if(F.col("side") == 1).alias("rows_after"),
    ).withColumn("equal", F.col("rows_before") == F.col("rows_after"))
