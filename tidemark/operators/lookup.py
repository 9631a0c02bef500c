"""Join of a large table to a small lookup table whose size may or may not be known."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup table is broadcast only when it is known to have at most this many rows.
BROADCAST_ROWS = 10_000

# Copies of a lookup row when the table is too large, or of unknown size, to broadcast.
SALTS = 64


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    on: str,
    spread_by: str | Sequence[str],
    lookup_rows: int | None = None,
) -> DataFrame:
    """Inner equi-join of ``left`` to a small table, mostly with one row per ``on`` value.

    With a row count known to be small the lookup side is broadcast. Otherwise each
    lookup row is copied once per salt and the left rows of a key are spread over the
    salts by a hash of ``spread_by``, so that a key holding a large share of ``left``
    is still joined by many tasks.
    """
    if lookup_rows is not None and lookup_rows <= BROADCAST_ROWS:
        return left.join(F.broadcast(lookup), on)
    salted = lookup.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    columns = [spread_by] if isinstance(spread_by, str) else spread_by
    # Never NULL, and known not to be: a filter for that would keep Spark from using one
    # shuffle for both sides where the lookup table is made of the same rows.
    salt = F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int")
    spread = left.withColumn("_salt", F.coalesce(salt, F.lit(0)))
    return spread.join(salted, [on, "_salt"]).drop("_salt")
