"""Arithmetic expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(num, den) -> Column:
    """``num / den`` as a double; 0.0 when ``den`` is 0 or either side is NULL."""
    return F.coalesce(F.try_divide(num, den).cast("double"), F.lit(0.0))


def squared_distance(a, b) -> Column:
    """Squared Euclidean distance of two arrays of doubles."""
    gaps = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g)
