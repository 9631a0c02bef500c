"""Column-name helpers; they look at the schema only."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """Column by its exact name, dots and slashes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def underscored(name: str) -> str:
    """A dotted path as a flat name."""
    return name.replace(".", "_")


def names_like(df: DataFrame, pattern: str) -> list[str]:
    """Names that match a regular expression as a whole, in column order."""
    return [c for c in df.columns if re.fullmatch(pattern, c)]


def names_except(df: DataFrame, dropped: Iterable[str]) -> list[str]:
    """All names but the given ones, in column order."""
    out = set(dropped)
    return [c for c in df.columns if c not in out]
