"""Writers: CSV, Parquet, JSON records and models. Versioned tables are in ``versions``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame

from tidemark.sources.versions import append_version, read_version, versions

__all__ = [
    "append_version",
    "read_version",
    "versions",
    "write_csv",
    "write_model",
    "write_parquet",
    "write_record",
]


def write_csv(df: DataFrame, path: str) -> None:
    """Replace a CSV table, with a header and quotes doubled inside values."""
    df.write.mode("overwrite").option("escape", '"').csv(path, header=True)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a Parquet table."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_record(df: DataFrame, path: str) -> None:
    """Replace a small table of metrics or parameters, as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_model(model: KMeansModel, path: str) -> None:
    """Replace a stored model."""
    model.write().overwrite().save(path)
