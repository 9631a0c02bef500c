"""Versioned tables: a folder of files per write, and a manifest per version.

``path/data/<id>`` holds the files of one write and ``path/manifests/<version>.json`` names the
folder that a version consists of, with its rows, files and schema. Files come first and the
manifest is put in place last, in one step, so a write that fails leaves nothing to be seen;
its folder is never read.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.files import file_names, put_text

MANIFESTS = "manifests"
MANIFEST_DDL = "version string, folder string, files array<string>, n_rows long, schema string"


def _manifest_path(path: str, version: str) -> str:
    return f"{path.rstrip('/')}/{MANIFESTS}/{quote(version, safe='')}.json"


def append_version(
    df: DataFrame, path: str, version: str, observed: dict | None = None
) -> dict:
    """Add a version of a table beside the earlier ones, and return its manifest. Versions sort
    by their text, as ISO times do.

    A version may have no rows. One that is there already is replaced, also by an empty one;
    its old files stay until they are removed. Rows are counted by the write itself, and so
    are the aggregates in ``observed``, which come back under their names.
    """
    spark, folder = df.sparkSession, f"data/{uuid.uuid4().hex}"
    counts = Observation()
    more = [expression.alias(name) for name, expression in (observed or {}).items()]
    rows = df.observe(counts, F.count(F.lit(1)).alias("_rows"), *more)
    rows.write.parquet(f"{path.rstrip('/')}/{folder}")
    found = dict(counts.get)
    manifest = {
        "version": version,
        "folder": folder,
        "files": file_names(spark, f"{path.rstrip('/')}/{folder}", ".parquet"),
        "n_rows": found.pop("_rows"),
        "schema": df.schema.json(),
    }
    put_text(spark, _manifest_path(path, version), json.dumps(manifest))
    return manifest | {"observed": found}


def versions(spark: SparkSession, path: str) -> list[str]:
    """The stored versions, oldest first, from the names of the manifests."""
    names = file_names(spark, f"{path.rstrip('/')}/{MANIFESTS}", ".json")
    return sorted(unquote(n.removesuffix(".json")) for n in names)


def manifest_of(spark: SparkSession, path: str, version: str | None = None) -> dict:
    """The manifest of a version, by default the latest."""
    stored = versions(spark, path)
    if not stored or version not in (None, *stored):
        raise ValueError(f"no version {version or ''} of {path}".replace("  ", " "))
    file = _manifest_path(path, stored[-1] if version is None else version)
    return spark.read.schema(MANIFEST_DDL).json(file).first().asDict()


def read_version(
    spark: SparkSession, path: str, version: str | None = None
) -> DataFrame:
    """One version of a table, by default the latest, with its ``version``; only its files are
    read."""
    manifest = manifest_of(spark, path, version)
    schema = T.StructType.fromJson(json.loads(manifest["schema"]))
    rows = spark.read.schema(schema).parquet(f"{path.rstrip('/')}/{manifest['folder']}")
    return rows.withColumn("version", F.lit(manifest["version"]))


def version_history(spark: SparkSession, path: str) -> DataFrame:
    """(version, n_rows, n_files) of all versions, from the manifests."""
    rows = spark.read.schema(MANIFEST_DDL).json(f"{path.rstrip('/')}/{MANIFESTS}")
    return rows.select("version", "n_rows", F.size("files").alias("n_files"))
