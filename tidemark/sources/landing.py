"""Landed payload files: what was read is known, so that each landing reads new files only."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.nested import parsed_once
from tidemark.sources.readers import BAD_RECORD
from tidemark.sources.versions import append_version, read_version, versions

ORIGIN = "origin"
LEDGER_DDL = "origin string, modified timestamp, size long, batch string"


@dataclass(frozen=True)
class Payloads:
    """One stored parse of payload documents: the records, the texts that do not parse, and
    what the write counted: ``rows``, ``bad`` and ``missing_<column>``."""

    good: DataFrame
    bad: DataFrame
    counts: dict[str, int]


def parsed_lines(lines: DataFrame, ddl: str) -> DataFrame:
    """(origin, record, bad) of JSON documents in ``value``: the record, or the text that does
    not parse as the schema. Blank lines are no documents."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD}
    lines = lines.filter(F.trim("value") != "")
    record = F.from_json("value", f"{ddl}, {BAD_RECORD} STRING", options)
    rows = lines.select(ORIGIN, "value", parsed_once(record).alias("record"))
    failed = F.col(f"record.{BAD_RECORD}").isNotNull()
    return rows.select(
        ORIGIN,
        F.when(~failed, F.col("record").dropFields(BAD_RECORD)).alias("record"),
        F.when(failed, F.col("value")).alias("bad"),
    )


def observed_counts(rows: DataFrame) -> dict[str, Column]:
    """Aggregates over parsed rows: documents, bad ones, and records without each field."""
    good = F.col("bad").isNull()
    missing = {
        f"missing_{f.name}": F.count_if(good & F.col("record").getField(f.name).isNull())
        for f in rows.schema["record"].dataType.fields
    }
    return {"rows": F.count(F.lit(1)), "bad": F.count("bad"), **missing}


def lines_of(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(origin, value): the lines of text files, and the file that each is from."""
    lines = spark.read.option("recursiveFileLookup", True).text(paths)
    return lines.select(F.col("_metadata.file_path").alias(ORIGIN), "value")


def store_payloads(spark: SparkSession, path: str, ddl: str, target: str) -> Payloads:
    """Read and parse JSON-line documents once and store them under ``target``; good and bad
    ones are then read from there, and the counts come from the write."""
    rows = parsed_lines(lines_of(spark, path), ddl)
    counts = Observation()
    numbers = [c.alias(name) for name, c in observed_counts(rows).items()]
    rows.observe(counts, *numbers).write.mode("overwrite").parquet(target)
    stored = spark.read.schema(rows.schema).parquet(target)
    return Payloads(
        stored.filter(F.col("bad").isNull()).select("record.*"),
        stored.filter(F.col("bad").isNotNull()).select(F.col("bad").alias(BAD_RECORD)),
        dict(counts.get),
    )


def require_observed(
    counts: dict[str, int], name: str, what: str, most: float | None = None
) -> None:
    """Raise when the write counted no ``name``, or with ``most`` more than that share of the
    rows."""
    if most is None and not counts[name]:
        raise ValueError(f"no {name} in {what}")
    if most is not None and counts[name] > most * counts["rows"]:
        raise ValueError(f"{counts[name]} of {counts['rows']} rows in {what} are {name}")


def landed_files(spark: SparkSession, source: str) -> DataFrame:
    """(origin, path, modified, size) of the files under a folder, without reading them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    return files.select(
        F.col("_metadata.file_path").alias(ORIGIN),
        "path",
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_size").alias("size"),
    )


def land(spark: SparkSession, source: str, target: str, ddl: str) -> dict[str, int]:
    """Read the payload files under ``source`` that are new or have changed since the landings
    before, and add them to the landed table ``target``. Returns what was counted.

    The ledger (origin, modified, size, batch) names the batch that holds the rows of a file.
    Rows are written first and the ledger, a versioned table, is committed last: a landing that
    fails has no effect, and the next one reads its files again. A changed file gets a new
    batch, and with it its old rows are out. A file that is gone keeps its rows.
    """
    ledger = read_ledger(spark, target)
    keys = [ORIGIN, "modified", "size"]
    fresh = landed_files(spark, source).join(ledger, keys, "left_anti").collect()
    counts = {"files": len(fresh), "rows": 0, "bad": 0}
    if not fresh:
        return counts
    batch = uuid.uuid4().hex
    rows = parsed_lines(lines_of(spark, [r["path"] for r in fresh]), ddl)
    seen = Observation()
    numbers = [c.alias(name) for name, c in observed_counts(rows).items()]
    rows.observe(seen, *numbers).write.parquet(f"{_rows_path(target)}/batch={batch}")
    counts |= seen.get
    added = spark.createDataFrame([(*(r[k] for k in keys), batch) for r in fresh], LEDGER_DDL)
    kept = ledger.join(added.select(ORIGIN), ORIGIN, "left_anti")
    append_version(kept.unionByName(added), _ledger_path(target), f"{_next(spark, target):012d}")
    return counts


def _ledger_path(target: str) -> str:
    return f"{target.rstrip('/')}/ledger"


def _rows_path(target: str) -> str:
    return f"{target.rstrip('/')}/rows"


def _next(spark: SparkSession, target: str) -> int:
    stored = versions(spark, _ledger_path(target))
    return int(stored[-1]) + 1 if stored else 1


def read_ledger(spark: SparkSession, target: str) -> DataFrame:
    """(origin, modified, size, batch) of the files whose rows are landed."""
    if not versions(spark, _ledger_path(target)):
        return spark.createDataFrame([], LEDGER_DDL)
    return read_version(spark, _ledger_path(target)).drop("version")


def read_landed(spark: SparkSession, target: str, ddl: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of a landed table: the records of all files as they were read last, each
    with its ``origin``, and the texts that do not parse."""
    ledger = read_ledger(spark, target).select(ORIGIN, "batch")
    schema = f"origin string, record struct<{ddl}>, bad string, batch string"
    if versions(spark, _ledger_path(target)):
        rows = spark.read.schema(schema).parquet(_rows_path(target))
    else:
        rows = spark.createDataFrame([], schema)
    # One ledger row per file and batch; batches that no file points to are not read.
    current = rows.join(ledger, [ORIGIN, "batch"], "left_semi")
    good = current.filter(F.col("bad").isNull()).select(ORIGIN, "record.*")
    bad = current.filter(F.col("bad").isNotNull())
    return good, bad.select(ORIGIN, F.col("bad").alias(BAD_RECORD))
