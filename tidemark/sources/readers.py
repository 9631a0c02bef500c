"""Readers: id lists, CSV, Parquet, and JSON payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.nested import parsed_once

BAD_RECORD = "_bad_record"

# The payload documents, one JSON object per line. Flattened, their leaves
# are the columns of the raw tables.
_UNIT = "STRUCT<id: BIGINT, name: STRING, power: BIGINT, trophies: BIGINT>"
_PLAYER = f"STRUCT<tag: STRING, name: STRING, brawler: {_UNIT}>"

BATTLE_PAYLOAD_DDL = f"""
    player_id STRING,
    items ARRAY<STRUCT<
        battleTime: STRING,
        event: STRUCT<id: BIGINT, mode: STRING, map: STRING>,
        battle: STRUCT<
            mode: STRING,
            type: STRING,
            result: STRING,
            duration: BIGINT,
            trophyChange: BIGINT,
            starPlayer: {_PLAYER},
            teams: ARRAY<ARRAY<{_PLAYER}>>,
            rank: BIGINT,
            players: ARRAY<{_PLAYER}>,
            bigBrawler: {_PLAYER},
            level: STRUCT<name: STRING, id: BIGINT>
        >
    >>
"""

PROFILE_PAYLOAD_DDL = f"""
    tag STRING,
    name STRING,
    nameColor STRING,
    trophies BIGINT,
    highestTrophies BIGINT,
    highestPowerPlayPoints DOUBLE,
    expLevel BIGINT,
    expPoints BIGINT,
    isQualifiedFromChampionshipChallenge BOOLEAN,
    `3vs3Victories` BIGINT,
    soloVictories BIGINT,
    duoVictories BIGINT,
    bestRoboRumbleTime BIGINT,
    bestTimeAsBigBrawler BIGINT,
    brawlers ARRAY<{_UNIT}>,
    icon STRUCT<id: BIGINT>,
    club STRUCT<tag: STRING, name: STRING>
"""


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """(pos, tag) from a text of comma-separated ids; nothing is trimmed.

    The comma is the record separator of the scan, so a long list is read in splits and
    never becomes one value. ``pos`` rises along the text but has gaps.
    """
    tags = spark.read.option("lineSep", ",").text(path)
    return tags.select(
        F.monotonically_increasing_id().alias("pos"), F.col("value").alias("tag")
    )


def split_id_list(lists: DataFrame, text: str, keys: Sequence[str] = ()) -> DataFrame:
    """([keys,] pos, tag) from id lists that are values of a column."""
    return lists.select(*keys, F.posexplode(F.split(text, ",")).alias("pos", "tag"))


def read_csv(
    spark: SparkSession, path: str, ddl: str | None = None, multi_line: bool = False
) -> DataFrame:
    """CSV with a header. With a DDL schema a value that does not fit fails the read;
    without one the types are inferred.

    ``multi_line`` admits line ends inside quoted values, but then a file is read by one
    task; without it large files are split.
    """
    reader = (
        spark.read.option("header", True)
        .option("sep", ",")
        .option("multiLine", multi_line)
        .option("escape", '"')
    )
    if ddl is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(ddl).option("mode", "FAILFAST").csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table."""
    return spark.read.parquet(path)


def read_payloads(
    spark: SparkSession, path: str, ddl: str
) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of JSON-line documents: the parsed records, and the text of those that
    do not parse as the schema. A bad document never stops the read; blank lines are not
    documents."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD}
    lines = spark.read.text(path).filter(F.trim("value") != "")
    record = F.from_json("value", f"{ddl}, {BAD_RECORD} STRING", options)
    records = lines.select("value", parsed_once(record).alias("record"))
    failed = F.col(f"record.{BAD_RECORD}").isNotNull()
    good = records.filter(~failed).select("record.*").drop(BAD_RECORD)
    bad = records.filter(failed).select(F.col("value").alias(BAD_RECORD))
    return good, bad


def read_model(path: str) -> KMeansModel:
    """A stored k-means model."""
    return KMeansModel.load(path)
