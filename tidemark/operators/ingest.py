"""Raw tables out of payload documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.shape import apply_ddl, flatten
from tidemark.params import BATTLE_LOG_DDL, PROFILE_DDL


def battle_rows(payloads: DataFrame) -> DataFrame:
    """Battle payloads, one row per battle with the columns of the raw logs."""
    items = payloads.select("player_id", F.explode("items").alias("item"))
    flat = flatten(items.select("player_id", "item.*"))
    star = "battle_starPlayer"
    return apply_ddl(flat.withColumn(star, F.lit(None).cast("string")), BATTLE_LOG_DDL)


def profile_rows(payloads: DataFrame) -> DataFrame:
    """Profile payloads, one row per player with the columns of the raw profiles."""
    flat = flatten(payloads).withColumnRenamed("tag", "player_id")
    return apply_ddl(flat, PROFILE_DDL)
