"""Stand-ins for the engine's input tables, made row by row from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.nested import parsed_once
from tidemark.operators.cohorts import assign_cohorts, within_ranges
from tidemark.params import BATTLE_LOG_DDL, FamilyParams

# Cohort ranges with open ends. The event ranges hold every day once; the first two order
# ranges overlap.
EVENT_RANGES = (("2023-12-31", "2024-01-16"), ("2024-01-15", "2024-01-31"))
ORDER_RANGES = (
    ("1994-12-31", "1997-06-15"),
    ("1997-03-01", "1999-12-31"),
    ("1999-12-30", "2001-12-31"),
)
EVENT_DAYS = (0, 1, 3, 7, 14, 28)

# Event types of the test table, read as event modes.
MODES = {
    "click": "soloShowdown",
    "view": "gemGrab",
    "purchase": "duoShowdown",
    "signup": "bossFight",
    "error": "friendly",
}
FAMILIES = FamilyParams()

# Profile features of a customer.
FEATURES = (
    "balance",
    "n_orders",
    "spend",
    "top_order",
    "mean_order",
    "active_months",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cohorts(logs: DataFrame, ranges) -> DataFrame:
    inside = within_ranges(logs, "stamp", ranges)
    days = inside.withColumn("battleTime", F.col("stamp").cast("date")).drop("stamp")
    return assign_cohorts(days, "battleTime", ranges)


def event_cohorts(
    spark: SparkSession, sf_dir: str, event_type: str | None = None
) -> DataFrame:
    """(player_id, battleTime, cohort) of the events, of one type if given."""
    events = table(spark, sf_dir, "events")
    if event_type:
        events = events.filter(F.col("event_type") == event_type)
    return _cohorts(
        events.select(F.col("user_id").alias("player_id"), F.col("ts").alias("stamp")),
        EVENT_RANGES,
    )


def order_cohorts(
    spark: SparkSession, sf_dir: str, where: str | None = None
) -> DataFrame:
    """(player_id, battleTime, cohort) of the orders, of some of them if a condition is given."""
    orders = table(spark, sf_dir, "orders")
    if where:
        orders = orders.filter(where)
    return _cohorts(
        orders.select(
            F.col("o_custkey").alias("player_id"), F.col("o_orderdate").alias("stamp")
        ),
        ORDER_RANGES,
    )


def _tag(number: Column) -> Column:
    return F.concat(F.lit("#"), number.cast("string"))


def _player(tag: Column, name: Column) -> Column:
    return F.struct(tag.alias("tag"), F.struct(name.alias("name")).alias("brawler"))


def nested_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as battle records with nested rosters, under the names of the raw logs.

    ``k`` in ``props`` gives the star player, and the size of the rosters: 0 to 3 players,
    teams of 0 to 4. Errors have no event id; from k = 90 on the id is NULL, and so are
    the rosters from k = 80 on.
    """
    events = table(spark, sf_dir, "events").select(
        "*", parsed_once(F.from_json("props", "k INT")["k"]).alias("k")
    )
    user, kind, k = F.col("user_id"), F.col("event_type"), F.col("k")
    size = F.floor(k / 20).cast("int")
    one = _player(_tag(user), F.upper(kind))
    two = _player(_tag(k), F.concat(F.lit("K"), k.cast("string")))
    three = _player(_tag(user + k), F.lit("THIRD"))
    four = _player(_tag(user + 1000), F.lit("FOURTH"))
    mode = F.lit(None).cast("string")
    for event_type, name in MODES.items():
        mode = F.when(kind == event_type, name).otherwise(mode)
    columns = {
        "battleTime": F.date_format("ts", "yyyyMMdd'T'HHmmss.SSS'Z'"),
        "event_id": F.when(kind == "error", 0).when(k < 90, F.col("event_id") + 1),
        "event_mode": mode,
        "event_map": F.concat(F.lit("map "), size.cast("string")),
        "battle_trophyChange": F.floor("value"),
        "battle_starPlayer_tag": F.when(k >= 10, _tag(k)),
        "battle_players": F.when(
            k < 80, F.slice(F.array(one, two, three), F.lit(1), size)
        ),
        "battle_teams": F.when(
            k < 80,
            F.array(
                F.slice(F.array(one, two, three, four), F.lit(1), size + 1),
                F.slice(F.array(three, one), F.lit(1), size),
            ),
        ),
        "player_id": _tag(user),
        "battle_bigBrawler_tag": _tag(size),
        "battle_bigBrawler_brawler_name": F.upper(mode),
    }
    return events.select(*[column.alias(name) for name, column in columns.items()])


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The battle records as raw logs: rosters as JSON text, all 28 columns."""
    logs = nested_logs(spark, sf_dir)
    known = {name: F.col(name) for name in logs.columns}
    for name in ("battle_players", "battle_teams"):
        known[name] = F.to_json(name)
    return logs.select(
        *[
            known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in T.StructType.fromDDL(BATTLE_LOG_DDL).fields
        ]
    )


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(player_id, segment, features): customers with sums over their orders. The orders
    are summed per customer before the join."""
    orders = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.count("*").alias("n_orders"),
            F.sum("o_totalprice").alias("spend"),
            F.max("o_totalprice").alias("top_order"),
            F.avg("o_totalprice").alias("mean_order"),
            F.count_distinct(F.trunc("o_orderdate", "month")).alias("active_months"),
        )
    )
    customers = table(spark, sf_dir, "customer")
    joined = customers.join(orders, "c_custkey", "left")
    return joined.select(
        F.col("c_custkey").alias("player_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in FEATURES[1:]],
    )


def cluster_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(player_id, cluster_labels) from customers and suppliers, so that some players
    have two labels; the label is NULL for a negative balance."""
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS player_id", "c_acctbal AS balance", "c_nationkey AS nation"
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS player_id", "s_acctbal AS balance", "s_nationkey AS nation"
    )
    return customers.union(suppliers).select(
        "player_id",
        F.when(F.col("balance") >= 0, F.pmod("nation", F.lit(4)).cast("double")).alias(
            "cluster_labels"
        ),
    )
