import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.segments import (
    cluster_retention,
    label_activity,
    retention_chart,
)
from tidemark.params import RatioParams

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 2, 15)
PARAMS = RatioParams(ratios=((1, 0),), analytical_ratios=((1, 1),))


def activity(spark):
    return spark.createDataFrame(
        [
            (1, "a", D1, 1, 5, 1, 7),
            (2, "a", D1, 0, 0, 0, 0),
            (1, "b", D1, 1, 1, 0, 0),
            (1, "c", D2, 1, 1, 0, 0),
            (1, "nobody", D1, 1, 1, 1, 1),
        ],
        "cohort int, player_id string, first_log date, "
        "D0R int, D0_Sessions bigint, D1R int, D1_Sessions bigint",
    )


def labels(spark):
    return spark.createDataFrame(
        [("a", 1.0), ("a", 1.0), ("b", 1.0), ("c", 2.0), ("b", None), ("idle", 2.0)],
        "player_id string, cluster_labels double",
    )


def test_join_fans_out_and_keeps_unlabelled(spark):
    rows = label_activity(activity(spark), labels(spark))
    counts = {r[0]: r[1] for r in rows.groupBy("player_id").count().collect()}
    assert counts == {"a": 4, "b": 2, "c": 1, "nobody": 1}
    plain = label_activity(activity(spark), labels(spark), unique_labels=True)
    assert sorted(plain.collect(), key=str) == sorted(
        rows.select(*plain.columns).collect(), key=str
    )


def test_cluster_retention(spark):
    table = cluster_retention(activity(spark), labels(spark), PARAMS)
    assert table.columns == ["cluster_labels", "first_log", "D0R", "D1R", "D1/D1"]
    assert [tuple(r) for r in table.collect()] == [
        (1, D1, 1.0, 2 / 3, 1.0),
        (2, D2, 1.0, 0.0, 0.0),
    ]
    assert table.schema["cluster_labels"].dataType.simpleString() == "int"


def test_weights_equal_a_plain_join(spark):
    plain = (
        label_activity(activity(spark), labels(spark))
        .dropna(subset=["cluster_labels"])
        .groupBy("cluster_labels", "first_log")
        .agg((F.sum("D1R") / F.sum("D0R")).alias("r"))
    )
    expected = {(int(r[0]), r[1]): r[2] for r in plain.collect()}
    table = cluster_retention(activity(spark), labels(spark), PARAMS)
    got = {(r["cluster_labels"], r["first_log"]): r["D1R"] for r in table.collect()}
    assert got == expected


def test_unique_labels(spark):
    once = labels(spark).dropDuplicates(["player_id"]).dropna()
    weighted = cluster_retention(activity(spark), once, PARAMS).collect()
    assert cluster_retention(activity(spark), once, PARAMS, True).collect() == weighted


def test_no_analytical_ratios(spark):
    params = RatioParams(ratios=((1, 0),), analytical_ratios=None)
    table = cluster_retention(activity(spark), labels(spark), params)
    assert table.columns == ["cluster_labels", "first_log", "D0R", "D1R"]


def test_chart_keeps_the_last_days(spark):
    table = cluster_retention(activity(spark), labels(spark), PARAMS)
    assert [tuple(r) for r in retention_chart(table, 30).orderBy("metric").collect()] == [
        (2, D2, "D0R", 1.0),
        (2, D2, "D1R", 0.0),
    ]
    assert retention_chart(table, 45).count() == 4
    text = table.withColumn("first_log", F.col("first_log").cast("string"))
    assert retention_chart(text, 45).count() == 4
