"""Sources, sinks and record shaping. Queries that go through a file write the table to
the session's shared folder first."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.functions.names import names_like, underscored
from tidemark.operators.clusters import with_vector
from tidemark.operators.ingest import battle_rows, profile_rows
from tidemark.operators.shape import (
    apply_ddl,
    flatten,
    head_of_list,
    require_rows,
    union_by_name,
    union_by_position,
    with_key,
)
from tidemark.operators.retention import ratio_register, user_activity
from tidemark.params import BATTLE_LOG_DDL, ActivityParams, RatioParams, require_columns
from tidemark.sources.files import file_names, replace_file
from tidemark.sources.landing import land, read_landed, store_payloads
from tidemark.sources.layout import shared_folder, table_path
from tidemark.sources.readers import (
    BATTLE_PAYLOAD_DDL,
    PROFILE_PAYLOAD_DDL,
    read_csv,
    read_id_list,
    read_model,
    read_parquet,
    read_payloads,
    split_id_list,
)
from tidemark.sources.versions import (
    append_version,
    read_version,
    version_history,
    versions,
)
from tidemark.sources.writers import write_csv, write_model, write_parquet, write_record
from tidemark.workload import clusters
from tidemark.workload.retention import EVENT_LOGS, RAW_SQL, player_json_sql
from tidemark.workload.views import EVENT_RANGES, event_cohorts, nested_logs, table


def _tag_lists(spark, d):
    # Customer names and segments as comma-separated lists, one per row.
    lists = table(spark, d, "customer").select(
        "c_custkey",
        F.concat_ws(",", "c_name", "c_mktsegment", F.lit(" x ")).alias("tags"),
    )
    return split_id_list(lists, "tags", ["c_custkey"])


def _id_list_file(spark, d):
    path = shared_folder(spark)
    names = table(spark, d, "customer").select("c_name")
    names.write.option("lineSep", ",").text(path)
    return read_id_list(spark, path).select("tag")


def _tag_list_sample(spark, d):
    # The first 25 items when all lists are read as one.
    place = (F.col("c_custkey") * 3 + F.col("pos")).alias("pos")
    return head_of_list(_tag_lists(spark, d).select(place, "tag"), 25)


def _csv_round_trip(spark, d):
    path = shared_folder(spark)
    customers = table(spark, d, "customer").withColumn(
        "note", F.concat(F.lit('said "hi", '), "c_mktsegment", F.lit("\nbye"))
    )
    write_csv(customers, path)
    return read_csv(
        spark,
        path,
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
        "c_mktsegment STRING, note STRING",
        multi_line=True,
    )


def _csv_inferred(spark, d):
    path = shared_folder(spark)
    write_csv(table(spark, d, "supplier"), path)
    return read_csv(spark, path).withColumn("s_suppkey", F.col("s_suppkey").cast("long"))


def _parquet_partitioned(spark, d):
    path = shared_folder(spark)
    write_parquet(event_cohorts(spark, d), path, ["cohort"])
    return read_parquet(spark, path).filter("cohort = 2").select("player_id", "battleTime")


def _record_sink(spark, d):
    path = table_path(shared_folder(spark), "metrics")
    totals = table(spark, d, "orders").agg(
        F.count("*").alias("n_orders"), F.max("o_totalprice").alias("top_order")
    )
    write_record(totals, path)
    return spark.read.schema("n_orders BIGINT, top_order DOUBLE").json(path)


def _versioned_table(spark, d):
    path = shared_folder(spark)
    customers = table(spark, d, "customer").select("c_custkey", "c_name")
    append_version(customers, path, "2024-01-01T00.00.00.000Z")
    append_version(
        customers.withColumn("c_name", F.lower("c_name")),
        path,
        "2024-01-02T00.00.00.000Z",
    )
    return read_version(spark, path)


def _model_round_trip(spark, d):
    path = shared_folder(spark)
    rows, names, model = clusters.fitted(spark, d)
    write_model(model, path)
    before = model.transform(with_vector(rows, names)).withColumnRenamed(
        "cluster_labels", "label_before"
    )
    return (
        read_model(path)
        .transform(before)
        .select(
            "player_id",
            (F.col("cluster_labels") == F.col("label_before")).alias("same_label"),
        )
    )


def _version_history(spark, d):
    """Versions that were written, replaced, left empty, or not committed."""
    path = shared_folder(spark)
    customers = table(spark, d, "customer").select("c_custkey", "c_name")
    append_version(customers, path, "2024-01-01")
    append_version(customers.limit(0), path, "2024-01-03")
    append_version(customers.filter("c_custkey % 2 = 0"), path, "2024-01-02")
    # A repeat that has nothing to write any more, and a write that failed before its commit.
    append_version(customers.limit(0), path, "2024-01-01")
    write_parquet(customers, f"{path}/data/unfinished")
    names = versions(spark, path)
    rows = [
        read_version(spark, path, v).groupBy().agg(
            F.lit(v).alias("version"), F.count("c_custkey").alias("n_read")
        )
        for v in names
    ]
    return version_history(spark, path).select("version", "n_rows").join(
        union_by_position(rows), "version"
    )


def _event_documents(spark, d):
    """Each event as one payload document with one item: (value, event_id, user_id)."""
    logs = nested_logs(spark, d)
    item = F.struct(
        F.col("battleTime"),
        F.struct(
            F.col("event_id").alias("id"),
            F.col("event_mode").alias("mode"),
            F.col("event_map").alias("map"),
        ).alias("event"),
        F.struct(
            F.col("battle_trophyChange").alias("trophyChange"),
            F.struct(F.col("battle_starPlayer_tag").alias("tag")).alias("starPlayer"),
            F.col("battle_players").alias("players"),
            F.col("battle_teams").alias("teams"),
        ).alias("battle"),
    )
    document = F.to_json(F.struct("player_id", F.array(item).alias("items")))
    return logs.select(document.alias("value"), "player_id", "battleTime")


def _broken_documents(spark, d):
    """A document that does not parse for each supplier."""
    return table(spark, d, "supplier").select(
        F.concat(F.lit('{"player_id": '), "s_name").alias("value")
    )


def _battle_documents(spark, d):
    """Event documents and broken ones, written as text."""
    path = shared_folder(spark)
    _event_documents(spark, d).select("value").union(_broken_documents(spark, d)).write.text(path)
    return path


def _battle_payloads(spark, d):
    return read_payloads(spark, _battle_documents(spark, d), BATTLE_PAYLOAD_DDL)


def _stored_payloads(spark, d):
    return store_payloads(
        spark, _battle_documents(spark, d), BATTLE_PAYLOAD_DDL, shared_folder(spark)
    )


def _payload_counts(spark, d):
    """What the write counted, beside the rows of both sides of the one stored parse."""
    found = _stored_payloads(spark, d)
    sides = found.good.select(F.lit(0).alias("side")).union(found.bad.select(F.lit(1)))
    counts = [F.lit(n).cast("long").alias(f"observed_{c}") for c, n in sorted(found.counts.items())]
    return sides.agg(
        F.count_if(F.col("side") == 0).alias("good"), F.count_if(F.col("side") == 1).alias("bad"), *counts
    )


def _landed(spark, d):
    """Three landings of the event documents: a third of the users, a file that changed and
    new ones, and the rest."""
    source, target, spare = (shared_folder(spark) for _ in range(3))
    documents = _event_documents(spark, d)
    part = F.pmod(F.crc32("player_id"), F.lit(4))

    def put(rows, name):
        # One file of a fixed name, as a fetch of some players leaves it.
        draft = f"{spare}/{name}-{uuid.uuid4().hex}"
        rows.select("value").coalesce(1).write.text(draft)
        replace_file(spark, f"{draft}/{file_names(spark, draft, '.txt')[0]}", f"{source}/{name}.json")

    put(documents.filter(part == 0), "a")
    put(documents.filter((part == 1) & (F.col("battleTime") < "20240110")), "b")
    land(spark, source, target, BATTLE_PAYLOAD_DDL)
    put(documents.filter(part == 1), "b")
    put(documents.filter(part == 2), "c")
    land(spark, source, target, BATTLE_PAYLOAD_DDL)
    put(documents.filter(part == 3).unionByName(_broken_documents(spark, d), True), "d")
    land(spark, source, target, BATTLE_PAYLOAD_DDL)
    return read_landed(spark, target, BATTLE_PAYLOAD_DDL)


def _payload_landing(spark, d):
    good, bad = _landed(spark, d)
    rows = battle_rows(good).select("player_id", "battleTime", "event_mode")
    broken = bad.select(F.col("_bad_record").alias("player_id"), F.lit(None), F.lit(None))
    return rows.union(broken)


def _checks(spark, d):
    """Which of the checks raise, on whole tables and on what is missing from them."""
    orders = table(spark, d, "orders")
    activity = user_activity(event_cohorts(spark, d), ActivityParams(days=(0, 1, 7)))
    checks = {
        "rows": lambda: require_rows(orders, "orders"),
        "no rows": lambda: require_rows(orders.filter("o_orderkey < 0"), "orders"),
        "columns": lambda: require_columns(orders.columns, ["o_orderkey", "o_custkey"]),
        "no column": lambda: require_columns(orders.columns, ["o_orderkey", "c_custkey"]),
        "ratio days": lambda: ratio_register(activity, RatioParams(((1, 0), (7, 1)), None)),
        "no ratio day": lambda: ratio_register(activity, RatioParams(((28, 0),), None)),
    }

    def raised(check):
        try:
            check()
        except ValueError:
            return True
        return False

    found = [(name, raised(check)) for name, check in checks.items()]
    facts = spark.createDataFrame(found, "input string, raised boolean")
    n = orders.agg(F.count("*").alias("n_orders"))
    # One row of counts.
    return facts.join(F.broadcast(n))


def _stored_layout(spark, d):
    """Tables stored by name, each under its layer."""
    base = shared_folder(spark)
    stored = {
        "battle_logs": ("raw", table(spark, d, "events")),
        "cohort_logs": ("primary", event_cohorts(spark, d)),
        "profiles_scaled": ("model_input", table(spark, d, "customer")),
    }
    for name, (_, rows) in stored.items():
        write_parquet(rows, table_path(base, name))
    parts = [
        read_parquet(spark, f"{base}/{layer}/{name}").agg(
            F.lit(name).alias("name"), F.lit(layer).alias("layer"), F.count("*").alias("n_rows")
        )
        for name, (layer, _) in stored.items()
    ]
    return union_by_position(parts)


def _battle_ingest(spark, d):
    good, _ = _battle_payloads(spark, d)
    return battle_rows(good).select(
        "player_id",
        "battleTime",
        "event_id",
        "event_mode",
        "battle_trophyChange",
        "battle_starPlayer_tag",
        F.get_json_object("battle_players", "$[1].tag").alias("second_tag"),
    )


def _battle_ingest_columns(spark, d):
    """All columns of the raw logs, from the stored parse."""
    return battle_rows(_stored_payloads(spark, d).good)


def _bad_payloads(spark, d):
    _, bad = _battle_payloads(spark, d)
    return bad.select(F.col("_bad_record").alias("record"))


def _profile_ingest(spark, d):
    path = shared_folder(spark)
    customers = table(spark, d, "customer")
    document = F.to_json(
        F.struct(
            F.concat(F.lit("#"), "c_custkey").alias("tag"),
            F.col("c_name").alias("name"),
            F.col("c_custkey").alias("trophies"),
            F.col("c_acctbal").alias("highestPowerPlayPoints"),
            F.struct(F.col("c_nationkey").alias("id")).alias("icon"),
            F.struct(F.col("c_mktsegment").alias("name")).alias("club"),
        )
    )
    customers.select(document.alias("value")).write.text(path)
    good, _ = read_payloads(spark, path, PROFILE_PAYLOAD_DDL)
    return profile_rows(good).select(
        "player_id", "name", "trophies", "highestPowerPlayPoints", "icon_id", "club_name"
    )


def _schema_on_load(spark, d):
    texts = table(spark, d, "orders").select(
        *[
            F.col(c).cast("string").alias(c)
            for c in ("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")
        ]
    )
    return apply_ddl(
        texts, "o_orderdate DATE, o_orderkey BIGINT, o_totalprice DOUBLE"
    )


def _flatten_nested(spark, d):
    nations = table(spark, d, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"),
        F.struct("n_name", F.struct("n_regionkey").alias("region")).alias("nation"),
    )
    customers = table(spark, d, "customer").join(nations, "c_nationkey")
    nested = customers.select(
        F.struct("c_custkey", "c_name").alias("who"),
        "nation",
        F.array("c_nationkey", F.lit(7)).alias("codes"),
    )
    flat = flatten(nested)
    kept = names_like(flat, r"who_.*|nation_.*|codes")
    return with_key(flat.select(*kept), "#all", underscored("row.key"))


def _union_missing_columns(spark, d):
    suppliers = table(spark, d, "supplier").withColumnRenamed("s_nationkey", "nationkey")
    customers = table(spark, d, "customer").withColumnRenamed("c_nationkey", "nationkey")
    return union_by_name([suppliers, customers])


def _battle_columns_sql() -> str:
    players = [
        player_json_sql("player_id", "upper(event_type)"),
        player_json_sql("'#' || k", "'K' || k"),
        player_json_sql("'#' || (user_id + k)", "'THIRD'"),
        player_json_sql("'#' || (user_id + 1000)", "'FOURTH'"),
    ]

    def listed(members: list[str], length: str) -> str:
        return f"'[' || array_to_string(([{', '.join(members)}])[1:{length}], ',') || ']'"

    teams = f"'[' || {listed(players, 'size + 1')} || ',' || {listed([players[2], players[0]], 'size')} || ']'"
    known = {
        "battleTime": "battle_time",
        "event_id": "event_id",
        "event_mode": "event_mode",
        "event_map": "'map ' || size",
        "battle_trophyChange": "trophies",
        "battle_starPlayer_tag": "star",
        "battle_players": f"CASE WHEN k < 80 THEN {listed(players[:3], 'size')} END",
        "battle_teams": f"CASE WHEN k < 80 THEN {teams} END",
        "player_id": "player_id",
    }
    types = {"STRING": "VARCHAR", "BIGINT": "BIGINT"}
    fields = [field.split() for field in BATTLE_LOG_DDL.split(",")]
    return ", ".join(
        f'CAST({known.get(name, "NULL")} AS {types[kind]}) AS "{name}"' for name, kind in fields
    )


QUERIES = {
    "tag_lists": _tag_lists,
    "tag_list_sample": _tag_list_sample,
    "id_list_file": _id_list_file,
    "csv_round_trip": _csv_round_trip,
    "csv_inferred": _csv_inferred,
    "parquet_partitioned": _parquet_partitioned,
    "record_sink": _record_sink,
    "versioned_table": _versioned_table,
    "version_history": _version_history,
    "payload_counts": _payload_counts,
    "payload_landing": _payload_landing,
    "battle_ingest_columns": _battle_ingest_columns,
    "input_checks": _checks,
    "stored_layout": _stored_layout,
    "model_round_trip": _model_round_trip,
    "battle_ingest": _battle_ingest,
    "bad_payloads": _bad_payloads,
    "profile_ingest": _profile_ingest,
    "schema_on_load": _schema_on_load,
    "flatten_nested": _flatten_nested,
    "union_missing_columns": _union_missing_columns,
}

ORACLES = {
    "tag_lists": """SELECT c_custkey, CAST(pos - 1 AS INT) AS pos, tag FROM (
            SELECT c_custkey, unnest(tags) AS tag, generate_subscripts(tags, 1) AS pos
            FROM (SELECT c_custkey, [c_name, c_mktsegment, ' x '] AS tags FROM customer)
        )""",
    "tag_list_sample": """SELECT pos, tag FROM (
            SELECT c_custkey * 3 AS pos, c_name AS tag FROM customer
            UNION ALL SELECT c_custkey * 3 + 1, c_mktsegment FROM customer
            UNION ALL SELECT c_custkey * 3 + 2, ' x ' FROM customer
        ) ORDER BY pos LIMIT 25""",
    "id_list_file": "SELECT c_name AS tag FROM customer",
    "csv_round_trip": """SELECT *, 'said "hi", ' || c_mktsegment || chr(10) || 'bye' AS note
        FROM customer""",
    "csv_inferred": "SELECT * FROM supplier",
    "parquet_partitioned": f"""SELECT user_id AS player_id, CAST(ts AS DATE) AS battleTime
        FROM events WHERE CAST(ts AS DATE) > DATE '{EVENT_RANGES[1][0]}'
        AND CAST(ts AS DATE) < DATE '{EVENT_RANGES[1][1]}'""",
    "record_sink": """SELECT count(*) AS n_orders, max(o_totalprice) AS top_order
        FROM orders""",
    "versioned_table": """SELECT c_custkey, lower(c_name) AS c_name,
        '2024-01-02T00.00.00.000Z' AS version FROM customer""",
    "version_history": """SELECT '2024-01-01' AS version, 0::BIGINT AS n_rows, 0::BIGINT AS n_read
        UNION ALL SELECT '2024-01-02', count(*), count(*) FROM customer WHERE c_custkey % 2 = 0
        UNION ALL SELECT '2024-01-03', 0, 0""",
    "payload_counts": """SELECT (SELECT count(*) FROM events) AS good, count(*) AS bad,
        count(*) AS observed_bad, 0::BIGINT AS observed_missing_items,
        0::BIGINT AS observed_missing_player_id,
        (SELECT count(*) FROM events) + count(*) AS observed_rows FROM supplier""",
    "payload_landing": f"""WITH {RAW_SQL}
        SELECT player_id, battle_time AS battleTime, event_mode FROM raw
        UNION ALL SELECT '{{"player_id": ' || s_name, NULL, NULL FROM supplier""",
    "battle_ingest_columns": f"WITH {RAW_SQL} SELECT {_battle_columns_sql()} FROM raw",
    "input_checks": """SELECT input, raised, (SELECT count(*) FROM orders) AS n_orders
        FROM (VALUES ('rows', FALSE), ('no rows', TRUE), ('columns', FALSE),
                     ('no column', TRUE), ('ratio days', FALSE), ('no ratio day', TRUE))
            AS checks(input, raised)""",
    "stored_layout": f"""WITH {EVENT_LOGS}
        SELECT 'battle_logs' AS name, 'raw' AS layer, count(*) AS n_rows FROM events
        UNION ALL SELECT 'cohort_logs', 'primary', count(*) FROM logs
        UNION ALL SELECT 'profiles_scaled', 'model_input', count(*) FROM customer""",
    "model_round_trip": "SELECT c_custkey AS player_id, TRUE AS same_label FROM customer",
    "battle_ingest": f"""WITH {RAW_SQL}
        SELECT player_id, battle_time AS battleTime, event_id, event_mode,
               trophies AS "battle_trophyChange", star AS "battle_starPlayer_tag",
               CASE WHEN k < 80 AND size > 1 THEN '#' || k END AS second_tag
        FROM raw""",
    "bad_payloads": """SELECT '{"player_id": ' || s_name AS record FROM supplier""",
    "profile_ingest": """SELECT '#' || c_custkey AS player_id, c_name AS name,
        c_custkey AS trophies, c_acctbal AS "highestPowerPlayPoints",
        CAST(c_nationkey AS BIGINT) AS icon_id, c_mktsegment AS club_name
        FROM customer""",
    "schema_on_load": """SELECT CAST(o_orderdate AS DATE) AS o_orderdate, o_orderkey,
        o_totalprice FROM orders""",
    "flatten_nested": """SELECT c_custkey AS who_c_custkey, c_name AS who_c_name,
        n_name AS nation_n_name, n_regionkey AS nation_region_n_regionkey,
        '[' || c_nationkey || ',7]' AS codes, '#all' AS row_key
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "union_missing_columns": """SELECT * FROM (
            SELECT s_suppkey, s_name, s_nationkey AS nationkey, s_acctbal FROM supplier
        ) UNION ALL BY NAME SELECT * FROM (
            SELECT c_custkey, c_name, c_nationkey AS nationkey, c_acctbal, c_mktsegment
            FROM customer
        )""",
}
