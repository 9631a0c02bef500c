"""Team rosters and JSON expressions."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from tidemark.functions.nested import (
    element,
    json_fragments,
    json_map,
    json_maps,
    map_value,
    prefix,
)
from tidemark.operators.cohorts import cohort_filter
from tidemark.operators.rosters import (
    BRAWLERS,
    FAMILY,
    PLAYERS,
    TEAM_SIZES,
    duo_roster,
    event_rosters,
    solo_roster,
    special_roster,
    split_event_families,
    trio_roster,
)
from tidemark.operators.shape import union_by_position
from tidemark.params import CohortParams, FamilyParams
from tidemark.workload.retention import RAW_SQL, player_json_sql, ranges_sql
from tidemark.workload.views import EVENT_RANGES, FAMILIES, raw_logs, table

KEYS = ("player_id", "battleTime", "event_mode", "battle_trophyChange")


def _as_text(rows):
    """Collections as JSON text."""
    return rows.withColumns({c: F.to_json(c) for c in (PLAYERS, BRAWLERS)})


def _roster(build):
    def query(spark, d):
        return _as_text(build(raw_logs(spark, d), KEYS))

    return query


def _kept_empty(spark, d):
    return _as_text(solo_roster(raw_logs(spark, d), KEYS, keep_empty=True))


_FAMILY_COLUMNS = ("cohort", "battleTime", "player_id", "event_mode", "is_starPlayer")


def _cohort_logs(spark, d, typed=False):
    params = CohortParams(ranges=EVENT_RANGES, typed_rosters=typed)
    return cohort_filter(raw_logs(spark, d), params)


def _families(spark, d, typed=False):
    """All families from one pass; collections of families without teams as plain lists."""
    rosters = event_rosters(_cohort_logs(spark, d, typed), FAMILIES)
    in_teams = F.col(FAMILY).isin(list(TEAM_SIZES))
    texts = {
        c: F.when(in_teams, F.to_json(c)).otherwise(F.to_json(F.get(c, 0)))
        for c in (PLAYERS, BRAWLERS)
    }
    return rosters.select(FAMILY, *_FAMILY_COLUMNS, *[t.alias(c) for c, t in texts.items()])


def _family_tables(spark, d):
    """The families from their stored folders."""
    tables = split_event_families(_cohort_logs(spark, d), FAMILIES)
    return union_by_position(
        [
            _as_text(table).select(
                F.lit(name).alias(FAMILY), *_FAMILY_COLUMNS, PLAYERS, BRAWLERS
            )
            for name, table in tables.items()
        ]
    )


def _disabled_family(spark, d):
    rosters = event_rosters(_cohort_logs(spark, d), FamilyParams(duo=()))
    counts = rosters.groupBy(FAMILY).agg(F.count("*").alias("n_rows"))
    names = spark.createDataFrame([(n,) for n in ("solo", "duo", "trio", "special")], "family string")
    # Four names, so broadcast.
    joined = counts.join(F.broadcast(names), FAMILY, "right")
    return joined.select(FAMILY, F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"))


def _json_map_extract(spark, d):
    events = table(spark, d, "events")
    values = json_map("props")
    return events.select("event_id", map_value(values, "k").alias("k"), map_value(values, "none").alias("none"))


def _json_lists(spark, d):
    logs = raw_logs(spark, d).select("battleTime", "player_id", "battle_players")
    maps = json_maps("battle_players")
    fragments = json_fragments("battle_players")
    return logs.select(
        "battleTime",
        "player_id",
        F.size(fragments).alias("n_players"),
        element(fragments, 0).alias("first_player"),
        map_value(element(maps, 1), "tag").alias("second_tag"),
        map_value(element(maps, 1), "brawler").alias("second_brawler"),
        F.array_join(F.transform(prefix(maps, 2), lambda m: m["tag"]), "|").alias(
            "first_tags"
        ),
    )


# ------------------------------------------------------------------------------- SQL

_KEYS_SQL = (
    "player_id, battle_time AS battleTime, event_mode, "
    'trophies AS "battle_trophyChange"'
)
_TAGS = "[player_id, '#' || k, '#' || (user_id + k)]"
_NAMES = "[upper(event_type), 'K' || k, 'THIRD']"


def _text(expression: str, name: str) -> str:
    return f"CAST(to_json({expression}) AS VARCHAR) AS {name}"


def _solo_columns() -> str:
    return f"{_text(f'({_TAGS})[1:size]', PLAYERS)}, {_text(f'({_NAMES})[1:size]', BRAWLERS)}"


def _team_columns(team_size: int) -> str:
    def team(values: list[str], length: str) -> str:
        members = [
            f"CASE WHEN {length} > {i} THEN {values[i]} END"
            if i < len(values)
            else "NULL"
            for i in range(team_size)
        ]
        return "[" + ", ".join(members) + "]"

    tags = ["player_id", "'#' || k", "'#' || (user_id + k)"]
    names = ["upper(event_type)", "'K' || k", "'THIRD'"]
    both = [
        f"[{team(v, '(size + 1)')}, {team([v[2], v[0]], 'size')}]" for v in (tags, names)
    ]
    return f"{_text(both[0], PLAYERS)}, {_text(both[1], BRAWLERS)}"


def _roster_sql(columns: str, where: str, more: str = "") -> str:
    return f"WITH {RAW_SQL} SELECT {_KEYS_SQL}{more}, {columns} FROM raw WHERE {where}"


_BOSS_SQL = (
    ", '#' || size AS \"battle_bigBrawler_tag\", "
    'upper(event_mode) AS "battle_bigBrawler_brawler_name"'
)
_HAS_PLAYERS = "k < 80 AND size > 0"
_STAR_SQL = 'CAST(CASE WHEN star = player_id THEN 1 ELSE 0 END AS INT) AS "is_starPlayer"'


def _families_sql() -> str:
    parts = {
        "solo": (_solo_columns(), "soloShowdown", _HAS_PLAYERS),
        "duo": (_team_columns(2), "duoShowdown", "k < 80"),
        "trio": (_team_columns(3), "gemGrab", "k < 80"),
        "special": (_solo_columns(), "bossFight", _HAS_PLAYERS),
    }
    selects = [
        f"""SELECT '{name}' AS family, CAST(cohort AS INT) AS cohort,
                   CAST(ts AS DATE) AS battleTime, player_id, event_mode, {_STAR_SQL},
                   {columns}
            FROM logs WHERE event_mode = '{mode}' AND {where}"""
        for name, (columns, mode, where) in parts.items()
    ]
    return f"""WITH {RAW_SQL}, {ranges_sql(EVENT_RANGES)},
        logs AS (
            SELECT * FROM raw
            JOIN ranges ON CAST(ts AS DATE) > lo AND CAST(ts AS DATE) < hi
            WHERE event_id <> 0
        ) {" UNION ALL ".join(selects)}"""


QUERIES = {
    "solo_roster": _roster(solo_roster),
    "solo_roster_keep_empty": _kept_empty,
    "duo_roster": _roster(duo_roster),
    "trio_roster": _roster(trio_roster),
    "special_roster": _roster(special_roster),
    "event_families": _families,
    "event_families_typed": partial(_families, typed=True),
    "event_family_tables": _family_tables,
    "disabled_family": _disabled_family,
    "json_map_extract": _json_map_extract,
    "json_lists": _json_lists,
}

ORACLES = {
    "solo_roster": _roster_sql(_solo_columns(), _HAS_PLAYERS),
    "solo_roster_keep_empty": f"""WITH {RAW_SQL} SELECT {_KEYS_SQL},
        CASE WHEN k < 80 THEN CAST(to_json(({_TAGS})[1:size]) AS VARCHAR) END
            AS {PLAYERS},
        CASE WHEN k < 80 THEN CAST(to_json(({_NAMES})[1:size]) AS VARCHAR) END
            AS {BRAWLERS}
        FROM raw""",
    "duo_roster": _roster_sql(_team_columns(2), "k < 80"),
    "trio_roster": _roster_sql(_team_columns(3), "k < 80"),
    "special_roster": _roster_sql(_solo_columns(), _HAS_PLAYERS, _BOSS_SQL),
    "event_families": _families_sql(),
    "event_families_typed": _families_sql(),
    "event_family_tables": _families_sql(),
    "disabled_family": f"""WITH {RAW_SQL}, {ranges_sql(EVENT_RANGES)}
        SELECT 'solo' AS family, count(*) AS n_rows FROM raw
        JOIN ranges ON CAST(ts AS DATE) > lo AND CAST(ts AS DATE) < hi
        WHERE event_id <> 0 AND event_mode = 'soloShowdown' AND {_HAS_PLAYERS}
        UNION ALL SELECT 'duo', 0
        UNION ALL SELECT 'trio', count(*) FROM raw
        JOIN ranges ON CAST(ts AS DATE) > lo AND CAST(ts AS DATE) < hi
        WHERE event_id <> 0 AND event_mode = 'gemGrab' AND k < 80
        UNION ALL SELECT 'special', count(*) FROM raw
        JOIN ranges ON CAST(ts AS DATE) > lo AND CAST(ts AS DATE) < hi
        WHERE event_id <> 0 AND event_mode = 'bossFight' AND {_HAS_PLAYERS}""",
    "json_map_extract": """SELECT event_id, json_extract_string(props, '$.k') AS k,
        CAST(NULL AS VARCHAR) AS "none" FROM events""",
    "json_lists": f"""WITH {RAW_SQL}
        SELECT battle_time AS battleTime, player_id,
               CASE WHEN k < 80 THEN size END AS n_players,
               CASE WHEN {_HAS_PLAYERS}
                    THEN {player_json_sql("player_id", "upper(event_type)")} END
                   AS first_player,
               CASE WHEN k < 80 AND size > 1 THEN '#' || k END AS second_tag,
               CASE WHEN k < 80 AND size > 1 THEN '{{"name":"K' || k || '"}}' END
                   AS second_brawler,
               CASE WHEN k < 80 THEN array_to_string(({_TAGS})[1:least(size, 2)], '|')
                   END AS first_tags
        FROM raw""",
}
