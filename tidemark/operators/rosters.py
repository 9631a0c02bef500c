"""Team rosters out of nested battle records, without a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.nested import (
    PLAYER_DDL,
    PLAYERS_DDL,
    TEAMS_DDL,
    element,
    parsed_once,
    without_nulls,
)
from tidemark.params import BOSS_COLUMNS, STANDARD_COLUMNS, FamilyParams
from tidemark.sources.layout import shared_folder
from tidemark.sources.writers import write_parquet

PLAYERS = "players_collection"
BRAWLERS = "brawlers_collection"


def _typed(df: DataFrame, column: str, whole_ddl: str, part_ddl: str) -> Column:
    """A roster column as typed arrays; it may hold JSON text, an array of JSON texts,
    or typed arrays already. A column that does not exist is NULL."""
    if column not in df.columns:
        return F.lit(None).cast(whole_ddl)
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.StringType):
        return F.from_json(column, whole_ddl)
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StringType):
        return F.transform(column, lambda part: F.from_json(part, part_ddl))
    return F.col(column)


def _with_rosters(
    df: DataFrame,
    roster: Column,
    tags: Column,
    names: Column,
    columns: Sequence[str],
    keep_empty: bool,
) -> DataFrame:
    rows = df.select(*columns, parsed_once(roster).alias("_roster"))
    if not keep_empty:
        rows = rows.filter(F.size("_roster") > 0)
    return rows.select(*columns, tags.alias(PLAYERS), names.alias(BRAWLERS))


def _player_roster(
    df: DataFrame, columns: Sequence[str], keep_empty: bool
) -> DataFrame:
    roster = F.col("_roster")
    return _with_rosters(
        df,
        _typed(df, "battle_players", PLAYERS_DDL, PLAYER_DDL),
        without_nulls(F.transform(roster, lambda p: p["tag"])),
        without_nulls(F.transform(roster, lambda p: p["brawler"]["name"])),
        columns,
        keep_empty,
    )


def solo_roster(
    df: DataFrame,
    columns: Sequence[str] = STANDARD_COLUMNS,
    keep_empty: bool = False,
) -> DataFrame:
    """Tags and brawler names of all players of a battle, in their order; NULLs are
    left out. A battle without players is dropped unless ``keep_empty``."""
    return _player_roster(df, columns, keep_empty)


def special_roster(
    df: DataFrame,
    columns: Sequence[str] = STANDARD_COLUMNS,
    keep_empty: bool = False,
) -> DataFrame:
    """As :func:`solo_roster`, with the boss columns."""
    return _player_roster(df, (*columns, *BOSS_COLUMNS), keep_empty)


def team_roster(
    df: DataFrame,
    team_size: int,
    columns: Sequence[str] = STANDARD_COLUMNS,
    keep_empty: bool = False,
) -> DataFrame:
    """One list of tags and one of brawler names per team, in their order.

    A team always has ``team_size`` members: further players are cut and missing ones
    are NULL. A battle without teams is dropped unless ``keep_empty``.
    """
    roster = F.col("_roster")

    def members(team: Column, read) -> Column:
        return F.array(*[read(element(team, i)) for i in range(team_size)])

    return _with_rosters(
        df,
        _typed(df, "battle_teams", TEAMS_DDL, PLAYERS_DDL),
        F.transform(roster, lambda t: members(t, lambda p: p["tag"])),
        F.transform(roster, lambda t: members(t, lambda p: p["brawler"]["name"])),
        columns,
        keep_empty,
    )


def duo_roster(df: DataFrame, columns=STANDARD_COLUMNS, keep_empty=False) -> DataFrame:
    """Teams of two."""
    return team_roster(df, 2, columns, keep_empty)


def trio_roster(df: DataFrame, columns=STANDARD_COLUMNS, keep_empty=False) -> DataFrame:
    """Teams of three."""
    return team_roster(df, 3, columns, keep_empty)


# Players per team of the families that play in teams; the others are lists of players.
TEAM_SIZES = {"duo": 2, "trio": 3}
FAMILY = "family"


def _modes(params: FamilyParams) -> dict[str, Sequence[str]]:
    return {
        "solo": params.solo,
        "duo": params.duo,
        "trio": params.trio,
        "special": params.special,
    }


def families_of(mode: str | Column, params: FamilyParams = FamilyParams()) -> Column:
    """The families that a mode belongs to, as an array; NULL for a mode of none."""
    held: dict[str, list[str]] = {}
    for family, modes in _modes(params).items():
        for m in modes:
            held.setdefault(m, []).append(family)
    if not held:
        return F.lit(None).cast("array<string>")
    entries = [
        column
        for m, names in held.items()
        for column in (F.lit(m), F.array(*[F.lit(n) for n in dict.fromkeys(names)]))
    ]
    return F.try_element_at(F.create_map(*entries), F.col(mode) if isinstance(mode, str) else mode)


def event_rosters(logs: DataFrame, params: FamilyParams = FamilyParams()) -> DataFrame:
    """Rosters of all event families in one pass over the logs.

    ``family`` comes first, then the standard and boss columns, then the two collections, both
    as one list per team; a family without teams has its players as one team. Each row is
    parsed once, by the roster text that its family reads. A mode in several families gives
    a row to each; modes of none, and battles without a roster unless ``keep_empty``, vanish.
    """
    columns = list(dict.fromkeys((*params.standard_columns, *BOSS_COLUMNS)))
    family = F.explode(families_of("event_mode", params)).alias(FAMILY)
    rows = logs.select("*", family)
    in_teams = F.col(FAMILY).isin(list(TEAM_SIZES))
    teams = _typed(rows, "battle_teams", TEAMS_DDL, PLAYERS_DDL)
    players = _typed(rows, "battle_players", PLAYERS_DDL, PLAYER_DDL)
    alone = F.when(players.isNotNull(), F.array(players))
    roster = F.when(in_teams, _tags_and_names(teams, 2)).otherwise(_tags_and_names(alone, 2))
    rows = rows.select(FAMILY, *columns, parsed_once(roster).alias("_roster"))
    roster, in_teams = F.col("_roster"), F.col(FAMILY).isin(list(TEAM_SIZES))
    if not params.keep_empty:
        some = F.when(in_teams, F.size(roster)).otherwise(F.size(F.get(roster, 0)))
        rows = rows.filter(some > 0)

    def collection(read) -> Column:
        whole = F.transform(roster, lambda team: without_nulls(F.transform(team, read)))
        for name, size in TEAM_SIZES.items():
            sized = F.transform(
                roster, lambda team: F.array(*[read(element(team, i)) for i in range(size)])
            )
            whole = F.when(F.col(FAMILY) == name, sized).otherwise(whole)
        return whole

    return rows.select(
        FAMILY,
        *columns,
        collection(lambda p: p["tag"]).alias(PLAYERS),
        collection(lambda p: p["name"]).alias(BRAWLERS),
    )


def _tags_and_names(values: Column, depth: int) -> Column:
    """Nested lists of roster entries with the tag and the brawler's name only."""
    if depth:
        return F.transform(values, lambda v: _tags_and_names(v, depth - 1))
    return F.struct(values["tag"].alias("tag"), values["brawler"]["name"].alias("name"))


def family_table(
    rosters: DataFrame, family: str, params: FamilyParams = FamilyParams()
) -> DataFrame:
    """One family's table out of the rosters of all, as its own roster function gives it. On
    stored rosters only the folder of the family is read."""
    boss = BOSS_COLUMNS if family == "special" else ()
    collections = {c: F.col(c) for c in (PLAYERS, BRAWLERS)}
    if family not in TEAM_SIZES:
        collections = {c: F.get(c, 0) for c in collections}
    rows = rosters.filter(F.col(FAMILY) == family)
    return rows.select(
        *params.standard_columns, *boss, *[v.alias(c) for c, v in collections.items()]
    )


def write_event_rosters(
    logs: DataFrame, path: str, params: FamilyParams = FamilyParams()
) -> DataFrame:
    """Write the rosters of all families, a folder for each, in one pass; returns them read
    back. Folders of families that are switched off, or have no row, are missing."""
    rosters = event_rosters(logs, params)
    write_parquet(rosters, path, [FAMILY])
    return logs.sparkSession.read.schema(rosters.schema).parquet(path)


def split_event_families(
    logs: DataFrame, params: FamilyParams = FamilyParams(), path: str | None = None
) -> dict[str, DataFrame]:
    """Roster tables of the four event families, from one pass that stores them under
    ``path``, by default a shared folder. A family that is switched off gives an empty table
    with the columns it would have."""
    stored = write_event_rosters(logs, path or shared_folder(logs.sparkSession), params)
    return {name: family_table(stored, name, params) for name in _modes(params)}
