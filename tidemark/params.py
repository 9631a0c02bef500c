"""Default parameters, table schemas, and the checks made on parameters."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

# Default cohort ranges, retention days, ratios, event modes and
# table columns. They define the data model and the default report.

COHORT_RANGES = (
    ("2019-10-11", "2020-04-10"),
    ("2020-04-11", "2020-10-10"),
    ("2020-10-11", "2021-04-10"),
    ("2021-04-11", "2021-10-10"),
    ("2021-10-11", "2022-04-10"),
    ("2022-04-11", "2022-10-10"),
    ("2022-10-11", "2023-04-10"),
    ("2023-04-11", "2023-10-10"),
)

RETENTION_DAYS = (0, 1, 3, 7, 14, 28, 56)
RATIOS = ((1, 0), (3, 0), (7, 0), (14, 0), (28, 0), (56, 0))
ANALYTICAL_RATIOS = ((3, 1), (7, 3), (28, 7))

SOLO_MODES = ("soloShowdown",)
DUO_MODES = ("duoShowdown",)
TRIO_MODES = ("gemGrab", "brawlBall", "bounty", "heist", "hotZone", "knockout")
SPECIAL_MODES = ("roboRumble", "bossFight", "lastStand", "bigGame")

BATTLE_LOG_DDL = """
    battleTime STRING,
    event_id BIGINT,
    event_mode STRING,
    event_map STRING,
    battle_mode STRING,
    battle_type STRING,
    battle_result STRING,
    battle_duration BIGINT,
    battle_trophyChange BIGINT,
    battle_starPlayer_tag STRING,
    battle_starPlayer_name STRING,
    battle_starPlayer_brawler_id BIGINT,
    battle_starPlayer_brawler_name STRING,
    battle_starPlayer_brawler_power BIGINT,
    battle_starPlayer_brawler_trophies BIGINT,
    battle_teams STRING,
    battle_rank BIGINT,
    battle_players STRING,
    player_id STRING,
    battle_starPlayer STRING,
    battle_bigBrawler_tag STRING,
    battle_bigBrawler_name STRING,
    battle_bigBrawler_brawler_id BIGINT,
    battle_bigBrawler_brawler_name STRING,
    battle_bigBrawler_brawler_power BIGINT,
    battle_bigBrawler_brawler_trophies BIGINT,
    battle_level_name STRING,
    battle_level_id BIGINT
"""

PROFILE_DDL = """
    player_id STRING,
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
    brawlers STRING,
    icon_id BIGINT,
    club_tag STRING,
    club_name STRING
"""

PROFILE_DROPPED = (
    "name",
    "nameColor",
    "isQualifiedFromChampionshipChallenge",
    "brawlers",
    "icon_id",
    "club_tag",
    "club_name",
    "bestTimeAsBigBrawler",
    "highestPowerPlayPoints",
)

STANDARD_COLUMNS = (
    "battlelog_id",
    "cohort",
    "battleTime",
    "player_id",
    "event_id",
    "event_mode",
    "event_map",
    "is_starPlayer",
    "battle_type",
    "battle_result",
    "battle_rank",
    "battle_duration",
    "battle_trophyChange",
    "battle_level_name",
)

BOSS_COLUMNS = ("battle_bigBrawler_tag", "battle_bigBrawler_brawler_name")


@dataclass(frozen=True)
class CohortParams:
    """How raw logs are cut into cohorts.

    ``closed`` says which range ends belong to a cohort: ``neither`` (default),
    ``left``, ``right`` or ``both``. ``bad_time`` is ``raise`` or ``null``. Roster texts
    become arrays of JSON texts, or with ``typed_rosters`` arrays of tag and brawler name,
    which the roster tables then read without parsing again.
    """

    ranges: Sequence[tuple[str, str]] = COHORT_RANGES
    closed: str = "neither"
    exclude_missing_events: bool = True
    bad_time: str = "raise"
    typed_rosters: bool = False

    def __post_init__(self):
        one_of("closed", self.closed, ("neither", "left", "right", "both"))
        one_of("bad_time", self.bad_time, ("raise", "null"))


@dataclass(frozen=True)
class FamilyParams:
    """Event modes per family; an empty tuple switches a family off."""

    solo: Sequence[str] = SOLO_MODES
    duo: Sequence[str] = DUO_MODES
    trio: Sequence[str] = TRIO_MODES
    special: Sequence[str] = SPECIAL_MODES
    standard_columns: Sequence[str] = STANDARD_COLUMNS
    keep_empty: bool = False


@dataclass(frozen=True)
class ActivityParams:
    """How retention is measured.

    ``frequency``: ``daily``, ``weekly`` or ``monthly``; anything else is daily.
    ``day_index``: ``calendar`` counts days, ``observed`` counts the days on which
    the cohort was seen at all. ``mode``: ``rolling`` (active on day d or later)
    or ``exact``. ``first_log_scope``: ``global`` or ``cohort``.
    """

    frequency: str | None = "daily"
    days: Sequence[int] = RETENTION_DAYS
    day_index: str = "calendar"
    mode: str = "rolling"
    first_log_scope: str = "global"

    def __post_init__(self):
        one_of("day_index", self.day_index, ("calendar", "observed"))
        one_of("mode", self.mode, ("rolling", "exact"))
        one_of("first_log_scope", self.first_log_scope, ("global", "cohort"))


@dataclass(frozen=True)
class RatioParams:
    """Ratios (numerator day, denominator day) of the report."""

    ratios: Sequence[tuple[int, int]] = RATIOS
    analytical_ratios: Sequence[tuple[int, int]] | None = ANALYTICAL_RATIOS


@dataclass(frozen=True)
class ClusterParams:
    """Feature selection and the k-means grid: k runs over 2 .. max_n_cluster - 1, and each
    fit keeps the best of ``n_init`` starts. ``folds`` are dealt by a ``hash`` of the key, or
    are ``contiguous`` in its order."""

    top_features: int = 4
    random_state: int = 42
    n_init: int = 10
    max_n_cluster: int = 13
    starting_point_method: Sequence[str] = ("k-means++",)
    max_iter: Sequence[int] = (200,)
    distortion_tol: Sequence[float] = (1e-4,)
    cross_validations: int = 5
    metric: str = "inertia"
    parallelism: int = 4
    folds: str = "hash"

    def __post_init__(self):
        one_of("folds", self.folds, ("hash", "contiguous"))
        one_of("metric", self.metric, ("inertia", "silhouette"))


def one_of(name: str, value: str, allowed: Iterable[str]) -> None:
    """Raise unless ``value`` is one of ``allowed``."""
    if value not in tuple(allowed):
        raise ValueError(f"{name} must be one of {tuple(allowed)}, not {value!r}")


def require_columns(present: Iterable[str], needed: Iterable[str]) -> None:
    """Raise when a needed column is missing."""
    missing = [c for c in needed if c not in set(present)]
    if missing:
        raise ValueError(f"missing column(s): {', '.join(missing)}")


def retention_days_of(columns: Iterable[str]) -> list[int]:
    """Days d for which a table holds a ``D{d}R`` column, in column order."""
    found = (re.fullmatch(r"D(\d+)R", c) for c in columns)
    return [int(m.group(1)) for m in found if m]


def check_ratio_days(
    ratios: Iterable[tuple[int, int]], days_available: Iterable[int]
) -> None:
    """Raise when a ratio needs a day that was not extracted."""
    days = set(days_available)
    for num, den in ratios:
        absent = [d for d in (num, den) if d not in days]
        if absent:
            raise ValueError(
                f"ratio ({num}, {den}) needs retention day(s) {absent}; "
                f"extracted days are {sorted(days)}"
            )
