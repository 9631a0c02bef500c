"""JSON text and array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The parts of a roster entry that the reports read.
PLAYER_DDL = "struct<tag:string,brawler:struct<name:string>>"
PLAYERS_DDL = f"array<{PLAYER_DDL}>"
TEAMS_DDL = f"array<{PLAYERS_DDL}>"


def json_fragments(text) -> Column:
    """A JSON array as an array of texts; nested values stay JSON text."""
    return F.from_json(text, "array<string>")


def json_map(text) -> Column:
    """A JSON object as a map of texts; nested values stay JSON text."""
    return F.from_json(text, "map<string,string>")


def json_maps(text) -> Column:
    """A JSON array of objects as an array of maps of texts."""
    return F.from_json(text, "array<map<string,string>>")


def element(values, index: int) -> Column:
    """Array element counted from 0; NULL when there is none."""
    return F.get(values, index)


def map_value(values, key: str) -> Column:
    """Map value by key; NULL when the key is absent."""
    return F.try_element_at(values, F.lit(key))


def parsed_once(expression: Column) -> Column:
    """A costly expression as a generator of one row.

    Selected like this, the value is computed once per row: later filters and projections
    read it, where the optimizer would otherwise copy the expression into each of them.
    """
    return F.explode_outer(F.array(expression))


def prefix(values, length: int) -> Column:
    """The first ``length`` elements of an array."""
    return F.slice(values, 1, length)


def without_nulls(values) -> Column:
    """An array with its NULL elements left out."""
    return F.filter(values, lambda v: v.isNotNull())
