"""Bronze to silver: types, names and the year."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rallybook.functions.scalars import parse_yyyymmdd
from rallybook.operators.names import (
    correct_names,
    fill_names,
    repair_names,
    with_full_name,
)
from rallybook.operators.sides import id_column


def silver_players(players: DataFrame) -> DataFrame:
    """Named players with typed id and birth date, a country and a full name, no duplicates.

    Columns that are not listed here pass through.
    """
    named = players.drop("wikidata_id").where(
        F.col("name_first").isNotNull() & F.col("name_last").isNotNull()
    )
    typed = named.withColumns(
        {
            "player_id": id_column(named, "player_id"),
            "dob": parse_yyyymmdd(F.col("dob")),
        }
    ).withColumnRenamed("ioc", "country")
    return with_full_name(typed).dropDuplicates()


def with_typed_ids(matches: DataFrame) -> DataFrame:
    return matches.withColumns({c: id_column(matches, c) for c in ("winner_id", "loser_id")})


def silver_matches(matches: DataFrame, players: DataFrame) -> DataFrame:
    """Matches with typed ids and names spelled as in the silver players.

    No row is lost or repeated, also when an id is listed under several names.
    """
    return repair_names(with_typed_ids(matches), players)


def silver_matches_by(matches: DataFrame, corrections: DataFrame) -> DataFrame:
    """The same from a table of name corrections instead of the players."""
    return correct_names(with_typed_ids(matches), corrections)


def backfill_names(players: DataFrame, matches: DataFrame) -> DataFrame:
    """Silver players after filling missing names from the matches."""
    return silver_players(fill_names(players, matches))
