"""The long view: one row per player and match, from one scan of the matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rallybook.functions.scalars import to_id, to_int
from rallybook.schemas import BREAK_POINT_COLUMNS, FINAL


def id_column(df: DataFrame, name: str) -> Column:
    """The column as bigint; text is parsed, a column that is bigint already is left alone."""
    return F.col(name) if df.schema[name].dataType.typeName() == "long" else to_id(F.col(name))


def int_column(df: DataFrame, name: str) -> Column:
    return F.col(name) if df.schema[name].dataType.typeName() == "integer" else to_int(F.col(name))


def with_int_break_points(matches: DataFrame) -> DataFrame:
    """The four break-point columns as int, the rest as it is."""
    return matches.withColumns({c: int_column(matches, c) for c in BREAK_POINT_COLUMNS})


def sides(matches: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Each match as a winner row and a loser row, rows without a player id left out; columns of the
    match in `keep` are kept.

    It takes the place of a union of two selections, which scans its input twice. Every row is
    doubled first and its columns are picked then, so what a query does not use is pruned
    down to the scan; ids are parsed before, or the filter would parse them once more.
    """
    typed = matches.withColumns({c: id_column(matches, c) for c in ("winner_id", "loser_id")})
    doubled = typed.withColumn("won", F.explode(F.array(F.lit(True), F.lit(False))))

    def pick(of_winner: Column, of_loser: Column) -> Column:
        return F.when(F.col("won"), of_winner).otherwise(of_loser)

    return doubled.select(
        pick(F.col("winner_id"), F.col("loser_id")).alias("player_id"),
        "won",
        pick(F.col("winner_name"), F.col("loser_name")).alias("name"),
        "tourney_id",
        "tourney_level",
        "round",
        pick(int_column(matches, "w_bpSaved"), int_column(matches, "l_bpSaved")).alias("bp_saved"),
        pick(int_column(matches, "w_bpFaced"), int_column(matches, "l_bpFaced")).alias("bp_faced"),
        *keep,
    ).where(F.col("player_id").isNotNull())


def at_level(matches: DataFrame, level: str) -> DataFrame:
    return matches.where(F.col("tourney_level") == level)


def finals(matches: DataFrame) -> DataFrame:
    return matches.where(F.col("round") == FINAL)


def finals_rows(matches: DataFrame) -> DataFrame:
    """The distinct (player, tournament) pairs of the finals, both sides."""
    return sides(finals(matches)).select("player_id", "tourney_id").distinct()
