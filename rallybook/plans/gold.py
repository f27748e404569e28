"""Silver to gold: statistics per player."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rallybook.operators.joins import lookup_join
from rallybook.operators.metrics import join_break_points, join_win_loss, with_finals_rates
from rallybook.operators.rollup import (
    CAREER_COLUMNS,
    career_figures,
    career_statistics,
    tournament_rollup,
)
from rallybook.operators.sides import sides

COUNTS = (
    "matches_lost",
    "matches_won",
    "matches_played",
    "finals_played",
    "finals_won",
    "tournaments_played",
)


def player_statistics_from(
    players: DataFrame, rollup: DataFrame, zero_fill: bool = False
) -> DataFrame:
    """Every player with the career figures that follow from a rollup by tournament."""
    figures = career_statistics(rollup, zero_fill)
    rows = lookup_join(players, figures, ["player_id"], ["full_name"])
    return rows.fillna(0, list(COUNTS)) if zero_fill else rows


def player_statistics(
    players: DataFrame, matches: DataFrame, zero_fill: bool = False
) -> DataFrame:
    """Every silver player with all career figures, from one scan of the matches.

    Players without a match, and by default without a win, loss or final, have NULL there;
    `zero_fill` gives them counts of 0.
    """
    rollup = tournament_rollup(sides(matches))
    return player_statistics_from(players, rollup, zero_fill)


def join_player_statistics(players: DataFrame, rollup: DataFrame) -> DataFrame:
    """The same table put together from single figures. They are joined on one row per player, so the
    rollup should be a stored table that all of them read."""
    part = career_figures(rollup)
    figures = players
    for table in (
        join_win_loss(part["losses"], part["wins"]),
        join_break_points(part["bp_lost"], part["bp_won"]),
        part["finals_played"],
        part["finals_won"],
        part["tournaments_played"],
    ):
        figures = lookup_join(figures, table, ["player_id"], ["full_name"])
    return with_finals_rates(figures).select(
        *[F.col(c) for c in players.columns], *[F.col(c) for c in CAREER_COLUMNS]
    )
