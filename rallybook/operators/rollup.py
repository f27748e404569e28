"""Partial counts per player and tournament, from which all gold figures follow."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rallybook.functions.scalars import percentage, zero_to_null
from rallybook.operators.metrics import with_finals_rates, with_mean_break_points, with_win_rate
from rallybook.schemas import FINAL

SUMS = (
    "won",
    "lost",
    "finals_won",
    "finals_lost",
    "won_bp_saved",
    "won_bp_faced",
    "lost_bp_saved",
    "lost_bp_faced",
)


def tournament_rollup(sides: DataFrame, by_level: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per player and tournament, and level or the columns `by` if asked for, with its
    match counts.

    The key is finer than the player, so the shuffle spreads a very active player, and with
    one row per tournament no later step needs a distinct count. Sums that a query does not
    use are pruned.
    """
    won, final = F.col("won"), F.col("round") == FINAL
    sums = [
        F.count_if(won).alias("won"),
        F.count_if(~won).alias("lost"),
        F.count_if(won & final).alias("finals_won"),
        F.count_if(~won & final).alias("finals_lost"),
    ]
    for side, outcome in (("won", won), ("lost", ~won)):
        for part in ("saved", "faced"):
            sums.append(F.sum(F.when(outcome, F.col(f"bp_{part}"))).alias(f"{side}_bp_{part}"))
    keys = ["player_id", "tourney_id"] + (["tourney_level"] if by_level else [])
    return sides.groupBy(*keys, *by).agg(*sums)


def added_up(rollup: DataFrame) -> DataFrame:
    """Rollups by level of parts of the matches, such as years, as one of all: every column is a sum."""
    keys = ("player_id", "tourney_id", "tourney_level")
    return rollup.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS])


def over_levels(rollup: DataFrame) -> DataFrame:
    """A rollup by level reduced to one row per player and tournament."""
    return rollup.groupBy("player_id", "tourney_id").agg(*[F.sum(c).alias(c) for c in SUMS])


def per_player(rollup: DataFrame, source: str, name: str) -> DataFrame:
    """Sum of one count per player, players without any left out."""
    return rollup.groupBy("player_id").agg(F.sum(source).alias(name)).where(F.col(name) > 0)


def break_points_from(rollup: DataFrame, outcome: str, name: str) -> DataFrame:
    """Break points saved in won or in lost matches, for players who have any of these."""
    saved, faced = F.sum(f"{outcome}_bp_saved"), F.sum(f"{outcome}_bp_faced")
    return (
        rollup.where(F.col(outcome) > 0)
        .groupBy("player_id")
        .agg(percentage(saved, faced).alias(name))
    )


def break_point_figures(rollup: DataFrame) -> dict[str, DataFrame]:
    """The two break-point figures, each a table of its own."""
    return {
        "bp_lost": break_points_from(rollup, "lost", "carrer_losses_bp_saved_%"),
        "bp_won": break_points_from(rollup, "won", "carrer_wins_bp_saved_%"),
    }


def career_figures(rollup: DataFrame) -> dict[str, DataFrame]:
    """Each career figure as a table of its own, from one row per player and tournament."""
    in_final = rollup.where(F.col("finals_won") + F.col("finals_lost") > 0)

    def tournaments(rows, name):
        return rows.groupBy("player_id").agg(F.count("tourney_id").alias(name))

    return {
        "losses": per_player(rollup, "lost", "matches_lost"),
        "wins": per_player(rollup, "won", "matches_won"),
        **break_point_figures(rollup),
        "finals_played": tournaments(in_final, "finals_played"),
        "finals_won": tournaments(rollup.where("finals_won > 0"), "finals_won"),
        "tournaments_played": tournaments(rollup, "tournaments_played"),
    }


def career_statistics(rollup: DataFrame, zero_fill: bool = False) -> DataFrame:
    """All career figures of a player from one row per player and tournament.

    Counts that are 0 become NULL, as joining separately counted figures would leave them, or
    stay 0 with `zero_fill`. Tournaments without an id count as matches but not as tournaments.
    """
    in_final = F.col("finals_won") + F.col("finals_lost") > 0
    won_final = F.col("finals_won") > 0

    def finals_count(condition):
        count = F.count(F.when(condition, F.col("tourney_id")))
        return count if zero_fill else F.when(F.bool_or(condition), count)

    def total(name):
        return F.sum(name) if zero_fill else zero_to_null(F.sum(name))

    figures = rollup.groupBy("player_id").agg(
        total("lost").alias("matches_lost"),
        total("won").alias("matches_won"),
        percentage(F.sum("lost_bp_saved"), F.sum("lost_bp_faced")).alias(
            "carrer_losses_bp_saved_%"
        ),
        percentage(F.sum("won_bp_saved"), F.sum("won_bp_faced")).alias("carrer_wins_bp_saved_%"),
        finals_count(in_final).alias("finals_played"),
        finals_count(won_final).alias("finals_won"),
        F.count("tourney_id").alias("tournaments_played"),
    )
    figures = with_finals_rates(with_mean_break_points(with_win_rate(figures)))
    return figures.select("player_id", *CAREER_COLUMNS)


CAREER_COLUMNS = (
    "matches_lost",
    "matches_won",
    "matches_played",
    "win_%",
    "carrer_losses_bp_saved_%",
    "carrer_wins_bp_saved_%",
    "carrer_avg_bp_saved_%",
    "finals_played",
    "finals_won",
    "tournaments_played",
    "finals_played_%",
    "finals_win_%",
    "tournament_win_%",
)
