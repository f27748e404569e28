"""Career figures, one operator per figure. Each has one row per player that has the figure.

Counting by player is safe for a player who holds a large share of all rows: each task first
reduces its rows to one per group, and distinct tournaments are spread by (player, tournament).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rallybook.functions.scalars import mean_of_percentages, percentage
from rallybook.operators.sides import finals, id_column, int_column, sides


def won_or_lost(matches: DataFrame, player: str) -> DataFrame:
    """The matches keyed by one side, `winner` or `loser`, without unknown players.

    An id that has to be parsed is made as the one element of an exploded array: a filter on it is not
    pushed below that, where it would parse every id once more.
    """
    name = f"{player}_id"
    parsed = matches.schema[name].dataType.typeName() != "long"
    own = F.explode(F.array(id_column(matches, name))) if parsed else F.col(name)
    return matches.withColumn("player_id", own).where(F.col("player_id").isNotNull())


def losses(matches: DataFrame) -> DataFrame:
    return won_or_lost(matches, "loser").groupBy("player_id").agg(F.count("*").alias("matches_lost"))


def wins(matches: DataFrame) -> DataFrame:
    return won_or_lost(matches, "winner").groupBy("player_id").agg(F.count("*").alias("matches_won"))


def with_win_rate(counts: DataFrame) -> DataFrame:
    """Adds `matches_played` and `win_%`, both NULL where a count is."""
    return counts.withColumn(
        "matches_played", F.col("matches_lost") + F.col("matches_won")
    ).withColumn("win_%", percentage(F.col("matches_won"), F.col("matches_played")))


def join_win_loss(lost: DataFrame, won: DataFrame) -> DataFrame:
    """Win and loss counts from two tables, players of either kept."""
    return with_win_rate(lost.join(won, "player_id", "full"))


def win_loss(matches: DataFrame, zero_fill: bool = False) -> DataFrame:
    """The same in one pass over the matches, without the join.

    A player who never lost has NULL losses, and with them NULL matches played and win rate;
    `zero_fill` counts them as 0.
    """
    lost, won = F.count_if(~F.col("won")), F.count_if("won")
    if not zero_fill:
        lost, won = F.nullif(lost, F.lit(0)), F.nullif(won, F.lit(0))
    counts = (
        sides(matches)
        .groupBy("player_id")
        .agg(lost.alias("matches_lost"), won.alias("matches_won"))
    )
    return with_win_rate(counts)


def break_points_saved(matches: DataFrame, player: str, name: str) -> DataFrame:
    """Break points saved by one side, in percent; each sum ignores its own NULLs."""
    letter = player[0]
    keyed = won_or_lost(matches, player)
    saved = F.sum(int_column(matches, f"{letter}_bpSaved"))
    faced = F.sum(int_column(matches, f"{letter}_bpFaced"))
    return keyed.groupBy("player_id").agg(percentage(saved, faced).alias(name))


def break_points_saved_won(matches: DataFrame) -> DataFrame:
    return break_points_saved(matches, "winner", "carrer_wins_bp_saved_%")


def break_points_saved_lost(matches: DataFrame) -> DataFrame:
    return break_points_saved(matches, "loser", "carrer_losses_bp_saved_%")


def with_mean_break_points(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "carrer_avg_bp_saved_%",
        mean_of_percentages(F.col("carrer_wins_bp_saved_%"), F.col("carrer_losses_bp_saved_%")),
    )


def join_break_points(
    lost: DataFrame, won: DataFrame, won_key_only: bool = False
) -> DataFrame:
    """Both break-point figures and their mean, players of either table kept.

    `won_key_only` takes the id from the won side alone, so that players who never won get a
    NULL id. It exists only to compare with results that were made that way.
    """
    if won_key_only:
        lost = lost.withColumnRenamed("player_id", "loser")
        both = lost.join(won, F.col("loser") == F.col("player_id"), "full").drop("loser")
    else:
        both = lost.join(won, "player_id", "full")
    return with_mean_break_points(
        both.select("player_id", "carrer_losses_bp_saved_%", "carrer_wins_bp_saved_%")
    )


def break_points_career(matches: DataFrame) -> DataFrame:
    """The same in one pass over the matches."""
    saved, faced = F.col("bp_saved"), F.col("bp_faced")

    def share(side):
        return percentage(F.sum(F.when(side, saved)), F.sum(F.when(side, faced)))

    figures = (
        sides(matches)
        .groupBy("player_id")
        .agg(
            share(~F.col("won")).alias("carrer_losses_bp_saved_%"),
            share(F.col("won")).alias("carrer_wins_bp_saved_%"),
        )
    )
    return with_mean_break_points(figures)


def distinct_tournaments(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy("player_id").agg(F.count_distinct("tourney_id").alias(name))


def tournaments_played(matches: DataFrame) -> DataFrame:
    return distinct_tournaments(sides(matches), "tournaments_played")


def finals_played(matches: DataFrame) -> DataFrame:
    return distinct_tournaments(sides(finals(matches)), "finals_played")


def finals_won(matches: DataFrame) -> DataFrame:
    return distinct_tournaments(won_or_lost(finals(matches), "winner"), "finals_won")


def with_finals_rates(df: DataFrame) -> DataFrame:
    played, won, entered = (F.col(c) for c in ("finals_played", "finals_won", "tournaments_played"))
    return df.withColumns(
        {
            "finals_played_%": percentage(played, entered),
            "finals_win_%": percentage(won, played),
            "tournament_win_%": percentage(won, entered),
        }
    )
