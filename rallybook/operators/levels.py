"""Figures for one tournament level, and by level."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from rallybook.functions.scalars import percentage, zero_to_null
from rallybook.operators.metrics import distinct_tournaments, won_or_lost
from rallybook.operators.rollup import tournament_rollup
from rallybook.operators.sides import at_level, finals, sides
from rallybook.schemas import DAVIS_CUP, GRAND_SLAM, MASTERS_1000
from rallybook.sources.scratch import stored, work_folder

MOST_LEVELS = 100


@dataclass(frozen=True)
class LevelNames:
    """The level code and the two prefixes its columns have."""

    level: str
    counts: str
    rates: str

    @property
    def played(self) -> str:
        return f"{self.counts}_played"

    @property
    def won(self) -> str:
        return f"{self.counts}_won"

    @property
    def matches_played(self) -> str:
        return f"{self.counts}_matches_played"

    @property
    def matches_won(self) -> str:
        return f"{self.counts}_matches_won"

    @property
    def win_rate(self) -> str:
        return f"{self.rates}_win_%"

    @property
    def matches_win_rate(self) -> str:
        return f"{self.rates}_matches_win_%"


GS = LevelNames(GRAND_SLAM, "gs", "gs")
MASTERS = LevelNames(MASTERS_1000, "masters_1000", "masters_1000")
DAVIS = LevelNames(DAVIS_CUP, "davis_cup", "davis")


def level_played(matches: DataFrame, names: LevelNames = GS) -> DataFrame:
    """Distinct tournaments of the level, as winner or loser of a match."""
    return distinct_tournaments(sides(at_level(matches, names.level)), names.played)


def level_won(matches: DataFrame, names: LevelNames = GS) -> DataFrame:
    """Finals won at the level: rows are counted, not distinct tournaments."""
    rows = won_or_lost(finals(at_level(matches, names.level)), "winner")
    return rows.groupBy("player_id").agg(F.count("*").alias(names.won))


def level_matches_played(matches: DataFrame, names: LevelNames = GS) -> DataFrame:
    rows = sides(at_level(matches, names.level))
    return rows.groupBy("player_id").agg(F.count("*").alias(names.matches_played))


def level_matches_won(matches: DataFrame, names: LevelNames = GS) -> DataFrame:
    rows = won_or_lost(at_level(matches, names.level), "winner")
    return rows.groupBy("player_id").agg(F.count("*").alias(names.matches_won))


def with_level_rates(df: DataFrame, names: LevelNames) -> DataFrame:
    return df.withColumns(
        {
            names.win_rate: percentage(F.col(names.won), F.col(names.played)),
            names.matches_win_rate: percentage(
                F.col(names.matches_won), F.col(names.matches_played)
            ),
        }
    )


def level_statistics_from(rollup: DataFrame, names: LevelNames = GS) -> DataFrame:
    """The level's figures from a rollup that has the level among its keys or holds it alone."""
    figures = rollup.groupBy("player_id").agg(
        F.count("tourney_id").alias(names.played),
        zero_to_null(F.sum("finals_won")).alias(names.won),
        F.sum(F.col("won") + F.col("lost")).alias(names.matches_played),
        zero_to_null(F.sum("won")).alias(names.matches_won),
    )
    return with_level_rates(figures, names)


def level_statistics(matches: DataFrame, names: LevelNames = GS) -> DataFrame:
    """The level's figures in one pass over its matches, without joins."""
    return level_statistics_from(tournament_rollup(sides(at_level(matches, names.level))), names)


def loss_rates_from(rollup: DataFrame) -> DataFrame:
    """`loss_%` over all matches, NULL like `win_%` for who never won or lost, and Grand Slam
    losses, from a rollup by level."""
    lost, won = zero_to_null(F.sum("lost")), zero_to_null(F.sum("won"))
    gs_lost = F.sum(F.when(F.col("tourney_level") == GRAND_SLAM, F.col("lost")))
    return rollup.groupBy("player_id").agg(
        percentage(lost, lost + won).alias("loss_%"),
        zero_to_null(gs_lost).alias("gs_matches_lost"),
    )


def loss_rates(matches: DataFrame) -> DataFrame:
    """The same in one pass over the matches."""
    return loss_rates_from(tournament_rollup(sides(matches), by_level=True))


def found_levels(rollup: DataFrame) -> list[str | None]:
    """The levels that occur, in order and NULL last. More than `MOST_LEVELS` are no levels."""
    rows = rollup.select("tourney_level").distinct().limit(MOST_LEVELS + 1).collect()
    if len(rows) > MOST_LEVELS:
        raise ValueError(f"more than {MOST_LEVELS} levels")
    return sorted((r.tourney_level for r in rows), key=lambda level: (level is None, level))


def level_pivot_from(rollup: DataFrame, levels=None) -> DataFrame:
    """Matches won and lost at each level as columns, 0 where there are none, from a rollup by level.

    Without `levels` every level that occurs has its columns; those of matches without a
    level are named `none`.
    """
    counts = []
    for level in found_levels(rollup) if levels is None else levels:
        here = F.col("tourney_level").eqNullSafe(F.lit(level))
        for outcome in ("won", "lost"):
            total = F.coalesce(F.sum(F.when(here, F.col(outcome))), F.lit(0))
            counts.append(total.alias(f"matches_{outcome}_{'none' if level is None else level}"))
    return rollup.groupBy("player_id").agg(*counts or [F.count("*").alias("matches")]).drop("matches")


def level_pivot(matches: DataFrame, levels=None) -> DataFrame:
    """The same from one scan of the matches. Without `levels` their counts are stored first, and both the
    levels and the figures are taken from those."""
    rollup = tournament_rollup(sides(matches), by_level=True)
    if levels is None:
        counts = rollup.groupBy("player_id", "tourney_level").agg(*[F.sum(c).alias(c) for c in ("won", "lost")])
        rollup = stored(counts, f"{work_folder(matches.sparkSession)}/levels")
    return level_pivot_from(rollup, levels)


def level_figures_from(rollup: DataFrame, names: LevelNames = GS) -> list[DataFrame]:
    """The level's four figures, each a table of its own, from a rollup by level."""
    here = rollup.where(F.col("tourney_level") == names.level).groupBy("player_id")
    played = here.agg(F.count("tourney_id").alias(names.played), F.sum(F.col("won") + F.col("lost")).alias("n"))
    won = here.agg(F.sum("finals_won").alias(names.won))
    matches_won = here.agg(F.sum("won").alias(names.matches_won))
    return [
        played.drop("n"),
        won.where(F.col(names.won) > 0),
        played.select("player_id", F.col("n").alias(names.matches_played)),
        matches_won.where(F.col(names.matches_won) > 0),
    ]


def join_level_figures(rollup: DataFrame, names: LevelNames = GS) -> DataFrame:
    """The level's statistics put together from the four figures."""
    figures, *others = level_figures_from(rollup, names)
    for part in others:
        figures = figures.join(part, "player_id", "left")
    return with_level_rates(figures, names)
