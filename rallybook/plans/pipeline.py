"""The whole run: land what is missing, clean it, and build the gold tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from rallybook.operators.joins import lookup_join
from rallybook.operators.levels import (
    DAVIS,
    GS,
    MASTERS,
    level_pivot_from,
    level_statistics_from,
    loss_rates_from,
)
from rallybook.operators.names import name_corrections
from rallybook.operators.rejects import MATCH_PARSERS, PLAYER_PARSERS, observed
from rallybook.operators.rollup import over_levels, tournament_rollup
from rallybook.operators.sides import sides, with_int_break_points
from rallybook.plans.gold import player_statistics_from
from rallybook.plans.report import run_report
from rallybook.plans.silver import (
    backfill_names,
    silver_matches_by,
    silver_players,
)
from rallybook.schemas import (
    CORRECTIONS_TABLE,
    DAVIS_STATISTICS_TABLE,
    GS_STATISTICS_TABLE,
    LEVEL_PIVOT_TABLE,
    MASTERS_STATISTICS_TABLE,
    MATCHES_TABLE,
    PLAYER_STATISTICS_TABLE,
    PLAYER_TOURNAMENTS_TABLE,
    PLAYERS_SOURCE,
    PLAYERS_TABLE,
    REPORT_TABLE,
)
from rallybook.sources.landing import land_bronze, load_matches
from rallybook.sources.layout import bucketed
from rallybook.sources.parallel import run_together
from rallybook.sources.tables import (
    Lake,
    Layer,
    load_csv,
    read_table,
    retype,
    write_table,
)

LEVEL_TABLES = {
    GS_STATISTICS_TABLE: GS,
    MASTERS_STATISTICS_TABLE: MASTERS,
    DAVIS_STATISTICS_TABLE: DAVIS,
}


def read_silver(spark: SparkSession, lake: Lake, name: str, fmt: str) -> DataFrame:
    table = read_table(spark, lake, Layer.SILVER, name, fmt)
    return retype(table) if fmt == "csv" else table


def bronze_to_silver(
    spark: SparkSession, lake: Lake, fmt: str = "parquet", backfill: bool = False
) -> None:
    """Silver players, and silver matches by year. The players are written first and read
    back, so that the matches join a table and not a plan that parses the CSV again.

    The (id, name) pairs that need a correction are collected in a table first. They are few as a
    rule, so Spark broadcasts the table by its size and the matches are not shuffled, however many
    players there are; of a larger table a digest is broadcast, and few matches are shuffled.

    `backfill` fills missing player names from the matches before nameless players are left out.

    A small report says how many values could not be read, counted in the passes that write the tables.
    """
    raw = load_csv(spark, lake, Layer.BRONZE, PLAYERS_SOURCE)
    matches = load_matches(spark, lake)
    raw, players_seen = observed(raw, PLAYER_PARSERS)
    players = backfill_names(raw, matches) if backfill else silver_players(raw)
    write_table(players, lake, Layer.SILVER, PLAYERS_TABLE, fmt)
    players = read_silver(spark, lake, PLAYERS_TABLE, fmt)
    # A partitioned CSV folder keeps its year in folder names only, so CSV stays in one piece.
    by_year = None if fmt == "csv" else "year"
    write_table(name_corrections(matches, players), lake, Layer.SILVER, CORRECTIONS_TABLE)
    lookup = read_table(spark, lake, Layer.SILVER, CORRECTIONS_TABLE)
    matches, matches_seen = observed(matches, MATCH_PARSERS)
    # All but a few rows stay with the task of their input files, so no task has many years of them.
    write_table(silver_matches_by(matches, lookup), lake, Layer.SILVER, MATCHES_TABLE, fmt, by_year)
    report = run_report(spark, {"players": players_seen, "matches": matches_seen}, players)
    write_table(report, lake, Layer.SILVER, REPORT_TABLE)


def silver_to_gold(
    spark: SparkSession, lake: Lake, silver_fmt: str = "parquet", fmt: str = "parquet"
) -> None:
    """The gold tables. The matches are scanned once for statistics: counts per player,
    tournament and level are written as a table of their own, in buckets by player, and each
    statistics table is made from that one without a shuffle of it."""
    players = read_silver(spark, lake, PLAYERS_TABLE, silver_fmt)
    matches = with_int_break_points(read_silver(spark, lake, MATCHES_TABLE, silver_fmt))
    rollup = tournament_rollup(sides(matches), by_level=True)

    def save(df: DataFrame, name: str, as_fmt: str = fmt, **options):
        return partial(write_table, df, lake, Layer.GOLD, name, as_fmt, **options)

    run_together(
        spark,
        [
            save(matches, MATCHES_TABLE, partition_by=None if fmt == "csv" else "year"),
            save(players, PLAYERS_TABLE),
        ],
    )
    rollup = bucketed(rollup, lake.path(Layer.GOLD, PLAYER_TOURNAMENTS_TABLE, "parquet"), "player_id")
    statistics = player_statistics_from(players, over_levels(rollup))
    statistics = lookup_join(statistics, loss_rates_from(rollup), ["player_id"], ["full_name"])
    tables = [save(statistics, PLAYER_STATISTICS_TABLE), save(level_pivot_from(rollup), LEVEL_PIVOT_TABLE)]
    for table, names in LEVEL_TABLES.items():
        at_level = rollup.where(F.col("tourney_level") == names.level)
        tables.append(save(level_statistics_from(at_level, names), table))
    run_together(spark, tables)


def run_pipeline(
    spark: SparkSession,
    manifest: DataFrame,
    lake: Lake,
    silver_fmt: str = "parquet",
    gold_fmt: str = "parquet",
    backfill: bool = False,
) -> list[str]:
    """Bronze, silver and gold in order; returns the sources that had to be landed."""
    landed = land_bronze(spark, manifest, lake)
    bronze_to_silver(spark, lake, silver_fmt, backfill)
    silver_to_gold(spark, lake, silver_fmt, gold_fmt)
    return landed
