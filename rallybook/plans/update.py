"""The daily run: only years whose sources are new or have changed are cleaned and counted again."""

from __future__ import annotations

from functools import partial
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from rallybook.functions.scalars import year_from_path
from rallybook.operators.joins import lookup_join
from rallybook.operators.levels import level_pivot_from, level_statistics_from, loss_rates_from
from rallybook.operators.names import name_corrections
from rallybook.operators.rollup import added_up, over_levels, tournament_rollup
from rallybook.operators.sides import sides, with_int_break_points
from rallybook.plans.gold import player_statistics_from
from rallybook.plans.pipeline import LEVEL_TABLES
from rallybook.plans.silver import silver_matches_by, silver_players
from rallybook.schemas import (
    CORRECTIONS_TABLE,
    LEVEL_PIVOT_TABLE,
    MATCHES_MARK,
    MATCHES_TABLE,
    PLAYER_STATISTICS_TABLE,
    PLAYERS_SOURCE,
    PLAYERS_TABLE,
    YEARLY_TOURNAMENTS_TABLE,
)
from rallybook.sources.landing import landed_names, load_sources
from rallybook.sources.ledger import enter, land_changed, read_ledger, unknown_to
from rallybook.sources.layout import bucketed
from rallybook.sources.parallel import run_together
from rallybook.sources.scratch import drop_folder
from rallybook.sources.tables import Lake, Layer, load_csv, read_table, write_table

FORMAT = "versioned"


def with_year(names: DataFrame) -> DataFrame:
    return names.withColumn("year", year_from_path(F.concat(F.lit("/"), F.col("name"))))


def sources_of_years(spark: SparkSession, lake: Lake, changed: DataFrame) -> list[str]:
    """The landed match sources of the years that a changed one belongs to: a year is built as a whole."""
    landed = spark.createDataFrame([(n,) for n in landed_names(spark, lake)], "name string")
    matches = F.contains("name", F.lit(MATCHES_MARK))
    years = with_year(changed.select("name").where(matches)).select(F.col("year").alias("_year")).distinct()
    rows = with_year(landed.where(matches)).join(years, F.col("year").eqNullSafe(F.col("_year")), "left_semi")
    return sorted(row.name for row in rows.collect())


def update_silver(spark: SparkSession, lake: Lake, names: list[str], players_changed: bool) -> None:
    """Silver players if their source has changed, and the matches of the sources named; years that
    none of them has rows of keep their files."""
    if players_changed:
        players = silver_players(load_csv(spark, lake, Layer.BRONZE, PLAYERS_SOURCE))
        write_table(players, lake, Layer.SILVER, PLAYERS_TABLE, FORMAT)
    if not names:
        return
    players = read_table(spark, lake, Layer.SILVER, PLAYERS_TABLE, FORMAT)
    matches = load_sources(spark, lake, names)
    # A correction depends on the pair of id and name alone, so those of some years are enough for them.
    write_table(name_corrections(matches, players), lake, Layer.SILVER, CORRECTIONS_TABLE, FORMAT)
    corrections = read_table(spark, lake, Layer.SILVER, CORRECTIONS_TABLE, FORMAT)
    repaired = silver_matches_by(matches, corrections)
    write_table(repaired, lake, Layer.SILVER, MATCHES_TABLE, FORMAT, "year", only_partitions=True)


def update_gold(spark: SparkSession, lake: Lake, years: DataFrame | None) -> None:
    """The gold matches and the counts per player, tournament, level and year of the given years, and
    all statistics, which are sums of these counts over the years."""
    players = read_table(spark, lake, Layer.SILVER, PLAYERS_TABLE, FORMAT)

    def save(df: DataFrame, name: str, **options):
        return partial(write_table, df, lake, Layer.GOLD, name, FORMAT, **options)

    tables = [save(players, PLAYERS_TABLE)]
    if years is not None:
        matches = with_int_break_points(read_table(spark, lake, Layer.SILVER, MATCHES_TABLE, FORMAT))
        found = [row.year for row in years.collect()]
        # As literals the years prune folders.
        known, unknown = [y for y in found if y is not None], None in found
        matches = matches.where(F.col("year").isin(known) | (F.col("year").isNull() & F.lit(unknown)))
        rollup = tournament_rollup(sides(matches, keep=("year",)), by_level=True, by=("year",))
        by_year = {"partition_by": "year", "only_partitions": True}
        tables += [save(matches, MATCHES_TABLE, **by_year), save(rollup, YEARLY_TOURNAMENTS_TABLE, gather=True, **by_year)]
    run_together(spark, tables)
    # Added up once for all tables below, and in buckets by player, so that none of them shuffles it.
    folder = f"{lake.root.rstrip('/')}/scratch/rallybook-{uuid4().hex}"
    yearly = read_table(spark, lake, Layer.GOLD, YEARLY_TOURNAMENTS_TABLE, FORMAT)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = added_up(yearly.repartition(buckets, "player_id"))
    rollup = bucketed(counts, folder, "player_id", buckets, arranged=True)
    statistics = player_statistics_from(players, over_levels(rollup))
    statistics = lookup_join(statistics, loss_rates_from(rollup), ["player_id"], ["full_name"])
    tables = [save(statistics, PLAYER_STATISTICS_TABLE), save(level_pivot_from(rollup), LEVEL_PIVOT_TABLE)]
    for table, names in LEVEL_TABLES.items():
        at_level = rollup.where(F.col("tourney_level") == names.level)
        tables.append(save(level_statistics_from(at_level, names), table))
    try:
        run_together(spark, tables)
    finally:
        drop_folder(spark, folder)


def update_lake(spark: SparkSession, manifest: DataFrame, lake: Lake, by_content: bool = False) -> list[str]:
    """Land what is new or has changed and bring silver and gold up to date; returns the names of the
    sources that the tables were built from anew.

    The tables are versioned: until a table is replaced its old rows can be read, and years without a
    change keep their files. All gold statistics equal those of a full run. Changed players may
    respell any match, so they rebuild all years. What the tables were built from is entered in a
    ledger at the end, so a run that dies anywhere is made up for by the next one.

    Sources taken off the manifest stay. Names are not filled from the matches here, as any new match
    might change them; use `run_pipeline` for that.
    """
    land_changed(spark, manifest, lake, by_content)
    changed = unknown_to(read_ledger(spark, lake, "built"), read_ledger(spark, lake, "landed"))
    rows = changed.collect()
    if not rows:
        return []
    changed = spark.createDataFrame(rows, changed.schema)
    players_changed = any(row.name == f"{PLAYERS_SOURCE}.csv" for row in rows)
    if players_changed:
        names = [n for n in landed_names(spark, lake) if MATCHES_MARK in n]
    else:
        names = sources_of_years(spark, lake, changed)
    update_silver(spark, lake, names, players_changed)
    years = with_year(spark.createDataFrame([(n,) for n in names], "name string")).select("year").distinct()
    update_gold(spark, lake, years if names else None)
    enter(spark, lake, "built", changed)
    return sorted({*names, *(row.name for row in rows)})
