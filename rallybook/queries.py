"""The query catalogue: each takes (spark, folder of the given tables) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from rallybook import fixtures
from rallybook.operators import levels, metrics, names, rejects, rollup
from rallybook.operators.sides import at_level, finals_rows, sides, with_int_break_points
from rallybook.plans import gold, pipeline, silver, update
from rallybook.schemas import (
    GS_STATISTICS_TABLE,
    LEVEL_PIVOT_TABLE,
    MATCHES_SOURCE_PREFIX,
    MATCHES_TABLE,
    PLAYER_STATISTICS_TABLE,
    PLAYERS_SOURCE,
    PLAYERS_TABLE,
    REPORT_TABLE,
)
from rallybook.sources import ledger
from rallybook.sources.landing import (
    concatenate_matches,
    land_bronze,
    landed_sources,
    load_matches,
    missing_sources,
    source_manifest,
)
from rallybook.sources.layout import bucketed, write_lookup
from rallybook.sources.parallel import folders_at_once, run_together
from rallybook.sources.scratch import stored, work_folder
from rallybook.sources.tables import (
    CSV_OPTIONS,
    PACKED,
    Lake,
    Layer,
    load_csv,
    read_csv,
    read_csv_by_name,
    read_table,
    write_table,
)
from rallybook.streaming import arrivals

Query = Callable[[SparkSession, str], DataFrame]


def on_matches(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(fixtures.matches(spark, sf_dir))


def on_both(operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """For operators on silver players and raw matches."""

    def query(spark, sf_dir):
        players = silver.silver_players(fixtures.players(spark, sf_dir))
        return operator(players, fixtures.matches(spark, sf_dir))

    return query


def stored_rollup(spark, sf_dir, *sums: str, level: str | None = None) -> DataFrame:
    """The rollup as a table in buckets by player, which all figures of a joined query read without
    a shuffle. Only the sums that are named are made, all by default, and only of one level if given."""
    matches = fixtures.matches(spark, sf_dir)
    if level is not None:
        matches = at_level(matches, level)
    rows = rollup.tournament_rollup(sides(matches), by_level=level is not None)
    keys = [c for c in rows.columns if c not in rollup.SUMS]
    return bucketed(rows.select(*keys, *(sums or rollup.SUMS)), f"{work_folder(spark)}/rollup", "player_id")


def win_loss_joined(spark, sf_dir):
    counts = stored_rollup(spark, sf_dir, "won", "lost")
    lost, won = rollup.per_player(counts, "lost", "matches_lost"), rollup.per_player(counts, "won", "matches_won")
    return metrics.join_win_loss(lost, won)


def break_points_joined(won_key_only: bool = False) -> Query:
    def query(spark, sf_dir):
        sums = [name for name in rollup.SUMS if not name.startswith("finals")]
        part = rollup.break_point_figures(stored_rollup(spark, sf_dir, *sums))
        return metrics.join_break_points(part["bp_lost"], part["bp_won"], won_key_only)

    return query


def player_statistics_joined(spark, sf_dir):
    return gold.join_player_statistics(stored_players(spark, sf_dir), stored_rollup(spark, sf_dir))


def gs_statistics_joined(spark, sf_dir):
    counts = stored_rollup(spark, sf_dir, "won", "lost", "finals_won", level=levels.GS.level)
    return levels.join_level_figures(counts)


def stored_players(spark, sf_dir) -> DataFrame:
    """Silver players as a table, of which the size is known when it is joined."""
    return stored(silver_players(spark, sf_dir), f"{work_folder(spark)}/players")


def silver_matches(spark, sf_dir):
    return silver.silver_matches(fixtures.matches(spark, sf_dir), stored_players(spark, sf_dir))


def silver_players(spark, sf_dir):
    return silver.silver_players(fixtures.players(spark, sf_dir))


def backfill_names(spark, sf_dir):
    return silver.backfill_names(
        fixtures.players(spark, sf_dir), fixtures.matches(spark, sf_dir)
    )


def player_lookup(spark, sf_dir):
    players = silver_players(spark, sf_dir)
    return names.find_ids(
        players, "Customer 000000001", "Customer 000000042", "Customer 000000099"
    )


def player_lookup_indexed(spark, sf_dir):
    """The same from files laid out for it."""
    path = f"{work_folder(spark)}/players"
    write_lookup(silver_players(spark, sf_dir), path, "full_name", "player_id")
    return names.find_ids(
        spark.read.parquet(path), "Customer 000000001", "Customer 000000042", "Customer 000000099"
    )


def untidy_matches(spark, sf_dir) -> DataFrame:
    """Matches with more values that are no numbers than the adapter has."""
    return fixtures.matches(spark, sf_dir).withColumn("l_bpFaced", F.expr(fixtures.UNTIDY_SQL))


def rejected_values(spark, sf_dir):
    found = rejects.rejected_values(fixtures.players(spark, sf_dir), rejects.PLAYER_PARSERS)
    return found.union(rejects.rejected_values(untidy_matches(spark, sf_dir), rejects.MATCH_PARSERS))


def unread_counts(spark, sf_dir):
    found = rejects.unread_counts(fixtures.players(spark, sf_dir), rejects.PLAYER_PARSERS)
    return found.union(rejects.unread_counts(untidy_matches(spark, sf_dir), rejects.MATCH_PARSERS))


def csv_roundtrip(spark, sf_dir):
    lake = Lake(work_folder(spark))
    write_table(fixtures.players(spark, sf_dir), lake, Layer.SILVER, PLAYERS_TABLE, "csv")
    return load_csv(spark, lake, Layer.SILVER, PLAYERS_TABLE)


def line_breaks(spark, sf_dir):
    """Players whose names hold line breaks, quotes and commas, landed and loaded."""
    folder = work_folder(spark)
    broken = f"case when player_id % 3 = 0 then name_last else {fixtures.BROKEN_NAME_SQL} end"
    raw = fixtures.players(spark, sf_dir).withColumn("name_last", F.expr(broken))
    raw.write.options(**CSV_OPTIONS).csv(f"{folder}/raw/players")
    lake = Lake(f"{folder}/lake")
    manifest = spark.createDataFrame([(f"{PLAYERS_SOURCE}.csv", f"{folder}/raw/players")], "name string, path string")
    land_bronze(spark, manifest, lake)
    return load_csv(spark, lake, Layer.BRONZE, PLAYERS_SOURCE)


def write_raw(spark, sf_dir, folder: str) -> DataFrame:
    """Players and one folder of matches per year as raw CSV; returns their manifest."""
    raw = fixtures.players(spark, sf_dir)
    raw.write.options(**CSV_OPTIONS).csv(f"{folder}/players")
    by_year = fixtures.matches(spark, sf_dir).write.partitionBy("year").options(**CSV_OPTIONS, **PACKED)
    with folders_at_once(spark):
        by_year.csv(f"{folder}/matches")
    # Only file names are read here.
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    source = F.regexp_extract("path", r"/(players|matches/year=\d+)/[^/]+$", 1)
    year = F.substring_index("source", "=", -1)
    stem = F.when(F.col("source") == "players", PLAYERS_SOURCE)
    return (
        files.select(source.alias("source"))
        .distinct()
        .select(
            F.concat(
                stem.otherwise(F.concat(F.lit(MATCHES_SOURCE_PREFIX), year)), F.lit(".csv")
            ).alias("name"),
            F.concat(F.lit(f"{folder}/"), "source").alias("path"),
        )
    )


def landed_lake(spark, sf_dir) -> tuple[Lake, DataFrame]:
    """A lake whose bronze layer holds all sources, and their manifest."""
    folder = work_folder(spark)
    manifest = write_raw(spark, sf_dir, f"{folder}/raw")
    lake = Lake(f"{folder}/lake")
    land_bronze(spark, manifest, lake)
    return lake, manifest


def yearly_files_load(spark, sf_dir):
    """With `path` as the name of the source it lies in."""
    lake, _ = landed_lake(spark, sf_dir)
    source = F.regexp_extract("path", r"/bronze/([^/]+)", 1)
    return load_matches(spark, lake).withColumn("path", source)


def yearly_list_load(spark, sf_dir):
    """The folders of all years as a list of paths."""
    folder = work_folder(spark)
    manifest = write_raw(spark, sf_dir, f"{folder}/raw")
    paths = sorted(r.path for r in manifest.where("name like '%matches%'").collect())
    return load_csv(spark, Lake(folder), paths)


def manifest(spark, sf_dir):
    """The sources of the years of the given orders, both ends included; folder left out."""
    years = fixtures.matches(spark, sf_dir).agg(F.min("year").alias("a"), F.max("year").alias("b")).first()
    rows = source_manifest(spark, "/raw", years.a, years.b)
    return rows.select("name", "path")


def all_matches(spark, sf_dir):
    lake, _ = landed_lake(spark, sf_dir)
    return concatenate_matches(spark, lake)


def counted_per_source(spark, lake) -> DataFrame:
    source = F.regexp_extract("path", r"/bronze/([^/]+)", 1).alias("name")
    return load_matches(spark, lake).groupBy(source).agg(F.count("*").alias("landed_rows"))


def bronze_relanding(spark, sf_dir):
    """Even years are landed and one odd year is left unfinished; then all that is missing is landed."""
    folder = work_folder(spark)
    sources = write_raw(spark, sf_dir, f"{folder}/raw")
    lake = Lake(f"{folder}/lake")
    year = F.regexp_extract("name", r"_(\d{4})\.csv$", 1).try_cast("int")
    land_bronze(spark, sources.where(year % 2 == 0), lake)
    odd = sources.where(year % 2 == 1).orderBy("name").first()
    unfinished = spark.read.text(odd.path).limit(3).write
    unfinished.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", False).text(
        f"{lake.folder(Layer.BRONZE)}/{odd.name}"
    )
    land_bronze(spark, sources, lake)
    return counted_per_source(spark, lake)


def yearly_union_by_name(spark, sf_dir):
    """Three layouts: all columns, columns in another order, and one column missing."""
    folder = work_folder(spark)
    matches = fixtures.matches(spark, sf_dir)
    layouts = (
        matches.columns,
        sorted(matches.columns),
        [c for c in matches.columns if c != "l_bpFaced"],
    )
    paths = []
    for i, columns in enumerate(layouts):
        paths.append(f"{folder}/layout-{i}.csv")
        part = matches.where(F.col("year") % 3 == i).select(*columns)
        part.write.options(**CSV_OPTIONS).csv(paths[-1])
    return read_csv_by_name(spark, paths)


def bronze_landing(spark, sf_dir):
    """Rows landed per source."""
    lake, _ = landed_lake(spark, sf_dir)
    counts = load_matches(spark, lake).groupBy("year").agg(F.count("*").alias("landed_rows"))
    matches = counts.select(
        F.format_string(f"{MATCHES_SOURCE_PREFIX}%d.csv", "year").alias("name"), "landed_rows"
    )
    players = load_csv(spark, lake, Layer.BRONZE, PLAYERS_SOURCE)
    return matches.union(
        players.agg(F.count("*").alias("landed_rows")).select(
            F.lit(f"{PLAYERS_SOURCE}.csv"), "landed_rows"
        )
    )


def missing_sources_listed(spark, sf_dir):
    """What is missing after landing the even years of the raw files, players not included."""
    folder = work_folder(spark)
    manifest = write_raw(spark, sf_dir, f"{folder}/raw")
    lake = Lake(f"{folder}/lake")
    year = F.regexp_extract("name", r"_(\d{4})\.csv$", 1).try_cast("int")
    land_bronze(spark, manifest.where(year % 2 == 0), lake)
    return missing_sources(manifest, landed_sources(spark, lake)).select("name")


def last_year(spark, sf_dir) -> int:
    return fixtures.matches(spark, sf_dir).agg(F.max("year")).first()[0]


def updated_lake(spark, sf_dir) -> Lake:
    """A lake built from all years but the last one, and then brought up to date with it."""
    folder = work_folder(spark)
    sources = write_raw(spark, sf_dir, f"{folder}/raw")
    lake = Lake(f"{folder}/lake")
    late = f"{MATCHES_SOURCE_PREFIX}{last_year(spark, sf_dir)}.csv"
    update.update_lake(spark, sources.where(F.col("name") != late), lake)
    update.update_lake(spark, sources, lake)
    return lake


def updated_table(name: str) -> Query:
    return lambda spark, sf_dir: read_table(spark, updated_lake(spark, sf_dir), Layer.GOLD, name, "versioned")


def updated_years(spark, sf_dir):
    """Rows of each year in gold, and the version of the table that wrote it."""
    lake = updated_lake(spark, sf_dir)
    version = F.regexp_extract("_metadata.file_path", r"/_version=(\d+)-", 1).cast("int")
    rows = read_table(spark, lake, Layer.GOLD, MATCHES_TABLE, "versioned")
    return rows.groupBy("year", version.alias("written_in")).agg(F.count("*").alias("matches"))


def changed_source(spark, sf_dir):
    """Rows per source after one raw year has grown, by itself, and has been landed again."""
    folder = work_folder(spark)
    sources = write_raw(spark, sf_dir, f"{folder}/raw")
    lake = Lake(f"{folder}/lake")
    ledger.land_changed(spark, sources, lake)
    late = f"{MATCHES_SOURCE_PREFIX}{last_year(spark, sf_dir)}.csv"
    path = sources.where(F.col("name") == late).first().path
    # Read to the end first: more files are about to be added where it is read from.
    once_more = stored(read_csv(spark, path), f"{folder}/copy")
    once_more.write.mode("append").options(**CSV_OPTIONS).csv(path)
    landed = ledger.land_changed(spark, sources, lake)
    return counted_per_source(spark, lake).withColumn("landed_again", F.col("name").isin(landed))


def failed_replacement(spark, sf_dir):
    """The players that are still there after a write meant to replace them has failed half-way."""
    lake = Lake(work_folder(spark))
    players = silver_players(spark, sf_dir)
    write_table(players, lake, Layer.SILVER, PLAYERS_TABLE, "versioned")
    bad = F.when(F.col("player_id") % 100 == 99, F.raise_error(F.lit("half-way")).cast("string"))
    try:
        broken = players.repartition(8).withColumn("full_name", bad.otherwise("nobody"))
        write_table(broken, lake, Layer.SILVER, PLAYERS_TABLE, "versioned")
    except PySparkException:
        return read_table(spark, lake, Layer.SILVER, PLAYERS_TABLE, "versioned")
    raise RuntimeError("the second write should have failed")


def arrived_lake(spark, sf_dir) -> Lake:
    """Years that arrive in two goes in one folder; the stream takes in what is new after each."""
    folder = work_folder(spark)
    sources = write_raw(spark, sf_dir, f"{folder}/raw").where("name like '%matches%'").collect()
    lake = Lake(f"{folder}/lake")
    late = f"{MATCHES_SOURCE_PREFIX}{last_year(spark, sf_dir)}.csv"
    for go in (False, True):
        arriving = [row for row in sources if (row.name == late) == go]
        run_together(spark, [partial(arrive, spark, row.path, f"{folder}/arriving/{row.name}") for row in arriving])
        arrivals.take_arrivals(spark, f"{folder}/arriving", lake)
    return lake


def arrive(spark, source: str, target: str) -> None:
    read_csv(spark, source).write.options(**CSV_OPTIONS).csv(target)


def streaming_counts(spark, sf_dir):
    return arrivals.arrived_counts(spark, arrived_lake(spark, sf_dir))


def streaming_matches(spark, sf_dir):
    """Rows per source, and in how many goes they came."""
    source = F.regexp_extract("path", r"/arriving/([^/]+)", 1)
    rows = arrivals.arrived_matches(spark, arrived_lake(spark, sf_dir))
    return rows.groupBy(source.alias("name"), "year").agg(F.count("*").alias("landed_rows"))


def pipeline_report(spark, sf_dir):
    folder = work_folder(spark)
    lake = Lake(f"{folder}/lake")
    pipeline.run_pipeline(spark, write_raw(spark, sf_dir, f"{folder}/raw"), lake)
    return read_table(spark, lake, Layer.SILVER, REPORT_TABLE)


def gold_table(name: str) -> Query:
    def query(spark, sf_dir):
        folder = work_folder(spark)
        manifest = write_raw(spark, sf_dir, f"{folder}/raw")
        lake = Lake(f"{folder}/lake")
        pipeline.run_pipeline(spark, manifest, lake)
        return read_table(spark, lake, Layer.GOLD, name)

    return query


QUERIES: dict[str, Query] = {
    # Silver
    "silver_players": silver_players,
    "silver_matches": silver_matches,
    "distinct_names": on_matches(names.distinct_names),
    "name_corrections": on_both(lambda p, m: names.name_corrections(m, p)),
    "name_candidates": on_both(names.name_candidates),
    "backfill_names": backfill_names,
    "player_lookup": player_lookup,
    "player_lookup_indexed": player_lookup_indexed,
    "rejected_values": rejected_values,
    "unread_counts": unread_counts,
    # Career figures
    "match_sides": on_matches(sides),
    "gold_matches": on_matches(with_int_break_points),
    "losses": on_matches(metrics.losses),
    "wins": on_matches(metrics.wins),
    "win_loss": on_matches(metrics.win_loss),
    "win_loss_joined": win_loss_joined,
    "win_loss_zero_filled": on_matches(lambda m: metrics.win_loss(m, zero_fill=True)),
    "bp_saved_won": on_matches(metrics.break_points_saved_won),
    "bp_saved_lost": on_matches(metrics.break_points_saved_lost),
    "bp_saved_career": on_matches(metrics.break_points_career),
    "bp_saved_career_joined": break_points_joined(),
    "bp_saved_career_won_key": break_points_joined(won_key_only=True),
    "tournaments_played": on_matches(metrics.tournaments_played),
    "finals_rows": on_matches(finals_rows),
    "finals_played": on_matches(metrics.finals_played),
    "finals_won": on_matches(metrics.finals_won),
    "player_tournaments": on_matches(lambda m: rollup.tournament_rollup(sides(m), by_level=True)),
    "player_statistics": on_both(gold.player_statistics),
    "player_statistics_zero_filled": on_both(
        lambda p, m: gold.player_statistics(p, m, zero_fill=True)
    ),
    "player_statistics_joined": player_statistics_joined,
    # Figures by level
    "gs_played": on_matches(levels.level_played),
    "gs_won": on_matches(levels.level_won),
    "gs_matches_played": on_matches(levels.level_matches_played),
    "gs_matches_won": on_matches(levels.level_matches_won),
    "gs_statistics": on_matches(levels.level_statistics),
    "gs_statistics_joined": gs_statistics_joined,
    "masters_statistics": on_matches(lambda m: levels.level_statistics(m, levels.MASTERS)),
    "davis_statistics": on_matches(lambda m: levels.level_statistics(m, levels.DAVIS)),
    "loss_rates": on_matches(levels.loss_rates),
    "level_pivot": on_matches(levels.level_pivot),
    # Sources, sinks and the whole run
    "csv_roundtrip": csv_roundtrip,
    "line_breaks": line_breaks,
    "yearly_files_load": yearly_files_load,
    "yearly_list_load": yearly_list_load,
    "manifest": manifest,
    "all_matches": all_matches,
    "yearly_union_by_name": yearly_union_by_name,
    "bronze_landing": bronze_landing,
    "bronze_relanding": bronze_relanding,
    "missing_sources": missing_sources_listed,
    "streaming_counts": streaming_counts,
    "streaming_matches": streaming_matches,
    "pipeline_report": pipeline_report,
    "incremental_run": updated_table(PLAYER_STATISTICS_TABLE),
    "incremental_gs": updated_table(GS_STATISTICS_TABLE),
    "incremental_years": updated_years,
    "changed_source": changed_source,
    "failed_replacement": failed_replacement,
    "pipeline_gold": gold_table(GS_STATISTICS_TABLE),
    "pipeline_level_pivot": gold_table(LEVEL_PIVOT_TABLE),
    "pipeline_player_statistics": gold_table(PLAYER_STATISTICS_TABLE),
}
