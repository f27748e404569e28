"""Names, codes and column types of the tables."""

from __future__ import annotations

from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

# File and table names.
PLAYERS_SOURCE = "atp_players"
MATCHES_SOURCE_PREFIX = "atp_matches_"
MATCHES_MARK = "matches"
PLAYERS_TABLE = "df_players"
MATCHES_TABLE = "df_matches"
GS_STATISTICS_TABLE = "df_gs_statistics"
MASTERS_STATISTICS_TABLE = "df_masters_statistics"

# Names of the tables that only this library writes.
DAVIS_STATISTICS_TABLE = "df_davis_statistics"
PLAYER_STATISTICS_TABLE = "df_player_statistics"
PLAYER_TOURNAMENTS_TABLE = "df_player_tournaments"
YEARLY_TOURNAMENTS_TABLE = "df_yearly_player_tournaments"
CORRECTIONS_TABLE = "df_name_corrections"
ALL_MATCHES_TABLE = "df_all_matches"
REPORT_TABLE = "df_run_report"
LEVEL_PIVOT_TABLE = "df_level_pivot"

# Codes found in the data.
GRAND_SLAM = "G"
MASTERS_1000 = "M"
DAVIS_CUP = "D"
FINAL = "F"

# Column names of the raw files.
PLAYER_COLUMNS = ("player_id", "name_first", "name_last", "dob", "ioc", "wikidata_id")
MATCH_COLUMNS = (
    "tourney_id",
    "tourney_name",
    "surface",
    "tourney_level",
    "round",
    "winner_id",
    "winner_name",
    "loser_id",
    "loser_name",
    "w_bpSaved",
    "w_bpFaced",
    "l_bpSaved",
    "l_bpFaced",
)
BREAK_POINT_COLUMNS = ("w_bpSaved", "w_bpFaced", "l_bpSaved", "l_bpFaced")

# Types that a silver table has beyond plain strings; used when it was kept as CSV.
SILVER_TYPES = {
    "player_id": "bigint",
    "winner_id": "bigint",
    "loser_id": "bigint",
    "dob": "date",
    "year": "int",
}


def all_strings(names) -> StructType:
    """A schema in which every column is a nullable string."""
    return StructType([StructField(name, StringType()) for name in names])


PLAYERS_BRONZE = all_strings(PLAYER_COLUMNS)
MATCHES_BRONZE = all_strings(MATCH_COLUMNS)

PLAYERS_SILVER = StructType(
    [
        StructField("player_id", LongType()),
        StructField("name_first", StringType()),
        StructField("name_last", StringType()),
        StructField("dob", DateType()),
        StructField("country", StringType()),
        StructField("full_name", StringType()),
    ]
)
