"""Values that could not be read, and what a run reports of them."""

from frames import matches, players, sorted_rows

from rallybook.operators.rejects import MATCH_PARSERS, PLAYER_PARSERS, observed, rejected_values, unread_counts
from rallybook.operators.sides import with_int_break_points
from rallybook.plans.pipeline import bronze_to_silver
from rallybook.schemas import REPORT_TABLE
from rallybook.sources.tables import Lake, Layer, read_table, write_csv

BAD = [
    {"w": "1", "l": "x", "w_bpSaved": "3.0", "w_bpFaced": "many", "l_bpSaved": " ", "l_bpFaced": None},
    {"w": "1.0", "l": "2", "w_bpSaved": "", "w_bpFaced": "many", "l_bpFaced": "1e99"},
    {"w": None, "l": "2.5", "w_bpSaved": "NaN"},
]


def test_values_are_listed_and_counted(spark):
    rows = matches(spark, *BAD)
    assert sorted_rows(rejected_values(rows, MATCH_PARSERS).select("column", "value", "rows")) == sorted_rows(
        spark.createDataFrame(
            [("loser_id", "x", 1), ("loser_id", "2.5", 1), ("w_bpFaced", "many", 2), ("l_bpFaced", "1e99", 1), ("w_bpSaved", "NaN", 1)],
            "column string, value string, rows long",
        ).select("column", "value", "rows")
    )
    counts = {r.column: (r["values"], r.unread, r["unread_%"]) for r in unread_counts(rows, MATCH_PARSERS).collect()}
    assert counts["w_bpFaced"] == (2, 2, 100.0) and counts["loser_id"] == (3, 2, 66.67)
    assert counts["winner_id"] == (2, 0, 0.0) and counts["l_bpSaved"] == (0, 0, None)


def test_unread_is_what_becomes_null(spark):
    rows = matches(spark, *BAD)
    typed = with_int_break_points(rows).collect()
    for name in ("w_bpSaved", "w_bpFaced", "l_bpSaved", "l_bpFaced"):
        raw = [row[name] for row in rows.collect()]
        lost = sum(bool(value and value.strip()) and row[name] is None for value, row in zip(raw, typed))
        assert {r.column: r.unread for r in unread_counts(rows, MATCH_PARSERS).collect()}[name] == lost


def test_dates_and_typed_or_absent_columns(spark):
    rows = players(spark, ("1", "A", "A", "19810230"), ("2", "B", "B", "19810228.0"), ("3", "C", "C", "soon"), ("4", "D", "D"))
    assert sorted_rows(rejected_values(rows, PLAYER_PARSERS)) == [("dob", 1, "19810230"), ("dob", 1, "soon")]
    typed = spark.createDataFrame([(1,)], "player_id long")
    assert rejected_values(typed, PLAYER_PARSERS).collect() == []
    assert sorted_rows(unread_counts(typed, PLAYER_PARSERS)) == [("dob", 0, None, 0), ("player_id", 0, 0.0, 1)]


def test_counts_are_observed_in_the_same_pass(spark, tmp_path):
    rows, seen = observed(matches(spark, *BAD), MATCH_PARSERS)
    rows.write.parquet(str(tmp_path / "out"))
    counts = seen.get
    assert counts["rows"] == 3 and counts["w_bpFaced"] == 2 and counts["winner_id"] == 0 and counts["loser_id"] == 2


def test_a_run_reports(spark, tmp_path):
    lake = Lake(str(tmp_path))
    raw = players(spark, ("1", "A", "A", "soon"), ("1", "A", "Other", None), ("2", "B", "B", "19810228.0"))
    write_csv(raw, f"{lake.folder(Layer.BRONZE)}/atp_players.csv")
    write_csv(matches(spark, *BAD), f"{lake.folder(Layer.BRONZE)}/atp_matches_2000.csv")
    bronze_to_silver(spark, lake)
    report = {(r.table, r.finding, r.column): r.rows for r in read_table(spark, lake, Layer.SILVER, REPORT_TABLE).collect()}
    assert report["players", "read", None] == 3 and report["matches", "read", None] == 3
    assert report["players", "unread", "dob"] == 1 and report["players", "repeated", "player_id"] == 1
    assert report["matches", "unread", "w_bpFaced"] == 2 and report["matches", "unread", "winner_id"] == 0
