"""What must not grow faster than the input: rows shuffled for names, sorts before folders, shuffles of the rollup."""

import pytest
from frames import matches as frame, players as named_players, sorted_rows
from pyspark.sql import functions as F

from rallybook.operators.levels import level_pivot_from
from rallybook.operators.names import correct_names, correction_digest, marked
from rallybook.operators.rollup import added_up, over_levels, tournament_rollup
from rallybook.operators.sides import sides
from rallybook.plans import update
from rallybook.plans.pipeline import bronze_to_silver
from rallybook.sources import tables
from rallybook.sources.layout import bucketed
from rallybook.sources.parallel import FOLDERS_SETTING, folders_at_once
from rallybook.sources.tables import Lake, Layer, of_source, read_csv, read_table, write_csv, write_table


def named_matches(spark, folder):
    """20,000 matches, the names of one player in 50 spelled wrongly, some ids or names missing."""
    rows = spark.range(20000).selectExpr(
        "if(id % 101 = 0, null, id % 2000) as winner_id",
        "case when id % 89 = 0 then null when id % 50 = 7 then 'x' || id % 2000 else 'P' || id % 2000 end as winner_name",
        "id * 7 % 1999 as loser_id",
        "if(id * 7 % 1999 % 50 = 9, 'y', 'P' || id * 7 % 1999) as loser_name",
        "'t' || id % 9 as tourney_id", "'R32' as round", "2000 + id % 3 as year",
    )
    rows.write.parquet(f"{folder}/matches")
    pairs = spark.range(2000).selectExpr("id as player_id", "explode(array('x' || id, 'y')) as name", "'P' || id as full_name")
    pairs.where("player_id % 50 in (7, 9)").write.parquet(f"{folder}/corrections")
    return spark.read.parquet(f"{folder}/matches"), spark.read.parquet(f"{folder}/corrections")


def test_only_matches_that_may_need_a_correction_are_shuffled(spark, tmp_path):
    matches, corrections = named_matches(spark, str(tmp_path))
    expected = sorted_rows(correct_names(matches, corrections))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        assert sorted_rows(correct_names(matches, corrections)) == expected
        found = marked(matches, corrections, "mark")
        wrong = F.expr("winner_name like 'x%' and winner_id is not null or loser_name = 'y'")
        counts = found.agg(F.count_if("mark").alias("marked"), F.count_if(wrong & ~F.col("mark")).alias("lost")).first()
        assert counts.lost == 0 and counts.marked < 3000
        digest, blocks = correction_digest(corrections)
        assert digest.count() == blocks and {len(r.digest_words) for r in digest.collect()} == {512}
        none = corrections.limit(0)
        assert correct_names(matches, none).count() == 20000
    finally:
        spark.conf.set(key, before)


def test_rows_are_not_sorted_to_be_written_in_folders(spark, tmp_path):
    lake, rows = Lake(str(tmp_path)), spark.range(0, 1000, 1, 4).selectExpr("id", "id % 5 as year")
    before = spark.conf.get(FOLDERS_SETTING)
    with folders_at_once(spark):
        with folders_at_once(spark):
            assert int(spark.conf.get(FOLDERS_SETTING)) > 1
        assert int(spark.conf.get(FOLDERS_SETTING)) > 1
    assert spark.conf.get(FOLDERS_SETTING) == before
    for fmt in ("parquet", "versioned"):
        write_table(rows, lake, Layer.GOLD, fmt, fmt, "year")
        assert sorted_rows(read_table(spark, lake, Layer.GOLD, fmt, fmt).select("id", "year")) == sorted_rows(rows)
    assert spark.conf.get(FOLDERS_SETTING) == before


def test_packed_csv_holds_the_same_rows(spark, tmp_path):
    rows = spark.createDataFrame([("a", ' "q", x'), ("b\nc", "d"), (None, "e")], "a string, b string")
    for packed in (False, True):
        write_csv(rows, f"{tmp_path}/{packed}.csv", packed=packed)
        assert sorted_rows(read_csv(spark, f"{tmp_path}/{packed}.csv")) == sorted_rows(rows)
    assert all(p.suffix == ".gz" for p in (tmp_path / "True.csv").glob("part-*"))
    # A line break is still noticed in the pass that writes.
    for value, marked_free in (("x\ry", False), ("x\ny", False), ("xy", True)):
        write_csv(spark.createDataFrame([(value,)], "a string"), f"{tmp_path}/one.csv")
        assert (tmp_path / "one.csv" / "_one_line").exists() == marked_free


def test_tables_from_a_stored_rollup_do_not_shuffle_it(spark, tmp_path):
    rows = [{"w": 1 + i % 3, "l": 1 + (i + 1) % 3, "tourney_id": f"t{i % 4}", "tourney_level": "AG"[i % 2]} for i in range(30)]
    rollup = tournament_rollup(sides(frame(spark, *rows)), by_level=True)
    for _ in range(2):  # the second replaces the first
        stored = bucketed(rollup, f"{tmp_path}/rollup", "player_id")
        assert sorted_rows(stored.select(*rollup.columns)) == sorted_rows(rollup)
    for table in (over_levels(stored), level_pivot_from(stored, ["A", "G"])):
        assert "Exchange" not in table._jdf.queryExecution().executedPlan().toString()


def test_counts_of_years_are_added_up_in_one_shuffle(spark, tmp_path):
    rows = [{"w": 1 + i % 3, "l": 1 + (i + 1) % 3, "tourney_id": f"t{i % 4}", "tourney_level": "AG"[i % 2]} for i in range(30)]
    rollup = tournament_rollup(sides(frame(spark, *rows)), by_level=True)
    counts = added_up(rollup.union(rollup).repartition(4, "player_id"))
    stored = bucketed(counts, f"{tmp_path}/rollup", "player_id", 4, arranged=True)
    assert sorted_rows(stored.select(*counts.columns)) == sorted_rows(added_up(rollup.union(rollup)))
    # Not more files than buckets, and what is read needs no exchange.
    assert len(list((tmp_path / "rollup").glob("part-*"))) <= 4
    assert "Exchange" not in over_levels(stored)._jdf.queryExecution().executedPlan().toString()


def test_only_the_daily_run_s_tables_stay_in_its_lake(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "atp_players.csv").write_text("player_id,name_first,name_last,dob,ioc,wikidata_id\n1,A,A,19810808,ARG,Q1\n")
    header = "tourney_id,tourney_level,round,winner_id,winner_name,loser_id,loser_name,w_bpSaved,w_bpFaced,l_bpSaved,l_bpFaced"
    (raw / "atp_matches_2001.csv").write_text(f"{header}\nt,G,F,1,A A,2,B B,1,2,3,4\n")
    manifest = spark.createDataFrame([(p.name, str(p)) for p in raw.iterdir()], "name string, path string")
    lake, asked = Lake(str(tmp_path / "lake")), []

    def once(*args, **kwargs):
        asked.append(args[1])
        return bucketed(*args, **kwargs)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(update, "bucketed", once)
        update.update_lake(spark, manifest, lake)
    assert len(asked) == 1 and "rallybook-" in asked[0]
    assert list((tmp_path / "lake" / "scratch").iterdir()) == []


def test_headers_are_found_without_sorting_the_lines(spark, tmp_path, monkeypatch):
    write_csv(spark.range(0, 4000, 1, 3).selectExpr("id as b", "id as a"), f"{tmp_path}/x.csv")
    (tmp_path / "y.csv").write_text("a,c\n0,1\n")
    plans = []

    def spied(files, paths):
        plans.append(files._jdf.queryExecution().executedPlan().toString())
        return of_source(files, paths)

    monkeypatch.setattr(tables, "of_source", spied)
    paths = [f"{tmp_path}/x.csv", f"{tmp_path}/y.csv"]
    assert tables.headers(spark, paths, set()) == {("b", "a"): paths[:1], ("a", "c"): paths[1:]}
    assert plans and not any("Sort" in plan for plan in plans)


@pytest.mark.parametrize("name", ["A A", "wrong"])
def test_a_run_counts_each_match_once_when_its_rows_are_read_twice(spark, tmp_path, name):
    lake, key = Lake(str(tmp_path)), "spark.sql.autoBroadcastJoinThreshold"
    bronze = lake.folder(Layer.BRONZE)
    write_csv(named_players(spark, ("1", "A", "A"), ("2", "B", "B")), f"{bronze}/atp_players.csv")
    rows = [{"w": "1", "l": "2", "winner_name": name if i == 0 else "A A", "loser_name": "B B", "w_bpFaced": "x"} for i in range(5)]
    write_csv(frame(spark, *rows), f"{bronze}/atp_matches_2000.csv")
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        bronze_to_silver(spark, lake)
    finally:
        spark.conf.set(key, before)
    report = read_table(spark, lake, Layer.SILVER, "df_run_report").where("table = 'matches'").collect()
    counts = {(r.finding, r.column): r.rows for r in report}
    assert counts["read", None] == 5 and counts["unread", "w_bpFaced"] == 5
    silver = read_table(spark, lake, Layer.SILVER, "df_matches")
    assert [r.winner_name for r in silver.collect()] == ["A A"] * 5
