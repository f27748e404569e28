"""Layouts: joins without a shuffle, and lookups that pass over row groups."""

import re

import pytest
from frames import sorted_rows
from test_plans import plan_of

from rallybook.operators import levels
from rallybook.operators.joins import lookup_join
from rallybook.operators.metrics import join_break_points, join_win_loss
from rallybook.operators.names import find_ids, repair_names
from rallybook.operators.rollup import career_figures, tournament_rollup
from rallybook.operators.sides import sides
from rallybook.plans.silver import silver_matches, silver_players
from rallybook import fixtures
from rallybook.sources.layout import bucketed, write_lookup

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_figures_of_a_bucketed_rollup_are_joined_without_a_shuffle(spark, tmp_path, no_broadcast):
    rows = tournament_rollup(sides(fixtures.matches(spark, SF_DIR)), by_level=True)
    rollup = bucketed(rows, str(tmp_path / "rollup"), "player_id", 4)
    figures = career_figures(rollup)
    joined = join_win_loss(figures["losses"], figures["wins"])
    for table in (joined, levels.join_level_figures(rollup), levels.level_statistics_from(rollup)):
        plan = plan_of(table)
        assert "Exchange" not in plan and plan.count("Bucketed: true") >= 1
    assert "SortMergeJoin" in plan_of(joined) or "ShuffledHashJoin" in plan_of(joined)
    break_points = plan_of(join_break_points(figures["bp_lost"], figures["bp_won"]))
    assert "Exchange" not in break_points and break_points.count("Bucketed: true") == 2
    assert sorted_rows(levels.join_level_figures(rollup)) == sorted_rows(levels.join_level_figures(rows))
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("rallybook_buckets")] == []


def test_a_bucket_is_one_file(spark, tmp_path):
    bucketed(spark.range(0, 10_000, 1, 50).selectExpr("id % 97 as k", "id"), str(tmp_path / "t"), "k", 4)
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("part-")]) == 4


def rows_scanned(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found = re.findall(r"FileScan", plan.toString())
    assert found
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_lookup_passes_over_row_groups(spark, tmp_path):
    """By the order of the first key, and by bloom filters alone for the second, whose values lie anywhere."""
    rows = spark.range(0, 200_000, 1, 4).selectExpr(
        "concat('Player ', lpad(id, 9, '0')) as full_name", "(id * 7919) % 200003 as player_id", "md5(cast(id as string)) as rest"
    )
    path = str(tmp_path / "players")
    write_lookup(rows, path, "full_name", "player_id", row_group=1 << 18)
    table = spark.read.parquet(path)
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        named = find_ids(table, "Player 000012345", "Player 000099999")
        assert sorted(r.player_id for r in named.collect()) == sorted(x * 7919 % 200003 for x in (12345, 99999))
        assert rows_scanned(find_ids(table, "Player 000012345")) <= 20_000
        by_id = table.where("player_id = 61")
        assert rows_scanned(by_id) <= 100_000 and by_id.count() <= 1
        assert rows_scanned(table.where("full_name = 'nobody'")) <= 20_000
    finally:
        spark.conf.set(key, before)


def test_the_level_pivot_scans_the_matches_once(spark, tmp_path):
    matches = fixtures.matches(spark, SF_DIR)
    found = levels.level_pivot(matches)
    plan = plan_of(found)
    assert "lineitem" not in plan and plan.count("FileScan parquet") == 1
    assert sorted_rows(found) == sorted_rows(levels.level_pivot(matches, ["A", "D", "F", "G", "M"]))


def test_input_columns_may_have_the_names_of_helpers(spark, no_broadcast):
    players = silver_players(fixtures.players(spark, SF_DIR))
    matches = fixtures.matches(spark, SF_DIR).selectExpr(
        "*", "'a' as _salt", "'b' as _key_0", "'c' as _canonical", "'d' as _lookup_salt", "'e' as _KEY_1"
    )
    repaired = silver_matches(matches, players)
    assert repaired.columns == matches.columns
    row = repaired.first()
    assert (row._salt, row._key_0, row._canonical, row._lookup_salt, row["_KEY_1"]) == ("a", "b", "c", "d", "e")
    assert repaired.count() == matches.count() == repair_names(repaired, players).count()
    looked_up = lookup_join(spark.range(3).selectExpr("id", "id as _key_0"), spark.range(2).selectExpr("id as k", "id as v"), ["id"], ["id"], 2)
    assert sorted_rows(looked_up) == sorted([(0, 0, 0), (1, 1, 1), (2, 2, None)], key=repr)
