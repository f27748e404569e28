"""Career and level figures on hand-made matches, one case per rule."""

import pytest
from frames import by_player, joined_career, joined_level, matches, players, sorted_rows

from rallybook.operators import levels, metrics
from rallybook.operators.rollup import career_statistics, over_levels, tournament_rollup
from rallybook.operators.sides import at_level, finals_rows, sides
from rallybook.plans.gold import player_statistics
from rallybook.plans.silver import silver_players


@pytest.fixture
def only_wins(spark):
    return matches(spark, {"w": "1", "l": "2"}, {"w": "1", "l": "2", "round": "SF"})


@pytest.fixture
def two_finals(spark):
    final = {"w": "1", "l": "2", "round": "F", "tourney_level": "G"}
    return matches(spark, final, final, {"w": "2", "l": "1", "tourney_level": "G"})


def test_one_sided_players_have_no_rate(only_wins):
    found = by_player(metrics.win_loss(only_wins))
    assert found[1] == {
        "player_id": 1, "matches_lost": None, "matches_won": 2, "matches_played": None, "win_%": None
    }
    assert found[2]["matches_lost"] == 2 and found[2]["matches_won"] is None
    assert found == by_player(
        metrics.join_win_loss(metrics.losses(only_wins), metrics.wins(only_wins))
    )


def test_zero_fill_counts_what_is_missing(spark, only_wins):
    found = by_player(metrics.win_loss(only_wins, zero_fill=True))
    assert (found[1]["matches_lost"], found[1]["win_%"]) == (0, 100.0)
    assert (found[2]["matches_won"], found[2]["win_%"]) == (0, 0.0)
    named = silver_players(players(spark, ("1", "A", "B"), ("3", "C", "D")))
    table = by_player(player_statistics(named, only_wins, zero_fill=True))
    assert (table[1]["win_%"], table[1]["finals_played_%"]) == (100.0, 0.0)
    assert (table[3]["matches_played"], table[3]["tournaments_played"]) == (0, 0)
    assert table[3]["win_%"] is None


def test_no_final_gives_null(spark, only_wins):
    named = silver_players(players(spark, ("1", "A", "B"), ("2", "C", "D"), ("3", "E", "F")))
    found = by_player(player_statistics(named, only_wins))
    assert found[1]["finals_played"] is None and found[1]["finals_win_%"] is None
    assert found[1]["tournaments_played"] == 1
    assert found[3]["matches_won"] is None and found[3]["tournaments_played"] is None


def test_key_of_break_points(spark):
    one = matches(
        spark,
        {"w": "1", "l": "2", "w_bpSaved": "1", "w_bpFaced": "2", "l_bpSaved": "3", "l_bpFaced": "4"},
    )
    lost, won = metrics.break_points_saved_lost(one), metrics.break_points_saved_won(one)
    found = by_player(metrics.join_break_points(lost, won))
    assert found[2]["carrer_losses_bp_saved_%"] == 75.0
    assert found[2]["carrer_avg_bp_saved_%"] is None
    assert found == by_player(metrics.break_points_career(one))
    assert set(by_player(metrics.join_break_points(lost, won, won_key_only=True))) == {1, None}


def test_no_break_points_faced(spark):
    one = matches(spark, {"w": "1", "l": "2", "w_bpSaved": "0", "w_bpFaced": "0"})
    found = by_player(metrics.break_points_saved_won(one))
    assert found == {1: {"player_id": 1, "carrer_wins_bp_saved_%": None}}


def test_break_point_sums_ignore_their_own_nulls(spark):
    two = matches(
        spark,
        {"w": "1", "l": "2", "w_bpFaced": "4.0"},
        {"w": "1", "l": "2", "w_bpSaved": "3.0"},
    )
    assert by_player(metrics.break_points_saved_won(two))[1]["carrer_wins_bp_saved_%"] == 75.0
    assert by_player(metrics.break_points_career(two))[1]["carrer_wins_bp_saved_%"] == 75.0


def test_finals_are_distinct_but_level_titles_are_rows(spark, two_finals):
    assert by_player(metrics.finals_won(two_finals))[1]["finals_won"] == 1
    assert by_player(levels.level_won(two_finals))[1]["gs_won"] == 2
    found = by_player(levels.level_statistics(two_finals))
    assert found[1] == {
        "player_id": 1, "gs_played": 1, "gs_won": 2, "gs_matches_played": 3, "gs_matches_won": 2,
        "gs_win_%": 200.0, "gs_matches_win_%": 66.67,
    }
    assert found[2]["gs_won"] is None and found[2]["gs_win_%"] is None
    assert found == by_player(joined_level(two_finals))
    assert sorted_rows(finals_rows(two_finals)) == [(1, "t1"), (2, "t1")]


def test_rows_without_a_player_are_left_out(spark):
    one = matches(spark, {"w": None, "l": "2", "tourney_level": "G"}, {"w": "x", "l": "2"})
    assert set(by_player(metrics.win_loss(one))) == {2}
    assert set(by_player(metrics.wins(one))) == set()
    assert set(by_player(levels.level_statistics(one))) == {2}


def test_a_tournament_without_an_id_counts_as_matches_only(spark):
    some = matches(
        spark,
        {"w": "1", "l": "2", "tourney_id": None, "round": "F", "tourney_level": "G"},
        {"w": "1", "l": "2", "tourney_level": "G"},
    )
    assert by_player(metrics.tournaments_played(some))[1]["tournaments_played"] == 1
    found = by_player(career_statistics(tournament_rollup(sides(some))))[1]
    assert (found["tournaments_played"], found["finals_played"], found["finals_won"]) == (1, 0, 0)
    assert found["matches_won"] == 2
    assert by_player(metrics.finals_played(some))[1]["finals_played"] == 0
    assert by_player(levels.level_statistics(some)) == by_player(joined_level(some))


def test_other_levels_and_their_names(spark):
    some = matches(
        spark,
        {"w": "1", "l": "2", "tourney_level": "M", "round": "F"},
        {"w": "1", "l": "2", "tourney_level": "D"},
    )
    masters = by_player(levels.level_statistics(some, levels.MASTERS))[1]
    assert masters["masters_1000_played"] == 1 and masters["masters_1000_win_%"] == 100.0
    assert masters["masters_1000_matches_played"] == 1
    davis = by_player(levels.level_statistics(some, levels.DAVIS))[1]
    assert davis["davis_cup_played"] == 1 and davis["davis_win_%"] is None
    assert by_player(joined_level(some, levels.MASTERS))[1] == masters


def test_loss_rates_and_pivot(spark):
    some = matches(
        spark,
        {"w": "1", "l": "2", "tourney_level": "G"},
        {"w": "2", "l": "1", "tourney_level": "A"},
        {"w": "2", "l": "1", "tourney_level": "M"},
        {"w": "3", "l": "1"},
    )
    rates = by_player(levels.loss_rates(some))
    assert rates[1]["loss_%"] == 75.0 and rates[1]["gs_matches_lost"] is None
    assert rates[2]["gs_matches_lost"] == 1
    assert rates[3]["loss_%"] is None
    pivot = by_player(levels.level_pivot(some))
    assert pivot[2]["matches_lost_G"] == 1 and pivot[2]["matches_won_M"] == 1
    assert pivot[1]["matches_lost_A"] == 2 and pivot[3]["matches_won_A"] == 1
    assert sum(v for row in pivot.values() for k, v in row.items() if k != "player_id") == 2 * some.count()


def test_pivot_of_given_levels_and_of_too_many(spark):
    some = matches(spark, *[{"w": "1", "l": "2", "tourney_level": f"L{i}"} for i in range(101)])
    assert by_player(levels.level_pivot(some, ["L7"]))[1]["matches_won_L7"] == 1
    with pytest.raises(ValueError, match="more than"):
        levels.level_pivot(some)
    assert levels.level_pivot(some.limit(0)).count() == 0


def test_a_rollup_by_level_gives_the_same_figures(spark):
    some = matches(
        spark,
        {"w": "1", "l": "2", "tourney_level": "G", "round": "F", "w_bpFaced": "3", "w_bpSaved": "1"},
        {"w": "1", "l": "2", "tourney_level": "M", "round": "F"},
        {"w": "2", "l": "1", "tourney_id": "t2", "tourney_level": "M"},
        {"w": "2", "l": "1", "tourney_id": None, "tourney_level": None, "l_bpFaced": "2", "l_bpSaved": "1"},
    )
    long = sides(some)
    coarse, fine = tournament_rollup(long), tournament_rollup(long, by_level=True)
    assert sorted_rows(career_statistics(over_levels(fine))) == sorted_rows(career_statistics(coarse))
    masters = levels.level_statistics_from(fine.where("tourney_level = 'M'"), levels.MASTERS)
    assert sorted_rows(masters) == sorted_rows(levels.level_statistics(some, levels.MASTERS))
    assert at_level(some, "M").count() == 2


def test_fused_and_joined_tables_agree(spark, two_finals):
    named = silver_players(players(spark, ("1", "A", "B"), ("2", "C", "D"), ("9", "E", "F")))
    fused = player_statistics(named, two_finals)
    joined = joined_career(named, two_finals)
    assert fused.columns == joined.columns
    assert sorted_rows(fused) == sorted_rows(joined)
