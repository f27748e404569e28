"""Generated matches: the tables against plain Python, and against each other."""

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from frames import by_player, joined_career, joined_level, matches, players, sorted_rows
from hypothesis import HealthCheck, given, settings, strategies as st

from rallybook.operators import levels, metrics
from rallybook.plans.gold import player_statistics
from rallybook.plans.silver import silver_players

PLAYERS = range(1, 6)
POINTS = st.one_of(st.none(), st.integers(0, 9).map(str), st.integers(0, 9).map("{}.0".format))

MATCH = st.fixed_dictionaries(
    {
        "ids": st.permutations(PLAYERS).map(lambda p: p[:2]),
        "tourney_id": st.sampled_from(["a", "b", "c", None]),
        "tourney_level": st.sampled_from(["G", "M", "D", "F", "A", None]),
        "round": st.sampled_from(["F", "SF", "R32", None]),
        "w_bpSaved": POINTS,
        "w_bpFaced": POINTS,
        "l_bpSaved": POINTS,
        "l_bpFaced": POINTS,
    }
)
SOME_MATCHES = st.lists(MATCH, min_size=1, max_size=25)
FEW = settings(
    max_examples=6,
    deadline=None,
    derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)


def frame(spark, generated):
    rows = [
        {**{k: v for k, v in m.items() if k != "ids"}, "w": str(m["ids"][0]), "l": f"{m['ids'][1]}.0"}
        for m in generated
    ]
    return matches(spark, *rows)


def named(spark):
    return silver_players(players(spark, *[(str(i), "P", str(i)) for i in PLAYERS]))


def percent(a, b):
    if a is None or not b:
        return None
    exact = Decimal(repr(a / b * 100))
    return float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))


def total(values):
    known = [int(float(v)) for v in values if v is not None]
    return sum(known) if known else None


def career(generated, player):
    won = [m for m in generated if m["ids"][0] == player]
    lost = [m for m in generated if m["ids"][1] == player]
    both = won + lost

    def tournaments(rows):
        return len({m["tourney_id"] for m in rows} - {None}) if rows else None

    final = [m for m in both if m["round"] == "F"]
    found = {
        "matches_lost": len(lost) or None,
        "matches_won": len(won) or None,
        "matches_played": len(both) if won and lost else None,
        "finals_played": tournaments(final),
        "finals_won": tournaments([m for m in won if m["round"] == "F"]),
        "tournaments_played": tournaments(both),
    }
    found["win_%"] = percent(found["matches_won"], found["matches_played"])
    losses = percent(total(m["l_bpSaved"] for m in lost), total(m["l_bpFaced"] for m in lost))
    wins = percent(total(m["w_bpSaved"] for m in won), total(m["w_bpFaced"] for m in won))
    found["carrer_losses_bp_saved_%"], found["carrer_wins_bp_saved_%"] = losses, wins
    mean = None
    if losses is not None and wins is not None:
        exact = (Decimal(str(losses)) + Decimal(str(wins))) / 2
        mean = float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))
    found["carrer_avg_bp_saved_%"] = mean
    found["finals_played_%"] = percent(found["finals_played"], found["tournaments_played"])
    found["finals_win_%"] = percent(found["finals_won"], found["finals_played"])
    found["tournament_win_%"] = percent(found["finals_won"], found["tournaments_played"])
    return found


@FEW
@given(SOME_MATCHES)
def test_player_statistics(spark, generated):
    rows = frame(spark, generated)
    fused = player_statistics(named(spark), rows)
    found = by_player(fused)
    for player in PLAYERS:
        expected = career(generated, player)
        assert {k: found[player][k] for k in expected} == expected
    assert sorted_rows(joined_career(named(spark), rows)) == sorted_rows(fused)


@FEW
@given(SOME_MATCHES, st.sampled_from([levels.GS, levels.MASTERS, levels.DAVIS]))
def test_level_statistics(spark, generated, names):
    rows = frame(spark, generated)
    here = [m for m in generated if m["tourney_level"] == names.level]
    expected = {}
    for player in {i for m in here for i in m["ids"]}:
        won = [m for m in here if m["ids"][0] == player]
        both = [m for m in here if player in m["ids"]]
        played = len({m["tourney_id"] for m in both} - {None})
        titles = len([m for m in won if m["round"] == "F"]) or None
        expected[player] = {
            "player_id": player,
            names.played: played,
            names.won: titles,
            names.matches_played: len(both),
            names.matches_won: len(won) or None,
            names.win_rate: percent(titles, played),
            names.matches_win_rate: percent(len(won) or None, len(both)),
        }
    assert by_player(levels.level_statistics(rows, names)) == expected
    assert by_player(joined_level(rows, names)) == expected


@FEW
@given(SOME_MATCHES)
def test_counts_add_up_and_layout_does_not_matter(spark, generated):
    rows = frame(spark, generated)
    counts = by_player(metrics.win_loss(rows, zero_fill=True))
    assert sum(c["matches_won"] for c in counts.values()) == len(generated)
    assert sum(c["matches_lost"] for c in counts.values()) == len(generated)
    assert all(0 <= c["win_%"] <= 100 for c in counts.values())
    pivot = by_player(levels.level_pivot(rows, ("G", "M", "D", "F", "A")))
    by_level = defaultdict(int)
    for m in generated:
        by_level[m["tourney_level"]] += 1
    for level in "GMDFA":
        assert sum(p[f"matches_won_{level}"] for p in pivot.values()) == by_level[level]
    turned = frame(spark, list(reversed(generated))).repartition(5)
    assert sorted_rows(metrics.win_loss(turned)) == sorted_rows(metrics.win_loss(rows))
    assert sorted_rows(metrics.finals_played(turned)) == sorted_rows(metrics.finals_played(rows))
