import datetime

import pytest
from frames import by_player, matches, players, sorted_rows
from pyspark.sql import functions as F

from rallybook.operators import names
from rallybook.plans.silver import (
    backfill_names,
    silver_matches,
    silver_matches_by,
    silver_players,
)
from rallybook.schemas import PLAYERS_SILVER


def test_players(spark):
    raw = players(
        spark,
        ("1.0", "Ann", "Bee", "19810808.0"),
        ("1", "Ann", "Bee", "19810808"),
        ("2", None, "Cee"),
        ("3", "Dee", None),
        ("4", "Eff", "Gee", "19000000"),
    )
    found = silver_players(raw)
    assert [(f.name, f.dataType) for f in found.schema] == [
        (f.name, f.dataType) for f in PLAYERS_SILVER
    ]
    assert by_player(found) == {
        1: dict(player_id=1, name_first="Ann", name_last="Bee", dob=datetime.date(1981, 8, 8),
                country="ARG", full_name="Ann Bee"),
        4: dict(player_id=4, name_first="Eff", name_last="Gee", dob=None,
                country="ARG", full_name="Eff Gee"),
    }


def test_other_player_columns_pass_through(spark):
    raw = players(spark, ("1", "Ann", "Bee")).withColumn("hand", F.lit("R"))
    assert silver_players(raw).first().hand == "R"


@pytest.fixture(params=[True, False], ids=["broadcast", "salted"])
def either_join(spark, request):
    """Both ways of joining names: small enough to broadcast, and not."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    if not request.param:
        spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_match_names_and_ids(spark, either_join):
    named = silver_players(players(spark, ("1", "Ann", "Bee"), ("2", "Cee", "Dee")))
    raw = matches(
        spark,
        dict(w="1.0", winner_name="Ann-Bee", l="2", loser_name="Cee Dee"),
        dict(w="2", winner_name=None, l="7", loser_name="Un Known"),
        dict(w=None, winner_name="No Id", l="1", loser_name="A. Bee"),
    )
    found = silver_matches(raw, named)
    assert found.columns == raw.columns
    corrections = names.name_corrections(raw, named)
    assert sorted_rows(corrections.select("full_name", "name", "player_id")) == [
        ("Ann Bee", "A. Bee", 1),
        ("Ann Bee", "Ann-Bee", 1),
    ]
    corrected = silver_matches_by(raw, corrections)
    assert corrected.columns == raw.columns
    assert sorted_rows(corrected) == sorted_rows(found)
    picked = found.select("winner_id", "winner_name", "loser_id", "loser_name")
    assert sorted(map(tuple, picked.collect()), key=repr) == sorted(
        [
            (1, "Ann Bee", 2, "Cee Dee"),
            (2, None, 7, "Un Known"),
            (None, "No Id", 1, "Ann Bee"),
        ],
        key=repr,
    )


def test_two_names_for_an_id_do_not_repeat_matches(spark, either_join):
    named = silver_players(players(spark, ("7", "X", "Y"), ("7", "X-Y", "Z")))
    raw = matches(spark, dict(w="7", winner_name="X.Y", l="8"), dict(w="8", l="7", loser_name="q"))
    found = silver_matches(raw, named)
    assert found.count() == 2
    assert found.where("winner_id = 7").first().winner_name == "X Y"
    assert [tuple(r) for r in names.repeated_ids(named).collect()] == [(7, 2)]
    with pytest.raises(ValueError, match="not unique"):
        names.assert_unique_ids(named)
    names.assert_unique_ids(named.limit(1))


def candidates_by_joins(named, raw):
    """The same table the long way: all spellings joined, respelled, and made distinct."""
    def side(which):
        return raw.select(
            F.col(f"{which}_id").cast("bigint").alias(f"{which}_id"), f"{which}_name"
        ).distinct()

    full = named
    for which in ("winner", "loser"):
        names_of = side(which)
        full = full.join(names_of, F.col("player_id") == F.col(f"{which}_id"), "left")
        name = F.col(f"{which}_name")
        full = full.withColumn(
            f"{which}_name", F.when(F.col("full_name") != name, F.col("full_name")).otherwise(name)
        )
    return full.dropDuplicates()


def test_name_candidates_equal_the_join_of_all_spellings(spark, either_join):
    named = silver_players(
        players(spark, ("1", "Ann", "Bee"), ("1", "An", "Bee"), ("2", "Cee", "Dee"), ("3", "E", "F"))
    )
    raw = matches(
        spark,
        dict(w="1", winner_name=None, l="2", loser_name="Cee-Dee"),
        dict(w="1", winner_name="Ann Bee", l="2", loser_name=None),
        dict(w="1", winner_name="Ann-Bee", l="2", loser_name="Cee Dee"),
        dict(w="2", winner_name="C Dee", l="1", loser_name="A"),
        dict(w="9", winner_name="Z", l="1", loser_name="B"),
    )
    found = names.name_candidates(named, raw)
    expected = candidates_by_joins(named, raw)
    assert found.columns == expected.columns
    assert sorted_rows(found) == sorted_rows(expected)
    assert found.where("player_id = 1").count() == 4


def test_null_and_known_name_leave_one_silver_row(spark):
    raw_players = players(spark, ("1", "Ann", "Bee"))
    raw = matches(spark, dict(w="1", l="2"), dict(w="1", winner_name="Ann Bee", l="2"))
    named = silver_players(raw_players)
    assert names.name_candidates(named, raw).count() == 2
    assert named.count() == 1
    assert silver_matches(raw, named).count() == 2


def test_distinct_names(spark):
    raw = matches(
        spark,
        dict(w="1", winner_name="A", l="2", loser_name="B"),
        dict(w="1", winner_name="A", l="2", loser_name="C"),
    )
    assert sorted_rows(names.distinct_names(raw).select("player_id", "name", "won")) == sorted(
        [("A", 1, True), ("B", 2, False), ("C", 2, False)], key=repr
    )


def test_backfill(spark, either_join):
    raw_players = players(
        spark,
        ("1", None, "del Potro"),
        ("2", "Ann", None),
        ("3", None, None),
        ("4", None, "Other"),
        ("5", None, None),
        ("6", None, "Never Played"),
        ("7", "Kept", "Name"),
    )
    raw = matches(
        spark,
        dict(w="1", winner_name="Juan Martin del Potro", l="2", loser_name="Ann Van Bee"),
        dict(w="3", winner_name="Cee Dee Eff", l="4", loser_name="Gee Aitch"),
        dict(w="5", winner_name="Mononym", l="7", loser_name="Something Else"),
        dict(w="3", winner_name="Zed Last", l="5", loser_name=None),
    )
    found = {r.player_id: r.full_name for r in backfill_names(raw_players, raw).collect()}
    assert found == {
        1: "Juan Martin del Potro",
        2: "Ann Van Bee",
        3: "Cee Dee Eff",
        4: "Gee Other",
        7: "Kept Name",
    }


def test_find_ids(spark):
    named = silver_players(players(spark, ("1", "Ann", "Bee"), ("2", "Cee", "Dee"), ("3", "E", "F")))
    found = names.find_ids(named, "Ann Bee", "E F", "No One")
    assert found.columns == ["player_id"]
    assert sorted(r[0] for r in found.collect()) == [1, 3]
