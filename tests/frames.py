"""Small frames for the tests: matches by keyword, everything else NULL or plain."""

from rallybook.operators import levels
from rallybook.operators.rollup import tournament_rollup
from rallybook.operators.sides import sides
from rallybook.plans.gold import join_player_statistics
from rallybook.schemas import MATCHES_BRONZE, PLAYERS_BRONZE

PLAIN = {"tourney_id": "t1", "tourney_level": "A", "round": "R32"}



def matches(spark, *rows):
    """Rows are dicts; `w` and `l` stand for the two ids."""
    full = []
    for row in rows:
        row = dict(row)
        given = {**PLAIN, "winner_id": row.pop("w", None), "loser_id": row.pop("l", None), **row}
        full.append(tuple(given.get(name) for name in MATCHES_BRONZE.names))
    return spark.createDataFrame(full, MATCHES_BRONZE)


def players(spark, *rows):
    """Rows are (id, first, last) or (id, first, last, dob)."""
    full = [(r[0], r[1], r[2], r[3] if len(r) > 3 else None, "ARG", "Q1") for r in rows]
    return spark.createDataFrame(full, PLAYERS_BRONZE)


def by_player(df):
    """The rows as dicts by player id; fails if an id comes twice."""
    rows = [row.asDict() for row in df.collect()]
    found = {row["player_id"]: row for row in rows}
    assert len(found) == len(rows)
    return found


def sorted_rows(df):
    columns = sorted(df.columns)
    return sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)


def joined_level(rows, names=levels.GS):
    return levels.join_level_figures(tournament_rollup(sides(rows), by_level=True), names)


def joined_career(named, rows):
    return join_player_statistics(named, tournament_rollup(sides(rows)))
