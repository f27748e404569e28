"""Files that keep arriving: each is taken once, whatever fails in between."""

import pytest
from frames import sorted_rows
from test_update import matches_of, put

from rallybook.operators.rollup import career_statistics, over_levels, tournament_rollup
from rallybook.operators.sides import sides
from rallybook.plans.silver import with_typed_ids
from rallybook.sources.tables import Lake, read_csv
from rallybook.streaming import arrivals
from rallybook.streaming.arrivals import arrived_counts, arrived_matches, arrivals_path, take_arrivals


@pytest.fixture
def folder(tmp_path):
    put(tmp_path / "in" / "atp_matches_2000.csv", matches_of(2000))
    put(tmp_path / "in" / "nested" / "atp_matches_2001.csv", matches_of(2001))
    return tmp_path / "in"


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def batch_counts(spark, *paths):
    rows = read_csv(spark, [str(p) for p in paths])
    return sorted_rows(tournament_rollup(sides(with_typed_ids(rows)), by_level=True))


def test_two_runs_equal_one_batch(spark, folder, lake):
    assert take_arrivals(spark, str(folder), lake) == 1
    first = [folder / "atp_matches_2000.csv", folder / "nested" / "atp_matches_2001.csv"]
    assert sorted_rows(arrived_counts(spark, lake)) == batch_counts(spark, *first)
    assert take_arrivals(spark, str(folder), lake) == 0
    put(folder / "atp_matches_2002.csv", matches_of(2002))
    assert take_arrivals(spark, str(folder), lake) == 1
    every = [*first, folder / "atp_matches_2002.csv"]
    assert sorted_rows(arrived_counts(spark, lake)) == batch_counts(spark, *every)
    matches = arrived_matches(spark, lake)
    assert sorted_rows(matches.drop("path", "year")) == sorted_rows(read_csv(spark, [str(p) for p in every]))
    assert {r.year for r in matches.collect()} == {2000, 2001, 2002}
    found = career_statistics(over_levels(arrived_counts(spark, lake)))
    assert found.count() == 4


def test_a_batch_that_failed_counts_once(spark, folder, lake, monkeypatch):
    """It dies after its matches are written and is repeated with the same number."""
    count, calls = arrivals.tournament_rollup, []

    def dies_once(*args, **options):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("killed")
        return count(*args, **options)

    monkeypatch.setattr(arrivals, "tournament_rollup", dies_once)
    with pytest.raises(Exception, match="killed"):
        take_arrivals(spark, str(folder), lake)
    with pytest.raises(ValueError, match="nothing has arrived"):
        arrived_counts(spark, lake)
    put(folder / "atp_matches_2002.csv", matches_of(2002))
    take_arrivals(spark, str(folder), lake)
    every = [folder / "atp_matches_2000.csv", folder / "nested" / "atp_matches_2001.csv", folder / "atp_matches_2002.csv"]
    assert sorted_rows(arrived_counts(spark, lake)) == batch_counts(spark, *every)
    assert arrived_matches(spark, lake).count() == 36


def test_files_in_several_batches_with_other_columns_and_line_breaks(spark, folder, lake):
    text = matches_of(2003).splitlines()
    wider = "\n".join([text[0] + ",note", *(line + ',"two\nlines"' for line in text[1:])]) + "\n"
    put(folder / "atp_matches_2003.csv", wider)
    assert take_arrivals(spark, str(folder), lake, files_per_batch=1) == 3
    matches = arrived_matches(spark, lake)
    assert sorted((r.year, r.note) for r in matches.collect()) == sorted(
        [(y, None) for y in (2000, 2001) for _ in range(12)] + [(2003, "two\nlines")] * 12, key=str
    )
    plain = put(folder.parent / "plain.csv", matches_of(2003)) or folder.parent / "plain.csv"
    every = [folder / "atp_matches_2000.csv", folder / "nested" / "atp_matches_2001.csv", plain]
    assert sorted_rows(arrived_counts(spark, lake)) == batch_counts(spark, *every)


def test_nothing_has_arrived(spark, tmp_path, lake):
    (tmp_path / "none").mkdir()
    assert take_arrivals(spark, str(tmp_path / "none"), lake) == 0
    with pytest.raises(ValueError, match="nothing has arrived"):
        arrived_matches(spark, lake)
    assert arrivals_path(lake, "counts").endswith("/lake/arrivals/counts")
