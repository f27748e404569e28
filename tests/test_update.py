"""The daily run: what is landed again, what is built again, and what a dying run leaves."""

import os

import pytest
from frames import sorted_rows
from pyspark.sql import functions as F

from rallybook.plans import update
from rallybook.plans.pipeline import run_pipeline
from rallybook.plans.update import update_lake
from rallybook.sources.landing import landed_sources
from rallybook.sources.ledger import fingerprints, land_changed, ledger_path, read_ledger
from rallybook.sources.tables import Lake, Layer, of_source, read_table
from rallybook.sources.versions import versions

GOLD = ("df_players", "df_matches", "df_player_statistics", "df_level_pivot", "df_gs_statistics",
        "df_masters_statistics", "df_davis_statistics")
MATCH_HEADER = "tourney_id,tourney_level,round,winner_id,winner_name,loser_id,loser_name,w_bpSaved,w_bpFaced,l_bpSaved,l_bpFaced"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def matches_of(year, count=12, wrong="A-A"):
    lines = [MATCH_HEADER]
    for i in range(count):
        a, b = 1 + (i + year) % 4, 1 + (i * 2 + year + 1) % 4
        names = {1: wrong if i % 2 else "A A", 2: "B B", 3: "C C", 4: ""}
        lines.append(f"{year}-{i % 3},{'GMDFA'[i % 5]},{'F' if i % 4 == 0 else 'R32'},{a},{names[a]},{b},{names[b]},{i % 5},{i % 5 + 1},{i % 3},4")
    return "\n".join(lines) + "\n"


PLAYERS = "player_id,name_first,name_last,dob,ioc,wikidata_id\n1,A,A,19810808,ARG,Q1\n2,B,B,19810808.0,ESP,Q2\n3,C,C,,FRA,Q3\n4,D,D,x,USA,\n"


@pytest.fixture
def raw(spark, tmp_path):
    put(tmp_path / "raw" / "atp_players.csv", PLAYERS)
    for year in (2000, 2001, 2002):
        put(tmp_path / "raw" / f"atp_matches_{year}.csv", matches_of(year))

    def manifest():
        names = sorted(p.name for p in (tmp_path / "raw").iterdir())
        return spark.createDataFrame([(n, str(tmp_path / "raw" / n)) for n in names], "name string, path string")

    return manifest


def gold(spark, lake, name, fmt="versioned"):
    table = read_table(spark, lake, Layer.GOLD, name, fmt)
    return sorted_rows(table.drop("path").select(*sorted(set(table.columns) - {"path"})))


def same_as_a_full_run(spark, lake, manifest, tmp_path):
    full = Lake(str(tmp_path / f"full-{len(list(tmp_path.iterdir()))}"))
    run_pipeline(spark, manifest, full)
    for name in GOLD:
        assert gold(spark, lake, name) == gold(spark, full, name, "parquet"), name


def folders(spark, lake, layer, name):
    return {f.partition("/")[0]: f for f in versions(spark, lake.path(layer, name, "versioned"))[-1].folders}


def test_a_new_year_rewrites_only_itself(spark, raw, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    first = raw().where("name not like '%2002%'")
    assert update_lake(spark, first, lake) == ["atp_matches_2000.csv", "atp_matches_2001.csv", "atp_players.csv"]
    same_as_a_full_run(spark, lake, first, tmp_path)
    tables = [(Layer.SILVER, "df_matches"), (Layer.GOLD, "df_matches"), (Layer.GOLD, "df_yearly_player_tournaments")]
    before = [folders(spark, lake, *table) for table in tables]
    players = folders(spark, lake, Layer.SILVER, "df_players")
    assert update_lake(spark, raw(), lake) == ["atp_matches_2002.csv"]
    for table, old in zip(tables, before):
        now = folders(spark, lake, *table)
        assert set(now) == {*old, "year=2002"} and all(now[year] == old[year] for year in old)
    assert folders(spark, lake, Layer.SILVER, "df_players") == players
    same_as_a_full_run(spark, lake, raw(), tmp_path)
    assert update_lake(spark, raw(), lake) == []


def test_a_source_that_changed_is_landed_and_built_again(spark, raw, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    update_lake(spark, raw(), lake)
    put(tmp_path / "raw" / "atp_matches_2001.csv", matches_of(2001, count=20))
    assert update_lake(spark, raw(), lake) == ["atp_matches_2001.csv"]
    same_as_a_full_run(spark, lake, raw(), tmp_path)
    # Other names for the same players, so that all matches are spelled anew.
    put(tmp_path / "raw" / "atp_players.csv", PLAYERS.replace("2,B,B,", "2,Bee,Bee,"))
    assert len(update_lake(spark, raw(), lake)) == 4
    same_as_a_full_run(spark, lake, raw(), tmp_path)


def test_a_run_that_dies_is_made_up_for(spark, raw, tmp_path, monkeypatch):
    """After landing, and again between silver and gold: the next run builds what is missing, and
    until then gold is as it was."""
    lake = Lake(str(tmp_path / "lake"))
    update_lake(spark, raw().where("name not like '%2002%'"), lake)
    before = gold(spark, lake, "df_player_statistics")

    def dies(*_):
        raise RuntimeError("killed")

    for step in ("update_silver", "update_gold"):
        with monkeypatch.context() as patch:
            patch.setattr(update, step, dies)
            with pytest.raises(RuntimeError, match="killed"):
                update_lake(spark, raw(), lake)
        assert gold(spark, lake, "df_player_statistics") == before
    assert update_lake(spark, raw(), lake) == ["atp_matches_2002.csv"]
    same_as_a_full_run(spark, lake, raw(), tmp_path)


def test_two_sources_of_a_year_and_one_without(spark, raw, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    put(tmp_path / "raw" / "more_matches_2001.csv", matches_of(2001, count=5))
    put(tmp_path / "raw" / "matches_old.csv", matches_of(1990, count=7))
    update_lake(spark, raw(), lake)
    same_as_a_full_run(spark, lake, raw(), tmp_path)
    put(tmp_path / "raw" / "more_matches_2001.csv", matches_of(2001, count=6))
    assert update_lake(spark, raw(), lake) == ["atp_matches_2001.csv", "more_matches_2001.csv"]
    put(tmp_path / "raw" / "matches_old.csv", matches_of(1990, count=8))
    assert update_lake(spark, raw(), lake) == ["matches_old.csv"]
    same_as_a_full_run(spark, lake, raw(), tmp_path)


def test_fingerprints_by_files_or_by_content(spark, raw, tmp_path):
    def prints(by_content):
        return {r.name: r.fingerprint for r in fingerprints(spark, raw(), by_content).collect()}

    by_file, by_content = prints(False), prints(True)
    path = tmp_path / "raw" / "atp_matches_2000.csv"
    os.utime(path, (1_000_000, 1_000_000))
    assert prints(False) != by_file and prints(True) == by_content
    lines = path.read_text().splitlines()
    put(path, "\n".join([lines[0], *reversed(lines[1:])]) + "\n")
    assert prints(True) == by_content
    put(path, "\n".join([*lines, lines[1], lines[1]]) + "\n")
    changed = prints(True)
    assert {n for n in changed if changed[n] != by_content[n]} == {"atp_matches_2000.csv"}
    facts = {r.name: (r.files, r.bytes) for r in fingerprints(spark, raw()).collect()}
    assert facts["atp_players.csv"] == (1, len(PLAYERS))


def test_landing_by_content(spark, raw, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    assert len(land_changed(spark, raw(), lake, by_content=True)) == 4
    os.utime(tmp_path / "raw" / "atp_players.csv", (1_000_000, 1_000_000))
    assert land_changed(spark, raw(), lake, by_content=True) == []
    # A landing that lost its mark is landed again, whatever the ledger says.
    os.remove(tmp_path / "lake" / "bronze" / "atp_players.csv" / "_SUCCESS")
    assert land_changed(spark, raw(), lake, by_content=True) == ["atp_players.csv"]
    assert landed_sources(spark, lake).count() == read_ledger(spark, lake, "landed").count() == 4
    assert len(versions(spark, ledger_path(lake, "landed"))) == 2


def test_no_sources(spark, tmp_path):
    nothing = spark.createDataFrame([], "name string, path string")
    assert update_lake(spark, nothing, Lake(str(tmp_path))) == []


def test_files_find_their_source(spark):
    paths = ["/a b/x+y.csv", "s3a://bucket/dir/", "/a b", "hdfs://h:1/p/é.csv"]
    files = [("file:///a%20b/x+y.csv", 0), ("s3a://bucket/dir/k=1/part-0.csv", 1), ("file:/a%20b/z.csv", 2),
             ("hdfs://h:1/p/%C3%A9.csv", 3), ("file:///elsewhere", 4)]
    found = of_source(spark.createDataFrame(files, "file string, n int"), paths)
    assert sorted((r.n, r.source) for r in found.collect()) == [
        (0, "/a b"), (0, "/a b/x+y.csv"), (1, "s3a://bucket/dir/"), (2, "/a b"), (3, "hdfs://h:1/p/é.csv")
    ]


def test_sums_over_years_prune_and_do_not_read_the_matches(spark, raw, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    update_lake(spark, raw(), lake)
    rows = read_table(spark, lake, Layer.SILVER, "df_matches", "versioned").where(F.col("year").isin([2001]))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2001" in plan.split("PartitionFilters")[1]
