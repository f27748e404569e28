"""The run from raw files to gold equals the operators on rows in memory."""

import pytest
from frames import sorted_rows

from rallybook import fixtures
from rallybook.operators import levels
from rallybook.operators.sides import with_int_break_points
from rallybook.plans.gold import player_statistics
from rallybook.plans.pipeline import read_silver, run_pipeline
from rallybook.plans.silver import backfill_names, silver_matches, silver_players
from rallybook.queries import write_raw
from rallybook.sources.landing import landed_sources
from rallybook.sources.scratch import work_folder
from rallybook.sources.tables import Lake, Layer, read_table, retype

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("raw"))
    return write_raw(spark, SF_DIR, folder)


@pytest.fixture
def broadcast_limit(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    yield lambda value: value and spark.conf.set(key, value)
    spark.conf.set(key, before)


def loss_joined(statistics, matches):
    return statistics.join(levels.loss_rates(matches), "player_id", "left").select(
        *statistics.columns, "loss_%", "gs_matches_lost"
    )


# The last limit rules out any broadcast, so names are repaired by way of corrections.
@pytest.mark.parametrize(
    "silver_fmt, gold_fmt, backfill, limit",
    [
        ("parquet", "parquet", False, None),
        ("csv", "csv", True, None),
        ("parquet", "parquet", False, "-1"),
    ],
)
def test_pipeline(spark, raw, tmp_path, broadcast_limit, silver_fmt, gold_fmt, backfill, limit):
    broadcast_limit(limit)
    lake = Lake(str(tmp_path))
    landed = run_pipeline(spark, raw, lake, silver_fmt, gold_fmt, backfill)
    assert len(landed) == raw.count() == landed_sources(spark, lake).count()
    raw_players = fixtures.players(spark, SF_DIR)
    raw_matches = fixtures.matches(spark, SF_DIR)
    players = backfill_names(raw_players, raw_matches) if backfill else silver_players(raw_players)
    matches = silver_matches(raw_matches, players)

    def gold(name):
        table = read_table(spark, lake, Layer.GOLD, name, gold_fmt)
        return retype(table) if gold_fmt == "csv" else table

    def same(found, expected):
        if gold_fmt == "csv":
            expected = expected.selectExpr(*[f"cast(`{c}` as string) `{c}`" for c in expected.columns])
            found = found.selectExpr(*[f"cast(`{c}` as string) `{c}`" for c in found.columns])
        assert sorted_rows(found.select(*expected.columns)) == sorted_rows(expected)

    silver = read_silver(spark, lake, "df_matches", silver_fmt)
    assert sorted_rows(silver.drop("path")) == sorted_rows(matches)
    assert silver.select("path").distinct().count() >= 7
    same(gold("df_players"), players)
    same(gold("df_matches"), with_int_break_points(matches))
    same(gold("df_player_statistics"), player_statistics(players, matches))
    same(gold("df_player_statistics").drop("x"), loss_joined(player_statistics(players, matches), matches))
    same(gold("df_level_pivot"), levels.level_pivot(matches))
    same(gold("df_gs_statistics"), levels.level_statistics(matches))
    same(gold("df_masters_statistics"), levels.level_statistics(matches, levels.MASTERS))
    same(gold("df_davis_statistics"), levels.level_statistics(matches, levels.DAVIS))
    # Every run leaves the same tables, whatever Spark may broadcast.
    assert sorted(p.name.split(".")[0] for p in (tmp_path / "silver").iterdir()) == [
        "df_matches",
        "df_name_corrections",
        "df_players",
        "df_run_report",
    ]
    assert run_pipeline(spark, raw, lake, silver_fmt, gold_fmt, backfill) == []
    same(gold("df_gs_statistics"), levels.level_statistics(matches))


class Conf:
    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, name, default):
        return self.settings.get(name, default)


def test_work_folder_is_the_shared_one():
    cluster = Conf(**{"spark.master": "spark://host", "spark.checkpoint.dir": "s3://shared/x/"})
    assert work_folder(cluster).startswith("s3://shared/x/rallybook-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_folder(Conf(**{"spark.master": "spark://host"}))
