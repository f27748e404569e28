import datetime

import pytest
from pyspark.sql import functions as F

from rallybook.functions import scalars


def one_column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_ids_lose_the_tail_of_a_float(spark):
    values = ["7", "7.0", "104925.00", "x", "7.5", None, "9007199254740993.0"]
    found = one_column(spark, values, scalars.to_id)
    assert found == [7, 7, 104925, None, None, None, 9007199254740993]


def test_ints(spark):
    values = ["5", "5.0", "5.7", "-3", " 4 ", "NA", "", None, "99999999999"]
    assert one_column(spark, values, scalars.to_int) == [5, 5, 5, -3, 4, None, None, None, None]


def test_dates(spark):
    day = datetime.date(1981, 8, 8)
    values = ["19810808", "19810808.0", "19000000", "x", None, "1981", "19810231"]
    found = one_column(spark, values, scalars.parse_yyyymmdd)
    assert found == [day, day, None, None, None, None, None]


@pytest.mark.parametrize(
    "path, year",
    [
        ("file:/my_dir/atp_matches_2003.csv", 2003),
        ("file:/my_dir/atp_matches_2003.csv/part-00000-a_1999.csv", 2003),
        ("s3://b/atp_matches_2003.csv/part-00000-abc.csv", 2003),
        ("file:/my_2001_dir/atp_players.csv", None),
    ],
)
def test_year_from_path(spark, path, year):
    assert one_column(spark, [path], scalars.year_from_path) == [year]


def test_prefer_canonical_keeps_unknown_names(spark):
    rows = [("A-B", "A B"), ("A B", "A B"), (None, "A B"), ("A-B", None), (None, None)]
    df = spark.createDataFrame(rows, "name string, canonical string").coalesce(1)
    found = df.select(scalars.prefer_canonical(F.col("name"), F.col("canonical"))).collect()
    assert [r[0] for r in found] == ["A B", "A B", None, "A-B", None]


def test_percentage_of_nothing_is_null(spark):
    rows = [(1, 3), (2, 3), (0, 4), (4, 0), (0, 0), (None, 2), (2, None)]
    df = spark.createDataFrame(rows, "a long, b long").coalesce(1)
    found = [r[0] for r in df.select(scalars.percentage(F.col("a"), F.col("b"))).collect()]
    assert found == [33.33, 66.67, 0.0, None, None, None, None]


def test_mean_rounds_half_a_cent_up(spark):
    rows = [(0.0, 0.29), (50.0, 51.0), (33.33, 66.66), (None, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double").coalesce(1)
    mean = scalars.mean_of_percentages(F.col("a"), F.col("b"))
    assert [r[0] for r in df.select(mean).collect()] == [0.15, 50.5, 50.0, None]


def test_full_name(spark):
    df = spark.createDataFrame([("Ann", "Bee")], "f string, l string")
    assert df.select(scalars.full_name(F.col("f"), F.col("l"))).first()[0] == "Ann Bee"
