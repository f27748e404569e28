"""Versioned tables: what a reader sees while writers come, fail and die."""

import pytest
from frames import sorted_rows
from pyspark.sql import functions as F

from rallybook.sources.tables import Lake, Layer, read_table, write_table
from rallybook.sources.versions import (
    POINTERS,
    Version,
    drop_old_versions,
    has_version,
    publish,
    read_version,
    versions,
    write_version,
)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "my tables" / "t")


def table(spark, *rows):
    return spark.createDataFrame(list(rows), "x long, year int")


def failing(df):
    bad = F.when(F.col("x") == 9, F.raise_error(F.lit("half-way")).cast("int")).otherwise(F.col("year"))
    return df.withColumn("year", bad)


def test_versions_side_by_side(spark, path):
    assert not has_version(spark, path)
    with pytest.raises(ValueError, match="no version"):
        read_version(spark, path)
    assert write_version(table(spark, (1, 2000)), path).number == 1
    first = read_version(spark, path)
    assert write_version(table(spark, (2, 2001), (3, None)), path).number == 2
    assert sorted_rows(read_version(spark, path)) == [(2, 2001), (3, None)]
    assert sorted_rows(first) == sorted_rows(read_version(spark, path, 1)) == [(1, 2000)]
    with pytest.raises(ValueError, match="no version 7"):
        read_version(spark, path, 7)


def test_a_writer_that_fails_leaves_the_old_rows(spark, path):
    write_version(table(spark, (1, 2000), (2, 2001)), path, "year")
    for only_partitions in (False, True):
        with pytest.raises(Exception, match="half-way"):
            rows = table(spark, *[(i, 2000 + i % 3) for i in range(40)]).repartition(20)
            write_version(failing(rows), path, "year", only_partitions)
        assert sorted_rows(read_version(spark, path)) == [(1, 2000), (2, 2001)]
    assert write_version(table(spark, (5, 2005)), path, "year").number == 2
    assert sorted_rows(read_version(spark, path)) == [(5, 2005)]


def test_a_writer_killed_before_or_while_it_publishes(spark, path, tmp_path):
    """Its folders are not listed anywhere, and a pointer cut short counts for nothing."""
    write_version(table(spark, (1, 2000)), path)
    table(spark, (9, 2009)).withColumn("_version", F.lit("2-dead")).write.mode("append").partitionBy("_version").parquet(path)
    (tmp_path / "my tables" / "t" / POINTERS / "0000000002.json").write_text('{"folders": ["_version=2-de')
    assert sorted_rows(read_version(spark, path)) == [(1, 2000)]
    assert write_version(table(spark, (3, 2003)), path).number == 3
    assert sorted_rows(read_version(spark, path)) == [(3, 2003)]
    assert drop_old_versions(spark, path, keep=1) == 2
    assert sorted_rows(read_version(spark, path)) == [(3, 2003)]


def test_only_the_partitions_written_are_replaced(spark, path):
    write_version(table(spark, (1, 2000), (2, 2001), (3, None)), path, "year")
    before = versions(spark, path)[0].folders
    write_version(table(spark, (4, 2001), (5, 2002)), path, "year", only_partitions=True)
    after = versions(spark, path)[-1].folders
    assert sorted_rows(read_version(spark, path)) == sorted([(1, 2000), (3, None), (4, 2001), (5, 2002)], key=repr)
    assert len(set(before) & set(after)) == 2 and len(after) == 4
    write_version(table(spark, (6, None)), path, "year", only_partitions=True)
    assert (6, None) in sorted_rows(read_version(spark, path)) and read_version(spark, path).count() == 4
    plan = read_version(spark, path).where("year = 2001")._jdf.queryExecution().executedPlan().toString()
    assert "year" in plan.split("PartitionFilters")[1].split("]")[0]


def test_two_writers_from_the_same_version(spark, path):
    write_version(table(spark, (1, 2000)), path)
    with pytest.raises(Exception, match="(?i)already exists"):
        publish(spark, path, Version(1, (), table(spark, (1, 1)).schema))
    assert sorted_rows(read_version(spark, path)) == [(1, 2000)]


def test_empty_tables_and_columns(spark, path):
    write_version(table(spark), path, "year")
    assert read_version(spark, path).collect() == [] and read_version(spark, path).columns == ["x", "year"]
    odd = spark.createDataFrame([(1, "a")], "`win_%` int, `a.b` string")
    write_version(odd, path)
    assert read_version(spark, path).collect() == [(1, "a")] and read_version(spark, path).columns == ["win_%", "a.b"]


def test_old_versions_are_dropped_and_shared_folders_stay(spark, path):
    write_version(table(spark, (1, 2000), (2, 2001)), path, "year")
    for x in range(3, 6):
        write_version(table(spark, (x, 2001)), path, "year", only_partitions=True)
    assert drop_old_versions(spark, path, keep=2) == 2
    assert [v.number for v in versions(spark, path)] == [3, 4]
    assert sorted_rows(read_version(spark, path)) == [(1, 2000), (5, 2001)]
    assert sorted_rows(read_version(spark, path, 3)) == [(1, 2000), (4, 2001)]
    assert drop_old_versions(spark, path, keep=2) == 0


def test_as_a_format_of_the_lake(spark, tmp_path):
    lake = Lake(str(tmp_path))
    write_table(table(spark, (1, 2000), (2, 2001)), lake, Layer.GOLD, "t", "versioned", "year")
    write_table(table(spark, (3, 2001)), lake, Layer.GOLD, "t", "versioned", "year", only_partitions=True)
    assert sorted_rows(read_table(spark, lake, Layer.GOLD, "t", "versioned")) == [(1, 2000), (3, 2001)]
    with pytest.raises(ValueError, match="only versioned"):
        write_table(table(spark, (3, 2001)), lake, Layer.GOLD, "u", "parquet", "year", only_partitions=True)
