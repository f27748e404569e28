"""Table layouts that spare work later: buckets for joins without a shuffle, and sorted files with
bloom filters for the lookup of single rows."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame

LOOKUP_ROW_GROUP = 1 << 20


def bucketed(
    df: DataFrame, path: str, key: str, buckets: int | None = None, arranged: bool = False
) -> DataFrame:
    """The rows stored in buckets by `key` and read again: group-bys and joins by that key, with tables of as
    many buckets or with each other, need no exchange. What is at the path is replaced.

    The rows are shuffled by the key once, here, so a bucket is one file; `arranged` rows come out of a
    `repartition` by the key and that number already and are not shuffled again. By default there are as many buckets
    as shuffle partitions. A key that holds most of the rows makes a large bucket: reduce by key and
    something else first, as the rollups are.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"rallybook_buckets_{uuid4().hex}"
    rows = df if arranged else df.repartition(buckets, key)
    writer = rows.write.mode("overwrite").format("parquet").option("compression", "zstd")
    writer.option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    table = spark.table(name)
    # The plan holds files and buckets by itself; only the catalogue forgets the name.
    spark.sql(f"DROP TABLE {name}")
    return table


def write_lookup(df: DataFrame, path: str, *keys: str, row_group: int = LOOKUP_ROW_GROUP) -> None:
    """The rows as Parquet for looking up single values of `keys`: ordered by the first, so its values lie
    together in few row groups, and with a bloom filter for each, so that row groups without a
    value are passed over whichever key is asked for."""
    writer = df.repartitionByRange(keys[0]).sortWithinPartitions(*keys).write.mode("overwrite")
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", True)
    # Small groups, as a group is read whole or not at all.
    writer.option("parquet.block.size", row_group).parquet(path)
