"""A left join to a table with one row per key that holds up when one key is hot."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rallybook.functions.columns import unused


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate, the one that Spark's own broadcast decision uses."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return int(conf.autoBroadcastJoinThreshold())


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark will broadcast it by its own limit, `spark.sql.autoBroadcastJoinThreshold`."""
    return estimated_bytes(df) <= broadcast_limit(df)


def lookup_join(
    facts: DataFrame, lookup: DataFrame, keys: list[str], spread: list[str], salts: int = 1
) -> DataFrame:
    """`facts` left join `lookup` on the fact columns `keys`. The first columns of `lookup` are
    the matching keys, together unique, and are absent from the result.

    A lookup below Spark's broadcast limit is left to Spark, which broadcasts it. Otherwise
    a salt taken from the `spread` columns becomes one more join key, and each lookup row is
    repeated once per salt: rows of a hot or NULL key go to `salts` partitions. That key
    also puts an exchange directly under the join on both sides, without which (the lookup
    is usually fresh from a group-by on its key) adaptive execution could not split what
    is still too large. The salt depends on the row alone, so a repeated task repeats it.
    """
    named = facts.columns + lookup.columns
    renamed = [unused(f"_key_{i}", named) for i in range(len(keys))]
    salt, other_salt = unused("_salt", named), unused("_lookup_salt", named)
    lookup = lookup.withColumnsRenamed(dict(zip(lookup.columns, renamed)))
    matched = [F.col(key) == F.col(other) for key, other in zip(keys, renamed)]
    if fits_broadcast(lookup):
        return facts.join(lookup, matched, "left").drop(*renamed)
    facts = facts.withColumn(salt, F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    lookup = lookup.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias(other_salt))
    matched.append(F.col(salt) == F.col(other_salt))
    return facts.join(lookup, matched, "left").drop(salt, other_salt, *renamed)
