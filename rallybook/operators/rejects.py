"""Values that could not be read: counted in the pass that reads them, or listed.

Text that is no id, number or date becomes NULL in silver and gold. These say how often, and what it was.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, functions as F

from rallybook.functions.scalars import parse_yyyymmdd, to_id, to_int
from rallybook.schemas import BREAK_POINT_COLUMNS

Parser = Callable[[Column], Column]

PLAYER_PARSERS: dict[str, Parser] = {"player_id": to_id, "dob": parse_yyyymmdd}
MATCH_PARSERS: dict[str, Parser] = {
    "winner_id": to_id,
    "loser_id": to_id,
    **{name: to_int for name in BREAK_POINT_COLUMNS},
}


def is_unread(df: DataFrame, name: str, parser: Parser) -> Column:
    """Whether there is text, not only blanks, that the parser makes NULL of. A column that is typed
    already, or absent, has none."""
    if name not in df.columns or df.schema[name].dataType.typeName() != "string":
        return F.lit(False)
    value = F.col(name)
    return F.coalesce((F.trim(value) != "") & parser(value).isNull(), F.lit(False))


def observed(df: DataFrame, parsers: dict[str, Parser]) -> tuple[DataFrame, Observation]:
    """The same rows, and the counts of unread values per column once they have been through."""
    seen = Observation()
    counts = [F.count_if(is_unread(df, name, parser)).alias(name) for name, parser in parsers.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def unread_counts(df: DataFrame, parsers: dict[str, Parser]) -> DataFrame:
    """`column`, `values` (that are there), `unread`, and `unread_%`, a row per column, in one pass."""
    there = [F.count_if(F.trim(F.col(name)) != "") if name in df.columns else F.lit(0) for name in parsers]
    unread = [F.count_if(is_unread(df, name, parser)) for name, parser in parsers.items()]
    rows = [
        F.struct(F.lit(name).alias("column"), a.cast("long").alias("values"), b.cast("long").alias("unread"))
        for name, a, b in zip(parsers, there, unread)
    ]
    share = F.round(F.try_divide(F.col("unread"), F.col("values")) * 100, 2)
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows")).withColumn("unread_%", share)


def rejected_values(df: DataFrame, parsers: dict[str, Parser]) -> DataFrame:
    """`column`, `value` and `rows`: every text that could not be read and how often it occurs."""
    found = [
        F.when(is_unread(df, name, parser), F.struct(F.lit(name).alias("column"), F.col(name).cast("string").alias("value")))
        for name, parser in parsers.items()
        if name in df.columns
    ]
    # Rows without one are gone before anything is shuffled.
    values = df.select(F.explode(F.array_compact(F.array(*found))).alias("found")).select("found.*")
    return values.groupBy("column", "value").agg(F.count("*").alias("rows"))
