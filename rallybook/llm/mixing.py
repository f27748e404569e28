"""Operator 4: mixing sources to target weights, by capped water-filling.

DataFrame functions only. A source's target is its weighted share of the budget, but at most
`max_epochs` times its size; what a clamped source leaves is shared by weight among the others until
none is above. Ordered by cap / weight the clamped sources come first, so running sums over the
table of sources give the level at once instead of by repeated passes.

A source is then taken whole as often as the target allows, and for the rest its documents are
taken in a seeded order until the target is met; the last one is cut. Running sums over documents are
taken over 4096 hash ranges per source first and within the one range where the target
falls after, so that no task sees a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rallybook.sources.scratch import stored, work_folder

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix-1"
RANGE_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, budget: int | None = None, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """`sizes` (source, source_size, weight; a row per source) with `target`, the words to take.

    Without a budget all words are shared out. The table has a row per source, so its
    running sums may be taken in one task.
    """
    exact = "decimal(38,0)"
    cap = F.col("source_size") * max_epochs
    total = F.sum("source_size").over(Window.partitionBy()) if budget is None else F.lit(budget)
    rows = sizes.withColumns({"_cap": cap.cast(exact), "_weight": F.col("weight").cast(exact), "_total": total.cast(exact)})
    order = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("_weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumns({"_left": (F.col("_total") - before).cast(exact), "_rest": rest.cast(exact)})
    clamped = F.col("_cap").cast("double") * F.col("_rest").cast("double") <= F.col("_weight").cast("double") * F.col("_left").cast("double")
    rows = rows.withColumn("_clamped", clamped)
    # The first source that is not clamped sets the level of all that are not.
    level = F.min(F.when(~F.col("_clamped"), F.struct(-F.col("_left") / F.col("_rest"), "_left", "_rest"))).over(Window.partitionBy())
    rows = rows.withColumn("_level", level)
    share = F.col("_weight").cast("double") * F.col("_level._left").cast("double") / F.col("_level._rest").cast("double")
    target = F.when(F.col("_clamped"), F.col("_cap").cast("double")).otherwise(share)
    return rows.withColumn("target", target).select(*sizes.columns, "target")


def weighted(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Sources by code point, null last, with the given weights in turn."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turns = F.array(*[F.lit(w) for w in weights])
    return sizes.withColumn("weight", F.get(turns, place % len(weights)))


def mixed(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    budget: int | None = None,
    seed: str = SEED,
) -> DataFrame:
    """How much of every document the mix takes: `doc_id`, `source`, `size` in words,
    `source_size`, `target` of its source, `whole` repetitions, `part`, the words of one more, and
    `taken`, the words altogether.

    Per source the words taken are the target, rounded. Null text: size 0, taken 0. Null
    source: a source of its own, last in order. Null doc_id: a value like any other. Documents with
    the same doc_id follow each other in the seeded order, smaller ones first; repeated rows are
    taken as rows. A source without words has target 0. An empty table gives an empty result. Other
    columns are not looked at.
    """
    folder = work_folder(docs.sparkSession)
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("_key"))
    rows = stored(rows, f"{folder}/sizes")
    at = F.substring("_key", 1, RANGE_DIGITS)
    ranges = rows.groupBy("source", at.alias("_range")).agg(F.sum("size").alias("words"))
    sizes = ranges.groupBy("source").agg(F.sum("words").alias("source_size"))
    shares = targets(weighted(sizes, weights), budget, max_epochs)
    goal = F.round("target").cast("long")
    some = F.col("source_size") > 0
    shares = shares.withColumns(
        {
            "whole": F.when(some, F.expr("cast(round(target) as bigint) div source_size")).otherwise(F.lit(0)).cast("long"),
            "_more": F.when(some, goal % F.col("source_size")).otherwise(F.lit(0)).cast("long"),
        }
    )
    first = F.sum("words").over(
        Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    ranges = ranges.withColumn("_before", F.coalesce(first, F.lit(0)))
    s, r = shares.alias("s"), ranges.alias("r")
    plan = r.join(s, F.col("r.source").eqNullSafe(F.col("s.source"))).select(
        F.col("r.source").alias("_source"),
        F.col("_range").alias("_in"),
        "source_size",
        "target",
        "whole",
        # Words of the range that the last, partial repetition takes; less than all in one range.
        F.least(F.greatest(F.col("_more") - F.col("_before"), F.lit(0)), F.col("words")).alias("_take"),
        "words",
    )
    plan = stored(plan, f"{folder}/plan")
    same = F.col("source").eqNullSafe(F.col("_source")) & (at == F.col("_in"))
    rows = rows.join(plan, same)
    all_or_none = (F.col("_take") == 0) | (F.col("_take") == F.col("words"))
    plain = rows.where(all_or_none).withColumn("part", F.when(F.col("_take") > 0, F.col("size")).otherwise(F.lit(0)))
    order = Window.partitionBy("_source", "_in").orderBy("_key", "doc_id", "size")
    earlier = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = rows.where(~all_or_none).withColumn("part", earlier)
    cut = cut.withColumn("part", F.least(F.greatest(F.col("_take") - F.col("part"), F.lit(0)), F.col("size")))
    taken = F.col("size") * F.col("whole") + F.col("part")
    columns = ["doc_id", "source", "size", "source_size", "target", "whole", F.col("part").cast("long").alias("part")]
    return plain.unionByName(cut).select(*columns, taken.cast("long").alias("taken"))
