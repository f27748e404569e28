"""CSV records that cross lines, read without giving a whole file to one task.

A line that begins outside a quoted value may end inside one, and a line that begins inside may
end on either side. So each line is a function of one bit, and where a line begins follows from
composing the functions of all lines before it: by running sums within each block of a file, and
again over the blocks, of which only one row each is compared. Lines that hold one record are parsed as
they are; only the lines of a record that crosses lines are brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

DELIMITER, QUOTE = ",", '"'
FIELD_START, INSIDE, LITERAL = 0, 1, 2


def ends_inside(line: Column, begins_inside: bool) -> Column:
    """1 if a quoted value is open at the end of the line, else 0.

    A quote opens a value only where a value begins; within a quoted value it closes it, and a second one
    right after opens it again, which is how a quote is written there. Elsewhere it is text.
    """
    def after_quote(state: Column, before: Column) -> Column:
        opens = F.endswith(before, F.lit(DELIMITER)) | ((state == FIELD_START) & (before == ""))
        return F.when(state == INSIDE, FIELD_START).when(opens, INSIDE).otherwise(LITERAL)

    parts = F.split(line, QUOTE)
    before_quotes = F.slice(parts, F.lit(1), F.size(parts) - 1)
    start = INSIDE if begins_inside else FIELD_START
    state = F.aggregate(before_quotes, F.lit(start), after_quote)
    return F.when(F.contains(line, F.lit(QUOTE)), (state == INSIDE).cast("int")).otherwise(int(begins_inside))


def text_lines(spark: SparkSession, paths) -> DataFrame:
    """`file`, `block` (where its part of the file begins), `place` (rising within a block), `line`."""
    lines = spark.read.option("lineSep", "\n").text(paths)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("line"),
    )


def files_with_line_breaks(spark: SparkSession, paths) -> DataFrame:
    """`file`: the files in which some quoted value goes on in the next line, found in one scan. Until the
    first such line every line begins outside, so no line has to know of any other."""
    lines = text_lines(spark, paths).where(F.contains("line", F.lit(QUOTE)))
    return lines.where(ends_inside(F.col("line"), False) == 1).select("file").distinct()


def composed(rows: DataFrame, keys: list[str], order: str, zero: Column, one: Column) -> DataFrame:
    """Adds `after_0` and `after_1`, what the bit is after a row if it was 0 or 1 before the first, where
    a row alone makes `zero` of 0 and `one` of 1.

    A row keeps the bit, flips it, or sets it. So the bit is what the last row that set it made of it, or else
    the first one, flipped as often as rows have flipped it since.
    """
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_flips", F.sum(((zero == 1) & (one == 0)).cast("int")).over(upto))
    made = F.when(zero == one, F.struct(zero.alias("bit"), F.col("_flips").alias("flips")))
    rows = rows.withColumn("_set", F.last(made, ignorenulls=True).over(upto))
    since = F.col("_set.bit") + F.col("_flips") - F.col("_set.flips")
    after = {f"after_{bit}": F.coalesce(since, F.lit(bit) + F.col("_flips")) % 2 for bit in (0, 1)}
    return rows.withColumns(after).drop("_flips", "_set")


def located_lines(lines: DataFrame) -> DataFrame:
    """The lines with `begins` and `ends`, whether inside a quoted value, and `record`, the block and
    place of the line where its record begins."""
    block = ["file", "block"]
    in_block = Window.partitionBy(*block).orderBy("place")
    lines = lines.withColumns({f"ends_{b}": ends_inside(F.col("line"), bool(b)) for b in (0, 1)})
    lines = composed(lines, block, "place", F.col("ends_0"), F.col("ends_1"))
    before = {f"before_{b}": F.coalesce(F.lag(f"after_{b}").over(in_block), F.lit(b)) for b in (0, 1)}
    lines = lines.withColumn("at", F.row_number().over(in_block)).withColumns(before)
    starts = {b: F.max(F.when(F.col(f"before_{b}") == 0, F.col("at"))).alias(f"start_{b}") for b in (0, 1)}
    ends = {b: F.max_by(f"after_{b}", "at").alias(f"block_{b}") for b in (0, 1)}
    blocks = lines.groupBy(*block).agg(*starts.values(), *ends.values())

    blocks = composed(blocks, ["file"], "block", F.col("block_0"), F.col("block_1"))
    in_file = Window.partitionBy("file").orderBy("block")
    blocks = blocks.withColumns(
        {
            "begins": F.coalesce(F.lag("after_0").over(in_file), F.lit(0)),
            "is_last": F.lead("block").over(in_file).isNull(),
        }
    )
    start = F.when(F.col("begins") == 0, F.col("start_0")).otherwise(F.col("start_1"))
    here = F.when(start.isNotNull(), F.struct(F.col("block"), start.alias("at")))
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    never_closed = F.raise_error(F.concat(F.lit("a quoted value is never closed in "), F.col("file")))
    closed = F.when(F.col("is_last") & (F.col("after_0") == 1), never_closed.cast("boolean")).otherwise(True)
    blocks = blocks.withColumn("open_record", F.last(here, ignorenulls=True).over(earlier)).where(closed)
    blocks = blocks.select(*block, "begins", "open_record")

    def known(name: str) -> Column:
        return F.when(F.col("begins") == 0, F.col(f"{name}_0")).otherwise(F.col(f"{name}_1"))

    lines = lines.join(blocks, block).select(
        *block, "at", "line", known("before").alias("begins"), known("after").alias("ends"), "open_record"
    )
    upto = Window.partitionBy(*block).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    own = F.last(F.when(F.col("begins") == 0, F.struct("block", "at")), ignorenulls=True).over(upto)
    return lines.withColumn("record", F.coalesce(own, F.col("open_record"))).drop("open_record")


def csv_records(spark: SparkSession, paths) -> DataFrame:
    """`file`, `is_first` (of the file), and `text` of every record, line breaks within values kept."""
    lines = located_lines(text_lines(spark, paths))
    first = ((F.col("record.block") == 0) & (F.col("record.at") == 1)).alias("is_first")
    one_line = (F.col("begins") == 0) & (F.col("ends") == 0)
    # Only such lines can be blank without being part of a value.
    whole = lines.where(one_line & (F.trim(F.regexp_replace("line", r"\r$", "")) != ""))
    whole = whole.select("file", first, F.col("line").alias("text"))
    crossing = lines.where(~one_line).groupBy("file", "record").agg(
        F.sort_array(F.collect_list(F.struct("block", "at", "line"))).alias("lines")
    )
    text = F.array_join(F.transform("lines", lambda x: x["line"]), "\n")
    records = whole.unionByName(crossing.select("file", first, text.alias("text")))
    return records.withColumn("text", F.regexp_replace("text", r"\r$", ""))


def read_records(spark: SparkSession, paths, header, options: dict, with_path: bool = False) -> DataFrame:
    """The records of files that all have this header as all-string columns; `with_path` adds their file."""
    names = ", ".join(f"`{name.replace('`', '``')}` string" for name in header)
    values = F.from_csv("text", names, {k: str(v) for k, v in options.items() if k != "header"})
    records = csv_records(spark, paths).withColumn("values", values)
    found = F.lower(F.array_join(F.array(*[F.col("values")[i] for i in header]), "\n"))
    expected = F.lit("\n".join(header).lower())
    wrong = F.raise_error(F.concat(F.lit("CSV header does not conform to the schema in "), F.col("file")))
    is_row = F.when(~F.col("is_first"), True).when(found == expected, False).otherwise(wrong.cast("boolean"))
    columns = [F.col("values")[name].alias(name) for name in header]
    return records.where(is_row).select(*columns, *([F.col("file").alias("path")] if with_path else []))
