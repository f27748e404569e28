"""Match files landed and counted as they arrive, each once, with Structured Streaming.

The stream is of files: a micro-batch is the files that are new in a folder. Its rows are read by
the same reader as any other source, so values may hold line breaks, and both the rows and their counts
per player, tournament and level go to folders numbered like the batch. A batch that is repeated
after a failure replaces its own folders, so nothing counts twice. Counts are sums, so those
of all batches add up to those of all matches, and no state is kept between batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rallybook.functions.scalars import year_from_path
from rallybook.operators.rollup import SUMS, added_up, tournament_rollup
from rallybook.operators.sides import sides
from rallybook.plans.silver import with_typed_ids
from rallybook.sources.tables import Lake, read_csv_by_name
from rallybook.sources.versions import files_at

# The columns of Spark's list of files.
FILES = "path string, modificationTime timestamp, length long, content binary"
BATCH = "batch"


def arrivals_path(lake: Lake, name: str) -> str:
    return f"{lake.root.rstrip('/')}/arrivals/{name}"


def new_files(spark: SparkSession, folder: str, per_batch: int | None = None) -> DataFrame:
    """A stream of the paths of CSV files below a folder, also of those in folders that Spark has written."""
    files = spark.readStream.format("binaryFile").schema(FILES)
    files = files.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    if per_batch is not None:
        files = files.option("maxFilesPerTrigger", per_batch)
    return files.load(folder).select("path")


def rows_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files as rows with `path` and the `year` in it, columns matched by name."""
    rows = read_csv_by_name(spark, paths, with_path=True)
    return rows.withColumn("year", year_from_path(F.col("path")))


def take_batch(files: DataFrame, batch: int, lake: Lake) -> None:
    """Land and count the files of one micro-batch. Only their names come to the driver."""
    spark = files.sparkSession
    paths = [row.path for row in files.collect()]
    if not paths:
        return
    rows = rows_of(spark, paths)
    landed = f"{arrivals_path(lake, 'matches')}/{BATCH}={batch}"
    rows.write.mode("overwrite").option("compression", "zstd").parquet(landed)
    counted = tournament_rollup(sides(with_typed_ids(spark.read.parquet(landed))), by_level=True)
    counted.write.mode("overwrite").option("compression", "zstd").parquet(f"{arrivals_path(lake, 'counts')}/{BATCH}={batch}")


def take_arrivals(spark: SparkSession, folder: str, lake: Lake, files_per_batch: int | None = None) -> int:
    """Take in all files that have arrived since the last call and return how many batches that took.

    The checkpoint in the lake remembers the files that were taken. Run it from a scheduler.
    """
    writer = new_files(spark, folder, files_per_batch).writeStream.foreachBatch(lambda files, batch: take_batch(files, batch, lake))
    writer = writer.option("checkpointLocation", arrivals_path(lake, "checkpoint"))
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(progress["numInputRows"] > 0 for progress in query.recentProgress)


def finished(spark: SparkSession, lake: Lake, name: str) -> DataFrame | None:
    """The batches that were written to the end, as a table; None before the first."""
    path = arrivals_path(lake, name)
    pattern, files = files_at(spark, f"{path}/{BATCH}=*/_SUCCESS")
    done = [status.getPath().getParent().toString() for status in files.globStatus(pattern) or []]
    if not done:
        return None
    return spark.read.option("basePath", path).option("mergeSchema", True).parquet(*done).drop(BATCH)


def arrived_matches(spark: SparkSession, lake: Lake) -> DataFrame:
    """All matches that have arrived."""
    rows = finished(spark, lake, "matches")
    if rows is None:
        raise ValueError("nothing has arrived yet")
    return rows


def arrived_counts(spark: SparkSession, lake: Lake) -> DataFrame:
    """Their counts per player, tournament and level, the sums of all batches."""
    counts = finished(spark, lake, "counts")
    if counts is None:
        raise ValueError("nothing has arrived yet")
    return added_up(counts.select("player_id", "tourney_id", "tourney_level", *SUMS))
