"""Which state of which source has been taken in: fingerprints, and a ledger of them.

A source counts as new or changed if the ledger does not have its name with its present fingerprint.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from rallybook.sources.landing import land_source, landed_sources
from rallybook.sources.parallel import run_together
from rallybook.sources.tables import Lake, of_source, sources_with_line_breaks
from rallybook.sources.versions import has_version, read_version, write_version

LEDGER = "name string, files long, bytes long, modified timestamp, fingerprint string"


def fingerprints(spark: SparkSession, sources: DataFrame, by_content: bool = False) -> DataFrame:
    """For each source (`name`, `path`): `files`, `bytes`, `modified` (of the newest file) and
    `fingerprint`, a digest of the names, lengths and times of its files.

    `by_content` reads the sources and makes the digest of their lines, whatever their order, files and
    times are, so that a source that was only copied anew has not changed.
    """
    named = sources.select("name", "path").collect()
    paths = [row.path for row in named]
    if not paths:
        return spark.createDataFrame([], LEDGER)
    # Names and lengths only; the column with the content is not asked for.
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    files = of_source(listed.select(F.col("path").alias("file"), "modificationTime", "length"), paths)
    one_file = F.xxhash64(F.substring_index("file", "/", -1), "length", "modificationTime")
    facts = files.groupBy("source").agg(
        F.count("*").alias("files"),
        F.sum("length").alias("bytes"),
        F.max("modificationTime").alias("modified"),
        total(one_file).alias("digest"),
    )
    if by_content:
        lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"))
        # Summed per file first, so a path is looked up once a file and not once a line.
        per_file = lines.groupBy("file").agg(total(F.xxhash64("value")).alias("digest"))
        content = of_source(per_file, paths).groupBy("source").agg(F.sum("digest").alias("digest"))
        facts = facts.drop("digest").join(content, "source", "left")
    names = spark.createDataFrame([(row.name, row.path) for row in named], "name string, source string")
    rest = F.concat_ws(":", *(["digest"] if by_content else ["files", "bytes", "digest"]))
    return names.join(facts, "source", "left").select(
        "name",
        F.coalesce("files", F.lit(0)).alias("files"),
        F.coalesce("bytes", F.lit(0)).alias("bytes"),
        "modified",
        F.sha2(F.coalesce(rest, F.lit("")), 256).alias("fingerprint"),
    )


def total(hashes):
    """The sum of 64-bit hashes; unlike an exclusive or it tells a row from three of it."""
    return F.sum(hashes.cast("decimal(38,0)"))


def ledger_path(lake: Lake, name: str) -> str:
    return f"{lake.root.rstrip('/')}/ledger/{name}"


def read_ledger(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    path = ledger_path(lake, name)
    return read_version(spark, path) if has_version(spark, path) else spark.createDataFrame([], LEDGER)


def unknown_to(ledger: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of `found` that the ledger does not have with their fingerprint."""
    return found.join(ledger.select("name", "fingerprint"), ["name", "fingerprint"], "left_anti").select(*found.columns)


def enter(spark: SparkSession, lake: Lake, name: str, rows: DataFrame) -> None:
    """Put the rows into the ledger in place of others of their name."""
    old = read_ledger(spark, lake, name)
    kept = old.join(rows.select("name"), "name", "left_anti").select(*old.columns)
    write_version(kept.unionByName(rows), ledger_path(lake, name))


def land_changed(spark: SparkSession, manifest: DataFrame, lake: Lake, by_content: bool = False) -> list[str]:
    """Land the sources that are new, have changed since they were landed, or whose landing did not
    end; returns their names.

    Fingerprints are taken before the copy, so a source that changes meanwhile is landed again next
    time. The ledger is written last: a run that dies is repeated and loses nothing.
    """
    found = fingerprints(spark, manifest, by_content)
    landed = read_ledger(spark, lake, "landed").join(landed_sources(spark, lake), "name", "left_semi")
    todo = unknown_to(landed, found).collect()
    if not todo:
        return []
    names = [row.name for row in todo]
    paths = {row.name: row.path for row in manifest.select("name", "path").collect() if row.name in names}
    broken = sources_with_line_breaks(spark, list(paths.values()))
    run_together(spark, [partial(land_source, spark, lake, name, path, broken) for name, path in paths.items()])
    enter(spark, lake, "landed", spark.createDataFrame(todo, LEDGER))
    return sorted(names)
