"""Bronze landing: which sources are missing, and copying just those."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from rallybook.functions.scalars import year_from_path
from rallybook.schemas import ALL_MATCHES_TABLE, MATCHES_MARK, MATCHES_SOURCE_PREFIX, PLAYERS_SOURCE
from rallybook.sources.parallel import run_together
from rallybook.sources.tables import (
    Lake,
    Layer,
    read_csv,
    read_csv_by_name,
    read_table,
    sources_with_line_breaks,
    write_csv,
    write_table,
)
from rallybook.sources.versions import files_at


def source_manifest(
    spark: SparkSession, base: str, first_year: int, last_year: int, inclusive: bool = True
) -> DataFrame:
    """`name` and `path` of the players file and of one matches file per year."""
    end = last_year + 1 if inclusive else last_year
    # The number after the last year stands for the players.
    stem = F.when(F.col("id") < end, F.format_string(f"{MATCHES_SOURCE_PREFIX}%d", "id"))
    names = spark.range(first_year, end + 1).select(
        F.concat(stem.otherwise(PLAYERS_SOURCE), F.lit(".csv")).alias("name")
    )
    return names.withColumn("path", F.concat(F.lit(base.rstrip("/") + "/"), "name"))


def landed_names(spark: SparkSession, lake: Lake) -> list[str]:
    """Names of the sources whose landing has ended: folders with a `_SUCCESS` mark, and plain files.

    Only the bronze folder itself and the marks are listed, not the files of the sources.
    """
    folder, files = files_at(spark, lake.folder(Layer.BRONZE))
    if not files.exists(folder):
        return []
    done = files.globStatus(files_at(spark, f"{lake.folder(Layer.BRONZE)}/*/_SUCCESS")[0]) or []
    names = {status.getPath().getParent().getName() for status in done}
    names |= {s.getPath().getName() for s in files.listStatus(folder) if s.isFile()}
    return sorted(n for n in names if not n.startswith((".", "_")))


def landed_sources(spark: SparkSession, lake: Lake) -> DataFrame:
    """The same as a DataFrame with the column `name`."""
    return spark.createDataFrame([(n,) for n in landed_names(spark, lake)], "name string")


def missing_sources(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    return manifest.join(landed, "name", "left_anti")


def land_source(spark: SparkSession, lake: Lake, name: str, path: str, broken: set[str] | None = None) -> None:
    """Copy one source, values untouched and files compressed, over whatever an unfinished landing has left. It counts as
    landed once the job has put its `_SUCCESS` mark into the folder."""
    write_csv(read_csv(spark, path, broken=broken), f"{lake.folder(Layer.BRONZE)}/{name}", packed=True)


def land_bronze(spark: SparkSession, manifest: DataFrame, lake: Lake) -> list[str]:
    """Land the sources of the manifest that bronze lacks; returns their names.

    Only names and paths come to the driver; the rows are copied by Spark jobs. One job looks for
    line breaks within values in all sources at once.
    """
    todo = missing_sources(manifest, landed_sources(spark, lake)).collect()
    broken = sources_with_line_breaks(spark, [row.path for row in todo])
    run_together(spark, [partial(land_source, spark, lake, row.name, row.path, broken) for row in todo])
    return sorted(row.name for row in todo)


def load_sources(spark: SparkSession, lake: Lake, names: list[str]) -> DataFrame:
    """Landed sources by name, plus `path` and the `year` in it."""
    rows = read_csv(spark, [f"{lake.folder(Layer.BRONZE)}/{n}" for n in names], with_path=True)
    return rows.withColumn("year", year_from_path(F.col("path")))


def load_matches(spark: SparkSession, lake: Lake) -> DataFrame:
    """All landed sources with `matches` in their name, plus `path` and the `year` in it."""
    names = [n for n in landed_names(spark, lake) if MATCHES_MARK in n]
    if not names:
        raise ValueError(f"no matches have landed in {lake.folder(Layer.BRONZE)}")
    return load_sources(spark, lake, names)


def concatenate_matches(spark: SparkSession, lake: Lake, name: str = ALL_MATCHES_TABLE) -> DataFrame:
    """The landed matches as one table, columns matched by name, written to silver and read again."""
    folder = lake.folder(Layer.BRONZE)
    paths = [f"{folder}/{n}" for n in landed_names(spark, lake) if MATCHES_MARK in n]
    write_table(read_csv_by_name(spark, paths), lake, Layer.SILVER, name)
    return read_table(spark, lake, Layer.SILVER, name)
