"""Tables of a lake: CSV, Parquet, versioned Parquet or Delta under `root/layer/name`."""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass
from enum import Enum
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from rallybook.schemas import SILVER_TYPES, all_strings
from rallybook.sources.parallel import folders_at_once
from rallybook.sources.records import files_with_line_breaks, read_records
from rallybook.sources.versions import files_at, read_version, write_version

# Quotes inside quoted values are doubled, and blanks around values are data.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
# For folders of CSV files that are copied and read again, each written by one task.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
FORMATS = ("csv", "parquet", "versioned", "delta")
GATHER_SLOTS = 16
# In a CSV folder that holds no value with a line break.
ONE_LINE_MARK = "_one_line"


class Layer(Enum):
    BRONZE = "bronze"
    SILVER = "silver"
    GOLD = "gold"


@dataclass(frozen=True)
class Lake:
    """Where the layers live; `root` is any path that Spark can write."""

    root: str

    def folder(self, layer: Layer) -> str:
        if not isinstance(layer, Layer):
            raise ValueError(f"not a layer: {layer!r}")
        return f"{self.root.rstrip('/')}/{layer.value}"

    def path(self, layer: Layer, name: str, fmt: str) -> str:
        """CSV tables carry their extension, the others do not."""
        return f"{self.folder(layer)}/{name}{'.csv' if check_format(fmt) == 'csv' else ''}"


def check_format(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}, expected one of {FORMATS}")
    return fmt


def expanded(spark: SparkSession, paths) -> list[str]:
    """The paths as a list, patterns replaced by what they match."""
    found = []
    for path in paths if isinstance(paths, list) else [paths]:
        if re.search(r"[*?\[{]", path):
            place, files = files_at(spark, path)
            found += [status.getPath().toString() for status in files.globStatus(place) or []]
        else:
            found.append(path)
    return found


def of_source(files: DataFrame, paths: list[str]) -> DataFrame:
    """The rows of `files`, keyed by `file`, with `source`: the given path that is the file or lies above it.

    The paths are compared with each file's own ancestors, as a join on equal keys.
    """
    scheme = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"
    given = [(path, re.sub(scheme, "", path).rstrip("/")) for path in dict.fromkeys(paths)]
    sources = files.sparkSession.createDataFrame(given, "source string, _place string")
    decoded = F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B")))
    parts = F.split(F.regexp_replace(decoded, scheme, ""), "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    return files.withColumn("_place", F.explode(above)).join(sources, "_place").drop("_place")


def sources_with_line_breaks(spark: SparkSession, paths: list[str]) -> set[str]:
    """Those of the paths that hold a value with a line break. Folders marked as free of them
    are believed, the others are scanned together."""
    unknown = []
    for path in dict.fromkeys(paths):
        mark, files = files_at(spark, f"{path.rstrip('/')}/{ONE_LINE_MARK}")
        if not files.exists(mark):
            unknown.append(path)
    if not unknown:
        return set()
    found = of_source(files_with_line_breaks(spark, unknown), unknown)
    return {row.source for row in found.select("source").distinct().collect()}


def read_csv(
    spark: SparkSession, paths, with_path: bool = False, broken: set[str] | None = None
) -> DataFrame:
    """One path or a list of paths with the same header as one all-string DataFrame.

    Spark binds CSV columns by position, so the header of each file is compared with the
    first one and the read fails where they differ; `read_csv_by_name` aligns them instead.
    `with_path` adds the file each row came from as `path`.

    Values may contain line breaks. Files without any are read by Spark's own reader line by line; the
    others, `broken` if that is known already, by records that cross lines and blocks.
    """
    paths = expanded(spark, paths)
    if broken is None:
        broken = sources_with_line_breaks(spark, paths)
    return with_header(spark, paths, header_of(spark, paths[0], broken), with_path, broken)


def header_of(spark: SparkSession, path: str, broken: set[str]) -> list[str]:
    return spark.read.options(**CSV_OPTIONS).option("multiLine", path in broken).csv(path).columns


def with_header(
    spark: SparkSession, paths: list[str], header, with_path: bool = False, broken: set[str] = frozenset()
) -> DataFrame:
    """The paths read with a header that is known; it is compared with that of each file."""
    parts = []
    plain = [path for path in paths if path not in broken]
    if plain:
        reader = spark.read.options(**CSV_OPTIONS).option("enforceSchema", False)
        rows = reader.schema(all_strings(header)).csv(plain)
        parts.append(rows.select("*", F.col("_metadata.file_path").alias("path")) if with_path else rows)
    left = [path for path in paths if path in broken]
    while left:
        # A path that is given twice is read twice, but lines of a file must not be mixed with its copy.
        once = list(dict.fromkeys(left))
        parts.append(read_records(spark, once, header, CSV_OPTIONS, with_path))
        for path in once:
            left.remove(path)
    return reduce(DataFrame.union, parts)


def headers(spark: SparkSession, paths: list[str], broken: set[str]) -> dict[tuple[str, ...], list[str]]:
    """The paths by their header, all found in one job that reads the first line of every file.

    A path may be a folder of files; those share a header, as Spark's own CSV folders do. Files are
    compared in Spark and one row per given path comes back.
    """
    lines = spark.read.text(list(dict.fromkeys(paths))).select(
        "value", F.col("_metadata.file_path").alias("file"), "_metadata.file_block_start"
    )
    first = F.monotonically_increasing_id()
    lines = lines.where("file_block_start = 0").withColumn("place", first)
    # The places first, which are hashed; the smallest of texts would be found by sorting all lines.
    places = lines.groupBy("file").agg(F.min("place").alias("place")).select("place")
    heads = lines.join(F.broadcast(places), "place").select("file", F.col("value").alias("header"))
    known = of_source(heads, paths).groupBy("source").agg(F.min("header").alias("low"), F.max("header").alias("high"))
    found = {row.source: row for row in known.collect()}
    groups: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        if path not in found:
            raise ValueError(f"no header in {path}")
        low, high = found[path].low, found[path].high
        if low != high:
            raise ValueError(f"files with different headers in {path}")
        header = header_of(spark, path, broken) if path in broken else next(csv.reader([low]))
        groups.setdefault(tuple(header), []).append(path)
    return groups


def read_csv_by_name(spark: SparkSession, paths, with_path: bool = False) -> DataFrame:
    """Files with different headers as one DataFrame, columns matched by name, gaps NULL; `with_path`
    adds the file each row came from.

    Files that share a header share one scan, so the plan grows with the number of
    different headers and not with the number of files.
    """
    paths = expanded(spark, paths)
    broken = sources_with_line_breaks(spark, paths)
    groups = headers(spark, paths, broken)
    parts = [with_header(spark, group, header, with_path, broken) for header, group in groups.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def write_csv(df: DataFrame, path: str, partition_by: str | None = None, packed: bool = False) -> None:
    """Replace a CSV folder. Whether any value has a line break is observed in the same pass; if none has,
    the folder is marked, so that readers need not look. `packed` compresses its files."""
    broken = F.lit(False)
    for field in df.schema.fields:
        if field.dataType.typeName() == "string":
            for end in "\n\r":
                found = F.contains(F.col(quoted(field.name)), F.lit(end))
                broken = broken | F.coalesce(found, F.lit(False))
    seen = Observation()
    rows = df.observe(seen, F.bool_or(broken).alias("line_breaks"))
    writer = rows.write.mode("overwrite").options(**CSV_OPTIONS, **(PACKED if packed else {}))
    # Landing relies on the mark of a finished job.
    writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", True)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.csv(path)
    if not seen.get.get("line_breaks"):
        mark, files = files_at(df.sparkSession, f"{path}/{ONE_LINE_MARK}")
        files.create(mark, True).close()


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def load_csv(spark: SparkSession, lake: Lake, source, name: str | None = None) -> DataFrame:
    """`source` is a layer, read at `name`, or a list of full paths, where `name` is ignored."""
    if isinstance(source, list):
        return read_csv(spark, source)
    if isinstance(source, Layer):
        return read_csv(spark, lake.path(source, name, "csv"))
    raise ValueError(f"expected a layer or a list of paths, got {type(source).__name__}")


def read_table(
    spark: SparkSession, lake: Lake, layer: Layer, name: str, fmt: str = "parquet"
) -> DataFrame:
    path = lake.path(layer, name, fmt)
    if fmt == "csv":
        return read_csv(spark, path)
    return read_version(spark, path) if fmt == "versioned" else spark.read.format(fmt).load(path)


def write_table(
    df: DataFrame,
    lake: Lake,
    layer: Layer,
    name: str,
    fmt: str = "parquet",
    partition_by: str | None = None,
    gather: bool = False,
    only_partitions: bool = False,
) -> None:
    """Replace the table, in folders by one column if asked. While a `versioned` table is replaced
    its old rows stay readable, and `only_partitions` replaces just those that the rows belong to.

    `gather` is for rows that a shuffle has mixed, of which every task would write a file per
    folder: it brings the rows of a folder together. Adaptive execution splits what is too large
    for a task, so a folder with most of the rows is no bottleneck; without it each folder's rows are
    dealt out to `GATHER_SLOTS` tasks.
    """
    path = lake.path(layer, name, fmt)
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    if partition_by and gather and adaptive:
        df = df.hint("rebalance", partition_by)
    elif partition_by and gather:
        slot = F.pmod(F.xxhash64(*[c for c in df.columns if c != partition_by]), F.lit(GATHER_SLOTS))
        df = df.repartition(partition_by, slot)
    if only_partitions and fmt != "versioned":
        raise ValueError("only versioned tables can be replaced by partition")
    if fmt == "csv":
        write_csv(df, path, partition_by)
        return
    if fmt == "versioned":
        write_version(df, path, partition_by, only_partitions)
        return
    writer = df.write.mode("overwrite")
    if fmt == "parquet":
        writer = writer.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with folders_at_once(df.sparkSession):
        writer.format(fmt).save(path)


def retype(df: DataFrame) -> DataFrame:
    """Give the columns of a silver table kept as CSV their types again."""
    return df.select(
        *[
            F.col(c).try_cast(SILVER_TYPES[c]).alias(c) if c in SILVER_TYPES else F.col(c)
            for c in df.columns
        ]
    )
