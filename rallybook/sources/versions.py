"""Parquet tables that are replaced safely.

Each write adds folders of its own below the table and a pointer that lists the folders that make up
the table from now on. The pointer is written last, so a job that dies half-way leaves the old
version readable and the new folders unnoticed. A version can keep the folders of partitions that it does
not touch. Pointers are numbered and never overwritten: of two writers that started from the same version
the second one fails. No rename is needed.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from rallybook.sources.parallel import folders_at_once

POINTERS = "_pointers"
VERSION = "_version"


@dataclass(frozen=True)
class Version:
    number: int
    # Relative to the table, such as `year=2003/_version=7-1f0c`.
    folders: tuple[str, ...]
    schema: StructType

    def partition(self, folder: str) -> str:
        return folder.rpartition("/")[0]


def files_at(spark: SparkSession, path: str):
    """The path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def versions(spark: SparkSession, path: str) -> list[Version]:
    """All versions that have a pointer, oldest first. A pointer cut short by a dying writer is none."""
    pointers, files = files_at(spark, f"{path}/{POINTERS}")
    if not files.exists(pointers):
        return []
    found = []
    for status in files.listStatus(pointers):
        number = re.fullmatch(r"(\d+)\.json", status.getPath().getName())
        if number is None:
            continue
        stream = files.open(status.getPath())
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            known = json.loads(text)
        except json.JSONDecodeError:
            continue
        schema = StructType.fromJson(known["schema"])
        found.append(Version(int(number[1]), tuple(known["folders"]), schema))
    return sorted(found, key=lambda version: version.number)


def published_numbers(spark: SparkSession, path: str) -> list[int]:
    """The numbers of all pointers, also of those cut short."""
    pointers, files = files_at(spark, f"{path}/{POINTERS}")
    if not files.exists(pointers):
        return [0]
    names = [status.getPath().getName() for status in files.listStatus(pointers)]
    return [0, *(int(m[1]) for m in (re.fullmatch(r"(\d+)\.json", name) for name in names) if m)]


def publish(spark: SparkSession, path: str, version: Version) -> None:
    pointer, files = files_at(spark, f"{path}/{POINTERS}/{version.number:010d}.json")
    text = json.dumps({"folders": version.folders, "schema": version.schema.jsonValue()})
    stream = files.create(pointer, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def write_version(
    df: DataFrame, path: str, partition_by: str | None = None, only_partitions: bool = False
) -> Version:
    """Write the rows as the next version of the table and return it.

    With `only_partitions` they replace just the partitions that they have rows of, and the version
    shares the folders of all others with the one before.
    """
    spark = df.sparkSession
    before = versions(spark, path)
    number = max(published_numbers(spark, path)) + 1
    attempt = f"{number}-{uuid4().hex[:12]}"
    keys = ([partition_by] if partition_by else []) + [VERSION]
    rows = df.withColumn(VERSION, F.lit(attempt))
    with folders_at_once(spark):
        rows.write.mode("append").option("compression", "zstd").partitionBy(*keys).parquet(path)
    pattern, files = files_at(spark, f"{path}/{'*/' if partition_by else ''}{VERSION}={attempt}")
    root = files.makeQualified(files_at(spark, path)[0]).toString()
    new = [status.getPath().toString().removeprefix(f"{root}/") for status in files.globStatus(pattern) or []]
    version = Version(number, tuple(sorted(new)), df.schema)
    if only_partitions and before:
        replaced = {version.partition(folder) for folder in new}
        old = [folder for folder in before[-1].folders if version.partition(folder) not in replaced]
        version = Version(number, tuple(sorted([*new, *old])), df.schema)
    publish(spark, path, version)
    return version


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The newest version of the table, or the one of that number."""
    known = [v for v in versions(spark, path) if number in (None, v.number)]
    if not known:
        raise ValueError(f"no {'version' if number is None else f'version {number}'} of {path}")
    version = known[-1]
    if not version.folders:
        return spark.createDataFrame([], version.schema)
    full = StructType(list(version.schema.fields)).add(VERSION, StringType())
    reader = spark.read.schema(full).option("basePath", path)
    rows = reader.parquet(*[f"{path}/{folder}" for folder in version.folders])
    return rows.select(*[F.col(f"`{name}`") for name in version.schema.names])


def has_version(spark: SparkSession, path: str) -> bool:
    return bool(versions(spark, path))


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete what only older versions use, and what dead writers have left; returns how many folders.

    Folders that are numbered above the newest version may belong to a writer at work and stay.
    """
    known = versions(spark, path)
    if not known:
        return 0
    used = {folder for version in known[-keep:] for folder in version.folders}
    place, files = files_at(spark, path)
    root = files.makeQualified(place).toString()
    gone = 0
    for pattern in (f"{path}/{VERSION}=*", f"{path}/*/{VERSION}=*"):
        for status in files.globStatus(files_at(spark, pattern)[0]) or []:
            folder = status.getPath().toString().removeprefix(f"{root}/")
            number = int(folder.rpartition("=")[2].partition("-")[0])
            if folder not in used and number <= known[-1].number:
                files.delete(status.getPath(), True)
                gone += 1
    for version in known[:-keep]:
        files.delete(files_at(spark, f"{path}/{POINTERS}/{version.number:010d}.json")[0], False)
    return gone
