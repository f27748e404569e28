"""Folders for intermediate tables, below the one that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from functools import cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


@cache
def local_scratch() -> str:
    folder = tempfile.mkdtemp(prefix="rallybook-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def work_folder(spark: SparkSession) -> str:
    """A new folder below the shared one that `spark.checkpoint.dir` names. Only a local
    session without that setting uses a temporary folder of this machine.

    The caller owns the folder. It holds what a returned DataFrame still has to read, so it is
    left in place; `drop_folder` removes it once the result has been written.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = local_scratch()
    return f"{shared.rstrip('/')}/rallybook-{uuid4().hex}"


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder made by `work_folder`, or a table below one, in whatever store it is."""
    if "rallybook-" not in folder:
        raise ValueError(f"not a work folder: {folder}")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def stored(df: DataFrame, path: str, **options) -> DataFrame:
    """The rows written as Parquet and read again: lineage ends at files that outlive executors."""
    df.write.options(compression="zstd", **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
