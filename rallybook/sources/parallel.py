"""Spark jobs submitted together, so that small ones do not leave the cluster idle, and tasks that write
several folders at once."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

JOBS_AT_ONCE = 8
FOLDERS_AT_ONCE = 32
FOLDERS_SETTING = "spark.sql.maxConcurrentOutputFileWriters"
at_work: dict[int, int] = {}
setting = Lock()


def run_together(spark: SparkSession, jobs: list[Callable[[], None]]) -> None:
    """Run the jobs, several at a time; the first failure is raised after all have ended."""
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    for job in running:
        job.result()


@contextmanager
def folders_at_once(spark: SparkSession):
    """While it lasts, tasks that write into a folder per value keep a file open for each instead of sorting
    their rows, which spills if there are many. Beyond `FOLDERS_AT_ONCE` folders a task sorts the rest.

    A setting of the session that is there already stays. Jobs that run together share it: the last one to
    end takes it back.
    """
    session = id(spark)
    with setting:
        ours = at_work.get(session, 0)
        if ours or int(spark.conf.get(FOLDERS_SETTING)) == 0:
            at_work[session] = ours + 1
            spark.conf.set(FOLDERS_SETTING, FOLDERS_AT_ONCE)
    try:
        yield
    finally:
        with setting:
            if session in at_work:
                at_work[session] -= 1
                if not at_work[session]:
                    del at_work[session]
                    spark.conf.unset(FOLDERS_SETTING)
