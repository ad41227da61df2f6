"""Helpers that depend on the session: the shared work folder and size-checked broadcasts."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of at most a few hundred bytes each, so the largest broadcast is some 50 MB.
BROADCAST_ROWS = 200_000

# Less than this is not worth a task of its own.
TASK_BYTES = 16 << 20


def work_folder(spark: SparkSession) -> str:
    """A new, empty place in the folder the cluster shares (``spark.checkpoint.dir``).

    Only a local session may go without the setting: there every task sees the
    same disk, so a temporary folder will do.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(
                "set spark.checkpoint.dir to a folder all executors can reach, or pass work="
            )
        shared = tempfile.mkdtemp(prefix="dumptables-")
    return f"{shared.rstrip('/')}/dumptables-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the time of a block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


# A compressed file costs about as much to open as this much of it to read.
OPEN_BYTES = 128 << 10

# At least, for every core that reads dumps.
TASKS_PER_CORE = 4


def _fewest_tasks(spark: SparkSession) -> int:
    return TASKS_PER_CORE * spark.sparkContext.defaultParallelism


def full_splits(spark: SparkSession) -> dict[str, str]:
    """Settings for reading dumps: small files share a task until it has its fill of data.

    Spark counts 4 MB for opening a file, so that tasks would grow in number with the files,
    however small these are, and so would the files of all that is made from them.
    """
    set_to = int(spark._jsparkSession.sessionState().conf().filesOpenCostInBytes())
    fewest = spark.conf.get("spark.sql.files.minPartitionNum", None) or _fewest_tasks(spark)
    return {
        "spark.sql.files.openCostInBytes": str(min(set_to, OPEN_BYTES)),
        "spark.sql.files.minPartitionNum": str(fewest),
    }


def few_listings(spark: SparkSession) -> dict[str, str]:
    """Settings for listing dumps: some folders to a task. Spark gives each its own, up to 10,000."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    return {key: str(min(int(spark.conf.get(key)), _fewest_tasks(spark)))}


# A join on the scan task and more finds both sides dealt by the scan task alone.
SAME_TASK = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def wide_splits(spark: SparkSession) -> dict[str, str]:
    """Settings for reading intermediate tables: splits of 16 MB at least. Smaller ones may be
    wanted for compressed dumps, which are far larger once read; their tables need no more tasks."""
    set_to = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    return {"spark.sql.files.maxPartitionBytes": str(max(set_to, TASK_BYTES))}


def beside(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` (with ``scan_part`` among its join columns) hinted to come to the stage's rows:
    to all tasks when counted small, else to the task that holds the rows of its scan task.
    Either way the stage's rows stay where they are.
    """
    return F.broadcast(df) if is_bounded(df, rows or BROADCAST_ROWS) else df.hint("shuffle_hash")


def is_bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``rows`` rows. Meant for written tables, where counting
    reads file footers or a few narrow columns."""
    return df.count() <= rows


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` hinted for broadcast when counted small, else as it is.

    Beyond the bound the join is left to Spark: a shuffle join whose skewed
    partitions adaptive execution splits.
    """
    return F.broadcast(df) if is_bounded(df, rows) else df


def put_note(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; it appears whole or not at all."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path)
    draft = hadoop.Path(place.getParent(), f"_{place.getName()}")
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    out = store.create(draft, True)
    out.write(text.encode())
    out.close()
    store.delete(place, False)
    store.rename(draft, place)


def names_in(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Names in a folder that match, none if there is no such folder; one call however many."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(place):
        return []
    paths = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(store.listStatus(place))
    listed = spark._jvm.org.apache.commons.lang3.ArrayUtils.toString(paths)
    return re.findall(rf"/({pattern})(?=,|\}}$)", listed)


def delete_folder(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def together(spark: SparkSession, *actions: Callable[[], object]) -> list:
    """Run independent actions at the same time, so that one fills the gaps of another."""
    if not actions:
        return []
    with ThreadPoolExecutor(max_workers=len(actions)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(a)) for a in actions]
        return [job.result() for job in running]
