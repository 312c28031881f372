"""Sizing and shared scratch space for jobs that run on a cluster."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIB = 1024 * 1024
# A shuffle keeps one block per (map task, reduce task) pair. Both sides are bounded so that the
# driver's block tables stay small at 100 TB; beyond the bounds tasks get larger and spill.
MAX_SCAN_TASKS = 100_000
MAX_SHUFFLE_TASKS = 20_000
SCAN_BYTES_PER_TASK = 128 * MIB
SHUFFLE_BYTES_PER_TASK = 256 * MIB

# Settings to start a cluster session with. The sizes that depend on the input are set per job by
# `sized_for`; adaptive execution joins shuffle partitions that turn out small. The learner and the
# evaluator exchange statistics between as many tasks as `spark.default.parallelism` says, whatever the
# scan's width is.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.default.parallelism": "2000",
}


def input_bytes(spark: SparkSession, path: str) -> int:
    """Bytes below `path` (glob allowed), asked from the file system that holds it; compressed files count
    as they are stored."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(target) or []
    return sum(fs.getContentSummary(status.getPath()).getLength() for status in found)


def qualified(spark: SparkSession, path: str) -> str:
    """The path as its file system names it: with scheme, without `..`, on a local disk without links."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    target = fs.makeQualified(target)
    if target.toUri().getScheme() == "file":
        return f"file:{jvm.java.io.File(target.toUri().getPath()).getCanonicalPath()}"
    return target.toString().rstrip("/")


def matches(spark: SparkSession, path: str) -> list[str]:
    """What a path or glob names, qualified; the path itself if there is nothing."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [status.getPath().toString() for status in fs.globStatus(target) or []]
    return [qualified(spark, p) for p in found or [path]]


def is_inside(path: str, folder: str) -> bool:
    """Whether a qualified path is the folder or lies in it."""
    return path == folder or path.startswith(f"{folder}/")


def shuffle_conf(
    total_bytes: int,
    current_partitions: int,
    max_scan_tasks: int = MAX_SCAN_TASKS,
    max_shuffle_tasks: int = MAX_SHUFFLE_TASKS,
) -> dict[str, str]:
    """Shuffle width and scan split size for work that exchanges the rows it reads.

    Holds only what must differ from the session's values: a wider shuffle, larger splits.
    """
    conf = {}
    if total_bytes > max_scan_tasks * SCAN_BYTES_PER_TASK:
        conf["spark.sql.files.maxPartitionBytes"] = str(math.ceil(total_bytes / max_scan_tasks))
    wanted = min(math.ceil(total_bytes / SHUFFLE_BYTES_PER_TASK), max_shuffle_tasks)
    if wanted > current_partitions:
        conf["spark.sql.shuffle.partitions"] = str(wanted)
    return conf


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Set session values for the actions inside the block, then put the old ones back."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@contextmanager
def sized_for(
    spark: SparkSession,
    total_bytes: int,
    max_scan_tasks: int = MAX_SCAN_TASKS,
    max_shuffle_tasks: int = MAX_SHUFFLE_TASKS,
) -> Iterator[dict[str, str]]:
    """Run the actions inside the block with scan and shuffle sizes that fit the input.

    The sizes hold for the whole session meanwhile; a job next to others should get a session of its own
    (`spark.newSession()`).
    """
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    conf = shuffle_conf(total_bytes, current, max_scan_tasks, max_shuffle_tasks)
    with session_conf(spark, conf):
        yield conf


def fixed_layout(df: DataFrame, tasks: int) -> DataFrame:
    """The rows in a layout that depends on nothing but their content and `tasks`: dealt out and sorted by a
    hash of the whole row, so that no key is hot. Costs one exchange."""
    content = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.repartition(tasks, content).sortWithinPartitions(content)


def scratch_dir(spark: SparkSession) -> str:
    """A new folder name in the shared space the cluster names in `spark.checkpoint.dir`.

    Only a local-mode session without that setting gets a folder on its own machine, removed at exit.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return f"{shared.rstrip('/')}/holdfast-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="holdfast-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
