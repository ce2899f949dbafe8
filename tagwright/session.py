"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import re
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are meant for. Broadcasts are left to AQE, which knows the
# measured size of a side; the planner's estimate alone never picks one. Joins
# whose measured partitions are small hash instead of sorting.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


# Shuffle data one task should get on a cluster.
TASK_BYTES = 128 * 1024 * 1024


def cluster_settings(shuffled_bytes: int) -> dict[str, str]:
    """Settings for a job that shuffles about ``shuffled_bytes``: enough initial
    partitions that none has to spill, merged by AQE where they turn out small."""
    partitions = max(200, -(-shuffled_bytes // TASK_BYTES))
    return {
        **RECOMMENDED,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES),
    }


def local_session(cpus: int | str = 8, **settings: str) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tagwright")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "12g")
    )
    for key, value in {**RECOMMENDED, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a folder of its own.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if path:
        return path
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tagwright-"))
    return context.getCheckpointDir()


_OWNER: ContextVar[str | None] = ContextVar("tagwright_scratch", default=None)


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tagwright"


def _application(spark: SparkSession) -> str:
    """The owner's name of this application; the prefix tells owned folders apart
    from whatever else lies there."""
    return f"owner-{spark.sparkContext.applicationId}"


def shared_path(spark: SparkSession) -> str:
    """A new folder name below the shared folder, in the folder of its owner: the
    innermost open ``scratch``, else the application."""
    owner = _OWNER.get() or _application(spark)
    return f"{_scratch_root(spark)}/{owner}/{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Owns the intermediates that are written inside it and removes them at its end,
    also after an error. Consume what reads them before: a DataFrame is lazy.

    The folder's name begins with the application's, so that ``sweep_scratch`` of a
    later application finds what a killed one left.
    """
    owner = f"{_application(spark)}-{uuid.uuid4().hex}"
    outer = _OWNER.set(owner)
    path = f"{_scratch_root(spark)}/{owner}"
    try:
        yield path
    finally:
        _OWNER.reset(outer)
        _remove(spark, path)


def release_scratch(spark: SparkSession) -> None:
    """Remove all intermediates of this application, at its end."""
    own = re.compile(re.escape(_application(spark)) + "(-[0-9a-f]{32})?")
    for name, folder in _owned(spark):
        if own.fullmatch(name):
            _remove(spark, folder)


def sweep_scratch(spark: SparkSession, idle_hours: float) -> list[str]:
    """Remove the folders of other applications in which nothing was begun or ended
    for ``idle_hours``, and return their names. Others may be at work in the shared
    folder: take more hours than the longest job. Only folders that an owner made
    are looked at."""
    if idle_hours <= 0:
        raise ValueError("idle_hours must be above the length of the longest job")
    own = _application(spark)
    oldest = time.time() - idle_hours * 3600
    swept = []
    for name, folder in _owned(spark):
        if name != own and not name.startswith(f"{own}-") and _last_change(spark, folder) < oldest:
            _remove(spark, folder)
            swept.append(name)
    return swept


def _owned(spark: SparkSession) -> list[tuple[str, str]]:
    folders = folders_like(spark, f"{_scratch_root(spark)}/owner-*")
    return [(folder.rstrip("/").rsplit("/", 1)[1], folder) for folder in folders]


def _last_change(spark: SparkSession, folder: str) -> float:
    """When the folder, or a table in it, last got a file, in seconds."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [system.getFileStatus(target), *system.listStatus(target)]
    return max(f.getModificationTime() for f in found) / 1000


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def write_shared(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and return the stored
    table: cuts lineage, survives lost executors, keeps column pruning."""
    spark = df.sparkSession
    path = path or shared_path(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def qualified(spark: SparkSession, path: str) -> str:
    """The full name of a path, as file listings show it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(target).toString()


def folders_like(spark: SparkSession, pattern: str) -> list[str]:
    """Folders whose names match a pattern with wildcards."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return [f.getPath().toString() for f in found or [] if f.isDirectory()]


def files_like(spark: SparkSession, pattern: str) -> frozenset[str]:
    """Names of the files that match a pattern with wildcards."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return frozenset(f.getPath().getName() for f in found or [] if not f.isDirectory())


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
