"""Session settings and the shared folder that lineage cuts are written to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession


SHUFFLES_REMOVED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(app_name: str = "shelfmark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and a UTC clock.

    Shuffle partitions are left to the cluster's own setting; adaptive
    execution coalesces them to the real data size.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor reaches: ``spark.checkpoint.dir``. Unset, a local one serves in local mode only."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or _folders.get(spark.sparkContext.applicationId)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        if spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        shared = _folders[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="shelfmark-checkpoint-")
    return shared.rstrip("/")


_folders: dict[str, str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder, removed when the driver ends, also after ``spark.stop()``.

    Hadoop's file system removes the folder as it is closed by the driver's JVM.
    """
    home = f"{shared_folder(spark)}/shelfmark-{name}-{uuid.uuid4().hex}"
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(home)
    files = target.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(target)
    files.deleteOnExit(target)
    return f"{home}/data"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the frame as Parquet to the shared folder and read it back.

    Needed where several consumers must see the same rows, also after an executor is
    lost. The copy has statistics, and later steps read only the columns they use. The
    shuffle files of the write are removed with its end, not when the driver's JVM happens to collect them.
    """
    spark = df.sparkSession
    path = scratch(spark, "cut")
    before = spark.conf.get(SHUFFLES_REMOVED)
    spark.conf.set(SHUFFLES_REMOVED, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLES_REMOVED, before)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, sources: DataFrame, task_bytes: int, *keys: str | Column) -> DataFrame:
    """The frame by the hash of ``keys``, in tasks for about ``task_bytes`` of the files that ``sources`` comes from.

    With the cluster's number of shuffle partitions alone, a task's share grows with the input; here the number of
    tasks does. As long as the cluster's number is enough, it is left to adaptive execution.
    """
    jvm, conf = df.sparkSession._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file)) for file in sources.inputFiles()]
    tasks = -(-sum(path.getFileSystem(conf).getFileStatus(path).getLen() for path in paths) // task_bytes)
    enough = tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(*keys) if enough else df.repartition(tasks, *keys)


def side_by_side(spark: SparkSession, work: Callable, items: list) -> list:
    """The results of ``work`` on each item, in their order; the jobs of all items share the cores."""
    if not items:
        return []
    with ThreadPoolExecutor(len(items)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), items))
