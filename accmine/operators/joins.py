"""Spreading narrow work over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TASK_BYTES = 128 << 20    # input bytes meant for one task


def scan_tasks(df: DataFrame, splittable: bool = True) -> tuple[int, int] | None:
    """(tasks that the scan can use, estimated bytes), from the file listing and the plan's statistics only:
    no job runs. None if the plan does not read files or gives no estimate."""
    try:
        files = len(df._jdf.inputFiles())          # counted there: no path comes to Python
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:        # no classic plan (Spark Connect)
        return None
    if not files or size >= 1 << 60:
        return None
    per_split = int(df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    return (max(files, -(-size // per_split)) if splittable else files), size


def spread(df: DataFrame, keys, partitions: int | None = None, splittable: bool = True, expansion: float = 1.0,
           task_bytes: int = TASK_BYTES) -> DataFrame:
    """Hash-repartition ``df`` on ``keys`` if its scan would leave the cluster idle or its tasks too large.

    Splittable files are cut by Spark itself: they are spread only when the whole input has fewer splits
    than the cluster has cores. Files that cannot be split (gzip) are one task each: they are spread, to
    about ``task_bytes`` of expanded content a task, when they are fewer than the cores or larger than that.
    Hashing on the keys (not round-robin) keeps the assignment the same when a task is retried."""
    if partitions is None:
        scan = scan_tasks(df, splittable)
        if scan is None:
            return df
        tasks, size = scan
        cores = df.sparkSession.sparkContext.defaultParallelism
        wanted = max(cores, -(-int(size * expansion) // task_bytes))
        if tasks >= (cores if splittable else wanted):
            return df
        partitions = cores if splittable else wanted
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return df.repartition(partitions, F.xxhash64(*cols))
