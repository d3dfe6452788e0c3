"""Session construction and shared scratch locations.

Staged files (corpus copies, feeds, stream checkpoints) go below the folder the
cluster names in ``spark.checkpoint.dir``, which is shared by all executors. A
machine-local folder is only chosen when nothing is configured (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # articles are large: keep Arrow batches to the UDF small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # the JVM never compiles a method above 8,000 bytes of bytecode: a stage whose generated method is larger
    # would be interpreted, so it runs operator by operator instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


# For a large cluster: start shuffles wide and let AQE merge them to ~256 MB, so partitions fit
# executor memory at any input size; split skewed join partitions; read large splittable files
# in 256 MB pieces. (Gzip corpus files are not splittable: one task per file regardless.)
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "accmine", extra: dict | None = None,
                  cluster: bool = False) -> SparkSession:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root; set a local one only when none is configured."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext; the cluster setting must exist
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise RuntimeError("spark.checkpoint.dir is not set")
        return root
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local["):   # executors elsewhere would not see a folder of this machine
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="accmine-ckpt-")  # tests / single machine only
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


_JOB: ContextVar[str | None] = ContextVar("accmine_job", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder path under the shared checkpoint root (not created), inside a ``job_scratch`` below
    its folder."""
    root = _JOB.get() or os.path.join(ensure_checkpoint_dir(spark).rstrip("/"), "accmine")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def job_scratch(spark: SparkSession):
    """What is staged inside goes when the block ends well; after a failure it stays, to be looked at. For
    jobs whose results are written elsewhere: a DataFrame that still reads a staged table must not leave."""
    own = scratch_path(spark, "job")
    token = _JOB.set(own)
    try:
        yield
    finally:
        _JOB.reset(token)
    path = spark._jvm.org.apache.hadoop.fs.Path(own)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def brief_shuffles(spark: SparkSession):
    """The shuffle files of each write or action inside go when it ends, and not when the driver happens to collect
    its garbage. For jobs that shuffle much again and again; a result computed twice would be shuffled twice."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
