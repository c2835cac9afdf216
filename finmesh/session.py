"""Session construction and shared-folder helpers.

On a cluster the session is created by the platform: we only *read* its
settings (``spark.checkpoint.dir`` in particular).  ``get_session`` is for
local runs and tests, and only fills settings that are still unset.
"""
from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings we want everywhere; applied only when the session leaves them unset.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows with whole texts: a batch lies in the JVM and in its Python worker, in each several times while it is worked on
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    # a record that repeats a field keeps the last, as a dict does
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def get_session(master: str | None = None, app: str = "finmesh",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply runtime SQL defaults that are unset, and make sure a checkpoint dir exists."""
    for k, v in _DEFAULTS.items():
        if spark.conf.get(k, None) is None and spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster (``spark.checkpoint.dir``).

    Only a local session without that setting gets a folder of its own; on a
    cluster a machine-local folder would not be seen by the executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="finmesh-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder (never machine-local on a cluster)."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def scratch_root(spark: SparkSession) -> str:
    return getattr(spark, "_finmesh_scratch", None) or f"{checkpoint_dir(spark).rstrip('/')}/finmesh-scratch"


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through the Hadoop FileSystem API (any shared file system)."""
    p, fs = _file_system(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def cleanup_scratch(spark: SparkSession) -> None:
    """Delete this session's scratch folder (landed pages, round trips,
    surrogate-key tables).  Results are lazy and may read it, so the caller
    says when they are no longer needed; ``scratch`` does so for a block."""
    delete_folder(spark, scratch_root(spark))


@contextmanager
def scratch(spark: SparkSession):
    """Scratch tables made inside the block are deleted at its end."""
    before = getattr(spark, "_finmesh_scratch", None)
    spark._finmesh_scratch = f"{scratch_root(spark)}/{uuid.uuid4().hex}"
    try:
        yield
    finally:
        done, spark._finmesh_scratch = spark._finmesh_scratch, before
        delete_folder(spark, done)


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Shuffle files of what is executed inside the block are deleted when it has been executed, not when the driver happens to
    collect garbage.  For frames that are stored and then read from there; a result that is lazy may be executed again."""
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREE_SHUFFLES) if before is None else spark.conf.set(_FREE_SHUFFLES, before)
