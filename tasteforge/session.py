"""Session set-up and the one place where intermediate tables are written."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def shuffle_partitions(shuffled_bytes: int, cores: int, target_bytes: int = 256 << 20) -> int:
    """How many reduce partitions keep each near ``target_bytes``; AQE merges those that turn out small.

    Never fewer than two per core, and no more than 100,000, which the driver still tracks well.
    """
    return max(2 * cores, min(100_000, -(-shuffled_bytes // target_bytes)))


def build_session(app_name: str = "tasteforge", conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the defaults above; the master comes from spark-submit unless ``conf`` sets it."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _machine_local(path: str) -> bool:
    """Whether a path lies in a temporary folder, which every machine of a cluster has of its own."""
    plain = re.sub("/+", "/", path.removeprefix("file:"))
    folders = {"/tmp", "/var/tmp", "/dev/shm", tempfile.gettempdir()}
    return ("://" not in path or path.startswith("file:")) and any(plain == f or plain.startswith(f"{f}/") for f in folders)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local-mode session may do without one, or name a temporary folder; its own is deleted at exit.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    local = spark.sparkContext.master.startswith("local")
    if configured and (local or not _machine_local(configured)):
        return configured.rstrip("/")
    if not local:
        raise RuntimeError(f"set spark.checkpoint.dir to a folder shared by all executors, not {configured!r}")
    path = tempfile.mkdtemp(prefix="tasteforge-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir()


_scope: ContextVar[str] = ContextVar("intermediates", default="")


def _intermediates(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tasteforge-{spark.sparkContext.applicationId}{_scope.get()}"


def intermediate_path(spark: SparkSession, name: str) -> str:
    """A fresh place in the shared folder, dropped with the other intermediates."""
    return f"{_intermediates(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The stored table cuts the lineage: it outlives any executor, is not recomputed by the
    several jobs that read it, and row numbers given before the write stay fixed.
    """
    path = intermediate_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_intermediates(spark: SparkSession) -> None:
    """Delete every table materialized in the current scope. Call it when no result depends on them any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_intermediates(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scoped_intermediates(spark: SparkSession) -> Iterator[None]:
    """Tables materialized inside belong to this block and are deleted when it ends, also after a failure.

    Jobs that run side by side in one application each keep their own.
    """
    token = _scope.set(f"{_scope.get()}/{uuid.uuid4().hex}")
    try:
        yield
    finally:
        drop_intermediates(spark)
        _scope.reset(token)


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of the files under ``paths``; a path that is not there counts nothing."""
    total = 0
    for text in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(text)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(path):
            total += files.getContentSummary(path).getLength()
    return total
