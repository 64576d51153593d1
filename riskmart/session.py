"""Session construction and shared-storage scratch paths."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every riskmart job relies on. AQE re-plans joins and partition
# counts at run time; skew-join splitting keeps a hot key from landing in one task.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "riskmart", extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests. On a cluster use spark-submit settings."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.host", "127.0.0.1")
               .config("spark.driver.bindAddress", "127.0.0.1"))
    for key, value in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_ROOT: str | None = None


def shared_root(spark: SparkSession) -> str:
    """Directory on storage every executor can reach.

    Uses the cluster's ``spark.checkpoint.dir`` (or a checkpoint directory set
    on the context). Only on a ``local`` master, where driver and executors are
    one process, a fresh local directory is made when neither is set; any other
    master without a shared root is an error.
    """
    global _LOCAL_ROOT
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    try:
        root = spark.sparkContext.getCheckpointDir()
    except Exception:                       # no driver-side context (e.g. Spark Connect)
        root = None
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"spark.checkpoint.dir is not set and the master is {master!r}: intermediate "
                         "files need a folder that the driver and all executors share")
    if _LOCAL_ROOT is None:                 # one process: one directory for it
        _LOCAL_ROOT = tempfile.mkdtemp(prefix="riskmart-")
    return _LOCAL_ROOT


_AT_EXIT: list = []


def release_all() -> None:
    """Remove the directories that were kept for the program's end (of sessions that still run)."""
    while _AT_EXIT:
        scratch = _AT_EXIT.pop()
        if scratch.spark.sparkContext._jsc is not None and not scratch.spark.sparkContext._jsc.sc().isStopped():
            scratch.release()


atexit.register(release_all)


class Scratch:
    """One job's own directory of intermediate files under the shared root.

    Nothing else writes or deletes there. ``release`` (or leaving the ``with``
    block) removes it; call it only when no DataFrame that reads it is used any
    more. With ``until_exit`` it is removed when the driver program ends, for files
    that a returned DataFrame still reads.
    """

    def __init__(self, spark: SparkSession, name: str = "job", until_exit: bool = False):
        self.spark = spark
        self.root = f"{shared_root(spark)}/riskmart/{name}-{uuid.uuid4().hex}"
        self._count = 0
        if until_exit:
            _AT_EXIT.append(self)

    def path(self, name: str) -> str:
        """A path of its own for one set of files."""
        self._count += 1
        return f"{self.root}/{self._count:03d}-{name}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and read it back: cuts lineage, survives lost executors."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *exc) -> None:
        self.release()


_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within the block a query's shuffle files go when it ends, not when the driver next collects its garbage."""
    before = spark.conf.get(_REMOVE_SHUFFLES, None)
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REMOVE_SHUFFLES)
        else:
            spark.conf.set(_REMOVE_SHUFFLES, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared root; nothing deletes it but its user."""
    return f"{shared_root(spark)}/riskmart/{name}-{uuid.uuid4().hex[:12]}"
