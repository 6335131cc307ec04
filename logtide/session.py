"""Session settings and the shared work folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names, and
a session without it is an error. Only a local session, whose driver and tasks
are one process, gets a fresh folder of its own.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "logtide", shuffle_partitions: int = 8,
                  max_partition_mb: int = 128, shared_path: str | None = None) -> SparkSession:
    """Session with the settings the operators assume.

    ``shared_path`` names the folder that the driver and all executors reach;
    it goes to ``spark.checkpoint.dir``.

    On a cluster, size ``shuffle_partitions`` so a post-shuffle partition is
    about 128-256 MB (AQE coalesces smaller ones and splits skewed ones), and
    ``max_partition_mb`` so a scan split fits an executor core's memory share.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.files.maxPartitionBytes", f"{max_partition_mb}m")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    if master:
        builder = builder.master(master)
    if shared_path:
        builder = builder.config(CHECKPOINT_CONF, shared_path)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Text times in both log formats are read and written in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _is_local(spark: SparkSession) -> bool:
    return re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "local")) is not None


def shared_dir(spark: SparkSession) -> str:
    """Root folder every executor can reach: the session's checkpoint dir.

    Where a local session names none, one is made here; any other session
    must name it, since tasks elsewhere would not see a folder of the driver.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not _is_local(spark):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that the driver and all executors share "
                               "(build_session(shared_path=...))")
        root = tempfile.mkdtemp(prefix="logtide-")
        spark.conf.set(CHECKPOINT_CONF, root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system it is in; a missing one is fine."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def session_id(spark: SparkSession) -> str:
    """Identifier of the running application (for per-session memoisation)."""
    app = spark.conf.get("spark.app.id", None)
    return app or str(id(spark))


# Runs of one query whose stored tables are kept: frames returned by older runs can no longer be read.
KEEP_RUNS = 3
_RUNS: dict[tuple, list[list[str]]] = defaultdict(list)
_OPEN: list[list[str]] = []


@contextmanager
def query_run(spark: SparkSession, name: str) -> Iterator[None]:
    """Notes the folders that a query stores; drops those of its runs before the last ``KEEP_RUNS``."""
    runs = _RUNS[session_id(spark), name]
    runs.append([])
    _OPEN.append(runs[-1])
    try:
        yield
    finally:
        _OPEN.pop()
        while len(runs) > KEEP_RUNS:
            for path in runs.pop(0):
                delete_path(spark, path)


@atexit.register
def _drop_all() -> None:
    """At the end of the driver, stored tables of a session that is still there are dropped."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        return
    try:
        for runs in _RUNS.values():
            for path in (p for run in runs for p in run):
                delete_path(spark, path)
    except Exception:  # the JVM has gone first
        return


def new_work_dir(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A fresh, unique sub-folder of the shared folder for one job run; ``keep`` it until the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    if keep:
        _RUNS[session_id(spark), ""].append([path])
    elif _OPEN:
        _OPEN[-1].append(path)
    return path


def checkpointed(df, name: str = "stage"):
    """Store a (small, derived) DataFrame as a table in the shared folder and read it back.

    Cuts its lineage: later steps read the stored rows instead of recomputing
    them from the source, executors lost afterwards cost nothing, and the
    stored size is known before the next join is planned. One job, no
    recomputation (unlike an unpersisted ``checkpoint()``).
    """
    spark = df.sparkSession
    path = new_work_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
