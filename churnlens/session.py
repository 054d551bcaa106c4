"""Session construction and the shared working folder.

On a cluster the shared folder comes from ``spark.checkpoint.dir`` (set by the
cluster owner to a shared filesystem). Only when that is unset — local tests —
do we create a private folder and register it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

#: Settings every job relies on. Time parts are computed in UTC; AQE re-plans
#: joins and coalesces small shuffle partitions; skew-join splitting handles a
#: hot user that survives the explicit salting.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: Suggested settings for the full-size log (hundreds of TB on ~1000
#: executors). Shuffle partitions start high and AQE coalesces them to the
#: advisory size; files are read in 256 MB splits.
CLUSTER_CONF = {
    **CORE_CONF,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
}

#: For a session that trains several models at a time (to be set when it starts): jobs of
#: different pools share the executors.
FAIR_CONF = {"spark.scheduler.mode": "FAIR"}

#: Upper bound of rows for a side that may be broadcast (see operators.joins).
MAX_BROADCAST_ROWS_KEY = "spark.churnlens.maxBroadcastRows"
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000  # ~60 MB of (userId, count) pairs
#: ... and of its size as a written table.
MAX_BROADCAST_BYTES_KEY = "spark.churnlens.maxBroadcastBytes"
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "churnlens", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the core settings."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = {
        **CORE_CONF,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_core_conf(spark)
    return spark


def ensure_core_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable core settings to an existing session. They stay with the session:
    its later plans (among them the lazy results of the caller) depend on the time zone."""
    for k, v in CORE_CONF.items():
        spark.conf.set(k, v)
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone != CORE_CONF["spark.sql.session.timeZone"]:
        raise RuntimeError(f"hours, weekdays and months are computed in UTC; the session's time zone is {zone}")


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide working folder: the session's checkpoint directory.

    Set only for a local master that has none (local runs and tests): on a
    cluster a folder of this machine would not reach the executors.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            d = tempfile.mkdtemp(prefix="churnlens-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d.rstrip("/")


#: Paths handed out inside the innermost ``scratch`` of this context, in order. Threads have contexts
#: of their own; one that works for a ``scratch`` runs in a copy of its context.
_inside: ContextVar[list[str] | None] = ContextVar("scratch_paths", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder. Outside any ``scratch`` it stays until the
    caller (or the folder's owner) deletes it."""
    path = f"{shared_dir(spark)}/churnlens/{name}-{uuid.uuid4().hex[:12]}"
    mine = _inside.get()
    if mine is not None:
        mine.append(path)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    mine = _inside.get()
    if mine is not None and path in mine:
        mine.remove(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Scratch tables written inside (by this context) are deleted at the end: for jobs that write
    their result elsewhere before they return."""
    token = _inside.set([])
    try:
        yield
    finally:
        mine = _inside.get() or []
        _inside.reset(token)
        for path in mine:
            drop_path(spark, path)


def carried(spark: SparkSession, f: Callable) -> Callable:
    """``f`` of one argument, to be run by other threads with this one's job group, scheduler pool and
    scratch tables."""
    here, inside = copy_context(), inheritable_thread_target(spark)(f)
    return lambda x: here.copy().run(inside, x)  # a context runs in one thread at a time


def max_broadcast_bytes(spark: SparkSession) -> int:
    v = spark.conf.get(MAX_BROADCAST_BYTES_KEY, None)
    return int(v) if v else DEFAULT_MAX_BROADCAST_BYTES


def max_broadcast_rows(spark: SparkSession) -> int:
    v = spark.conf.get(MAX_BROADCAST_ROWS_KEY, None)
    return int(v) if v else DEFAULT_MAX_BROADCAST_ROWS
