"""Session helpers: default configuration and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings a job of this library expects.  On a cluster they come from the
# cluster configuration; ``local_session`` sets them for tests and the bench.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "loadworks") -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session
    without that setting (tests) gets a folder of its own; on a cluster a
    missing setting is an error, because a machine-local folder would be a
    different one on every executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    shared = sc.getConf().get("spark.checkpoint.dir", None)
    if not shared:
        shared = local_scratch(sc.master)
    sc.setCheckpointDir(shared)
    return sc.getCheckpointDir() or shared


def local_scratch(master: str) -> str:
    """A temporary folder for a session whose only machine is this one."""
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"spark.checkpoint.dir is not set (master {master}): name a folder "
                           "that the driver and all executors share")
    return tempfile.mkdtemp(prefix="loadworks-ckpt-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder.

    Used for files a job writes and reads back (landing files, swap tables).
    Spark's cleaner does not know these folders: use ``scratch`` for those that
    are not needed after a block of code, or ``drop_scratch``.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/loadworks-{name}-{uuid.uuid4().hex[:12]}"
    _made(spark).append(("path", path))
    return path


def scratch_database(spark: SparkSession, name: str = "lw_scratch") -> str:
    """A session-catalog database whose files live in the shared folder."""
    db = f"{name}_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch_path(spark, db)}'")
    _made(spark).append(("database", db))
    return db


_MADE: dict[str, list[tuple[str, str]]] = {}


def _made(spark: SparkSession) -> list[tuple[str, str]]:
    return _MADE.setdefault(spark.sparkContext.applicationId, [])


def _drop(spark: SparkSession, kind: str, name: str) -> None:
    if kind == "database":
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
        return
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_scratch(spark: SparkSession, since: int = 0) -> int:
    """Drop the scratch databases and folders made by this session after the first
    ``since``; returns how many there are left.  Results that read them must be
    written by then."""
    made = _made(spark)
    while len(made) > since:
        _drop(spark, *made.pop())
    return len(made)


@contextmanager
def scratch(spark: SparkSession, name: str):
    """A scratch folder that is dropped at the end of the block."""
    path = scratch_path(spark, name)
    try:
        yield path
    finally:
        _made(spark).remove(("path", path))
        _drop(spark, "path", path)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Drops all scratch databases and folders that the block made."""
    before = len(_made(spark))
    try:
        yield
    finally:
        drop_scratch(spark, before)
