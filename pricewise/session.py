"""Session helpers: build a local session for tests/bench, and resolve the shared
checkpoint/scratch location from the session's own configuration."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "pricewise", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. UI off, AQE on, UTC, Arrow on.

    A checkpoint directory is set only here (tests/bench), and only when the
    caller did not name one: on a cluster the operator reads it from the session.
    """
    parts = shuffle_partitions or (8 if cores == "*" else max(int(cores), 1))
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.default.parallelism", str(parts))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("PRICEWISE_DRIVER_MEMORY", "16g")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_single_jvm(master: str) -> bool:
    """``local`` and ``local[...]``: executors are threads of the driver. ``local-cluster``
    has processes of its own."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint directory, set on the SparkContext.

    It is the session's: the context's current one, or ``spark.checkpoint.dir``. Only where
    neither is set and the whole session is one JVM (tests, bench) a temporary folder is
    made, and removed when Python ends; on a cluster a machine-local folder would not
    survive executor loss.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no context; only the session setting is available
        return spark.conf.get(CHECKPOINT_CONF, None)
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get(CHECKPOINT_CONF, None)
    if not conf and _is_single_jvm(sc.master):
        conf = tempfile.mkdtemp(prefix="pricewise-ckpt-")
        atexit.register(shutil.rmtree, conf, ignore_errors=True)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    return None


_scratch: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for sinks and round trips; see
    ``remove_scratch``."""
    base = ensure_checkpoint_dir(spark)
    if not base:
        raise RuntimeError(
            f"no shared folder: set {CHECKPOINT_CONF} on the session before writing tables")
    path = f"{base.rstrip('/')}/pricewise-scratch/{name}-{uuid.uuid4().hex[:12]}"
    _scratch.add(path)
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Delete the scratch paths that this process has made, once no frame reads them any
    more. Works on any file system that Spark writes to; returns the number deleted."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    gone = 0
    for path in sorted(_scratch):
        p = jvm.org.apache.hadoop.fs.Path(path)
        gone += bool(p.getFileSystem(conf).delete(p, True))
        _scratch.discard(path)
    return gone
