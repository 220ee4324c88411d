"""Session helpers.

Library code never builds its own session: every operator takes DataFrames and
returns DataFrames. These helpers are for scripts, tests and the benchmark.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a cluster deployment should also carry; none of them is a cap.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "martlens",
                  warehouse: str | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    if warehouse:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    builder = (builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("MARTLENS_DRIVER_MEMORY", "8g")))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(master: str) -> bool:
    """Do driver and executors share one process (and so its folders)?"""
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session names none and no checkpoint folder is set yet
    (local tests) do we create one under the system temp folder; on a cluster
    the setting must point at shared storage.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if not is_local(sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="martlens-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


_SCRATCH: dict[str, SparkSession] = {}


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables under the shared checkpoint folder.
    Its tables may be read as long as this driver process lives; then it is
    deleted."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/martlens/{name}-{uuid.uuid4().hex}"
    forget_at_exit(spark, path)
    return path


def forget_at_exit(spark: SparkSession, path: str) -> None:
    """Delete ``path`` when this driver process ends."""
    if not _SCRATCH:
        atexit.register(_forget)
    _SCRATCH[path] = spark


def _forget() -> None:
    for path, spark in _SCRATCH.items():
        with contextlib.suppress(Exception):     # a session that is already gone cannot delete any more
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    _SCRATCH.clear()
