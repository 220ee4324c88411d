"""Tables on shared storage that cut lineage between Spark jobs.

A job that loses executors re-reads such a table instead of repeating
everything before it.  The folder is the one the cluster names in
``spark.checkpoint.dir``; a local master without that setting (tests) gets a
temporary one, any other master without it is refused.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

import martlens
from martlens.session import forget_at_exit, is_local
from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_SHIPPED: set[str] = set()


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXT_ROWS = "2000"      # texts of a few KB: batches of some MB instead of some ten


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, and make
    Arrow batches small where the session leaves their size at the default."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        if not spark.sparkContext.getConf().contains(BATCH_ROWS) and spark.conf.get(BATCH_ROWS) == "10000":
            spark.conf.set(BATCH_ROWS, TEXT_ROWS)
        home = os.path.dirname(os.path.abspath(martlens.__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="martlens-ship-"), "martlens")
        spark.sparkContext.addPyFile(shutil.make_archive(archive, "zip", os.path.dirname(home), "martlens"))
        _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not is_local(spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="martlens-llm-")
    return _LOCAL[app]


def partitions(spark: SparkSession) -> int:
    """Reduce tasks of a job: the session's setting, which is sized to the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Workspace:
    """Intermediate tables of one run of an operator.  A result may read them
    for as long as the driver process lives; when it ends they are deleted."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.path = f"{shared_dir(spark)}/martlens-llm/{name}-{uuid.uuid4().hex}"
        forget_at_exit(spark, self.path)

    def save(self, df: DataFrame, name: str, compression: str = "zstd",
             partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Write ``df`` once and return the stored table."""
        out = f"{self.path}/{name}"
        writer = df.write.option("compression", compression)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(out)
        return self.spark.read.schema(df.schema).parquet(out)

    def drop(self, name: str) -> None:
        """Delete a table of this run that no later step reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
