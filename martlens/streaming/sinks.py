"""Sinks (K2-K4, K7-K10, T7).

``KeyedStore`` is the upsert target: merge-on-read over immutable batch
folders. Each micro-batch writes ``<root>/mlbatch=<id>/<partition cols>``; a
replay of the same batch id overwrites exactly that folder, so a retried or
re-run batch is idempotent. Readers take the latest version per key with a
partially aggregated ``groupBy`` (``martlens.operators.keyed``). No path is
ever overwritten while it is read, and nothing passes through the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from martlens.operators.keyed import last_per_key

BATCH_COL = "mlbatch"
POINTER = "current.pointer"


class KeyedStore:
    """``key`` columns name a row, ``version`` columns order its versions within
    a batch. ``schema`` (DDL) is what an empty store reads as."""

    def __init__(self, root: str, key: str | Sequence[str], version: Sequence[str] = (),
                 partition_by: Sequence[str] = (), schema: str | None = None):
        self.root = root.rstrip("/")
        self.keys = [key] if isinstance(key, str) else list(key)
        self.version = list(version)
        self.partition_by = list(partition_by)
        self.schema = schema

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Upsert one micro-batch (K2/K3). An empty batch leaves an empty
        folder, which reads as no rows. A row without a (string) key is a
        document of its own, as an index would number it: its id is the batch
        and its place in it, so a replay replaces it. Partition columns are
        never filled; reject rows without them before."""
        (self.named(batch, batch_id).write.mode("overwrite").partitionBy(*self.partition_by)
             .parquet(f"{self.root}/{BATCH_COL}={int(batch_id)}"))

    def named(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """``batch`` with keys for rows that have none."""
        rows = batch
        place = F.concat_ws("-", F.lit(str(int(batch_id))), F.monotonically_increasing_id().cast("string"))
        for k in self.keys:
            if dict(batch.dtypes)[k] == "string" and k not in self.partition_by:
                rows = rows.withColumn(k, F.coalesce(F.col(k), place))
        return rows

    def sink(self) -> Callable[[DataFrame, int], None]:
        return self.write_batch

    # -- reading

    def _current(self, spark: SparkSession) -> dict | None:
        """What the pointer file names: the compacted folder and the last batch in it."""
        try:
            return json.loads(spark.read.text(f"{self.root}/{POINTER}").first()[0])
        except AnalysisException as e:
            if not _is_missing(e):
                raise
            return None

    def _folder(self, spark: SparkSession, path: str) -> DataFrame | None:
        try:
            return spark.read.option("basePath", self.root).parquet(path)
        except AnalysisException as e:
            if not _is_missing(e):
                raise
            return None

    def raw(self, spark: SparkSession) -> DataFrame:
        """Every version that still counts, with the writing batch id in
        ``mlbatch`` (the last compacted one for compacted rows). Partition
        columns come back as the strings they are in the path."""
        now = self._current(spark)
        df = self._folder(spark, f"{self.root}/{BATCH_COL}=*")
        if now is not None:
            base = spark.read.parquet(f"{self.root}/{now['base']}").withColumn(BATCH_COL, F.lit(now["through"]).cast("long"))
            df = base if df is None else base.unionByName(df.filter(F.col(BATCH_COL) > now["through"]).withColumn(
                BATCH_COL, F.col(BATCH_COL).cast("long")))
        if df is None:
            if self.schema is None:
                raise FileNotFoundError(f"nothing stored under {self.root}, and no schema given")
            df = spark.createDataFrame([], f"{self.schema}, {BATCH_COL} long")
        for c in self.partition_by:
            df = df.withColumn(c, F.col(c).cast("string"))
        return df

    def read(self, spark: SparkSession) -> DataFrame:
        """Latest row per key: later batch wins, then the version columns."""
        return self.latest(self.raw(spark))

    def latest(self, raw: DataFrame) -> DataFrame:
        return last_per_key(raw, self.keys, [BATCH_COL, *self.version]).drop(BATCH_COL)

    def compact(self, spark: SparkSession, through: int) -> None:
        """Fold all batches up to ``through`` (committed ones) into one folder
        of latest rows. Readers follow the pointer file, which is replaced by
        one rename after the folder is complete; a reader that planned before
        still finds the old folders, which only ``vacuum`` removes."""
        base = f"base-{int(through):012d}-{uuid.uuid4().hex[:8]}"
        raw = self.raw(spark).filter(F.col(BATCH_COL) <= int(through))
        self.latest(raw).write.partitionBy(*self.partition_by).parquet(f"{self.root}/{base}")
        _replace_text(spark, f"{self.root}/{POINTER}", json.dumps({"base": base, "through": int(through)}))

    def compact_by_turns(self, spark: SparkSession, batch_id: int, every: int) -> None:
        """To be called at the end of every micro-batch: each ``every`` batches,
        fold the committed ones (those before ``batch_id``), and delete what the
        compaction before had made superfluous.  Readers so have ``every``
        batches of time to finish with an old plan.  0 turns it off."""
        if not every or int(batch_id) % every != every - 1 or int(batch_id) < 1:
            return
        last = self._current(spark)
        if last is not None and last["through"] >= int(batch_id) - 1:
            return      # a replay of this batch
        if last is None and self._folder(spark, f"{self.root}/{BATCH_COL}=*") is None:
            return      # nothing written yet
        self.compact(spark, int(batch_id) - 1)
        if last is not None:
            self._delete(spark, last["through"], {last["base"], self._current(spark)["base"]})

    def vacuum(self, spark: SparkSession) -> None:
        """Delete the folders that the current pointer has made superfluous.
        Call it when no reader that planned before the last ``compact`` runs."""
        now = self._current(spark)
        if now is not None:
            self._delete(spark, now["through"], {now["base"]})

    def _delete(self, spark: SparkSession, through: int, keep: set[str]) -> None:
        fs, root = _fs(spark, self.root)
        for f in fs.listStatus(root):
            name = f.getPath().getName()
            old_batch = name.startswith(f"{BATCH_COL}=") and int(name.split("=")[1]) <= through
            if old_batch or (name.startswith("base-") and name not in keep):
                fs.delete(f.getPath(), True)


def _is_missing(e: AnalysisException) -> bool:
    return e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside ``path`` and rename it over."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs, _ = _fs(spark, path)
    draft = hadoop.Path(f"{path}.{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
    context = hadoop.FileContext.getFileContext(draft.toUri() if draft.toUri().getScheme() else fs.getUri(),
                                                spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(draft), fs.makeQualified(hadoop.Path(path)), options)


def upper_case_columns(df: DataFrame) -> DataFrame:
    """Column names upper-cased, for targets whose columns are matched by
    upper-cased field name."""
    return df.toDF(*[c.upper() for c in df.columns])


def append_by_batch(root: str, partition_by: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """Idempotent append (K7/K8 style): batch ``id`` always lands in the same
    folder, replacing any partial output of an earlier attempt."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{root.rstrip('/')}/{BATCH_COL}={int(batch_id)}")
    return write


def archive_logs(lines: DataFrame, path: str, checkpoint: str, date_col: str = "dt"):
    """K9: raw log lines archived as text, one folder per day."""
    return (lines.select("value", date_col).writeStream.format("text").partitionBy(date_col)
                 .option("checkpointLocation", checkpoint).start(path))


# A topic sink takes a stream of (topic, value) and returns its configured writer.
TopicSink = Callable[[DataFrame], DataStreamWriter]


def kafka_sink(servers: str) -> TopicSink:
    """K1: ``value`` to the topic named per row (connector needed at run time)."""
    def writer(rows: DataFrame) -> DataStreamWriter:
        return (rows.select("topic", F.col("value").cast("string").alias("value"))
                    .writeStream.format("kafka").option("kafka.bootstrap.servers", servers))
    return writer


def folder_sink(root: str) -> TopicSink:
    """The same as text folders ``topic=...``, one per topic, for tests and
    for chains without a broker (``text_stream`` reads such a folder)."""
    def writer(rows: DataFrame) -> DataStreamWriter:
        return rows.select("topic", "value").writeStream.format("text").partitionBy("topic").option("path", root)
    return writer


def to_jdbc(url: str, table: str, properties: dict[str, str]) -> Callable[[DataFrame, int], None]:
    """K8: append each micro-batch to a relational table. At-least-once: a
    replayed batch appends again, so give the target a key (or dedup on read)
    where duplicates matter."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.jdbc(url, table, mode="append", properties=properties)
    return write
