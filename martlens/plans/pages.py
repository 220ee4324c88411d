"""Deep result pages by a page directory, and search-after (L1).

``orderBy.offset.limit`` merges page x size rows in one task.  Here the result
is stored once, range partitioned by a total order, with a directory of one row
per partition: its number of rows and its first and last key.  Prefix sums over
the directory tell which partitions hold a page, and only these are read; a row
is ranked inside its partition.  A cursor (the last key of a page) continues
from its partition on, without counting what lies before.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART = "page_part"


def write_pages(hits: DataFrame, path: str, order: Sequence[str], partitions: int) -> None:
    """Store ``hits`` in ``partitions`` ranges of ``order``, a total order."""
    ranged = hits.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    dealt = ranged.withColumn(PART, F.spark_partition_id())
    dealt.write.partitionBy(PART).parquet(f"{path}/rows")
    spark = hits.sparkSession
    spark.createDataFrame([(dealt.schema.json(),)], "value string").coalesce(1).write.text(f"{path}/schema")
    stored = spark.read.schema(dealt.schema).parquet(f"{path}/rows")
    key = F.struct(*order)
    stored.groupBy(PART).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first"), F.max(key).alias("last")) \
        .coalesce(1).write.parquet(f"{path}/directory")


class Pages:
    """Pages of a stored result. The directory is read to the driver: one row
    per partition, whatever the number of rows."""

    def __init__(self, spark: SparkSession, path: str, order: Sequence[str]):
        self.spark, self.path, self.order = spark, path, list(order)
        self.schema = T.StructType.fromJson(json.loads(spark.read.text(f"{path}/schema").first()[0]))
        self.directory = sorted(spark.read.parquet(f"{path}/directory").collect(), key=lambda r: r[PART])
        self.total = sum(r["n"] for r in self.directory)

    def _rows(self, parts: Sequence[int]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/rows").filter(F.col(PART).isin(list(parts)))

    def last_page(self, size: int) -> int:
        return max(1, -(-self.total // size))

    def page(self, page_no: int, size: int) -> DataFrame:
        """Rows ``(page_no - 1) * size`` .. ``+ size`` in the order."""
        if page_no < 1 or size < 0:
            raise ValueError("page numbers start at 1 and size must be >= 0")
        lo, start, held = (page_no - 1) * size, 0, {}
        for r in self.directory:
            if start < lo + size and start + r["n"] > lo:
                held[r[PART]] = start
            start += r["n"]
        rows = self._rows(held)
        place = F.row_number().over(Window.partitionBy(PART).orderBy(*self.order)) - 1
        begins = F.lit(0)
        for part, n in held.items():
            begins = F.when(F.col(PART) == part, n).otherwise(begins)
        at = rows.withColumn("_at", place + begins).filter((F.col("_at") >= lo) & (F.col("_at") < lo + size))
        return at.orderBy("_at").drop("_at", PART)

    def after(self, cursor: Sequence, size: int) -> DataFrame:
        """The ``size`` rows that follow the key ``cursor`` (values of the order
        columns). No more partitions are read than hold them."""
        key, left, parts = tuple(cursor), size, []
        for r in self.directory:
            if tuple(r["last"]) <= key or left <= 0:
                continue
            parts.append(r[PART])
            left -= r["n"] if tuple(r["first"]) > key else 0    # how much of the first one follows is not known
        above, equal = F.lit(False), F.lit(True)
        for c, v in zip(self.order, key, strict=True):
            above, equal = above | (equal & (F.col(c) > F.lit(v))), equal & (F.col(c) == F.lit(v))
        return self._rows(parts).filter(above).orderBy(*self.order).limit(size).drop(PART)
