"""Serving tables: the sale-detail index partitioned by ``dt`` and the DAU
table partitioned by ``logDate``, so the dashboard's date term filter prunes
partitions instead of scanning history.

``materialize`` overwrites a path that nobody reads while it is written (use a
new path per build and switch readers afterwards); ``open_table`` reads it
back with partition values as the strings they were written from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.plans import queries as q


def materialize(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Write ``df`` clustered by its partition columns: a shuffle on them
    groups each day's rows into few files, and no driver round trip."""
    cols = list(partition_by)
    df.repartition(*cols).write.mode("overwrite").partitionBy(*cols).parquet(path)


def open_table(spark: SparkSession, path: str, partition_by: Sequence[str]) -> DataFrame:
    df = spark.read.parquet(path)
    for c in partition_by:
        df = df.withColumn(c, F.col(c).cast("string"))
    return df


def build_sale_index(spark: SparkSession, sf_dir: str, path: str) -> None:
    materialize(q.sale_detail_q(spark, sf_dir), path, ["dt"])


def build_dau_table(spark: SparkSession, sf_dir: str, path: str) -> None:
    materialize(q.dau_first(spark, sf_dir), path, ["logDate"])


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Save ``df`` as a catalog table bucketed and sorted by ``key``. Two
    tables bucketed the same way on the join key (e.g. orders and lineitem
    on the order key) join with a sort-merge join that needs no exchange on
    either side -- the shuffle is paid once, at write time."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
