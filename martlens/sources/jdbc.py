"""Relational sources (S4-S6, K8): the user table of record over JDBC.

The reference looks one user up per row; here a batch's unknown ids are looked
up together.  They go to the database as ``IN`` lists, several queries side by
side, so it reads these users by their key and nobody else; a whole-table read
is there for loading the dimension.  A JDBC driver must be on the classpath.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The four user columns the enrichment keeps.
USER_COLUMNS = ("id", "user_level", "birthday", "gender")
IDS_PER_QUERY = 500
IDS_AT_ONCE = 50_000        # ids brought to the driver together, to be written into queries


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str],
              key: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """A table over JDBC; with ``key``/``lower``/``upper``/``num_partitions`` the
    read is split into that many range queries on the key."""
    if key is not None and None not in (lower, upper, num_partitions):
        return spark.read.jdbc(url, table, column=key, lowerBound=lower, upperBound=upper,
                               numPartitions=num_partitions, properties=properties)
    return spark.read.jdbc(url, table, properties=properties)


def users_from_jdbc(spark: SparkSession, url: str, properties: dict[str, str], table: str = "user_info",
                    **split) -> DataFrame:
    """The user dimension with the four kept columns (pruned at the source);
    join it with ``martlens.operators.sale_detail.enrich_users``."""
    return read_jdbc(spark, url, table, properties, **split).select(*USER_COLUMNS)


def in_lists(ids: Sequence[str], column: str = "id", per_query: int = IDS_PER_QUERY) -> list[str]:
    """Predicates that together name every id once, ``per_query`` ids each."""
    quoted = ["'" + str(i).replace("'", "''") + "'" for i in sorted(set(ids))]
    return [f"{column} IN ({', '.join(quoted[k:k + per_query])})" for k in range(0, len(quoted), per_query)]


def rows_by_id(ids: DataFrame, read: Callable[[list[str]], DataFrame], column: str = "id",
               per_query: int = IDS_PER_QUERY, at_once: int = IDS_AT_ONCE) -> DataFrame | None:
    """Rows that ``read`` finds for the ``id`` column of ``ids``.  ``read`` takes
    a list of predicates, one query each.  Ids come to the driver ``at_once`` at a
    time at most (but for the unevenness of a hash); None when there are none."""
    ids = ids.select("id").filter(F.col("id").isNotNull()).distinct().persist()
    try:
        rounds = -(-ids.count() // at_once)
        part = F.pmod(F.xxhash64("id"), F.lit(max(1, rounds)))
        found = [read(in_lists([str(r.id) for r in ids.filter(part == k).collect()], column, per_query)) for k in range(rounds)]
    finally:
        ids.unpersist()
    return reduce(DataFrame.unionByName, found) if found else None


def user_lookup_jdbc(spark: SparkSession, url: str, properties: dict[str, str], table: str = "user_info",
                     **sizes: int) -> Callable[[DataFrame], DataFrame]:
    """A lookup of users by id at the database, for ``user_lookup``."""
    def lookup(ids: DataFrame) -> DataFrame:
        found = rows_by_id(ids, lambda predicates: spark.read.jdbc(url, table, predicates=predicates, properties=properties)
                           .select(*USER_COLUMNS), **sizes)
        return found if found is not None else spark.createDataFrame([], ", ".join(f"{c} string" for c in USER_COLUMNS))

    return lookup
