"""User dimension and relational lookups.

The reference looks users up one row at a time (cache, then database); here
every lookup is a set-based join over the whole batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.operators.keyed import last_per_key


def latest_version(changes: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last write wins per key, by ``order`` (ingest sequence)."""
    keys = [key] if isinstance(key, str) else list(key)
    return last_per_key(changes, keys, order)


def fresh_dimension(dim: DataFrame, updated_at: str, now: F.Column, ttl_seconds: int = 86400) -> DataFrame:
    """Rows refreshed within ``ttl_seconds`` of ``now``. Expiry is only a
    cache policy; the values of live rows never change because of it."""
    return dim.filter(F.col(updated_at) >= now - F.expr(f"INTERVAL {int(ttl_seconds)} SECONDS"))


def scalar_per_key(keys: DataFrame, key: str, facts: DataFrame, fact_key: str, value: str,
                   default: int = 0) -> DataFrame:
    """S5 in bulk: for each key, the largest ``value`` among its facts as a
    long, ``default`` when it has none. Facts are aggregated before the join,
    so the join sees one row per key on each side."""
    per_key = facts.groupBy(F.col(fact_key).alias(key)).agg(F.max(F.col(value)).cast("long").alias("value"))
    return (keys.select(key).join(per_key, key, "left")
                .select(key, F.coalesce("value", F.lit(default).cast("long")).alias("value")))


def exists_in(keys: DataFrame, key: str, facts: DataFrame, fact_key: str) -> DataFrame:
    """S6 in bulk: the keys that have at least one fact (left semi join).
    The fact keys are de-duplicated first (a partial aggregate), so a key
    with a third of all facts reaches the join as one row per map task --
    AQE cannot split the right side of a semi join."""
    return keys.join(facts.select(F.col(fact_key).alias(key)).distinct(), key, "left_semi")
