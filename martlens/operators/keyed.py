"""Keyed first/last row selection.

``groupBy(key).agg(min|max(struct(order..., rest...)))`` instead of a
``row_number()`` window: the aggregate runs partially on the map side, so a
key holding a third of all rows still ships one row per map task through the
shuffle, and no task ever sorts one whole key. The struct compares field by
field, so the order columns decide and the remaining columns break ties.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], agg) -> DataFrame:
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    fields = order + rest
    picked = df.groupBy(*keys).agg(agg(F.struct(*fields)).alias("_pick"))
    return picked.select(*keys, *[F.col("_pick").getField(c).alias(c) for c in fields]).select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row with the smallest ``order`` values per ``keys`` (ties: other columns)."""
    return _pick(df, keys, order, F.min)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row with the largest ``order`` values per ``keys`` (last write wins)."""
    return _pick(df, keys, order, F.max)
