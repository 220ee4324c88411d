"""Keyed upsert (K2, K3, K4, T7): the latest version per id wins, across the
stored rows and a new batch. The storage form lives in
``martlens.streaming.sinks``; this is the set operation it runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from martlens.operators.keyed import last_per_key


def upsert_latest(existing: DataFrame | None, incoming: DataFrame, key: str | Sequence[str],
                  version: Sequence[str]) -> DataFrame:
    """``existing`` plus ``incoming``, one row per key: the one with the
    largest ``version`` (then the largest remaining columns)."""
    keys = [key] if isinstance(key, str) else list(key)
    rows = incoming if existing is None else existing.unionByName(incoming, allowMissingColumns=True)
    return last_per_key(rows, keys, version)
