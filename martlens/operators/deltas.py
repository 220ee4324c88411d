"""Totals kept right by signed rows (A3, A4, A16 over K2, T7).

An order that arrives again with another amount or date must leave its old
day and hour and enter the new ones.  ``signed_changes`` turns a batch into the
rows that say so: minus the stored image, plus the new one.  Sums of signed
rows are totals: stored ones and those of a batch add up, and no batch reads
more of the past than the images of its own keys.

Batches may come in any order: the largest ``version`` of a key wins (ties:
the other columns, by position), whenever it arrives; an older or equal one
changes nothing.  Rows without a key are rejected.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlens.operators.keyed import last_per_key

AMOUNT = "decimal(28,2)"
SIGN = "sign"


def signed_changes(stored: DataFrame | None, batch: DataFrame, key: str | Sequence[str],
                   version: Sequence[str]) -> DataFrame:
    """The columns of ``batch`` and ``sign``: +1 for an image that becomes the
    latest of its key, -1 for the one it replaces.  ``stored`` has the same
    columns and one row per key."""
    keys = [key] if isinstance(key, str) else list(key)
    present = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    newest = last_per_key(batch.filter(present), keys, version)
    order = [*version, *[c for c in batch.columns if c not in keys and c not in version]]
    plus = newest.select(*keys, F.struct(*order).alias("new"))
    if stored is None:
        return plus.select(*[c if c in keys else F.col(f"new.`{c}`").alias(c) for c in batch.columns],
                           F.lit(1).alias(SIGN))
    both = plus.join(stored.select(*keys, F.struct(*order).alias("old")), keys, "left")
    wins = both.filter(F.col("old").isNull() | (F.col("new") > F.col("old")))
    rows = F.array_compact(F.array(
        F.struct(F.lit(1).alias(SIGN), F.col("new").alias("image")),
        F.when(F.col("old").isNotNull(), F.struct(F.lit(-1).alias(SIGN), F.col("old").alias("image")))))
    signed = wins.select(*keys, F.inline(rows))
    return signed.select(*[c if c in keys else F.col(f"image.`{c}`").alias(c) for c in batch.columns], SIGN)


def signed_totals(changes: DataFrame, by: Sequence[str], amount: str = "total_amount") -> DataFrame:
    """Per ``by``: the sum of signed amounts, of signed rows, and of signed rows
    that have an amount."""
    money = F.col(amount).cast("decimal(18,2)")
    return changes.groupBy(*by).agg(
        F.sum(F.when(F.col(SIGN) > 0, money).otherwise(-money)).cast(AMOUNT).alias("amount"),
        F.sum(F.col(SIGN).cast("long")).alias("orders"),
        F.sum(F.when(F.col(amount).isNotNull(), F.col(SIGN)).otherwise(0).cast("long")).alias("priced"))


def add_totals(totals: DataFrame, by: Sequence[str]) -> DataFrame:
    """Totals of the same groups added up; groups that no order is left in go."""
    return totals.groupBy(*by).agg(F.sum("amount").cast(AMOUNT).alias("amount"), F.sum("orders").alias("orders"),
                                   F.sum("priced").alias("priced")).filter(F.col("orders") != 0)


def as_served(totals: DataFrame, by: Sequence[str]) -> DataFrame:
    """``sum_amount`` (null where no order of the group has an amount, as SUM
    gives it) and ``order_count``."""
    return totals.select(*by, F.when(F.col("priced") != 0, F.coalesce("amount", F.lit(0)).cast("double")).alias("sum_amount"),
                         F.col("orders").alias("order_count"))


def totals_of_batches(batches: Sequence[DataFrame], key: str, version: Sequence[str], by: Sequence[str],
                      amount: str = "total_amount") -> DataFrame:
    """Totals after all ``batches``, each applied to what the ones before left."""
    stored, signed = None, None
    for batch in batches:
        changes = signed_totals(signed_changes(stored, batch, key, version), by, amount)
        signed = changes if signed is None else signed.unionByName(changes)
        rows = batch if stored is None else stored.unionByName(batch)
        stored = last_per_key(rows.filter(F.col(key).isNotNull()), [key], version)
    return as_served(add_totals(signed, by), by)
