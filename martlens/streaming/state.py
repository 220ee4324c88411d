"""State that streaming jobs keep beside their rows: order totals with
retractions, and what is known of devices (numbers, daily sets, first days).

Every store below is written once per micro-batch from what *earlier* batches
left, into the batch's own folder, so a replayed batch writes the same rows
again.  Reading folds the folders; ``compact_every`` batches they are folded
into one, and folders that the compaction before made superfluous go.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.operators import deltas, device_sets, first_seen
from martlens.operators.keyed import last_per_key
from martlens.streaming.metrics import counted
from martlens.streaming.sinks import BATCH_COL, KeyedStore

COMPACT_EVERY = 100     # micro-batches
ORDER_VERSION = ("operate_time", "create_time")


class FoldingStore(KeyedStore):
    """Rows of one key in several batches fold into one by aggregates whose
    result does not depend on order (sum, min, max, bitmap OR).  Keys may be null."""

    def __init__(self, root: str, key: str | Sequence[str], folds: dict[str, Callable[[str], Column]],
                 partition_by: Sequence[str] = (), schema: str | None = None):
        super().__init__(root, key, (), partition_by, schema)
        self.folds = folds

    def named(self, batch: DataFrame, batch_id: int) -> DataFrame:
        return batch

    def latest(self, raw: DataFrame) -> DataFrame:
        return raw.groupBy(*self.keys).agg(*[fold(c).cast(dict(raw.dtypes)[c]).alias(c) for c, fold in self.folds.items()])


def before(store: KeyedStore, spark: SparkSession, batch_id: int) -> DataFrame:
    """All versions that batches before ``batch_id`` wrote."""
    return store.raw(spark).filter(F.col(BATCH_COL) < int(batch_id))


class OrderTotals:
    """Orders by id, and their totals per day and hour kept by deltas.  A later
    version (``operate_time``, then ``create_time``) replaces an earlier one
    whenever it arrives; totals then leave the old day and hour."""

    BY = ("create_date", "create_hour")

    def __init__(self, orders: KeyedStore, root: str, compact_every: int = COMPACT_EVERY):
        self.orders, self.every = orders, compact_every
        self.sums = FoldingStore(root, self.BY, {"amount": F.sum, "orders": F.sum, "priced": F.sum}, ("create_date",),
                                 f"create_date string, create_hour string, amount {deltas.AMOUNT}, orders long, priced long")

    def write_batch(self, batch: DataFrame, batch_id: int) -> int:
        """Take in a batch; returns how many images of it are new."""
        spark = batch.sparkSession
        ids = batch.select("id").filter(F.col("id").isNotNull()).distinct()
        images = before(self.orders, spark, batch_id).join(ids, "id", "left_semi").select(*batch.columns)
        stored = last_per_key(images, ["id"], ORDER_VERSION)
        changes = deltas.signed_changes(stored, batch, "id", ORDER_VERSION).persist()
        try:
            self.sums.write_batch(deltas.signed_totals(changes, self.BY), batch_id)
            images, n = counted(changes.filter(F.col(deltas.SIGN) > 0).drop(deltas.SIGN))
            self.orders.write_batch(images, batch_id)
        finally:
            changes.unpersist()
        for store in (self.orders, self.sums):
            store.compact_by_turns(spark, batch_id, self.every)
        return n.get["rows"]

    def _hours(self, spark: SparkSession, date: str | None) -> DataFrame:
        raw = self.sums.raw(spark)
        return self.sums.latest(raw if date is None else raw.filter(F.col("create_date") == date))

    def hourly(self, spark: SparkSession, date: str | None = None) -> DataFrame:
        """create_date, create_hour, sum_amount, order_count; one date reads its folders only."""
        return deltas.as_served(deltas.add_totals(self._hours(spark, date), self.BY), self.BY)

    def daily(self, spark: SparkSession, date: str | None = None) -> DataFrame:
        return deltas.as_served(deltas.add_totals(self._hours(spark, date), self.BY[:1]), self.BY[:1])


class DeviceHistory:
    """What the device-days of all batches say: dense device numbers, one bitmap
    set of devices per day, the first day of each device, and the new devices
    of each day.  ``parts`` must stay what it was when the store began."""

    def __init__(self, root: str, parts: int = device_sets.PARTS, compact_every: int = COMPACT_EVERY):
        root = root.rstrip("/")
        self.parts, self.every = parts, compact_every
        self.numbers = KeyedStore(f"{root}/numbers", "mid", schema="mid string, number long")
        self.used = FoldingStore(f"{root}/used", "part", {"used": F.max}, schema="part long, used long")
        self.sets = FoldingStore(f"{root}/sets", ("logDate", "bucket"), {"devices": F.bitmap_or_agg}, ("logDate",),
                                 "logDate string, bucket long, devices binary")
        self.first = FoldingStore(f"{root}/first_days", "mid", {"first_day": F.min}, schema="mid string, first_day date")
        self.new = FoldingStore(f"{root}/new_devices", "logDate", {"new_devices": F.sum}, ("logDate",),
                                "logDate string, new_devices long")

    def write_batch(self, device_days: DataFrame, batch_id: int) -> None:
        """Take in the device-days (mid, logDate) of a batch; repeated ones change nothing."""
        spark = device_days.sparkSession
        days = device_days.select("mid", "logDate").filter(F.col("mid").isNotNull() & F.col("logDate").isNotNull()).distinct().persist()
        try:
            mids = days.select("mid").distinct()
            known = before(self.numbers, spark, batch_id).join(mids, "mid", "left_semi").select("mid", "number")
            used = self.used.latest(before(self.used, spark, batch_id))
            self.numbers.write_batch(device_sets.extend_numbers(known, mids, self.parts, used), batch_id)
            mine = self.numbers.raw(spark).filter(F.col(BATCH_COL) == int(batch_id)).select("mid", "number")
            self.used.write_batch(device_sets.used_places(mine), batch_id)
            self.sets.write_batch(device_sets.daily_sets(days, known.unionByName(mine)), batch_id)
            state = self.first.latest(before(self.first, spark, batch_id).join(mids, "mid", "left_semi"))
            moves = first_seen.first_seen_moves(state, days).persist()
            try:
                self.first.write_batch(moves.select("mid", "first_day"), batch_id)
                self.new.write_batch(first_seen.by_date(moves), batch_id)
            finally:
                moves.unpersist()
        finally:
            days.unpersist()
        for store in (self.numbers, self.used, self.sets, self.first, self.new):
            store.compact_by_turns(spark, batch_id, self.every)

    def new_devices(self, spark: SparkSession, date: str | None = None) -> DataFrame:
        """logDate, new_devices; one date reads its folders only."""
        raw = self.new.raw(spark)
        return first_seen.add_counts(raw if date is None else raw.filter(F.col("logDate") == date))

    def active_devices(self, spark: SparkSession, first: str, last: str) -> DataFrame:
        """Distinct devices from ``first`` to ``last``, from their daily sets."""
        return device_sets.active_devices(self.sets.raw(spark), first, last)

    def trailing(self, spark: SparkSession, spans: Sequence[int] = (7, 30)) -> DataFrame:
        return device_sets.trailing_active_devices(self.sets.read(spark), spans)
