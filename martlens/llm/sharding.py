"""Two-pass external shuffle of whole records into a fixed number of shards.

Pass 1 measures the table and fixes how many memory-sized buckets a shard has.
Pass 2 scatters the records: a seeded rendezvous hash of the id picks the
shard, a second seeded hash of the row the bucket inside it, so bucket sizes are near
equal whatever the sources or copies.  Each bucket is then gathered, put in
random order by ``shuffle`` (a seeded Fisher-Yates shuffle of an array) and
written.  All of it is column expressions.

Law ``key``: the id and the number of shards decide.  With one more shard a
record stays, or moves to the new shard: each shard draws a hash for the id
and the largest draw wins, so a new shard can only take.

Edge cases: a null or empty text has size 8 and checksum 0; repeated rows each
keep a slot of their own; rows that share an id, or have none, share one shard
and are dealt over its buckets like others; an empty table gives no rows; other
columns of the input are ignored.  Shards depend on ids only; buckets and slots
also on how the input lies in its files.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlens.llm.store import Workspace, partitions

SHARDS = 24
BUCKET_BYTES = 4 << 20
ROW_BYTES = 8               # what a record takes beside its text


def rendezvous(key: Column, shards: int, seed: int) -> Column:
    """Shard of a key: the one that draws the largest hash for it."""
    draws = F.array(*[F.xxhash64(F.lit(seed), key, F.lit(i)) for i in range(shards)])
    return F.array_position(draws, F.array_max(draws)).cast("int") - 1


def record_size(text: Column) -> Column:
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long") + ROW_BYTES


def write_shards(spark: SparkSession, docs: DataFrame, ws: Workspace, shards: int = SHARDS,
                 bucket_bytes: int = BUCKET_BYTES, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """The shuffled records (shard, bucket, pos, doc_id, text), written in that
    order by shard, and each bucket's first slot (shard, bucket, first_slot)."""
    records = docs.select("doc_id", "text")
    total = records.agg(F.sum(record_size(F.col("text"))).alias("bytes")).first()["bytes"] or 0
    per_shard = max(1, math.ceil(total / (shards * bucket_bytes)))
    tasks = partitions(spark)
    # rows of one id (or none) are dealt over the buckets too, repeated rows by their place in the input
    draw = F.xxhash64(F.lit(seed + 1), "doc_id", "text", F.monotonically_increasing_id())
    scattered = (records
                 .withColumn("shard", rendezvous(F.col("doc_id"), shards, seed))
                 .withColumn("bucket", F.pmod(draw, F.lit(per_shard)).cast("int"))
                 .withColumn("task", F.floor((F.col("shard") * per_shard + F.col("bucket")) * tasks
                                             / (shards * per_shard)).cast("int"))
                 .repartitionById(tasks, F.col("task")))
    shuffled = (scattered.groupBy("task", "shard", "bucket")
                .agg(F.sort_array(F.collect_list(F.struct("doc_id", "text"))).alias("records"))
                .sortWithinPartitions("shard", "bucket")
                .select("shard", "bucket", F.posexplode(F.shuffle("records", F.lit(seed + 2))).alias("pos", "r"))
                .select("shard", "bucket", "pos", "r.doc_id", "r.text"))
    stored = ws.save(shuffled, "shards", partition_by=("shard",))
    sizes = stored.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = F.sum("n").over(earlier)
    return stored, sizes.select("shard", "bucket", F.coalesce(before, F.lit(0)).alias("first_slot"))


def op3_sharding(spark: SparkSession, docs: DataFrame, shards: int = SHARDS, seed: int = 17) -> DataFrame:
    """One row per record of the written shards: shard, slot (gapless from 0),
    size, text checksum, and the shard it would have with one shard more."""
    stored, first = write_shards(spark, docs, Workspace(spark, "sharding"), shards, seed=seed)
    # digest before the join: only small rows move
    digest = stored.select("doc_id", record_size(F.col("text")).alias("size"),
                           F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
                           F.col("shard").cast("int").alias("shard"), "bucket", "pos")
    return (digest.join(first, ["shard", "bucket"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("first_slot") + F.col("pos")).cast("long").alias("slot"),
                    rendezvous(F.col("doc_id"), shards + 1, seed).alias("grown_shard")))
