"""Exact duplicates with a heavy-hitter split.

Texts are equal when they are identical after lower-casing A-Z; their digest is
the SHA-256 of that form.  A text whose copies are a noticeable share of all
rows would put that share into one task, so digests are split:

1. Every task summarises the digests it holds in a Misra-Gries sketch
   (``approx_top_k_accumulate``: at most TRACKED counters, the smallest are
   decremented away), and the sketches are merged in three levels.  A digest
   with more than 3.5 / TRACKED of all rows is certainly in the result.
2. The digests with an estimate of at least 1 / SHARE of all rows are
   candidates.  They are counted exactly over all rows, by whole digest, with
   partial aggregation: one row per candidate and task is shuffled.  What has
   two rows or more is a winner, with the row that stays.
3. Winners are broadcast: their rows are decided where they lie.  There are at
   most ``most_winners()`` of them at any input size, 21,460 rows of some 60 bytes
   at the default settings: estimates are too high by 3.5 / TRACKED of all rows
   at most, so each has at least 1 / SHARE - 3.5 / TRACKED of them.
4. All other digests are shuffled.  None of their groups has more than 1 / SHARE
   of the rows, and only digests, ids and row numbers travel.

Of equal texts the row with the largest id stays; rows without an id come last;
of rows that share the id too, exactly one stays.

Edge cases: null counts as the empty text, and all empty texts are equal;
repeated rows are copies of each other; a group without any id has a null
keep_id; an empty table gives no rows; other columns may have any names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlens.llm.store import Workspace

TRACKED = 65536     # counters of a sketch
SHARE = 10_000      # a digest with 1 / SHARE of all rows or more is heavy
FAN = 64            # sketches merged by one task in each of the first two levels
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normalised(text: Column) -> Column:
    """The text with A-Z in lower case; null is the empty text."""
    text = F.coalesce(text, F.lit(""))
    # for a text of one-byte characters ``lower`` does the same, faster
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def most_winners(tracked: int = TRACKED, share: int = SHARE) -> int:
    return min(tracked, math.floor(1 / (1 / share - 3.5 / tracked)))


def digests(docs: DataFrame, *keep: Column) -> DataFrame:
    """doc_id, digest, a 64-bit key of it, and a number of the row; store it
    before use, so that numbers stay."""
    digest = F.unhex(F.sha2(normalised(F.col("text")), 256))
    return docs.select("doc_id", digest.alias("digest"), *keep).withColumn("key", F.xxhash64("digest")) \
        .withColumn("number", F.monotonically_increasing_id())


def frequent(table: DataFrame, rows: int, tracked: int = TRACKED, share: int = SHARE) -> DataFrame:
    """Keys (column key) that may have 1 / share of the rows or more."""
    most, least = most_winners(tracked, share), max(2, -(-rows // share))
    part = F.floor(F.spark_partition_id() / FAN)
    level1 = table.select("key", part.alias("part")).groupBy("part").agg(
        F.expr(f"approx_top_k_accumulate(key, {tracked})").alias("sketch"))
    level2 = level1.groupBy(F.floor(F.col("part") / FAN).alias("part")).agg(
        F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))
    whole = level2.groupBy(F.lit(0).alias("part")).agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))
    return whole.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {most})")).alias("top")) \
        .filter(F.col("top.count") >= least).select(F.col("top.item").alias("key"))


def winners(table: DataFrame, candidates: DataFrame) -> DataFrame:
    """The exact size and the staying row of every candidate digest that has copies."""
    return table.join(F.broadcast(candidates), "key").groupBy("digest").agg(
        F.max(F.struct("doc_id", "number")).alias("stays"), F.count(F.lit(1)).alias("size")).filter("size > 1")


def decide(table: DataFrame, heavy: DataFrame) -> DataFrame:
    """``table`` with keep_id, group_size and kept; ``heavy`` is small."""
    marked = table.join(F.broadcast(heavy), "digest", "left")
    known = marked.filter("size IS NOT NULL").select(
        *table.columns, F.col("stays.doc_id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("number") == F.col("stays.number")).alias("kept"))
    group = Window.partitionBy("digest").orderBy(F.col("doc_id").desc_nulls_last(), "number")
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = marked.filter("size IS NULL").select(
        *table.columns, F.first("doc_id").over(whole).alias("keep_id"),
        F.count(F.lit(1)).over(whole).alias("group_size"), (F.row_number().over(group) == 1).alias("kept"))
    return known.unionByName(rest)


def _decided(table: DataFrame, ws: Workspace) -> tuple[DataFrame, DataFrame]:
    slim = table.select("doc_id", "digest", "key", "number")
    heavy = ws.save(winners(slim, frequent(slim, slim.count())), "winners")
    return decide(slim, heavy), heavy


def without_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.  Copies of heavy
    texts go where they lie; of the others only row numbers are shuffled and
    then taken out, so no text travels for its copies' sake."""
    ws = Workspace(spark, "exact")
    table = ws.save(digests(docs, F.struct("*").alias("row")), "rows")
    decided, heavy = _decided(table, ws)
    gone = ws.save(decided.filter("NOT kept AND group_size > 1").select("number", "digest")
                   .join(F.broadcast(heavy.select("digest")), "digest", "left_anti").select("number"), "gone")
    here = table.join(F.broadcast(heavy.select("digest", "stays")), "digest", "left").filter(
        F.col("stays").isNull() | (F.col("stays.number") == F.col("number")))
    return here.join(gone, "number", "left_anti").select("row.*")


def op13_exact_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Every document with the id that stays of its group, the group's size,
    whether it stays, and the digest of its normalised text."""
    ws = Workspace(spark, "exact")
    table = ws.save(digests(docs.select("doc_id", "text")), "digests")
    decided, _ = _decided(table, ws)
    return decided.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE = f"""
WITH t AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')) AS text_sha256 FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""
