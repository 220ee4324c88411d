"""Corpus preparation: quality, near duplicates, repeats, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the docs of the next one.  All but the last
return the columns of documents.

1. quality: documents that the classifier rejects go.  It learns from the
   labels of sf_dir and scores what it is given.
2. near_duplicates: of rows linked by 5-word shingles (3/4 or more in common)
   the one with the smallest id stays, rows without an id counting as last.
   Repeated rows of one id and text, and rows without an id, are linked rows
   like others: one row of every class stays.
3. repeats: words covered by a 35-word window that occurs twice go; a text
   that has any keeps its other words, joined by one space, and n_chars
   follows.  No row goes, also where no word is left.
4. packing: every remaining document's tokens are packed into sequences of
   4096; the result is a row for each piece.

Edge cases are those of the stages' operators; an empty table stays empty
through all stages.  Rows without words are linked with nothing and stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.llm import jaccard_join, packing, quality, recompression
from martlens.llm.store import Workspace, ship_package


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.scored(docs, labels, tuple(docs.columns)).filter("score >= 0.5").select(
        *[F.col(f"row.{c}") for c in docs.columns])


#: Names of a row's content key and of its number among rows of one key.
KEY, TURN = "content key of the row", "number of the row"


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    ws = Workspace(spark, "first")
    # equal rows share a key, rows that differ in id or text do not
    keyed = docs.withColumn(KEY, F.xxhash64("doc_id", "text"))
    classes = jaccard_join.classes_by_key(spark, keyed.select(F.col(KEY).alias("doc_id"), "text")) \
        .filter("n_shingles > 0").groupBy(F.col("doc_id").alias(KEY)).agg(
            F.min("component_id").alias("component"), F.count(F.lit(1)).alias("n"))
    members = ws.save(classes.join(keyed.groupBy(KEY).agg(F.min("doc_id").alias("doc_id")), KEY), "members")
    first = members.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", KEY)).alias("first")) \
        .select(F.col("first")[KEY].alias(KEY), F.lit(True).alias("stays"))
    # keys of which some row goes
    copies = ws.save(members.join(first, KEY, "left").filter("stays IS NULL OR n > 1").select(
        KEY, F.coalesce("stays", F.lit(False)).alias("stays")), "copies")
    rest = keyed.join(copies.select(KEY), KEY, "left_anti").select(*docs.columns)
    again = ws.save(keyed.join(copies.filter("stays").select(KEY), KEY).withColumn(TURN, F.monotonically_increasing_id()), "again")
    one = again.groupBy(KEY).agg(F.min(TURN).alias(TURN)).select(TURN)
    return rest.unionByName(again.join(one, TURN, "left_semi").select(*docs.columns))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return recompression.remove_repeats(spark, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.op9_best_fit_packing(spark, docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("near_duplicates", keep_first),
    ("repeats", drop_repeats),
    ("packing", pack),
]

# A trained classifier is not SQL; tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ws = Workspace(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = ws.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
