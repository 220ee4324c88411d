"""The term table of a document store, kept up by upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.functions.text import search_tokens
from martlens.operators import term_index
from martlens.operators.keyed import last_per_key
from martlens.streaming.sinks import BATCH_COL, KeyedStore
from martlens.streaming.state import COMPACT_EVERY, before

BUCKETS = 64


class TermIndex:
    """Documents (doc_id, dt, text) by id, and their term rows by token bucket.

    A document that comes again replaces its rows: tokens it lost are stored as
    no longer live.  A micro-batch reads the stored tokens of its own documents
    only, and writes from what earlier batches left, so a replay changes
    nothing.  ``buckets`` must stay what it was when the index began.  A token
    that a third of all documents hold is many files of one bucket, read in
    parallel; nothing gathers it in one task."""

    def __init__(self, root: str, text: str = "sku_name", buckets: int = BUCKETS, compact_every: int = COMPACT_EVERY):
        root = root.rstrip("/")
        self.text, self.buckets, self.every = text, buckets, compact_every
        self.documents = KeyedStore(f"{root}/documents", "doc_id", schema="doc_id string, dt string, tokens array<string>")
        self.terms = KeyedStore(f"{root}/terms", ["token", "doc_id"], partition_by=("bucket",),
                                schema="token string, doc_id string, dt string, live boolean, bucket string")

    def _bucket(self, token):
        return F.pmod(F.xxhash64(token), F.lit(self.buckets)).cast("string")

    def write_batch(self, docs: DataFrame, batch_id: int) -> None:
        spark = docs.sparkSession
        new = last_per_key(docs.filter(F.col("doc_id").isNotNull()).select(
            "doc_id", "dt", F.coalesce(F.array_distinct(search_tokens(self.text)), F.array().cast("array<string>")).alias("tokens")),
            ["doc_id"], ["dt"]).persist()
        try:
            old = last_per_key(before(self.documents, spark, batch_id).join(new.select("doc_id"), "doc_id", "left_semi"),
                               ["doc_id"], [BATCH_COL]).select("doc_id", F.col("tokens").alias("had"))
            gone = F.coalesce(F.array_except("had", "tokens"), F.array().cast("array<string>"))
            rows = new.join(old, "doc_id", "left").select("doc_id", "dt", F.inline(F.concat(
                F.transform("tokens", lambda t: F.struct(t.alias("token"), F.lit(True).alias("live"))),
                F.transform(gone, lambda t: F.struct(t.alias("token"), F.lit(False).alias("live"))))))
            self.terms.write_batch(rows.withColumn("bucket", self._bucket("token")), batch_id)
            self.documents.write_batch(new, batch_id)
        finally:
            new.unpersist()
        for store in (self.documents, self.terms):
            store.compact_by_turns(spark, batch_id, self.every)

    def term_rows(self, spark: SparkSession, keyword: str) -> DataFrame:
        """Live term rows of the keyword's tokens, from their buckets only."""
        tokens = spark.range(1).select(term_index.asked(keyword).alias("t"), F.transform(
            term_index.asked(keyword), self._bucket).alias("b")).first()
        raw = self.terms.raw(spark).filter(F.col("bucket").isin(sorted(set(tokens["b"]))) & F.col("token").isin(tokens["t"]))
        return self.terms.latest(raw).filter("live").select("token", "doc_id", "dt")

    def search(self, spark: SparkSession, keyword: str | None, operator: str = "and", date: str | None = None) -> DataFrame:
        """(doc_id, dt) of the hits; see ``operators.term_index``."""
        if keyword is None or not keyword.strip():
            hits = self.documents.read(spark).select("doc_id", "dt")
            return hits if date is None else hits.filter(F.col("dt") == date)
        terms = self.term_rows(spark, keyword)
        terms = terms if date is None else terms.filter(F.col("dt") == date)
        return (term_index.having_all if operator == "and" else term_index.having_any)(terms, keyword, "dt")
