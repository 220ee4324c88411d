"""Keyword search over term rows instead of texts.

Every document has one row per distinct token: (token, doc_id, dt).  All tokens
of a keyword (AND) is relational division: the documents that have as many of
the asked tokens as there are.  Any token (OR) is a distinct union.  Tokens are
those of ``functions.text.search_tokens``; a keyword of blanks asks for nothing
and gets every document, one without any token gets none.

``TermIndex`` (streaming.term_store) keeps the rows by token bucket, so a
search reads the buckets of its own tokens only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlens.functions.text import search_tokens


def term_rows(docs: DataFrame, text: str = "sku_name", *keep: str) -> DataFrame:
    """(token, doc_id, *keep) of documents; a null or token-less text has no rows."""
    return docs.filter(F.col("doc_id").isNotNull()).select(
        F.explode(F.array_distinct(search_tokens(text))).alias("token"), "doc_id", *keep)


def asked(keyword: str) -> Column:
    return F.array_distinct(search_tokens(F.lit(keyword)))


def having_all(terms: DataFrame, keyword: str, *keep: str) -> DataFrame:
    """(doc_id, *keep) of the documents that have every token of ``keyword``,
    also where term rows repeat. ``keep`` are columns that depend on the document."""
    mine = terms.filter(F.array_contains(asked(keyword), F.col("token")))
    return mine.groupBy("doc_id", *keep).agg(F.count_distinct("token").alias("_n")).filter(F.col("_n") == F.size(asked(keyword))).drop("_n")


def having_any(terms: DataFrame, keyword: str, *keep: str) -> DataFrame:
    return terms.filter(F.array_contains(asked(keyword), F.col("token"))).select("doc_id", *keep).distinct()
