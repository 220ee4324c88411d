"""Serving queries over the sale-detail index.

One filtered DataFrame feeds the total, the page and the aggregations; they
are separate Spark jobs over the same pruned scan, as the index serves them
from one request.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.functions.ratio import half_up_share, remainder_share
from martlens.functions.text import match_all, match_any
from martlens.operators.sale_detail import enrich_users, join_orders_lines
from martlens.schemas import SALE_DETAIL_COLUMNS

# Pie titles and slice names as the dashboard shows them.
AGE_TITLE = "用户年龄占比"
AGE_NAMES = ("20岁以下", "20岁到30岁", "30岁及30岁以上")
GENDER_TITLE = "用户性别占比"
GENDER_NAMES = ("男", "女")
AGE_LOW, AGE_HIGH = 20, 30
MALE = "M"


def search(index: DataFrame, keyword: str | None = None, date: str | None = None,
           operator: str = "and", text_col: str = "sku_name", date_col: str = "dt") -> DataFrame:
    """F4 term filter on the date (skipped when ``date`` is None) and F5/F6
    keyword match (``and`` = all tokens, ``or`` = any token)."""
    out = index if date is None else index.filter(F.col(date_col) == date)
    pred = match_all(text_col, keyword) if operator == "and" else match_any(text_col, keyword)
    return out.filter(pred)


def total(hits: DataFrame) -> DataFrame:
    """Number of hits, independent of paging."""
    return hits.agg(F.count(F.lit(1)).alias("total"))


def page(hits: DataFrame, page_no: int, size: int, order: Sequence[str]) -> DataFrame:
    """L1: rows ``(page_no-1)*size`` .. ``+size`` in a total order. Spark plans
    this as a per-partition top-(offset+size) and a merge, never a full sort
    into one task."""
    if page_no < 1 or size < 0:
        raise ValueError("page numbers start at 1 and size must be >= 0")
    return hits.orderBy(*order).offset((page_no - 1) * size).limit(size)


def terms(hits: DataFrame, col: str) -> DataFrame:
    """Counts of all buckets of ``col``."""
    return hits.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("doc_count"))


def top_terms(hits: DataFrame, col: str, size: int) -> DataFrame:
    """L3: the caller's top ``size`` buckets (ties by key), each with
    ``other_docs``, the number of documents in the buckets left out."""
    counts = terms(hits, col)
    top = counts.orderBy(F.desc("doc_count"), F.asc(col)).limit(size)
    summed = F.coalesce(F.sum("doc_count"), F.lit(0))
    return top.select(col, "doc_count", (counts.agg(summed).scalar() - top.agg(summed).scalar()).alias("other_docs"))


def sale_hits(order_info: DataFrame, order_detail: DataFrame, user_info: DataFrame | None, as_of: str | None,
              keyword: str | None = None, operator: str = "and", date: str | None = None) -> DataFrame:
    """Matches over orders and lines that are not indexed yet: the keyword cuts
    the lines before they meet the orders, and users are joined to the hits
    only -- or not at all when ``user_info`` is None (no user column asked)."""
    lines = search(order_detail, keyword=keyword, operator=operator)
    rows = join_orders_lines(order_info, lines)
    rows = rows if date is None else rows.filter(F.col("dt") == date)
    rows = rows.withColumn("doc_id", F.concat_ws("_", F.col("order_id").cast("string"), "order_detail_id"))
    return rows if user_info is None else enrich_users(rows, user_info, as_of).select("doc_id", *SALE_DETAIL_COLUMNS)


def _share_counts(hits: DataFrame) -> DataFrame:
    """One pass over the hits: total, male, under-20 and 30-plus counts."""
    age = F.col("user_age")
    return hits.agg(F.count(F.lit(1)).alias("n"),
                    F.count(F.when(F.col("user_gender") == MALE, 1)).alias("m"),
                    F.count(F.when(age < AGE_LOW, 1)).alias("lo"),
                    F.count(F.when(age >= AGE_HIGH, 1)).alias("hi"))


def _with_shares(counts: DataFrame) -> DataFrame:
    n = F.col("n")
    return (counts.withColumn("male_ratio", half_up_share(F.col("m"), n))
                  .withColumn("female_ratio", remainder_share(F.col("male_ratio")))
                  .withColumn("lt20_ratio", half_up_share(F.col("lo"), n))
                  .withColumn("ge30_ratio", half_up_share(F.col("hi"), n))
                  .withColumn("20to30_ratio", remainder_share(F.col("lt20_ratio"), F.col("ge30_ratio"))))


def gender_ratio(hits: DataFrame) -> DataFrame:
    """Male share (1 decimal, half up); female is the remainder, so a
    null or non-M gender counts as female and an empty result is 0 / 100."""
    return _with_shares(_share_counts(hits)).select("male_ratio", "female_ratio")


def age_ratio(hits: DataFrame) -> DataFrame:
    """Shares of ``age < 20`` and ``age >= 30``; 20-30 is the remainder."""
    return _with_shares(_share_counts(hits)).select("lt20_ratio", "20to30_ratio", "ge30_ratio")


def stat_json(hits: DataFrame) -> DataFrame:
    """``total`` and the two pies as the dashboard's JSON (age pie first)."""
    opt = lambda name, col: F.struct(F.lit(name).alias("name"), F.col(col).alias("value"))
    stats = F.array(
        F.struct(F.lit(AGE_TITLE).alias("title"),
                 F.array(opt(AGE_NAMES[0], "lt20_ratio"), opt(AGE_NAMES[1], "20to30_ratio"),
                         opt(AGE_NAMES[2], "ge30_ratio")).alias("options")),
        F.struct(F.lit(GENDER_TITLE).alias("title"),
                 F.array(opt(GENDER_NAMES[0], "male_ratio"), opt(GENDER_NAMES[1], "female_ratio")).alias("options")),
    )
    return _with_shares(_share_counts(hits)).select(F.col("n").alias("total"), F.to_json(stats).alias("stat"))


def facets(hits: DataFrame) -> DataFrame:
    """A5-A10 in one pass: total, both term lists, both pies and the largest age,
    from one aggregate over grouping sets, so the hits are read once and shuffled
    once, partially aggregated.

    Rows (facet, bucket, doc_count, value): ``total``; a row per ``user_age`` and
    ``user_gender`` bucket; ``max_age``; the shares of ``gender_ratio`` and
    ``age_ratio`` in ``value``. Without hits the last three are as in
    ``max_metric``, ``gender_ratio`` and ``age_ratio``."""
    age, gender = F.col("user_age"), F.col("user_gender")
    # grouping sets give no row at all for no input, not even the total: one empty row sees to it
    rows = hits.select(age, gender, F.lit(1).alias("hit"))
    spine = hits.sparkSession.range(1).select(*[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns])
    sets = rows.unionByName(spine).groupingSets([["user_age"], ["user_gender"], []], "user_age", "user_gender").agg(
        F.grouping_id().alias("gid"), F.count("hit").alias("n"), F.max(age).alias("oldest"),
        F.count(F.when(gender == MALE, 1)).alias("m"), F.count(F.when(age < AGE_LOW, 1)).alias("lo"),
        F.count(F.when(age >= AGE_HIGH, 1)).alias("hi"))
    s = _with_shares(sets)
    none, text = F.lit(None), F.lit(None).cast("string")

    def row(facet, bucket, count, value):
        return F.struct(F.lit(facet).alias("facet"), bucket.cast("string").alias("bucket"),
                        count.cast("long").alias("doc_count"), value.cast("double").alias("value"))

    whole = F.array(row("total", text, F.col("n"), none), row("max_age", text, none, F.col("oldest")),
                    *[row("gender_ratio", F.lit(b), none, F.col(c)) for b, c in (("male", "male_ratio"), ("female", "female_ratio"))],
                    *[row("age_ratio", F.lit(b), none, F.col(c)) for b, c in (
                        ("lt20", "lt20_ratio"), ("20to30", "20to30_ratio"), ("ge30", "ge30_ratio"))])
    # grouping_id: a bit per column that is rolled up, user_age first
    one = F.when(F.col("gid") == 1, row("user_age", age, F.col("n"), none)).otherwise(row("user_gender", gender, F.col("n"), none))
    return s.filter((F.col("gid") == 3) | F.coalesce("user_age", F.when(gender.isNotNull(), 0)).isNotNull()).select(
        F.inline(F.when(F.col("gid") == 3, whole).otherwise(F.array(one))))


def max_metric(hits: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """A10: maximum of ``col`` over the hits (null when none)."""
    return hits.agg(F.max(col).alias(name or f"max_{col}"))


def sale_detail_response(index: DataFrame, date: str | None, page_no: int, size: int, keyword: str | None,
                         order: Sequence[str] = ("dt", "doc_id")) -> dict[str, DataFrame]:
    """The search endpoint's three answers from one filtered input: ``total``
    (one row), ``detail`` (the page) and ``stat`` (total + pie JSON)."""
    hits = search(index, keyword=keyword, date=date)
    return {"total": total(hits), "detail": page(hits, page_no, size, list(order)), "stat": stat_json(hits)}
