"""The registered query of every operator of this package, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martlens.llm import (
    exact_dedup,
    jaccard_join,
    order_minhash,
    packing,
    periodic_runs,
    piece_viterbi,
    quality,
    quantised_neighbours,
    ranked_search,
    recompression,
    sharding,
    token_files,
    url_filter,
)
from martlens.llm.store import ship_package

Query = Callable[[SparkSession, str], DataFrame]


def _over(table: str, operator: Callable[[SparkSession, DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return operator(spark, spark.read.parquet(f"{sf_dir}/{table}.parquet"))

    query.__name__, query.__doc__ = operator.__name__, operator.__doc__
    return query


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return quality.op5_quality(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"),
                               spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return ranked_search.op12_ranked_search(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"),
                                            spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Query] = {
    "op1_jaccard_join": _over("documents", jaccard_join.op1_jaccard_join),
    "op2_order_minhash": _over("documents", order_minhash.op2_order_minhash),
    "op3_sharding": _over("documents", sharding.op3_sharding),
    "op4_quantised_neighbours": _over("embeddings", quantised_neighbours.op4_quantised_neighbours),
    "op5_quality": op5_quality,
    "op6_piece_viterbi": _over("documents", piece_viterbi.op6_piece_viterbi),
    "op7_recompression": _over("documents", recompression.op7_recompression),
    "op8_token_files": _over("documents", token_files.op8_token_files),
    "op9_best_fit_packing": _over("documents", packing.op9_best_fit_packing),
    "op10_url_filter": _over("pages", url_filter.op10_url_filter),
    "op11_periodic_runs": _over("documents", periodic_runs.op11_periodic_runs),
    "op12_ranked_search": op12_ranked_search,
    "op13_exact_dedup": _over("documents", exact_dedup.op13_exact_dedup),
}

ORACLE_SQL: dict[str, str] = {
    "op10_url_filter": url_filter.ORACLE,
    "op12_ranked_search": ranked_search.ORACLE,
    "op13_exact_dedup": exact_dedup.ORACLE,
}
