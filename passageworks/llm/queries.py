"""Registered queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, table
from . import boilerplate, leakage, matching, mixing, neardup, rankagg, splitting, truncation


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.furniture_lines(table(spark, d, "page_block"), table(spark, d, "page_manifest"))


def p1_body(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.body_text(table(spark, d, "page_block"), table(spark, d, "page_manifest"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_duplicate_pairs(table(spark, d, "chunk"))


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_duplicate_groups(table(spark, d, "chunk"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return matching.matched_chunks(table(spark, d, "chunk")).select("chunk_id_a", "chunk_id_b")


def p3_confidence(spark: SparkSession, d: str) -> DataFrame:
    return matching.matched_chunks(table(spark, d, "chunk"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return splitting.oversized(table(spark, d, "chunk"), table(spark, d, "doc_section"))


def p4_pieces(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split_oversized(splitting.corpus_items(table(spark, d, "chunk"), table(spark, d, "doc_section")))


def _ranking(spark: SparkSession, d: str) -> DataFrame:
    return rankagg.median_rank_ranking(table(spark, d, "search_result"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return rankagg.majority_winner(materialize(_ranking(spark, d), "ranking"), ["run_id", "query_id"], list(rankagg.CONFIGS), 3)


def p5_ranking(spark: SparkSession, d: str) -> DataFrame:
    r = _ranking(spark, d)
    return r.select("run_id", "query_id", "item_id", "median_rank", F.round("mean_rank", 6).alias("mean_rank"), F.col("position").cast("bigint").alias("position"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_items(table(spark, d, "documents"), table(spark, d, "gold_query"))


def p7_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixing.Mixture(table(spark, d, "documents"), table(spark, d, "mix_target")).report()


def p7_copies(spark: SparkSession, d: str) -> DataFrame:
    return mixing.Mixture(table(spark, d, "documents"), table(spark, d, "mix_target")).copies()


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncation_evidence(table(spark, d, "documents")).filter("truncated").select("doc_id").distinct()


def p8_rates(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncation_rates(truncation.truncation_evidence(table(spark, d, "documents")))


_ALL = (p1_found, p1_body, p2_found, p2_groups, p3_found, p3_confidence, p4_found, p4_pieces, p5_found, p5_ranking, p6_found, p7_mixture, p7_copies, p8_found, p8_rates)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}
