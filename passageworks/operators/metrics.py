"""Retrieval metrics over rankings and gold expectations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .retrieval import cosine

CUTS = (5, 10, 20, 50)


def expectations(gold: DataFrame) -> DataFrame:
    """query_id, topic, anchors (upper case), paths (lower case): single and plural expectations merged."""
    merge = lambda one, many, f: F.array_sort(F.array_distinct(F.transform(F.array_compact(F.concat(F.array(one), F.coalesce(many, F.array().cast("array<string>")))), f)))
    return gold.select("query_id", "topic", merge("expect_anchor", F.col("expect_anchors"), F.upper).alias("anchors"), merge("expect_path", F.col("expect_paths"), F.lower).alias("paths"))


def unusable(gold: DataFrame) -> DataFrame:
    """Gold rows without any expectation; a loader must refuse them."""
    return expectations(gold).filter((F.size("anchors") == 0) & (F.size("paths") == 0))


def is_relevant(anchor: Column, breadcrumb: Column, anchors: Column, paths: Column) -> Column:
    """Any of: an equal anchor, or an expected path inside the breadcrumb; case is ignored."""
    by_anchor = F.coalesce(F.array_contains(anchors, F.upper(anchor)), F.lit(False))
    by_path = F.exists(paths, lambda p: F.contains(F.lower(F.coalesce(breadcrumb, F.lit(""))), p))
    return by_anchor | by_path


def first_ranks(rankings: DataFrame, relevant: DataFrame, queries: DataFrame) -> DataFrame:
    """config, query_id, topic, first_rank: the best relevant place, null for a miss. relevant: query_id, item_id."""
    hit = rankings.join(relevant, ["query_id", "item_id"], "left_semi").groupBy("config", "query_id").agg(F.min("rank").alias("first_rank"))
    per = hit.groupBy("query_id").agg(F.map_from_entries(F.collect_list(F.struct("config", "first_rank"))).alias("found"))  # a few configs
    configs = rankings.agg(F.array_sort(F.collect_set("config")).alias("configs"))  # one row
    every = queries.join(per, "query_id", "left").crossJoin(F.broadcast(configs)).withColumn("config", F.explode("configs"))
    return every.withColumn("first_rank", F.try_element_at("found", "config")).drop("found", "configs")


def gain(rank: Column, cutoff: int | None = None) -> Column:
    """nDCG with a single relevant place."""
    g = 1 / F.log2(rank + F.lit(1))
    return F.coalesce(g if cutoff is None else F.when(rank <= cutoff, g), F.lit(0.0))


def measures(ranks: DataFrame, by: tuple[str, ...] = ("config",), cuts: tuple[int, ...] = CUTS) -> DataFrame:
    """Recall at each cut, MRR over all places, nDCG at 5 and the number of questions."""
    r = F.col("first_rank")
    recall = [F.avg(F.when(r <= c, 1.0).otherwise(0.0)).alias(f"recall_{c}") for c in cuts]
    return ranks.groupBy(*by).agg(F.count(F.lit(1)).alias("questions"), *recall, F.avg(F.coalesce(1 / r, F.lit(0.0))).alias("mrr"), F.avg(gain(r, 5)).alias("ndcg_5"))


def by_topic(ranks: DataFrame, cut: int = 5) -> DataFrame:
    """Recall by topic and over all topics (topic null, overall 1) in one pass."""
    hit = F.avg(F.when(F.col("first_rank") <= cut, 1.0).otherwise(0.0)).alias("recall")
    return ranks.rollup("config", "topic").agg(hit, F.count(F.lit(1)).alias("questions"), F.grouping("topic").alias("overall"), F.grouping("config").alias("_all")).filter("_all = 0").drop("_all")


def bucket(rank: Column) -> Column:
    return F.when(rank.isNull(), "miss").when(rank == 1, "1").when(rank <= 3, "2-3").when(rank <= 5, "4-5").when(rank <= 10, "6-10").when(rank <= 20, "11-20").when(rank <= 50, "21-50").otherwise("miss")


def rank_buckets(ranks: DataFrame) -> DataFrame:
    return ranks.groupBy("config", bucket(F.col("first_rank")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def pool_recall(ranks: DataFrame) -> DataFrame:
    """config, pool_recall: the share of questions with a relevant item anywhere among the candidates. Reordering candidates cannot change it."""
    return ranks.groupBy("config").agg(F.avg(F.col("first_rank").isNotNull().cast("double")).alias("pool_recall"))


def misses(ranks: DataFrame, cut: int = 5) -> DataFrame:
    """The questions of each configuration without a relevant item in the first `cut` places."""
    return ranks.filter(F.col("first_rank").isNull() | (F.col("first_rank") > cut))


def labels(gold: DataFrame) -> DataFrame:
    """query_id, label: what a question expects, for reports: its anchors, else its paths."""
    e = expectations(gold)
    return e.select("query_id", F.array_join(F.when(F.size("anchors") > 0, F.col("anchors")).otherwise(F.col("paths")), " | ").alias("label"))


def side_by_side(measured: DataFrame, configs: list[str], value: str = "recall_5") -> DataFrame:
    """One row with a column per configuration."""
    return measured.groupBy().pivot("config", configs).agg(F.first(value))


def agreement(left: DataFrame, right: DataFrame, key: str = "item_id") -> DataFrame:
    """How closely two sets of vectors of the same items agree: least cosine, greatest difference of a component, items."""
    j = left.select(key, F.col("vector").alias("l")).join(right.select(key, F.col("vector").alias("r")), key)
    delta = F.array_max(F.zip_with("l", "r", lambda a, b: F.abs(a.cast("double") - b.cast("double"))))
    return j.agg(F.min(cosine(F.col("l"), F.col("r"))).alias("least_cosine"), F.max(delta).alias("greatest_difference"), F.count(F.lit(1)).alias("items"))
