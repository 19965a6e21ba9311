"""One ranking from several differently-scaled scores: weighted median rank aggregation."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import group_ranks, running_count
from ..session import materialize

#: Items of a group that one task may sort. Larger groups are ranked in ranges, with the same result.
SMALL = 20_000
CONFIGS = {"dense": True, "bm25": True, "rerank_small": True, "rerank_large": True, "dense_l2": False}


def latest_scores(df: DataFrame, keys: Sequence[str], item: str, config: str, score: str, at: str, row_id: str) -> DataFrame:
    """One row per group, config and item: that scored last; of equal times the greatest score, a null or NaN time or score last."""
    s = F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double"))
    last = F.max(F.struct(F.col(at).isNotNull(), F.col(at), s.isNotNull(), s, F.col(row_id))).alias("_m")
    return df.groupBy(*keys, F.col(config).alias("config"), F.col(item).alias("item_id")).agg(last).select(*keys, "config", "item_id", F.col("_m").getField("col4").alias("score"))


def item_scores(scores: DataFrame, keys: Sequence[str], configs: Sequence[str]) -> DataFrame:
    """One row per item: keys, item_id, s ARRAY<DOUBLE>, its score in each config, null where it has none.

    scores: keys, config, item_id, score; one row per item and config. Other configs and null items are left out.
    """
    s = scores.filter(F.col("config").isin(list(configs)) & F.col("item_id").isNotNull())
    return s.groupBy(*keys, "item_id").agg(F.array(*[F.max(F.when(F.col("config") == c, F.col("score"))) for c in configs]).alias("s"))


def item_ranks(items: DataFrame, keys: Sequence[str], higher_is_better: Sequence[bool], big: DataFrame | None = None) -> DataFrame:
    """keys, item_id, r ARRAY<DOUBLE>: every item's mid-rank in every config. An item without a score ranks behind all scored ones, tied with
    all like it. One shuffle by group serves all configs; the groups in `big` are ranked in ranges.
    """
    small, large = _by_size(items, keys, big)
    ranks = []
    for i, up in enumerate(higher_is_better):
        # Zero and minus zero tie.
        score = F.col("s")[i] + F.lit(0.0)
        order = score.desc_nulls_last() if up else score.asc_nulls_last()
        tied = F.count(F.lit(1)).over(Window.partitionBy(*keys, score))
        ranks.append(F.rank().over(Window.partitionBy(*keys).orderBy(order)) + (tied - 1) / F.lit(2.0))
    out = small.select(*keys, "item_id", F.array(*ranks).alias("r"))
    if large is None:
        return out
    long = large.select(*keys, "item_id", F.posexplode("s").alias("_c", "score"))
    up = F.element_at(F.array(*[F.lit(u) for u in higher_is_better]), F.col("_c") + 1)
    ranked = group_ranks(long, [*keys, "_c"], "score", up)
    return out.unionByName(ranked.groupBy(*keys, "item_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("_c", "rank"))), lambda x: x["rank"]).alias("r")))


def large_groups(rows: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """The groups of more than SMALL rows as _b0, _b1, ..., at most rows / SMALL of them; None where there are none."""
    big = materialize(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > SMALL).select(*[F.col(k).alias(f"_b{i}") for i, k in enumerate(keys)]), "large-groups")
    return None if big.isEmpty() else big


def _by_size(rows: DataFrame, keys: Sequence[str], big: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """Rows of the other groups, and of those in `big`, if there are any."""
    if big is None:
        return rows, None
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_b{i}"))
    return rows.join(big, on, "left_anti"), rows.join(big, on, "left_semi")


def _median(ranks: Column) -> Column:
    """Weighted lower median of an array of (rank, weight) sorted by rank."""
    half = F.aggregate(ranks, F.lit(0.0), lambda a, x: a + x["weight"]) / 2
    done = F.aggregate(
        ranks,
        F.struct(F.lit(0.0).alias("w"), F.lit(None).cast("double").alias("m")),
        lambda a, x: F.struct((a["w"] + x["weight"]).alias("w"), F.when(a["m"].isNull() & (a["w"] + x["weight"] >= half), x["rank"]).otherwise(a["m"]).alias("m")),
    )
    return done["m"]


def median_rank_ranking(df: DataFrame, keys: Sequence[str] = ("run_id", "query_id"), item: str = "item_id", config: str = "config", score: str = "score", at: str = "scored_at", row_id: str = "result_id", higher_is_better: Mapping[str, bool] = CONFIGS, weights: Mapping[str, float] | None = None) -> DataFrame:
    """The ranking of each group: keys, item_id, median_rank, mean_rank, ranks MAP<config, rank>, position (from 1).

    Order: weighted median rank, then weighted mean rank, then item_id. Only ranks are compared, so no scale or range of a
    config matters. Repeated rows and older scores are dropped first. Null scores and absent items rank last and tie. Null
    keys are a group of their own; an empty input has an empty result; columns other than the named ones are not read. Configs of
    weight 0 are ignored. Groups of any size are ranked in ranges, never in one task.
    """
    keys = list(keys)
    weights = {c: float((weights or {}).get(c, 1.0)) for c in higher_is_better}
    if min(weights.values()) < 0 or not any(weights.values()):
        raise ValueError("weights must be non-negative and not all zero")
    used = {c: up for c, up in higher_is_better.items() if weights[c] > 0}
    total = sum(weights[c] for c in used)
    items = materialize(item_scores(latest_scores(df, keys, item, config, score, at, row_id), keys, list(used)), "scores")
    big = large_groups(items, keys)
    ranks = item_ranks(items, keys, list(used.values()), big)
    w = F.array(*[F.lit(weights[c]) for c in used])
    sorted_ = F.array_sort(F.zip_with("r", w, lambda r, x: F.struct(r.alias("rank"), x.alias("weight"))))
    out = ranks.select(
        *keys, "item_id", _median(sorted_).alias("median_rank"),
        (F.aggregate(F.zip_with("r", w, lambda r, x: r * x), F.lit(0.0), lambda a, x: a + x) / F.lit(total)).alias("mean_rank"),
        F.map_from_arrays(F.array(*[F.lit(c) for c in used]), F.col("r")).alias("ranks"),
    )
    small, large = _by_size(out, keys, big)
    small = small.withColumn("position", F.row_number().over(Window.partitionBy(*keys).orderBy("median_rank", "mean_rank", "item_id")).cast("bigint"))
    return small if large is None else small.unionByName(running_count(large, keys, ["median_rank", "mean_rank", "item_id"], F.lit(True), "position"))


def majority_winner(ranking: DataFrame, keys: Sequence[str], configs: Sequence[str], least: int) -> DataFrame:
    """The item of each group that is better than each other item in at least `least` configs, if there is one: keys, item_id.

    Only ranks from the operator are compared. The leader by median rank is the first champion; an item that beats the champion
    takes its place, in the order of the ranking, and whoever beats all must be the last champion, which is then checked against every item.
    """
    keys = list(keys)
    vec = F.array(*[F.col("ranks")[c] for c in configs]).alias("v")
    small, large = _by_size(ranking.select(*keys, "position", "item_id", vec), keys, large_groups(ranking, keys))

    def wins(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: (p < q).cast("int")), F.lit(0), lambda a, z: a + z)

    def champion(rows: Column) -> Column:
        return F.aggregate(F.slice(rows, 2, F.size(rows)), F.element_at(rows, 1), lambda c, x: F.when(wins(x["v"], c["v"]) >= least, x).otherwise(c))

    listed = F.array_sort(F.collect_list(F.struct("position", "item_id", "v"))).alias("a")
    one = small.groupBy(*keys).agg(listed).withColumn("c", champion(F.col("a")))
    beaten = F.forall("a", lambda x: (x["item_id"] == F.col("c")["item_id"]) | (wins(F.col("c")["v"], x["v"]) >= least))
    out = one.filter(beaten).select(*keys, "c.item_id")
    return out if large is None else out.unionByName(_winner_of_large(large, keys, listed, champion, wins, least))


def _winner_of_large(rows: DataFrame, keys: list[str], listed: Column, champion: Callable, wins: Callable, least: int) -> DataFrame:
    """Champions of runs of SMALL places, then among those until each group has one; it is checked against every item through a join."""
    top, rows = rows, materialize(rows, "large")
    while True:
        top = top.withColumn("_b", F.floor((F.col("position") - 1) / F.lit(SMALL))).groupBy(*keys, "_b").agg(listed)
        top = materialize(top.withColumn("c", champion(F.col("a"))).select(*keys, F.col("_b").alias("_run"), "c.item_id", "c.v"), "champions")
        if top.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
            break
        top = top.withColumn("position", F.row_number().over(Window.partitionBy(*keys).orderBy("_run"))).drop("_run")  # a row for each SMALL places
    best = top.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("item_id").alias("_item"), F.col("v").alias("_v"))
    on = off = F.lit(True)
    for i, k in enumerate(keys):
        on, off = on & F.col(k).eqNullSafe(F.col(f"_k{i}")), off & F.col(f"_k{i}").eqNullSafe(F.col(f"_f{i}"))
    fails = rows.join(best, on).filter((F.col("item_id") != F.col("_item")) & (wins(F.col("_v"), F.col("v")) < least)).select(*[F.col(k).alias(f"_f{i}") for i, k in enumerate(keys)]).distinct()
    return best.join(fails, off, "left_anti").select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)], F.col("_item").alias("item_id"))
