
import numpy as np
import pytest
from pyspark.sql import functions as F

from passageworks.operators import goldset, metrics, retrieval
from passageworks.operators.ordered import group_ranks, take_until


def ranking(spark, rows, src=0):
    return spark.createDataFrame([("q", i, s, r) for r, (i, s) in enumerate(rows, 1)], "query_id string, item_id string, score double, rank int").withColumn("src", F.lit(src))


def scores(df):
    return {r["item_id"]: r["score"] for r in df.collect()}


def test_rrf(spark):
    a, b = ranking(spark, [("a", 3.0), ("b", 2.0), ("c", 1.0)]), ranking(spark, [("c", 3.0), ("a", 2.0), ("d", 1.0)])
    got = scores(retrieval.reciprocal_rank_fusion(a.unionByName(b)))
    for k, v in {"a": 0.032522475, "c": 0.032266458, "b": 0.016129032, "d": 0.015873016}.items():
        assert got[k] == pytest.approx(v, abs=1e-8)


@pytest.mark.parametrize(("alpha", "want"), [(0.5, {"a": 0.625, "c": 0.5, "b": 0.25, "d": 0}), (0.3, {"c": 0.7, "a": 0.475, "b": 0.15, "d": 0}), (0.7, {"a": 0.775, "b": 0.35, "c": 0.3, "d": 0})])
def test_weighted(spark, alpha, want):
    dense, sparse = ranking(spark, [("a", 0.9), ("b", 0.5), ("c", 0.1)]), ranking(spark, [("c", 12.0), ("a", 3.0), ("d", 0.0)])
    got = scores(retrieval.weighted_fusion(dense, sparse, alpha))
    assert all(got[k] == pytest.approx(v) for k, v in want.items())


def test_weighted_equal_scores(spark):
    flat = ranking(spark, [("a", 2.0), ("b", 2.0)])
    assert set(scores(retrieval.weighted_fusion(flat, flat)).values()) == {1.0}


def test_bm25(spark):
    docs = spark.createDataFrame([(1, "work_mem sort"), (2, "shared buffers memory"), (3, "sort sort order by memory"), (4, "vacuum")], "id int, text string")
    q = spark.createDataFrame([(1, "sort mem")], "query_id int, question string")
    index = retrieval.InvertedIndex(docs, "id", "text")
    assert index.stats.first()["avgdl"] == 3.25
    idf = {r["term"]: r["idf"] for r in index.terms.collect()}
    assert idf["mem"] == pytest.approx(0.847298, abs=1e-6) and idf["sort"] == pytest.approx(0)
    got = index.search(q, 4, zero_fill=True).collect()
    assert len(got) == 4 and max(r["score"] for r in got) == pytest.approx(0.767587, abs=1e-6)


def test_reorder(spark):
    base = ranking(spark, [("a", 0.9), ("b", 0.8), ("c", 0.7)])
    new = spark.createDataFrame([("q", "a", 1.0), ("q", "b", 5.0)], "query_id string, item_id string, new_score double")
    got = [(r["item_id"], r["score"]) for r in retrieval.reorder(base, new, 2).orderBy("rank").collect()]
    assert got == [("b", 5.0), ("a", 1.0), ("c", 0.7)]
    assert [r["item_id"] for r in retrieval.reorder(base, new, 1).orderBy("rank").collect()] == ["a", "b", "c"]


def test_unknown_reranker(spark):
    with pytest.raises(ValueError):
        retrieval.rerank(ranking(spark, []), None, None, 5, "nope")


def test_dense_against_brute_force(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(120, 8))
    v[5] = 0
    rows = [(i, [float(x) for x in v[i]]) for i in range(120)] + [(900, None)]
    vec = spark.createDataFrame(rows, "item_id int, vector array<float>")
    q = spark.createDataFrame([(i, r) for i, r in rows[:120] if i % 20 == 0], "query_id int, vector array<float>")
    got = retrieval.dense_top_k(q, vec.repartition(5), 7, block=2).collect()
    unit = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    for i in range(0, 120, 20):
        want = np.argsort(-(unit @ unit[i]), kind="stable")[:7].tolist()
        assert [r["item_id"] for r in sorted((r for r in got if r["query_id"] == i), key=lambda r: r["rank"])] == want
    assert retrieval.dense_top_k(q.limit(0), vec, 3).count() == 0


def test_metrics(spark):
    ranks = spark.createDataFrame([("c", i, "t", r) for i, r in enumerate([1, 3, None, 7, 2])], "config string, query_id int, topic string, first_rank int")
    m = metrics.measures(ranks).first()
    assert m["recall_5"] == pytest.approx(0.6) and m["mrr"] == pytest.approx(0.395238, abs=1e-6) and m["ndcg_5"] == pytest.approx(0.426186, abs=1e-6)
    assert m["recall_5"] <= m["recall_10"] <= m["recall_20"] <= m["recall_50"]
    assert {r["bucket"]: r["n"] for r in metrics.rank_buckets(ranks).collect()} == {"1": 1, "2-3": 2, "6-10": 1, "miss": 1}


def test_gain(spark):
    got = [r[0] for r in spark.createDataFrame([(r,) for r in (1, 2, 3, 5, 10)], "r int").select(metrics.gain(F.col("r"))).collect()]
    assert got == pytest.approx([1, 0.63093, 0.5, 0.386853, 0.289065], abs=1e-5)


def test_group_ranks_with_ties_nulls_and_infinities(spark):
    inf = float("inf")
    vals = [3.0, 3.0, 1.0, None, float("nan"), inf, -inf, 2.5]
    df = spark.createDataFrame([("g", i, v) for i, v in enumerate(vals)] + [(None, 9, 1.0)], "g string, i int, s double")
    got = {r["i"]: r["rank"] for r in group_ranks(df, ["g"], "s").collect()}
    assert got == {5: 1, 0: 2.5, 1: 2.5, 7: 4, 2: 5, 6: 6, 3: 7.5, 4: 7.5, 9: 1}
    assert group_ranks(df.limit(0), ["g"], "s").count() == 0


def test_take_until(spark):
    df = spark.createDataFrame([("a", i, (i * 37 % 100) / 100, 10, 255) for i in range(100)], "k string, i int, p double, s int, t int")
    got = take_until(df, "k", F.col("p"), "s", "t", buckets=8).collect()
    assert abs(sum(r["s"] for r in got) - 255) <= 5 and max(r["p"] for r in got) <= 0.26


def test_even_stride(spark):
    df = spark.createDataFrame([(i,) for i in range(17)], "id int")
    got = sorted(r["id"] for r in goldset.even_stride(df, "id", 5).collect())
    assert got == [int(i * 17 / 5) for i in range(5)]
    assert goldset.even_stride(df, "id", 50).count() == 17


