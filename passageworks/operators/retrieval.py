"""Rankings: dense and lexical top-k, fusion, reranking.

Every ranking is a relation (config, query_id, rank, item_id, score) with the total order score descending, item_id ascending.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import lexical_tokens
from ..session import materialize

QUERY_BLOCK = 2_000
#: Query terms that are broadcast at most (a few MB); more are joined by a shuffle.
ASKED = 50_000


def dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, v: s + v)


def norm(x: Column) -> Column:
    return F.sqrt(dot(x, x))


def cosine(x: Column, y: Column) -> Column:
    """Cosine similarity; 0 if either norm is 0."""
    n = norm(x) * norm(y)
    return F.when(n == 0, F.lit(0.0)).otherwise(dot(x, y) / n)


def top_k(scored: DataFrame, k: int, config: str | None = None) -> DataFrame:
    """Best k per query by (score desc, item_id). scored: query_id, item_id, score. Scores that agree to 9 places tie."""
    w = Window.partitionBy("query_id").orderBy(F.round("score", 9).desc(), "item_id")
    out = scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return out if config is None else out.withColumn("config", F.lit(config))


def dense_top_k(queries: DataFrame, vectors: DataFrame, k: int, where: Column | None = None, block: int = QUERY_BLOCK) -> DataFrame:
    """Exact cosine top-k of a stated query set: queries (query_id, vector) in blocks of bounded size against all vectors (item_id, vector).

    Each task scores its batch of vectors against the block with one matrix product and keeps k per query, so vectors are never shuffled, and
    behind it k rows per query and task are, not a row per pair. Blocks are run and written one by one: the driver and a task hold one block
    of `block` queries, however many there are. `where` filters items before ranking. Null vectors and vectors of another length are left out.
    """
    items = vectors if where is None else vectors.filter(where)
    items = items.select("item_id", "vector").filter("item_id IS NOT NULL AND vector IS NOT NULL")
    id_type = vectors.schema["item_id"].dataType.simpleString()
    q_type = queries.schema["query_id"].dataType.simpleString()
    schema = f"query_id {q_type}, item_id {id_type}, score double"
    out = None
    for ids, matrix in _query_blocks(queries, block):
        part = items.filter(F.size("vector") == matrix.shape[1]).mapInPandas(_score_block(ids, matrix, k), schema)
        if len(ids) == block:
            part = materialize(top_k(part, k).select("query_id", "item_id", "score"), "dense")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = queries.sparkSession.createDataFrame([], schema)
    return top_k(out, k)


def _query_blocks(queries: DataFrame, block: int):
    ids, rows = [], []
    for r in queries.select("query_id", "vector").filter("vector IS NOT NULL").toLocalIterator():
        if rows and (len(rows) == block or len(r["vector"]) != len(rows[0])):
            yield ids, np.array(rows, np.float64)
            ids, rows = [], []
        ids.append(r["query_id"])
        rows.append(r["vector"])
    if rows:
        yield ids, np.array(rows, np.float64)


def _score_block(ids: list, matrix: np.ndarray, k: int):
    def run(it):
        m = matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-300)
        best = [(np.empty(0, object), np.empty(0))] * len(ids)
        for pdf in it:
            if not len(pdf):
                continue
            v = np.array(pdf["vector"].tolist(), np.float64)
            n = np.linalg.norm(v, axis=1)
            scores = np.divide(m @ v.T, n, out=np.zeros((len(m), len(n))), where=n > 0)
            _keep_best(best, scores, pdf["item_id"].to_numpy(object), k)
        rows = [(ids[i], a, float(b)) for i, (x, s) in enumerate(best) for a, b in zip(x, s)]
        yield pd.DataFrame(rows, columns=["query_id", "item_id", "score"])

    return run


class InvertedIndex:
    """BM25 over a corpus: `postings` (term, item_id, tf, dl), `terms` (term, df, idf), `stats` (one row: n, avgdl).

    Okapi weights; a term in more than half of the documents would get a negative idf, which is raised to epsilon times the mean idf. Postings
    are written once, when first used, and every search reads them.
    """

    def __init__(self, docs: DataFrame, item_id: str, text: str, k1: float = 1.5, b: float = 0.75, epsilon: float = 0.25):
        self.k1, self.b = k1, b
        self.docs = docs.select(F.col(item_id).alias("item_id"), lexical_tokens(F.coalesce(F.col(text), F.lit(""))).alias("t"))
        self._epsilon = epsilon

    @cached_property
    def postings(self) -> DataFrame:
        return materialize(self._counted(), "postings")

    def _known(self) -> DataFrame:
        """The postings, counted anew where no search has written them yet."""
        return self.__dict__["postings"] if "postings" in self.__dict__ else self._counted()

    def _counted(self) -> DataFrame:
        # Counted within each document's row: no shuffle, and a document's postings stay together, so a search adds them up before it shuffles.
        def count(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in it:
                n = [Counter(t) for t in pdf["t"]]
                sizes = [len(c) for c in n]
                yield pd.DataFrame({"term": [w for c in n for w in c], "item_id": pdf["item_id"].repeat(sizes).array, "tf": [k for c in n for k in c.values()], "dl": np.repeat([c.total() for c in n], sizes).astype(np.int32)})

        i_type = self.docs.schema["item_id"].dataType.simpleString()
        return self.docs.mapInPandas(count, f"term string, item_id {i_type}, tf bigint, dl int")

    @cached_property
    def stats(self) -> DataFrame:
        n, total = self.docs.agg(F.count(F.lit(1)).alias("n")), self._known().agg(F.coalesce(F.sum("tf"), F.lit(0)).alias("total"))
        return n.crossJoin(F.broadcast(total)).select("n", (F.col("total") / F.nullif("n", F.lit(0))).alias("avgdl"))  # one row each

    @cached_property
    def terms(self) -> DataFrame:
        df = self._known().groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        raw = df.crossJoin(F.broadcast(self.stats)).withColumn("raw", F.log(F.col("n") - F.col("df") + 0.5) - F.log(F.col("df") + 0.5))  # stats is one row
        mean = raw.agg(F.avg("raw").alias("mean"))
        return raw.crossJoin(F.broadcast(mean)).select("term", "df", F.when(F.col("raw") < 0, F.col("mean") * self._epsilon).otherwise(F.col("raw")).alias("idf"))

    def search(self, queries: DataFrame, k: int, query_id: str = "query_id", text: str = "question", zero_fill: bool = False) -> DataFrame:
        """Top k per query by BM25. A word repeated in the question counts each time. zero_fill also ranks documents without any hit.

        Query terms, with their weights, are joined with the postings, by broadcast up to ASKED of them, and the products summed per query and
        document. What is ranked is cut to k per query before it is shuffled.
        """
        postings = self.postings
        q = queries.select(F.col(query_id).alias("query_id"), lexical_tokens(F.coalesce(F.col(text), F.lit(""))).alias("t"))
        asked = q.select("query_id", F.explode("t").alias("term")).groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("times"))
        asked = materialize(asked.join(self.terms, "term").select("query_id", "term", (F.col("times") * F.col("idf")).alias("weight")), "asked")
        if asked.count() <= ASKED:
            asked = F.broadcast(asked)
        norm = F.lit(self.k1) * (1 - self.b + self.b * F.col("dl") / F.coalesce("avgdl", F.lit(1.0)))
        part = F.col("weight") * F.col("tf") * (self.k1 + 1) / (F.col("tf") + norm)
        hits = postings.join(asked, "term").crossJoin(F.broadcast(self.stats))  # stats is one row
        scored = hits.groupBy("query_id", "item_id").agg(F.sum(part).alias("score"))
        if zero_fill:
            spare = self.docs.select("item_id").orderBy("item_id")
            pad = q.select("query_id").distinct().crossJoin(F.broadcast(spare.limit(k)))  # k rows
            scored = scored.unionByName(pad.join(scored, ["query_id", "item_id"], "left_anti").withColumn("score", F.lit(0.0)))
        return top_k(scored, k)


def _keep_best(best: list, scores: np.ndarray, names: np.ndarray, k: int) -> None:
    """Merge a batch's scores [query, item] into the best so far; ties at the edge stay, the final order settles them."""
    for i in range(len(best)):
        s, x = np.concatenate([best[i][1], scores[i]]), np.concatenate([best[i][0], names])
        if len(s) > k:
            keep = s >= np.partition(s, len(s) - k)[len(s) - k] - 1e-9
            s, x = s[keep], x[keep]
        best[i] = (x, s)


def reciprocal_rank_fusion(rankings: DataFrame, k: int = 60, top: int | None = None) -> DataFrame:
    """rankings: src (order of the rankings), query_id, item_id, rank. score = sum of 1 / (k + rank); ties by best place, then item."""
    fused = rankings.groupBy("query_id", "item_id").agg(F.sum(1 / (F.lit(k) + F.col("rank"))).alias("score"))
    out = fused.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.round("score", 12).desc(), "item_id")))
    return out if not top else out.filter(F.col("rank") <= top)


def weighted_fusion(dense: DataFrame, sparse: DataFrame, alpha: float = 0.5, top: int | None = None) -> DataFrame:
    """alpha * dense + (1 - alpha) * sparse over min-max scaled scores; 0 where absent; a list of equal scores scales to 1."""

    def scaled(df: DataFrame, name: str) -> DataFrame:
        w = Window.partitionBy("query_id")
        lo, span = F.min("score").over(w), F.max("score").over(w) - F.min("score").over(w)
        return df.select("query_id", "item_id", F.when(span == 0, F.lit(1.0)).otherwise((F.col("score") - lo) / F.nullif(span, F.lit(0.0))).alias(name))

    both = scaled(dense, "d").join(scaled(sparse, "s"), ["query_id", "item_id"], "full_outer")
    fused = both.select("query_id", "item_id", (F.lit(alpha) * F.coalesce("d", F.lit(0.0)) + F.lit(1 - alpha) * F.coalesce("s", F.lit(0.0))).alias("score"))
    out = fused.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.round("score", 12).desc(), "item_id")))
    return out if not top else out.filter(F.col("rank") <= top)


def reorder(ranking: DataFrame, scores: DataFrame, depth: int) -> DataFrame:
    """The first `depth` places put in order of new scores (query_id, item_id, new_score); places behind stay. A head of one is left alone."""
    joined = ranking.join(scores, ["query_id", "item_id"], "left")
    head = F.col("rank") <= depth
    heads = F.sum(head.cast("int")).over(Window.partitionBy("query_id"))
    act = head & (heads >= 2)
    order = [(F.col("rank") > depth).cast("int"), F.when(act, -F.col("new_score")).asc_nulls_last(), F.col("rank")]
    return joined.select("query_id", "item_id", F.when(act, F.col("new_score")).otherwise(F.col("score")).alias("score"), F.row_number().over(Window.partitionBy("query_id").orderBy(*order)).alias("rank"))


DEPTH, FUSED_FROM, ALPHAS, RERANK_DEPTHS = 50, 100, (0.3, 0.5, 0.7), (20, 50)


def experiment_runs(dense: DataFrame, sparse: DataFrame, questions: DataFrame, texts: DataFrame, models: tuple[str, ...] = ("overlap",)) -> DataFrame:
    """config, query_id, rank, item_id, score of every configuration: dense, bm25, hybrid_rrf, hybrid_<alpha>, and dense and hybrid_rrf reranked.

    dense, sparse: rankings to FUSED_FROM places. Fusion draws from all of them, and every ranking is judged over DEPTH, so configurations compare like
    for like. A base is scored by a model once, to DEPTH; shallower rerankings reuse the scores and hold the same candidates.
    """
    cols = ["query_id", "item_id", "rank", "score"]
    cut = lambda r: r.filter(F.col("rank") <= DEPTH).select(*cols)
    hybrid = materialize(reciprocal_rank_fusion(dense.select(*cols).unionByName(sparse.select(*cols)), top=DEPTH), "hybrid")
    runs = {"dense": cut(dense), "bm25": cut(sparse), "hybrid_rrf": cut(hybrid)}
    runs |= {f"hybrid_{a}": weighted_fusion(dense, sparse, a, DEPTH).select(*cols) for a in ALPHAS}
    for name, pool in (("dense", cut(dense)), ("hybrid_rrf", cut(hybrid))):
        for model in models:
            scores = materialize(model_scores(pool, questions, texts, model), "scores")
            runs |= {f"{name}_{model}_{n}": reorder(pool, scores, n).select(*cols) for n in RERANK_DEPTHS}
    out = None
    for config, r in runs.items():
        r = r.withColumn("config", F.lit(config))
        out = r if out is None else out.unionByName(r)
    return out


RERANKERS: dict[str, Callable[[Column, Column], Column]] = {}


def register_reranker(name: str, scorer: Callable[[Column, Column], Column]) -> None:
    """A scorer takes (question, text) columns, built-in or a pandas UDF, and returns a score column."""
    RERANKERS[name] = scorer


def model_scores(ranking: DataFrame, questions: DataFrame, texts: DataFrame, model: str) -> DataFrame:
    """query_id, item_id, new_score: a registered model's score of each question (query_id, question) and ranked text (item_id, text)."""
    if model not in RERANKERS:
        raise ValueError(f"unknown reranker {model!r}; known: {sorted(RERANKERS)}")
    pairs = ranking.select("query_id", "item_id").join(questions, "query_id").join(texts, "item_id")
    return pairs.select("query_id", "item_id", RERANKERS[model](F.col("question"), F.col("text")).alias("new_score"))


def rerank(ranking: DataFrame, questions: DataFrame, texts: DataFrame, depth: int, model: str = "overlap") -> DataFrame:
    """Score the first `depth` candidates with a registered model and reorder them. questions: query_id, question; texts: item_id, text."""
    return reorder(ranking, model_scores(ranking.filter(F.col("rank") <= depth), questions, texts, model), depth)


def cross_encoder(load: Callable[[], Callable[[list[tuple[str, str]]], list[float]]], batch: int = 32) -> Callable[[Column, Column], Column]:
    """A reranker by any model of pairs: `load` gives a function from (question, text) pairs to scores and is called once in each worker."""

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = None
        for q, t in batches:
            model = model or load()
            pairs = [(a or "", b or "") for a, b in zip(q, t)]
            yield pd.Series([float(x) for at in range(0, len(pairs), batch) for x in model(pairs[at : at + batch])], dtype="float64")

    return score


def _overlap(question: Column, text: Column) -> Column:
    """Share of the question's distinct tokens that the text holds: a deterministic stand-in that needs no model files."""
    q = F.array_distinct(lexical_tokens(question))
    return F.size(F.array_intersect(q, lexical_tokens(text))) / F.greatest(F.size(q), F.lit(1))


register_reranker("overlap", _overlap)
