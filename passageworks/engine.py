"""One object for the whole pipeline: extract, chunk, embed, ask, evaluate, compare."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import preview, token_count
from .operators import chunking, consistency, html, layout, metrics, retrieval, store
from .session import materialize, ship
from .sources.records import DOCUMENT, Corpus, read_parquet_or_empty, read_vector_cache

QUERY_PREFIX = "Represent this sentence for searching relevant passages: "


class Engine:
    def __init__(self, spark: SparkSession, root: str, corpus: str = "slice", embed: Callable[[Column], Column] | None = None, cost: chunking.Cost = token_count):
        ship(spark)
        self.spark, self.corpus = spark, Corpus(root, corpus)
        self.embed = embed or store.random_hyperplane_embedding(64)
        self.cost = cost

    def extract(self, pages: DataFrame) -> DataFrame:
        docs = html.extract_pages(pages)
        docs.write.mode("overwrite").parquet(self.corpus.stage("documents", "html"))
        return docs

    def extract_layout(self, lines: DataFrame, outline: DataFrame, pages: int, outermost: bool = True) -> DataFrame:
        """Documents of a laid-out build: those whose titles the html build has, or all where there is no html build."""
        path = self.corpus.stage("documents", "html")
        have = read_parquet_or_empty(self.spark, path, DOCUMENT)
        wanted = None if have.isEmpty() else layout.wanted_titles(have)
        docs = layout.extract_documents(lines, outline, pages, wanted, outermost)
        docs.write.mode("overwrite").parquet(self.corpus.stage("documents", "pdf"))
        return docs

    def chunk(self, source_format: str) -> DataFrame:
        docs = self.spark.read.parquet(self.corpus.stage("documents", source_format)).withColumn("source_format", F.lit(source_format))
        path = self.corpus.stage("chunks", source_format)
        chunking.chunk_documents(docs, self.cost).write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def embed_and_store(self, source_format: str) -> DataFrame:
        """Vectors of the chunks; only texts that no earlier run embedded are embedded."""
        chunks = self.spark.read.parquet(self.corpus.stage("chunks", source_format))
        out, _ = store.embed_with_cache(chunks, read_vector_cache(self.spark, self.corpus.vectors), self.embed)
        out = materialize(out.select("chunk_id", "content_hash", "vector"), "embedded")
        stored = self.upsert(out, source_format)
        known = read_vector_cache(self.spark, self.corpus.vectors).select("content_hash")
        fresh = stored.select("content_hash", "vector").join(known, "content_hash", "left_anti").dropDuplicates(["content_hash"])
        store.write_new_vectors(materialize(fresh, "vectors"), self.corpus.vectors)
        return stored

    def upsert(self, vectors: DataFrame, source_format: str) -> DataFrame:
        """Add vectors (chunk_id, content_hash, vector) to the store, replacing those of the same chunk_id; rows of other chunks stay."""
        path = self.corpus.stage("vectors", source_format)
        have = read_parquet_or_empty(self.spark, path, "chunk_id string, content_hash string, vector array<float>")
        kept = have.join(vectors.select("chunk_id"), "chunk_id", "left_anti")
        merged = materialize(kept.select("chunk_id", "content_hash", "vector").unionByName(vectors.dropDuplicates(["chunk_id"])), "store")
        merged.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def reset(self, source_format: str) -> None:
        """Empty the vector store of one format."""
        self.spark.createDataFrame([], "chunk_id string, content_hash string, vector array<float>").write.mode("overwrite").parquet(self.corpus.stage("vectors", source_format))

    def ask(self, questions: DataFrame, source_format: str, k: int = 5, where: Column | None = None, full: bool = False) -> DataFrame:
        """Top k passages of questions (query_id, question); fails on an empty store. `where` filters chunks before ranking."""
        chunks = self.spark.read.parquet(self.corpus.stage("chunks", source_format))
        vectors = self.spark.read.parquet(self.corpus.stage("vectors", source_format))
        if vectors.isEmpty():
            raise ValueError(f"the {source_format} store is empty; run chunk and embed_and_store first")
        items = vectors.select("chunk_id", "vector") if where is None else vectors.join(chunks.filter(where).select("chunk_id"), "chunk_id").select("chunk_id", "vector")
        q = questions.select("query_id", self.embed(F.concat(F.lit(QUERY_PREFIX), "question")).alias("vector"))
        top = retrieval.dense_top_k(q, items.withColumnRenamed("chunk_id", "item_id"), k)
        payload = chunks.select(F.col("chunk_id").alias("item_id"), "title", "section_anchor", "source_url", preview(F.col("text"), full=full).alias("text"))
        return top.join(payload, "item_id")

    def evaluate(self, gold: DataFrame, source_format: str, k: int = 50) -> DataFrame:
        chunks = self.spark.read.parquet(self.corpus.stage("chunks", source_format))
        r = self.ask(gold.select("query_id", "question"), source_format, k).withColumn("config", F.lit("dense"))
        e = metrics.expectations(gold)
        return metrics.measures(metrics.first_ranks(r.select("config", "query_id", "item_id", "rank"), self._hits(r, gold, chunks), e.select("query_id", "topic")))

    def experiment(self, gold: DataFrame, source_format: str = "html", models: tuple[str, ...] = ("overlap",)) -> DataFrame:
        """Every configuration's measures, with the recall of its candidate pool, over one pass of retrieval."""
        chunks = self.spark.read.parquet(self.corpus.stage("chunks", source_format))
        dense = materialize(self.ask(gold.select("query_id", "question"), source_format, retrieval.FUSED_FROM).select("query_id", "item_id", "rank", "score"), "dense")
        sparse = materialize(retrieval.InvertedIndex(chunks, "chunk_id", "text").search(gold, retrieval.FUSED_FROM), "sparse")
        texts = chunks.select(F.col("chunk_id").alias("item_id"), "text")
        runs = materialize(retrieval.experiment_runs(dense, sparse, gold.select("query_id", "question"), texts, models), "runs")
        ranks = metrics.first_ranks(runs, self._hits(runs, gold, chunks), metrics.expectations(gold).select("query_id", "topic"))
        return metrics.measures(ranks).join(metrics.pool_recall(ranks), "config")

    def _hits(self, rankings: DataFrame, gold: DataFrame, chunks: DataFrame) -> DataFrame:
        e = metrics.expectations(gold)
        c = chunks.select(F.col("chunk_id").alias("item_id"), F.col("section_anchor").alias("anchor"), F.array_join("section_path", " > ").alias("crumb"))
        pairs = rankings.select("query_id", "item_id").distinct().join(c, "item_id").join(e, "query_id")
        return pairs.filter(metrics.is_relevant(F.col("anchor"), F.col("crumb"), F.col("anchors"), F.col("paths"))).select("query_id", "item_id")

    def compare(self) -> DataFrame:
        """Coverage and similarities of the two builds in one row; vectors count where both are stored."""
        rows = {}
        for f in ("html", "pdf"):
            c = self.spark.read.parquet(self.corpus.stage("chunks", f)).select("chunk_id", "doc_id", "ordinal", "text", "content_hash", F.col("section_path").alias("path"), F.col("section_anchor").alias("anchor"))
            rows[f] = consistency.keyed(c)
        left, right = (materialize(consistency.grouped(rows[f], "chunk_id", ["doc_id", "ordinal"]), "groups") for f in ("html", "pdf"))
        joined = materialize(consistency.fallback_join(left, right), "joined")
        pairs = consistency.compare(consistency.with_texts(joined, rows["html"], rows["pdf"], "chunk_id", ["doc_id", "ordinal"]))
        ids = rows["html"].unionByName(rows["pdf"]).select(F.col("chunk_id").alias("item"), "content_hash")
        cos = consistency.vector_cosines(joined, ids.join(read_vector_cache(self.spark, self.corpus.vectors), "content_hash"))
        told = pairs.agg(F.median("jaccard").alias("median_jaccard"), F.median("char_ratio").alias("median_ratio"))
        return consistency.coverage(joined, left, right).crossJoin(told).crossJoin(cos.agg(F.median("cosine").alias("median_cosine"), F.count(F.lit(1)).alias("cosine_pairs")))  # one row each

    def status(self) -> DataFrame:
        return self.corpus.status(self.spark)
