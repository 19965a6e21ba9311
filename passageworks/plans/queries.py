"""Registered queries of the retrieval-analytics operators, each over its whole tables; their SQL is in sql.py."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import identity, text
from ..operators import chunking, consistency, crawl, goldset, html, layout, metrics, retrieval, store
from ..session import materialize, shared_dir, table
from .sql import SQL  # noqa: F401

AREAS = {"Server Administration": "admin", "Server Programming": "programming", "Reference": "reference", "Internals": "internals", "Tutorial": "tutorial", "Client Interfaces": "clients"}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


# Identity and text


@query
def content_hash_dedup(spark, d):
    t = table(spark, d, "documents").filter("text IS NOT NULL")
    return t.groupBy(identity.content_hash(F.col("text")).alias("content_hash")).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))


@query
def stable_chunk_id(spark, d):
    c = table(spark, d, "chunk")
    return c.select("chunk_id", identity.chunk_id(F.col("source_format"), F.col("doc_id"), F.col("section_anchor"), F.col("ordinal")).alias("derived_id")).distinct()


@query
def hash_audit(spark, d):
    c = table(spark, d, "chunk").filter("text IS NOT NULL")
    state = F.when(F.col("content_hash").isNull(), "missing").when(F.col("content_hash") == identity.content_hash(F.col("text")), "current").otherwise("stale")
    return c.groupBy("source_format", state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


@query
def normalize_prose(spark, d):
    return table(spark, d, "documents").select("doc_id", text.normalize_prose(F.col("text"), from_pdf=False).alias("prose"))


@query
def normalize_prose_wrapped(spark, d):
    return table(spark, d, "documents").select("doc_id", text.normalize_prose(F.col("text"), from_pdf=True).alias("prose"))


@query
def normalize_code(spark, d):
    b = table(spark, d, "doc_section").select("section_id", F.posexplode("blocks").alias("ord", "b")).filter("b.kind = 'code' AND b.text IS NOT NULL")
    return b.select("section_id", "ord", text.normalize_code(F.col("b.text")).alias("code")).distinct()


@query
def section_numbers(spark, d):
    t = table(spark, d, "chunk").select(F.explode("section_path").alias("title")).filter("title IS NOT NULL").distinct()
    return t.select("title", text.split_section_number(F.col("title")).alias("s")).select("title", F.col("s.number").alias("number"), F.col("s.title").alias("bare"))


@query
def title_keys(spark, d):
    t = table(spark, d, "chunk").select(F.explode("section_path").alias("title")).filter("title IS NOT NULL")
    return t.groupBy(text.title_key(F.col("title")).alias("key")).agg(F.countDistinct("title").alias("spellings"), F.count(F.lit(1)).alias("n"))


@query
def token_key_set(spark, d):
    return table(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", F.array_join(text.token_key_set(F.col("text")), " ").alias("words"))


@query
def token_count_estimate(spark, d):
    return table(spark, d, "documents").select("doc_id", text.token_count(F.col("text")).alias("tokens"))


@query
def comparison_text(spark, d):
    return table(spark, d, "chunk").filter("text IS NOT NULL").select("chunk_id", text.comparison_text(F.col("text")).alias("plain")).distinct()


@query
def body_preview(spark, d):
    b = text.body(F.col("text"))
    return table(spark, d, "chunk").filter("text IS NOT NULL").select("chunk_id", F.length(b).cast("bigint").alias("body_chars"), text.preview(b).alias("preview")).distinct()


@query
def lexical_tokenize(spark, d):
    t = text.lexical_tokens(F.col("text"))
    return table(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", F.size(t).cast("bigint").alias("n"), F.array_join(t, " ").alias("tokens"))


@query
def parameter_anchors(spark, d):
    name = F.regexp_extract("title", r"^([a-z][a-z0-9_]*) \(", 1)
    return table(spark, d, "chunk").select(name.alias("name")).filter("name <> ''").distinct().select("name", text.parameter_anchor(F.col("name")).alias("anchor"))


@query
def breadcrumb_areas(spark, d):
    c = table(spark, d, "chunk").select("chunk_id", "section_path", "title").distinct()
    crumb = identity.breadcrumb(F.col("section_path"), F.col("title"))
    return c.groupBy(text.area_of(crumb, AREAS).alias("area")).agg(F.count(F.lit(1)).alias("n"), F.max(F.length(crumb)).cast("bigint").alias("longest"))


@query
def metadata_flatten(spark, d):
    return table(spark, d, "chunk").select("chunk_id", *identity.metadata_columns()).distinct()


@query
def markdown_table(spark, d):
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    j = n.join(r, n["n_regionkey"] == r["r_regionkey"])
    rows = F.array_sort(F.collect_list(F.struct("n_nationkey", F.array("n_name", F.col("n_nationkey").cast("string")).alias("cells"))))
    g = j.groupBy("r_name").agg(rows.alias("x"))
    cells = F.concat(F.array(F.array(F.lit("nation"), F.lit("key"))), F.transform("x", lambda v: v["cells"]))
    return g.select("r_name", text.markdown_table(cells).alias("md"))


# Crawl


@query
def url_slugs(spark, d):
    return table(spark, d, "page_manifest").filter("url IS NOT NULL").select("url", identity.url_slug(F.col("url")).alias("derived_slug"), identity.is_allowed(F.col("url"), ["/current/", "#"]).alias("allowed")).distinct()


@query
def manifest_latest(spark, d):
    return crawl.latest_fetch(table(spark, d, "page_manifest")).select("slug", "fetched_at", "sha256")


@query
def ancestor_breadcrumb(spark, d):
    return crawl.ancestor_titles(table(spark, d, "page_manifest")).select("slug", F.array_join("ancestors", " > ").alias("ancestors"))


# Sections and chunks


@query
def section_split_lines(spark, d):
    t = table(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "line"))
    return t.filter("line <> ''").select("doc_id", F.col("ord").cast("bigint").alias("ord"), "line")


@query
def sentence_split_count(spark, d):
    return table(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", F.size(chunking.sentences(F.col("text"))).cast("bigint").alias("sentences"))


@query
def chunk_greedy_pack(spark, d):
    t = table(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", chunking.greedy_pack(chunking.sentences(F.col("text")), 120).alias("g"))
    return t.select("doc_id", F.posexplode("g").alias("ord", "part")).select("doc_id", F.col("ord").cast("bigint").alias("ord"), "part")


@query
def chunk_type_flags(spark, d):
    s = table(spark, d, "doc_section").filter("blocks IS NOT NULL")
    kinds = F.transform(F.filter("blocks", lambda b: F.coalesce(F.trim(b["text"]), F.lit("")) != ""), lambda b: b["kind"])
    return s.select("section_id", chunking.chunk_type(kinds, F.col("kind") == "parameter").alias("chunk_type"), F.array_contains(kinds, "table").alias("has_table")).distinct()


def _sections(spark, d):
    s = table(spark, d, "doc_section")
    fmt = F.when(F.col("doc_id").startswith("pdf:"), "pdf").otherwise("html")
    return chunking.sections_of_table(s, fmt, F.lit("18"))


@query
def chunk_documents(spark, d):
    c = chunking.chunk_sections(_sections(spark, d), ["section_ord", "section_id"])
    return c.select("chunk_id", "doc_id", "ordinal", "chunk_type", "token_count", "content_hash", "section_anchor", "has_code", "has_table")


@query
def chunked_validate(spark, d):
    return chunking.invalid_chunks(chunking.chunk_sections(_sections(spark, d), ["section_ord", "section_id"]))


@query
def chunk_statistics(spark, d):
    c = table(spark, d, "chunk").select("chunk_id", "chunk_type", "section_anchor", text.token_count(F.col("text")).alias("token_count")).distinct()
    anchored = c.groupBy("chunk_type").agg(F.avg((F.coalesce("section_anchor", F.lit("")) != "").cast("double")).alias("anchored"))
    out = chunking.chunk_statistics(c, "chunk_type").join(anchored, "chunk_type")
    return out.select("chunk_type", "chunks", F.col("least").cast("bigint").alias("least"), F.col("median").cast("bigint").alias("median"), F.col("p95").cast("bigint").alias("p95"), F.col("most").cast("bigint").alias("most"), F.col("over_limit").cast("bigint").alias("over_limit"), F.round("anchored", 6).alias("anchored"))


@query
def validate_chunks(spark, d):
    return chunking.invalid_chunks(table(spark, d, "chunk").select("chunk_id", "text", "section_path").distinct())


@query
def block_profile(spark, d):
    b = table(spark, d, "doc_section").dropDuplicates(["section_id"]).select(F.explode("blocks").alias("b"))
    return b.groupBy(F.col("b.kind").alias("kind"), F.col("b.lang").alias("lang")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(F.coalesce("b.text", F.lit("")))).alias("chars"))


@query
def artifact_peek(spark, d):
    c = table(spark, d, "chunk")
    hay = F.lower(F.concat_ws("\n", "section_anchor", "title", "text"))
    return c.filter(F.contains(hay, F.lit("savepoint")) & F.contains(hay, F.lit("guc-"))).select("chunk_id", "doc_id", "title").distinct()


@query
def html_sections(spark, d):
    """Pages written out as HTML from the sections of a document, parsed again."""
    s = table(spark, d, "doc_section").dropDuplicates(["section_id"]).filter("blocks IS NOT NULL")
    esc = lambda c: F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    para = F.array_join(F.transform("blocks", lambda b: F.when(b["kind"] == "code", F.concat(F.lit("<pre>"), esc(b["text"]), F.lit("</pre>"))).otherwise(F.concat(F.lit("<p>"), esc(b["text"])))), "")
    one = F.concat(F.lit('<div class="sect1" id="'), F.coalesce("anchor", F.lit("")), F.lit('"><h2>'), esc(F.col("title")), F.lit("</h2>"), para, F.lit("</div>"))
    p = s.select("doc_id", "section_ord", "section_id", one.alias("h")).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("section_ord", "section_id", "h"))).alias("x"))
    body = F.array_join(F.transform("x", lambda v: v["h"]), "")
    pages = p.select(F.col("doc_id").alias("slug"), F.lit(None).cast("string").alias("url"), F.col("doc_id").alias("title"), F.lit(0).alias("ordinal"), F.concat(F.lit('<html><body><div id="docContent">'), body, F.lit("</div></body></html>")).alias("html"), F.array().cast("array<string>").alias("ancestors"))
    found = html.extract_pages(pages).select("doc_id", F.posexplode("sections").alias("ord", "s"))
    return found.select("doc_id", F.col("ord").cast("bigint").alias("ord"), "s.title", "s.number", "s.anchor", F.col("s.level").cast("bigint").alias("level"), F.size("s.blocks").cast("bigint").alias("n_blocks"))


@query
def html_tags(spark, d):
    b = table(spark, d, "documents").filter("text IS NOT NULL")
    return html.tag_frequency(b, "text")


# Layout


def _event_lines(spark, d):
    e = table(spark, d, "events")
    sec = (F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")).cast("double")
    return e.select(F.col("user_id").alias("doc"), F.dayofyear("ts").alias("page"), sec.alias("y0"), F.col("event_id").cast("double").alias("x0"), F.col("event_type").alias("text"), (F.col("value") < 20).alias("mono"))


@query
def paragraph_islands(spark, d):
    p = layout.paragraphs(_event_lines(spark, d))
    return p.groupBy("doc").agg(F.max("paragraph").alias("paragraphs"), F.max(F.length("text")).cast("bigint").alias("longest"))


@query
def code_runs(spark, d):
    b = layout.blocks(_event_lines(spark, d))
    return b.groupBy("doc", "kind").agg(F.count(F.lit(1)).alias("blocks"))


def _outline(spark, d):
    s = table(spark, d, "doc_section").filter("doc_id LIKE 'pdf:%' AND page IS NOT NULL").dropDuplicates(["section_id"])
    return s.select(F.col("doc_id").alias("doc"), (F.col("section_ord").cast("bigint") * 10_000_000 + F.col("section_id")).alias("index"), "level", "title", "page")


@query
def outline_end_page(spark, d):
    return layout.outline_ends(_outline(spark, d), 5000).select("doc", "index", "end_page", F.array_join("path", " > ").alias("path"))


@query
def root_selection(spark, d):
    e = layout.outline_ends(_outline(spark, d), 5000)
    return layout.select_roots(e, True).select("doc", "index", F.lit("outermost").alias("rule")).unionByName(layout.select_roots(e, False).select("doc", "index", F.lit("innermost").alias("rule")))


@query
def layout_documents(spark, d):
    """Sections of the PDF build laid out as lines again, then parsed back with their outline."""
    s = table(spark, d, "doc_section").filter("doc_id LIKE 'pdf:%' AND page IS NOT NULL").dropDuplicates(["section_id"])
    s = s.withColumn("at", F.col("section_ord").cast("bigint") * 10_000_000 + F.col("section_id")).withColumn("blocks", F.filter(F.coalesce("blocks", F.array().cast("array<struct<kind:string,text:string,lang:string>>")), lambda b: F.coalesce(b["text"], F.lit("")) != ""))
    head = s.select(F.col("doc_id").alias("doc"), "page", (F.col("at") * 1e-3).alias("y0"), F.lit(0.0).alias("x0"), F.col("title").alias("text"), F.lit(False).alias("mono"), F.lit(True).alias("heading"), F.lit(False).alias("starts_mono"))
    b = s.select("doc_id", "page", "at", F.posexplode("blocks").alias("i", "b")).select("doc_id", "page", "at", "i", (F.col("b.kind") == "code").alias("mono"), F.posexplode(F.split("b.text", "\n")).alias("j", "text"))
    body = b.select(F.col("doc_id").alias("doc"), "page", (F.col("at") * 1e-3 + (F.col("i") + 1) * 1e-5 + (F.col("j") + 1) * 1e-8).alias("y0"), F.lit(0.0).alias("x0"), "text", "mono", F.lit(False).alias("heading"), F.col("mono").alias("starts_mono"))
    docs = layout.extract_documents(head.unionByName(body), _outline(spark, d), 5000)
    return docs.select("doc_id", "title", F.size("sections").cast("bigint").alias("n_sections"), "page_start", "page_end")


# Retrieval


def _vectors(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"), "label")


def _vector_queries(spark, d):
    return _vectors(spark, d).filter("item_id % 20 = 0").select(F.col("item_id").alias("query_id"), "vector", "label")


def _dense(spark, d, k=50):
    return retrieval.dense_top_k(_vector_queries(spark, d), _vectors(spark, d), k)


def _half(spark, d, k=50):
    half = lambda v, i: v.select(i, F.slice("vector", 1, 32).alias("vector"))
    return retrieval.dense_top_k(half(_vector_queries(spark, d), "query_id"), half(_vectors(spark, d), "item_id"), k)


def _shown(r):
    return r.select("query_id", "item_id", F.col("rank").cast("bigint").alias("rank"), F.round("score", 6).alias("score"))


@query
def dense_topk(spark, d):
    return _shown(_dense(spark, d, 10))


@query
def dense_topk_filtered(spark, d):
    return _shown(retrieval.dense_top_k(_vector_queries(spark, d), _vectors(spark, d), 10, F.col("label") < 5))


@query
def bm25_index_stats(spark, d):
    return retrieval.InvertedIndex(table(spark, d, "documents"), "doc_id", "text").terms.select("term", "df")


@query
def bm25_topk(spark, d):
    return _shown(retrieval.InvertedIndex(table(spark, d, "documents"), "doc_id", "text").search(table(spark, d, "gold_query"), 10))


@query
def rrf_fusion(spark, d):
    both = _dense(spark, d).unionByName(_half(spark, d))
    return _shown(retrieval.reciprocal_rank_fusion(both, top=20))


@query
def weighted_fusion(spark, d):
    dense, half = materialize(_dense(spark, d), "dense"), materialize(_half(spark, d), "half")
    out = [_shown(retrieval.weighted_fusion(dense, half, a, 20)).withColumn("alpha", F.lit(a)) for a in (0.3, 0.5, 0.7)]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query
def rerank_reorder(spark, d):
    dense = _dense(spark, d)
    new = dense.select("query_id", "item_id", ((F.col("item_id") * 7919 + F.col("query_id")) % 1009).cast("double").alias("new_score"))
    return _shown(retrieval.reorder(dense, new, 20))


@query
def rerank_overlap(spark, d):
    docs, gold = table(spark, d, "documents"), table(spark, d, "gold_query")
    first = retrieval.InvertedIndex(docs, "doc_id", "text").search(gold, 20)
    return _shown(retrieval.rerank(first, gold.select("query_id", "question"), docs.select(F.col("doc_id").alias("item_id"), "text"), 20))


def _grid(spark, d):
    dense, half = materialize(_dense(spark, d), "dense"), materialize(_half(spark, d), "half")
    cols = ["query_id", "item_id", "rank", "score"]
    new = dense.select("query_id", "item_id", ((F.col("item_id") * 7919 + F.col("query_id")) % 1009).cast("double").alias("new_score"))
    runs = {"dense": dense, "half": half, "rrf": retrieval.reciprocal_rank_fusion(dense.unionByName(half), top=50)}
    runs |= {f"weighted_{a}": retrieval.weighted_fusion(dense, half, a, 50) for a in (0.3, 0.5, 0.7)}
    runs |= {f"dense_rerank_{n}": retrieval.reorder(dense, new, n) for n in (20, 50)}
    out = None
    for name, r in runs.items():
        r = r.select(*cols, F.lit(name).alias("config"))
        out = r if out is None else out.unionByName(r)
    return out


def _ranks(spark, d, rankings):
    q = _vector_queries(spark, d).select("query_id", F.col("label").cast("string").alias("topic"), F.col("label").alias("ql"))
    items = _vectors(spark, d).select("item_id", "label")
    hits = rankings.join(q, "query_id").join(items, "item_id").filter((F.col("ql") == F.col("label")) & (F.col("query_id") != F.col("item_id"))).select("query_id", "item_id").distinct()
    return metrics.first_ranks(rankings, hits, q.select("query_id", "topic"))


def _rounded(m, *by):
    return m.select(*by, *[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in m.dtypes if c not in by])


@query
def recall_mrr_ndcg(spark, d):
    r = materialize(_dense(spark, d).select("query_id", "item_id", "rank", "score", F.lit("dense").alias("config")), "dense")
    return _rounded(metrics.measures(_ranks(spark, d, r)), "config")


@query
def recall_by_topic(spark, d):
    r = materialize(_dense(spark, d).select("query_id", "item_id", "rank", "score", F.lit("dense").alias("config")), "dense")
    t = metrics.by_topic(_ranks(spark, d, r), 2)
    return t.select("config", "topic", F.col("overall").cast("int").alias("overall"), F.round("recall", 6).alias("recall"), "questions")


@query
def experiment_grid(spark, d):
    return _rounded(metrics.measures(_ranks(spark, d, materialize(_grid(spark, d), "grid"))), "config")


@query
def rank_buckets(spark, d):
    return metrics.rank_buckets(_ranks(spark, d, materialize(_grid(spark, d), "grid")))


@query
def gold_metrics(spark, d):
    """Runs of the store against the gold expectations: any-of relevance by anchor or breadcrumb. Items stand at their best place over all runs, by
    their latest scores, whatever rank was recorded."""
    latest = Window.partitionBy("run_id", "config", "query_id", "item_id").orderBy(F.col("scored_at").desc_nulls_last(), F.col("score").desc_nulls_last(), F.col("result_id").desc())
    s = table(spark, d, "search_result").filter("item_id IS NOT NULL").withColumn("_i", F.row_number().over(latest)).filter("_i = 1")
    better = F.when(F.col("config") == "dense_l2", -F.col("score")).otherwise(F.col("score"))
    place = F.row_number().over(Window.partitionBy("run_id", "config", "query_id").orderBy(better.desc_nulls_last(), "item_id"))
    s = s.withColumn("rank", place).groupBy("config", "query_id", "item_id").agg(F.min("rank").alias("rank"))
    c = table(spark, d, "chunk").groupBy(F.col("chunk_id").alias("item_id")).agg(F.max("section_anchor").alias("anchor"), F.max(F.array_join("section_path", " > ")).alias("crumb"))
    e = metrics.expectations(table(spark, d, "gold_query"))
    hits = s.select("query_id", "item_id").distinct().join(c, "item_id").join(e, "query_id").filter(metrics.is_relevant(F.col("anchor"), F.col("crumb"), F.col("anchors"), F.col("paths"))).select("query_id", "item_id")
    w = Window.partitionBy("config", "query_id").orderBy("rank", "item_id")
    placed = s.withColumn("rank", F.row_number().over(w))
    return _rounded(metrics.measures(metrics.first_ranks(placed, hits, e.select("query_id", "topic"))), "config")


# Gold set and samples


@query
def goldset_verify(spark, d):
    return goldset.verify(table(spark, d, "gold_query"), table(spark, d, "chunk"))


@query
def stratified_stride_sample(spark, d):
    t = table(spark, d, "documents").filter("lang IS NOT NULL AND site IS NOT NULL").select("lang", "site", "doc_id", "title")
    return goldset.stride_sample(t, "lang", "site", "doc_id", 5, prefer="title").select("lang", "site", "doc_id")


@query
def even_stride_sample(spark, d):
    return goldset.even_stride(table(spark, d, "documents").select("doc_id"), "doc_id", 100)


# Store


@query
def vector_cache_plan(spark, d):
    c = table(spark, d, "chunk")
    plan = store.cache_plan(c, c.filter("source_format = 'html'"))
    return plan.groupBy("hit").agg(F.count(F.lit(1)).alias("n"))


@query
def upsert_latest(spark, d):
    c = table(spark, d, "chunk").select("chunk_id", "source_format", "loaded_at")
    return store.upsert_latest(c.filter("source_format = 'html'"), c, ["chunk_id"], "loaded_at").select("chunk_id", "loaded_at")


@query
def embed_documents(spark, d):
    t = table(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", "text", identity.content_hash(F.col("text")).alias("content_hash"))
    cache = spark.createDataFrame([], "content_hash string, vector array<float>")
    out, _ = store.embed_with_cache(t, cache, store.random_hyperplane_embedding(16))
    return out.select("doc_id", F.size("vector").cast("bigint").alias("dim"), F.round(retrieval.norm(F.col("vector")), 4).alias("length"), F.round(F.col("vector")[0].cast("double"), 4).alias("first"), F.round(F.col("vector")[15].cast("double"), 4).alias("last"))


# Consistency


_PLACE = ["doc_id", "ordinal"]


def _joined(spark, d):
    """(join of the groups of both builds, keyed rows and groups of either)."""
    c = table(spark, d, "chunk").filter("text IS NOT NULL").groupBy("chunk_id").agg(*[F.first(x).alias(x) for x in ("source_format", "doc_id", "ordinal", "text")], F.max("section_path").alias("path"), F.max("section_anchor").alias("anchor"))
    keyed = materialize(consistency.keyed(c).drop("path", "anchor"), "keyed")
    rows = [keyed.filter(F.col("source_format") == f) for f in ("html", "pdf")]
    groups = [materialize(consistency.grouped(r, "chunk_id", _PLACE), "groups") for r in rows]
    return materialize(consistency.fallback_join(*groups), "joined"), rows, groups


def _pairs(spark, d):
    joined, rows, _ = _joined(spark, d)
    return consistency.with_texts(joined, *rows, "chunk_id", _PLACE)


@query
def format_join_fallback(spark, d):
    return _joined(spark, d)[0].select("key", "item", F.col("n").cast("bigint").alias("n"), "right_key", "right_item")


@query
def jaccard_pairs(spark, d):
    return consistency.compare(_pairs(spark, d), chars=False).select("key", F.round("jaccard", 6).alias("jaccard"), F.round("length_ratio", 6).alias("length_ratio"))


@query
def char_similarity(spark, d):
    return consistency.compare(_pairs(spark, d)).select("key", "right_key", F.round("char_ratio", 6).alias("char_ratio"))


@query
def compare_summary(spark, d):
    p = consistency.compare(_pairs(spark, d), chars=False)
    return p.groupBy(consistency.ratio_bucket(F.col("jaccard")).alias("bucket")).agg(F.count(F.lit(1)).alias("pairs"), F.round(F.median("length_ratio"), 6).alias("median_length_ratio"))


@query
def compare_worst(spark, d):
    """The eight pairs that agree least: a report."""
    p = consistency.compare(_pairs(spark, d), chars=False)
    return consistency.worst(p, "jaccard").select("key", F.round("jaccard", 6).alias("jaccard"))


@query
def compare_coverage(spark, d):
    joined, _, groups = _joined(spark, d)
    c = consistency.coverage(joined, *groups)
    return c.select("left_keys", "right_keys", "matched", F.round("left_coverage", 6).alias("left_coverage"), F.round("right_coverage", 6).alias("right_coverage"))


@query
def pair_vector_cosine(spark, d):
    """Cosines of matched single passages, by hashed vectors of their texts."""
    joined, rows, _ = _joined(spark, d)
    texts = rows[0].select("chunk_id", "text").unionByName(rows[1].select("chunk_id", "text"))
    vectors = texts.select(F.col("chunk_id").alias("item"), store.random_hyperplane_embedding(16)(F.col("text")).alias("vector"))
    return consistency.vector_cosines(joined, vectors).select("key", "right_key", F.round("cosine", 4).alias("cosine"))


@query
def unmatched_keys(spark, d):
    return consistency.unmatched_by_kind(_joined(spark, d)[0])


# Streaming


@query
def stream_event_windows(spark, d):
    """The events table read as a stream; the windowed counts of the last trigger."""
    path = f"{d}/events.parquet"
    schema = spark.read.parquet(path).schema
    out = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    stream = spark.readStream.schema(schema).parquet(path if _is_dir(spark, path) else f"{d}/events*.parquet")
    counts = stream.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("day"), "event_type", "n")
    q = counts.writeStream.outputMode("complete").foreachBatch(lambda b, _: b.write.mode("overwrite").parquet(out)).option("checkpointLocation", f"{out}-state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out).select(F.date_format("day", "yyyy-MM-dd").alias("day"), "event_type", "n")


def _is_dir(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()
