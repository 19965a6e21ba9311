"""Registered queries of the pipeline's stages: crawl, pages, stage files, stores and reports. Their SQL is in stages_sql.py."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..engine import Engine
from ..functions import identity, text
from ..operators import crawl, goldset, html, layout, metrics, retrieval, store
from ..session import materialize, shared_dir, table
from ..sources import records
from . import queries as base
from .queries import query
from .stages_sql import SQL

base.SQL.update(SQL)

PREFIX = "http"


def _folder(spark) -> str:
    return f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"


# Crawl


def _crawled(spark, d):
    """Pages with links to the next page of their site, in crawl order, and to their parent."""
    m = crawl.latest_fetch(table(spark, d, "page_manifest")).select("slug", "url", "title", "ordinal", "parent_slug", "sha256")
    host = F.regexp_extract("url", "^[a-z]+://([^/:]*)", 1)
    after = F.lead("url").over(Window.partitionBy(host).orderBy("ordinal", "slug"))
    link = lambda key, to: F.coalesce(F.concat(F.lit(f'<a accesskey="{key}" title="x" href="'), to, F.lit('">go</a>')), F.lit(""))
    return m.withColumn("html", F.concat(F.lit("<html><head><title>"), F.col("title"), F.lit("</title></head><body>"), link("n", after), link("u", F.concat(F.lit("./x/../"), F.col("parent_slug"))), F.lit("<h1>"), F.col("title"), F.lit("</h1></body></html>")))


@query
def page_hashes(spark, d):
    return _crawled(spark, d).select("slug", identity.page_hash(F.col("html")).alias("sha256"))


@query
def nav_links(spark, d):
    p = _crawled(spark, d)
    return crawl.next_links(p, PREFIX).join(crawl.nav_links(p, PREFIX, "u", "up_slug"), "slug")


@query
def crawl_chain(spark, d):
    """The pages reached over next links from the first page of all."""
    links = materialize(crawl.next_links(_crawled(spark, d), PREFIX), "nav")
    seed = links.agg(F.min("slug")).first()[0]
    return crawl.crawl_order(links, [seed]).select("slug", F.col("ordinal").cast("bigint").alias("ordinal"))


@query
def html_titles(spark, d):
    return _crawled(spark, d).select("slug", html.html_title(F.col("html")).alias("title"))


@query
def html_structure(spark, d):
    return html.structure(_crawled(spark, d)).filter("kind = 'tag'").select("name", "n")


# Pages


def _rich_pages(spark, d):
    """Sections written out as pages of the manual's markup: paragraphs, code, synopses, notes and tables."""
    s = table(spark, d, "doc_section").dropDuplicates(["section_id"]).filter("blocks IS NOT NULL")
    esc = lambda c: F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    cells = lambda line: F.concat(F.lit("<tr><td>"), F.array_join(F.transform(F.slice(F.split(line, "[|]"), F.lit(2), F.greatest(F.size(F.split(line, "[|]")) - 2, F.lit(1))), esc), "</td><td>"), F.lit("</td></tr>"))
    lines = lambda t: F.filter(F.split(F.coalesce(t, F.lit("")), "\n"), lambda x: F.contains(x, F.lit("|")))
    body = lambda b: F.when(b["kind"] == "code", F.concat(F.lit('<pre class="programlisting">'), esc(b["text"]), F.lit("</pre>"))).when(b["kind"] == "table", F.concat(F.lit('<div class="informaltable"><table>'), F.array_join(F.transform(lines(b["text"]), cells), ""), F.lit("</table></div>"))).when(b["kind"] == "admonition", F.concat(F.lit('<div class="tip"><h3>Tip</h3><p>'), esc(b["text"]), F.lit("</p></div>"))).otherwise(F.concat(F.lit("<p>"), esc(b["text"])))
    one = F.concat(F.lit('<div class="sect1"><div class="titlepage"><h2>'), esc(F.col("title")), F.lit("</h2></div>"), F.array_join(F.transform("blocks", body), ""), F.lit("</div>"))
    return s.select(F.col("section_id").cast("string").alias("slug"), F.lit(None).cast("string").alias("url"), "title", F.lit(0).alias("ordinal"), F.concat(F.lit('<html><body><div class="navheader">skip</div><div id="docContent">'), one, F.lit("</div></body></html>")).alias("html"), F.array(F.lit("Manual")).alias("ancestors"))


@query
def html_blocks(spark, d):
    b = html.extract_pages(_rich_pages(spark, d)).select(F.col("doc_id").cast("bigint").alias("section_id"), F.posexplode(F.col("sections")[0]["blocks"]).alias("ord", "b"))
    return b.select("section_id", F.col("ord").cast("bigint").alias("ord"), "b.kind", "b.text")


# Text


@query
def fenced_code(spark, d):
    b = table(spark, d, "doc_section").select("section_id", F.posexplode("blocks").alias("ord", "b")).filter("b.kind = 'code'")
    return b.select("section_id", F.col("ord").cast("bigint").alias("ord"), text.fence_code(F.col("b.text"), F.col("b.lang")).alias("code")).distinct()


@query
def collapsed_lines(spark, d):
    return table(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", text.collapse_blank_lines(F.replace("text", F.lit(". "), F.lit(".\n\n\n\n"))).alias("text"))


@query
def nav_titles(spark, d):
    return table(spark, d, "page_manifest").select("title").distinct().select("title", text.clean_nav_title(F.concat(F.lit("Site: Documentation: 18: "), F.col("title"))).alias("bare"))


# Stage files and stores


@query
def jsonl_roundtrip(spark, d):
    c = table(spark, d, "chunk")
    path = _folder(spark)
    records.write_jsonl(c.select(*[x.strip().split()[0] for x in records.CHUNK.split(", ")]), path)
    return records.read_chunks(spark, path).select("chunk_id", "text", F.array_join("section_path", " > ").alias("path"), "token_count", "source_page", "has_code").distinct()


@query
def manifest_pages(spark, d):
    """Cached pages of the manifest: those that were written, read back as files."""
    p = _crawled(spark, d).select("slug", "html")
    path = _folder(spark)
    p.select(F.concat_ws("\t", "slug", F.regexp_replace("html", r"\s+", " ")).alias("value")).write.text(path)
    files = spark.read.text(path).select(F.split("value", "\t")[0].alias("slug"), F.split("value", "\t")[1].alias("html"))
    m = crawl.latest_fetch(table(spark, d, "page_manifest")).filter("parent_slug IS NOT NULL").select("slug")
    return records.pages_of_manifest(m, files).select("slug", F.length("html").cast("bigint").alias("chars"))


@query
def vector_cache_roundtrip(spark, d):
    """Texts of one build are embedded and cached; those of both then need new vectors only for hashes that the cache lacks."""
    c = table(spark, d, "chunk").filter("text IS NOT NULL").select("chunk_id", "source_format", "text").distinct().withColumn("content_hash", identity.content_hash(F.col("text")))
    path, embed = _folder(spark), store.random_hyperplane_embedding(16)
    none = records.read_vector_cache(spark, path)
    store.write_new_vectors(store.embed_with_cache(c.filter("source_format = 'html'"), none, embed)[1], path)
    out, new = store.embed_with_cache(c, records.read_vector_cache(spark, path), embed)
    n = out.agg(F.count(F.lit(1)).alias("texts"), F.count("vector").alias("with_vector"))
    return n.crossJoin(records.read_vector_cache(spark, path).agg(F.count(F.lit(1)).alias("cached"))).crossJoin(new.agg(F.count(F.lit(1)).alias("embedded")))  # one row each


def _engine(spark, d) -> Engine:
    """An engine whose html chunks are the chunk table's."""
    e = Engine(spark, _folder(spark), embed=store.random_hyperplane_embedding(16))
    c = table(spark, d, "chunk").filter("source_format = 'html' AND text IS NOT NULL").dropDuplicates(["chunk_id"]).withColumn("content_hash", identity.content_hash(F.col("text")))
    c.select(*[x.strip().split()[0] for x in records.CHUNK.split(", ")]).write.parquet(e.corpus.stage("chunks", "html"))
    e.embed_and_store("html")
    return e


@query
def store_status(spark, d):
    e = _engine(spark, d)
    e.reset("pdf")
    return e.status().select("stage", "source_format", "rows")


@query
def store_upsert(spark, d):
    """Vectors stored again replace those of the same chunk; others stay."""
    e = _engine(spark, d)
    again = spark.read.parquet(e.corpus.stage("vectors", "html")).filter("chunk_id < '8'").select(F.col("chunk_id"), F.lit("again").alias("content_hash"), "vector")
    return e.upsert(again.unionByName(again.limit(0)), "html").groupBy((F.col("content_hash") == "again").alias("again")).agg(F.count(F.lit(1)).alias("n"))


@query
def ask_store(spark, d):
    """The five nearest passages of each question, over the whole store."""
    a = _engine(spark, d).ask(table(spark, d, "gold_query").select("query_id", "question"), "html", 5, full=True)
    return a.select("query_id", F.col("rank").cast("bigint").alias("rank"), F.round("score", 4).alias("score"))


# Reports


def _text_rankings(spark, d, depth: int = 100):
    """Dense and lexical rankings of the questions over the documents, to the depth that fusion draws from."""
    embed = store.random_hyperplane_embedding(16)
    docs, gold = table(spark, d, "documents"), table(spark, d, "gold_query")
    vectors = docs.select(F.col("doc_id").alias("item_id"), embed(F.col("text")).alias("vector"))
    dense = retrieval.dense_top_k(gold.select("query_id", embed(F.col("question")).alias("vector")), vectors, depth)
    sparse = retrieval.InvertedIndex(docs, "doc_id", "text").search(gold, depth)
    return materialize(dense, "dense"), materialize(sparse, "sparse"), docs.select(F.col("doc_id").alias("item_id"), "text"), gold


@query
def text_experiment(spark, d):
    """Every configuration of the experiment over one pass of retrieval; a document is relevant that was collected under the question's topic word."""
    dense, sparse, docs, gold = _text_rankings(spark, d)
    runs = retrieval.experiment_runs(dense, sparse, gold.select("query_id", "question"), docs)
    runs = materialize(runs, "runs")
    topic = gold.select("query_id", F.lower("topic").alias("topic")).filter("topic IS NOT NULL")
    hits = runs.select("query_id", "item_id").distinct().join(docs, "item_id").join(topic, "query_id").filter(F.contains(F.lower(F.coalesce("text", F.lit(""))), F.col("topic"))).select("query_id", "item_id")
    ranks = metrics.first_ranks(runs, hits, gold.select("query_id", "topic"))
    m = metrics.measures(ranks).join(metrics.pool_recall(ranks), "config")
    return base._rounded(m, "config")


@query
def measures_side_by_side(spark, d):
    r = base._ranks(spark, d, materialize(base._grid(spark, d), "grid"))
    return metrics.side_by_side(metrics.measures(r).withColumn("recall_5", F.round("recall_5", 6)), ["dense", "half", "rrf"])


@query
def gold_misses(spark, d):
    """Questions without a relevant passage, with their labels."""
    dense = materialize(base._dense(spark, d).select("query_id", "item_id", "rank", "score", F.lit("dense").alias("config")), "dense")
    return metrics.misses(base._ranks(spark, d, dense), 1).select("config", "query_id", "topic")


@query
def gold_labels(spark, d):
    return metrics.labels(table(spark, d, "gold_query")).select("query_id", "label")


@query
def gold_repeats(spark, d):
    return goldset.repeated_anchors(table(spark, d, "gold_query"))


@query
def gold_topics(spark, d):
    return table(spark, d, "gold_query").groupBy("topic").agg(F.count(F.lit(1)).alias("questions"))


@query
def vector_agreement(spark, d):
    """All vectors against themselves rounded to two places, as two devices would give them."""
    v = base._vectors(spark, d)
    low = v.select("item_id", F.transform("vector", lambda x: F.round(x.cast("double"), 2)).alias("vector"))
    a = metrics.agreement(v, low)
    return a.select(F.round("least_cosine", 5).alias("least_cosine"), F.round("greatest_difference", 5).alias("greatest_difference"), "items")


# Layout


def _spans(spark, d):
    """Lines of the PDF build's sections as font spans: titles bold and large, code in a mono font, parameter heads with a mono name."""
    s = table(spark, d, "doc_section").filter("doc_id LIKE 'pdf:%' AND page IS NOT NULL").dropDuplicates(["section_id"])
    b = s.select("doc_id", "page", "section_id", F.posexplode(F.concat(F.array(F.struct(F.lit("title").alias("kind"), F.col("title").alias("text"), F.lit(None).cast("string").alias("lang"))), F.coalesce("blocks", F.array().cast("array<struct<kind:string,text:string,lang:string>>")))).alias("i", "b"))
    b = b.filter("trim(coalesce(b.text, '')) <> ''").select("doc_id", "page", (F.col("section_id") * 1000 + F.col("i")).alias("line"), "b.kind", F.split("b.text", "\n")[0].alias("text"))
    font = F.when(F.col("kind") == "title", "Helvetica-Bold").when(F.col("kind") == "code", "Courier").otherwise("Times")
    size = F.when(F.col("kind") == "title", 14.0).otherwise(10.0)
    return b.select(F.col("doc_id").alias("doc"), "page", "line", F.explode(F.array(F.struct(F.lit(0).alias("span"), F.left("text", F.lit(3)).alias("text")), F.struct(F.lit(1).alias("span"), F.substring("text", 4, 1_000_000).alias("text")))).alias("x"), font.alias("font"), size.alias("size")).select(
        "doc", "page", "line", "x.span", F.col("line").cast("double").alias("y0"), (F.col("line") + 1).cast("double").alias("y1"), F.col("x.span").cast("double").alias("x0"), "x.text", "font", "size")


@query
def layout_line_flags(spark, d):
    return layout.lines_of_spans(_spans(spark, d)).groupBy("doc", "mono", "heading", "starts_mono").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("text")).alias("chars"))


@query
def layout_fonts(spark, d):
    return layout.profile_fonts(_spans(spark, d)).select("font", "size", "chars")


@query
def layout_heading_parts(spark, d):
    """Lines per part of a document that its heading lines split off."""
    parts = layout.split_headings(layout.lines_of_spans(_spans(spark, d)), "doc")
    return parts.groupBy("doc", F.col("part").cast("bigint").alias("part")).agg(F.count(F.lit(1)).alias("lines"))


@query
def outline_matches(spark, d):
    """Outline entries of the PDF build whose titles the html build has, and titles that no entry has."""
    o = layout.outline_ends(base._outline(spark, d), 5000)
    s = table(spark, d, "doc_section").filter("doc_id NOT LIKE 'pdf:%'").dropDuplicates(["section_id"])
    wanted = s.filter("title <> ''").select(text.title_key(F.col("title")).alias("key")).filter("key <> ''").distinct().withColumn("context", F.lit(None).cast("string"))
    found = layout.matched_entries(o, wanted).select(F.lit("matched").alias("state"), F.concat_ws("|", "doc", F.col("index").cast("string")).alias("what"))
    return found.unionByName(layout.unmatched_titles(wanted, base._outline(spark, d)).select(F.lit("unmatched").alias("state"), F.col("key").alias("what")))
