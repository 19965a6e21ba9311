import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from passageworks.engine import Engine
from passageworks.functions import text
from passageworks.operators import layout, metrics, retrieval, store
from passageworks.sources import fetch, records


def test_fetcher_pauses_and_tries_again():
    now, slept, failed = [0.0], [], [2]

    def sleep(s):
        slept.append(s)
        now[0] += s

    def get(url):
        if failed[0]:
            failed[0] -= 1
            raise OSError("down")
        return b"x"

    f = fetch.Fetcher(get, ("/private/",), 1.0, 3, lambda: now[0], sleep)
    assert f.get("http://a.test/1") == b"x" and slept == [1.0, 2.0]
    f.get("http://a.test/2")
    assert slept == [1.0, 2.0, 1.0]
    with pytest.raises(ValueError):
        f.get("http://a.test/private/1")
    failed[0] = 9
    with pytest.raises(OSError):
        f.get("http://a.test/3")


def test_collect_follows_next_links(tmp_path):
    pages = {
        "http://a.test/d/a.html": '<title>A &amp; B</title><a accesskey="n" href="b.html">', "http://a.test/d/b.html": '<a href="../d/c.html#x" accesskey="n"><a accesskey="u" href="a.html">',
        "http://a.test/d/c.html": '<a accesskey="n" href="a.html">', "http://a.test/d/z.html": '<a accesskey="n" href="http://else.test/">',
    }
    f = fetch.Fetcher(lambda u: pages[u].encode(), pause=0)
    rows = fetch.collect(f, ["http://a.test/d/a.html", "http://a.test/d/z.html"], "http://a.test/d/", str(tmp_path))
    assert [(r["slug"], r["ordinal"], r["parent_slug"]) for r in rows] == [("a.html", 0, None), ("b.html", 1, "a.html"), ("c.html", 2, None), ("z.html", 3, None)]
    assert rows[0]["title"] == "A & B"
    pages.clear()  # all cached now
    assert len(fetch.collect(f, ["http://a.test/d/a.html"], "http://a.test/d/", str(tmp_path), limit=2)) == 2


def test_providers():
    both = ["CUDAExecutionProvider", "CPUExecutionProvider"]
    assert store.providers("auto", both) == both and store.providers("cpu", both) == both[1:] and store.providers("auto", both[1:]) == both[1:]
    with pytest.raises(RuntimeError):
        store.providers("cuda", both[1:])
    with pytest.raises(ValueError):
        store.providers("tpu", both)


def test_models_are_loaded_once_a_worker(spark):
    df = spark.createDataFrame([(i, "x" * i) for i in range(9)] + [(9, None)], "id int, t string").coalesce(1)
    embed = store.model_embedding(lambda: lambda texts: [[float(len(t)), 1.0] for t in texts], batch=4)
    got = {r["id"]: list(r["v"]) for r in df.select("id", embed(F.col("t")).alias("v")).collect()}
    assert got[3] == [3.0, 1.0] and got[9] == [0.0, 1.0]
    score = retrieval.cross_encoder(lambda: lambda pairs: [float(len(a) - len(b)) for a, b in pairs], batch=3)
    assert {r["s"] for r in df.filter("id < 3").select(score(F.lit("ab"), F.col("t")).alias("s")).collect()} == {2.0, 1.0, 0.0}


def test_wordpiece_counts(spark, tmp_path):
    (tmp_path / "vocab.txt").write_text("\n".join(["[UNK]", "work", "##ing", "mem", "_", "."]))
    df = spark.createDataFrame([("Working mem.",), ("",), (None,), ("other",)], "t string")
    count = text.wordpiece_count(str(tmp_path / "vocab.txt"))
    assert [r[0] for r in df.select(count(F.col("t"))).collect()] == [4, 0, 0, 1]


def test_reranking_keeps_the_candidate_pool(spark):
    """Whatever is reranked at whatever depth, the pool and its recall are the base's."""
    rng = np.random.default_rng(2)
    rank = lambda seed: spark.createDataFrame([(q, int(i), r, float(100 - r)) for q in range(4) for r, i in enumerate(np.random.default_rng(seed + q).permutation(300)[:100], 1)], "query_id int, item_id int, rank int, score double")
    texts = spark.createDataFrame([(i, f"word{i % 7} word{i % 5}") for i in range(300)], "item_id int, text string")
    questions = spark.createDataFrame([(q, f"word{q} word3") for q in range(4)], "query_id int, question string")
    runs = retrieval.experiment_runs(rank(1), rank(50), questions, texts).cache()
    pool = {}
    for r in runs.collect():
        pool.setdefault(r["config"], {}).setdefault(r["query_id"], set()).add(r["item_id"])
    assert len(pool) == 10 and all(len(s) == 50 for p in pool.values() for s in p.values())
    for base in ("dense", "hybrid_rrf"):
        assert pool[base] == pool[f"{base}_overlap_20"] == pool[f"{base}_overlap_50"]
    hits = spark.createDataFrame([(q, int(i)) for q in range(4) for i in rng.permutation(300)[:3]], "query_id int, item_id int")
    recall = {r["config"]: r["pool_recall"] for r in metrics.pool_recall(metrics.first_ranks(runs, hits, questions.select("query_id", F.lit("t").alias("topic")))).collect()}
    assert recall["dense"] == recall["dense_overlap_20"] == recall["dense_overlap_50"]


def test_paragraphs_of_a_layout_are_rejoined(spark):
    t = [(1, 10.0, "A sen-", False), (1, 20.0, "tence goes on", False), (1, 70.0, "An\u00adother \ufb01ne one", False), (1, 80.0, "  SELECT 1;", True), (1, 90.0, "    FROM t;", True), (2, 10.0, "End pre-", False), (2, 20.0, "SQL", False)]
    lines = spark.createDataFrame([("d", p, y, 0.0, x, m) for p, y, x, m in t], "doc string, page int, y0 double, x0 double, text string, mono boolean")
    got = [(r["kind"], r["text"]) for r in layout.text_blocks(lines).orderBy("block", "paragraph").collect()]
    assert got == [("prose", "A sentence goes on"), ("prose", "Another fine one"), ("code", "```\nSELECT 1;\n  FROM t;\n```"), ("prose", "End pre-SQL")]


def test_dehyphenate(spark):
    cases = {"config-\nuration": "configuration", "pre-\nPostgres": "pre-Postgres", "CRE-\nATE": "CREATE", "a-\nB-\nc": "a-B-\nc", "x-\n1": "x-1", "Ä-\nb": "Äb", "a -\nb": "a -\nb"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert [r[0] for r in df.select(text.dehyphenate(F.col("t"))).collect()] == list(cases.values())


def test_engine_store_and_reports(spark, tmp_path):
    e = Engine(spark, str(tmp_path), embed=store.random_hyperplane_embedding(8))
    doc = {"doc_id": "d", "source_format": "html", "pg_version": "18", "title": "T", "sections": [{"title": f"S{i}", "level": 1, "path": ["T", f"S{i}"], "blocks": [{"kind": "prose", "text": f"Topic number {i} tells of thing{i} and of how it is used every day in the field. " * 4, "lang": None}], "anchor": f"A-{i}", "number": None, "kind": "section", "page": None} for i in range(5)], "source_url": None, "page_start": None}
    (tmp_path / "d.json").write_text(json.dumps(doc))
    for f in ("html", "pdf"):
        records.read_documents(spark, str(tmp_path / "d.json")).drop("source_format").write.mode("overwrite").parquet(e.corpus.stage("documents", f))
        assert e.chunk(f).count() == 5 and e.embed_and_store(f).count() == 5
    assert e.embed_and_store("html").count() == 5  # again: nothing doubles
    gold = spark.createDataFrame([(i, f"thing{i}", f"A-{i}", None, None, None, "t") for i in range(3)], "query_id int, question string, expect_anchor string, expect_path string, expect_anchors array<string>, expect_paths array<string>, topic string")
    m = {r["config"]: r for r in e.experiment(gold).collect()}
    assert len(m) == 10 and m["bm25"]["recall_5"] == 1.0 and m["dense"]["pool_recall"] == 1.0
    path = records.write_report(e.evaluate(gold, "html"), str(tmp_path / "reports"), "evaluate", "html")
    assert spark.read.json(path).count() == 1
    c = e.compare().first()
    assert c["matched"] == 5 and c["left_coverage"] == 1.0 and c["median_ratio"] == 1.0 and c["cosine_pairs"] == 5
    e.reset("html")
    with pytest.raises(ValueError):
        e.ask(gold, "html")
