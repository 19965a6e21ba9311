import importlib
import math
import os
import sys

import pytest

import __spark_entry__ as entry_module

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")

SAMPLE = (
    "content_hash_dedup", "stable_chunk_id", "title_keys", "comparison_text", "lexical_tokenize", "ancestor_breadcrumb", "chunk_greedy_pack", "chunk_statistics", "paragraph_islands", "code_runs",
    "outline_end_page", "root_selection", "dense_topk", "dense_topk_filtered", "bm25_topk", "rrf_fusion", "weighted_fusion", "rerank_reorder", "experiment_grid", "recall_by_topic", "gold_metrics",
    "goldset_verify", "stratified_stride_sample", "even_stride_sample", "upsert_latest", "vector_cache_plan", "format_join_fallback", "compare_summary", "stream_event_windows",
    "normalize_code", "section_numbers", "html_sections", "html_blocks", "nav_links", "crawl_chain", "jsonl_roundtrip", "store_status", "ask_store", "text_experiment", "layout_documents", "outline_matches", "pair_vector_cosine",
)


def test_entry(spark):
    assert entry_module.entry(spark).count() == 1


def test_sql_only_for_known_queries():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    return f"{float(v):.5f}" if isinstance(v, (int, float)) or type(v).__name__ == "Decimal" else str(v)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    got = entry_module.queries()[name](spark, DATA)
    cols = sorted(got.columns)
    want = con.execute(entry_module.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert sorted([plain(r[c]) for c in cols] for r in got.collect()) == sorted([plain(r[i]) for i in at] for r in want.fetchall())


def test_rest_works_without_the_training_operators(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("passageworks.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "passageworks.llm", None)
    again = importlib.reload(entry_module)
    assert "dense_topk" in again.queries() and not any(q.startswith("p1_") for q in again.queries())
    monkeypatch.undo()
    importlib.reload(entry_module)
