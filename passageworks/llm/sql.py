"""DuckDB statements equivalent to the training-data queries, where SQL can express them over whole tables.

None for p1 (alignment), p3 (propagation), p4_pieces (bisection), p6 (normalisation), p7 (tokenizer) and p8 (endings): those are
tested against brute force in tests/llm.
"""

from __future__ import annotations

_WORDS = """d AS (SELECT DISTINCT chunk_id, source_format AS f, list_sort(list_distinct(regexp_extract_all(lower(substring(text, instr(text, chr(10) || chr(10)) + 2)), '[a-z0-9_]+'))) AS w FROM chunk WHERE instr(text, chr(10) || chr(10)) > 0),
k AS (SELECT *, len(w) AS n, row_number() OVER () AS r FROM d WHERE len(w) > 0),
t AS (SELECT r, f, n, unnest(w) AS t FROM k), df AS (SELECT f, t, count(*) AS df FROM t GROUP BY ALL),
p AS (SELECT r, f, n, t FROM t JOIN df USING (f, t) QUALIFY row_number() OVER (PARTITION BY r ORDER BY df, t) <= n - ceil(0.8 * n) + 1),
c AS (SELECT DISTINCT a.r AS ra, b.r AS rb FROM p a JOIN p b ON a.f = b.f AND a.t = b.t AND a.r < b.r AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
o AS (SELECT x.chunk_id AS x, y.chunk_id AS y, len(list_intersect(x.w, y.w)) AS i, x.n + y.n AS s FROM c JOIN k x ON x.r = c.ra JOIN k y ON y.r = c.rb)"""

_RANKED = """l AS (SELECT run_id, query_id, config, item_id, score FROM search_result WHERE item_id IS NOT NULL AND config IN ('dense', 'bm25', 'rerank_small', 'rerank_large', 'dense_l2')
  QUALIFY row_number() OVER (PARTITION BY run_id, query_id, config, item_id ORDER BY scored_at DESC NULLS LAST, score DESC NULLS LAST, result_id DESC) = 1),
u AS (SELECT DISTINCT run_id, query_id, item_id FROM l), g AS (SELECT u.*, c.config, CASE WHEN c.config = 'dense_l2' THEN -l.score ELSE l.score END AS s FROM u CROSS JOIN (VALUES ('dense'), ('bm25'), ('rerank_small'), ('rerank_large'), ('dense_l2')) c(config)
  LEFT JOIN l ON l.run_id = u.run_id AND l.query_id = u.query_id AND l.item_id = u.item_id AND l.config = c.config),
k AS (SELECT *, rank() OVER (PARTITION BY run_id, query_id, config ORDER BY s DESC NULLS LAST) + (count(*) OVER (PARTITION BY run_id, query_id, config, s) - 1) / 2 AS r FROM g)"""

SQL: dict[str, str] = {
    "p2_found": f"WITH {_WORDS} SELECT DISTINCT least(x, y) AS chunk_id_a, greatest(x, y) AS chunk_id_b FROM o WHERE x <> y AND 5 * i >= 4 * (s - i)",
    "p4_found": """SELECT 'chunk' AS item_type, chunk_id AS item_key FROM chunk WHERE chunk_id IS NOT NULL AND ceil(length(text) / 4) > 512
UNION SELECT 'section', section_id::VARCHAR FROM doc_section WHERE section_id IS NOT NULL AND list_sum(list_transform(blocks, lambda b: ceil(length(coalesce(b.text, '')) / 4))) > 512""",
    "p5_found": f"WITH {_RANKED}, b AS (SELECT x.run_id, x.query_id, x.item_id, y.item_id AS other, count(*) FILTER (WHERE x.r < y.r) AS wins FROM k x JOIN k y ON x.run_id = y.run_id AND x.query_id = y.query_id AND x.config = y.config AND x.item_id <> y.item_id GROUP BY ALL) SELECT run_id, query_id, item_id FROM b GROUP BY ALL HAVING min(wins) >= 3",
    "p5_ranking": f"WITH {_RANKED}, m AS (SELECT run_id, query_id, item_id, list_sort(list(r))[3]::DOUBLE AS median_rank, round(avg(r), 6) AS mean_rank FROM k GROUP BY ALL) SELECT *, row_number() OVER (PARTITION BY run_id, query_id ORDER BY median_rank, mean_rank, item_id) AS position FROM m",
}
