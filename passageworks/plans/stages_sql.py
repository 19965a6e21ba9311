"""DuckDB statements equivalent to the queries of stages.py."""

from __future__ import annotations

from .sql import _BM25, _FUSED, _GOLD, _LINES, _MANIFEST, _MEASURES, _ONE_DENSE, _OUTLINE, _PROSE, _RETRIEVED, _TOKENS, _bare, _embedded, _folded, _key, _ranks, _title

_SLUG = r"coalesce(nullif(regexp_extract(regexp_replace(regexp_extract(regexp_replace({u}, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', ''), '([^/]*)$', 1), ''), 'index.html')"

_CRAWLED = f"""{_MANIFEST}, cr AS (SELECT *, lead(url) OVER (PARTITION BY regexp_extract(url, '^[a-z]+://([^/:]*)', 1) ORDER BY ordinal, slug) AS nxt FROM m),
pg AS (SELECT *, '<html><head><title>' || title || '</title></head><body>' || coalesce('<a accesskey="n" title="x" href="' || nxt || '">go</a>', '') || coalesce('<a accesskey="u" title="x" href="./x/../' || parent_slug || '">go</a>', '') || '<h1>' || title || '</h1></body></html>' AS html FROM cr),
nv AS (SELECT slug, CASE WHEN nxt IS NOT NULL THEN {_SLUG.format(u='nxt')} END AS next_slug, parent_slug AS up_slug FROM cr)"""

_CODE = """l AS (SELECT *, list_transform(string_split({t}, chr(10)), lambda x: rtrim(x, ' ' || chr(9) || chr(13))) AS l FROM {f}), u AS (SELECT *, list_filter(range(1, len(l) + 1), lambda i: l[i] <> '') AS used FROM l),
mg AS (SELECT *, coalesce(list_min(list_transform(list_filter(l, lambda x: x <> ''), lambda x: length(x) - length(ltrim(x, ' ' || chr(9))))), 0) AS margin FROM u),
cd AS (SELECT *, coalesce(array_to_string(list_transform(l[used[1]:used[-1]], lambda x: substring(x, margin + 1)), chr(10)), '') AS code FROM mg)"""


def _tidy(t: str) -> str:
    return _PROSE.format(t=_LINES.format(t=_folded(t)))


_SPANS = """sp AS (SELECT * FROM doc_section WHERE doc_id LIKE 'pdf:%' AND page IS NOT NULL QUALIFY row_number() OVER (PARTITION BY section_id) = 1),
bl AS (SELECT doc_id, page, section_id, unnest(range(len(b))) AS i, unnest(b) AS b FROM (SELECT *, list_concat([struct_pack(kind := 'title', text := title, lang := NULL::VARCHAR)], coalesce(blocks, [])) AS b FROM sp)),
ln AS (SELECT doc_id AS doc, page, section_id * 1000 + i AS line, b.kind AS kind, string_split(b.text, chr(10))[1] AS text FROM bl WHERE trim(coalesce(b.text, '')) <> '')"""

def _embedded_queries(source: str, key: str, text: str) -> str:
    """The vectors of a second source, as vq."""
    return _embedded(source, key, text).replace("ht", "hq").replace("ax ", "aq ").replace("FROM ax", "FROM aq").replace("vec ", "vq ")


_SCALED = "SELECT query_id, item_id, CASE WHEN max(score) OVER w = min(score) OVER w THEN 1.0 ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END AS s FROM {f} WINDOW w AS (PARTITION BY query_id)"

_EXPERIMENT = f"""{_BM25}, {_embedded('documents', 'doc_id', 'text')}, {_embedded_queries('gold_query', 'query_id', 'question')},
dn AS (SELECT query_id, item_id, score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, item_id) AS rank FROM (SELECT vq.k AS query_id, vec.k AS item_id, list_cosine_similarity(vq.v::DOUBLE[], vec.v::DOUBLE[]) AS score FROM vq, vec) QUALIFY rank <= 100),
hy AS (SELECT query_id, item_id, row_number() OVER (PARTITION BY query_id ORDER BY round(sum(1.0 / (60 + rank)), 12) DESC, item_id) AS rank FROM (SELECT query_id, item_id, rank FROM dn UNION ALL SELECT query_id, item_id, rank FROM bm) GROUP BY query_id, item_id QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(sum(1.0 / (60 + rank)), 12) DESC, item_id) <= 50),
hs AS (SELECT query_id, item_id, rank FROM hy), sd AS ({_SCALED.format(f='dn')}), ss AS ({_SCALED.format(f='bm')}),
wt AS (SELECT a.alpha, coalesce(sd.query_id, ss.query_id) AS query_id, coalesce(sd.item_id, ss.item_id) AS item_id, a.alpha * coalesce(sd.s, 0) + (1 - a.alpha) * coalesce(ss.s, 0) AS score FROM sd FULL JOIN ss ON sd.query_id = ss.query_id AND sd.item_id = ss.item_id CROSS JOIN (VALUES (0.3::DOUBLE), (0.5::DOUBLE), (0.7::DOUBLE)) a(alpha)),
pool AS (SELECT 'dense' AS base, query_id, item_id, rank FROM dn WHERE rank <= 50 UNION ALL SELECT 'hybrid_rrf', query_id, item_id, rank FROM hs),
qq AS (SELECT query_id, {_TOKENS.format(t='question')} AS qw FROM gold_query),
ps AS (SELECT pool.*, len(list_intersect(list_distinct(qq.qw), list_distinct(t.t))) / greatest(len(list_distinct(qq.qw)), 1) AS new_score FROM pool JOIN qq USING (query_id) JOIN t ON t.doc_id = pool.item_id),
grid AS (SELECT 'dense' AS config, query_id, item_id, rank FROM dn WHERE rank <= 50 UNION ALL SELECT 'bm25', query_id, item_id, rank FROM bm WHERE rank <= 50 UNION ALL SELECT 'hybrid_rrf', query_id, item_id, rank FROM hs
  UNION ALL SELECT 'hybrid_' || alpha::VARCHAR, query_id, item_id, row_number() OVER (PARTITION BY alpha, query_id ORDER BY round(score, 12) DESC, item_id) AS r FROM wt QUALIFY r <= 50
  UNION ALL SELECT base || '_overlap_' || d.depth::VARCHAR, query_id, item_id, row_number() OVER (PARTITION BY base, d.depth, query_id ORDER BY rank > d.depth, CASE WHEN rank <= d.depth THEN -new_score END NULLS LAST, rank) FROM ps CROSS JOIN (VALUES (20), (50)) d(depth)),
ranks AS (SELECT c.config, g.query_id, min(CASE WHEN contains(lower(coalesce(x.text, '')), lower(g.topic)) THEN r.rank END) AS first_rank
  FROM gold_query g CROSS JOIN (SELECT DISTINCT config FROM grid) c LEFT JOIN grid r ON r.query_id = g.query_id AND r.config = c.config LEFT JOIN documents x ON x.doc_id = r.item_id GROUP BY ALL)"""

SQL: dict[str, str] = {
    "text_experiment": f"WITH {_EXPERIMENT} SELECT {_MEASURES}, round(avg((first_rank IS NOT NULL)::INT), 6) AS pool_recall FROM ranks GROUP BY config",
    "page_hashes": f"WITH {_CRAWLED} SELECT slug, sha256(html) AS sha256 FROM pg",
    "nav_links": f"WITH {_CRAWLED} SELECT * FROM nv",
    "crawl_chain": f"WITH RECURSIVE {_CRAWLED}, w AS (SELECT min(slug) AS slug, 0::BIGINT AS ordinal FROM nv UNION ALL SELECT nv.next_slug, w.ordinal + 1 FROM w JOIN nv ON nv.slug = w.slug WHERE nv.next_slug IS NOT NULL AND nv.next_slug <> nv.slug) SELECT slug, ordinal FROM w",
    "html_titles": f"WITH {_CRAWLED} SELECT slug, {_tidy('title')} AS title FROM pg",
    "html_structure": f"WITH {_CRAWLED}, t AS (SELECT unnest(list_concat(['html', 'head', 'title', 'body', 'h1'], list_concat(CASE WHEN nxt IS NULL THEN [] ELSE ['a'] END, CASE WHEN parent_slug IS NULL THEN [] ELSE ['a'] END))) AS name FROM pg) SELECT name, count(*) AS n FROM t GROUP BY name",
    "html_blocks": f"""WITH s AS (SELECT * FROM doc_section QUALIFY row_number() OVER (PARTITION BY section_id) = 1), b AS (SELECT section_id, unnest(range(len(blocks))) AS i, unnest(blocks) AS b FROM s WHERE blocks IS NOT NULL),
x AS (SELECT section_id, i, b.kind AS kind, coalesce(b.text, '') AS text FROM b), c AS (SELECT section_id, i, {_folded('text')} AS raw FROM x WHERE kind = 'code'), {_CODE.format(t='raw', f='c')},
tr AS (SELECT section_id, i, list_transform(list_filter(string_split(text, chr(10)), lambda y: contains(y, '|')), lambda y: list_transform(string_split(y, '|')[2:greatest(len(string_split(y, '|')) - 1, 2)], lambda z: {_tidy('z')})) AS r FROM x WHERE kind = 'table'),
tk AS (SELECT section_id, i, list_filter(r, lambda y: len(list_filter(y, lambda z: z <> '')) > 0) AS r FROM tr), tw AS (SELECT *, list_max(list_transform(r, lambda y: len(y))) AS w FROM tk),
al AS (SELECT section_id, i, 'code' AS kind, '```' || chr(10) || code || chr(10) || '```' AS text FROM cd WHERE code <> ''
UNION ALL SELECT section_id, i, 'table', array_to_string(list_transform(r, lambda y: '| ' || array_to_string(list_concat(y, list_transform(range(w - len(y)), lambda q: '')), ' | ') || ' |'), chr(10)) FROM tw WHERE len(r) > 0
UNION ALL SELECT section_id, i, 'admonition', 'Tip: ' || {_tidy('text')} FROM x WHERE kind = 'admonition' AND {_tidy('text')} <> ''
UNION ALL SELECT section_id, i, 'prose', {_tidy('text')} FROM x WHERE coalesce(kind, '') NOT IN ('code', 'table', 'admonition') AND {_tidy('text')} <> '')
SELECT section_id, row_number() OVER (PARTITION BY section_id ORDER BY i) - 1 AS ord, kind, text FROM al""",
    "fenced_code": f"""WITH b AS (SELECT section_id, unnest(range(len(blocks))) AS ord, unnest(blocks) AS b FROM doc_section), c AS (SELECT section_id, ord, b.lang AS lang, {_folded("coalesce(b.text, '')")} AS raw FROM b WHERE b.kind = 'code'), {_CODE.format(t='raw', f='c')}
SELECT DISTINCT section_id, ord, CASE WHEN code = '' THEN '' ELSE '```' || coalesce(lang, '') || chr(10) || code || chr(10) || '```' END AS code FROM cd""",
    "collapsed_lines": r"SELECT doc_id, trim(regexp_replace(replace(text, '. ', '.' || repeat(chr(10), 4)), '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(9) || chr(10) || chr(13)) AS text FROM documents WHERE text IS NOT NULL",
    "nav_titles": "SELECT DISTINCT title, trim(title) AS bare FROM page_manifest",
    "jsonl_roundtrip": "SELECT DISTINCT chunk_id, text, array_to_string(section_path, ' > ') AS path, token_count, source_page, has_code FROM chunk",
    "manifest_pages": f"WITH {_CRAWLED} SELECT slug, length(regexp_replace(html, '\\s+', ' ', 'g')) AS chars FROM pg WHERE parent_slug IS NOT NULL",
    "vector_cache_roundtrip": """WITH c AS (SELECT DISTINCT chunk_id, source_format, text FROM chunk WHERE text IS NOT NULL)
SELECT count(*) AS texts, count(*) AS with_vector, (SELECT count(DISTINCT text) FROM c WHERE source_format = 'html') AS cached, (SELECT count(DISTINCT text) FROM c WHERE text NOT IN (SELECT text FROM c WHERE source_format = 'html')) AS embedded FROM c""",
    "store_status": """WITH n AS (SELECT count(DISTINCT chunk_id) AS n FROM chunk WHERE source_format = 'html' AND text IS NOT NULL)
SELECT 'documents' AS stage, 'html' AS source_format, NULL::BIGINT AS rows UNION ALL SELECT 'documents', 'pdf', NULL UNION ALL SELECT 'chunks', 'html', n FROM n UNION ALL SELECT 'chunks', 'pdf', NULL UNION ALL SELECT 'vectors', 'html', n FROM n UNION ALL SELECT 'vectors', 'pdf', 0""",
    "store_upsert": "SELECT chunk_id < '8' AS again, count(DISTINCT chunk_id) AS n FROM chunk WHERE source_format = 'html' AND text IS NOT NULL GROUP BY 1",
    "ask_store": f"""WITH hc AS (SELECT chunk_id, any_value(text) AS text FROM chunk WHERE source_format = 'html' AND text IS NOT NULL GROUP BY 1), gq AS (SELECT query_id, 'Represent this sentence for searching relevant passages: ' || question AS question FROM gold_query),
{_embedded('hc', 'chunk_id', 'text')}, {_embedded_queries('gq', 'query_id', 'question')},
al AS (SELECT vq.k AS query_id, vec.k AS item_id, list_cosine_similarity(vq.v::DOUBLE[], vec.v::DOUBLE[]) AS score FROM vq, vec)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, item_id) AS rank, round(score, 4) AS score FROM al QUALIFY rank <= 5""",
    "measures_side_by_side": f"WITH {_RETRIEVED} {_FUSED} {_ranks('grid')}, ms AS (SELECT config, round(avg(CASE WHEN first_rank <= 5 THEN 1.0 ELSE 0.0 END), 6) AS r FROM ranks GROUP BY config) SELECT max(r) FILTER (WHERE config = 'dense') AS dense, max(r) FILTER (WHERE config = 'half') AS half, max(r) FILTER (WHERE config = 'rrf') AS rrf FROM ms",
    "gold_misses": f"WITH {_RETRIEVED} {_ONE_DENSE} {_ranks('one')} SELECT config, query_id, topic FROM ranks WHERE first_rank IS NULL OR first_rank > 1",
    "gold_labels": f"WITH {_GOLD} SELECT query_id, CASE WHEN len(anchors) > 0 THEN array_to_string(anchors, ' | ') ELSE array_to_string(paths, ' | ') END AS label FROM ex",
    "gold_repeats": f"WITH {_GOLD} SELECT anchor, count(*) AS n FROM (SELECT unnest(anchors) AS anchor FROM ex) GROUP BY 1 HAVING count(*) > 1",
    "gold_topics": "SELECT topic, count(*) AS questions FROM gold_query GROUP BY topic",
    "vector_agreement": """WITH v AS (SELECT embedding::DOUBLE[] AS a, list_transform(embedding, lambda x: round(x::DOUBLE, 2)) AS b FROM embeddings)
SELECT round(min(list_cosine_similarity(a, b)), 5) AS least_cosine, round(max(list_max(list_transform(range(1, len(a) + 1), lambda i: abs(a[i] - b[i])))), 5) AS greatest_difference, count(*) AS items FROM v""",
    "layout_line_flags": f"WITH {_SPANS}, f AS (SELECT doc, page, line, text, kind = 'code' AS mono, kind = 'title' AS heading FROM ln) SELECT doc, mono AND trim(text) <> '' AS mono, heading AND trim(text) <> '' AS heading, mono AS starts_mono, count(*) AS lines, sum(length(text))::BIGINT AS chars FROM f GROUP BY ALL",
    "layout_fonts": f"WITH {_SPANS} SELECT CASE kind WHEN 'title' THEN 'Helvetica-Bold' WHEN 'code' THEN 'Courier' ELSE 'Times' END AS font, CASE kind WHEN 'title' THEN 14.0 ELSE 10.0 END::DOUBLE AS size, sum(length(text))::BIGINT AS chars FROM ln GROUP BY ALL",
    "layout_heading_parts": f"WITH {_SPANS}, f AS (SELECT doc, sum((kind = 'title' AND trim(text) <> '')::INT) OVER (PARTITION BY doc ORDER BY page, line ROWS UNBOUNDED PRECEDING)::BIGINT AS part FROM ln) SELECT doc, part, count(*) AS lines FROM f GROUP BY ALL",
    "layout_documents": f"""WITH {_OUTLINE}, r AS (SELECT * FROM e WHERE NOT EXISTS (SELECT 1 FROM e a WHERE a.doc = e.doc AND a.index < e.index AND a.level < e.level AND a.end_page >= e.end_page)),
b AS (SELECT r.*, (SELECT min(n.index) FROM o n WHERE n.doc = r.doc AND n.index > r.index AND n.level <= r.level) AS end_index FROM r),
c AS (SELECT DISTINCT doc_id AS doc, section_ord::BIGINT * 10000000 + section_id AS index FROM doc_section WHERE len(list_filter(coalesce(blocks, []), lambda x: trim(coalesce(x.text, ''), ' ' || chr(9) || chr(10) || chr(13)) <> '')) > 0),
k AS (SELECT b.doc, b.index, b.title, b.page, b.end_page, count(*) AS n_sections FROM b JOIN c ON c.doc = b.doc AND c.index >= b.index AND (b.end_index IS NULL OR c.index < b.end_index) JOIN o ON o.doc = c.doc AND o.index = c.index GROUP BY ALL)
SELECT 'pdf:' || coalesce(nullif({_key('title')}, ''), 'entry') || ':p' || page::VARCHAR AS doc_id, list_transform([{_title('title')}], lambda tt: {_bare('tt')})[1] AS title, n_sections, page AS page_start, end_page FROM k""".replace("end_page FROM k", "end_page AS page_end FROM k"),
    "outline_matches": f"""WITH {_OUTLINE}, w AS (SELECT DISTINCT {_key('title')} AS key FROM doc_section WHERE doc_id NOT LIKE 'pdf:%' AND title <> ''), k AS (SELECT doc, index, {_key('title')} AS key FROM o)
SELECT 'matched' AS state, doc || '|' || index::VARCHAR AS what FROM k WHERE key IN (SELECT key FROM w WHERE key <> '') UNION ALL SELECT 'unmatched', key FROM w WHERE key <> '' AND key NOT IN (SELECT key FROM k)""",
}
