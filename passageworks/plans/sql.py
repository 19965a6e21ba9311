"""DuckDB statements equivalent to the queries of this package; names and values must agree."""

from __future__ import annotations

_RETRIEVED = r"""
q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS qv, label AS ql FROM embeddings WHERE vec_id % 20 = 0),
v AS (SELECT vec_id AS item_id, embedding::DOUBLE[] AS iv, label FROM embeddings),
dense_all AS (SELECT query_id, item_id, list_cosine_similarity(qv, iv) AS score, label FROM q, v),
dense AS (SELECT query_id, item_id, score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, item_id) AS rank FROM dense_all QUALIFY rank <= 50),
half AS (SELECT query_id, item_id, list_cosine_similarity(qv[1:32], iv[1:32]) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(list_cosine_similarity(qv[1:32], iv[1:32]), 9) DESC, item_id) AS rank FROM q, v QUALIFY rank <= 50)
"""

_FUSED = r""",
rrf AS (SELECT query_id, item_id, sum(1.0 / (60 + rank)) AS score FROM (SELECT query_id, item_id, rank FROM dense UNION ALL SELECT query_id, item_id, rank FROM half) GROUP BY ALL),
sd AS (SELECT query_id, item_id, CASE WHEN max(score) OVER w = min(score) OVER w THEN 1.0 ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END AS s FROM dense WINDOW w AS (PARTITION BY query_id)),
sh AS (SELECT query_id, item_id, CASE WHEN max(score) OVER w = min(score) OVER w THEN 1.0 ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END AS s FROM half WINDOW w AS (PARTITION BY query_id)),
weighted AS (SELECT a.alpha, coalesce(sd.query_id, sh.query_id) AS query_id, coalesce(sd.item_id, sh.item_id) AS item_id, a.alpha * coalesce(sd.s, 0) + (1 - a.alpha) * coalesce(sh.s, 0) AS score
  FROM sd FULL JOIN sh ON sd.query_id = sh.query_id AND sd.item_id = sh.item_id CROSS JOIN (VALUES (0.3::DOUBLE), (0.5::DOUBLE), (0.7::DOUBLE)) a(alpha)),
renewed AS (SELECT *, ((item_id * 7919 + query_id) % 1009)::DOUBLE AS new_score FROM dense),
reranked AS (SELECT d.depth, query_id, item_id, CASE WHEN rank <= d.depth THEN new_score ELSE score END AS score,
  row_number() OVER (PARTITION BY d.depth, query_id ORDER BY rank > d.depth, CASE WHEN rank <= d.depth THEN -new_score END NULLS LAST, rank) AS rank FROM renewed CROSS JOIN (VALUES (20), (50)) d(depth)),
grid AS (
  SELECT 'dense' AS config, query_id, item_id, rank FROM dense UNION ALL SELECT 'half', query_id, item_id, rank FROM half
  UNION ALL SELECT 'rrf', query_id, item_id, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, item_id) AS r FROM rrf QUALIFY r <= 50
  UNION ALL SELECT 'weighted_' || alpha::VARCHAR, query_id, item_id, row_number() OVER (PARTITION BY alpha, query_id ORDER BY round(score, 12) DESC, item_id) AS r FROM weighted QUALIFY r <= 50
  UNION ALL SELECT 'dense_rerank_' || depth::VARCHAR, query_id, item_id, rank FROM reranked)
"""


def _ranks(source: str) -> str:
    return f""",
ranks AS (SELECT c.config, q.query_id, q.ql::VARCHAR AS topic, min(CASE WHEN v.label = q.ql AND v.item_id <> q.query_id THEN g.rank END) AS first_rank
  FROM q CROSS JOIN (SELECT DISTINCT config FROM {source}) c LEFT JOIN {source} g ON g.query_id = q.query_id AND g.config = c.config LEFT JOIN v ON v.item_id = g.item_id GROUP BY ALL)
"""


_MEASURES = """config, count(*) AS questions, round(avg(CASE WHEN first_rank <= 5 THEN 1.0 ELSE 0.0 END), 6) AS recall_5, round(avg(CASE WHEN first_rank <= 10 THEN 1.0 ELSE 0.0 END), 6) AS recall_10,
round(avg(CASE WHEN first_rank <= 20 THEN 1.0 ELSE 0.0 END), 6) AS recall_20, round(avg(CASE WHEN first_rank <= 50 THEN 1.0 ELSE 0.0 END), 6) AS recall_50,
round(avg(coalesce(1.0 / first_rank, 0.0)), 6) AS mrr, round(avg(coalesce(CASE WHEN first_rank <= 5 THEN 1.0 / log2(first_rank + 1) END, 0.0)), 6) AS ndcg_5"""

_ONE_DENSE = ", one AS (SELECT 'dense' AS config, * FROM dense)"

_TOKENS = r"""flatten(list_transform(regexp_extract_all(lower({t}), '[a-z0-9_]+'), lambda w: CASE WHEN contains(w, '_') THEN list_concat([w], list_filter(string_split(w, '_'), lambda p: p <> '')) ELSE [w] END))"""

_PROSE = r"""trim(regexp_replace(regexp_replace(regexp_replace({t}, '[ \t\x{{00a0}}]+', ' ', 'g'), ' +([,.;:!?)\]])', '\1', 'g'), '([(\[]) +', '\1', 'g'))"""


def _folded(t: str) -> str:
    out = f"translate({t}, chr(173) || chr(8203) || chr(8204) || chr(8205) || chr(65279), '')"
    for a, b in (("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("…", "..."), ("“", '"'), ("”", '"'), ("‘", "''"), ("’", "''"), ("‑", "-"), ("‐", "-")):
        out = f"replace({out}, '{a}', '{b}')"
    return out


_LINES = r"replace(replace(replace({t}, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10), ' ')"



def _rejoined(t: str) -> str:
    """Words over a line-break hyphen; it stays between a small letter and a capital or digit."""
    kept = f"regexp_replace({t}, '(\\p{{Ll}})-\\n([\\p{{Lu}}\\p{{Nd}}])', '\\1-\\2', 'g')"
    return f"regexp_replace({kept}, '([\\p{{L}}\\p{{N}}_])-\\n([\\p{{L}}\\p{{N}}_])', '\\1\\2', 'g')"


def _title(t: str) -> str:
    """A title folded and tidied."""
    return _PROSE.format(t=_LINES.format(t=_folded(t)))


def _label(t: str) -> str:
    return f"(lower(split_part({t}, ' ', 1)) IN ('chapter', 'part', 'appendix') AND regexp_full_match(regexp_replace(split_part({t}, ' ', 2), '\\.$', ''), '[0-9]+|[IVXLCivxlc]+|[A-Za-z]') AND split_part({t}, ' ', 3) <> '')"


def _own_number(t: str) -> str:
    return f"(ends_with(split_part({t}, ' ', 1), '.') AND regexp_full_match(split_part({t}, ' ', 1), '([A-Z][.])?[0-9]+([.][0-9]+)*[.]') AND split_part({t}, ' ', 2) <> '')"


def _number(t: str) -> str:
    """Of a tidied title: what follows "Chapter", with or without a dot, or the dotted first word."""
    return f"CASE WHEN {_label(t)} THEN regexp_replace(split_part({t}, ' ', 2), '\\.$', '') WHEN {_own_number(t)} THEN rtrim(split_part({t}, ' ', 1), '.') END"


def _bare(t: str) -> str:
    after = lambda n: f"array_to_string(string_split({t}, ' ')[{n}:], ' ')"
    return f"CASE WHEN {_label(t)} THEN {after(3)} WHEN {_own_number(t)} THEN {after(2)} ELSE {t} END"


def _key(t: str) -> str:
    """Of any title: letters and digits of its bare form; the tidied title is bound once."""
    return f"list_transform([{_title(t)}], lambda tt: regexp_replace(lower({_bare('tt')}), '[^a-z0-9]+', '', 'g'))[1]"


_SENTENCES = r"""list_filter(string_split(regexp_replace(text, '([.!?])\s+([A-Z(\[`"])', '\1' || chr(30) || '\2', 'g'), chr(30)), lambda s: s <> '')"""

_COMPARABLE = r"""lower(trim(regexp_replace(replace(regexp_replace(replace({t}, '`', ''), '(?m)^\s*\|?[\s:|-]*-{{3,}}[\s:|-]*\|?\s*$', ' ', 'g'), '|', ' '), '[\s\x{{00a0}}]+', ' ', 'g')))"""

_MANIFEST = "m AS (SELECT * FROM page_manifest QUALIFY row_number() OVER (PARTITION BY slug ORDER BY fetched_at DESC NULLS LAST, sha256 DESC, ordinal DESC, url DESC) = 1)"

_OUTLINE = """o AS (SELECT DISTINCT doc_id AS doc, section_ord::BIGINT * 10000000 + section_id AS index, level, title, page FROM doc_section WHERE doc_id LIKE 'pdf:%' AND page IS NOT NULL),
e AS (SELECT *, coalesce((SELECT arg_min(n.page, n.index) FROM o n WHERE n.doc = o.doc AND n.index > o.index AND n.level <= o.level), 5000) AS end_page FROM o)"""

_EVENTS = """l AS (SELECT user_id AS doc, dayofyear(ts) AS page, (hour(ts) * 3600 + minute(ts) * 60 + second(ts))::DOUBLE AS y0, event_id::DOUBLE AS x0, event_type AS text, value < 20 AS mono FROM events)"""

_GOLD = """ex AS (SELECT query_id, topic, question,
  list_sort(list_distinct(list_transform(list_filter(list_concat([expect_anchor], coalesce(expect_anchors, [])), lambda x: x IS NOT NULL), lambda x: upper(x)))) AS anchors,
  list_sort(list_distinct(list_transform(list_filter(list_concat([expect_path], coalesce(expect_paths, [])), lambda x: x IS NOT NULL), lambda x: lower(x)))) AS paths FROM gold_query)"""

_SIDES = f"""c AS (SELECT chunk_id, any_value(source_format) AS source_format, any_value(doc_id) AS doc_id, any_value(ordinal) AS ordinal, any_value(text) AS text, max(section_path) AS path, max(section_anchor) AS anchor FROM chunk WHERE text IS NOT NULL GROUP BY chunk_id),
k AS (SELECT *, list_filter(list_transform(coalesce(path, []), lambda p: {_key('p')}), lambda x: x <> '') AS ks FROM c),
ck AS (SELECT *, CASE WHEN coalesce(trim(anchor), '') <> '' THEN ['anchor:' || upper(trim(anchor))] ELSE list_concat(CASE WHEN len(ks) >= 2 THEN ['path2:' || ks[-2] || '|' || ks[-1]] ELSE [] END, CASE WHEN len(ks) BETWEEN 1 AND 2 THEN ['path1:' || ks[-1]] ELSE [] END) END AS keys FROM k),
g AS (SELECT source_format, keys[1] AS key, count(*) AS n, arg_min(chunk_id, struct_pack(a := doc_id, b := ordinal, c := chunk_id)) AS item, arg_min(keys, struct_pack(a := doc_id, b := ordinal, c := chunk_id)) AS keys,
  string_agg(CASE WHEN instr(text, chr(10) || chr(10)) > 0 THEN substring(text, instr(text, chr(10) || chr(10)) + 2) ELSE text END, ' ' ORDER BY doc_id, ordinal, chunk_id) AS text, min(struct_pack(a := doc_id, b := ordinal, c := chunk_id)) AS first FROM ck WHERE len(keys) > 0 GROUP BY ALL),
al AS (SELECT key, first, unnest(keys) AS alias FROM g WHERE source_format = 'pdf'),
ix AS (SELECT alias, arg_min(key, struct_pack(a := first, b := key)) AS right_key, count(*) AS n FROM al GROUP BY alias HAVING NOT starts_with(alias, 'path1:') OR count(*) = 1),
lk AS (SELECT key, unnest(keys) AS alias, unnest(range(len(keys))) AS pos FROM g WHERE source_format = 'html'),
best AS (SELECT lk.key, arg_min(ix.right_key, lk.pos) AS right_key FROM lk JOIN ix USING (alias) GROUP BY lk.key),
j AS (SELECT g.key, g.item, g.n, g.text, best.right_key, r.item AS right_item, r.n AS right_n, r.text AS right_text FROM g LEFT JOIN best USING (key) LEFT JOIN g r ON r.key = best.right_key AND r.source_format = 'pdf' WHERE g.source_format = 'html'),
w AS (SELECT *, {_COMPARABLE.format(t='text')} AS lt, {_COMPARABLE.format(t='right_text')} AS rt FROM j WHERE right_key IS NOT NULL),
s AS (SELECT *, list_distinct(regexp_extract_all(lt, '[a-z0-9]+')) AS lw, list_distinct(regexp_extract_all(rt, '[a-z0-9]+')) AS rw FROM w),
sim AS (SELECT key, coalesce(len(list_intersect(lw, rw)) / nullif(len(list_distinct(list_concat(lw, rw))), 0), 0.0) AS jaccard, coalesce(least(length(lt), length(rt)) / nullif(greatest(length(lt), length(rt)), 0), 1.0) AS length_ratio FROM s)"""



def _embedded(source: str, key: str, text: str, dim: int = 16) -> str:
    """CTEs ht, ax, vec: signed hashing of tokens, unit length; vec has key and v."""
    return f"""ht AS (SELECT {key} AS k, unnest({_TOKENS.format(t=text)}) AS t FROM {source}),
ax AS (SELECT k, ('0x' || substr(md5(t), 1, 7))::BIGINT % {dim} AS a, sum(CASE WHEN ('0x' || substr(md5(t), 8, 1))::INT % 2 = 0 THEN 1 ELSE -1 END)::DOUBLE AS s FROM ht GROUP BY ALL),
vec AS (SELECT k, list_transform(range({dim}), lambda i: coalesce(m[i], 0.0)::FLOAT) AS v FROM (SELECT k, map_from_entries(list((a, s / nullif(l, 0)))) AS m FROM (SELECT *, sqrt(sum(s * s) OVER (PARTITION BY k)) AS l FROM ax) GROUP BY k))"""


_BM25 = f"""t AS (SELECT doc_id, {_TOKENS.format(t="coalesce(text, '')")} AS t FROM documents), st AS (SELECT count(*) AS n, avg(len(t)) AS avgdl FROM t),
po AS (SELECT doc_id, dl, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS dl, unnest(t) AS term FROM t) GROUP BY ALL),
df AS (SELECT term, ln(any_value(n) - count(*) + 0.5) - ln(count(*) + 0.5) AS raw FROM po CROSS JOIN st GROUP BY term), idf AS (SELECT term, CASE WHEN raw < 0 THEN 0.25 * (SELECT avg(raw) FROM df) ELSE raw END AS idf FROM df),
qt AS (SELECT query_id, term, count(*) AS qn FROM (SELECT query_id, unnest({_TOKENS.format(t='question')}) AS term FROM gold_query) GROUP BY ALL),
sc AS (SELECT query_id, doc_id AS item_id, sum(qn * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score FROM qt JOIN idf USING (term) JOIN po USING (term) CROSS JOIN st GROUP BY ALL),
bm AS (SELECT query_id, item_id, score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, item_id) AS rank FROM sc QUALIFY rank <= 100),
over AS (SELECT bm.query_id, bm.item_id, bm.rank, len(list_intersect(list_distinct(q.qw), list_distinct(t.t))) / greatest(len(list_distinct(q.qw)), 1) AS new_score FROM bm JOIN (SELECT query_id, {_TOKENS.format(t='question')} AS qw FROM gold_query) q USING (query_id) JOIN t ON t.doc_id = bm.item_id)"""

SQL: dict[str, str] = {
    "rerank_overlap": f"WITH {_BM25} SELECT query_id, item_id, row_number() OVER (PARTITION BY query_id ORDER BY -new_score, rank) AS rank, round(new_score, 6) AS score FROM over WHERE rank <= 20",
    "embed_documents": f"WITH {_embedded('documents', 'doc_id', 'text')} SELECT doc_id, 16::BIGINT AS dim, round(coalesce(sqrt(list_sum(list_transform(v, lambda x: x::DOUBLE * x))), 0.0), 4) AS length, round(coalesce(v[1], 0)::DOUBLE, 4) AS first, round(coalesce(v[16], 0)::DOUBLE, 4) AS last FROM documents LEFT JOIN vec ON k = doc_id WHERE text IS NOT NULL",
    "compare_worst": f"WITH {_SIDES} SELECT key, round(jaccard, 6) AS jaccard FROM sim ORDER BY sim.jaccard, key LIMIT 8",
    "compare_coverage": f"""WITH {_SIDES}, cov AS (SELECT (SELECT count(*) FROM g WHERE source_format = 'html') AS left_keys, (SELECT count(*) FROM g WHERE source_format = 'pdf') AS right_keys, (SELECT count(right_key) FROM j) AS matched)
SELECT *, round(matched / left_keys, 6) AS left_coverage, round(matched / right_keys, 6) AS right_coverage FROM cov""",
    "pair_vector_cosine": f"""WITH {_SIDES}, {_embedded('c', 'chunk_id', 'text')}
SELECT j.key, j.right_key, round(coalesce(list_cosine_similarity(a.v::DOUBLE[], b.v::DOUBLE[]), 0), 4) AS cosine FROM j JOIN vec a ON a.k = j.item JOIN vec b ON b.k = j.right_item WHERE n = 1 AND right_n = 1""",
    "content_hash_dedup": "SELECT substr(sha256(text), 1, 16) AS content_hash, min(doc_id) AS doc_id, count(*) AS copies FROM documents WHERE text IS NOT NULL GROUP BY 1",
    "stable_chunk_id": "SELECT DISTINCT chunk_id, substr(sha1(concat_ws('|', source_format, doc_id, coalesce(section_anchor, ''), ordinal::VARCHAR)), 1, 16) AS derived_id FROM chunk",
    "hash_audit": "SELECT source_format, CASE WHEN content_hash IS NULL THEN 'missing' WHEN content_hash = substr(sha256(text), 1, 16) THEN 'current' ELSE 'stale' END AS state, count(*) AS n FROM chunk WHERE text IS NOT NULL GROUP BY ALL",
    "normalize_prose": f"SELECT doc_id, {_PROSE.format(t=_LINES.format(t=_folded('coalesce(text, chr(0))')))} AS prose FROM documents".replace("coalesce(text, chr(0))", "coalesce(text, '')"),
    "normalize_prose_wrapped": f"SELECT doc_id, {_PROSE.format(t=_LINES.format(t=_rejoined(_folded('text'))))} AS prose FROM documents".replace("translate(text,", "translate(coalesce(text, ''),"),
    "normalize_code": f"""WITH b AS (SELECT section_id, unnest(range(len(blocks))) AS ord, unnest(blocks) AS b FROM doc_section), c AS (SELECT section_id, ord, string_split({_folded('b.text')}, chr(10)) AS l FROM b WHERE b.kind = 'code' AND b.text IS NOT NULL),
t AS (SELECT section_id, ord, list_transform(l, lambda x: rtrim(x, ' ' || chr(9) || chr(13))) AS l FROM c), u AS (SELECT section_id, ord, l, list_filter(range(1, len(l) + 1), lambda i: l[i] <> '') AS used FROM t),
m AS (SELECT *, coalesce(list_min(list_transform(list_filter(l, lambda x: x <> ''), lambda x: length(x) - length(ltrim(x, ' ' || chr(9))))), 0) AS margin FROM u)
SELECT DISTINCT section_id, ord::INT AS ord, coalesce(array_to_string(list_transform(l[used[1]:used[-1]], lambda x: substring(x, margin + 1)), chr(10)), '') AS code FROM m""",
    "html_sections": f"""WITH s AS (SELECT * FROM doc_section QUALIFY row_number() OVER (PARTITION BY section_id) = 1), k AS (SELECT doc_id, section_ord, section_id, anchor, blocks, {_title("coalesce(title, '')")} AS tt FROM s WHERE blocks IS NOT NULL)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY section_ord, section_id) - 1 AS ord, {_bare('tt')} AS title, {_number('tt')} AS number, nullif(anchor, '') AS anchor, 1::BIGINT AS level,
  len(list_filter(blocks, lambda b: trim(coalesce(b.text, ''), ' ' || chr(9) || chr(10) || chr(13)) <> ''))::BIGINT AS n_blocks FROM k""",
    "section_numbers": f"SELECT title, {_number('tt')} AS number, {_bare('tt')} AS bare FROM (SELECT DISTINCT title, {_title('title')} AS tt FROM (SELECT unnest(section_path) AS title FROM chunk) WHERE title IS NOT NULL)",
    "title_keys": f"SELECT {_key('title')} AS key, count(DISTINCT title) AS spellings, count(*) AS n FROM (SELECT unnest(section_path) AS title FROM chunk) WHERE title IS NOT NULL GROUP BY 1",
    "token_key_set": "SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+'))), ' ') AS words FROM documents WHERE text IS NOT NULL",
    "token_count_estimate": "SELECT doc_id, ceil(length(coalesce(text, '')) / 4)::BIGINT AS tokens FROM documents",
    "comparison_text": f"SELECT DISTINCT chunk_id, {_COMPARABLE.format(t='text')} AS plain FROM chunk WHERE text IS NOT NULL",
    "body_preview": "SELECT DISTINCT chunk_id, length(b) AS body_chars, CASE WHEN length(b) > 420 THEN rtrim(b[1:420]) || ' ...' ELSE b END AS preview FROM (SELECT chunk_id, CASE WHEN instr(text, chr(10) || chr(10)) > 0 THEN substring(text, instr(text, chr(10) || chr(10)) + 2) ELSE text END AS b FROM chunk WHERE text IS NOT NULL)",
    "lexical_tokenize": f"SELECT doc_id, len(t) AS n, array_to_string(t, ' ') AS tokens FROM (SELECT doc_id, {_TOKENS.format(t='text')} AS t FROM documents WHERE text IS NOT NULL)",
    "parameter_anchors": r"SELECT DISTINCT name, 'GUC-' || upper(replace(name, '_', '-')) AS anchor FROM (SELECT regexp_extract(title, '^([a-z][a-z0-9_]*) \(', 1) AS name FROM chunk) WHERE name <> ''",
    "breadcrumb_areas": """WITH b AS (SELECT DISTINCT chunk_id, section_path, title FROM chunk), c AS (SELECT coalesce(nullif(array_to_string(list_filter(coalesce(section_path, []), lambda x: x <> ''), ' > '), ''), title) AS crumb FROM b)
SELECT CASE WHEN starts_with(crumb, 'Server Administration') THEN 'admin' WHEN starts_with(crumb, 'Server Programming') THEN 'programming' WHEN starts_with(crumb, 'Reference') THEN 'reference' WHEN starts_with(crumb, 'Internals') THEN 'internals' WHEN starts_with(crumb, 'Tutorial') THEN 'tutorial' WHEN starts_with(crumb, 'Client Interfaces') THEN 'clients' END AS area, count(*) AS n, max(length(crumb)) AS longest FROM c GROUP BY 1""",
    "metadata_flatten": """SELECT DISTINCT chunk_id, doc_id, source_format, pg_version, title, coalesce(array_to_string(section_path, ' > '), '') AS breadcrumb, chunk_type, coalesce(token_count, -1) AS token_count, coalesce(content_hash, '') AS content_hash,
coalesce(ordinal, -1) AS ordinal, coalesce(source_url, '') AS source_url, coalesce(source_page, -1) AS source_page, coalesce(section_anchor, '') AS section_anchor, has_code, has_table FROM chunk""",
    "markdown_table": r"""SELECT r_name, '| nation | key |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || replace(n_name, '|', '\|') || ' | ' || n_nationkey::VARCHAR || ' |', chr(10) ORDER BY n_nationkey) AS md FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""",
    "url_slugs": r"SELECT DISTINCT url, coalesce(nullif(regexp_extract(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', ''), '([^/]*)$', 1), ''), 'index.html') AS derived_slug, NOT (contains(url, '/current/') OR contains(url, '#')) AS allowed FROM page_manifest WHERE url IS NOT NULL",
    "manifest_latest": f"WITH {_MANIFEST} SELECT slug, fetched_at, sha256 FROM m",
    "ancestor_breadcrumb": f"""WITH RECURSIVE {_MANIFEST},
walk AS (SELECT slug, parent_slug AS at, [slug] AS seen, []::VARCHAR[] AS up, 0 AS hop FROM m UNION ALL
  SELECT walk.slug, p.parent_slug, list_concat(seen, [walk.at]), CASE WHEN NOT ends_with(lower(trim(p.title)), 'documentation') AND trim(p.title) <> '' THEN list_concat([p.title], up) ELSE up END, hop + 1
  FROM walk JOIN m p ON p.slug = walk.at WHERE hop < 8 AND NOT list_contains(seen, walk.at))
SELECT slug, array_to_string(arg_max(up, hop), ' > ') AS ancestors FROM walk GROUP BY slug""",
    "section_split_lines": "SELECT doc_id, ord, line FROM (SELECT doc_id, unnest(range(len(p))) AS ord, unnest(p) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents WHERE text IS NOT NULL)) WHERE line <> ''",
    "sentence_split_count": f"SELECT doc_id, len({_SENTENCES}) AS sentences FROM documents WHERE text IS NOT NULL",
    "chunk_greedy_pack": f"""WITH RECURSIVE u AS (SELECT doc_id, unnest(range(len(p))) AS i, unnest(p) AS s FROM (SELECT doc_id, {_SENTENCES} AS p FROM documents WHERE text IS NOT NULL)),
f AS (SELECT doc_id, i, s, ceil(length(s) / 4)::BIGINT AS room, 0::BIGINT AS ord FROM u WHERE i = 0 UNION ALL
  SELECT u.doc_id, u.i, u.s, CASE WHEN f.room + ceil(length(u.s) / 4) > 120 THEN ceil(length(u.s) / 4)::BIGINT ELSE f.room + ceil(length(u.s) / 4)::BIGINT END, CASE WHEN f.room + ceil(length(u.s) / 4) > 120 THEN f.ord + 1 ELSE f.ord END FROM f JOIN u ON u.doc_id = f.doc_id AND u.i = f.i + 1)
SELECT doc_id, ord, string_agg(s, ' ' ORDER BY i) AS part FROM f GROUP BY ALL""",
    "chunk_type_flags": """WITH k AS (SELECT section_id, kind, list_transform(list_filter(blocks, lambda b: coalesce(trim(b.text), '') <> ''), lambda b: b.kind) AS kinds FROM doc_section WHERE blocks IS NOT NULL)
SELECT DISTINCT section_id, CASE WHEN kind = 'parameter' THEN 'parameter' WHEN len(kinds) = 0 THEN 'prose' WHEN len(list_filter(kinds, lambda x: x NOT IN ('code', 'synopsis'))) = 0 THEN 'code' WHEN list_distinct(kinds) = ['table'] THEN 'table' WHEN len(list_distinct(kinds)) > 1 THEN 'mixed' ELSE 'prose' END AS chunk_type, list_contains(kinds, 'table') AS has_table FROM k""",
    "chunk_statistics": """WITH c AS (SELECT DISTINCT chunk_id, chunk_type, section_anchor, ceil(length(coalesce(text, '')) / 4)::BIGINT AS t FROM chunk)
SELECT chunk_type, count(*) AS chunks, min(t) AS least, trunc(median(t))::BIGINT AS median, list_sort(list(t))[greatest(1, floor(count(*) * 0.95)::BIGINT)] AS p95, max(t) AS most, count(*) FILTER (WHERE t > 512) AS over_limit, round(avg((coalesce(section_anchor, '') <> '')::INT), 6) AS anchored FROM c GROUP BY 1""",
    "validate_chunks": """WITH c AS (SELECT DISTINCT chunk_id, text, section_path FROM chunk)
SELECT chunk_id, 'over_window' AS rule FROM c WHERE ceil(length(coalesce(text, '')) / 4) > 512 UNION SELECT chunk_id, 'empty_text' FROM c WHERE trim(coalesce(text, '')) = ''
UNION SELECT chunk_id, 'open_fence' FROM c WHERE (len(string_split(text, '```')) - 1) % 2 <> 0 UNION SELECT chunk_id, 'no_path' FROM c WHERE coalesce(len(section_path), 0) <= 0 UNION SELECT chunk_id, 'repeated_id' FROM c GROUP BY chunk_id HAVING count(*) > 1""",
    "block_profile": "SELECT b.kind AS kind, b.lang AS lang, count(*) AS n, sum(length(coalesce(b.text, '')))::BIGINT AS chars FROM (SELECT unnest(blocks) AS b FROM (SELECT DISTINCT section_id, blocks FROM doc_section)) GROUP BY ALL",
    "artifact_peek": "SELECT DISTINCT chunk_id, doc_id, title FROM chunk WHERE contains(lower(concat_ws(chr(10), section_anchor, title, text)), 'savepoint') AND contains(lower(concat_ws(chr(10), section_anchor, title, text)), 'guc-')",
    "html_tags": "SELECT tag, count(*) AS n FROM (SELECT unnest(list_transform(regexp_extract_all(text, '<([a-zA-Z][a-zA-Z0-9]*)', 1), lambda x: lower(x))) AS tag FROM documents WHERE text IS NOT NULL) GROUP BY 1",
    "paragraph_islands": f"""WITH {_EVENTS}, gp AS (SELECT *, CASE WHEN lag(page) OVER w = page THEN y0 - lag(y0) OVER w END AS gap FROM l WINDOW w AS (PARTITION BY doc ORDER BY page, y0, x0)),
md AS (SELECT doc, median(gap) AS med FROM gp WHERE gap > 0 GROUP BY doc),
nw AS (SELECT gp.*, sum(CASE WHEN gap IS NULL OR gap > coalesce(med, 12.0) * 1.55 THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY page, y0, x0 ROWS UNBOUNDED PRECEDING) AS paragraph FROM gp LEFT JOIN md USING (doc)),
pp AS (SELECT doc, paragraph, string_agg(text, chr(10) ORDER BY page, y0, x0) AS text FROM nw GROUP BY ALL)
SELECT doc, max(paragraph)::BIGINT AS paragraphs, max(length(text)) AS longest FROM pp GROUP BY doc""",
    "code_runs": f"""WITH {_EVENTS}, r AS (SELECT *, sum(st) OVER (PARTITION BY doc ORDER BY page, y0, x0 ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, CASE WHEN lag(mono) OVER (PARTITION BY doc ORDER BY page, y0, x0) IS DISTINCT FROM mono THEN 1 ELSE 0 END AS st FROM l)),
c AS (SELECT *, mono AND count(*) OVER (PARTITION BY doc, run) >= 2 AS code FROM r),
b AS (SELECT *, sum(s2) OVER (PARTITION BY doc ORDER BY page, y0, x0 ROWS UNBOUNDED PRECEDING) AS block FROM (SELECT *, CASE WHEN lag(code) OVER (PARTITION BY doc ORDER BY page, y0, x0) IS DISTINCT FROM code THEN 1 ELSE 0 END AS s2 FROM c))
SELECT doc, CASE WHEN code THEN 'code' ELSE 'prose' END AS kind, count(DISTINCT block) AS blocks FROM b GROUP BY ALL""",
    "outline_end_page": f"""WITH {_OUTLINE}
SELECT doc, index, end_page, (SELECT string_agg(a.title, ' > ' ORDER BY a.index) FROM o a WHERE a.doc = e.doc AND a.index <= e.index AND a.level <= e.level AND NOT EXISTS (SELECT 1 FROM o b WHERE b.doc = a.doc AND b.index > a.index AND b.index <= e.index AND b.level <= a.level)) AS path FROM e""",
    "root_selection": f"""WITH {_OUTLINE}
SELECT doc, index, 'outermost' AS rule FROM e WHERE NOT EXISTS (SELECT 1 FROM e a WHERE a.doc = e.doc AND a.index < e.index AND a.level < e.level AND a.end_page >= e.end_page)
UNION ALL SELECT doc, index, 'innermost' FROM e WHERE NOT EXISTS (SELECT 1 FROM e a WHERE a.doc = e.doc AND a.index > e.index AND a.level > e.level AND a.end_page <= e.end_page)""",
    "dense_topk": f"WITH {_RETRIEVED} SELECT query_id, item_id, rank, round(score, 6) AS score FROM dense WHERE rank <= 10",
    "dense_topk_filtered": f"WITH {_RETRIEVED} SELECT query_id, item_id, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, item_id) AS rank, round(score, 6) AS score FROM dense_all WHERE label < 5 QUALIFY rank <= 10",
    "bm25_index_stats": f"SELECT term, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest({_TOKENS.format(t='text')}) AS term FROM documents) GROUP BY term",
    "bm25_topk": f"""WITH t AS (SELECT doc_id, {_TOKENS.format(t="coalesce(text, '')")} AS t FROM documents), st AS (SELECT count(*) AS n, avg(len(t)) AS avgdl FROM t),
po AS (SELECT doc_id, dl, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS dl, unnest(t) AS term FROM t) GROUP BY ALL),
df AS (SELECT term, ln(any_value(n) - count(*) + 0.5) - ln(count(*) + 0.5) AS raw FROM po CROSS JOIN st GROUP BY term), idf AS (SELECT term, CASE WHEN raw < 0 THEN 0.25 * (SELECT avg(raw) FROM df) ELSE raw END AS idf FROM df),
qt AS (SELECT query_id, term, count(*) AS qn FROM (SELECT query_id, unnest({_TOKENS.format(t='question')}) AS term FROM gold_query) GROUP BY ALL),
sc AS (SELECT query_id, doc_id AS item_id, sum(qn * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score FROM qt JOIN idf USING (term) JOIN po USING (term) CROSS JOIN st GROUP BY ALL)
SELECT query_id, item_id, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, item_id) AS rank, round(score, 6) AS score FROM sc QUALIFY rank <= 10""",
    "rrf_fusion": f"WITH {_RETRIEVED} {_FUSED} SELECT query_id, item_id, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, item_id) AS rank, round(score, 6) AS score FROM rrf QUALIFY rank <= 20",
    "weighted_fusion": f"WITH {_RETRIEVED} {_FUSED} SELECT alpha, query_id, item_id, row_number() OVER (PARTITION BY alpha, query_id ORDER BY round(score, 12) DESC, item_id) AS rank, round(score, 6) AS score FROM weighted QUALIFY rank <= 20",
    "rerank_reorder": f"WITH {_RETRIEVED} {_FUSED} SELECT query_id, item_id, rank, round(score, 6) AS score FROM reranked WHERE depth = 20",
    "recall_mrr_ndcg": f"WITH {_RETRIEVED} {_ONE_DENSE} {_ranks('one')} SELECT {_MEASURES} FROM ranks GROUP BY config",
    "recall_by_topic": f"WITH {_RETRIEVED} {_ONE_DENSE} {_ranks('one')} SELECT config, topic, grouping(topic)::INT AS overall, round(avg(CASE WHEN first_rank <= 2 THEN 1.0 ELSE 0.0 END), 6) AS recall, count(*) AS questions FROM ranks GROUP BY GROUPING SETS ((config, topic), (config))",
    "experiment_grid": f"WITH {_RETRIEVED} {_FUSED} {_ranks('grid')} SELECT {_MEASURES} FROM ranks GROUP BY config",
    "rank_buckets": f"WITH {_RETRIEVED} {_FUSED} {_ranks('grid')} SELECT config, CASE WHEN first_rank IS NULL THEN 'miss' WHEN first_rank = 1 THEN '1' WHEN first_rank <= 3 THEN '2-3' WHEN first_rank <= 5 THEN '4-5' WHEN first_rank <= 10 THEN '6-10' WHEN first_rank <= 20 THEN '11-20' WHEN first_rank <= 50 THEN '21-50' ELSE 'miss' END AS bucket, count(*) AS n FROM ranks GROUP BY ALL",
    "gold_metrics": f"""WITH {_GOLD}, la AS (SELECT * FROM search_result WHERE item_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY run_id, config, query_id, item_id ORDER BY scored_at DESC NULLS LAST, score DESC NULLS LAST, result_id DESC) = 1),
pl AS (SELECT *, row_number() OVER (PARTITION BY run_id, config, query_id ORDER BY CASE WHEN config = 'dense_l2' THEN -score ELSE score END DESC NULLS LAST, item_id) AS p FROM la), s AS (SELECT config, query_id, item_id, min(p) AS r FROM pl GROUP BY ALL), placed AS (SELECT config, query_id, item_id, row_number() OVER (PARTITION BY config, query_id ORDER BY r, item_id) AS rank FROM s),
c AS (SELECT chunk_id AS item_id, max(section_anchor) AS anchor, coalesce(max(array_to_string(section_path, ' > ')), '') AS crumb FROM chunk GROUP BY 1),
hit AS (SELECT config, p.query_id, min(rank) AS first_rank FROM placed p JOIN c USING (item_id) JOIN ex ON ex.query_id = p.query_id WHERE coalesce(list_contains(anchors, upper(anchor)), false) OR len(list_filter(paths, lambda x: contains(lower(crumb), x))) > 0 GROUP BY ALL),
ranks AS (SELECT k.config, ex.query_id, hit.first_rank FROM ex CROSS JOIN (SELECT DISTINCT config FROM placed) k LEFT JOIN hit ON hit.config = k.config AND hit.query_id = ex.query_id)
SELECT {_MEASURES} FROM ranks GROUP BY config""",
    "goldset_verify": rf"""WITH {_GOLD}, c AS (SELECT chunk_id, upper(max(section_anchor)) AS anchor, lower(coalesce(array_to_string(max(section_path), ' > '), '')) AS crumb FROM chunk WHERE chunk_id IS NOT NULL GROUP BY 1),
m AS (SELECT query_id, chunk_id FROM (SELECT query_id, unnest(anchors) AS anchor FROM ex) JOIN c USING (anchor) UNION SELECT query_id, chunk_id FROM (SELECT query_id, unnest(paths) AS p FROM ex) JOIN c ON contains(crumb, p)),
n AS (SELECT query_id, count(*) AS k FROM m GROUP BY 1)
SELECT query_id, coalesce(k, 0) AS matches, coalesce(k, 0) = 0 AS unresolved, coalesce(k, 0) > 30 AS unspecific,
len(list_filter(list_concat(list_transform(anchors, lambda a: replace(regexp_replace(lower(a), '^guc-', ''), '-', '_')), paths), lambda t: length(t) > 3 AND contains(lower(question), t))) > 0 AS leaking FROM ex LEFT JOIN n USING (query_id)""",
    "stratified_stride_sample": """WITH d AS (SELECT lang, site, min(doc_id) AS first FROM documents WHERE lang IS NOT NULL AND site IS NOT NULL GROUP BY ALL),
i AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY first) - 1 AS i, greatest(1, floor(count(*) OVER (PARTITION BY lang) / 5)) AS step FROM d), k AS (SELECT lang, site FROM i WHERE i % step = 0 AND i / step < 5)
SELECT k.lang, k.site, arg_min(doc_id, struct_pack(a := title IS NULL, b := doc_id)) AS doc_id FROM k JOIN documents USING (lang, site) GROUP BY ALL""",
    "even_stride_sample": "WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents), n AS (SELECT count(*) AS n FROM documents) SELECT DISTINCT doc_id FROM o, n, range(100) s(k) WHERE k < least(100, n) AND i = floor(k * n / least(100, n))",
    "vector_cache_plan": "SELECT hit, count(*) AS n FROM (SELECT DISTINCT content_hash, content_hash IN (SELECT content_hash FROM chunk WHERE source_format = 'html' AND content_hash IS NOT NULL) AS hit FROM chunk WHERE content_hash IS NOT NULL) GROUP BY hit",
    "upsert_latest": "SELECT chunk_id, max(loaded_at) AS loaded_at FROM chunk GROUP BY chunk_id",
    "format_join_fallback": f"WITH {_SIDES} SELECT key, item, n, right_key, right_item FROM j",
    "jaccard_pairs": f"WITH {_SIDES} SELECT key, round(jaccard, 6) AS jaccard, round(length_ratio, 6) AS length_ratio FROM sim",
    "compare_summary": f"WITH {_SIDES} SELECT CASE WHEN jaccard >= 0.95 THEN '>=0.95' WHEN jaccard >= 0.85 THEN '0.85-0.95' WHEN jaccard >= 0.70 THEN '0.70-0.85' WHEN jaccard >= 0.50 THEN '0.50-0.70' ELSE '<0.50' END AS bucket, count(*) AS pairs, round(median(length_ratio), 6) AS median_length_ratio FROM sim GROUP BY 1",
    "unmatched_keys": f"WITH {_SIDES} SELECT split_part(key, ':', 1) AS kind, count(*) AS n FROM j WHERE right_key IS NULL GROUP BY 1",
    "stream_event_windows": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL",
}
