import difflib
import json

import pytest
from pyspark.sql import functions as F

from passageworks.operators import chunking, consistency, crawl, html, layout, store
from passageworks.operators.chunking import chunk_documents
from passageworks.sources import records
from passageworks.sources.layout_source import LayoutLines
from passageworks.streaming import ingest

SENTENCE = "The server listens on the port that this value names for now. "
DOC = {"doc_id": "test.html", "source_format": "html", "pg_version": "18", "title": "Server Configuration", "source_url": "https://example.test/test.html", "page_start": None}


def section(blocks, title="Connection Settings", kind="section", anchor=None):
    return {"title": title, "level": 2, "path": ["Server Configuration", title], "blocks": [dict(zip(("kind", "text", "lang"), (*b, None))) for b in blocks], "anchor": anchor, "number": None, "kind": kind, "page": None}


DOCUMENT = f"doc_id string, source_format string, pg_version string, title string, sections array<{records.SECTION}>, source_url string, page_start int"


def documents(spark, rows):
    return spark.createDataFrame([tuple(r[c.strip().split()[0]] for c in "doc_id,source_format,pg_version,title,sections,source_url,page_start".split(",")) for r in rows], DOCUMENT)


def chunks(spark, *sections):
    return chunk_documents(documents(spark, [DOC | {"sections": list(sections)}])).orderBy("ordinal").collect()


def test_breadcrumb_starts_the_text(spark):
    assert chunks(spark, section([("prose", SENTENCE * 3)]))[0]["text"].startswith("Server Configuration > Connection Settings\n\n")


def test_ceiling(spark):
    got = chunks(spark, section([("prose", SENTENCE * 400)]))
    assert len(got) > 1 and all(c["token_count"] <= 512 for c in got)


def test_code_is_fenced_in_each_part(spark):
    code = "```sql\n" + "\n".join(f"SELECT column_{i} FROM some_table WHERE other = {i};" for i in range(200)) + "\n```"
    got = chunks(spark, section([("code", code)]))
    assert len(got) > 1 and all(c["token_count"] <= 512 and c["text"].count("```") % 2 == 0 and "```sql" in c["text"] for c in got)


def test_table_repeats_its_header(spark):
    rows = "| a | b |\n| --- | --- |\n" + "\n".join(f"| value number {i} | {'x' * 40} |" for i in range(100))
    got = chunks(spark, section([("table", rows)]))
    assert len(got) > 1 and all("| a | b |\n| --- | --- |" in c["text"] for c in got) and all(c["has_table"] for c in got)


def test_parameters_stay_apart_and_keep_anchors(spark):
    got = chunks(spark, section([("prose", "Tiny.")], "port (integer)", "parameter", "GUC-PORT"), section([("prose", "Tiny.")], "host (string)", "parameter", "GUC-HOST"))
    assert [c["section_anchor"] for c in got] == ["GUC-PORT", "GUC-HOST"] and got[0]["source_url"].endswith("#GUC-PORT")


def test_small_section_joins_the_one_before(spark):
    got = chunks(spark, section([("prose", SENTENCE * 4)]), section([("prose", "See also.")], "More"))
    assert len(got) == 1 and "More\nSee also." in got[0]["text"]


def test_empty_and_null(spark):
    assert chunks(spark, section([])) == [] and chunks(spark, section([("prose", None), ("prose", "  ")])) == []


@pytest.mark.parametrize(("blocks", "want"), [([("prose", "a")], "prose"), ([("code", "a")], "code"), ([("prose", "a"), ("code", "b")], "mixed"), ([("code", "a"), ("synopsis", "b")], "code"), ([("admonition", "a")], "prose")])
def test_types(spark, blocks, want):
    assert chunks(spark, section(blocks))[0]["chunk_type"] == want
    df = spark.createDataFrame([([b[0] for b in blocks],)], "k array<string>")
    assert df.select(chunking.chunk_type(F.col("k"), F.lit(False))).first()[0] == want


def test_overlap_repeats_whole_sentences(spark):
    text = " ".join(f"Sentence number {i} says something short." for i in range(120))
    df = spark.createDataFrame([(text,)], "t string")
    parts = df.select(chunking.prose_parts(F.col("t"), F.lit(200))).first()[0]
    assert len(parts) > 1
    for a, b in zip(parts, parts[1:]):
        first = b.split(". ")[0]
        assert first in a


def test_greedy_pack(spark):
    units = ["aaaa", "bbbbbbbb", "cc", "d" * 24, "e"]
    df = spark.createDataFrame([(units,)], "u array<string>")
    want = ["aaaa bbbbbbbb", "cc", "d" * 24, "e"]
    assert df.select(chunking.greedy_pack(F.col("u"), 3)).first()[0] == want


def test_stable_under_repartition(spark):
    rows = [DOC | {"doc_id": f"d{i}", "sections": [section([("prose", SENTENCE * (i + 1))])]} for i in range(12)]
    df = documents(spark, rows)
    a, b = (sorted(map(str, chunk_documents(x).collect())) for x in (df.repartition(1), df.repartition(7)))
    assert a == b and len(a) >= 12
    assert chunking.invalid_chunks(chunk_documents(df)).count() == 0


def test_sizes_and_merging_of_many_documents(spark):
    """Groups are greedy (no piece could take the next block), texts come out whole and in order, and numbers count from 0 in each
    document, also where its sections are spread over many ranges."""
    import random

    rng = random.Random(4)
    rows, said = [], {}
    for d in range(12):
        secs, said[f"d{d}"] = [], []
        for k in range(rng.choice([0, 1, 30])):
            blocks = []
            for _ in range(rng.randint(0, 4)):
                n = rng.choice([1, 3, 30, 250])
                text = " ".join(f"Word{rng.randint(0, 9999)} stands here{'.' * (rng.random() < 0.4)}" for _ in range(n))
                blocks.append((rng.choice(["prose", "admonition", "code", "table"]), f"```\n{text}\n```" if rng.random() < 0.1 else text))
                said[f"d{d}"] += [w for w in text.split() if w.startswith("Word")]
            secs.append(section(blocks, f"T{k}", "parameter" if rng.random() < 0.2 else "section", f"A{k}"))
        rows.append(DOC | {"doc_id": f"d{d}", "sections": secs})
    got = chunk_documents(documents(spark, rows).repartition(5)).orderBy("doc_id", "ordinal").collect()
    by = {}
    for c in got:
        by.setdefault(c["doc_id"], []).append(c)
    for doc, cs in by.items():
        assert [c["ordinal"] for c in cs] == list(range(len(cs))) and all(c["token_count"] <= 512 and c["char_count"] == len(c["text"]) for c in cs)
        words = [w for c in cs for w in c["text"].split() if w.startswith("Word")]
        at = iter(words)
        assert all(w in at for w in said[doc])  # in order; overlaps come beside
        assert len({c["chunk_id"] for c in cs}) == len(cs)
    small = [c for cs in by.values() for c, after in zip(cs, cs[1:]) if after["token_count"] < 40 and after["chunk_type"] != "parameter" and c["chunk_type"] != "parameter" and [x["section_path"] for x in cs].count(after["section_path"]) == 1 and c["token_count"] < 250]
    assert not small


def test_texts_that_cannot_be_cut(spark):
    """A word longer than any budget stays whole; a table of a head only and an open fence lose nothing."""
    word = "x" * 5000
    head = "| " + " | ".join(f"column{i}" * 9 for i in range(40)) + " |\n| --- |"
    got = chunks(spark, section([("prose", f"Before it. {word} After it.")]), section([("table", head)]), section([("code", "```sql\n" + "SELECT 1;\n" * 300)]))
    assert any(word in c["text"] for c in got) and sum(c["text"].count("SELECT 1;") for c in got) == 300
    assert all(f"column{i}" in "".join(c["text"] for c in got) for i in range(40))


def test_quantile_is_an_element(spark):
    df = spark.createDataFrame([("a", 10 * i) for i in range(1, 11)], "g string, t int")
    assert chunking.token_quantile(df, "g", "t", 0.95).first()["p95"] == 90


PAGE = """<html><head><title>Docs: Documentation: 18: X</title></head><body><div class="navheader">skip</div><div id="docContent">
<div class="sect1" id="A"><div class="titlepage"><h2>19.3. Top &amp; More</h2></div><p>First <code>a_b</code> text<p>Second</p>
<pre class="programlisting">  x
    y</pre><div class="note"><h3>Note</h3><p>Mind.</p></div><table><tr><th>h</th></tr><tr><td>a|b</td></tr></table>
<ul><li>one<ul><li>inner</li></ul><li>two</ul>
<div class="variablelist"><dl><dt id="GUC-P"><span class="term">p (int)</span></dt><dd><p>Means p.</p></dd></dl></div>
<div class="sect2"><h3>Sub</h3><p>Under.</p></div></div></div><script>no()</script></body></html>"""


def test_html_sections():
    got = html.sections(PAGE, ["Manual"])
    assert [(s["title"], s["level"], s["kind"]) for s in got] == [("Top & More", 2, "section"), ("p (int)", 3, "parameter"), ("Sub", 3, "section")]
    top = got[0]
    assert top["number"] == "19.3" and top["anchor"] == "A" and top["path"] == ["Manual", "Top & More"]
    texts = [(b["kind"], b["text"]) for b in top["blocks"]]
    assert ("prose", "First `a_b` text") in texts and ("prose", "Second") in texts
    assert ("code", "```\nx\n  y\n```") in texts and ("admonition", "Note: Mind.") in texts
    assert ("table", "| h |\n| --- |\n| a\\|b |") in texts and ("prose", "- one\n  - inner\n- two") in texts
    assert got[1]["anchor"] == "GUC-P" and got[1]["blocks"][0]["text"] == "Means p."
    assert html.sections("", []) == [] and html.sections("<p>no body", []) == []


MANUAL = """<html><body><div id="docContent"><h1>Not a section</h1><div class="refentry" id="SQL-X"><div class="refnamediv"><h2>ALTER <code>X</code></h2><p>ALTER X \u2014 change \u201cx\u201d</p></div>
<div class="refsynopsisdiv"><h2>Synopsis</h2><pre class="synopsis">ALTER X  [ y ]
</pre></div><div class="refsect1" id="P"><h2>3.1. Para\u00admeters of <code class="c">a_b</code> (<code>int</code>)</h2><p>See de\ufb01nitions.<br>Next</p><hr><em>Loose</em>
<div class="itemizedlist"><ul><li><p>one</p><div class="orderedlist"><ol><li>in <code>c</code>ner</li></ol></div></li><li></li></ul></div><div class="tip"><h3 class="title">Tip</h3><p>Try.</p></div>
<div class="variablelist"><dl class="variablelist"><dt id="GUC-A"><span class="term"><code>a_b</code> (<code>int</code>)</span><span class="term">a_c</span></dt><dd><p>Means a.</p>
<div class="variablelist"><dl class="variablelist"><dt><span class="term">on</span></dt><dd><p>Always.</p></dd><dt>off</dt></dl></div></dd><dt id="GUC-B">b</dt><dt id="GUC-C">c</dt><dd>Bare text.</dd><dt></dt><dd>none</dd></dl></div>
<div class="sect2" id="S"><div class="titlepage"><h3></h3></div><h3>Sub</h3><p>Under.</div></div></div></div></body></html>"""


def test_html_of_a_reference_page():
    """The manual's own markup: lists in lists, definition lists in a div of the same class, folded text, plain titles."""
    got = html.sections(MANUAL, [])
    assert [(s["title"], s["level"], s["kind"], s["anchor"]) for s in got] == [
        ("ALTER X", 1, "section", "SQL-X"), ("Synopsis", 2, "section", None), ("Parameters of a_b (int)", 2, "section", "P"),
        ("a_b (int) / a_c", 3, "parameter", "GUC-A"), ("b", 3, "parameter", "GUC-B"), ("c", 3, "parameter", "GUC-C"), ("Sub", 3, "section", "S"),
    ]
    texts = [[(b["kind"], b["text"]) for b in s["blocks"]] for s in got]
    assert texts[0] == [("prose", 'ALTER X \u2014 change "x"')] and texts[1] == [("synopsis", "```sql\nALTER X  [ y ]\n```")]
    assert texts[2] == [("prose", "See definitions. Next"), ("prose", "Loose"), ("prose", "- one\n  1. in `c`ner"), ("admonition", "Tip: Try.")] and got[2]["number"] == "3.1"
    assert texts[3] == [("prose", "Means a."), ("prose", "- on: Always.\n- off")] and texts[4] == texts[5] == [("prose", "Bare text.")] and texts[6] == [("prose", "Under.")]
    assert got[6]["path"] == ["ALTER X", "Parameters of a_b (int)", "Sub"]


def test_html_title(spark):
    df = spark.createDataFrame([("<title> A &amp; B </title>",), ("<h1>H</h1>",), ("x",)], "h string")
    assert [r[0] for r in df.select(html.html_title(F.col("h"))).collect()] == ["A & B", "H", ""]


def lines(spark, rows):
    return spark.createDataFrame([("d", *r) for r in rows], "doc string, page int, y0 double, x0 double, text string, mono boolean, heading boolean, starts_mono boolean")


def test_paragraphs_and_blocks(spark):
    rows = [(1, 10.0, 0.0, "a", False, False, False), (1, 20.0, 0.0, "b", False, False, False), (1, 50.0, 0.0, "c", True, False, True), (1, 60.0, 0.0, "d", True, False, True), (2, 10.0, 0.0, "e", True, False, True)]
    got = [r["text"] for r in layout.paragraphs(lines(spark, rows)).orderBy("paragraph").collect()]
    assert got == ["a\nb", "c\nd", "e"]
    got = [(r["kind"], r["text"]) for r in layout.blocks(lines(spark, [*rows[:2], rows[2], (1, 55.0, 0.0, "p", False, False, False), rows[3], rows[4]])).orderBy("block").collect()]
    assert got == [("prose", "a\nb\nc\np"), ("code", "d\ne")]


def test_parameters(spark):
    rows = [(1, 1.0, 0.0, "intro", False, False, False), (1, 2.0, 0.0, "work_mem (integer)", False, False, True), (1, 3.0, 0.0, "Sets it.", False, False, False), (1, 4.0, 0.0, "other_one (string)", False, False, True)]
    got = layout.split_parameters(lines(spark, rows)).collect()
    assert [(r["name"], r["type"], r["text"]) for r in got] == [("work_mem", "integer", "Sets it.")]


def test_outline(spark):
    o = spark.createDataFrame([("d", 0, 1, "A", 1), ("d", 1, 2, "B", 2), ("d", 2, 3, "C", 3), ("d", 3, 2, "D", 5), ("d", 4, 1, "E", 9)], "doc string, index long, level int, title string, page int")
    got = {r["title"]: (r["end_page"], r["path"]) for r in layout.outline_ends(o, 20).collect()}
    assert got == {"A": (9, ["A"]), "B": (5, ["A", "B"]), "C": (5, ["A", "B", "C"]), "D": (9, ["A", "D"]), "E": (20, ["E"])}
    e = layout.outline_ends(o, 20)
    assert {r["title"] for r in layout.select_roots(e).collect()} == {"A", "E"}
    assert {r["title"] for r in layout.select_roots(e, False).collect()} == {"C", "D", "E"}


def test_outline_of_fifteen_levels(spark):
    """Levels 1 to 15 below each other, a second entry of level 14, and one of level 1."""
    rows = [("m", n - 1, n, f"T{n}", n) for n in range(1, 16)] + [("m", 15, 14, "U", 16), ("m", 16, 1, "V", 18)]
    e = layout.outline_ends(spark.createDataFrame(rows, "doc string, index long, level int, title string, page int"), 20)
    got = {r["title"]: (r["end_page"], r["path"]) for r in e.collect()}
    titles = [f"T{n}" for n in range(1, 16)]
    assert got == {f"T{n}": (16 if n > 13 else 18, titles[:n]) for n in range(1, 16)} | {"U": (18, [*titles[:13], "U"]), "V": (20, ["V"])}
    assert {r["title"] for r in layout.select_roots(e).collect()} == {"T1", "V"}
    assert {r["title"] for r in layout.select_roots(e, False).collect()} == {"T15", "U", "V"}


def test_documents_of_a_layout(spark):
    o = spark.createDataFrame([("m", 0, 1, "Chapter 1. Start", 1), ("m", 1, 2, "1.1. Settings", 1), ("m", 2, 1, "Chapter 2. End", 3)], "doc string, index long, level int, title string, page int")
    t = [
        (1, 10.0, "Chapter 1. Start", False, True, False), (1, 20.0, "Opening words", False, False, False), (1, 30.0, "1.1. Settings", False, True, False), (1, 40.0, "Before all.", False, False, False),
        (1, 50.0, "work_mem (integer)", False, False, True), (1, 60.0, "Sets memory.", False, False, False), (2, 10.0, "An Extra Heading", False, True, False), (2, 20.0, "SELECT 1;", True, False, True), (2, 30.0, "SELECT 2;", True, False, True),
        (3, 10.0, "Chapter 2. End", False, True, False), (3, 20.0, "Closing words", False, False, False),
    ]
    l = spark.createDataFrame([("m", p, y, 0.0, x, m, h, s) for p, y, x, m, h, s in t], "doc string, page int, y0 double, x0 double, text string, mono boolean, heading boolean, starts_mono boolean")  # noqa: E741
    docs = {r["title"]: r for r in layout.extract_documents(l, o, 9).collect()}
    assert set(docs) == {"Start", "End"} and docs["Start"]["doc_id"] == "pdf:start:p1" and docs["Start"]["page_end"] == 3
    got = [(s["title"], s["kind"], s["anchor"], s["level"], [b["text"] for b in s["blocks"]]) for s in docs["Start"]["sections"]]
    assert got == [
        ("Start", "section", None, 1, ["Opening words"]), ("Settings", "section", None, 2, ["Before all."]), ("work_mem (integer)", "parameter", "GUC-WORK-MEM", 3, ["Sets memory."]),
        ("An Extra Heading", "section", None, 3, ["```\nSELECT 1;\nSELECT 2;\n```"]),
    ]
    assert docs["Start"]["sections"][2]["path"] == ["Start", "Settings", "work_mem (integer)"] and docs["Start"]["sections"][1]["number"] == "1.1"
    wanted = spark.createDataFrame([("settings", "start"), ("gone", None)], "key string, context string")
    only = layout.extract_documents(l, o, 9, wanted).collect()
    assert only[0]["sections"][0]["path"] == ["Settings"] and only[0]["sections"][1]["path"] == ["Settings", "work_mem (integer)"]
    assert [r["title"] for r in only] == ["Settings"] and [r["key"] for r in layout.unmatched_titles(wanted, o).collect()] == ["gone"]


def test_assign_lines(spark):
    starts = spark.createDataFrame([("d", 7, 1, 5.0), ("d", 8, 2, 1.0)], "doc string, index long, page int, y double")
    rows = [(1, 1.0, 0.0, "x", False, False, False), (1, 5.0, 0.0, "y", False, False, False), (2, 9.0, 0.0, "z", False, False, False)]
    assert {r["text"]: r["index"] for r in layout.assign_lines(lines(spark, rows), starts).collect()} == {"x": None, "y": 7, "z": 8}


def test_keys_and_fallback(spark):
    df = spark.createDataFrame([("guc-port", ["A"]), (None, ["A B", "C"]), ("", ["X", "Y", "Z"]), (None, ["C"]), (None, None)], "a string, p array<string>")
    got = [r[0] for r in df.select(consistency.candidate_keys(F.col("p"), F.col("a"))).collect()]
    assert got == [["anchor:GUC-PORT"], ["path2:ab|c", "path1:c"], ["path2:y|z"], ["path1:c"], []]


def test_char_similarity(spark):
    df = spark.createDataFrame([("abcd", "bcde"), ("create table t", "table create t"), (None, None)], "a string, b string")
    got = [r[0] for r in df.select(consistency.char_similarity("a", "b")).collect()]
    assert got == pytest.approx([0.75, 0.571429, difflib.SequenceMatcher(None, "", "").ratio()], abs=1e-6)


def test_ancestors_stop_at_cycles(spark):
    m = spark.createDataFrame([("a", "A", "b"), ("b", "B", "c"), ("c", "Docs Documentation", None), ("x", "X", "y"), ("y", "Y", "x"), ("o", "O", "gone")], "slug string, title string, parent_slug string")
    m = m.withColumns({"url": F.lit(""), "sha256": F.lit(""), "fetched_at": F.lit("2025"), "ordinal": F.lit(1)})
    got = {r["slug"]: r["ancestors"] for r in crawl.ancestor_titles(m).collect()}
    assert got["a"] == ["B"] and got["x"] == ["Y"] and got["o"] == [] and got["c"] == []


def test_crawl_order(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y"), ("y", None), ("z", None)], "slug string, next_slug string")
    got = [r["slug"] for r in crawl.crawl_order(links, ["a", "x"]).orderBy("ordinal").collect()]
    assert got == ["a", "b", "c", "x", "y"]


def test_next_links(spark):
    p = spark.createDataFrame([("a", '<a accesskey="n" href="b.html">'), ("b", '<a href="https://else.test/c" accesskey="n">'), ("c", "none")], "slug string, html string")
    assert {r["slug"]: r["next_slug"] for r in crawl.next_links(p, "https://x.test/docs").collect()} == {"a": "b.html", "b": None, "c": None}


def test_cache_embeds_each_text_once(spark):
    t = spark.createDataFrame([(1, "h1", "x"), (2, "h1", "x"), (3, "h2", "y")], "id int, content_hash string, text string")
    cache = spark.createDataFrame([("h2", [1.0, 2.0])], "content_hash string, vector array<float>")
    out, new = store.embed_with_cache(t, cache, store.random_hyperplane_embedding(2))
    assert new.count() == 1 and out.count() == 3 and {r["id"]: r["vector"] for r in out.collect()}[3] == [1.0, 2.0]


def test_layout_source(spark, tmp_path):
    span = {"bbox": [1, 2, 3, 4], "text": "work", "font": "Courier", "size": 10}
    (tmp_path / "m.json").write_text(json.dumps({"pages": [{"height": 100, "lines": [{"spans": [span, span | {"font": "Times"}]}]}]}))
    spark.dataSource.register(LayoutLines)
    got = layout.lines_of_spans(spark.read.format("layout_lines").load(str(tmp_path))).first()
    assert (got["doc"], got["text"], got["mono"], got["starts_mono"], got["heading"]) == ("m", "workwork", False, True, False)


def test_streaming_ingest_is_idempotent(spark, tmp_path):
    doc = DOC | {"sections": [section([("prose", SENTENCE * 3)])], "source_path": None, "page_end": None, "ordinal": 0}
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text(json.dumps(doc) + "\n")
    store_path, state = str(tmp_path / "store"), str(tmp_path / "state")
    for _ in range(2):
        ingest.ingest_chunks(ingest.stream_documents(spark, str(src)), store_path, state).awaitTermination()
    assert ingest.read_store(spark, store_path).count() == 1
    doc["sections"][0]["blocks"][0]["text"] = SENTENCE * 5
    (src / "b.json").write_text(json.dumps(doc) + "\n")
    ingest.ingest_chunks(ingest.stream_documents(spark, str(src)), store_path, state).awaitTermination()
    assert [r["char_count"] for r in ingest.read_store(spark, store_path).collect()] == [len("Server Configuration > Connection Settings\n\n" + (SENTENCE * 5).strip())]


def test_goldset_file(spark, tmp_path):
    (tmp_path / "g.json").write_text(json.dumps([{"question": "q", "expect_anchor": "A"}]))
    assert records.load_goldset(spark, str(tmp_path / "g.json")).count() == 1
    (tmp_path / "bad.json").write_text(json.dumps([{"question": "q"}]))
    with pytest.raises(ValueError):
        records.load_goldset(spark, str(tmp_path / "bad.json"))
    with pytest.raises(ValueError):
        records.Corpus("/x", "other")
