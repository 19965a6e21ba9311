import random

import pytest
from pyspark.sql import functions as F

from passageworks.llm import boilerplate, leakage, matching, mixing, truncation


# Leakage


def test_words():
    assert leakage.words("> **Bold** `x_y` con-\n> tinued ﬁne d­a​ta <b>tag</b>ged [link](http://x.y) &amp; _it_") == ["bold", "x_y", "continued", "fine", "data", "tagged", "link", "it"]
    assert leakage.words(None) == [] and leakage.words("") == []


def test_leaks_equal_brute_force(spark):
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(40)]
    gold = [(i, " ".join(rng.choices(vocab, k=rng.choice([5, 10, 14]))), " ".join(rng.choices(vocab, k=30))) for i in range(12)] + [(99, None, ""), (3, "same id " + "z " * 12, None)]
    docs = []
    for i in range(120):
        w = rng.choices(vocab, k=rng.randint(0, 60))
        if rng.random() < 0.5:
            src = rng.choice(gold[:12])[rng.choice([1, 2])].split()
            n = rng.choice([8, 9, 10, 15])
            at = rng.randint(0, max(0, len(src) - n))
            w[len(w) // 2 : len(w) // 2] = src[at : at + n]
        docs.append((i, rng.choice([" ", "\n> ", "  ", ", "]).join(w).upper()))
    docs += [(500, None), (501, ""), (500, None), (None, gold[0][2])]
    g = {}
    for q, a, b in gold:
        for t in (a, b):
            g.setdefault(q, set()).update(leakage.shingles(t, 10))
    want = {(d, q) for d, t in docs for q, s in g.items() if s & set(leakage.shingles(t, 10))}
    ddf = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"_d": F.lit(1), "_t": F.lit("x"), "query_id": F.lit(5)})
    gdf = spark.createDataFrame(gold, "query_id long, question string, passage string")
    assert {tuple(r) for r in leakage.leaked_items(ddf, gdf).collect()} == want and len(want) > 20
    assert {tuple(r) for r in leakage.leaked_items(ddf.repartition(9), gdf).collect()} == want
    assert leakage.leaked_items(ddf, gdf.limit(0)).count() == 0 and leakage.leaked_items(ddf.limit(0), gdf).count() == 0


# Truncation


@pytest.mark.parametrize(
    ("text", "state"),
    [
        ("All is well.", "complete"), ("Two words. The thi", "cut"), ("Is it?", "complete"), (None, "complete"), ("  ", "complete"), ("Done.\n\n-- \nab", "complete"), ("Fine\n\nthanks", "complete"),
        ("A.\n\n```sql\nSELECT 1;\n```", "complete"), ("A.\n\n```sql\nSELECT 1", "cut"), ("A.\n\n| a | b |\n| c | d |", "complete"), ("A.\n\n| a | b |\n| c | d", "cut"), ("A.\n\n| a | b |\n| c |", "cut"),
        ("A. More [...]", "cut"), ("A. Mor…", "cut"), ("More on this in the next chapter...", "complete"), ("A. (X is unaffected)", "complete"), ("A.\n\nEnd of section 25", "complete"), ("A.\n\nSee https://a.example/b", "complete"),
        ("- Long entries end here.\n- Another one begins with wo", "cut"), ("Set.\n\n- red things\n- blue things", "bare"), ("A.\n\nTags: one, two three", "bare"), ("Text &am", "cut"), ("/* note. */", "complete"), ("x.\n\nstatic int a;", "complete"),
        ("Set `a_b", "cut"), ("日本語です。", "complete"), ("日本語で", "cut"), ("A.\n\n    flag = 40", "complete"), ("Same for files etc.", "complete"),
    ],
)
def test_endings(text, state):
    got = truncation.ending(text)[0]
    assert got == state or (state == "cut" and text == "日本語で" and got in ("cut", "bare"))


def test_strict_prefixes_equal_brute_force(spark):
    rng = random.Random(2)
    vals = ["".join(rng.choices("ab", k=rng.randint(0, 9))) for _ in range(300)] + [None, "", "é", "éa", "漢", "漢字"]
    df = spark.createDataFrame([(v,) for v in vals], "x string").withColumn("v", F.lit("clash")).repartition(7)
    s = {v for v in vals if v}
    want = {v for v in s if any(x != v and x.startswith(v) for x in s)}
    got = truncation.strict_prefixes(df, "x").collect()
    assert {r["v"] for r in got} == want and len(got) == len(want) and all(r["longer"].startswith(r["v"]) and r["longer"] != r["v"] for r in got)
    assert truncation.strict_prefixes(df.limit(0), "x").count() == 0


def test_truncation_evidence(spark):
    rows = [
        (1, "Set.\n\n- red things\n- blue elephan", "a"), (2, "Talk of red things and blue elephants here.", "a"), (3, "Set.\n\n- red things\n- blue elephants", None), (4, None, "b"), (None, "x", "b"),
        (5, "The text goes on and st", "b"), (6, "The text goes on and stops.", "b"), (6, "The text goes on and stops.", "b"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"state": F.lit("x"), "_w": F.lit(1)})
    e = truncation.truncation_evidence(df)
    by = {r["doc_id"]: r for r in e.collect()}
    assert {d for d, r in by.items() if r["truncated"]} == {1, 5} and by[1]["word_cut"] and by[5]["has_longer_copy"] and e.count() == 7
    rates = {r["source"]: (r["n_docs"], r["n_truncated"]) for r in truncation.truncation_rates(e).collect()}
    assert rates == {"a": (2, 1), None: (1, 0), "b": (4, 1)}
    assert truncation.truncation_evidence(df.limit(0)).count() == 0


def test_word_cut_of_copies_and_at_scale(spark):
    """A cut text collected again counts once; a fragment in several texts is one beside a far more frequent longer word, a word is not."""
    cut = "Set.\n\n- red things\n- blue elephan"
    rows = [(1, cut), (2, cut.replace("\n", "  \n").upper()), (3, "Blue elephants here."), (4, "Set.\n\n- red things\n- many rep"), (5, "Set.\n\n- more things\n- the rep"), (6, "Set.\n\n- red things\n- blue tabl")]
    rows += [(100 + i, f"The replica {i} of a table.") for i in range(60)] + [(200 + i, f"The tables {i} of it.") for i in range(60)] + [(300, "Set.\n\n- red things\n- blue table")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("a"))
    by = {r["doc_id"]: r for r in truncation.truncation_evidence(df).collect()}
    assert {d for d, r in by.items() if r["truncated"]} == {1, 2, 4, 5, 6} and not by[300]["word_cut"]
    rates = truncation.truncation_rates(truncation.truncation_evidence(df)).first()
    assert (rates["n_docs"], rates["n_truncated"]) == (len(rows), 5)


def test_texts_written_without_stops_and_proven_cuts(spark):
    """A text with a sentence a line and no stops is complete unless its last word never ends a sentence; a strict prefix is truncated."""
    line = "whenever the red engine of the second ferry turns for more than a minute the captain of the harbour writes"
    rows = [(1, f"Hi,\n\n{line} it\n{line} a report"), (2, f"Hi,\n\n{line} it\n{line} a rep"), (3, f"Hi,\n\n{line} it\n{line} the"), (4, "All is well."), (5, "All is well. And more is to come."), (6, "All  is\nWELL.")]
    rows += [(100 + i, f"The captain {i} of the ferry wrote a report. He did the job.") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("a"))
    by = {r["doc_id"]: r for r in truncation.truncation_evidence(df).collect()}
    assert {d for d, r in by.items() if r["truncated"]} == {2, 3, 4, 6} and by[1]["state"] == "stopless" and by[4]["has_longer_copy"]
    wrapped = "a long sentence that was wrapped at a width of forty characters or so and\nthen goes on over the next line and is\ncut off in the mid"
    assert truncation.ending(wrapped)[0] == "cut" and truncation.ending(f"{line}\n{line}. It")[0] == "cut"


# Mixing

TARGET = "source string, target_share double, max_repeats int"


def test_mixture(spark):
    rng = random.Random(4)
    docs = [(i, "word " * rng.randint(1, 40), rng.choice(["big", "big", "big", "mid"])) for i in range(900)] + [(5000 + i, "word " * 20, "small") for i in range(6)] + [(7000, None, "big"), (7001, "", "mid"), (7002, "x", "unlisted"), (7003, "x", None), (None, "x", "big"), (3, "word", "mid")]
    ddf = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("tokens", F.lit(1))
    tdf = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.15, 4), ("none", 0.05, 3), (None, 0.1, 1)], TARGET)
    mix = mixing.Mixture(ddf, tdf)
    got = mix.copies().collect()
    limit = {"big": 1, "mid": 2, "small": 4}
    assert len({r["doc_id"] for r in got}) == len(got) and all(1 <= r["copies"] <= limit[r["source"]] for r in got)
    rep = {r["source"]: r for r in mix.report().collect()}
    assert rep["none"]["tokens"] == 0 and rep["small"]["most_copies"] == 4
    for s, share in (("big", 0.5), ("mid", 0.3), ("small", 0.15)):
        assert rep[s]["reached_share"] == pytest.approx(share / 0.95, abs=0.02)
    again = mixing.Mixture(ddf.repartition(9), tdf).copies()
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in got}
    large = {r["source"]: r for r in mixing.Mixture(ddf, tdf, total_tokens=10**9).report().collect()}
    assert large["small"]["tokens"] == 4 * large["small"]["have_tokens"] and large["small"]["reached_share"] < 0.15
    assert mixing.Mixture(ddf.limit(0), tdf).copies().count() == 0 and mixing.Mixture(ddf, tdf.limit(0)).report().count() == 0


def test_inclusion_follows_the_fraction(spark):
    docs = spark.createDataFrame([(i, "word word word", "s") for i in range(4000)], "doc_id long, text string, source string")
    t = spark.createDataFrame([("s", 1.0, 3)], TARGET)
    have = mixing.Mixture(docs, t).report().first()["have_tokens"]
    got = mixing.Mixture(docs, t, total_tokens=int(have * 1.25)).copies().groupBy("copies").count().collect()
    assert {r["copies"]: r["count"] for r in got} == {1: 3000, 2: 1000}


def test_pareto_order_follows_size(spark):
    """Long documents are drawn more often: inclusion over many seeds is proportional to size, certain ones are always in, and the
    order differs from that of the random numbers alone."""
    sizes = [1] * 150 + [4] * 100 + [400]
    docs = spark.createDataFrame([(i, "word " * n, "s") for i, n in enumerate(sizes)], "doc_id long, text string, source string")
    t = spark.createDataFrame([("s", 1.0, 3)], TARGET)
    first = mixing.Mixture(docs, t)
    have = first.report().first()["have_tokens"]
    mix = mixing.Mixture(docs, t, total_tokens=int(have * 1.6))
    p = {r["doc_id"]: r["p"] for r in mix.inclusion().collect()}
    tokens = {r["doc_id"]: r["tokens"] for r in mix.inclusion().collect()}
    assert p[250] == 1 and p[200] / p[0] == pytest.approx(tokens[200] / tokens[0])
    assert sum(p[d] * tokens[d] for d in p) == pytest.approx(have * 0.6, rel=0.01)
    drawn = dict.fromkeys(p, 0)
    for seed in range(12):
        mix.seed = seed
        got = {r["doc_id"]: r["copies"] for r in mix.copies().collect()}
        assert set(got.values()) <= {1, 2} and abs(sum(tokens[d] * (c - 1) for d, c in got.items()) - have * 0.6) <= 3
        for d, c in got.items():
            drawn[d] += c - 1
    assert drawn[250] == 12
    mean = lambda ds: sum(drawn[d] for d in ds) / len(ds) / 12
    assert mean(range(150)) == pytest.approx(p[0], abs=0.05) and mean(range(150, 250)) == pytest.approx(p[200], abs=0.06)


# Matching


def test_matching(spark):
    rng = random.Random(6)
    vocab = [f"term{i}" for i in range(400)]
    rows, want = [], set()
    for i in range(60):
        words = rng.choices(vocab, k=60)
        title = f"Part {chr(65 + i % 26)}{chr(97 + i // 26)} Overview"
        html = " ".join(words)
        wrapped = "\n".join(" ".join(words[k : k + 9]) for k in range(0, 60, 9)).replace("term1", "te-\nrm1", 1)
        rows.append((f"h{i:02d}", f"Book > {title}\n\n{html}", "html", "18", ["Book", title], None if i % 3 else f"A-{i}"))
        if i % 4:
            rows.append((f"p{i:02d}", f"Chapter 3. Book > 3.{i}. {title}\n\n{wrapped}", "pdf", "18" if i % 5 else "17", ["Chapter 3. Book", f"3.{i}. {title}"] if i % 7 else None, None))
            if i % 5:
                want.add((f"h{i:02d}", f"p{i:02d}"))
    rows += [("h90", None, "html", "18", None, None), ("p90", "", "pdf", None, [], ""), (None, "x\n\ny", "pdf", "18", None, None), rows[0], rows[1]]
    sib = " ".join(rng.choices(vocab, k=60))
    rows += [("h91", f"B > a (int)\n\n{sib} a", "html", "18", ["B", "a (int)"], "GUC-A"), ("p92", f"B > b (int)\n\n{sib} b", "pdf", "18", ["B", "b (int)"], "GUC-B"), ("h92", f"B > b (int)\n\n{sib} b", "html", "18", ["B", "b (int)"], None)]
    want.add(("h92", "p92"))
    df = spark.createDataFrame(rows, "chunk_id string, text string, source_format string, pg_version string, section_path array<string>, section_anchor string").withColumns({"id": F.lit(1), "side": F.lit("x"), "p": F.lit(2)})
    got = matching.matched_chunks(df).collect()
    assert {(r["chunk_id_a"], r["chunk_id_b"]) for r in got} == want and all(0.5 <= r["confidence"] <= 1 for r in got)
    assert matching.matched_chunks(df.limit(0)).count() == 0


def test_keys_of_any_size_lose_no_pair_with_compatible_titles(spark, monkeypatch):
    """Pairs meet unless two known titles differ, whether keys are large (here of over 4 pairs) or not, and no possible match is left out."""
    stock = " ".join(f"stock{i}" for i in range(9))
    titles = [None, None, "Red Gadgets", "Red Gadg...", "Red Gizmos", "Blue", "Re...", "3.1. Blue", "Blue Whales", "Blue…"]
    paths = [t and [f"Parent {k % 3}", t] for k, t in enumerate(titles)]
    rows = [(f"{side}{k}", f"x\n\n{stock}", side, "18", p, None) for side in ("html", "pdf") for k, p in enumerate(paths)]
    df = spark.createDataFrame(rows, "chunk_id string, text string, source_format string, pg_version string, section_path array<string>, section_anchor string")
    prof = matching.profiles(df, ("html", "pdf"))
    ids = {r["hid"]: (r["id"], r["title"]) for r in prof.collect()}
    pairs = lambda: {(ids[r["ha"]], ids[r["hb"]]) for r in matching.candidates(prof, ("html", "pdf")).collect()}
    edges = lambda of: {(r["a"], r["b"], round(r["logit"], 9)) for r in matching.weights(prof, of, ("html", "pdf")).collect()}
    every = [(x, y) for x in ids.values() for y in ids.values() if x[0][0] == "h" and y[0][0] == "p"]
    hids = {i: h for h, (i, _) in ids.items()}
    whole = edges(spark.createDataFrame([(hids[x[0]], hids[y[0]]) for x, y in every], "ha long, hb long"))
    cut = lambda x, y: len(x) > 4 and x.endswith("*") and y.startswith(x[:-1])
    want = {(a, b) for a, b in every if not a[1] or not b[1] or a[1] == b[1] or cut(a[1], b[1]) or cut(b[1], a[1])}
    assert len(want) < len(every)
    for hot in (400, 2):
        monkeypatch.setattr(matching, "CELL", hot)
        assert want <= pairs() and {e for e in whole if e[2] > -1} <= edges(matching.candidates(prof, ("html", "pdf")))


def test_propagation_on_a_small_graph(spark):
    """Marginals of the one-to-one model on a path of three edges, a tree, where belief propagation is exact."""
    import math

    w = {("a", "x"): 2.0, ("b", "x"): 3.0, ("b", "y"): 0.5}
    edges = spark.createDataFrame([(a, b, math.log(v)) for (a, b), v in w.items()], "a string, b string, logit double")
    states = [(), *[(e,) for e in w], (("a", "x"), ("b", "y"))]
    weight = [math.prod(w[e] for e in s) for s in states]
    want = {e: sum(x for s, x in zip(states, weight) if e in s) / sum(weight) for e in w}
    got = {(r["a"], r["b"]): r["p"] for r in matching.propagate(edges, eps=1e-6).collect()}
    assert all(got[e] == pytest.approx(want[e], abs=1e-3) for e in w)


# Page bodies


def test_lcs_equals_brute_force():
    rng = random.Random(7)
    for _ in range(60):
        a, b = rng.choices("abcd", k=rng.randint(0, 12)), rng.choices("abcde", k=rng.randint(0, 12))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
        got = boilerplate.lcs(a, b)
        assert len(got) == t[-1][-1] and all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(sorted(got), sorted(got)[1:]))


def test_pages(spark):
    blocks, manifest, want = [], [], set()
    n = 0
    said = lambda i: "".join(chr(97 + (i * i + 7 * k) % 26) for k in range(3 + i % 5))
    for site, count in (("one.test", 6), ("two.test", 5), ("three.test", 4), ("solo.test", 1)):
        for k in range(count):
            slug = f"{site}-{k}"
            title = f"Using {['Red', 'Green', 'Blue', 'Pink', 'Gray', 'Gold'][k]} Gadgets"
            manifest += [(slug, f"https://{site}/docs/p{k}.html", title, "2025-01-02"), (slug, f"https://{site}/docs/p{k}.html", "Old Title Here", "2024-01-01")]
            page = [
                ("Toggle menu\nHome\nDownload", [1, 2, 3]), (title, []), (f"Notes\nThis page {said(n)} says {said(n + 1)} about the {said(n + 2)}, in full.", []), (f"Rate this article: 1 2 3 ({k * 31} votes)", [1]),
                (f"Another {said(n)} fact about {said(n + 3)} stands here {said(n + 4)} as prose.", []), ("Related topics\nManaging Big Boxes\nUsing Tiny Tools", [1, 2, 3]), (f"Copyright 2010-20{10 + k} Some Project. All rights reserved.", [1]), ("", []),
            ]
            for o, (text, bad) in enumerate(page):
                url = None if o % 3 == 2 else f"HTTP://{site.upper()}/docs/p{k}.html#top"
                blocks.append((n, slug, url, o, text))
                want |= {(n, i) for i in bad}
                n += 1
    blocks += [blocks[0], (n, "orphan", None, 0, None), (n + 1, "orphan", None, 1, "A line of its own that nothing shares.")]
    bdf = spark.createDataFrame(blocks, "block_id long, slug string, url string, block_ord int, text string").withColumns({"host": F.lit("x"), "tpl": F.lit("y"), "line": F.lit(1)})
    mdf = spark.createDataFrame(manifest, "slug string, url string, title string, fetched_at string").withColumn("path", F.lit(1))
    got = {tuple(r) for r in boilerplate.furniture_lines(bdf, mdf).collect()}
    assert got == want
    body = {r["slug"]: r["body"] for r in boilerplate.body_text(bdf, mdf).collect()}
    assert body["one.test-0"].startswith("Using Red Gadgets\nNotes\nThis page ") and body["orphan"].startswith("A line")
    assert boilerplate.furniture_lines(bdf.limit(0), mdf.limit(0)).count() == 0


def test_link_entries_of_two_sites_count_among_many(spark):
    """Menu rows of single-page sites whose entries stand on two of 320 sites; a row with any other word stays."""
    shared = ["Home", "News", "Zebra Shop"]
    blocks, manifest = [], []
    for i in range(320):
        name = "".join(chr(97 + (i // 26**k) % 26) for k in range(3))
        blocks.append((i, f"s{i}", f"https://{name}.test/a", 1, f"The site {name}{name} tells about its {name}x matters, in full."))
        if i < 40:
            blocks.append((1000 + i, f"s{i}", f"https://{name}.test/a", 0, "Home\nNews"))
        manifest.append((f"s{i}", f"https://{name}.test/a", None, "2025-01-01"))
    for k, at in enumerate(("x.test", "x.test", "y.test", "y.test")):
        blocks += [(400 + k, f"t{k}", f"https://{at}/{k}", 0, "Zebra Shop | Home"), (410 + k, f"t{k}", f"https://{at}/{k}", 1, f"Page {'abcd'[k] * 5} is its own here.")]
    blocks += [(500, "solo", "https://solo.test/a", 0, " | ".join(shared)), (501, "solo", "https://solo.test/a", 1, "Home | News | Lion Shop"), (502, "solo", "https://solo.test/a", 2, "Home News Zebra Shop")]
    bdf = spark.createDataFrame(blocks, "block_id long, slug string, url string, block_ord int, text string")
    mdf = spark.createDataFrame(manifest, "slug string, url string, title string, fetched_at string")
    got = {tuple(r) for r in boilerplate.furniture_lines(bdf, mdf).collect()}
    assert {(500, 1), (502, 1)} <= got and (501, 1) not in got


def test_neighbours_meet_across_partitions(spark):
    """Sites of two pages, in more partitions than there are pages: what the two share is found wherever a partition ends."""
    blocks, manifest, want = [], [], set()
    word = lambda i: "".join(chr(97 + (i // 26**k) % 26) for k in range(3))
    for i in range(24):
        slug, url = f"s{i}", f"https://{word(i // 2)}.test/{i}"
        manifest.append((slug, url, None, "2025-01-01"))
        blocks += [(2 * i, slug, url, 0, f"Run by {word(i // 2)}{word(i // 2)} and friends"), (2 * i + 1, slug, url, 1, f"Page {word(i)}x{word(i + 50)} is its own here.")]
        want.add((2 * i, 1))
    bdf = spark.createDataFrame(blocks, "block_id long, slug string, url string, block_ord int, text string")
    mdf = spark.createDataFrame(manifest, "slug string, url string, title string, fetched_at string")
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "30"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert {tuple(r) for r in boilerplate.furniture_lines(bdf, mdf).collect()} == want
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
