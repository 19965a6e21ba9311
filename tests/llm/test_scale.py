"""Cases that only show at a size: long pages, many copies, hot keys, partitions."""

import random

import pytest
from pyspark.sql import functions as F

from passageworks.llm import boilerplate, matching, rankagg

BLOCKS = "block_id long, slug string, url string, block_ord int, text string"
PAGES = "slug string, url string, title string, fetched_at string"


def letters(i, n=4):
    return "".join(chr(97 + (i * 7 // 26**k + i) % 26) for k in range(n)) + chr(97 + i % 26)


def lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = row[:]
        for j, y in enumerate(b):
            row[j + 1] = old[j] + 1 if x == y else max(old[j + 1], row[j])
    return row[-1]


def test_lcs_of_long_pages(monkeypatch):
    """Halving long pages gives as long a sequence; an insertion of any length shifts nothing."""
    rng = random.Random(3)
    for limit in (1, 40, 10**6):
        monkeypatch.setattr(boilerplate, "STATE_BITS", limit)
        for _ in range(25):
            a, b = rng.choices("abcdef", k=rng.randint(0, 40)), rng.choices("abcdef", k=rng.randint(0, 40))
            got = boilerplate.lcs(a, b)
            assert len(got) == lcs_length(a, b) and all(a[i] == b[j] for i, j in got)
            assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))
    a = list(range(9000))
    b = [-1, *a[:10], *range(20_000, 24_000), *a[10:]]
    assert len(boilerplate.lcs(a, b)) == 9000


def test_mirrors_and_quotations_are_no_furniture(spark):
    """A one-page manual mirrored on five hosts keeps all its lines, and a sentence quoted on single pages of large sites stays; a
    notice of the same number of single-page sites goes."""
    blocks, manifest, n = [], [], 0

    def page(host, path, *lines):
        nonlocal n
        slug = f"{host}{path}"
        manifest.append((slug, f"https://{host}{path}", None, "2025-01-01"))
        for o, line in enumerate(lines):
            blocks.append((n, slug, f"https://{host}{path}", o, line))
            n += 1
        return n - len(lines)

    manual = ["The flux valve closes when the tide is high.", "It opens again as soon as the moon has set behind the eastern hills of the bay.", "Nobody has seen it stuck."]
    mirrors = [page(f"mirror{letters(i)}.test", "/m", *manual) for i in range(5)]
    quote, quoted, notices = "A wise engineer measures twice.", [], []
    for i in range(5):
        for k in range(6):
            own = f"The {letters(9 * i + k)} of {letters(50 + 9 * i + k)} is told here at length, as it must."
            at = page(f"big{letters(i)}.test", f"/{k}", *([own, quote, f"More on {letters(90 + 9 * i + k)} there."] if k == 3 else [own, f"More on {letters(90 + 9 * i + k)} there."]))
            quoted += [at + 1] if k == 3 else []
    for i in range(5):
        notices.append(page(f"solo{letters(i)}.test", "/a", "We keep crumbs of your visit", f"All about the {letters(200 + i)}{letters(i)} can be read in these very words."))
    got = {tuple(r) for r in boilerplate.furniture_lines(spark.createDataFrame(blocks, BLOCKS), spark.createDataFrame(manifest, PAGES)).collect()}
    assert got == {(b, 1) for b in notices} and mirrors and quoted


@pytest.mark.parametrize("hot", [2_000, 2])
def test_equal_at_any_number_of_partitions(spark, monkeypatch, hot):
    """Sites of many pages; the same rows at 2 and at 50 partitions, and with common templates joined either way."""
    monkeypatch.setattr(boilerplate, "HOT_LINES", hot)
    rng = random.Random(5)
    blocks, manifest, n = [], [], 0
    for s in range(4):
        for k in range(14):
            slug, url = f"{s}-{k}", f"https://{letters(s)}.test/{k:02d}"
            manifest.append((slug, url, None, "2025-01-01"))
            for o in range(4):
                text = f"Served by {letters(s)} since 20{k}" if o == 3 and rng.random() < 0.7 else f"A {letters(rng.randint(0, 9999))} {letters(rng.randint(0, 9999))} line."
                blocks.append((n, slug, url, o, text))
                n += 1
    b, m = spark.createDataFrame(blocks, BLOCKS), spark.createDataFrame(manifest, PAGES)
    found = []
    for parts in ("2", "50"):
        conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": parts}
        old = {k: spark.conf.get(k) for k in conf}
        for k, v in conf.items():
            spark.conf.set(k, v)
        try:
            found.append({tuple(r) for r in boilerplate.furniture_lines(b, m).collect()})
        finally:
            for k, v in old.items():
                spark.conf.set(k, v)
    assert found[0] == found[1] and len(found[0]) > 20


def test_one_long_page(spark):
    """A page of thousands of lines beside a short one: all that they share is found, in order."""
    def rows(slug, lines, base):
        return [(base + i, slug, f"https://a.test/{slug}", i, x) for i, x in enumerate(lines)]

    foot = [f"foot {letters(i, 5)}" for i in range(40)]
    a = [f"own {letters(i, 6)}{i % 7 * 'x'}" for i in range(3000)]
    blocks = rows("p1", [*a[:1500], *foot[:20], *a[1500:], *foot[20:]], 0) + rows("p2", foot, 100_000)
    m = spark.createDataFrame([("p1", None, None, None)], PAGES)
    got = {r["block_id"] for r in boilerplate.furniture_lines(spark.createDataFrame(blocks, BLOCKS).withColumn("key", F.lit(1)), m).collect()}
    assert got == {b[0] for b in blocks if b[4] in foot}


# Matching

CHUNKS = "chunk_id string, text string, source_format string, pg_version string, section_path array<string>, section_anchor string"
SIDES = ("html", "pdf")


def test_copies_of_a_passage_are_one_node(spark):
    """450 x 450 records of one stock passage: one node for the untitled copies, an edge to each title, and no pair is lost or emitted twice."""
    stock = " ".join(f"stock{i}" for i in range(30))
    rows = [(f"h{i}", f"x\n\n{stock}", "html", "18", ["Book", f"Title {letters(i)}{i}"], None) for i in range(450)]
    rows += [(f"p{i}", f"x\n\n{stock}", "pdf", "18", None, None) for i in range(450)]
    prof = matching.profiles(spark.createDataFrame(rows, CHUNKS), SIDES).cache()
    same = matching.copied(prof)
    assert same.count() == 450 and {r["copies"] for r in same.select("copies").distinct().collect()} == {450}
    pairs = matching.candidates(prof, SIDES, same)
    assert pairs.count() == 450
    assert matching.matched_chunks(spark.createDataFrame(rows, CHUNKS)).count() == 0


def test_copies_send_as_many_messages(spark):
    """A node of n copies gives each pair the marginal that n single records give it."""
    w = 1.7
    single = spark.createDataFrame([("a", f"x{i}", w) for i in range(5)] + [("b", f"x{i}", w / 2) for i in range(5)], "a string, b string, logit double")
    classed = spark.createDataFrame([("a", "x", w, 1, 5), ("b", "x", w / 2, 1, 5)], "a string, b string, logit double, copies_a long, copies_b long")
    one = {(r["a"], r["b"]): r["p"] for r in matching.propagate(single, eps=1e-7).collect()}
    all_ = {(r["a"], r["b"]): r["p"] for r in matching.propagate(classed, eps=1e-7).collect()}
    assert all(abs(p - all_[a, "x"]) < 1e-5 for (a, _), p in one.items()) and len(all_) == 2


def test_unsettled_marginals_are_no_result(spark):
    edges = spark.createDataFrame([("a", "x", 9.0), ("b", "x", 9.0), ("b", "y", 9.0), ("a", "y", 9.0)], "a string, b string, logit double")
    with pytest.raises(RuntimeError):
        matching.propagate(edges, rounds=1, eps=1e-12)


def test_large_heading_stays_near_linear(spark):
    """500 x 500 records under one heading: the same matches as without the layout for large headings, from few pairs."""
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(3000)]
    rows, want = [], set()
    for i in range(500):
        words = rng.choices(vocab, k=40)
        rows.append((f"h{i}", "x\n\n" + " ".join(words), "html", "18", ["Book", "Notes"], None))
        # The pdf side has half of the passage, with an edit in each eight words, and text of its own.
        part = [("zz" if k % 7 == 6 else x) for k, x in enumerate(words[:24])] + rng.choices(vocab, k=16)
        rows.append((f"p{i}", "x\n\n" + " ".join(part), "pdf", "18", ["Book", "Notes"], None))
        want.add((f"h{i}", f"p{i}"))
    df = spark.createDataFrame(rows, CHUNKS)
    prof = matching.profiles(df, SIDES).cache()
    pairs = matching.candidates(prof, SIDES)
    ids = {r["hid"]: r["id"] for r in prof.select("hid", "id").collect()}
    got = {(ids[r["ha"]], ids[r["hb"]]) for r in pairs.collect()}
    assert want <= got and len(got) < 10_000


# One ranking


@pytest.mark.parametrize("small", [3, 20_000])
def test_large_groups_rank_alike(spark, monkeypatch, small):
    """Groups that are ranked in ranges have the ranking and the winner of those that are not; ties, nulls and null keys included."""
    rng = random.Random(9)
    rows = []
    for run, n in ((1, 40), (2, 3), (None, 25)):
        for c in rankagg.CONFIGS:
            rows += [(len(rows) + i, run, 7, c, f"i{rng.randint(0, n)}", rng.choice([None, float("nan"), 0.0, -0.0, 1.0, rng.random()]), 5) for i in range(n)]
            rows.append((10_000 + len(rows), run, 7, c, "best", 1e6 if rankagg.CONFIGS[c] else -1e6, 9))
    df = spark.createDataFrame(rows, "result_id long, run_id long, query_id long, config string, item_id string, score double, at int").withColumn("scored_at", F.timestamp_seconds("at"))
    want = None
    for s in (20_000, small):
        monkeypatch.setattr(rankagg, "SMALL", s)
        r = rankagg.median_rank_ranking(df)
        won = rankagg.majority_winner(r, ["run_id", "query_id"], list(rankagg.CONFIGS), 3)
        got = sorted(map(str, r.drop("ranks").collect())), sorted(map(str, won.collect()))
        assert len(got[1]) == 3 and (want is None or want == got)
        want = got
