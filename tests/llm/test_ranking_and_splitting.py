import random
from statistics import median

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from passageworks.llm.rankagg import CONFIGS, majority_winner, median_rank_ranking
from passageworks.llm.splitting import bisect_item, corpus_items, estimate, oversized, split_oversized

RESULT = "result_id long, run_id long, query_id long, config string, rank int, item_id string, score double, scored_at timestamp"


def results(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "result_id long, run_id long, query_id long, config string, item_id string, score double, at int").withColumn("scored_at", F.timestamp_seconds("at"))


def brute(rows):
    last = {}
    for r in rows:
        run, q, c, item, score, at = r
        if item is not None and c in CONFIGS:
            key = (run, q, c, item)
            new = (at, score is not None, score if score is not None else 0)
            if key not in last or new > last[key]:
                last[key] = new
    out = {}
    for run, q in {(k[0], k[1]) for k in last}:
        items = sorted({k[3] for k in last if k[:2] == (run, q)})
        ranks = {i: [] for i in items}
        for c, up in CONFIGS.items():
            s = {i: (last[run, q, c, i][2] if up else -last[run, q, c, i][2]) for i in items if (run, q, c, i) in last and last[run, q, c, i][1]}
            for i in items:
                ranks[i].append(sum(v > s[i] for v in s.values()) + (sum(v == s[i] for v in s.values()) + 1) / 2 if i in s else len(s) + (len(items) - len(s) + 1) / 2)
        out[run, q] = [i for i, r in sorted(ranks.items(), key=lambda x: (median(x[1]), round(sum(x[1]) / 5, 9), x[0]))]
        out[run, q, "winner"] = [i for i in items if all(sum(x < y for x, y in zip(ranks[i], ranks[j])) >= 3 for j in items if j != i)]
    return out


def test_ranking_and_winner_equal_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for run in (1, 2, None):
        for q in range(3):
            for c in [*CONFIGS, "other"]:
                for i in range(rng.randint(0, 14)):
                    rows.append((run, q, c, f"i{rng.randint(0, 15):02d}" if rng.random() > 0.03 else None, rng.choice([None, 1.0, 2.0, rng.random() * 1e6, -rng.random()]), rng.randint(0, 5)))
            for c, up in CONFIGS.items():
                if q != 1:
                    rows.append((run, q, c, "best", 1e9 if up else -1e9, 9))
    df = results(spark, rows + rows[:20]).withColumns({"position": F.lit(1), "median_rank": F.lit(0), "v": F.lit(0)})
    want = brute(rows)
    got = median_rank_ranking(df)
    by = {}
    for r in got.orderBy("position").collect():
        by.setdefault((r["run_id"], r["query_id"]), []).append(r["item_id"])
    assert by == {k: v for k, v in want.items() if len(k) == 2}
    win = {(r["run_id"], r["query_id"]): r["item_id"] for r in majority_winner(got, ["run_id", "query_id"], list(CONFIGS), 3).collect()}
    assert win == {k[:2]: v[0] for k, v in want.items() if len(k) == 3 and v} and "best" in win.values()


def test_scale_does_not_matter(spark):
    rows = [(1, 1, c, i, float(s), 0) for c, up in CONFIGS.items() for i, s in (("a", 3), ("b", 2), ("c", 1))]
    grown = [(a, b, c, i, s * 1e12 if c == "bm25" else s, t) for a, b, c, i, s, t in rows]
    f = lambda r: [x["item_id"] for x in median_rank_ranking(results(spark, r)).orderBy("position").collect()]
    assert f(rows) == f(grown)


def test_empty_and_weights(spark):
    df = results(spark, [(1, 1, "dense", "a", 1.0, 0), (1, 1, "dense", "b", 2.0, 0), (1, 1, "bm25", "a", 9.0, 0)])
    assert median_rank_ranking(df.limit(0)).count() == 0
    only = median_rank_ranking(df, weights={c: float(c == "dense") for c in CONFIGS}).orderBy("position").first()
    assert only["item_id"] == "b"
    with pytest.raises(ValueError):
        median_rank_ranking(df, weights=dict.fromkeys(CONFIGS, 0.0))


def rebuilt(blocks, pieces):
    text = "".join(b or "" for b in blocks)
    return "".join(text[a:b] for _, a, b, _ in pieces)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab. \n,é漢", min_size=0, max_size=900) | st.none(), max_size=6), st.integers(40, 90))
def test_pieces_lose_nothing_and_fit(blocks, limit):
    pieces = bisect_item(blocks, limit)
    total = sum(estimate(len(b or "")) for b in blocks)
    assert bool(pieces) == (total > limit)
    if pieces:
        assert rebuilt(blocks, pieces) == "".join(b or "" for b in blocks)
        assert all(t <= limit for *_, t in pieces)
        assert all(s <= a < b for s, a, b, _ in pieces) and all(x[2] == y[1] for x, y in zip(pieces, pieces[1:]))


def test_cuts_at_the_strongest_boundary():
    text = ("First sentence here. " * 20).strip() + "\n\n" + ("Second part goes on. " * 20).strip()
    (_, _, end, _), *_ = bisect_item([text], 150)
    assert text[:end].endswith("\n\n")
    words = bisect_item(["word " * 400], 100)
    assert all("word " * 400 != "" and ("word " * 400)[a - 1] == " " for _, a, _, _ in words[1:])
    solid = bisect_item(["x" * 3000], 100)
    assert rebuilt(["x" * 3000], solid) == "x" * 3000


def test_overlap_is_near_its_share():
    pieces = bisect_item(["Some words make a sentence of usual length, more or less. " * 300], 512)
    shares = [(a - s) / 4 for s, a, _, _ in pieces[1:]]
    assert all(0 < x <= 61 for x in shares) and sum(shares) / len(shares) > 40


def test_items(spark):
    chunk = spark.createDataFrame([("a", "x " * 1025, 1), ("a", "x " * 1025, 2), ("b", "y" * 2048, 3), ("c", None, 4), ("d", "", 5), (None, "z" * 9000, 6)], "chunk_id string, text string, item_key int")
    block = "struct<kind string, text string, lang string>"
    rows = [(1, [("prose", "q" * 1021, None), ("prose", None, None), ("code", "r" * 1021, None), ("p", "s", None)]), (2, []), (3, None), (4, [("p", "t" * 2000, None)])]
    section = spark.createDataFrame(rows, f"section_id long, blocks array<{block}>")
    assert sorted(map(tuple, oversized(chunk, section).collect())) == [("chunk", "a"), ("section", "1")]
    got = split_oversized(corpus_items(chunk, section)).orderBy("item_type", "piece_no").collect()
    assert "".join(r["text"][r["overlap_chars"] :] for r in got if r["item_key"] == "a") == "x " * 1025
    assert all(r["token_count"] <= 512 for r in got)
    assert oversized(chunk.limit(0), section.limit(0)).count() == 0
