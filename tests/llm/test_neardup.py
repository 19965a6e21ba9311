import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from passageworks.llm import neardup
from passageworks.llm.neardup import Bands, body_words, connected_components, near_duplicate_groups, near_duplicate_pairs, signatures, trie_join

SCHEMA = "chunk_id string, text string, source_format string"


def brute(rows, j=0.8):
    docs = {}
    for i, t, g in rows:
        if i is not None and (w := frozenset(body_words(t))):
            docs.setdefault((i, g), set()).add(w)
    out = set()
    keys = list(docs)
    for x in keys:
        for y in keys:
            if x[0] < y[0] and x[1] == y[1] and any(len(a & b) >= j * len(a | b) - 1e-12 for a in docs[x] for b in docs[y]):
                out.add((x[0], y[0]))
    return out


def corpus(seed, n=160):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            base = rng.choice(rows)[1].split("\n\n", 1)[1].split()
            words = [w for w in base if rng.random() > 0.06] + [rng.choice(vocab) for _ in range(rng.randint(0, 4))]
        else:
            words = [rng.choice(vocab) for _ in range(rng.choice([1, 3, 8, 20, 60, 150]))]
        rng.shuffle(words)
        rows.append((f"c{i:03d}", "head\n\n" + (" ".join(words) or "x"), rng.choice(["html", "pdf"])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_equal_brute_force(spark, seed):
    rows = corpus(seed)
    got = {tuple(r) for r in near_duplicate_pairs(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows) and len(got) > 20


def test_heavy_tries_are_cut_without_loss(spark, monkeypatch):
    monkeypatch.setattr(neardup, "LEAVES", 12)
    rows = [(i, t, "html") for i, t, _ in corpus(3)]
    got = {tuple(r) for r in near_duplicate_pairs(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("threshold", [0.6, 0.9, 1.0])
def test_other_thresholds(spark, threshold):
    rows = corpus(4, 90)
    got = {tuple(r) for r in near_duplicate_pairs(spark.createDataFrame(rows, SCHEMA), threshold=threshold).collect()}
    assert got == brute(rows, threshold)


def test_trie_join_finds_every_pair_within_budget():
    bands, rng = Bands(0.8), random.Random(5)
    words = [[f"v{x}" for x in sorted(rng.sample(range(90), 40))] for _ in range(80)]
    words += [sorted(set(w[:-1] + [f"z{k}"])) for k, w in enumerate(words)]
    band = bands.band(40)
    sig = signatures(words, bands, neardup.Hashes())
    width = bands.width(band)
    leaf = [next(x for x in neardup.leaves(s, len(w), bands) if x[0] == band and x[1] == 0) for s, w in zip(sig, words)]
    keys = np.array([[np.int64(x[2]).view(np.uint64), *np.frombuffer(x[3], np.uint64)] for x in leaf], np.uint64)
    assert keys.shape[1] == 1 + width
    order = np.lexsort(keys.T[::-1])
    keys, sizes = keys[order], np.array([len(w) for w in words])[order]
    a, b = trie_join(keys, sizes, None, bands, band)
    got = {tuple(sorted(p)) for p in zip(a.tolist(), b.tolist())}
    want = {
        (i, j)
        for i in range(len(keys))
        for j in range(i + 1, len(keys))
        if np.bitwise_count(keys[i, 0] ^ keys[j, 0]) <= neardup.ERRORS and np.bitwise_count(keys[i, 1:] ^ keys[j, 1:]).sum() <= bands.bound(int(sizes[i] + sizes[j]))
    }
    assert got == want


def test_dirty_rows(spark):
    long = " ".join(f"word{i}" for i in range(6000))
    rows = [
        ("a", "h\n\none two three", "html"), ("a", "h\n\none two three", "html"), ("b", "x\n\nTHREE two one", "html"), ("c", "h\n\none two three", "pdf"), ("d", None, "html"), ("e", "", "html"), ("f", "no body", "html"),
        ("g", "h\n\n---", "html"), (None, "h\n\none two three", "html"), ("h", "h\n\n" + long, None), ("i", "h\n\n" + long + " extra", None), ("j", "h\n\nÉÈ one two three", "html"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"_id": F.lit(1), "_group": F.lit("z"), "similarity": F.lit(0), "_text": F.lit("t")})
    got = {tuple(r) for r in near_duplicate_pairs(df).collect()}
    assert got == {("a", "b"), ("a", "j"), ("b", "j"), ("h", "i")}
    assert near_duplicate_pairs(df.limit(0)).count() == 0
    groups = {r["chunk_id"]: (r["group_id"], r["n_links"]) for r in near_duplicate_groups(df).collect()}
    assert groups == {"a": ("a", 0), "b": ("a", 0), "j": ("a", 0), "c": ("c", 0), "h": ("h", 1), "i": ("h", 1)}


def test_components(spark):
    edges = [(f"n{i:02d}", f"n{i + 1:02d}") for i in range(0, 30)] + [("x", "y"), ("y", "x"), ("z", "z")]
    got = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(edges, "_a string, _b string")).collect()}
    assert all(got[f"n{i:02d}"] == "n00" for i in range(31)) and got["y"] == "x" and got["x"] == "x"


def test_threshold_is_checked():
    with pytest.raises(ValueError):
        Bands(0)
