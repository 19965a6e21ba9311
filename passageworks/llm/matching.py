"""Match records of two sources without a common key: loopy belief propagation over candidate pairs.

Records that give the same evidence (side, part, text shingles, titles, anchor) are one class with a number of copies, exactly, so stock passages
do not multiply. Candidates share a block: one of the SKETCH smallest hashes of a text's long word shingles, or its last title with the title before
it; and their last titles can agree. Under a heading of many records, pairs must also share a short shingle, without which no edge has weight. Each candidate edge gets log odds from partial, noisy evidence: shared shingles of the whole texts, the
last title, the anchor, and the rest of the section path. One-to-one factors (a record has at most one partner) turn the edges into a graph
model; messages m(i->j) = 1 / (1 + sum over k != j of w(i,k) m(k->i)) are exchanged through joins until they settle (copies of a class
send and get equal messages, so a class counts as often as it has copies), and
p = w m(i->j) m(j->i) / (1 + w m(i->j) m(j->i)) is the marginal probability that the edge is a match.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, release
from .neardup import Hashes

SHINGLE = 3
SKETCH = 6
SKETCH_SHINGLE = 8
#: Records of one side that meet as many of the other in one task; how larger blocks are laid out depends on it, not what is found.
CELL = 400
#: Characters that a title that was cut must keep to be compared.
CUT_LEAST = 4
ROUNDS = 200
EPS = 1e-3
#: Edges with no more log odds than this are no candidates.
LEAST = -6.0

_INVISIBLE = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])
_HYPHEN = re.compile(r"(\w)[-‐]\s*\n\s*(?=\w)")
_WORD = re.compile(r"[a-z0-9_]+")
_NUMBER = re.compile(r"^\s*(?:(?:chapter|part|appendix|section)\s+[\w.]+\.\s+|[A-Z]?\.?\d+(?:\.\d+)*\.\s+|[A-Z](?:\.\d+)+\.\s+)", re.IGNORECASE)
_NOT_KEY = re.compile(r"[^a-z0-9]+")


def fold(text: str) -> str:
    if text.isascii() and "-" not in text:
        return text
    return _HYPHEN.sub(r"\1", unicodedata.normalize("NFKC", text).translate(_INVISIBLE))


@lru_cache(maxsize=100_000)
def title_key(title: str | None) -> str:
    """A title in lower case without its number, spaces and punctuation."""
    return _NOT_KEY.sub("", _NUMBER.sub("", fold(title or "")).lower())


def _last_title(title: str) -> str:
    """Its key; one that was cut short ends in a star."""
    return title_key(title) + ("*" if title.rstrip().endswith(("…", "...")) else "")


def _same(x: Column, y: Column, least: int) -> Column:
    """Equal, or one begins the other and was cut."""
    cut = lambda a, b: (F.length(a) > least) & F.startswith(b, F.rtrim(a, F.lit("*")))
    return (x == y) | (F.endswith(x, F.lit("*")) & cut(x, y)) | (F.endswith(y, F.lit("*")) & cut(y, x))


def _shingle_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of n words, or of all words if there are fewer, from the words' hashes."""
    n = min(n, len(h))
    if not n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        out = (out ^ h[k : len(h) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _signed(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


PROFILE = "id string, hid bigint, class binary, side string, part string, keys array<bigint>, heading bigint, shingles array<int>, title string, path array<string>, anchor string"


def _profile(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = Hashes()
    for batch in it:
        cols = {c: batch.column(c).to_pylist() for c in ("id", "side", "part", "text", "path", "anchor")}
        kinds, keys, headings, shingles, titles, paths, anchors = [], [], [], [], [], [], []
        for side, part, text, path, anchor in zip(cols["side"], cols["part"], cols["text"], cols["path"], cols["anchor"]):
            text = text or ""
            at = text.find("\n\n")
            head, body = (text[:at], text[at + 2 :]) if at >= 0 else ("", text)
            told = [p for p in path or () if p and p.strip()]
            steps = [k for p in (told or head.split(" > ")) if (k := title_key(p))]
            found = _WORD.findall(fold(body).lower())
            words = np.fromiter(map(cache.__getitem__, found), np.uint64, len(found))
            title = _last_title(told[-1]) if told else ""
            parent = steps[-2] if told and len(steps) > 1 else ""
            own = np.uint64(xxhash.xxh64_intdigest(str(part)))
            short = _shingle_hashes(words, SHINGLE)
            anchor = (anchor or "").strip().upper().replace("_", "-")
            kinds.append(xxhash.xxh3_128_digest(repr((side, part, title, steps, anchor)).encode() + short.tobytes()))
            keys.append((_shingle_hashes(words, SKETCH_SHINGLE)[:SKETCH] ^ own).view(np.int64))
            headings.append(_signed(f"{part}|{parent}|{title}") if title else None)
            shingles.append((short >> np.uint64(32)).astype(np.uint32).view(np.int32))
            titles.append(title)
            paths.append(steps)
            anchors.append(anchor)
        if len(cache) > 2_000_000:
            cache.clear()
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array([_signed(i) for i in cols["id"]], pa.int64()), pa.array(kinds, pa.binary()), batch.column("side"), batch.column("part"), pa.array(keys, pa.list_(pa.int64())), pa.array(headings, pa.int64()), pa.array(shingles, pa.list_(pa.int32())), pa.array(titles, pa.string()), pa.array(paths, pa.list_(pa.string())), pa.array(anchors, pa.string())],
            names=["id", "hid", "class", "side", "part", "keys", "heading", "shingles", "title", "path", "anchor"],
        )


def profiles(df: DataFrame, sides: tuple[str, str], id_col: str = "chunk_id", side_col: str = "source_format", part_col: str = "pg_version", text: str = "text", path: str = "section_path", anchor: str = "section_anchor") -> DataFrame:
    """One row per row of the two sides: block keys, shingles and title evidence; hid is the id's hash, class that of the evidence."""
    one = df.select(F.col(id_col).cast("string").alias("id"), F.col(side_col).cast("string").alias("side"), F.col(part_col).cast("string").alias("part"), F.col(text).cast("string").alias("text"), F.col(path).cast("array<string>").alias("path"), F.col(anchor).cast("string").alias("anchor"))
    one = one.filter(F.col("side").isin(*sides) & F.col("id").isNotNull())
    return one.mapInArrow(_profile, PROFILE)


def copied(prof: DataFrame) -> DataFrame:
    """rep, copies, hid, id: the members of each class of more than one id; rep is the hash of the id that stands for them."""
    c = prof.select("class", "hid").distinct().groupBy("class").agg(F.min("hid").alias("rep"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    return materialize(prof.select("class", "hid", "id").join(c, "class").select("rep", "copies", "hid", "id").distinct(), "copies")


def candidates(prof: DataFrame, sides: tuple[str, str], copies: DataFrame | None = None) -> DataFrame:
    """Pairs of id hashes (ha of the first side, hb of the second) that share a block of one part and whose last titles can agree, each once.

    Of copies, one stands for all. Titles can agree if they are equal, one is missing, or one was cut and both begin alike; other pairs have
    log odds of -1 at most, so none can be a match. That is part of the join key at every size: a row is sent to each kind of agreement
    that it can have. Counts per key, pre-aggregated, first leave out the keys that only one side holds. A large key is laid out in cells of
    about CELL by CELL, so no task gets a whole key, and a large heading is joined on (heading, short shingle) instead, which leaves
    out pairs that share none: they have no weight. Rows carry hashes only; two ids with one hash would merely be judged more often.
    """
    first = F.col("side") == sides[0]
    base = F.rtrim(F.col("title"), F.lit("*"))
    one = prof if copies is None else prof.join(copies.filter("hid <> rep").select("hid").distinct(), "hid", "left_anti")
    evidence = [F.when(F.col("title") != "", F.xxhash64("title")).alias("title"), F.when(F.length(base) >= CUT_LEAST, F.xxhash64(F.substring(base, 1, CUT_LEAST))).alias("stem"), F.endswith("title", F.lit("*")).alias("cut")]
    key = F.concat(F.transform(F.array_distinct("keys"), lambda k: F.struct(k.alias("key"), F.lit(False).alias("headed"))), F.when(F.col("heading").isNull(), F.array().cast("array<struct<key:bigint,headed:boolean>>")).otherwise(F.array(F.struct(F.col("heading").alias("key"), F.lit(True).alias("headed")))))
    rows = one.select(first.alias("first"), "hid", *evidence, F.explode(key).alias("k")).select("first", "hid", "title", "stem", "cut", "k.*")
    met = _met(rows, "key", "headed").select("key", "headed", (F.col("n0") * F.col("n1") > CELL * CELL).alias("hot"))
    rows = materialize(rows.join(met.hint("merge"), ["key", "headed"]), "blocks")
    sub = rows.filter("NOT headed").select("key", "first", "hid", "hot", F.explode(_agreements()).alias("sub"))
    whole = rows.filter("headed AND NOT hot").select("key", "first", "hid", "hot", F.lit(0).cast("bigint").alias("sub"))
    wide = rows.filter("headed AND hot").select("key", "first", "hid", "hot")
    wide = wide.join(prof.select("hid", "shingles").hint("merge"), "hid").select("key", "first", "hid", "hot", F.explode(F.col("shingles").cast("array<bigint>")).alias("sub"))
    split = sub.filter("hot").unionByName(wide).select("first", "hid", "key", "sub")
    cold = sub.filter("NOT hot").unionByName(whole).select("key", "sub", "first", "hid", F.lit(0).cast("bigint").alias("cell"))
    both = cold.unionByName(_cells(split))
    a = both.filter("first").select("key", "sub", "cell", F.col("hid").alias("ha"))
    b = both.filter("NOT first").select("key", "sub", "cell", F.col("hid").alias("hb"))
    return a.join(b.hint("merge"), ["key", "sub", "cell"]).select("ha", "hb").distinct()


def _met(rows: DataFrame, *by: str) -> DataFrame:
    """Rows of either side per key, for keys that both hold."""
    n = rows.groupBy(*by).agg(F.sum(F.col("first").cast("bigint")).alias("n0"), F.sum((~F.col("first")).cast("bigint")).alias("n1"))
    return n.filter("n0 > 0 AND n1 > 0")


def _cells(rows: DataFrame) -> DataFrame:
    """Rows (first, hid, key, sub) of large keys, once for each cell in which they meet the other side: key, sub, first, hid, cell."""
    across = lambda n: F.ceil(F.col(n) / F.lit(CELL))
    met = _met(rows, "key", "sub").select("key", "sub", across("n0").alias("k0"), across("n1").alias("k1"))
    part = lambda k: F.pmod(F.xxhash64("hid"), F.col(k))
    along = lambda k: F.sequence(F.lit(0).cast("bigint"), F.col(k) - 1)
    cell = F.when(F.col("first"), F.transform(along("k1"), lambda j: part("k0") * F.col("k1") + j)).otherwise(F.transform(along("k0"), lambda i: i * F.col("k1") + part("k1")))
    return rows.join(met, ["key", "sub"]).select("key", "sub", "first", "hid", F.explode(cell).alias("cell"))


def _agreements() -> Column:
    """The ways in which a record's last title (title, stem, cut) can agree with one of the other side, as hashes that both sides share."""
    titled = F.col("title").isNotNull()
    sub = lambda when, kind, *of: F.when(when, F.xxhash64(F.lit(kind), *of))
    kinds = lambda mine, theirs, m: F.array(  # noqa: E731  mine: a missing or cut title is this row's, theirs: the other row's
        sub(titled, "equal", "title"), sub(~titled, f"none-{mine}"), sub(F.lit(m) | titled, f"none-{theirs}"),
        sub(F.col("cut") & F.col("stem").isNotNull(), f"cut-{mine}", "stem"), sub(titled & F.col("stem").isNotNull(), f"cut-{theirs}", "stem"),
    )
    return F.array_compact(F.when(F.col("first"), kinds("a", "b", False)).otherwise(kinds("b", "a", True)))


def weights(prof: DataFrame, pairs: DataFrame, sides: tuple[str, str]) -> DataFrame:
    """(a, b, logit): evidence of each candidate as log odds that it is a match; of repeated rows the best."""
    one = lambda c: prof.filter(F.col("side") == sides["ab".index(c)]).select(F.col("hid").alias(f"h{c}"), F.col("id").alias(c), F.col("part").alias(f"{c}_part"), *[F.col(x).alias(f"{c}_{x}") for x in ("shingles", "title", "path", "anchor")])
    e = pairs.hint("merge").join(one("a"), "ha").hint("merge").join(one("b"), "hb").filter(F.col("a_part").eqNullSafe(F.col("b_part")))
    both = F.size(F.array_intersect("a_shingles", "b_shingles"))
    least, most = F.least(F.size("a_shingles"), F.size("b_shingles")), F.greatest(F.size("a_shingles"), F.size("b_shingles"))
    contained = F.coalesce(both / F.nullif(least, F.lit(0)), F.lit(0.0))
    overlap = F.coalesce(both / F.nullif(most, F.lit(0)), F.lit(0.0))
    known = (F.col("a_title") != "") & (F.col("b_title") != "")
    title = F.when(~known, 0.0).when(_same(F.col("a_title"), F.col("b_title"), CUT_LEAST), 3.0).otherwise(-14.0)
    anchored = (F.col("a_anchor") != "") & (F.col("b_anchor") != "")
    begins = F.startswith("a_anchor", "b_anchor") | F.startswith("b_anchor", "a_anchor")
    anchor = F.when(~anchored, 0.0).when(F.col("a_anchor") == F.col("b_anchor"), 2.0).when(begins, 0.0).otherwise(-8.0)
    steps = lambda s: F.array_remove(F.col(f"{s}_path"), F.rtrim(F.col(f"{s}_title"), F.lit("*")))
    rest = F.size(F.array_intersect(steps("a"), steps("b")))
    path = F.when((rest == 0) & (F.size(steps("a")) > 0) & (F.size(steps("b")) > 0), -4.0).otherwise(F.least(rest, F.lit(3)) * 1.0)
    logit = F.lit(-7.0) + 12.0 * contained + 3.0 * overlap + title + anchor + path
    scored = e.select("a", "b", F.when(contained < 0.12, F.least(logit, F.lit(LEAST))).otherwise(logit).alias("logit"))
    return scored.filter(F.col("logit") > LEAST).groupBy("a", "b").agg(F.max("logit").alias("logit"))


def _others(df: DataFrame, end: str, message: str, copies: str) -> DataFrame:
    """Sum of w * message at each node over all copies of its neighbours, pre-aggregated before the shuffle."""
    return df.groupBy(end).agg(F.sum(F.col(copies) * F.col("w") * F.col(message)).alias(f"_{end}"))


def propagate(edges: DataFrame, rounds: int = ROUNDS, eps: float = EPS) -> DataFrame:
    """(a, b, p): marginal match probabilities under one-to-one factors, for each pair of copies of a and b.

    edges: a, b, logit and, where nodes stand for several records, copies_a and copies_b. An edge whose two ends are single records without another edge
    needs no messages: p = w / (1 + w). In each round the records of one side send, then those of the other with the new messages, half of
    a message being the old one from round 10 on; a round is written to the shared folder, and the loop ends when no marginal changes by
    more than eps. Raises RuntimeError if that has not happened after `rounds` rounds: unsettled marginals are never returned.
    """
    copies = [F.col(c) if c in edges.columns else F.lit(1).cast("bigint").alias(c) for c in ("copies_a", "copies_b")]
    e = edges.select("a", "b", *copies, F.exp(F.least(F.greatest("logit", F.lit(-30.0)), F.lit(30.0))).alias("w"))
    na, nb = e.groupBy("a").agg(F.sum("copies_b").alias("na")), e.groupBy("b").agg(F.sum("copies_a").alias("nb"))
    e = materialize(e.join(na, "a").join(nb, "b").withColumn("free", (F.col("na") == 1) & (F.col("nb") == 1)).drop("na", "nb"), "bp")
    free = e.filter("free").select("a", "b", (F.col("w") / (1 + F.col("w"))).alias("p"))
    m = materialize(e.filter("NOT free").select("a", "b", "copies_a", "copies_b", "w", F.lit(1.0).alias("ab"), F.lit(1.0).alias("ba")), "bp-0")
    odds = lambda x, y: F.col("w") * x * y
    for n in range(rounds):
        keep = 0.0 if n < 10 else 0.5
        blend = lambda old, new: old * keep + new * (1 - keep)  # noqa: B023, E731
        new = m.join(_others(m, "a", "ba", "copies_b"), "a")
        new = new.withColumn("ab2", blend(F.col("ab"), 1 / (1 + F.greatest(F.col("_a") - F.col("w") * F.col("ba"), F.lit(0.0))))).drop("_a")
        new = new.join(_others(new, "b", "ab2", "copies_a"), "b")
        new = new.withColumn("ba2", blend(F.col("ba"), 1 / (1 + F.greatest(F.col("_b") - F.col("w") * F.col("ab2"), F.lit(0.0)))))
        old, now = odds(F.col("ab"), F.col("ba")), odds(F.col("ab2"), F.col("ba2"))
        new = new.select("a", "b", "copies_a", "copies_b", "w", F.col("ab2").alias("ab"), F.col("ba2").alias("ba"), F.abs(now / (1 + now) - old / (1 + old)).alias("change"))
        m = materialize(new, "bp-m")
        if (m.agg(F.max("change")).first()[0] or 0.0) <= eps:
            break
    else:
        raise RuntimeError(f"belief propagation has not settled after {rounds} rounds")
    q = F.col("w") * F.col("ab") * F.col("ba")
    return free.unionByName(m.select("a", "b", (q / (1 + q)).alias("p")))


def match_records(df: DataFrame, sides: tuple[str, str] = ("html", "pdf"), least: float = 0.5, **columns: str) -> DataFrame:
    """(a, b, confidence): at most one partner per record, each other's most probable one with p >= least.

    Only records of one part (pg_version) can match; a null part is a part of its own. Records without words and titles have no
    candidate. Ties in p are settled by a hash of the ids. Repeated rows count once; null ids are left out; other columns are not read.
    A record's probabilities add up to 1 at most, so a class pair with p >= least has at most 1 / least copies a side to be expanded.
    """
    prof = materialize(profiles(df, sides, **columns), "profiles")
    same = copied(prof)
    pairs = materialize(candidates(prof, sides, same), "pairs")
    release(pairs)
    n = same.filter("hid = rep").select("id", "copies")
    edges = weights(prof, pairs, sides)
    for c in "ab":
        edges = edges.join(n.select(F.col("id").alias(c), F.col("copies").alias(f"copies_{c}")), c, "left").fillna(1, [f"copies_{c}"])
    edges = materialize(edges, "edges")
    release(edges)
    p = propagate(edges).filter(F.col("p") >= least)
    names = same.filter("hid = rep").select("rep", F.col("id").alias("_of")).join(same.select("rep", "id"), "rep").select("_of", "id")
    for c in "ab":
        p = p.join(names.select(F.col("_of").alias(c), F.col("id").alias("_id")), c, "left").withColumn(c, F.coalesce("_id", c)).drop("_id")
    p = materialize(p.select("a", "b", "p"), "matches")
    best = lambda c, o: F.max(F.struct("p", F.xxhash64(o).alias("h"), F.col(o).alias("to"))).alias(f"best_{c}")
    top_a, top_b = p.groupBy("a").agg(best("a", "b")), p.groupBy("b").agg(best("b", "a"))
    both = p.join(top_a, "a").join(top_b, "b").filter((F.col("best_a.to") == F.col("b")) & (F.col("best_b.to") == F.col("a")))
    return both.select("a", "b", F.col("p").alias("confidence"))


def matched_chunks(df: DataFrame) -> DataFrame:
    """chunk_id_a < chunk_id_b and confidence."""
    m = match_records(df)
    return m.select(F.least("a", "b").alias("chunk_id_a"), F.greatest("a", "b").alias("chunk_id_b"), "confidence")
