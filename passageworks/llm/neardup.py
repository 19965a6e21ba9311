"""Near-duplicate records with small edits: a binary trie self-join over word-parity fingerprints.

Two word sets whose Jaccard similarity is at least J differ in at most d = (|A| + |B|) (1 - J) / (1 + J) words. A
fingerprint that flips one bit for each word of a set can differ in at most as many bits as the sets differ in words,
so "Hamming distance over d" proves "not similar": pruning by it loses nothing.

A trie over whole fingerprints prunes late, because d errors may all lie at its end. So the words are dealt into m
blocks with m (K + 1) > d; then some block holds at most K = 2 of the differences. One trie per block is rooted at
that block: its first 64 levels are the block's parity bits with error budget K, the levels below are a parity of
the whole set, 128 bits or more as the band's d grows, with budget d. The join traverses pairs of nodes together, adds up differing bits and drops a pair of
nodes as soon as a budget is exceeded; with K = 2 the number of pairs visited grows like n log^2 n instead of n^2.

On the cluster a trie is one task group (format, size band, block). A trie with more than LEAVES leaves is cut at its top:
q coarse levels (parities of q groups of the block's bits, so they too differ in at most as many bits as words) name
2^q nodes, and each pair of nodes within K bits is a task of its own. A hot group therefore splits; nothing is capped.
Equal word sets are one leaf. Surviving pairs are verified on the words themselves.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from fractions import Fraction
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, release

WORD = re.compile(r"[a-z0-9_]+")
ERRORS = 2
LEAVES = 1_000_000
BROADCAST_ROWS = 10_000
#: Copies of one word set that meet as many others in one task.
COPIES = 1_000
FP_WORDS = 16
DIRECT = 64
FRONTIER = 400_000


def body_words(text: str | None) -> list[str]:
    """Distinct words of the text after its first empty line; none where there is no such line."""
    if not text:
        return []
    at = text.find("\n\n")
    return sorted(set(WORD.findall(text[at + 2 :].lower()))) if at >= 0 else []


class Bands:
    """Size bands of the smaller set of a pair, and what each needs: error bound and number of blocks."""

    def __init__(self, threshold: float):
        j = Fraction(str(threshold))
        if not 0 < j <= 1:
            raise ValueError("threshold must be in (0, 1]")
        self.j, self.ratio = j, (1 - j) / (1 + j)
        self.starts = [1]

    def _grow(self, n: int) -> None:
        while self.starts[-1] <= n:
            low = self.starts[-1]
            self.starts.append(max(low + 1, low * 5 // 4))

    def band(self, n: int) -> int:
        self._grow(n)
        return int(np.searchsorted(self.starts, n, "right")) - 1

    def bound(self, total: int) -> int:
        """Most differing words of two sets whose sizes add up to total."""
        return int(total * self.ratio)

    def worst(self, band: int) -> int:
        self._grow(self.starts[min(band, len(self.starts) - 1)])
        while len(self.starts) <= band + 1:
            self._grow(self.starts[-1])
        high = self.starts[band + 1] - 1
        return self.bound(high + int(high / self.j))

    def blocks(self, band: int) -> int:
        return self.worst(band) // (ERRORS + 1) + 1

    def width(self, band: int) -> int:
        """64-bit words of the whole set's parity, so wide that unrelated sets differ in clearly more than d bits."""
        d = self.worst(band)
        return 2 if d <= 40 else 4 if d <= 96 else 8 if d <= 208 else FP_WORDS

    def of(self, n: int) -> list[int]:
        """Bands in which a set of n words can meet a partner: its own, and those of smaller partners."""
        least = -((-n * self.j.numerator) // self.j.denominator)
        return list(range(self.band(max(1, least)), self.band(n) + 1))


class Hashes(dict):
    """64-bit hashes of words, computed once."""

    def __missing__(self, word: str) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def signatures(batch_words: list[list[str]], bands: Bands, cache: Hashes) -> list[bytes]:
    """For each non-empty word list: the parity of the set, then the block parities of each of its bands, as 64-bit words."""
    size = np.array([len(w) for w in batch_words], np.int64)
    order = np.argsort(size, kind="stable")  # a band is then a stretch of documents and of their words
    n = size[order]
    flat = np.fromiter(map(cache.__getitem__, chain.from_iterable(batch_words[i] for i in order)), np.uint64, int(n.sum()))
    if len(cache) > 2_000_000:
        cache.clear()
    doc, start = np.repeat(np.arange(len(n)), n), np.concatenate([[0], np.cumsum(n)])
    fp = np.zeros(len(n) * FP_WORDS, np.uint64)
    np.bitwise_xor.at(fp, doc * FP_WORDS + ((flat >> np.uint64(6)) & np.uint64(FP_WORDS - 1)).astype(np.int64), np.uint64(1) << (flat & np.uint64(63)))
    fp = fp.reshape(len(n), FP_WORDS)
    bit = np.uint64(1) << ((flat >> np.uint64(10)) & np.uint64(63))
    part = (flat >> np.uint64(20)).astype(np.int64)
    of = {int(s): bands.of(int(s)) for s in np.unique(n)}
    out: list[list[bytes]] = []
    for s, mine in of.items():
        i, j = np.searchsorted(n, s), np.searchsorted(n, s, "right")
        out += [[row.tobytes()] for row in np.ascontiguousarray(fold(fp[i:j].T, bands.width(mine[-1])).T)]
    for b in sorted({b for mine in of.values() for b in mine}):
        within = [s for s, mine in of.items() if b in mine]
        i, j = np.searchsorted(n, min(within)), np.searchsorted(n, max(within), "right")
        m, at = bands.blocks(b), slice(start[i], start[j])
        blocks = np.zeros((j - i) * m, np.uint64)
        np.bitwise_xor.at(blocks, (doc[at] - i) * m + part[at] % m, bit[at])
        for k, row in enumerate(blocks.reshape(-1, m), i):
            out[k].append(row.tobytes())
    done: list[bytes] = [b""] * len(n)
    for k, i in enumerate(order):
        done[i] = b"".join(out[k])
    return done


def fold(fp: np.ndarray, width: int) -> np.ndarray:
    """The same parity over fewer bits; sets that differ in d words still differ in at most d bits."""
    while len(fp) > width:
        fp = fp[: len(fp) // 2] ^ fp[len(fp) // 2 :]
    return fp


def leaves(sig: bytes, n: int, bands: Bands) -> list[tuple[int, int, int, bytes]]:
    """(band, block, block parity, whole parity) of each trie that the signature belongs to."""
    mine = bands.of(n)
    words = np.frombuffer(sig, np.uint64)
    k = bands.width(mine[-1])
    fp, bits = words[:k], words.view(np.int64).tolist()
    out = []
    for b in mine:
        folded = fold(fp, bands.width(b)).tobytes()
        for i in range(bands.blocks(b)):
            out.append((b, i, bits[k], folded))
            k += 1
    return out


def trie_join(keys: np.ndarray, sizes: np.ndarray, split: int | None, bands: Bands, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows of keys within both budgets; with split, only pairs of a row before it and one from it on.

    keys: uint64 [n, 1 + width], first the block's parity, in lexicographic order within each side.
    """
    n, total = len(keys), bands.worst(band)
    ones: dict[int, np.ndarray] = {}

    def count(level: int) -> np.ndarray:
        if level not in ones:
            bits = (keys[:, level // 64] >> np.uint64(63 - level % 64)) & np.uint64(1)
            ones[level] = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])
        return ones[level]

    found_a, found_b = [np.empty(0, np.int32)], [np.empty(0, np.int32)]

    cols = [np.ascontiguousarray(keys[:, w]) for w in range(keys.shape[1])]

    def finish(f: np.ndarray) -> None:
        """All pairs of leaves of small node pairs, checked on the whole fingerprint."""
        la, lb = f[1] - f[0], f[3] - f[2]
        row = np.repeat(np.arange(f.shape[1]), la)
        each = np.arange(len(row)) - np.repeat(np.cumsum(la) - la - f[0], la)
        per = lb[row]
        a = np.repeat(each.astype(np.int32), per)
        b = (np.arange(len(a)) - np.repeat(np.cumsum(per) - per - f[2][row], per)).astype(np.int32)
        keep = np.flatnonzero(np.bitwise_count(cols[0][a] ^ cols[0][b]) <= ERRORS)
        a, b = a[keep], b[keep]
        keep = a < b
        a, b = a[keep], b[keep]
        apart = np.zeros(len(a), np.int64)
        most = np.floor((sizes[a] + sizes[b]) * float(bands.ratio) + 1e-9)
        for c in cols[1:]:
            apart += np.bitwise_count(c[a] ^ c[b])
            keep = apart <= most
            a, b, apart, most = a[keep], b[keep], apart[keep], most[keep]
        found_a.append(a)
        found_b.append(b)

    root = np.array([[0], [n], [0], [n], [0], [0]] if split is None else [[0], [split], [split], [n], [0], [0]], np.int64)
    stack = [(0, root)]
    while stack:
        level, f = stack.pop()
        small = (f[1] - f[0]) * (f[3] - f[2]) <= DIRECT
        if level == 64 * keys.shape[1]:
            small[:] = True  # equal fingerprints: every pair of these leaves is a candidate
        if small.any():
            for at in range(0, int(small.sum()), 50_000):
                finish(f[:, small][:, at : at + 50_000])
            f = f[:, ~small]
        if not f.shape[1]:
            continue
        if f.shape[1] > FRONTIER:
            half = f.shape[1] // 2
            stack += [(level, f[:, :half]), (level, f[:, half:])]
            continue
        c = count(level)
        mid_a = f[1] - (c[f[1]] - c[f[0]])
        mid_b = f[3] - (c[f[3]] - c[f[2]])
        same = f[0] == f[2] if split is None else np.zeros(f.shape[1], bool)
        first, miss = (4, ERRORS) if level < 64 else (5, total)
        e = f[first]
        parts = []
        for lo_a, hi_a, lo_b, hi_b, add, mask in (
            (f[0], mid_a, f[2], mid_b, 0, None), (mid_a, f[1], mid_b, f[3], 0, None),
            (f[0], mid_a, mid_b, f[3], 1, None), (mid_a, f[1], f[2], mid_b, 1, ~same),
        ):
            keep = (hi_a > lo_a) & (hi_b > lo_b) & (e + add <= miss)
            if mask is not None:
                keep &= mask
            if keep.any():
                g = np.stack([lo_a, hi_a, lo_b, hi_b, f[4], f[5]])[:, keep]
                g[first] += add
                parts.append(g)
        if parts:
            stack.append((level + 1, np.concatenate(parts, axis=1)))
    return np.concatenate(found_a), np.concatenate(found_b)


class NearDuplicates:
    """Documents, their classes of equal word sets, and the links between classes.

    docs: one row per input row with words: `_id`, `_group`, `_class` BINARY(16), `_n`, `_sig`.
    links(): one row per pair of different classes with similarity >= threshold: `_group`, `_a`, `_b` (class), `similarity`.
    Rows whose text is null, has no empty line or no words after it take no part. Only pairs of one `group` value count; a
    null group is a group of its own. Repeated rows count once; an id with several texts has a row for each. Other columns
    are never read, whatever their names.
    """

    def __init__(self, df: DataFrame, id_col: str, text_col: str, group_col: str, threshold: float = 0.8):
        self.threshold, self.bands = threshold, Bands(threshold)
        self.source = df.select(F.col(id_col).cast("string").alias("_id"), F.col(group_col).cast("string").alias("_group"), F.col(text_col).cast("string").alias("_text")).filter("_id IS NOT NULL AND _text IS NOT NULL")
        self.docs = materialize(self.source.mapInArrow(_describe(threshold), "_id string, _group string, _class binary, _n int, _sig binary"), "neardup")

    def members(self) -> DataFrame:
        """Each id's classes, once: `_group`, `_class`, `_id`."""
        return self.docs.select("_group", "_class", "_id").distinct()

    def candidates(self) -> DataFrame:
        """Pairs of classes within the Hamming budgets, each once: `_group`, `_a`, `_b`."""
        reps = self.docs.groupBy("_group", "_class").agg(F.first("_n").alias("_n"), F.first("_sig").alias("_sig"))
        heavy = self.docs.groupBy("_group", "_n").agg(F.count(F.lit(1)).alias("c"))
        heavy = heavy.mapInPandas(_band_counts(self.threshold), "_g string, _band2 int, c bigint").groupBy("_g", "_band2").agg(F.sum("c").alias("_c"))
        heavy = materialize(heavy.filter(F.col("_c") > LEAVES), "neardup-heavy")
        rows = reps.mapInArrow(_explode(self.threshold), "_group string, _class binary, _n int, _band int, _block int, _bits bigint, _fp binary")
        found = heavy.count()
        if not found:
            rows = rows.withColumn("_u", F.lit(0)).withColumn("_lo", F.lit(0)).withColumn("_hi", F.lit(0))
        else:
            rows = _node_pairs(rows, F.broadcast(heavy) if found <= BROADCAST_ROWS else heavy)
        pairs = rows.groupBy("_group", "_band", "_block", "_lo", "_hi").applyInArrow(_join(self.threshold), "_group string, _a binary, _b binary")
        return pairs.distinct()

    def links(self) -> DataFrame:
        """Verified links between classes, each once, with the exact similarity.

        Texts of candidate classes are fetched by a merge join at every size, so small and large inputs run alike.
        """
        pairs = materialize(self.candidates(), "neardup-candidates")
        release(pairs)
        cls = pairs.select("_group", F.col("_a").alias("_class")).union(pairs.select("_group", F.col("_b").alias("_class"))).distinct()
        cls = cls.select(F.col("_group").alias("_g"), F.col("_class").alias("_k"))
        ids = self.docs.join(cls, F.col("_group").eqNullSafe(F.col("_g")) & (F.col("_class") == F.col("_k"))).groupBy("_group", "_class").agg(F.min("_id").alias("_id"))
        ids = ids.select(F.col("_group").alias("_g"), F.col("_id").alias("_i")).distinct()
        texts = self.source.join(ids.hint("merge"), F.col("_group").eqNullSafe(F.col("_g")) & (F.col("_id") == F.col("_i")), "left_semi")
        words = texts.mapInArrow(_words, "_group string, _class binary, _words array<bigint>").dropDuplicates(["_group", "_class"])
        a = words.select(F.col("_group").alias("_ga"), F.col("_class").alias("_ca"), F.col("_words").alias("_wa"))
        b = words.select(F.col("_group").alias("_gb"), F.col("_class").alias("_cb"), F.col("_words").alias("_wb"))
        both = pairs.join(a, F.col("_group").eqNullSafe(F.col("_ga")) & (F.col("_a") == F.col("_ca"))).join(b, F.col("_group").eqNullSafe(F.col("_gb")) & (F.col("_b") == F.col("_cb")))
        both = both.withColumn("_i", F.size(F.array_intersect("_wa", "_wb")))
        both = both.withColumn("_u", F.size("_wa") + F.size("_wb") - F.col("_i"))
        j = Fraction(str(self.threshold))
        return both.filter(F.col("_i") * j.denominator >= F.col("_u") * j.numerator).select("_group", "_a", "_b", (F.col("_i") / F.col("_u")).alias("similarity"))


def _node_pairs(rows: DataFrame, heavy: DataFrame) -> DataFrame:
    """Send the leaves of heavy tries to each pair of top nodes they belong to; heavy: `_g`, `_band2`, `_c` leaves."""
    rows = rows.join(heavy, F.col("_group").eqNullSafe(F.col("_g")) & (F.col("_band") == F.col("_band2")), "left").drop("_g", "_band2")
    q = F.least(F.lit(16), F.ceil(F.log2(F.coalesce(F.col("_c"), F.lit(1)) / F.lit(float(LEAVES))))).cast("int")
    rows = rows.withColumn("_q", F.greatest(F.lit(0), q)).drop("_c")
    parity = "CAST(aggregate(sequence(0, (63 - j) div _q), 0L, (p, k) -> p ^ (shiftright(_bits, CAST(j + k * _q AS INT)) & 1L)) AS INT)"
    rows = rows.withColumn("_u", F.expr(f"IF(_q = 0, 0, aggregate(sequence(0, greatest(_q, 1) - 1), 0, (a, j) -> a + shiftleft({parity}, j)))"))
    rows = rows.withColumn("_flip", F.explode(F.expr(f"IF(_q = 0, array(0), filter(sequence(0, shiftleft(1, _q) - 1), x -> bit_count(x) <= {ERRORS}))")))
    rows = rows.withColumn("_v", F.col("_u").bitwiseXOR(F.col("_flip"))).withColumn("_lo", F.least("_u", "_v")).withColumn("_hi", F.greatest("_u", "_v"))
    return rows.drop("_q", "_flip", "_v")


def _describe(threshold: float):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, cache = Bands(threshold), Hashes()
        for batch in it:
            ids, groups, texts = (batch.column(k).to_pylist() for k in range(3))
            kept = [(i, g, w) for i, g, t in zip(ids, groups, texts) if (w := body_words(t))]
            if not kept:
                continue
            sigs = signatures([w for _, _, w in kept], bands, cache)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in kept], pa.string()), pa.array([k[1] for k in kept], pa.string()), pa.array([hashlib.md5("\n".join(k[2]).encode()).digest() for k in kept], pa.binary()), pa.array([len(k[2]) for k in kept], pa.int32()), pa.array(sigs, pa.binary())],
                names=["_id", "_group", "_class", "_n", "_sig"],
            )

    return run


def _words(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        kept = [(g, w) for g, t in zip(batch.column("_group").to_pylist(), batch.column("_text").to_pylist()) if (w := body_words(t))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([g for g, _ in kept], pa.string()), pa.array([hashlib.md5("\n".join(w).encode()).digest() for _, w in kept], pa.binary()), pa.array([np.array([xxhash.xxh64_intdigest(x) for x in w], np.uint64).view(np.int64) for _, w in kept], pa.list_(pa.int64()))],
            names=["_group", "_class", "_words"],
        )


def _explode(threshold: float):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(threshold)
        for batch in it:
            n = batch.column("_n").to_numpy()
            sig = batch.column("_sig").to_pylist()
            for size in np.unique(n):
                at = np.flatnonzero(n == size)
                words = np.frombuffer(b"".join([sig[i] for i in at]), np.uint64).reshape(len(at), -1)
                mine = bands.of(int(size))
                k = bands.width(mine[-1])
                fp = words[:, :k]
                for b in mine:
                    m, wide = bands.blocks(b), bands.width(b)
                    folded = np.ascontiguousarray(fold(fp.T, wide).T)
                    whole = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer((np.arange(len(at) + 1, dtype=np.int32) * (8 * wide)).tobytes()), pa.py_buffer(folded.tobytes())])
                    take = pa.array(np.tile(at, m))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("_group").take(take), batch.column("_class").take(take), pa.array(np.full(len(at) * m, size, np.int32)), pa.array(np.full(len(at) * m, b, np.int32)), pa.array(np.repeat(np.arange(m, dtype=np.int32), len(at))), pa.array(words[:, k : k + m].T.ravel().view(np.int64)), whole.take(pa.array(np.tile(np.arange(len(at)), m)))],
                        names=["_group", "_class", "_n", "_band", "_block", "_bits", "_fp"],
                    )
                    k += m

    return run


def _band_counts(threshold: float):
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bands = Bands(threshold)
        for pdf in it:
            rows = [(g, b, c) for g, n, c in pdf.itertuples(index=False) for b in bands.of(int(n))]
            yield pd.DataFrame(rows, columns=["_g", "_band2", "c"])

    return run


def _join(threshold: float):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        bands = Bands(threshold)
        group, band, _, lo, hi = (k.as_py() for k in key)
        width = bands.width(band)
        rows = rows.combine_chunks()
        keys = np.empty((len(rows), 1 + width), np.uint64)
        keys[:, 0] = rows["_bits"].to_numpy().view(np.uint64)
        keys[:, 1:] = np.frombuffer(b"".join(rows["_fp"].to_pylist()), np.uint64).reshape(-1, width)
        side = (rows["_u"].to_numpy() != lo).astype(np.int64)
        order = np.lexsort([*keys.T[::-1], side])
        keys, side, sizes = keys[order], side[order], rows["_n"].to_numpy().astype(np.int64)[order]
        split = None if lo == hi else int((side == 0).sum())
        if split is not None and split in (0, len(keys)):
            a = b = np.empty(0, np.int32)
        else:
            a, b = trie_join(keys, sizes, split, bands, band)
        low, high = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
        mine = (np.searchsorted(np.array(bands.starts), low, "right") - 1 == band) & (low * bands.j.denominator >= high * bands.j.numerator)
        a, b = rows["_class"].take(pa.array(order[a[mine]])), rows["_class"].take(pa.array(order[b[mine]]))
        swap = pc.greater(a, b)
        return pa.table({"_group": pa.array([group] * len(a), pa.string()), "_a": pc.if_else(swap, b, a), "_b": pc.if_else(swap, a, b)})

    return run


def near_duplicate_pairs(df: DataFrame, id_col: str = "chunk_id", text_col: str = "text", group_col: str = "source_format", threshold: float = 0.8) -> DataFrame:
    """All pairs of different ids of one group whose similarity reaches the threshold: id_a < id_b, each pair once.

    Copies are expanded; use near_duplicate_groups where classes may stay compact. Cases: see NearDuplicates.
    """
    nd = NearDuplicates(df, id_col, text_col, group_col, threshold)
    member = nd.members()
    links = nd.links()
    a = member.select(F.col("_group").alias("_ga"), F.col("_class").alias("_ca"), F.col("_id").alias("x"))
    b = member.select(F.col("_group").alias("_gb"), F.col("_class").alias("_cb"), F.col("_id").alias("y"))
    across = links.join(a, F.col("_group").eqNullSafe(F.col("_ga")) & (F.col("_a") == F.col("_ca"))).join(b, F.col("_group").eqNullSafe(F.col("_gb")) & (F.col("_b") == F.col("_cb"))).select("x", "y").filter("x <> y")
    copied = member.groupBy("_group", "_class").agg(F.ceil(F.count(F.lit(1)) / F.lit(COPIES)).alias("k"), F.count(F.lit(1)).alias("c")).filter("c > 1").select(F.col("_group").alias("_gc"), F.col("_class").alias("_cc"), "k")
    same = member.join(copied, F.col("_group").eqNullSafe(F.col("_gc")) & (F.col("_class") == F.col("_cc"))).withColumn("own", F.pmod(F.xxhash64("_id"), F.col("k")))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("k") - 1))  # the k parts of a class meet part by part
    x = same.select(F.col("_group").alias("_ga"), F.col("_class").alias("_ca"), F.col("_id").alias("x"), F.col("own").alias("xa"), every.alias("ya"))
    y = same.select(F.col("_group").alias("_gb"), F.col("_class").alias("_cb"), F.col("_id").alias("y"), every.alias("xb"), F.col("own").alias("yb"))
    within = x.join(y, F.col("_ga").eqNullSafe(F.col("_gb")) & (F.col("_ca") == F.col("_cb")) & (F.col("xa") == F.col("xb")) & (F.col("ya") == F.col("yb")) & (F.col("x") < F.col("y"))).select("x", "y")
    pairs = across.unionByName(within).select(F.least("x", "y").alias(f"{id_col}_a"), F.greatest("x", "y").alias(f"{id_col}_b"))
    return pairs.distinct()


def near_duplicate_groups(df: DataFrame, id_col: str = "chunk_id", text_col: str = "text", group_col: str = "source_format", threshold: float = 0.8) -> DataFrame:
    """One row per id: `group_id` (the least id of its connected component) and `n_links` (links between different word sets).

    Every id with a word set has a row; alone it is its own group. An id with several texts belongs to all their groups,
    which are then one. Columns: id, group_id, n_links. Cases: see NearDuplicates.
    """
    nd = NearDuplicates(df, id_col, text_col, group_col, threshold)
    key = F.md5(F.concat(F.coalesce(F.col("_group"), F.lit("")), F.lit("|"), F.hex("_class")))
    docs = nd.members().select("_id", key.alias("node"))
    links = nd.links().select(*[F.md5(F.concat(F.coalesce(F.col("_group"), F.lit("")), F.lit("|"), F.hex(c))).alias(c) for c in ("_a", "_b")])
    links = materialize(links, "neardup-links")
    degree = links.select(F.col("_a").alias("node")).union(links.select("_b")).groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    shared = docs.select(F.concat(F.lit("id:"), "_id").alias("_a"), F.col("node").alias("_b")).join(docs.groupBy("_id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select(F.concat(F.lit("id:"), "_id").alias("_a")), "_a", "left_semi")
    label = connected_components(links.unionByName(shared))
    out = docs.join(label, "node", "left").join(degree, "node", "left")
    out = out.withColumn("_l", F.coalesce("label", "node"))
    least = out.groupBy("_l").agg(F.min("_id").alias("group_id"))
    return out.join(least, "_l").groupBy(F.col("_id").alias(id_col), "group_id").agg(F.sum(F.coalesce("n", F.lit(0))).cast("bigint").alias("n_links"))


def connected_components(edges: DataFrame, a: str = "_a", b: str = "_b", max_rounds: int = 60) -> DataFrame:
    """(node, label): label is the least node of the component. Alternating large-star and small-star rounds.

    Edges to hubs shrink each round, every round is one distributed job written to the shared folder, and the loop ends
    when the number and hash of edges stay; the number of rounds grows with the logarithm of the component size. Raises
    RuntimeError if they have not after max_rounds: components that are not whole are never returned.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    e = materialize(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    seen = None
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = materialize(large, "cc-large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select("v", "m").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialize(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "cc-small")
        state = tuple(e.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components have not settled after {max_rounds} rounds")
    tops = e.select(F.col("v").alias("node"), F.col("v").alias("label"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).union(tops).groupBy("node").agg(F.min("label").alias("label"))
