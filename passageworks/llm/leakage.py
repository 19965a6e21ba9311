"""Evaluation texts that appear, fully or partly, in corpus documents: a prefix-filtered set join of word shingles.

Every run of `size` consecutive words of an item's question or of its passage is a shingle. A document holds the shingle only
if it holds all its words, so of the shingle's words in order of rarity the first two at their distance (a necessary prefix for full
containment with a positional bound) suffice to find all candidates. The first word's place in the shingle says where the shingle must
begin in the document and that `size` words must remain there (the length bound); the window is then compared exactly.

Rarity is the number of documents that hold a word, counted over all documents. Items, shingles and index are tables, however many there are:
the corpus is normalised in one scan, its words are counted and the occurrences of prefixes, with the words around them, are joined with
the index. Which are worth sending is known from a bit table of fixed size, so other words are never shuffled.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

SIZE = 10
#: The table of prefixes has two to the power of so many bits (1 MB); what shares a bit with one is sent in vain.
LOG_BITS = 23

_INVISIBLE = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0x200E, 0x200F])
_TAG = re.compile(r"</?[a-zA-Z][^<>\n]{0,200}>")
_LINK = re.compile(r"!?\[([^\[\]\n]*)\]\((?:[^()\s]|\([^()\s]*\))*\)")
_LEAD = re.compile(r"(?m)^[ \t]*(?:(?:>|\||//+|/?\*+/?|#+|--)[ \t]*)+")
_HYPHEN = re.compile(r"(\w)[-‐‑][ \t]*\n\s*(?=\w)")
_WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    """Lower-case words of a text without markup, quote marks at line starts, line-break hyphens and look-only characters.

    Null and empty texts have none. Underscores inside a word belong to it; at its ends they are markup.
    """
    if not text:
        return []
    t = html.unescape(text) if "&" in text else text
    t = unicodedata.normalize("NFKC", t).translate(_INVISIBLE).replace("\r\n", "\n").replace("\r", "\n")
    if "](" in t:
        t = _LINK.sub(r"\1", t)
    if "<" in t:
        t = _TAG.sub("", t)
    t = _HYPHEN.sub(r"\1", _LEAD.sub("", t))
    return [w for x in _WORD.findall(t.lower()) if (w := x.strip("_"))]


def shingles(text: str | None, size: int) -> list[tuple[str, ...]]:
    w = words(text)
    return [tuple(w[i : i + size]) for i in range(len(w) - size + 1)]


def leaked_items(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "query_id", fields: tuple[str, ...] = ("question", "passage"), size: int = SIZE) -> DataFrame:
    """(doc_id, item_id) of each document that holds at least `size` consecutive words of one field of an item; no repeats.

    Fields shorter than `size` words cannot leak. Null ids are kept as such, null and empty texts hold nothing. Repeated rows and
    items give one row. Other columns are not read. An empty side gives an empty result.
    """
    if size < 1:
        raise ValueError("size must be positive")
    asked = materialize(_item_shingles(items, item_id, fields, size), "shingles")
    docs = documents.select(F.col(doc_id).alias("_d"), F.col(text).cast("string").alias("_t")).filter("_t IS NOT NULL AND _t <> ''")
    d_type = documents.schema[doc_id].dataType.simpleString()

    def normalise(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pd.DataFrame({"_d": pdf["_d"], "_w": [" ".join(words(t)) for t in pdf["_t"]]})

    said = materialize(docs.mapInPandas(normalise, f"_d {d_type}, _w string"), "words")
    index = materialize(_index(asked.select("shingle").distinct(), said, size), "index")
    sent = _occurrences(said, _bits(index), size, d_type)
    start = F.col("off") - F.col("at")
    held = (start >= 0) & (start + size <= F.col("n"))
    same = F.array_join(F.slice(F.split("around", " "), start + 1, F.lit(size)), " ") == F.col("shingle")
    found = sent.join(index.hint("merge"), "prefix").filter(held).filter(same).select("_d", "shingle").distinct()
    return found.join(asked, "shingle").select(F.col("_d").alias(doc_id), F.col("_q").alias(item_id)).distinct()


def _item_shingles(items: DataFrame, item_id: str, fields: tuple[str, ...], size: int) -> DataFrame:
    """_q, shingle: every run of `size` words of a field."""
    q_type = items.schema[item_id].dataType.simpleString()
    one = items.select(F.col(item_id).alias("_q"), F.explode(F.array(*[F.col(f).cast("string") for f in fields])).alias("_t")).filter("_t IS NOT NULL")

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pd.DataFrame([(q, " ".join(s)) for q, t in zip(pdf["_q"], pdf["_t"]) for s in set(shingles(t, size))], columns=["_q", "shingle"])

    return one.mapInPandas(run, f"_q {q_type}, shingle string").distinct()


def _index(asked: DataFrame, said: DataFrame, size: int) -> DataFrame:
    """shingle, at, prefix, word: of each shingle whose words the corpus has all, the rarest word's place and hash, and its hash with the next."""

    def count(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n: Counter = Counter()
        for pdf in it:
            for t in pdf["_w"]:
                n.update(set(t.split(" ")))
            if len(n) > 200_000:
                yield pd.DataFrame({"word": list(n), "n": list(n.values())})
                n.clear()
        if n:
            yield pd.DataFrame({"word": list(n), "n": list(n.values())})

    rarity = said.select("_w").mapInPandas(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    places = asked.select("shingle", F.posexplode(F.split("shingle", " ")).alias("at", "word")).join(rarity, "word")
    rare = F.sort_array(F.collect_list(F.struct("n", "word", "at"))).alias("r")  # a row for each of `size` words
    first = places.groupBy("shingle").agg(rare).filter(F.size("r") == size).select("shingle", F.col("r")[0]["word"].alias("w"), F.col("r")[0]["at"].alias("at"), F.col("r")[min(1, size - 1)]["word"].alias("v"), F.col("r")[min(1, size - 1)]["at"].alias("vat"))

    def prefix(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in filter(len, it):
            w, v = _hashes(pdf["w"], {}), _hashes(pdf["v"], {})
            pair = _pair(w, v, (pdf["vat"] - pdf["at"]).to_numpy(np.int64))
            yield pd.DataFrame({"shingle": pdf["shingle"], "at": pdf["at"], "prefix": pair.view(np.int64), "word": w.view(np.int64)})

    return first.mapInPandas(prefix, "shingle string, at int, prefix bigint, word bigint")


def _hashes(words: Iterable[str], cache: dict[str, int]) -> np.ndarray:
    out = []
    for w in words:
        h = cache.get(w)
        if h is None:
            h = cache[w] = xxhash.xxh64_intdigest(w)
        out.append(h)
    return np.array(out, np.uint64)


def _pair(w: np.ndarray, v: np.ndarray, apart: np.ndarray | int) -> np.ndarray:
    """Hash of two words and their distance."""
    x = (w ^ (v >> np.uint64(31) | v << np.uint64(33))) * np.uint64(0x9E3779B97F4A7C15) + np.asarray(apart).astype(np.int64).view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    return x * np.uint64(0xBF58476D1CE4E5B9)


def _bit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - LOG_BITS)).astype(np.int64)


def _on(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    k = _bit(h)
    return table[k >> 3] >> (7 - (k & 7)) & 1 == 1


def _bits(index: DataFrame) -> bytes:
    """The bit table of the index's first words and prefixes: of one size whatever their number, joined from one table a partition."""

    def table(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = np.zeros(1 << LOG_BITS, bool)
        for batch in it:
            for c in ("word", "prefix"):
                on[_bit(batch.column(c).to_numpy().view(np.uint64))] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(on).tobytes()], pa.binary())], names=["b"])

    def join(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = np.zeros(1 << LOG_BITS - 3, np.uint8)
        for batch in it:
            for b in batch.column("b").to_pylist():
                on |= np.frombuffer(b, np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([on.tobytes()], pa.binary())], names=["b"])

    each = index.select("word", "prefix").coalesce(16).mapInArrow(table, "b binary")
    return bytes(each.repartition(1).mapInArrow(join, "b binary").first()["b"])


def _occurrences(said: DataFrame, bits: bytes, size: int, d_type: str) -> DataFrame:
    """_d, prefix, off, n, around: each occurrence of a prefix of the bit table with up to size - 1 words on either side of its first word; off
    words stand before it, n are there in all."""
    packed = said.sparkSession.sparkContext.broadcast(bits)  # of a fixed size

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, cache = np.frombuffer(packed.value, np.uint8), {}
        for batch in it:
            texts = [t.split(" ") for t in batch.column("_w").to_pylist()]
            ends = np.cumsum([len(w) for w in texts])
            h = _hashes((x for w in texts for x in w), cache)
            if len(cache) > 2_000_000:
                cache.clear()
            first = np.flatnonzero(_on(table, h))
            doc = np.searchsorted(ends, first, "right")
            begin, end = np.concatenate([[0], ends])[doc], ends[doc]
            of, prefix, before, around = [], [], [], []
            for apart in (x for x in range(1 - size, size) if x or size == 1):
                there = np.flatnonzero((first + apart >= begin) & (first + apart < end))
                p = _pair(h[first[there]], h[first[there] + apart], apart)
                hit = _on(table, p)
                prefix += p[hit].view(np.int64).tolist()
                for k in there[hit]:
                    q = int(first[k] - begin[k])
                    of.append(int(doc[k]))
                    before.append(min(q, size - 1))
                    around.append(texts[doc[k]][max(0, q - size + 1) : q + size])
            columns = [batch.column("_d").take(pa.array(of, pa.int64())), pa.array(prefix, pa.int64()), pa.array(before, pa.int32()), pa.array(map(len, around), pa.int32()), pa.array([" ".join(a) for a in around], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["_d", "prefix", "off", "n", "around"])

    return said.mapInArrow(run, f"_d {d_type}, prefix bigint, off int, n int, around string")
