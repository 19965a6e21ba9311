"""Cut oversized items into overlapping pieces by recursive bisection at natural boundaries.

An item is a sequence of blocks (a chunk is one block). Its size is the sum of its blocks' tokens. The item is cut at the
strongest boundary near its midpoint (block, blank line, line, sentence, clause, word; anywhere only if there is none) and
halves that still exceed the limit minus the overlap are cut again. Then each piece but the first gets, before its own
text, the end of the piece before it, up to the overlap and from a boundary on.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cut positions (offset where the right part begins), strongest first.
BOUNDARIES = [
    re.compile(r"\n[ \t\r]*\n\s*(?=\S)"),
    re.compile(r"\n(?=[^\n])"),
    re.compile(r"(?<=[.!?])[\"')\]]*\s+(?=\S)|(?<=[。！？])"),
    re.compile(r"(?<=[,;:])\s+(?=\S)|(?<=[、，；：])"),
    re.compile(r"\s+(?=\S)"),
]


def estimate(n_chars: int) -> int:
    return -(-n_chars // 4)


class _Item:
    """Blocks laid end to end, with all boundaries and the token count of any span."""

    def __init__(self, blocks: list[str], tokens_of: Callable[[str], int] | None):
        self.text = "".join(blocks)
        self.edges = [0]
        for b in blocks:
            self.edges.append(self.edges[-1] + len(b))
        self.tokens_of = tokens_of
        levels = [sorted(set(self.edges[1:-1]))]
        levels += [[m.end() for m in p.finditer(self.text)] for p in BOUNDARIES]
        self.levels = levels

    def size(self, a: int, b: int) -> int:
        """Tokens of text[a:b], counted block by block."""
        i = max(bisect.bisect_right(self.edges, a) - 1, 0)
        total = 0
        while a < b and i + 1 < len(self.edges):
            end = min(b, self.edges[i + 1])
            if end > a:
                total += estimate(end - a) if self.tokens_of is None else self.tokens_of(self.text[a:end])
                a = end
            i += 1
        return total

    def cut(self, a: int, b: int) -> int:
        """The strongest boundary in the middle half of (a, b), the one nearest the midpoint; else the midpoint itself."""
        mid, reach = (a + b) / 2, (b - a) / 4
        for level in self.levels:
            lo, hi = bisect.bisect_left(level, mid - reach), bisect.bisect_right(level, mid + reach)
            near = [x for x in level[lo:hi] if a < x < b]
            if near:
                return min(near, key=lambda x: (abs(x - mid), x))
        return max(a + 1, int(mid))

    def start_of_overlap(self, a: int, b: int, most: int) -> int:
        """Where the repeated end of text[a:b] begins: at the strongest boundary, down to a clause, that uses at least three quarters of `most`, else at a word."""
        lo, hi = a, b
        while lo < hi:
            m = (lo + hi) // 2
            if self.size(m, b) <= most:
                hi = m
            else:
                lo = m + 1
        far = lo
        if far == a:
            return a
        for level in self.levels[:5]:
            k = bisect.bisect_left(level, far)
            if k < len(level) and level[k] < b and self.size(level[k], b) * 4 >= most * 3:
                return level[k]
        level = self.levels[5]
        k = bisect.bisect_left(level, far)
        return level[k] if k < len(level) and level[k] < b else far


def bisect_item(blocks: list[str | None], limit: int = 512, overlap: float = 0.12, tokens_of: Callable[[str], int] | None = None) -> list[tuple[int, int, int, int]]:
    """(overlap start, own start, end, tokens) of each piece over the joined text; none for an item within the limit.

    The own parts joined are the whole text. Null blocks count as empty. tokens_of defaults to ceil(characters / 4) per block.
    """
    item = _Item([b or "" for b in blocks], tokens_of)
    if item.size(0, len(item.text)) <= limit:
        return []
    shared = int(limit * overlap)
    parts, todo = [], [(0, len(item.text))]
    while todo:
        a, b = todo.pop()
        if item.size(a, b) <= limit - shared or b - a <= 1:
            parts.append((a, b))
        else:
            c = item.cut(a, b)
            todo += [(c, b), (a, c)]
    out = []
    for i, (a, b) in enumerate(parts):
        start = a if i == 0 else item.start_of_overlap(parts[i - 1][0], a, shared)
        while start < a and item.size(start, b) > limit:
            start += 1
        out.append((start, a, b, item.size(start, b)))
    return out


PIECES = "item_type string, item_key string, piece_no int, n_pieces int, overlap_chars int, token_count int, text string"


def split_oversized(items: DataFrame, limit: int = 512, overlap: float = 0.12) -> DataFrame:
    """Pieces of the items over the limit: item_type, item_key, piece_no (from 0), n_pieces, overlap_chars, token_count, text.

    items: item_type STRING, item_key STRING, blocks ARRAY<STRING>; other columns are ignored whatever their names. Only
    oversized items leave the scan, so the shuffle that merges repeated rows holds little. Of rows with the same type and
    key that differ, the one with the greatest text is cut. Null keys, null or empty block lists and null blocks: no tokens, no pieces.
    Texts without any boundary are cut at the midpoint. text[overlap_chars:] of an item's pieces joined in order is its text.
    """
    size = F.aggregate(F.coalesce("blocks", F.array().cast("array<string>")), F.lit(0).cast("bigint"), lambda n, b: n + F.ceil(F.length(F.coalesce(b, F.lit(""))) / F.lit(4)).cast("bigint"))
    big = items.select("item_type", "item_key", "blocks").filter(F.col("item_key").isNotNull() & (size > limit))
    big = big.groupBy("item_type", "item_key").agg(F.max("blocks").alias("blocks"))

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = []
            for kind, key, blocks in zip(pdf["item_type"], pdf["item_key"], pdf["blocks"]):
                text = "".join(b or "" for b in blocks)
                pieces = bisect_item(list(blocks), limit, overlap)
                rows += [(kind, key, i, len(pieces), a - s, t, text[s:b]) for i, (s, a, b, t) in enumerate(pieces)]
            yield pd.DataFrame(rows, columns=["item_type", "item_key", "piece_no", "n_pieces", "overlap_chars", "token_count", "text"])

    return big.mapInPandas(run, PIECES)


def corpus_items(chunk: DataFrame, section: DataFrame) -> DataFrame:
    """Chunks and sections as items."""
    c = chunk.select(F.lit("chunk").alias("item_type"), F.col("chunk_id").cast("string").alias("item_key"), F.array("text").alias("blocks"))
    s = section.select(F.lit("section").alias("item_type"), F.col("section_id").cast("string").alias("item_key"), F.col("blocks.text").alias("blocks"))
    return c.unionByName(s)


def oversized(chunk: DataFrame, section: DataFrame, limit: int = 512) -> DataFrame:
    """(item_type, item_key) of the items that the operator cut."""
    return split_oversized(corpus_items(chunk, section), limit).filter("piece_no = 0").select("item_type", "item_key")
