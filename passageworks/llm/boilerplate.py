"""Main body of web pages by nearest-URL page differencing.

Pages are put in order of (host, URL path), so a page's neighbours are the pages of its site with the nearest URLs. Each page is
aligned with its neighbours line by line, by a longest common subsequence over line templates (numbers, the host, the page's
own title and title phrases are placeholders), and shared lines are what the site puts around its pages. Pages go through the alignment
as arrays of template hashes, so a long page is a few bytes a line and the alignment is exact at every length. One range-partitioned sort
brings neighbours together; the pages at the ends of ranges meet in a second, small pass, so it doesn't matter where ranges end.

What the shared lines show is then carried to the whole corpus. A template that most of its pages on a site share is furniture there. One
that is furniture on several sites, or that pages of different content hold on several sites, is furniture everywhere, which serves
sites with a single page that have nothing to be aligned with. It is none if more of the sites with neighbours show it on single pages than
share it: that is how lines that authors have in common look (labelled notes, quotations). Pages of one content, such as mirrors, count
once. A short line that is mostly followed by prose in the same block is a heading; rows of a table are body. Titles that follow a list label of the furniture (related pages, contents) go with
it, and so does a block of nothing but three or more titles. What stands before the page's own title line is not body.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

NEIGHBOURS = 2
#: Sites whose agreement makes a template furniture where no alignment can tell.
WIDE = 3
#: A template of a site with more than this share of all lines is joined by broadcast: at most HOT_LINES of them can exist.
HOT_LINES = 2_000
#: Words of an entry of a link row or menu, at most.
ENTRY_WORDS = 3
#: Bits of alignment state kept for the way back; longer pages are halved first, with the same result.
STATE_BITS = 400_000_000
TITLE, PHRASE, HOST, CELL = "<T>", "<L>", "<H>", " ¦ "
#: What kind of line it is, and what the alignment shows.
TITLED, OWN, BEFORE_PROSE, BEFORE_TITLE, ROW, SHORT, LINKS = (1 << i for i in range(7))
SHARED, FIRST, HIT, MET = 1, 2, 4, 8

_PHRASE = re.compile(r"[A-Z][A-Za-z]*[a-z][A-Za-z]*(?: (?:and |of |the |for )?[A-Z][A-Za-z]*)+")
_BARE = re.compile(rf"(?:The )?(?:{_PHRASE.pattern})$")
_GAP = re.compile(r"\s*\t\s*|\s{2,}")
_DIGITS = re.compile(r"\d+")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"\w+")
_PROSE = re.compile(r"[.!?:;]$|`")
_NO_LINKS = re.compile(r"[0-9_]|[.!?]$")


def template(line: str, host: str, title: str) -> tuple[str, bool]:
    """The line with what differs between the pages of a site replaced, empty for a blank line; and whether it is nothing but
    a title. A bare title is its own template. Cells set apart by tabs or wide gaps are treated one by one."""
    cells = [_SPACE.sub(" ", c).strip() for c in _GAP.split(line.strip())]
    t = CELL.join(c for c in cells if c)
    if title and t == title:
        return TITLE, True
    if len(cells) == 1 and _BARE.match(t):
        return t, True
    if host:
        t = t.replace(host, HOST)
    if title and title in t:
        t = t.replace(title, PHRASE)
    return _DIGITS.sub("#", _PHRASE.sub(PHRASE, t)), False


def lcs(a: list, b: list) -> list[tuple[int, int]]:
    """Index pairs of a longest common subsequence, in order; exact at every length.

    One bit of state for each item of b, updated for each item of a by whole-number arithmetic; the way back reads the kept
    states. Where those would exceed STATE_BITS, a is halved and the best place to halve b found from both ends first.
    """
    common = set(a) & set(b)
    ia, ib = [i for i, x in enumerate(a) if x in common], [j for j, x in enumerate(b) if x in common]
    head = 0
    while head < len(ia) and head < len(ib) and a[ia[head]] == b[ib[head]]:
        head += 1
    tail = 0
    while tail < min(len(ia), len(ib)) - head and a[ia[-1 - tail]] == b[ib[-1 - tail]]:
        tail += 1
    xs, ys = ia[head : len(ia) - tail], ib[head : len(ib) - tail]
    found = _align([a[i] for i in xs], [b[j] for j in ys])
    return list(zip(ia[:head], ib[:head])) + [(xs[i], ys[j]) for i, j in found] + list(zip(ia[len(ia) - tail :], ib[len(ib) - tail :]))


def _states(a: list, b: list) -> Iterator[int]:
    """After each item of a, a whole number whose bit j is 0 where the common length grows between b[:j] and b[:j + 1]."""
    at: dict = {}
    for j, x in enumerate(b):
        at[x] = at.get(x, 0) | 1 << j
    every = (1 << len(b)) - 1
    v = every
    for x in a:
        u = v & at.get(x, 0)
        v = (v + u | v - u) & every
        yield v


def _lengths(a: list, b: list) -> np.ndarray:
    """Common length of a with each b[:j]."""
    v = (1 << len(b)) - 1
    for v in _states(a, b):  # noqa: B007
        pass
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def _align(a: list, b: list) -> list[tuple[int, int]]:
    if not a or not b:
        return []
    if len(a) > 1 and len(a) * len(b) > STATE_BITS:
        m = len(a) // 2
        k = int(np.argmax(_lengths(a[:m], b) + _lengths(a[m:][::-1], b[::-1])[::-1]))
        return _align(a[:m], b[:k]) + [(i + m, j + k) for i, j in _align(a[m:], b[k:])]
    states = list(_states(a, b))
    i, j, out = len(a), len(b), []
    while i and j:
        if states[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or states[i - 1] >> (j - 1) & 1:
                j -= 1
                out.append((i, j))
    return out[::-1]


_LINES = "slug string, host string, block_ord int, block_id bigint, line_no int, line string, key bigint, bits int"


def _lines(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The non-blank lines of blocks with the hash of their template and what kind of line they are."""
    names = [c.split()[0] for c in _LINES.split(", ")]
    types = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int32()]
    for batch in it:
        cols = [[] for _ in names]
        for slug, host, title, order, block, text in zip(*(batch.column(c).to_pylist() for c in ("slug", "host", "title", "block_ord", "block_id", "text"))):
            lines = text.split("\n")
            told = [(k, x.strip(), *template(x, host, title or "")) for k, x in enumerate(lines, 1)]
            told = [x for x in told if x[2]]
            for i, (k, line, t, bare) in enumerate(told):
                after = told[i + 1] if i + 1 < len(told) else None
                prose = after is not None and not after[3] and len(after[1].split()) > 3 and _PROSE.search(after[1]) is not None
                bits = bare * TITLED | (t == TITLE) * OWN | prose * BEFORE_PROSE | (after is not None and after[3]) * BEFORE_TITLE
                bits |= t.startswith("|") * ROW | (t.count(" ") < 4) * SHORT | (not _NO_LINKS.search(line)) * LINKS
                key = xxhash.xxh64_intdigest(t) - (1 << 63)
                for c, v in zip(cols, (slug, host, order, block, k, line, key, bits | min(len(t), 1 << 20) << 8)):
                    c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)


class _Page:
    """A page in URL order: the hashes that can be aligned, which of its lines are shared, and whether it has met a neighbour."""

    __slots__ = ("host", "keys", "met", "place", "shared", "tpl", "use")

    def __init__(self, host: str, place: int, keys: np.ndarray, bits: np.ndarray, marks: list[int] | None):
        self.host, self.place, self.keys = host, place, keys
        self.use = np.flatnonzero(bits & OWN == 0)
        self.tpl = keys[self.use].tolist()
        old = np.zeros(len(keys), np.int8) if marks is None else np.array(marks, np.int8)
        self.shared, self.met = old & SHARED != 0, bool((old & MET).any())

    def meet(self, other: _Page) -> None:
        self.met = other.met = True
        pairs = lcs(self.tpl, other.tpl)
        if pairs:
            i, j = zip(*pairs)
            self.shared[self.use[list(i)]] = True
            other.shared[other.use[list(j)]] = True

    def marks(self) -> np.ndarray:
        """For each line whether it is shared, whether it is the first of its template on the page and one of those is shared, and met."""
        _, first, which = np.unique(self.keys, return_index=True, return_inverse=True)
        out = self.shared.astype(np.int8) * SHARED + np.int8(self.met * MET)
        out[first] += np.int8(FIRST) + np.int8(HIT) * (np.bincount(which[self.shared], minlength=len(first)) > 0).astype(np.int8)
        return out


def _difference(edges: bool):
    """Pages in URL order; each meets the next NEIGHBOURS pages of its host. Adds `marks` for each line, and `place` in the range for the
    pages within NEIGHBOURS of its ends. With `edges`, those pages of all ranges, in order, meet again, now across ranges."""

    def out(batch: pa.RecordBatch, pages: list[_Page], last: int) -> pa.RecordBatch:
        place = [p.place if p.place < NEIGHBOURS or last - p.place < NEIGHBOURS else None for p in pages]
        keep = [batch.column(c) for c in _KEPT]
        return pa.RecordBatch.from_arrays([*keep, pa.array([p.marks() for p in pages], pa.list_(pa.int8())), pa.array(place, pa.int32())], names=[*_KEPT, "marks", "place"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: deque[tuple[pa.RecordBatch, list[_Page]]] = deque()
        near: deque[_Page] = deque(maxlen=NEIGHBOURS)
        place, base, of = -1, 0, None
        for batch in it:
            if not len(batch):
                continue
            xs = batch.column("xs")
            flat, ends = xs.flatten(), np.cumsum(xs.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).tolist()
            key, bits = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("key", "bits"))
            old, told = (batch.column(c).to_pylist() if edges else [None] * len(batch) for c in ("marks", "place"))
            pages, begin = [], 0
            for k, (host, rng) in enumerate(zip(batch.column("host").to_pylist(), batch.column("range").to_pylist())):
                if rng != of:
                    of, base = rng, place + 1
                place = base + told[k] if edges else place + 1
                page = _Page(host, place, key[begin : ends[k]], bits[begin : ends[k]], old[k])
                begin = ends[k]
                for p in near:
                    if p.host == host and place - p.place <= NEIGHBOURS:
                        p.meet(page)
                near.append(page)
                pages.append(page)
            held.append((batch, pages))
            while held[0][1][-1].place + NEIGHBOURS <= place and not any(p is q for p in held[0][1] for q in near):
                yield out(*held.popleft(), place)
        for x in held:
            yield out(*x, place)

    return run


def address(url):
    """(host, path) columns of a URL: lower-case host without port, path without query, fragment and trailing slash."""
    u = F.trim(url)
    host = F.lower(F.regexp_extract(u, r"^(?i:[a-z][a-z0-9+.-]*:)?//(?:[^/@]*@)?([^/:?#]+)", 1))
    path = F.regexp_replace(F.lower(F.regexp_extract(u, r"^(?i:[a-z][a-z0-9+.-]*:)?//[^/?#]*([^?#]*)", 1)), r"/+$", "")
    return host, path


_KEPT = ("slug", "host", "path", "witness", "range", "xs")
_PAGE = "slug string, host string, path string, witness boolean, range int, xs array<struct<block_ord:int,block_id:bigint,line_no:int,key:bigint,bits:int>>, marks array<tinyint>, place int"


def _bit(name: int, of: str = "bits") -> Column:
    return F.col(of).bitwiseAND(F.lit(name)) != 0


def _sum(test: Column) -> Column:
    return F.sum(test.cast("bigint"))


def _read_lines(blocks: DataFrame, manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every non-blank line once (slug, host, block_ord, block_id, line_no, line, key, bits), and each page's slug and path."""
    one = blocks.select("block_id", "slug", "url", "block_ord", F.col("text").cast("string").alias("text")).filter("block_id IS NOT NULL AND text IS NOT NULL")
    one = one.groupBy("block_id").agg(F.min(F.struct("slug", "block_ord", "text", "url")).alias("b")).select("block_id", F.coalesce("b.slug", F.lit("")).alias("slug"), F.coalesce("b.block_ord", F.lit(0)).cast("int").alias("block_ord"), "b.text", "b.url")
    title = F.trim(F.regexp_replace("title", r"\s+", " "))
    told = manifest.filter("slug IS NOT NULL").select("slug", F.col("url").alias("m_url"), F.lit(None).cast("string").alias("b_url"), F.when(title != "", F.struct(F.coalesce("fetched_at", F.lit("")).alias("at"), title.alias("title"))).alias("named"))
    told = told.unionByName(one.select("slug", F.lit(None).cast("string").alias("m_url"), F.col("url").alias("b_url"), F.lit(None).cast("struct<at:string,title:string>").alias("named")))
    told = told.groupBy("slug").agg(F.max("m_url").alias("m"), F.max("b_url").alias("b"), F.max("named")["title"].alias("title"))
    host, path = address(F.coalesce("m", "b"))
    told = told.select("slug", F.coalesce(F.nullif(host, F.lit("")), F.concat(F.lit("?"), "slug")).alias("host"), path.alias("path"), "title")
    read = one.join(told, "slug").select("slug", "host", "title", "block_ord", "block_id", "text").mapInArrow(_lines, _LINES)
    return materialize(read, "lines"), told.select("slug", "path")


def _aligned(lines: DataFrame, paths: DataFrame) -> DataFrame:
    """Each line with what the alignment shows: slug, host, witness, early, block_id, line_no, key, bits, marks.

    Of the pages whose longest line is the same, those of one host are witnesses; the others may be mirrors and prove nothing more.
    """
    content = lines.groupBy("slug", "host").agg(F.max(F.struct(F.shiftright("bits", 8).alias("n"), "key"))["key"].alias("content"))
    witness = content.join(content.groupBy("content").agg(F.min("host").alias("_h")), "content").select("slug", (F.col("host") == F.col("_h")).alias("witness"))
    pages = lines.groupBy("slug", "host").agg(F.sort_array(F.collect_list(F.struct("block_ord", "block_id", "line_no", "key", "bits"))).alias("xs"))
    pages = materialize(pages.join(paths, "slug").join(witness, "slug"), "pages")
    order = ["host", "path", "slug"]
    ranged = pages.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("range", F.spark_partition_id())
    first = materialize(ranged.select(*_KEPT).mapInArrow(_difference(False), _PAGE), "differences")
    # At most 2 * NEIGHBOURS pages a range.
    edges = first.filter("place IS NOT NULL").repartition(1).sortWithinPartitions("range", "place").mapInArrow(_difference(True), _PAGE)
    both = first.filter("place IS NULL").unionByName(edges)
    own = F.array_position(F.transform("xs", lambda x: x["bits"].bitwiseAND(F.lit(OWN)) != 0), True)  # 0: no own title
    flat = both.select("slug", "host", "witness", own.alias("own"), F.posexplode(F.arrays_zip("xs", "marks")).alias("at", "x"))
    flat = flat.select("slug", "host", "witness", (F.col("at") + 1 < F.col("own")).alias("early"), "x.xs.block_id", "x.xs.line_no", "x.xs.key", "x.xs.bits", "x.marks")
    return materialize(flat, "aligned")


def _templates(flat: DataFrame) -> DataFrame:
    """host, key, n, list: the templates that are furniture on the host; list: titles mostly follow."""
    titled = F.max(_bit(TITLED)).alias("titled")
    on_site = flat.groupBy("host", "key").agg(titled, _sum(_bit(FIRST, "marks")).alias("pages"), _sum(_bit(HIT, "marks")).alias("hits"), F.count(F.lit(1)).alias("n"), _sum(_bit(BEFORE_PROSE)).alias("prose"), _sum(_bit(BEFORE_TITLE)).alias("titles"), F.max(_bit(ROW) | _bit(OWN)).alias("off"), F.max(_bit(SHORT)).alias("short"), F.max("witness").alias("witness"), F.max(_bit(MET, "marks")).alias("met"))
    on_site = on_site.withColumn("site", (F.col("pages") >= F.when(F.col("titled"), 3).otherwise(2)) & (F.col("hits") * 2 >= F.col("pages")))
    overall = on_site.groupBy("key").agg(_sum(F.col("site")).alias("sites"), _sum(F.col("met") & ~F.col("site")).alias("against"), _sum(~F.col("titled") & F.col("witness")).alias("hosts"), (F.sum("prose") / F.sum("n")).alias("prose_share"), (F.sum("titles") / F.sum("n")).alias("title_share"), F.max("off").alias("off"), F.max("short").alias("short"))
    overall = overall.withColumn("wide", (F.col("sites") >= 2) | (F.col("hosts") >= WIDE))
    # More sites with neighbours that show it on single pages than that share it: their authors wrote it.
    heading = F.col("short") & (F.col("prose_share") >= 0.5)
    overall = overall.filter((F.col("against") <= F.col("sites")) & ~F.col("off") & ~heading & ((F.col("sites") > 0) | F.col("wide")))
    here = on_site.select("host", "key", "site", "n").join(overall.select("key", "wide", (F.col("title_share") >= 0.4).alias("list")), "key").filter("site OR wide")
    return materialize(here.select("host", "key", "n", "list"), "templates")


def _with_templates(rows: DataFrame, known: DataFrame, total: int) -> DataFrame:
    """Rows (host, key, block_id, line_no, ...) with `list` of their template on their host, null where it is not known.

    Templates that make up more than 1 / HOT_LINES of the `total` lines, of which there can be no more than HOT_LINES, are broadcast, and
    rows that have found theirs are spread over the tasks of the join with the others.
    """
    hot = F.broadcast(known.filter(F.col("n") * HOT_LINES > total).select("host", "key", F.col("list").alias("_hot")))
    cold = known.filter(F.col("n") * HOT_LINES <= total).select("host", F.col("key").alias("_key"), F.lit(False).alias("_done"), "list")
    rows = rows.join(hot, ["host", "key"], "left").withColumn("_done", F.col("_hot").isNotNull())
    rows = rows.withColumn("_key", F.when(F.col("_done"), F.xxhash64("block_id", "line_no")).otherwise(F.col("key")))
    return rows.join(cold, ["host", "_key", "_done"], "left").withColumn("list", F.coalesce("_hot", "list")).drop("_hot", "_done", "_key")


def page_lines(blocks: DataFrame, manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(marked, lines). marked: block_id, line_no, furniture of every non-blank line; lines: slug, block_ord, block_id, line_no, line.

    blocks: block_id, slug, url, block_ord, text; manifest: slug, url, title, fetched_at; other columns are not read. Rows that
    repeat a block_id count once, and of a page's fetches the latest names its title. Addresses are compared without
    scheme, case of the host, query and fragment; a page whose address is nowhere recorded is its own site. Null texts and blank
    lines have no row. A page missing from the manifest has no known title; an empty input has an empty result. A page's lines are
    aligned in one task, at 28 bytes a line. Templates are told apart by 64-bit hashes.
    """
    lines, paths = _read_lines(blocks, manifest)
    flat = _aligned(lines, paths)
    known, total = _templates(flat), flat.count()

    texts = lines.filter(_bit(LINKS)).select("host", "key", "block_id", "line_no", "line")
    links = _link_rows(texts, _link_entries(_with_templates(texts, known, total).filter("list IS NOT NULL")))
    rows = _with_templates(flat.select("host", "key", "block_id", "line_no", "bits", "early"), known, total).join(links, ["block_id", "line_no"], "left")
    by_block = Window.partitionBy("block_id").orderBy("line_no")
    beside = (F.lag("links").over(by_block) > 0) | (F.lead("links").over(by_block) > 0)
    row = F.coalesce((F.col("links") == 2) | ((F.col("links") == 1) & beside), F.lit(False)) & ~_bit(ROW) & ~_bit(OWN)
    known_here = F.col("list").isNotNull()
    # A title that is known only as a link does not end the list that it stands in.
    label = F.when(~_bit(TITLED) | known_here | _bit(OWN), F.struct((known_here | row).alias("known"), F.coalesce("list", F.lit(False)).alias("list")))
    rows = rows.select("block_id", "line_no", "early", (known_here | row).alias("known"), (_bit(TITLED) & ~_bit(OWN)).alias("other"), label.alias("label"))
    before = F.last("label", ignorenulls=True).over(by_block.rowsBetween(Window.unboundedPreceding, -1))
    whole = Window.partitionBy("block_id")
    n, others = F.count(F.lit(1)).over(whole), F.sum(F.col("other").cast("int")).over(whole)
    listed = (F.col("other") & F.coalesce(before["known"] & before["list"], F.lit(False))) | ((n >= 3) & (others == n))
    return rows.select("block_id", "line_no", (F.col("known") | listed | F.col("early")).alias("furniture")), lines


def _link_entries(known: DataFrame) -> DataFrame:
    """e: entries of link rows and menus: furniture lines of up to three words, and what separators set apart in longer ones, on
    at least 2 sites, however many sites there are."""
    entry = known.select("host", F.explode(F.split("line", r"\s*(?:[|·»›•/*]|\s{2,}|\t)\s*")).alias("e")).withColumn("e", F.lower(F.trim("e")))
    entry = entry.filter(F.col("e").rlike(r"^\p{L}[\p{L} ]{1,30}$") & (F.size(F.split("e", " ")) <= ENTRY_WORDS))
    return entry.groupBy("e").agg(F.min("host").alias("one"), F.max("host").alias("other")).filter("one <> other").select("e")


def _runs(line: str) -> list[list[str]]:
    """For each word of the line, in lower case, the runs of one to ENTRY_WORDS words that begin with it and stand one space apart."""
    x = line.lower()
    at = [m.span() for m in _WORD.finditer(x)]
    out = []
    for i, (begin, end) in enumerate(at):
        out.append([x[begin:end]])
        for left, right in at[i + 1 : i + ENTRY_WORDS]:
            if x[end:left] != " ":
                break
            end = right
            out[-1].append(x[begin:end])
    return out


def _link_rows(texts: DataFrame, entries: DataFrame) -> DataFrame:
    """(block_id, line_no, links) of lines that hold entries and no other word. links: 2 is a row of three or more entries or a starred
    entry, 1 is one or two entries. Read from the left, the longest entry counts.

    Each different line's runs of words are joined with the entries, so neither the number of entries nor of lines is bound.
    """

    def runs(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pd.DataFrame([(x, e) for x in pdf["line"] for e in {r for rs in _runs(x) for r in rs}], columns=["line", "e"])

    @F.pandas_udf("int")
    def links(line: pd.Series, known: pd.Series) -> pd.Series:
        out = []
        for x, have in zip(line, known):
            have, words, i, n = set(have), _runs(x), 0, 0
            while i < len(words):
                k = max((k for k, r in enumerate(words[i], 1) if r in have), default=0)
                if not k:
                    break
                i, n = i + k, n + 1
            out.append(0 if i < len(words) else 2 if n >= 3 or x.startswith("* ") else 1)
        return pd.Series(out, dtype="int32")

    held = texts.select("line").distinct().mapInPandas(runs, "line string, e string").join(entries, "e")
    found = held.groupBy("line").agg(F.collect_set("e").alias("e")).select("line", links("line", "e").alias("links")).filter("links > 0")
    return materialize(texts.select("line", "block_id", "line_no").join(found, "line").select("block_id", "line_no", "links"), "links")


def body_text(blocks: DataFrame, manifest: DataFrame) -> DataFrame:
    """slug, body: each page's remaining lines in page order; pages without body lines have no row."""
    marked, lines = page_lines(blocks, manifest)
    keep = lines.select("slug", "block_ord", "block_id", "line_no", "line").join(marked.filter("NOT furniture"), ["block_id", "line_no"])
    return keep.groupBy("slug").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block_ord", "block_id", "line_no", "line"))), lambda x: x["line"]), "\n").alias("body"))


def furniture_lines(blocks: DataFrame, manifest: DataFrame) -> DataFrame:
    """(block_id, line_no) of the lines that are not body."""
    return page_lines(blocks, manifest)[0].filter("furniture").select("block_id", "line_no")
