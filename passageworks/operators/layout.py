"""Positioned text lines to sections: gaps-and-islands over windows of one document, range joins over the outline.

lines: doc, page, y0, y1, x0, text, mono, heading, starts_mono (doc: any key that groups the lines of one section or file).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identity import pdf_doc_id
from ..functions.text import fence_code, normalize_prose, parameter_anchor, split_section_number, title_key
from ..session import materialize

TOP, BOTTOM = 0.065, 0.925
GAP_FACTOR, GAP_DEFAULT = 1.55, 12.0
CODE_RUN = 2
HEADING_SIZE = 11.5
PARAMETER = r"^([a-z][a-z0-9_]{2,})\s*\(([a-z][a-z ]*)\)$"


def is_mono(font: Column) -> Column:
    return F.lower(font).contains("courier") | F.lower(font).contains("mono")


def is_heading_font(font: Column) -> Column:
    return F.lower(font).contains("helvetica") & F.lower(font).contains("bold")


def lines_of_spans(spans: DataFrame) -> DataFrame:
    """Lines from spans (doc, page, line, span, y0, y1, x0, text, font, size): all mono, all heading font and large enough, first span mono."""
    chars = F.length(F.trim("text"))
    g = spans.groupBy("doc", "page", "line").agg(
        F.min("y0").alias("y0"), F.max("y1").alias("y1"), F.min("x0").alias("x0"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("span", "text"))), lambda s: s["text"]), "").alias("text"),
        F.sum(chars).alias("n"), F.sum(F.when(is_mono(F.col("font")), chars).otherwise(0)).alias("m"), F.sum(F.when(is_heading_font(F.col("font")), chars).otherwise(0)).alias("h"),
        F.max("size").alias("size"), F.min_by(is_mono(F.col("font")), "span").alias("starts_mono"),
    )
    return g.withColumn("mono", (F.col("n") > 0) & (F.col("m") == F.col("n"))).withColumn("heading", (F.col("n") > 0) & (F.col("h") == F.col("n")) & (F.col("size") > HEADING_SIZE)).drop("n", "m", "h")


def without_furniture(lines: DataFrame, height: Column) -> DataFrame:
    """Lines between the header and footer bands."""
    return lines.filter(~(F.col("y0") / height < TOP) & ~(F.col("y0") / height > BOTTOM))


def _order(*by: str):
    return Window.partitionBy(*by).orderBy("page", "y0", "x0")


def paragraphs(lines: DataFrame, by: str = "doc") -> DataFrame:
    """by, paragraph, page, text: a new paragraph after a page change or a gap over 1.55 times the median gap."""
    gap = F.when(F.lag("page").over(_order(by)) == F.col("page"), F.col("y0") - F.lag("y0").over(_order(by)))
    gapped = lines.withColumn("_gap", gap)
    usual = gapped.filter("_gap > 0").groupBy(by).agg(F.median("_gap").alias("_med"))
    gapped = gapped.join(usual, by, "left").withColumn("_limit", F.coalesce(F.col("_med"), F.lit(GAP_DEFAULT)) * GAP_FACTOR)
    first = F.lag("page").over(_order(by)).isNull()
    new = first | F.col("_gap").isNull() | (F.col("_gap") > F.col("_limit"))
    numbered = gapped.withColumn("_new", new.cast("int")).withColumn("paragraph", F.sum("_new").over(_order(by).rowsBetween(Window.unboundedPreceding, 0)))
    return _joined(numbered, [by, "paragraph"])


def _joined(rows: DataFrame, keys: list[str]) -> DataFrame:
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "y0", "x0", "text"))), lambda x: x["text"]), "\n")
    return rows.groupBy(*keys).agg(F.min("page").alias("page"), text.alias("text"))


def _runs(lines: DataFrame, by: str) -> DataFrame:
    """lines with `block`, the number of their run in by, and `kind`: runs of at least two mono lines are code, everything between them prose."""
    w = _order(by)
    run = lines.withColumn("_start", F.coalesce((F.lag("mono").over(w) != F.col("mono")).cast("int"), F.lit(1))).withColumn("_run", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    code = run.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(by, "_run"))).withColumn("_code", F.col("mono") & (F.col("_n") >= CODE_RUN))
    again = code.withColumn("_start", F.coalesce((F.lag("_code").over(w) != F.col("_code")).cast("int"), F.lit(1))).withColumn("block", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return again.withColumn("kind", F.when(F.col("_code"), "code").otherwise("prose"))


def blocks(lines: DataFrame, by: str = "doc") -> DataFrame:
    """by, block, kind, page, text: runs of at least two mono lines are code, everything between them prose."""
    return _joined(_runs(lines, by), [by, "block", "kind"])


def text_blocks(lines: DataFrame, by: str = "doc") -> DataFrame:
    """by, block, paragraph, kind, text: fenced code, and prose as one normalised text a paragraph, with words rejoined that lines had broken."""
    runs = materialize(_runs(lines, by), "runs").withColumn("_r", F.concat_ws("|", F.col(by), F.col("block").cast("string")))
    code = _joined(runs.filter("kind = 'code'"), [by, "block"]).select(by, "block", F.lit(0).cast("bigint").alias("paragraph"), F.lit("code").alias("kind"), fence_code(F.col("text")).alias("text"))
    prose = runs.filter("kind = 'prose'")
    name = prose.groupBy("_r").agg(F.first(by).alias(by), F.first("block").alias("block"))
    prose = paragraphs(prose, "_r").join(name, "_r").select(by, "block", "paragraph", F.lit("prose").alias("kind"), normalize_prose(F.col("text"), from_pdf=True).alias("text"))
    return code.unionByName(prose).filter("text <> ''")


def split_at(lines: DataFrame, starts: Column, by: str = "doc") -> DataFrame:
    """lines with `part`: 0 before the first line that starts one, then counted up."""
    w = _order(by).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("part", F.sum(F.coalesce(starts, F.lit(False)).cast("int")).over(w))


def split_headings(lines: DataFrame, by: str = "doc") -> DataFrame:
    return split_at(lines, F.col("heading"), by)


def starts_parameter() -> Column:
    return F.col("starts_mono") & F.trim("text").rlike(PARAMETER)


def split_parameters(lines: DataFrame, by: str = "doc") -> DataFrame:
    """Parameter sections (by, part, name, type, page, text); a parameter without any further line has no row."""
    parts = split_at(lines, starts_parameter(), by).filter("part > 0")
    head = parts.filter(starts_parameter()).select(by, "part", F.regexp_extract(F.trim("text"), PARAMETER, 1).alias("name"), F.regexp_extract(F.trim("text"), PARAMETER, 2).alias("type"))
    return head.join(_joined(parts.filter(~starts_parameter()), [by, "part"]), [by, "part"])


def _deepest(entries: DataFrame) -> int:
    """The greatest level, 1 at least."""
    return max(1, int(entries.agg(F.max("level")).first()[0] or 1))


def outline_ends(outline: DataFrame, pages: int, doc: str = "doc") -> DataFrame:
    """outline (doc, index, level, title, page) with end_page (page of the next entry of the same or a higher level, else `pages`), end_index (that
    entry, null at the end) and path.

    The next entry is found per level: for each of the few levels up to the entry's own, the nearest later index of that level by a
    window, and the least of them. The greatest level is taken from the data.
    """
    w = Window.partitionBy(doc).orderBy("index").rowsBetween(1, Window.unboundedFollowing)
    u = Window.partitionBy(doc).orderBy("index").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    top = _deepest(outline)
    nxt = [F.first(F.when(F.col("level") == n, F.struct("index", "page")), ignorenulls=True).over(w).alias(f"_n{n}") for n in range(1, top + 1)]
    last = [F.last(F.when(F.col("level") == n, F.struct("index", "title")), ignorenulls=True).over(u).alias(f"_u{n}") for n in range(1, top + 1)]
    e = outline.select("*", *nxt, *last)
    after = F.array_compact(F.array(*[F.when(F.lit(n) <= F.col("level"), F.col(f"_n{n}")) for n in range(1, top + 1)]))
    end = F.coalesce(F.array_min(after)["page"], F.lit(pages))
    # An ancestor at level n is the last entry of level n, unless an entry of a higher level came after it.
    up = []
    for n in range(1, top + 1):
        over = F.greatest(F.lit(-1), *[F.coalesce(F.col(f"_u{m}.index"), F.lit(-1)) for m in range(1, n)]) if n > 1 else F.lit(-1)
        up.append(F.when((F.lit(n) <= F.col("level")) & (F.col(f"_u{n}.index") > over), F.col(f"_u{n}.title")))
    return e.withColumn("end_page", end).withColumn("end_index", F.array_min(after)["index"]).withColumn("path", F.array_compact(F.array(*up))).drop(*[f"_n{n}" for n in range(1, top + 1)], *[f"_u{n}" for n in range(1, top + 1)])


def locate_headings(outline: DataFrame, lines: DataFrame) -> DataFrame:
    """outline with y: the first line on its page whose key equals the title's, or (of 8 or more characters) begins it; else 0."""
    l = lines.select("doc", "page", "y0", title_key(F.col("text")).alias("_k")).filter("_k <> ''")  # noqa: E741
    o = outline.withColumn("_t", title_key(F.col("title")))
    hit = (F.col("_k") == F.col("_t")) | ((F.length("_k") >= 8) & F.startswith("_t", "_k"))
    y = o.select("doc", "index", "page", "_t").join(l, ["doc", "page"]).filter(hit).groupBy("doc", "index").agg(F.min("y0").alias("y"))
    return o.join(y, ["doc", "index"], "left").fillna(0.0, ["y"]).drop("_t")


def assign_lines(lines: DataFrame, starts: DataFrame) -> DataFrame:
    """lines with the `index` of the last start (doc, index, page, y) at or before them: an as-of join as one sorted pass."""
    s = starts.select("doc", "page", F.col("y").alias("y0"), F.lit(None).cast("double").alias("x0"), F.lit(0).alias("_side"), "index")
    both = lines.withColumn("_side", F.lit(1)).withColumn("index", F.lit(None).cast(starts.schema["index"].dataType)).unionByName(s, allowMissingColumns=True)
    w = Window.partitionBy("doc").orderBy("page", "y0", "_side").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("index", F.last("index", ignorenulls=True).over(w)).filter("_side = 1").drop("_side")


def wanted_titles(documents: DataFrame) -> DataFrame:
    """title key -> context key of the last document with that title: the first path element unless it is the title itself."""
    first = F.element_at(F.filter(F.transform("sections", lambda s: s["path"]), lambda p: F.size(p) > 1), 1)
    d = documents.filter((F.coalesce("title", F.lit("")) != "") & (F.size("sections") > 0)).select(title_key(F.col("title")).alias("key"), title_key(F.try_element_at(first, F.lit(1))).alias("_c"), "ordinal")
    return d.groupBy("key").agg(F.max_by(F.when(F.col("_c") != F.col("key"), F.col("_c")), "ordinal").alias("context"))


def matched_entries(outline: DataFrame, wanted: DataFrame) -> DataFrame:
    """Outline entries (with path) whose title is wanted and whose ancestors include the context, if there is one."""
    o = outline.withColumn("key", title_key(F.col("title"))).withColumn("_up", F.transform("path", lambda p: title_key(p)))
    return o.join(wanted, "key").filter(F.col("context").isNull() | F.array_contains("_up", F.col("context"))).drop("_up", "key", "context")


def select_roots(entries: DataFrame, outermost: bool = True) -> DataFrame:
    """Entries (doc, index, level, page, end_page) that no other one encloses (or, innermost, that enclose none).

    In outline order an entry is enclosed if an earlier one of a lower level ends at or behind its end, so a running maximum decides.
    """
    w = Window.partitionBy("doc").orderBy("index").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("doc").orderBy("index").rowsBetween(1, Window.unboundedFollowing)
    top = max(2, _deepest(entries))
    if outermost:
        ends = [F.max(F.when(F.col("level") == n, F.col("end_page"))).over(w).alias(f"_e{n}") for n in range(1, top)]
        hit = F.exists(F.array(*[F.struct(F.lit(n).alias("l"), F.col(f"_e{n}").alias("e")) for n in range(1, top)]), lambda x: (x["l"] < F.col("level")) & (x["e"] >= F.col("end_page")))
    else:
        ends = [F.min(F.when(F.col("level") == n, F.col("end_page"))).over(after).alias(f"_e{n}") for n in range(2, top + 1)]
        hit = F.exists(F.array(*[F.struct(F.lit(n).alias("l"), F.col(f"_e{n}").alias("e")) for n in range(2, top + 1)]), lambda x: (x["l"] > F.col("level")) & (x["e"] <= F.col("end_page")))
    e = entries.select("*", *ends).withColumn("_hit", F.coalesce(hit, F.lit(False)))
    return e.filter("NOT _hit").select(*entries.columns)


def extract_documents(lines: DataFrame, outline: DataFrame, pages: int, wanted: DataFrame | None = None, outermost: bool = True, version: str = "18") -> DataFrame:
    """Documents of a laid-out manual: one per selected outline entry, with a section per entry below it, per heading the outline
    lacks, and per parameter; sections are in reading order.

    Every outline entry is a half-open interval that begins at its heading, so a line belongs to one section only; lines are
    assigned by one sorted pass. Each later step is a window over the lines of one section.
    """
    o = outline_ends(outline, pages)
    roots = select_roots(o if wanted is None else matched_entries(o, wanted), outermost)
    root = roots.select("doc", "index", F.struct(F.col("index").alias("root"), "end_index", F.col("title").alias("root_title"), F.col("page").alias("root_page"), F.col("end_page").alias("root_end"), F.size("path").alias("depth")).alias("r"))
    w = Window.partitionBy("doc").orderBy("index").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    member = o.join(root, ["doc", "index"], "left").withColumn("r", F.last("r", ignorenulls=True).over(w))
    member = member.filter("r IS NOT NULL AND (r.end_index IS NULL OR index < r.end_index)")
    starts = locate_headings(outline, lines)
    e = member.join(starts.select("doc", "index", "y"), ["doc", "index"]).select("doc", "index", "level", "title", "path", F.col("page").alias("e_page"), "y", "r")
    own = assign_lines(lines, starts).join(e, ["doc", "index"])
    own = own.filter(~((F.col("page") == F.col("e_page")) & (F.col("y0") == F.col("y")) & (title_key(F.col("text")) != "") & F.startswith(title_key(F.col("title")), title_key(F.col("text")))))
    own = own.withColumn("_s", F.concat_ws("|", "doc", F.col("index").cast("string")))
    own = split_headings(own, "_s").withColumnRenamed("part", "h").withColumn("_s", F.concat_ws("|", "_s", F.col("h").cast("string")))
    own = materialize(own, "lines")  # what follows reads it several times
    heads = own.filter("heading").groupBy("_s").agg(F.min_by("text", F.struct("page", "y0")).alias("sub"))
    own = split_at(own.filter("NOT heading"), starts_parameter(), "_s").withColumn("_p", F.concat_ws("|", "_s", F.col("part").cast("string")))
    own = materialize(own, "parts")
    names = own.filter((F.col("part") > 0) & starts_parameter()).groupBy("_p").agg(F.first(F.trim("text")).alias("param"))
    body = text_blocks(own.filter(~((F.col("part") > 0) & starts_parameter())), "_p")
    body = body.groupBy("_p").agg(F.array_sort(F.collect_list(F.struct("block", "paragraph", F.struct("kind", "text", F.lit(None).cast("string").alias("lang")).alias("b")))).alias("bs"))
    meta = own.groupBy("_p", "_s", "doc", "index", "h", "part").agg(F.first("level").alias("level"), F.first("title").alias("title"), F.first("path").alias("path"), F.min("page").alias("page"), F.first("r").alias("r"))
    s = meta.join(heads, "_s", "left").join(names, "_p", "left").join(body, "_p", "left").filter("bs IS NOT NULL")
    number = split_section_number(F.coalesce("param", "sub", "title"))
    # Paths begin at the selected root, as those of the pages do.
    path = F.concat(F.transform(F.slice("path", F.greatest(F.col("r.depth"), F.lit(1)), F.size("path")), lambda p: split_section_number(p)["title"]), F.array_compact(F.array(split_section_number(F.col("sub"))["title"], F.col("param"))))
    section = F.struct(
        number["title"].alias("title"), (F.col("level") + F.col("sub").isNotNull().cast("int") + F.col("param").isNotNull().cast("int")).alias("level"), path.alias("path"),
        F.coalesce(F.transform("bs", lambda b: b["b"]), F.array().cast("array<struct<kind:string,text:string,lang:string>>")).alias("blocks"),
        F.when(F.col("param").isNotNull(), parameter_anchor(F.regexp_extract("param", PARAMETER, 1))).alias("anchor"), F.when(F.coalesce("param", "sub").isNull(), number["number"]).alias("number"),
        F.when(F.col("param").isNotNull(), "parameter").otherwise("section").alias("kind"), F.col("page").cast("int").alias("page"),
    )
    d = s.groupBy("doc", "r").agg(F.array_sort(F.collect_list(F.struct("index", "h", "part", section.alias("s")))).alias("x"))
    title = split_section_number(F.col("r.root_title"))["title"]
    return d.select(
        pdf_doc_id(title_key(F.col("r.root_title")), F.col("r.root_page")).alias("doc_id"), F.lit("pdf").alias("source_format"), F.lit(version).alias("pg_version"), title.alias("title"),
        F.transform("x", lambda v: v["s"]).alias("sections"), F.lit(None).cast("string").alias("source_url"), F.col("r.root_page").alias("page_start"), F.col("r.root_end").alias("page_end"), F.col("r.root").alias("ordinal"),
    )


def unmatched_titles(wanted: DataFrame, outline: DataFrame) -> DataFrame:
    """Wanted titles that no outline entry has."""
    return wanted.join(outline.select(title_key(F.col("title")).alias("key")), "key", "left_anti")


def profile_fonts(spans: DataFrame) -> DataFrame:
    return spans.groupBy("font", "size").agg(F.sum(F.length("text")).alias("chars"))
