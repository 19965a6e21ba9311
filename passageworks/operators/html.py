"""HTML pages to sections, on the standard library's parser.

A page becomes a small tree; whatever turns a part of it into text reads the flat stream of its events (an element opens, text, it closes).
Deliberate choices: comments are no text; a list at any depth inside an item is indented below it; a definition list inside a definition
is one block of the parameter, told once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import code_text, fold_text

# Elements and classes of the manual's markup.
SECTION_CLASSES = frozenset("sect1 sect2 sect3 sect4 sect5 refsect1 refsect2 refsect3 refentry refsynopsisdiv chapter preface appendix part glossdiv bibliodiv article".split())
NOISE_CLASSES = frozenset("navheader navfooter toc footnotes id_link indexterm".split())
NOISE_TAGS = frozenset(("script", "style"))
NOTES = {"note": "Note", "tip": "Tip", "important": "Important", "caution": "Caution", "warning": "Warning"}
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CODE_TAGS = frozenset(("code", "tt", "kbd", "samp"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: An opening tag closes these open elements, up to the named containers: HTML lets them go unclosed.
IMPLIED = {
    "p": ({"p"}, {"div", "td", "th", "li", "dd", "blockquote", "body"}), "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
INLINE_TAGS = frozenset("span code em strong a acronym".split())
BLOCK_TAGS = frozenset("p div ul ol dl table pre blockquote h1 h2 h3 h4 h5 h6".split())


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict | None = None, parent: Node | None = None):
        self.tag, self.attrs, self.children, self.parent = tag, attrs or {}, [], parent

    @property
    def classes(self) -> set[str]:
        return set((self.attrs.get("class") or "").split())

    def nodes(self) -> Iterator[Node]:
        return (c for c in self.children if isinstance(c, Node))

    def walk(self) -> Iterator[Node]:
        for c in self.nodes():
            yield c
            yield from c.walk()

    def find(self, test) -> Node | None:
        return next((n for n in self.walk() if test(n)), None)


class _Tree(HTMLParser):
    """A tree with unclosed paragraphs, items and cells closed; noise subtrees are never built."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root")
        self.skip = 0

    def handle_starttag(self, tag, attrs):
        if self.skip:
            self.skip += tag not in VOID
            return
        a = {k: v or "" for k, v in attrs}
        if tag in NOISE_TAGS or NOISE_CLASSES & set(a.get("class", "").split()):
            self.skip = int(tag not in VOID)
            return
        closes, within = IMPLIED.get(tag, (set(), set()))
        if tag in BLOCK_TAGS and tag != "p":
            closes, within = closes | {"p"}, within | {"div", "td", "th", "li", "dd", "blockquote", "body", "ul", "ol", "dl"}
        n = self.at
        while n.parent is not None and n.tag not in within:
            if n.tag in closes:
                self.at = n.parent
                if tag not in ("tr", "dt", "dd"):
                    break
            n = n.parent
        node = Node(tag, a, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        if not self.skip and tag == "br":
            self.at.children.append(Node("br", {}, self.at))

    def handle_endtag(self, tag):
        if self.skip:
            self.skip -= tag not in VOID
            return
        n = self.at
        while n.parent is not None and n.tag != tag:
            n = n.parent
        if n.parent is not None:
            self.at = n.parent

    def handle_data(self, data):
        if not self.skip:
            self.at.children.append(data)


def parse(html: str) -> Node:
    t = _Tree()
    t.feed(html)
    t.close()
    return t.root


OPEN, TEXT, CLOSE = "open", "text", "close"


def events(node: Node, skip: Callable[[Node], bool] = lambda n: False) -> Iterator[tuple[str, Node | str]]:
    """What is inside an element in reading order, without the elements to be skipped."""
    todo: list[tuple[str, Node | str]] = [(OPEN, c) for c in reversed(node.children)]
    while todo:
        kind, x = todo.pop()
        if isinstance(x, str):
            yield TEXT, x
        elif kind == CLOSE:
            yield CLOSE, x
        elif not skip(x):
            yield OPEN, x
            todo.append((CLOSE, x))
            todo += [(OPEN, c) for c in reversed(x.children)]


def marked(stream: Iterable[tuple[str, Node | str]]) -> str:
    """Text of a stream with line breaks and with inline code in backticks; code that is empty or holds backticks has none."""
    out: list[str] = []
    code, begin = 0, 0
    for kind, x in stream:
        if kind == TEXT:
            out.append(x)
        elif x.tag == "br" and kind == OPEN:
            out.append("\n")
        elif x.tag in CODE_TAGS:
            code += 1 if kind == OPEN else -1
            if kind == OPEN and code == 1:
                begin = len(out)
            elif not code:
                inner = "".join(out[begin:]).strip()
                out[begin:] = [f"`{inner}`" if inner and "`" not in inner else inner]
    return "".join(out)


def tidy(text: str) -> str:
    t = " ".join(fold_text(text).split())
    t = re.sub(r" +([,.;:!?)\]])", r"\1", t)
    return re.sub(r"([(\[]) +", r"\1", t)


def prose(node: Node, skip: Callable[[Node], bool] = lambda n: False) -> str:
    return tidy(marked(events(node, skip)))


def plain(node: Node) -> str:
    """Text without backticks, for titles and terms, so that they are alike in all formats."""
    return tidy(" ".join(x for kind, x in events(node) if kind == TEXT))


def is_section(n: Node) -> bool:
    return n.tag == "div" and bool(SECTION_CLASSES & n.classes)


def is_parameter_list(n: Node) -> bool:
    return n.tag == "dl" and ("variablelist" in n.classes or n.parent is not None and "variablelist" in n.parent.classes)


def table_text(table: Node) -> str:
    rows = [[prose(c) for c in r.nodes() if c.tag in ("td", "th")] for r in table.walk() if r.tag == "tr"]
    rows = [r for r in rows if any(r)]
    if not rows:
        return ""
    width = max(map(len, rows))
    lines = ["| " + " | ".join([c.replace("|", "\\|") for c in r] + [""] * (width - len(r))) + " |" for r in rows]
    if table.find(lambda n: n.tag in ("thead", "th")) is not None:
        lines.insert(1, "| " + " | ".join(["---"] * width) + " |")
    return "\n".join(lines)


def list_text(node: Node) -> str:
    """One line for each item with text, two spaces deeper for each list around it."""
    lists, items, inner = [[node.tag, 0]], [], []
    for kind, x in events(node):
        if kind == TEXT:
            if inner:
                inner[-1][2].append((TEXT, x))
        elif x.tag in ("ul", "ol"):
            lists.append([x.tag, 0]) if kind == OPEN else lists.pop()
        elif x.tag == "li" and kind == OPEN:
            lists[-1][1] += 1
            inner.append((len(lists) - 1, f"{lists[-1][1]}." if lists[-1][0] == "ol" else "-", []))
            items.append(inner[-1])
        elif x.tag == "li":
            inner.pop()
        elif inner:
            inner[-1][2].append((kind, x) if x.tag in CODE_TAGS or x.tag == "br" else (TEXT, " " if x.tag in BLOCK_TAGS else ""))
    return "\n".join("  " * depth + f"{mark} {text}" for depth, mark, stream in items if (text := tidy(marked(stream))))


def note_text(node: Node, label: str) -> str:
    """Label: text; the note's own title takes the label's place."""
    head = node.find(lambda x: x.tag in HEADINGS)
    text = prose(node, lambda x: x is head)
    own = prose(head) if head is not None else ""
    return f"{own if own and own.lower() != label.lower() else label}: {text}" if text else ""


def blocks(node: Node) -> list[tuple[str, str, str | None]]:
    """(kind, text, lang) of an element's direct content; nested sections and parameter lists are left to the walk, other elements dropped."""
    out: list[tuple[str, str, str | None]] = []
    for n in node.nodes():
        kind = text = ""
        note = next((label for c, label in NOTES.items() if c in n.classes), None) if n.tag == "div" else None
        if n.tag == "pre":
            kind = "synopsis" if "synopsis" in n.classes else "code"
            text = code_text("".join(x for e, x in events(n) if e == TEXT))
            text = text and f"```{'sql' if kind == 'synopsis' else ''}\n{text}\n```"
        elif n.tag == "table":
            kind, text = "table", table_text(n)
        elif n.tag in ("ul", "ol"):
            kind, text = "prose", list_text(n)
        elif n.tag in ("p", "blockquote") or n.tag in INLINE_TAGS:
            kind, text = "prose", prose(n)
        elif note:
            kind, text = "admonition", note_text(n, note)
        elif n.tag == "div" and "refnamediv" in n.classes:
            out += [("prose", t, None) for c in n.nodes() if c.tag == "p" and (t := prose(c))]
        elif n.tag == "div" and not is_section(n) and not {"titlepage", "variablelist"} & n.classes:
            out += blocks(n)
        if text:
            out.append((kind, text, None))
    return out


def heading(section: Node) -> str:
    """A title of the title page, of the name of a reference entry, or the first direct heading with text."""
    places = [c for c in section.nodes() if c.tag == "div" and "titlepage" in c.classes][:1]
    if "refentry" in section.classes:
        places += [c for c in section.nodes() if c.tag == "div" and "refnamediv" in c.classes][:1]
    heads = [h for c in places if (h := c.find(lambda n: n.tag in HEADINGS)) is not None]
    return next((t for h in [*heads, *(c for c in section.nodes() if c.tag in HEADINGS)] if (t := plain(h))), "")


NUMBER = re.compile(r"(?:(?i:chapter|part|appendix)\s+(\d+|(?i:[IVXLC]+|[A-Z]))\.?|((?:[A-Z]\.)?\d+(?:\.\d+)*)\.)\s+(.+)")


def split_number(title: str) -> tuple[str | None, str]:
    m = NUMBER.fullmatch(title)
    return (m[1] or m[2], m[3].strip()) if m else (None, title)


def below(node: Node, test: Callable[[Node], bool]) -> Iterator[Node]:
    """Nearest descendants that pass, not inside another section or a definition."""
    for c in node.nodes():
        if test(c):
            yield c
        elif not is_section(c) and c.tag != "dd":
            yield from below(c, test)


def definitions(node: Node) -> str:
    """A definition list as "- term: text" lines."""
    told = [(prose(dt), prose(dd) if dd is not None else "") for dt, dd in _defined(node)]
    return "\n".join(f"- {term}: {text}" if text else f"- {term}" for term, text in told if term)


def _defined(lst: Node) -> list[tuple[Node, Node | None]]:
    """Each direct term with the definition that follows it; terms one after the other have the same."""
    out, dd = [], None
    for n in reversed([n for n in lst.nodes() if n.tag in ("dt", "dd")]):
        if n.tag == "dd":
            dd = n
        else:
            out.append((n, dd))
    return out[::-1]


def content_root(html: str) -> Node | None:
    root = parse(html)
    found = root.find(lambda n: n.attrs.get("id") == "docContent")
    return found if found is not None else root.find(lambda n: n.tag == "body")


def sections(html: str, ancestors: list[str]) -> list[dict]:
    """Pre-order sections of a page; the entries of its definition lists become parameter sections one level below."""
    top = content_root(html)
    out: list[dict] = []
    if top is None:
        return out

    def emit(title: str, level: int, path: list[str], found: list, anchor: str | None, kind: str, number: str | None) -> list[str]:
        path = [*path, title] if title else path
        out.append({"title": title, "level": level, "path": path, "blocks": [{"kind": k, "text": t, "lang": g} for k, t, g in found], "anchor": anchor or None, "number": number, "kind": kind, "page": None})
        return path

    todo = [(n, len(ancestors) + 1, ancestors) for n in below(top, is_section)][::-1]
    while todo:
        node, level, path = todo.pop()
        number, title = split_number(heading(node))
        path = emit(title, level, path, blocks(node), node.attrs.get("id"), "section", number)
        for dt, dd in (x for lst in below(node, is_parameter_list) for x in _defined(lst)):
            name = tidy(" / ".join(plain(t) for t in dt.walk() if t.tag == "span" and "term" in t.classes)) or plain(dt)
            if name:
                inner = [] if dd is None else [t for lst in below(dd, is_parameter_list) if (t := definitions(lst))]
                own = [] if dd is None else blocks(dd) or ([("prose", t, None)] if not inner and (t := prose(dd)) else [])
                emit(name, level + 1, path, own + [("prose", t, None) for t in inner], dt.attrs.get("id"), "parameter", None)
        todo += [(n, level + 1, path) for n in below(node, is_section)][::-1]
    return out


SECTIONS = "array<struct<title string, level int, path array<string>, blocks array<struct<kind string, text string, lang string>>, anchor string, number string, kind string, page int>>"


def extract_pages(pages: DataFrame, source_format: str = "html", version: str = "18") -> DataFrame:
    """Documents of pages (slug, url, title, ordinal, html, ancestors ARRAY<STRING>); a page without content has no sections."""
    schema = f"doc_id string, source_format string, pg_version string, title string, sections {SECTIONS}, source_url string, page_start int, ordinal int"

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = []
            for slug, url, title, ordinal, html, up in pdf[["slug", "url", "title", "ordinal", "html", "ancestors"]].itertuples(index=False):
                found = sections(html or "", [a for a in (up if up is not None else [])])
                name = found[0]["title"] if found and found[0]["title"] else split_number(tidy(re.sub(r"^[^:]+: Documentation: [^:]+: ", "", title or "")))[1]
                rows.append((slug, source_format, version, name, found, url, None, ordinal))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in "doc_id source_format pg_version title sections source_url page_start ordinal".split()])

    return pages.select("slug", "url", "title", "ordinal", "html", "ancestors").mapInPandas(run, schema)


def title_of(html: str) -> str:
    """Text of <title>, else of the first h1 or h2 of the content, else empty."""
    root = parse(html)
    title = root.find(lambda n: n.tag == "title")
    text = tidy("".join(x for kind, x in events(title) if kind == TEXT)) if title is not None else ""
    top = content_root(html)
    head = (root if top is None else top).find(lambda n: n.tag in ("h1", "h2"))
    return text or (plain(head) if head is not None else "")


def html_title(html: Column) -> Column:
    """title_of as a Column; null gives an empty string."""

    @F.pandas_udf("string")
    def read(s: pd.Series) -> pd.Series:
        return s.map(lambda t: title_of(t) if t else "")

    return read(html)


def structure(pages: DataFrame, html: str = "html") -> DataFrame:
    """kind, name, n: how often elements (kind tag), classes and heading levels occur over all pages; noise is not counted."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            n: Counter = Counter()
            for t in pdf[html]:
                for x in parse(t or "").walk():
                    n["tag", x.tag] += 1
                    n.update(("class", c) for c in x.classes)
            yield pd.DataFrame([(k, v, c) for (k, v), c in n.items()], columns=["kind", "name", "n"])

    return pages.select(html).mapInPandas(run, "kind string, name string, n bigint").groupBy("kind", "name").agg(F.sum("n").alias("n"))


def tag_frequency(pages: DataFrame, html: str = "html") -> DataFrame:
    """tag, n: opening tags over all pages."""
    tags = F.regexp_extract_all(F.col(html), F.lit(r"<([a-zA-Z][a-zA-Z0-9]*)"), F.lit(1))
    return pages.select(F.explode(F.transform(tags, F.lower)).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
