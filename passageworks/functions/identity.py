"""Content hashes, stable identifiers and derived fields of documents and chunks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_hash(text: Column) -> Column:
    """First 16 hex digits of SHA-256."""
    return F.substring(F.sha2(text, 256), 1, 16)


def page_hash(html: Column) -> Column:
    return F.sha2(html, 256)


def chunk_id(source_format: Column, doc_id: Column, anchor: Column, ordinal: Column) -> Column:
    """First 16 hex digits of SHA-1 of format|document|anchor|ordinal; a null anchor counts as empty."""
    return F.substring(F.sha1(F.concat_ws("|", source_format, doc_id, F.coalesce(anchor, F.lit("")), ordinal.cast("string"))), 1, 16)


def breadcrumb(path: Column, doc_title: Column | None = None) -> Column:
    """Non-empty path parts joined by " > "; with doc_title, that title where no part is left."""
    joined = F.array_join(F.filter(F.coalesce(path, F.array().cast("array<string>")), lambda x: x != ""), " > ")
    return joined if doc_title is None else F.coalesce(F.nullif(joined, F.lit("")), doc_title)


def chunk_url(url: Column, anchor: Column) -> Column:
    return F.when((F.coalesce(url, F.lit("")) != "") & (F.coalesce(anchor, F.lit("")) != ""), F.concat(url, F.lit("#"), anchor)).otherwise(url)


def pdf_doc_id(title_key: Column, page: Column) -> Column:
    return F.concat(F.lit("pdf:"), F.coalesce(F.nullif(title_key, F.lit("")), F.lit("entry")), F.lit(":p"), page.cast("string"))


def collection_name(version: str, source_format: str) -> str:
    return f"docs_{version}_{source_format}"


def display_title(section_title: Column, doc_title: Column) -> Column:
    return F.coalesce(F.nullif(section_title, F.lit("")), doc_title)


def metadata_columns() -> list[Column]:
    """Flat, non-null projection of a chunk for stores that know scalars only."""
    s = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return [
        F.col("doc_id"), F.col("source_format"), F.col("pg_version"), F.col("title"),
        F.coalesce(F.array_join("section_path", " > "), F.lit("")).alias("breadcrumb"), F.col("chunk_type"),
        F.coalesce("token_count", F.lit(-1)).alias("token_count"), s("content_hash"), F.coalesce("ordinal", F.lit(-1)).alias("ordinal"),
        s("source_url"), F.coalesce("source_page", F.lit(-1)).alias("source_page"), s("section_anchor"), F.col("has_code"), F.col("has_table"),
    ]


def url_slug(url: Column) -> Column:
    """Last path component of a URL, index.html where there is none."""
    path = F.regexp_replace(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), "/+$", "")
    return F.coalesce(F.nullif(F.regexp_extract(path, r"([^/]*)$", 1), F.lit("")), F.lit("index.html"))


def is_allowed(url: Column, fragments: list[str]) -> Column:
    """Whether no disallowed fragment occurs in the URL."""
    out = F.lit(True)
    for f in fragments:
        out = out & ~url.contains(f)
    return out
