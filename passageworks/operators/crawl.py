"""Crawl manifests: upserts, parent chains, link order."""

from __future__ import annotations

from html import unescape
from urllib.parse import urldefrag, urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.identity import url_slug
from ..session import materialize
from .goldset import number_rows
from .store import latest

HOPS = 8
_ANCHOR = r"(?is)<a\b[^>]*\baccesskey=[\"']{key}[\"'][^>]*>"


@F.pandas_udf(StringType())
def _resolved(base: pd.Series, href: pd.Series) -> pd.Series:
    return pd.Series([urldefrag(urljoin(b or "", unescape(h)))[0] if h else None for b, h in zip(base, href)], dtype=object)


def latest_fetch(manifest: DataFrame) -> DataFrame:
    """One row per slug: the latest fetch; of equal times the greatest hash."""
    return latest(manifest, ["slug"], [F.col("fetched_at").desc_nulls_last(), F.col("sha256").desc(), F.col("ordinal").desc(), F.col("url").desc()])


def ancestor_titles(manifest: DataFrame, hops: int = HOPS) -> DataFrame:
    """slug, ancestors: titles of the parents, root first, at most `hops`; a cycle ends the chain; titles ending in "documentation" are left out.

    One self-join per hop on the parent, each over the pages that still have one; repeated rows are merged first.
    """
    m = materialize(latest_fetch(manifest).select("slug", "title", "parent_slug"), "manifest")
    up = m.select(F.col("slug").alias("_s"), F.col("title").alias("_t"), F.col("parent_slug").alias("_up"))
    walk = m.select("slug", F.col("parent_slug").alias("at"), F.array("slug").alias("seen"), F.array().cast("array<string>").alias("ancestors"))
    done = walk.filter("at IS NULL").select("slug", "ancestors")
    walk = walk.filter("at IS NOT NULL")
    for _ in range(hops):
        step = walk.join(up, walk["at"] == up["_s"], "left")
        stop = F.col("_s").isNull() | F.array_contains("seen", F.col("at"))
        keep = ~F.lower(F.trim("_t")).endswith("documentation") & (F.trim("_t") != "")
        titles = F.when(~stop & F.coalesce(keep, F.lit(False)), F.concat(F.array("_t"), F.col("ancestors"))).otherwise(F.col("ancestors"))
        step = step.select("slug", F.when(~stop, F.col("_up")).alias("at"), F.concat("seen", F.array("at")).alias("seen"), titles.alias("ancestors"))
        step = materialize(step, "hops")
        done = done.unionByName(step.filter("at IS NULL").select("slug", "ancestors"))
        walk = step.filter("at IS NOT NULL")
    return done.unionByName(walk.select("slug", "ancestors"))


def nav_links(pages: DataFrame, base: str, key: str = "n", out: str = "next_slug") -> DataFrame:
    """slug, out: the page that the link with this access key (n next, p previous, u up) leads to, if it stays below the base URL; else null.

    pages: slug, html and, where links are relative to the page, url; without it they are relative to the base.
    """
    tag = F.regexp_extract("html", _ANCHOR.format(key=key), 0)
    href = F.nullif(F.regexp_extract(tag, r"(?is)\bhref=[\"']([^\"']+)[\"']", 1), F.lit(""))
    own = F.coalesce("url", F.lit(base.rstrip("/") + "/")) if "url" in pages.columns else F.lit(base.rstrip("/") + "/")
    linked = pages.select("slug", _resolved(own, href).alias("_to"))
    return linked.select("slug", F.when(F.col("_to").startswith(base), url_slug(F.col("_to"))).alias(out))


def next_links(pages: DataFrame, base: str) -> DataFrame:
    """slug, next_slug: the link with access key n, if it stays below the base URL."""
    return nav_links(pages, base)


def crawl_order(links: DataFrame, seeds: list[str], limit: int | None = None) -> DataFrame:
    """slug, ordinal: pages in the order of their next links from each seed; a visited page ends a chain.

    Pointer doubling: distances to the end of each chain double per round, so a chain of n pages takes log2 n joins instead of n fetches.
    Pages are kept from the first seed that reaches them.
    """
    spark = links.sparkSession
    jump = materialize(links.filter("next_slug IS NOT NULL AND next_slug <> slug").select("slug", F.col("next_slug").alias("to")).dropDuplicates(["slug"]), "links")
    reach = spark.createDataFrame([(s, i, 0) for i, s in enumerate(seeds)], "slug string, seed int, at int")
    reach = reach.join(links.select("slug").distinct(), "slug", "left_semi")
    step, n = 1, -1
    while True:
        ahead = reach.join(jump, "slug").select(F.col("to").alias("slug"), "seed", (F.col("at") + step).alias("at"))
        reach = materialize(reach.unionByName(ahead).groupBy("slug", "seed").agg(F.min("at").alias("at")), "reach")
        m = reach.count()
        if m == n:
            break
        n, step = m, step * 2
        jump = materialize(jump.join(jump.select(F.col("slug").alias("to"), F.col("to").alias("far")), "to").select("slug", F.col("far").alias("to")), "links")
    first = reach.groupBy("slug").agg(F.min(F.struct("seed", "at")).alias("p")).select("slug", "p.seed", "p.at")
    if limit is not None:
        first = first.filter(F.col("at") < limit)
    return number_rows(first.withColumn("_o", F.struct("seed", "at", "slug")), "_o").select("slug", F.col("_i").alias("ordinal"))
