"""Gold-set tooling: stratified samples, verification, leak checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import distinctive_terms
from .metrics import expectations

SPECIFIC = 30


def stride_sample(rows: DataFrame, area: str, doc: str, order: str, per_area: int, prefer: str | None = None) -> DataFrame:
    """Per area every max(1, n / per_area)-th document in corpus order, at most per_area; of each the first preferred row, else the first.

    Documents are counted, not rows, so the windows hold one row per document. `order` must be unique within an area.
    """
    docs = rows.groupBy(area, doc).agg(F.min(order).alias("_first"))
    w = Window.partitionBy(area)
    docs = docs.withColumn("_i", F.row_number().over(w.orderBy("_first")) - 1).withColumn("_n", F.count(F.lit(1)).over(w))
    step = F.greatest(F.lit(1), F.floor(F.col("_n") / F.lit(per_area)))
    docs = docs.filter((F.col("_i") % step == 0) & (F.col("_i") / step < per_area)).select(area, doc)
    pick = F.min_by(F.struct(*[F.col(c) for c in rows.columns if c not in (area, doc)]), F.struct(*([F.col(prefer).isNull()] if prefer else []), F.col(order)))
    return rows.join(docs, [area, doc], "left_semi").groupBy(area, doc).agg(pick.alias("_p")).select(area, doc, "_p.*")


def even_stride(rows: DataFrame, order: str, sample: int) -> DataFrame:
    """Rows at positions floor(i * n / sample) of the order, for i below sample (all rows if there are fewer)."""
    n = rows.agg(F.count(F.lit(1)).alias("_total"))
    indexed = number_rows(rows, order).crossJoin(F.broadcast(n))  # n is one row
    i, total = F.col("_i"), F.col("_total")
    least = F.least(F.lit(sample), total)
    first = F.ceil(i * least / total).cast("bigint")
    return indexed.filter((first < least) & (F.floor(first * total / least) == i)).drop("_i", "_total")


def number_rows(rows: DataFrame, order: str) -> DataFrame:
    """rows with `_i`, the position in a total order, without a window over the whole table: positions within ranges plus range offsets."""
    ranged = rows.repartitionByRange(order).sortWithinPartitions(order).withColumn("_p", F.spark_partition_id())
    local = ranged.withColumn("_j", F.row_number().over(Window.partitionBy("_p").orderBy(order)) - 1)
    n = local.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy().orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a partition
    return local.join(n.select("_p", before.alias("_before")), "_p").withColumn("_i", F.col("_before") + F.col("_j")).drop("_p", "_j", "_before")


def match_counts(gold: DataFrame, chunks: DataFrame) -> DataFrame:
    """query_id, matches: chunks that satisfy an expectation. Anchors go through an equi-join; only path expectations, a stated
    query set, are compared with each distinct breadcrumb."""
    e = expectations(gold)
    c = chunks.filter("chunk_id IS NOT NULL").groupBy("chunk_id").agg(F.upper(F.max("section_anchor")).alias("anchor"), F.lower(F.coalesce(F.array_join(F.max("section_path"), " > "), F.lit(""))).alias("crumb"))
    by_anchor = e.select("query_id", F.explode("anchors").alias("anchor")).join(c.select("chunk_id", "anchor"), "anchor").select("query_id", "chunk_id")
    crumbs = c.select("crumb").distinct()
    p = e.select("query_id", F.explode("paths").alias("p"))
    by_path = p.join(crumbs, F.contains(F.col("crumb"), F.col("p"))).select("query_id", "crumb").distinct().join(c.select("chunk_id", "crumb"), "crumb").select("query_id", "chunk_id")
    n = by_anchor.union(by_path).distinct().groupBy("query_id").agg(F.count(F.lit(1)).alias("matches"))
    return e.select("query_id").join(n, "query_id", "left").fillna(0, ["matches"])


def verify(gold: DataFrame, chunks: DataFrame) -> DataFrame:
    """query_id, matches, unresolved, unspecific, leaking: a question that names what it asks for leaks."""
    e = expectations(gold).join(gold.select("query_id", F.lower("question").alias("q")), "query_id")
    leak = F.exists(distinctive_terms(F.col("anchors"), F.col("paths")), lambda t: F.contains(F.col("q"), t))
    m = match_counts(gold, chunks)
    return e.select("query_id", F.coalesce(leak, F.lit(False)).alias("leaking")).join(m, "query_id").select("query_id", "matches", (F.col("matches") == 0).alias("unresolved"), (F.col("matches") > SPECIFIC).alias("unspecific"), "leaking")


def repeated_anchors(gold: DataFrame) -> DataFrame:
    return expectations(gold).select(F.explode("anchors").alias("anchor")).groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
