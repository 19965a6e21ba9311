"""How closely two renderings of one corpus agree: prioritised key join, similarities, summary."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.text import body, comparison_text, title_key, token_key_set
from .retrieval import cosine


def candidate_keys(path: Column, anchor: Column) -> Column:
    """Keys from most to least specific: the anchor alone, or the last two titles and, for short paths, the last title."""
    k = F.filter(F.transform(F.coalesce(path, F.array().cast("array<string>")), lambda p: title_key(p)), lambda x: x != "")
    n = F.size(k)
    two = F.when(n >= 2, F.array(F.concat(F.lit("path2:"), F.try_element_at(k, F.lit(-2)), F.lit("|"), F.try_element_at(k, F.lit(-1))))).otherwise(F.array().cast("array<string>"))
    one = F.when((n >= 1) & (n <= 2), F.array(F.concat(F.lit("path1:"), F.try_element_at(k, F.lit(-1))))).otherwise(F.array().cast("array<string>"))
    return F.when(F.coalesce(F.trim(anchor), F.lit("")) != "", F.array(F.concat(F.lit("anchor:"), F.upper(F.trim(anchor))))).otherwise(F.concat(two, one))


def keyed(chunks: DataFrame) -> DataFrame:
    """chunks (item, text, path, anchor, order columns) that have a key, with `keys` and the most specific one, `key`."""
    return chunks.withColumn("keys", candidate_keys(F.col("path"), F.col("anchor"))).filter(F.size("keys") > 0).withColumn("key", F.col("keys")[0])


def grouped(rows: DataFrame, item: str, order: list[str]) -> DataFrame:
    """One row per key of keyed rows, without texts: key, the keys and the item of its first row, n, and `first`, that row's place."""
    place = F.struct(*order, item)
    g = rows.groupBy("key").agg(F.min_by(F.struct("keys", F.col(item).alias("item")), place).alias("x"), F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    return g.select("key", "x.keys", "n", "x.item", "first")


def alias_index(groups: DataFrame) -> DataFrame:
    """alias -> key: the first group that offers an alias owns it; single-title aliases only if unique."""
    a = groups.select("key", "first", F.explode("keys").alias("alias")).groupBy("alias").agg(F.min_by("key", F.struct("first", "key")).alias("key"), F.count(F.lit(1)).alias("c"))
    return a.filter(~F.col("alias").startswith("path1:") | (F.col("c") == 1)).select("alias", "key")


def fallback_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Each left group with the right group of its first key that resolves; right columns are null where none does. No texts are moved."""
    index = alias_index(right).withColumnRenamed("key", "right_key")
    k = left.select("key", F.posexplode("keys").alias("pos", "alias")).join(index, "alias")
    best = k.groupBy("key").agg(F.min(F.struct("pos", "right_key")).alias("b")).select("key", "b.right_key")
    r = right.select(F.col("key").alias("right_key"), F.col("item").alias("right_item"), F.col("n").alias("right_n"))
    return left.drop("first", "keys").join(best, "key", "left").join(r, "right_key", "left")


def with_texts(joined: DataFrame, left: DataFrame, right: DataFrame, item: str, order: list[str]) -> DataFrame:
    """The matched groups of a fallback join with `text` and `right_text`: the bodies of their keyed rows in order, joined by spaces. Only rows of matched
    groups are gathered."""
    matched = joined.filter("right_key IS NOT NULL")

    def texts(rows: DataFrame, keys: DataFrame, out: str) -> DataFrame:
        x = F.array_sort(F.collect_list(F.struct(*order, F.col(item).alias("item"), body(F.col("text")).alias("text"))))
        return rows.join(keys, "key", "left_semi").groupBy("key").agg(F.array_join(F.transform(x, lambda v: v["text"]), " ").alias(out))

    l = texts(left, matched.select("key"), "text")  # noqa: E741
    r = texts(right, matched.select(F.col("right_key").alias("key")).distinct(), "right_text").withColumnRenamed("key", "right_key")
    return matched.join(l, "key").join(r, "right_key")


def coverage(joined: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: groups of both sides, matched pairs, and the share of either side's groups that they are."""
    m = joined.agg(F.count("right_key").alias("matched"))
    c = left.agg(F.count(F.lit(1)).alias("left_keys")).crossJoin(right.agg(F.count(F.lit(1)).alias("right_keys"))).crossJoin(m)  # one row each
    share = lambda n: F.coalesce(F.col("matched") / F.nullif(F.col(n), F.lit(0)), F.lit(0.0))
    return c.select("left_keys", "right_keys", "matched", share("left_keys").alias("left_coverage"), share("right_keys").alias("right_coverage"))


def vector_cosines(joined: DataFrame, vectors: DataFrame) -> DataFrame:
    """key, right_key, cosine of the matched pairs whose groups are one item each, by the items' vectors (item, vector); pairs without both have no row."""
    one = joined.filter("right_key IS NOT NULL AND n = 1 AND right_n = 1").select("key", "right_key", "item", "right_item")
    v = one.join(vectors.select("item", F.col("vector").alias("_l")), "item").join(vectors.select(F.col("item").alias("right_item"), F.col("vector").alias("_r")), "right_item")
    return v.select("key", "right_key", cosine(F.col("_l"), F.col("_r")).alias("cosine"))


def jaccard(x: Column, y: Column) -> Column:
    """Shared over all distinct words; 0 where neither has any."""
    return F.coalesce(F.size(F.array_intersect(x, y)) / F.nullif(F.size(F.array_union(x, y)), F.lit(0)), F.lit(0.0))


@F.pandas_udf(DoubleType())
def char_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratio of matching characters by difflib's matching blocks."""
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)])


def length_ratio(x: Column, y: Column) -> Column:
    return F.coalesce(F.least(F.length(x), F.length(y)) / F.nullif(F.greatest(F.length(x), F.length(y)), F.lit(0)), F.lit(1.0))


def compare(joined: DataFrame, chars: bool = True) -> DataFrame:
    """Similarities of matched pairs with texts."""
    p = joined.withColumn("_l", comparison_text(F.col("text"))).withColumn("_r", comparison_text(F.col("right_text")))
    p = p.withColumn("jaccard", jaccard(token_key_set(F.col("_l")), token_key_set(F.col("_r")))).withColumn("length_ratio", length_ratio(F.col("_l"), F.col("_r")))
    p = p.withColumn("char_ratio", char_similarity("_l", "_r")) if chars else p
    return p.drop("_l", "_r")


def ratio_bucket(r: Column) -> Column:
    return F.when(r >= 0.95, ">=0.95").when(r >= 0.85, "0.85-0.95").when(r >= 0.70, "0.70-0.85").when(r >= 0.50, "0.50-0.70").otherwise("<0.50")


def unmatched_by_kind(joined: DataFrame) -> DataFrame:
    return joined.filter("right_key IS NULL").groupBy(F.substring_index("key", ":", 1).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def worst(pairs: DataFrame, by: str, n: int = 8) -> DataFrame:
    return pairs.orderBy(by, "key").limit(n)
