"""Mix sources to target shares of the total size: whole copies first, then a Pareto order sample of the rest."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import take_until
from ..session import materialize, share_file

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Split pattern of the byte-level vocabulary; fixed by the public tokenizer.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def encoding(path: str):
    """A byte-level tokenizer from a file of `base64 rank` lines."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, text: str, keep: list[str], path: str = VOCABULARY) -> DataFrame:
    """`keep` columns plus `tokens` BIGINT: tokens of the whole text, 0 for null and empty ones. The vocabulary file is sent to the executors."""
    name = share_file(df.sparkSession, path)
    cols = df.select(*keep, F.col(text).cast("string").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cols.schema if f.name != "_text") + ", tokens bigint"

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(SparkFiles.get(name))
        for batch in it:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(n, pa.int64())], names=[*keep, "tokens"])

    return cols.mapInArrow(run, schema)


class Mixture:
    """copies(): doc_id, source, tokens, copies (>= 1). report(): one row per source with target and reached shares.

    Each listed source with documents is to give target_share of the total, in tokens. `total_tokens` is the size of the
    mixture; by default the largest at which every listed source that has tokens stays within max_repeats, so all reach
    their targets. With a larger total, a source that runs out gives all its documents max_repeats times and its reached
    share falls short, which the report shows. A listed source without documents gives nothing and its share is not handed to any
    one source: the reached shares of the others are their targets over the sum of targets that can be served. Documents
    of unlisted or null sources, null ids and texts without tokens are not used. Rows that repeat a doc_id count once (the
    one with most tokens, then the least source).

    A source that needs f copies of each document on average gets floor(f) whole copies of all, and the fraction from a Pareto order
    sample with probability proportional to size: document i of t_i tokens is to be included with p_i = min(1, c t_i), where c makes the
    expected tokens those that remain; documents with p_i = 1 are certain. It gets a uniform u_i from a hash of the seed and its
    id, and documents are taken in ascending order of the odds u / (1 - u) divided by the odds of p_i, until the source's remaining tokens
    are reached (to half a document), which fixes the sample's size. Cuts are found in ranges and c from counts per size,
    so a source of any size is never sorted in one task.
    """

    def __init__(self, documents: DataFrame, targets: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", total_tokens: int | None = None, seed: int = 7, tokenizer: str = VOCABULARY):
        clean = targets.select(F.col("source").cast("string").alias("source"), F.col("target_share").cast("double").alias("target_share"), F.col("max_repeats").cast("bigint").alias("max_repeats")).filter("source IS NOT NULL AND target_share > 0 AND max_repeats > 0")
        self.targets = clean.groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
        docs = documents.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), F.col(text).alias("_t")).filter("doc_id IS NOT NULL AND source IS NOT NULL")
        counted = token_counts(docs, "_t", ["doc_id", "source"], tokenizer).filter("tokens > 0")
        best = F.max(F.struct("tokens", "source")).alias("b")
        self.docs = materialize(counted.groupBy("doc_id").agg(best).select("doc_id", "b.source", "b.tokens"), "mixing")
        have = self.docs.groupBy("source").agg(F.sum("tokens").alias("have_tokens"), F.count(F.lit(1)).alias("have_docs"))
        plan = self.targets.join(have, "source", "left").fillna(0, ["have_tokens", "have_docs"])
        fits = F.min(F.when(F.col("have_tokens") > 0, F.col("have_tokens") * F.col("max_repeats") / F.col("target_share"))).over(Window.partitionBy())
        total = F.lit(float(total_tokens)) if total_tokens is not None else F.coalesce(fits, F.lit(0.0))
        plan = plan.withColumn("total", total)  # one row per listed source
        want = F.least(F.col("total") * F.col("target_share"), (F.col("have_tokens") * F.col("max_repeats")).cast("double"))
        whole = F.floor(F.round(F.col("want") / F.nullif("have_tokens", F.lit(0)), 9))
        plan = plan.withColumn("want", want).withColumn("whole", F.coalesce(whole, F.lit(0)).cast("bigint"))
        plan = plan.withColumn("rest", F.greatest(F.lit(0.0), F.col("want") - F.col("whole") * F.col("have_tokens")))
        self.plan = materialize(plan.join(self._rates(plan), "source", "left"), "mixing-plan")
        self.seed = seed

    def _rates(self, plan: DataFrame) -> DataFrame:
        """source, rate: c of p = min(1, c t). Sizes that would have p over 1 are certain: the largest size v from which on none is
        satisfies c v <= 1 with c = (rest - tokens of larger documents) / (sum of squares of the others)."""
        n = self.docs.groupBy("source", "tokens").agg(F.count(F.lit(1)).alias("n")).join(plan.filter("rest > 0").select("source", "rest"), "source")
        down = Window.partitionBy("source").orderBy(F.col("tokens").desc())  # a row for each different size
        t = F.col("tokens").cast("double")
        larger = F.coalesce(F.sum(t * F.col("n")).over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
        squares = F.sum(t * t * F.col("n")).over(Window.partitionBy("source").orderBy("tokens"))
        n = n.select("source", "tokens", ((F.col("rest") - larger) / squares).alias("c"))
        return n.filter("c > 0 AND c * tokens <= 1").groupBy("source").agg(F.max_by("c", "tokens").alias("rate"))

    def inclusion(self) -> DataFrame:
        """doc_id, source, tokens, whole, rest, p: p is the probability of one copy beyond the whole ones."""
        d = self.docs.join(self.plan.select("source", "whole", "rest", "rate"), "source")
        return d.withColumn("p", F.coalesce(F.least(F.lit(1.0), F.col("rate") * F.col("tokens")), F.lit(0.0))).drop("rate")

    def copies(self) -> DataFrame:
        d = self.inclusion()
        u = (F.xxhash64(F.lit(self.seed), F.col("doc_id").cast("string")).bitwiseAND(F.lit((1 << 52) - 1)) + F.lit(0.5)) / F.lit(float(1 << 52))
        p = F.least(F.lit(1 - 1e-12), F.greatest(F.lit(1e-12), F.col("p")))
        q = (u / (1 - u)) / (p / (1 - p))
        extra = take_until(d.filter("rest > 0"), "source", q / (1 + q), "tokens", "rest").select("doc_id", "source", "tokens", F.lit(1).cast("bigint").alias("copies"))
        base = d.filter("whole > 0").select("doc_id", "source", "tokens", F.col("whole").alias("copies"))
        return base.unionByName(extra).groupBy("doc_id", "source", "tokens").agg(F.sum("copies").alias("copies"))

    def report(self) -> DataFrame:
        got = self.copies().groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.count(F.lit(1)).alias("docs"), F.sum("copies").alias("copies"), F.max("copies").alias("most_copies"))
        out = self.plan.select("source", "target_share", "max_repeats", "have_docs", "have_tokens").join(got, "source", "left").fillna(0, ["tokens", "docs", "copies", "most_copies"])
        total = F.sum("tokens").over(Window.partitionBy())  # one row per listed source
        return out.withColumn("reached_share", F.coalesce(F.col("tokens") / F.nullif(total, F.lit(0)), F.lit(0.0)))
