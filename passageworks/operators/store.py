"""Incremental vectors and keyed upserts over Parquet datasets."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upsert_latest(existing: DataFrame, incoming: DataFrame, key: Sequence[str], version: str) -> DataFrame:
    """One row per key, the one with the greatest version; of equal versions an incoming row wins over an existing one."""
    both = existing.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    return latest(both, key, [F.col(version).desc_nulls_last(), F.col("_new").desc()]).drop("_new")


def latest(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_i", F.row_number().over(w)).filter("_i = 1").drop("_i")


def cache_plan(texts: DataFrame, cache: DataFrame, key: str = "content_hash") -> DataFrame:
    """Distinct keys of the texts with `hit`: whether the cache holds their vector."""
    known = cache.select(key).distinct().withColumn("hit", F.lit(True))
    return texts.select(key).filter(F.col(key).isNotNull()).distinct().join(known, key, "left").fillna(False, ["hit"])


def missing_texts(texts: DataFrame, cache: DataFrame, key: str = "content_hash", text: str = "text") -> DataFrame:
    """One text per key that the cache lacks: what has to be embedded."""
    return texts.join(cache, key, "left_anti").groupBy(key).agg(F.min(text).alias(text))


def embed_with_cache(texts: DataFrame, cache: DataFrame, embed: Callable[[Column], Column], key: str = "content_hash", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(texts with `vector`, the cache's new rows). Each missing key is embedded once however often it occurs."""
    new = missing_texts(texts, cache, key, text).select(key, embed(F.col(text)).alias("vector"))
    return texts.join(cache.select(key, "vector").unionByName(new), key, "left"), new


def write_new_vectors(new: DataFrame, path: str) -> None:
    """Append only keys the cache did not have; readers see old and new files as one table."""
    new.write.mode("append").parquet(path)


def random_hyperplane_embedding(dim: int = 64) -> Callable[[Column], Column]:
    """A deterministic embedding without model files: signed hashing of tokens, unit length. For tests and offline runs.

    A token's axis is the number of the first seven hex digits of its MD5 modulo dim, its sign that of the eighth digit's lowest bit. Each token is
    hashed once a worker, so a text takes time in proportion to its tokens.
    """
    from ..functions.text import lexical_tokens

    @F.pandas_udf("array<float>")
    def embed_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, tuple[int, float]] = {}

        def place(t: str) -> tuple[int, float]:
            if t not in known:
                h = hashlib.md5(t.encode()).hexdigest()
                known[t] = int(h[:7], 16) % dim, 1.0 if int(h[7], 16) % 2 == 0 else -1.0
            return known[t]

        for s in batches:
            out = []
            for tokens in s:
                v = np.zeros(dim)
                for t in tokens if tokens is not None else ():
                    axis, sign = place(t)
                    v[axis] += sign
                n = np.linalg.norm(v)
                out.append((v / n if n else v).astype(np.float32))
            if len(known) > 1_000_000:
                known.clear()
            yield pd.Series(out)

    return lambda text: embed_tokens(lexical_tokens(F.coalesce(text, F.lit(""))))


def providers(device: str, available: Sequence[str] | None = None) -> list[str]:
    """The providers a model session asks for: cpu, auto (the GPU where there is one, then the CPU) or cuda (refused without a GPU)."""
    gpu, cpu = "CUDAExecutionProvider", "CPUExecutionProvider"
    if device not in ("cpu", "auto", "cuda"):
        raise ValueError(f"unknown device {device!r}")
    if available is None:
        try:
            from onnxruntime import get_available_providers

            available = get_available_providers()
        except ImportError:
            available = [cpu]
    if device == "cuda" and gpu not in available:
        raise RuntimeError("no GPU provider is available here")
    return [cpu] if device == "cpu" or gpu not in available else [gpu, cpu]


def model_embedding(load: Callable[[], Callable[[list[str]], Sequence[Sequence[float]]]], batch: int = 64) -> Callable[[Column], Column]:
    """An embedding by any model: `load` gives a function from a list of texts to vectors and is called once in each worker, when its first batch comes."""

    @F.pandas_udf("array<float>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = None
        for s in batches:
            model = model or load()
            texts = ["" if t is None else t for t in s]
            out: list = []
            for at in range(0, len(texts), batch):
                out += [np.asarray(v, np.float32) for v in model(texts[at : at + batch])]
            yield pd.Series(out, dtype=object)

    return embed
