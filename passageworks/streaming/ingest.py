"""Continuous ingestion: documents arrive as files, chunks are upserted; a replayed batch changes nothing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import token_count
from ..operators.chunking import Cost, chunk_documents
from ..operators.store import latest
from ..sources.records import CHUNK, DOCUMENT


def stream_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(DOCUMENT).json(path)


def ingest_chunks(documents: DataFrame, store: str, checkpoint: str, cost: Cost = token_count) -> StreamingQuery:
    """Chunk each micro-batch and write it under its batch number, replacing that number's files if the batch is replayed.

    read_store gives the newest row of each chunk_id, so the store is an upsert without rewriting what is there.
    """

    def write(batch: DataFrame, number: int) -> None:
        chunk_documents(batch, cost).write.mode("overwrite").parquet(f"{store}/batch={number}")

    return documents.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_store(spark: SparkSession, store: str) -> DataFrame:
    rows = spark.read.schema(CHUNK + ", batch bigint").parquet(store)
    return latest(rows, ["chunk_id"], [F.col("batch").desc()])


def compact_store(spark: SparkSession, store: str) -> str:
    """Write the current state once into a new folder and return its path."""
    out = f"{store.rstrip('/')}-{uuid.uuid4().hex[:8]}"
    read_store(spark, store).write.partitionBy("batch").parquet(out)
    return out


def windowed_counts(events: DataFrame, at: str = "ts", kind: str = "event_type", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events per window and kind with a watermark; works on batch and streaming frames."""
    return events.withWatermark(at, late).groupBy(F.window(at, width), kind).agg(F.count(F.lit(1)).alias("n"))
