"""Schemas and readers of stage files; schemas are declared, never inferred."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = "struct<kind string, text string, lang string>"
SECTION = f"struct<title string, level int, path array<string>, blocks array<{BLOCK}>, anchor string, number string, kind string, page int>"
DOCUMENT = f"doc_id string, source_format string, pg_version string, title string, sections array<{SECTION}>, source_url string, source_path string, page_start int, page_end int, ordinal int"
CHUNK = (
    "chunk_id string, text string, doc_id string, source_format string, pg_version string, title string, section_path array<string>, chunk_type string, token_count int, char_count int, "
    "content_hash string, ordinal int, source_url string, source_page int, section_anchor string, has_code boolean, has_table boolean"
)
MANIFEST = "slug string, url string, title string, sha256 string, fetched_at string, ordinal int, bytes bigint, parent_slug string"
VECTOR = "content_hash string, vector array<float>"
GOLD = "question string, expect_anchor string, expect_path string, expect_anchors array<string>, expect_paths array<string>, topic string"
CORPORA = ("slice", "full")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of a JSON-lines file; blank lines are skipped, malformed ones fail the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, DOCUMENT)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, CHUNK)


def read_pages(spark: SparkSession, glob: str) -> DataFrame:
    """slug, html of cached pages; bytes that are not UTF-8 become replacement characters."""
    files = spark.read.format("binaryFile").load(glob)
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("slug"), F.decode("content", F.lit("UTF-8")).alias("html"))


def pages_of_manifest(manifest: DataFrame, pages: DataFrame) -> DataFrame:
    """The manifest bounds a corpus: its rows whose page is cached."""
    return manifest.join(pages, "slug")


def read_parquet_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet dataset, empty where none has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def read_vector_cache(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet_or_empty(spark, path, VECTOR)


def load_goldset(spark: SparkSession, path: str) -> DataFrame:
    """Gold questions from YAML or JSON; unknown fields and questions without expectation are refused."""
    text = spark.read.text(path, wholetext=True).first()[0]
    if path.endswith((".yaml", ".yml")):
        import yaml

        rows = yaml.safe_load(text)
    else:
        rows = json.loads(text)
    names = [c.strip().split()[0] for c in GOLD.split(", ")]
    for i, r in enumerate(rows, 1):
        if unknown := set(r) - set(names):
            raise ValueError(f"question {i} has unknown fields {sorted(unknown)}")
        if not any(r.get(n) for n in names[1:5]):
            raise ValueError(f"question {i} expects nothing")
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], GOLD)
    return df.withColumn("query_id", F.monotonically_increasing_id())


def write_report(df: DataFrame, folder: str, *what: str) -> str:
    """A small result as one JSON file whose name tells what it is; returns its path."""
    path = f"{folder.rstrip('/')}/{'-'.join(what)}.json"
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


class Corpus:
    """Paths of one corpus below a root: derived stages are its own, pages and vectors are shared by content."""

    def __init__(self, root: str, name: str = "slice"):
        if name not in CORPORA:
            raise ValueError(f"unknown corpus {name!r}; known: {CORPORA}")
        self.root, self.name = root.rstrip("/"), name

    def stage(self, what: str, source_format: str) -> str:
        return f"{self.root}/{self.name}/{what}/source_format={source_format}"

    @property
    def pages(self) -> str:
        return f"{self.root}/shared/pages"

    @property
    def vectors(self) -> str:
        return f"{self.root}/shared/vectors"

    def status(self, spark: SparkSession, formats: tuple[str, ...] = ("html", "pdf"), stages: tuple[str, ...] = ("documents", "chunks", "vectors")) -> DataFrame:
        """stage, source_format, rows (null where the stage has not run)."""
        rows = []
        for stage in stages:
            for f in formats:
                try:
                    n = spark.read.parquet(self.stage(stage, f)).count()
                except Exception as e:  # noqa: BLE001
                    if "PATH_NOT_FOUND" not in str(e):
                        raise
                    n = None
                rows.append((stage, f, n))
        return spark.createDataFrame(rows, "stage string, source_format string, rows bigint")
