"""python -m passageworks.cli --root DIR [--corpus slice|full] COMMAND ..."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import functions as F

from .engine import Engine
from .operators import store
from .session import drop_materialized, get_session
from .sources import fetch
from .sources.records import CORPORA, load_goldset, read_pages, write_report


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="passageworks")
    p.add_argument("--root", required=True)
    p.add_argument("--corpus", choices=CORPORA, default="slice")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("extract").add_argument("pages", help="glob of cached HTML pages")
    for name in ("chunk", "embed"):
        sub.add_parser(name).add_argument("--source", choices=("html", "pdf"), default="html")
    ask = sub.add_parser("ask")
    ask.add_argument("question")
    ask.add_argument("--source", choices=("html", "pdf"), default="html")
    ask.add_argument("-k", "--top-k", type=int, default=5)
    ask.add_argument("--full", action="store_true")
    for name in ("evaluate", "experiment"):
        ev = sub.add_parser(name)
        ev.add_argument("goldset")
        ev.add_argument("--source", choices=("html", "pdf"), default="html")
        ev.add_argument("--report", help="folder that the result is written to as JSON")
    collect = sub.add_parser("collect", help="fetch pages that follow one another, with pauses and retries")
    collect.add_argument("seeds", nargs="+")
    collect.add_argument("--base", required=True)
    collect.add_argument("--limit", type=int)
    device = sub.add_parser("device")
    device.add_argument("--device", choices=("auto", "cpu", "cuda"), default="auto")
    sub.add_parser("compare")
    sub.add_parser("info")
    a = p.parse_args(args)
    spark = get_session()
    e = Engine(spark, a.root, a.corpus)
    if a.command == "extract":
        pages = read_pages(spark, a.pages).select("slug", F.lit(None).cast("string").alias("url"), F.lit("").alias("title"), F.lit(0).alias("ordinal"), "html", F.array().cast("array<string>").alias("ancestors"))
        e.extract(pages)
    elif a.command == "chunk":
        print(e.chunk(a.source).count())
    elif a.command == "embed":
        print(e.embed_and_store(a.source).count())
    elif a.command == "ask":
        q = spark.createDataFrame([(0, a.question)], "query_id bigint, question string")
        e.ask(q, a.source, a.top_k, full=a.full).orderBy("rank").show(a.top_k, truncate=False)
    elif a.command in ("evaluate", "experiment"):
        gold = load_goldset(spark, a.goldset)
        out = e.evaluate(gold, a.source) if a.command == "evaluate" else e.experiment(gold, a.source)
        if a.report:
            write_report(out, a.report, a.command, a.source, os.path.splitext(os.path.basename(a.goldset))[0])
        out.orderBy("config").show(50, truncate=False)
    elif a.command == "collect":
        print(len(fetch.collect(fetch.Fetcher(), a.seeds, a.base, e.corpus.pages, a.limit)))
    elif a.command == "device":
        print(store.providers(a.device))
    elif a.command == "compare":
        e.compare().show(truncate=False)
    else:
        e.status().show()
    drop_materialized(spark)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
