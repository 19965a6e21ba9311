"""A batch data source for positioned lines in JSON exports of page layouts: one partition per file.

spark.dataSource.register(LayoutLines); spark.read.format("layout_lines").load(folder). Reading PDF bytes themselves needs a
PDF library, which is gated: with one installed, export_pdf writes such files.
"""

from __future__ import annotations

import glob
import json
import os

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "doc string, page int, line int, span int, y0 double, y1 double, x0 double, text string, font string, size double, height double"


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options.get("path", "")

    def partitions(self):
        found = sorted(glob.glob(os.path.join(self.path, "*.json"))) if os.path.isdir(self.path) else [self.path]
        return [_File(p) for p in found]

    def read(self, partition):
        doc = os.path.splitext(os.path.basename(partition.path))[0]
        with open(partition.path) as f:
            for n, page in enumerate(json.load(f)["pages"], 1):
                for i, line in enumerate(page["lines"]):
                    for j, s in enumerate(line["spans"]):
                        x0, y0, _, y1 = s["bbox"]
                        yield (doc, n, i, j, float(y0), float(y1), float(x0), s["text"], s["font"], float(s["size"]), float(page["height"]))


class LayoutLines(DataSource):
    @classmethod
    def name(cls):
        return "layout_lines"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options)


def export_pdf(pdf: str, out: str) -> None:
    """Write a PDF's layout as JSON; raises ImportError where no PDF library is installed."""
    import fitz

    pages = []
    with fitz.open(pdf) as d:
        for p in d:
            lines = [{"spans": [{k: s[k] for k in ("bbox", "text", "font", "size")} for s in x["spans"]]} for b in p.get_text("dict")["blocks"] for x in b.get("lines", [])]
            pages.append({"height": p.rect.height, "lines": lines})
    with open(out, "w") as f:
        json.dump({"pages": pages}, f)
