"""Sinks: canonical Parquet, and folders with one set of files for each document.

A document's payload files are written first, each under a temporary name and then renamed; the page file, whose
presence marks the document as done, comes last. A task that runs again replaces the files by equal ones.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LINES = "array<struct<text:string,confidence:double,bbox:array<double>>>"


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def document_records(pages: DataFrame, texts: DataFrame, headings: DataFrame, markdown: DataFrame | None = None) -> DataFrame:
    """doc, pages, text, headings, md: all that a document's folder takes, as one row."""
    by_doc = pages.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("page_index", "image_path", "text_lines", "full_text"))).alias("pages"))
    df = texts.join(by_doc, "doc", "left").join(headings.select(F.col("document").alias("doc"), "n_headings", "headings"), "doc", "left")
    df = df.join(markdown.select("doc", "md"), "doc", "left") if markdown is not None else df.withColumn("md", F.lit(None).cast("string"))
    return df


def _put(path: str, data: str | bytes) -> None:
    """Writes a file under a temporary name and moves it into place, on any file system that Arrow knows."""
    system, name = fs.FileSystem.from_uri(path) if re.match("[a-z][a-z0-9+.-]*:/", path) else (fs.LocalFileSystem(), os.path.abspath(path))
    system.create_dir(name.rsplit("/", 1)[0], recursive=True)
    temp = f"{name}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(temp, compression=None) as f:
        f.write(data.encode() if isinstance(data, str) else data)
    system.move(temp, name)


def _line(x: dict) -> dict:
    return {"text": x["text"], "confidence": float(x["confidence"]), "bbox": [float(v) for v in x["bbox"]]}


def write_folders(records: DataFrame, output_dir: str, markdown_dir: str | None = None) -> DataFrame:
    """Writes the files of each record of document_records below output_dir, a path that all executors share.

    Returns doc, status (written or the error), n_pages. The write happens each time the result is used: callers cut
    it off once.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.to_dict("records"):
                doc, folder = r["doc"], f"{output_dir}/{r['doc']}"
                pages = [
                    {"page_index": int(p["page_index"]), "image_path": p["image_path"], "text_lines": [_line(x) for x in p["text_lines"]], "full_text": p["full_text"]}
                    for p in (r["pages"] if r["pages"] is not None else [])
                ]
                heads = [{"page": int(h["page"]), "text": h["text"]} for h in (r["headings"] if r["headings"] is not None else [])]
                try:
                    _put(f"{folder}/text_docling.txt", r["text"])
                    _put(f"{folder}/headings.json", json.dumps({"document": doc, "n_headings": len(heads), "headings": heads}, ensure_ascii=False, indent=2))
                    if r["md"] is not None:
                        _put(f"{folder}/{doc}.md", r["md"])
                        if markdown_dir:
                            _put(f"{markdown_dir}/{doc}.md", r["md"])
                    _put(f"{folder}/ocr_docling.json", json.dumps(pages, ensure_ascii=False, indent=2))
                    rows.append((doc, "written", len(pages)))
                except OSError as e:
                    rows.append((doc, repr(e), len(pages)))
            yield pd.DataFrame(rows, columns=["doc", "status", "n_pages"], dtype=object)

    return records.select("doc", "pages", "text", "headings", "md").mapInPandas(run, "doc string, status string, n_pages int")


def write_files(files: DataFrame, output_dir: str) -> DataFrame:
    """Writes data to output_dir/<doc>/<name> for each (doc, name, data); returns doc, name, status: written, or the
    error of the write or, where there is such a column, of the row."""
    files = files if "error" in files.columns else files.withColumn("error", F.lit(None).cast("string"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, name, data, error in zip(b["doc"], b["name"], b["data"], b["error"]):
                if error is not None:
                    rows.append((doc, name, error))
                    continue
                try:
                    _put(f"{output_dir}/{doc}/{name}", bytes(data))
                    rows.append((doc, name, "written"))
                except OSError as e:
                    rows.append((doc, name, repr(e)))
            yield pd.DataFrame(rows, columns=["doc", "name", "status"], dtype=object)

    return files.select("doc", "name", "data", "error").mapInPandas(run, "doc string, name string, status string")


def write_manifests(manifests: DataFrame, output_dir: str) -> DataFrame:
    """figures/figures.json of each (doc, json); returns doc, status."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, text in zip(b["doc"], b["json"]):
                try:
                    _put(f"{output_dir}/{doc}/figures/figures.json", json.dumps(json.loads(text), ensure_ascii=False, indent=2))
                    rows.append((doc, "written"))
                except OSError as e:
                    rows.append((doc, repr(e)))
            yield pd.DataFrame(rows, columns=["doc", "status"], dtype=object)

    return manifests.select("doc", "json").mapInPandas(run, "doc string, status string")
