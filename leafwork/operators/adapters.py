"""What needs a neural or PDF library, behind small interfaces that run in mapInPandas.

An adapter is built once in each Python worker, by a factory that travels to it, so that models load once. The
fakes are deterministic and need no library; they serve tests and dry runs.
"""

from __future__ import annotations

import base64
import importlib
import json
import urllib.request
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame

DEFAULT_PROMPT = "Describe this figure in one to three sentences."
ITEMS = "doc string, item_no int, label string, level int, text string, page_no int, l double, t double, r double, b double, origin string"
CELLS = "doc string, page_no int, rect_no int, idx int, text string, confidence double, l double, t double, r double, b double"
RECOGNISED = "doc string, chunk_start int, kind string, item_no int, label string, level int, text string, page_no int, rect_no int, idx int, confidence double, l double, t double, r double, b double, origin string, error string"


def frame(rows: list, columns: list[str]) -> pd.DataFrame:
    """Rows as plain objects, so that missing numbers stay missing and strings need no particular type."""
    return pd.DataFrame(rows, columns=columns, dtype=object)


class PdfAdapter(Protocol):
    def page_count(self, content: bytes) -> int: ...

    def split(self, content: bytes, start: int, end: int) -> bytes: ...

    def merge(self, parts: list[bytes]) -> bytes: ...

    def overlay(self, content: bytes, commands: list[dict]) -> bytes: ...


class OcrLayoutAdapter(Protocol):
    def recognise(self, doc: str, content: bytes) -> Iterator[dict]:
        """Rows of kind item, cell or page (a registered page, maybe without cells), pages counted from 1."""


class FigureAdapter(Protocol):
    def figures(self, doc: str, content: bytes, scale: float) -> Iterator[dict]:
        """Rows pic_no (all pictures count), page_no (from 1, or null), bbox, image (null: none), predictions (class, confidence)."""


class CaptionAdapter(Protocol):
    def caption(self, image: bytes, prompt: str | None, timeout: float) -> str | None: ...


class ChatCaptioner:
    """Captions from a server with a chat-completions interface: <base_url>/v1/chat/completions."""

    def __init__(self, base_url: str, model: str) -> None:
        self.url, self.model = base_url.rstrip("/") + "/v1/chat/completions", model

    def caption(self, image: bytes, prompt: str | None, timeout: float) -> str | None:
        picture = {"type": "image_url", "image_url": {"url": "data:image/png;base64," + base64.b64encode(image).decode()}}
        said = {"model": self.model, "messages": [{"role": "user", "content": [{"type": "text", "text": prompt or DEFAULT_PROMPT}, picture]}]}
        call = urllib.request.Request(self.url, json.dumps(said).encode(), {"Content-Type": "application/json"})
        with urllib.request.urlopen(call, timeout=timeout) as answer:
            return json.load(answer)["choices"][0]["message"]["content"]


def named_factory(name: str) -> Callable[[], object]:
    """The factory that `module:name` names, as settings give it."""
    module, _, attribute = name.partition(":")
    if not attribute:
        raise ValueError(f"not module:name: {name}")
    return getattr(importlib.import_module(module), attribute)


class TextPdf:
    """A stand-in for PDF files: pages are texts with form feeds between."""

    def page_count(self, content: bytes) -> int:
        if content.startswith(b"%PDF"):
            raise ValueError("a real PDF file: name an adapter for PDF in the configuration")
        return len(content.split(b"\f")) if content else 0

    def split(self, content: bytes, start: int, end: int) -> bytes:
        return b"\f".join(content.split(b"\f")[start:end])

    def merge(self, parts: list[bytes]) -> bytes:
        return b"\f".join(parts)

    def overlay(self, content: bytes, commands: list[dict]) -> bytes:
        return content


class TextRecogniser:
    """A stand-in for recognition: lines with # are headings, ~ starts a raw cell, ! a picture, others are items.

    A page row has the page's width and height as r and b.
    """

    def figures(self, doc: str, content: bytes, scale: float) -> Iterator[dict]:
        n = 0
        for p, page in enumerate(content.decode("utf-8", "ignore").split("\f"), 1):
            for i, line in enumerate(page.split("\n")):
                if line.startswith("!"):
                    kind, _, text = line[1:].partition(" ")
                    yield {"pic_no": n, "page_no": p, "bbox": [10.0, 15.0 * i, 100.0, 15.0 * i + 12], "image": text.encode() if text else None, "predictions": [(kind, 0.8), ("other", 0.2)] if kind else []}
                    n += 1

    def recognise(self, doc: str, content: bytes) -> Iterator[dict]:
        n = 0
        for p, page in enumerate(content.decode("utf-8", "ignore").split("\f"), 1):
            yield {"kind": "page", "page_no": p, "l": 0.0, "t": 0.0, "r": 612.0, "b": 792.0}
            for i, line in enumerate(page.split("\n")):
                if line.startswith("~"):
                    yield {"kind": "cell", "page_no": p, "rect_no": 0, "idx": i, "text": line[1:], "confidence": 0.9, "l": 10.0, "t": 15.0 * i, "r": 100.0, "b": 15.0 * i + 12}
                elif line and not line.startswith("!"):
                    marks = len(line) - len(line.lstrip("#"))
                    label = {0: "text", 1: "title"}.get(marks, "section_header")
                    yield {"kind": "item", "page_no": p, "item_no": n, "label": label, "level": max(1, marks - 1) if marks > 1 else None, "text": line.lstrip("# ") if marks else line, "l": 10.0, "t": 15.0 * i, "r": 100.0, "b": 15.0 * i + 12, "origin": "TOPLEFT"}
                    n += 1


def page_counts(docs: DataFrame, factory: Callable[[], PdfAdapter]) -> DataFrame:
    """Adds n_pages (null if the file can't be read) and error to (doc, content); content goes no further."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = factory()
        for b in batches:
            rows = []
            for doc, content in zip(b["doc"], b["content"]):
                try:
                    rows.append((doc, pdf.page_count(bytes(content)), None))
                except Exception as e:  # one bad file must not end the corpus
                    rows.append((doc, None, repr(e)))
            yield frame(rows, ["doc", "n_pages", "error"])

    return docs.select("doc", "content").mapInPandas(run, "doc string, n_pages int, error string")


def split_chunks(work: DataFrame, factory: Callable[[], PdfAdapter]) -> DataFrame:
    """doc, chunk_start, chunk_end, content: the byte slice of each planned chunk of (doc, content, chunk_start, chunk_end)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = factory()
        for b in batches:
            rows = [(d, s, e, pdf.split(bytes(c), s, e)) for d, s, e, c in zip(b["doc"], b["chunk_start"], b["chunk_end"], b["content"])]
            yield frame(rows, ["doc", "chunk_start", "chunk_end", "content"])

    return work.select("doc", "chunk_start", "chunk_end", "content").mapInPandas(run, "doc string, chunk_start int, chunk_end int, content binary")


def recognise(chunks: DataFrame, factory: Callable[[], OcrLayoutAdapter], do_ocr: bool = True) -> DataFrame:
    """RECOGNISED rows of (doc, chunk_start, content); a failing chunk gives one row of kind error.

    Without OCR the cells and registered pages are left out, as the layout alone gives items.
    """
    columns = [c.split()[0] for c in RECOGNISED.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engine = factory()
        for b in batches:
            for doc, start, content in zip(b["doc"], b["chunk_start"], b["content"]):
                base = {"doc": doc, "chunk_start": int(start)}
                try:
                    rows = [{**base, **r} for r in engine.recognise(doc, bytes(content)) if do_ocr or r["kind"] == "item"]
                except Exception as e:
                    rows = [{**base, "kind": "error", "error": repr(e)}]
                yield frame([[r.get(c) for c in columns] for r in rows], columns)

    return chunks.select("doc", "chunk_start", "content").mapInPandas(run, RECOGNISED)


def extract_figures(chunks: DataFrame, factory: Callable[[], FigureAdapter], scale: float) -> DataFrame:
    """doc, chunk_start, pic_no, page_no, bbox, image, predictions, error of (doc, chunk_start, content); a failing chunk
    gives one row with an error and nothing else."""
    columns = ["doc", "chunk_start", "pic_no", "page_no", "bbox", "image", "predictions", "error"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engine = factory()
        for b in batches:
            for doc, start, content in zip(b["doc"], b["chunk_start"], b["content"]):
                try:
                    found = list(engine.figures(doc, bytes(content), scale))
                    classes = [[{"class_name": c, "confidence": float(x)} for c, x in r["predictions"]] for r in found]
                    rows = [[doc, int(start), *(r[c] for c in columns[2:6]), p, None] for r, p in zip(found, classes)]
                except Exception as e:
                    rows = [[doc, int(start), *[None] * 5, repr(e)]]
                yield frame(rows, columns)

    kinds = "doc string, chunk_start int, pic_no int, page_no int, bbox array<double>, image binary, predictions array<struct<class_name:string,confidence:double>>, error string"
    return chunks.select("doc", "chunk_start", "content").mapInPandas(run, kinds)


def overlaid(docs: DataFrame, factory: Callable[[], PdfAdapter]) -> DataFrame:
    """doc, data, error: the PDF bytes of (doc, content, commands) with invisible text put on; null and the error if
    that fails."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = factory()
        for b in batches:
            rows = []
            for doc, content, commands in zip(b["doc"], b["content"], b["commands"]):
                try:
                    rows.append((doc, pdf.overlay(bytes(content), [dict(c) for c in (commands if commands is not None else [])]), None))
                except Exception as e:
                    rows.append((doc, None, repr(e)))
            yield frame(rows, ["doc", "data", "error"])

    return docs.select("doc", "content", "commands").mapInPandas(run, "doc string, data binary, error string")


def captions(figures: DataFrame, factory: Callable[[], CaptionAdapter], prompt: str | None, timeout: float) -> DataFrame:
    """doc, pic_no, caption of (doc, pic_no, image); null where the call fails. Results should be written, not recomputed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engine = factory()
        for b in batches:
            rows = []
            for doc, n, image in zip(b["doc"], b["pic_no"], b["image"]):
                try:
                    rows.append((doc, n, engine.caption(bytes(image), prompt, timeout)))
                except Exception:
                    rows.append((doc, n, None))
            yield frame(rows, ["doc", "pic_no", "caption"])

    return figures.select("doc", "pic_no", "image").mapInPandas(run, "doc string, pic_no int, caption string")
