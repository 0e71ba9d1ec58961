"""Page assembly: items to page text, a dense spine, reading order, and the fallback to raw recognition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwork.functions.text import is_blank, strip

BAND = 15.0


def marked_text() -> Column:
    """An item's text with the marks of its heading level; the marks come once, also before text of several lines."""
    level = F.least(F.col("level") + 1, F.lit(6))
    return F.when(F.col("label") == "title", F.concat(F.lit("# "), "text")).when(F.col("label") == "section_header", F.concat(F.repeat(F.lit("#"), level), F.lit(" "), "text")).otherwise(F.col("text"))


def item_lines(items: DataFrame) -> DataFrame:
    """doc, page_index (from 0), item_no, line. Items without text go, blank ones stay; without a page it is page 0."""
    kept = items.where(F.col("text").isNotNull() & (F.col("text") != ""))
    return kept.select("doc", F.coalesce(F.col("page_no") - 1, F.lit(0)).alias("page_index"), "item_no", marked_text().alias("line"))


def _joined(order: tuple[str, ...], value: str) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct(*order, value))), lambda x: x[value])


def assembled_pages(items: DataFrame) -> DataFrame:
    """doc, page_index, lines, assembled: the page's items in document order, joined by line feeds."""
    pages = item_lines(items).groupBy("doc", "page_index").agg(_joined(("item_no",), "line").alias("lines"))
    return pages.withColumn("assembled", F.array_join("lines", "\n"))


def page_spine(item_pages: DataFrame, ocr_pages: DataFrame | None = None) -> DataFrame:
    """doc, page_index: every page from 0 to the last one that has items or that recognition registered.

    item_pages: doc, page_index (from 0). ocr_pages: doc, page_no (from 1). Documents with neither have no pages.
    """
    last = item_pages.select("doc", "page_index")
    if ocr_pages is not None:
        last = last.unionByName(ocr_pages.select("doc", (F.col("page_no") - 1).alias("page_index")))
    last = last.groupBy("doc").agg(F.max("page_index").alias("last")).where("last >= 0")
    return last.select("doc", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("page_index"))


def reading_order(cells: DataFrame) -> DataFrame:
    """Cells with text, and their band: rows of 15 points, halves to even. Order: band, l, rect_no, idx."""
    return cells.where(~is_blank(F.col("text"))).withColumn("band", F.rint(F.col("t") / F.lit(BAND)))


def raw_pages(cells: DataFrame) -> DataFrame:
    """doc, page_index, cells (text and confidence in reading order), raw: their texts joined by line feeds."""
    pages = reading_order(cells).groupBy("doc", (F.col("page_no") - 1).alias("page_index")).agg(F.array_sort(F.collect_list(F.struct("band", "l", "rect_no", "idx", "text", "confidence"))).alias("cells"))
    return pages.withColumn("raw", F.array_join(F.transform("cells", lambda c: c["text"]), "\n"))


def page_results(items: DataFrame, cells: DataFrame | None = None, ocr_pages: DataFrame | None = None) -> DataFrame:
    """doc, page_index, image_path, text_lines, full_text, recovered.

    A page takes its raw cells instead of its items if it has cells and their stripped text is longer, in code
    points and with heading marks counted, than the assembled one. All parts are dealt by document and page, so the
    spine, items and cells meet in one exchange each.
    """
    assembled = assembled_pages(items)
    if cells is not None and ocr_pages is None:
        ocr_pages = cells.select("doc", "page_no").distinct()
    df = page_spine(assembled, ocr_pages).join(assembled, ["doc", "page_index"], "left")
    none = F.array().cast("array<double>")
    text = F.coalesce("assembled", F.lit(""))
    lines = F.transform(F.coalesce("lines", F.array().cast("array<string>")), lambda x: F.struct(x.alias("text"), F.lit(1.0).alias("confidence"), none.alias("bbox")))
    recovered = F.lit(False)
    if cells is not None:
        df = df.join(raw_pages(cells), ["doc", "page_index"], "left")
        recovered = F.col("cells").isNotNull() & (F.char_length(strip(F.col("raw"))) > F.char_length(strip(text)))
        taken = F.transform("cells", lambda c: F.struct(c["text"].alias("text"), c["confidence"].alias("confidence"), none.alias("bbox")))
        lines, text = F.when(recovered, taken).otherwise(lines), F.when(recovered, F.col("raw")).otherwise(text)
    return df.select("doc", "page_index", F.lit("").alias("image_path"), lines.alias("text_lines"), text.alias("full_text"), recovered.alias("recovered"))


def recovered_counts(pages: DataFrame) -> DataFrame:
    """doc, n_pages, n_recovered."""
    return pages.groupBy("doc").agg(F.count("*").alias("n_pages"), F.count_if("recovered").alias("n_recovered"))


def document_text(pages: DataFrame, docs: DataFrame | None = None, mark_from: str = "page_index") -> DataFrame:
    """doc, text: `=== Page i ===` and the page's text for each page, a blank line between. docs: documents that
    give an empty text if they have no pages."""
    part = F.concat(F.lit("=== Page "), F.col(mark_from).cast("string"), F.lit(" ===\n"), "full_text")
    texts = pages.select("doc", "page_index", part.alias("part")).groupBy("doc").agg(F.array_join(_joined(("page_index",), "part"), "\n\n").alias("text"))
    return texts if docs is None else docs.select("doc").join(texts, "doc", "left").withColumn("text", F.coalesce("text", F.lit("")))
