"""Headings: found in page-marked text, read from Markdown, and put back into older page files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafwork.functions import text as T


def headings_of_lines(lines: DataFrame) -> DataFrame:
    """doc, line_no, page, text of the headings among (doc, line_no, line).

    Page marks set the page for the lines behind them, 0 before the first; noise is dropped.
    """
    df = lines.withColumn("_s", T.strip(F.col("line")))
    df = df.withColumn("_mark", T.page_number(F.col("_s")))
    before = Window.partitionBy("doc").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("page", F.coalesce(F.last("_mark", ignorenulls=True).over(before), F.lit(0)))
    df = df.where(~F.col("_s").rlike(T.PAGE_MARK) & T.heading_level(F.col("_s")).isNotNull()).withColumn("text", T.heading_text(F.col("_s")))
    return df.where(~T.is_noise_heading(F.col("text"))).select("doc", "line_no", "page", "text")


def headings_of_texts(texts: DataFrame) -> DataFrame:
    """The headings of (doc, text)."""
    return headings_of_lines(T.exploded_lines(texts, "text", "doc"))


def heading_records(headings: DataFrame, docs: DataFrame) -> DataFrame:
    """document, n_headings, headings array<struct<page,text>> in document order; every document has a record."""
    got = headings.groupBy("doc").agg(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "page", "text"))), lambda h: F.struct(h["page"].alias("page"), h["text"].alias("text"))).alias("headings"))
    df = docs.select("doc").distinct().join(got, "doc", "left")
    found = F.coalesce("headings", F.array().cast("array<struct<page:int,text:string>>"))
    return df.select(F.col("doc").alias("document"), F.size(found).alias("n_headings"), found.alias("headings"))


def extract_summary(docs: DataFrame, existing: DataFrame, force: bool = False) -> DataFrame:
    """written, skipped: with force nothing is skipped."""
    df = docs.select("doc").join(existing.select("doc").distinct().withColumn("_e", F.lit(True)), "doc", "left")
    skip = F.lit(False) if force else F.coalesce("_e", F.lit(False))
    return df.agg(F.count_if(~skip).alias("written"), F.count_if(skip).alias("skipped"))


def markdown_headings(lines: DataFrame, rules: T.Rules = T.PYTHON) -> DataFrame:
    """doc, key, level from Markdown lines (doc, line_no, line); of equal keys the last line wins.

    Lines are not stripped, so an indented one is no heading; no noise is dropped.
    """
    df = lines.withColumn("level", T.heading_level(F.col("line"), rules.heading)).where("level is not null")
    df = df.withColumn("key", rules.normalize(rules.unescape(F.regexp_extract("line", rules.heading, 2))))
    return df.groupBy("doc", "key").agg(F.max_by("level", "line_no").alias("level"))


def promoted_lines(lines: DataFrame, headings: DataFrame, rules: T.Rules = T.PYTHON) -> DataFrame:
    """lines (doc, page_index, line_no, line) with level and out: the marks of the heading whose key equals the
    normalised line, before the unchanged line. A document's dictionary meets only its own lines."""
    df = lines.withColumn("key", rules.normalize(F.col("line"))).join(headings, ["doc", "key"], "left")
    return df.withColumn("out", F.when(F.col("level").isNotNull(), F.concat(F.repeat(F.lit("#"), F.col("level")), F.lit(" "), "line")).otherwise(F.col("line"))).drop("key")


def page_lines(pages: DataFrame) -> DataFrame:
    """doc, page_index, line_no, line of the pages' text_lines; a page without lines keeps a row with null line_no."""
    df = pages.select("doc", "page_index", F.posexplode_outer("text_lines").alias("line_no", "_l"))
    return df.select("doc", "page_index", "line_no", F.when(F.col("line_no").isNotNull(), F.coalesce(F.col("_l.text"), F.lit(""))).alias("line"))


def rebuilt_pages(promoted: DataFrame) -> DataFrame:
    """doc, page_index, full_text, n_matched from promoted lines."""
    lines = F.transform(F.array_sort(F.collect_list(F.when(F.col("line_no").isNotNull(), F.struct("line_no", "out")))), lambda x: x["out"])
    return promoted.groupBy("doc", "page_index").agg(F.array_join(lines, "\n").alias("full_text"), F.count("level").alias("n_matched"))


def backfill_summary(status: DataFrame) -> DataFrame:
    """would_write, total of (doc, status); counted the same in a dry run."""
    return status.agg(F.count_if(F.col("status") == "ready").alias("would_write"), F.count("*").alias("total"))


def heading_excerpts(headings: DataFrame, lines: DataFrame) -> DataFrame:
    """headings with excerpt: the first line of the page that is neither blank, page mark nor heading. lines: doc, page, line_no, line."""
    s = T.strip(F.col("line"))
    body = lines.where((s != "") & ~s.rlike(T.PAGE_MARK) & T.heading_level(s).isNull())
    first = body.groupBy("doc", "page").agg(F.min_by("line", "line_no").alias("excerpt"))
    return headings.join(first, ["doc", "page"], "left")
