"""Geometry: cell coordinates, the text overlay of searchable PDFs, figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafwork.functions.text import is_blank

SCALE = 2.0


def to_page_points(cells: DataFrame, scale: float = SCALE) -> DataFrame:
    """Cell boxes (l, t, r, b) from pixels of a crop to points of the page; rect_l and rect_t are the crop's corner."""
    return cells.withColumns({c: F.col(c) / F.lit(scale) + F.col(f"rect_{'l' if c in 'lr' else 't'}") for c in "ltrb"})


def flipped(df: DataFrame, height: Column) -> DataFrame:
    """Adds y0 and y1 from the top: boxes that count from the bottom are flipped; no origin means the top."""
    bottom = F.coalesce(F.col("origin") == "BOTTOMLEFT", F.lit(False))
    return df.withColumns({"y0": F.when(bottom, height - F.col("t")).otherwise(F.col("t")), "y1": F.when(bottom, height - F.col("b")).otherwise(F.col("b"))})


def overlay_commands(items: DataFrame, page_height: Column, page_count: Column | None = None) -> DataFrame:
    """doc, page_index, x, y, fontsize, text, item_no of the invisible text to put on pages.

    Blank items, those without page or box, boxes without width or lower than two points, and pages behind the
    document's end give nothing.
    """
    df = items.where(~is_blank(F.col("text")) & F.col("page_no").isNotNull() & F.col("l").isNotNull())
    df = flipped(df, page_height).where((F.col("r") > F.col("l")) & (F.col("y1") > F.col("y0")) & (F.col("y1") - F.col("y0") >= 2))
    if page_count is not None:
        df = df.where(F.col("page_no") <= page_count)
    size = F.greatest(F.lit(4.0), (F.col("y1") - F.col("y0")) * 0.8)
    return df.select("doc", (F.col("page_no") - 1).alias("page_index"), F.col("l").alias("x"), F.col("y1").alias("y"), size.alias("fontsize"), "text", "item_no")


def named_figures(pictures: DataFrame) -> DataFrame:
    """Pictures with an image, and their file name. The number counts all pictures of the document, from 0."""
    n = F.row_number().over(Window.partitionBy("doc").orderBy("pic_no")) - 1
    df = pictures.withColumn("_i", n).where("has_image")
    return df.withColumn("file", F.format_string("fig_p%s_%03d.png", F.coalesce(F.col("page").cast("string"), F.lit("x")), "_i")).withColumnRenamed("_i", "figure_no")


def main_class(predictions: DataFrame) -> DataFrame:
    """doc, pic_no, class_name: the most confident prediction; of equal ones the first by name."""
    best = F.min_by("class_name", F.struct(-F.col("confidence"), "class_name"))
    return predictions.groupBy("doc", "pic_no").agg(best.alias("class_name"))


def figure_manifest(figures: DataFrame, docs: DataFrame | None = None, captioned: bool = False) -> DataFrame:
    """doc, n_figures, json. classification is there only where predicted; caption is there, maybe null, if captioned.

    file, page and bbox are always there, also as null; so the records are put together as text.
    """
    quoted = lambda c: F.substring(F.to_json(F.array(c)), 2, 1 << 30)
    value = lambda c: F.when(c.isNull(), F.lit("null")).otherwise(F.regexp_replace(quoted(c), r"\]\z", ""))
    record = F.concat(
        F.lit('{"file":'), value(F.col("file")), F.lit(',"page":'), F.coalesce(F.col("page").cast("string"), F.lit("null")),
        F.lit(',"bbox":'), F.coalesce(F.to_json("bbox"), F.lit("null")),
        F.when(F.col("class_name").isNotNull(), F.concat(F.lit(',"classification":'), value(F.col("class_name")))).otherwise(""),
        F.concat(F.lit(',"caption":'), value(F.col("caption"))) if captioned else F.lit(""), F.lit("}"),
    )
    rows = figures.withColumn("_r", record).groupBy("doc").agg(F.count("*").alias("n_figures"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("figure_no", "_r"))), lambda x: x["_r"]), ",").alias("_all"))
    if docs is not None:
        rows = docs.select("doc").join(rows, "doc", "left").withColumns({"n_figures": F.coalesce("n_figures", F.lit(0)), "_all": F.coalesce("_all", F.lit(""))})
    return rows.select("doc", "n_figures", F.concat(F.lit('{"n_figures":'), F.col("n_figures").cast("string"), F.lit(',"figures":['), "_all", F.lit("]}")).alias("json"))
