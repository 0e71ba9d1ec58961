"""Inputs of the core queries, derived from the driver's tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def items(spark: SparkSession, sf_dir: str, gaps: bool = False, no_page: bool = False) -> DataFrame:
    """conversations as layout items, a turn a page, a line an item."""
    c = table(spark, sf_dir, "conversations")
    if gaps:
        c = c.where("turn % 3 <> 1")
    df = c.select(F.concat(F.lit("conv_"), F.col("conv_id")).alias("doc"), "turn", "role", F.posexplode(F.split("text", "\n")).alias("line_in_turn", "text"))
    label = F.when(F.col("role") == "system", "title").when(F.col("role") == "user", "section_header").otherwise("text")
    page = F.col("turn") + 1
    df = df.withColumns(
        {
            "item_no": F.row_number().over(Window.partitionBy("doc").orderBy("turn", "line_in_turn")) - 1,
            "label": label,
            "level": (F.col("turn") % 7 + 1).cast("int"),
            "page_no": (F.when(F.col("turn") % 5 != 4, page) if no_page else page).cast("int"),
        }
    )
    return df.select("doc", "item_no", "label", "level", "text", "page_no", "turn", "line_in_turn")


def raw_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1b: raw cells of the pages of F1: longer, shorter, equal or absent by turn modulo 4."""
    from leafwork.operators.pages import marked_text

    df = items(spark, sf_dir).withColumn("line", marked_text()).where("turn % 4 <> 3")
    text = F.when(F.col("turn") % 4 == 0, F.concat("line", F.lit(" raw" + "x" * 9))).when(F.col("turn") % 4 == 1, F.substring("text", 1, 3)).otherwise(F.col("line"))
    return df.select("doc", "page_no", F.lit(0).alias("rect_no"), F.col("line_in_turn").alias("idx"), text.alias("text"), F.lit(0.5).alias("confidence"), F.lit(10.0).alias("l"), (F.col("line_in_turn") * 15.0).alias("t"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents' lines, some of them turned into headings and noise."""
    df = table(spark, sf_dir, "documents").select(F.concat(F.lit("doc_"), F.col("doc_id")).alias("doc"), "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    marks = F.repeat(F.lit("#"), F.col("line_no") % 7 + 1)
    noise = F.concat(F.lit("## "), (F.col("line_no") * 37).cast("string"), F.lit(" - "), F.col("doc_id").cast("string"))
    line = F.when(F.col("line_no") % 11 == 0, noise).when(F.col("line_no") % 5 == 0, F.concat(marks, F.lit(" "), F.substring("line", 1, 40))).otherwise(F.col("line"))
    return df.select("doc", "line_no", line.alias("line"))


def markdown(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(Markdown lines, page lines): a page's h1 as heading, a repeated key, and paragraphs that may equal it."""
    p = table(spark, sf_dir, "pages").select(F.concat(F.lit("page_"), F.col("page_id")).alias("doc"), F.regexp_extract("html", "(?s)<h1[^>]*>(.*?)</h1>", 1).alias("h1"), F.regexp_extract("html", "(?s)<p[^>]*>(.*?)</p>", 1).alias("p"))
    md = p.select("doc", F.posexplode(F.array(F.concat(F.lit("## "), "h1"), F.lit("body text"), F.concat(F.lit("#### "), "h1"), F.lit("  ## Padded"))).alias("line_no", "line"))
    plain = F.col("h1")
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(name), F.lit(char))
    out = p.select("doc", F.lit(0).alias("page_index"), F.posexplode(F.array(F.concat(F.lit("  "), plain, F.lit(" ")), F.col("p"), F.lit("body text"))).alias("line_no", "line"))
    return md, out


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as PDF files with a page for every 500 characters."""
    d = table(spark, sf_dir, "documents")
    stem = F.concat(F.lit("Doc."), F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 3 == 0, "_ocr").otherwise(""))
    return d.select("doc_id", stem.alias("stem"), (F.floor(F.col("n_chars") / 500) + 1).cast("int").alias("n_pages"))


def geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order lines as cells with boxes."""
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    df = table(spark, sf_dir, "lineitem").withColumn("item_no", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*key)))
    top = (F.col("l_partkey") % 105) * 7.5
    bottom = top + F.col("l_linenumber") * 2.5 - 1
    below = F.col("l_linestatus") == "F"
    return df.select(
        F.col("l_orderkey").alias("doc"), "item_no", (F.col("l_linenumber") % 3 + 1).cast("int").alias("page_no"), F.lit(0).alias("rect_no"), F.col("item_no").alias("idx"),
        F.col("l_quantity").cast("double").alias("l"), (F.col("l_quantity") + F.col("l_suppkey") % 40).cast("double").alias("r"),
        F.when(below, bottom).otherwise(top).cast("double").alias("t"), F.when(below, top).otherwise(bottom).cast("double").alias("b"), top.cast("double").alias("top"),
        F.when(F.col("l_returnflag") == "R", "  ").otherwise(F.concat("l_returnflag", "l_linestatus")).alias("text"), F.when(below, "BOTTOMLEFT").otherwise("TOPLEFT").alias("origin"),
    )


def figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as pictures of documents."""
    df = table(spark, sf_dir, "embeddings").withColumn("pic_no", F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1)
    page = F.when(F.col("vec_id") % 11 != 0, F.col("vec_id") % 7).cast("int")
    return df.select(F.concat(F.lit("d"), F.col("label").cast("string")).alias("doc"), "vec_id", "pic_no", page.alias("page"), F.slice("embedding", 1, 4).cast("array<double>").alias("bbox"), (F.col("vec_id") % 5 != 0).alias("has_image"))
