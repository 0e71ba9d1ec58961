"""Sources of a corpus: listings, pruning, allow-lists, resume, and text readers.

Listings never read file contents: only the path column of the binaryFile source is selected.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwork.functions.text import decode_lossy, strip

PAGE_SCHEMA = "page_index int, image_path string, text_lines array<struct<text:string,confidence:double,bbox:array<double>>>, full_text string"


def report_stem(stem: Column) -> Column:
    """The key of a document's outputs: its stem without one trailing _ocr (lower case only)."""
    return F.regexp_replace(stem, r"_ocr\z", "")


def file_stem(path: Column) -> Column:
    """File name without its last suffix; dots before that stay."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?s)(?<=.)\.[^.]*\z", "")


def with_report_stem(df: DataFrame) -> DataFrame:
    return df.withColumn("report_stem", report_stem(F.col("stem")))


def start_from(df: DataFrame, start: str | None, column: str = "stem") -> DataFrame:
    """Documents whose upper-cased stem is not below the upper-cased start; all without a start."""
    return df.where(F.upper(column) >= F.upper(F.lit(start))) if start else df


def allow_list(listing: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(found, missing) for names (list_pos, name): order and duplicates of the list are kept.

    Names are stripped, blank ones dropped, and a final .pdf of any case is cut off before .pdf is put on.
    """
    clean = names.withColumn("name", strip(F.col("name"))).where("name <> ''")
    clean = clean.withColumn("stem", F.regexp_replace("name", r"(?is)\.pdf\z", "")).select("list_pos", "stem")
    found = clean.join(listing, "stem").orderBy("list_pos")
    missing = clean.join(listing.select("stem").distinct(), "stem", "left_anti").orderBy("list_pos")
    return found, missing


def skip_completed(df: DataFrame, done: DataFrame, key: str = "report_stem") -> DataFrame:
    """The documents without a completion mark."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def reject_collisions(df: DataFrame, key: str = "report_stem") -> DataFrame:
    """Adds collides: whether another document would write to the same folder."""
    n = df.groupBy(key).agg(F.count("*").alias("_n"))
    return df.join(n, key).withColumn("collides", F.col("_n") > 1).drop("_n")


def read_files(spark: SparkSession, pattern: str, name_glob: str | None = None, recursive: bool = False) -> DataFrame:
    """path, stem, parent, content of the files of a glob; an empty table where nothing matches."""
    reader = spark.read.format("binaryFile")
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    try:
        df = reader.load(pattern)
    except Exception as e:  # Spark reports a glob without matches as an error
        if "PATH_NOT_FOUND" not in str(e):
            raise
        df = spark.createDataFrame([], "path string, content binary")
    parts = F.split("path", "/")
    return df.select("path", file_stem(F.col("path")).alias("stem"), F.element_at(parts, -2).alias("parent"), "content")


def list_files(spark: SparkSession, pattern: str, name_glob: str | None = None, recursive: bool = False) -> DataFrame:
    """path, stem, parent of the files of a glob; their contents are not read."""
    return read_files(spark, pattern, name_glob, recursive).drop("content")


def kind_of(spark: SparkSession, path: str) -> str | None:
    """`file` or `folder` on whatever file system it is; None where there is neither."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(where):
        return None
    return "folder" if system.getFileStatus(where).isDirectory() else "file"


def read_pdfs(spark: SparkSession, pdf_input: str, from_ocr_pdf: bool = False) -> DataFrame:
    """path and content of the files that list_pdfs may name."""
    if kind_of(spark, pdf_input) == "file":
        found = read_files(spark, pdf_input)
    elif from_ocr_pdf:
        found = read_files(spark, f"{pdf_input}/*/*_ocr.pdf").unionByName(read_files(spark, pdf_input, "*.pdf"))
    else:
        found = read_files(spark, pdf_input, "*.pdf")
    return found.select("path", "content")


def list_pdfs(spark: SparkSession, pdf_input: str, start: str | None = None, file_list: list[str] | None = None, from_ocr_pdf: bool = False) -> tuple[DataFrame, DataFrame]:
    """(documents, missing) with path, stem, list_pos, in processing order.

    A single .pdf file stands for itself and every other option is ignored; then a file list wins over the scan of
    */*_ocr.pdf, and that over the start. Neither a .pdf file nor a folder is an error.
    """
    none = spark.createDataFrame([], "stem string, list_pos int")
    kind = kind_of(spark, pdf_input)
    if kind == "file" and pdf_input.lower().endswith(".pdf"):
        return list_files(spark, pdf_input).select("path", "stem", F.lit(0).alias("list_pos")), none
    if kind != "folder":
        raise ValueError(f"neither a .pdf file nor a folder: {pdf_input}")
    if file_list is not None:
        names = spark.createDataFrame([(i, n) for i, n in enumerate(file_list)], "list_pos int, name string")
        found, missing = allow_list(list_files(spark, pdf_input, "*.pdf"), names)
        return found.select("path", "stem", "list_pos"), missing
    if from_ocr_pdf:
        return list_files(spark, f"{pdf_input}/*/*_ocr.pdf").orderBy(F.upper("parent"), "path").select("path", "stem", F.lit(None).cast("int").alias("list_pos")), none
    listed = start_from(list_files(spark, pdf_input, "*.pdf"), start)
    return listed.orderBy(F.upper("stem"), "path").select("path", "stem", F.lit(None).cast("int").alias("list_pos")), none


def list_reports(spark: SparkSession, base: str, subfolders: bool = False) -> DataFrame:
    """Report folders that hold a page file: base/<report>, or base/<district>/<report> without districts ending in _md."""
    found = list_files(spark, f"{base}/{'*/*' if subfolders else '*'}/ocr_docling.json")
    found = found.select(F.regexp_replace("path", "/[^/]*$", "").alias("dir"), F.col("parent").alias("report"))
    if subfolders:
        found = found.withColumn("district", F.element_at(F.split("dir", "/"), -2)).where(~F.endswith("district", F.lit("_md")))
    return found.orderBy("dir")


def read_pages(spark: SparkSession, pattern: str, *more: str) -> DataFrame:
    """doc and the page columns from page files; doc is the folder's name. more: `dir` for the folder's path too."""
    try:
        df = spark.read.schema(PAGE_SCHEMA).json(pattern, multiLine=True).withColumn("_path", F.col("_metadata.file_path"))
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        df = spark.createDataFrame([], f"{PAGE_SCHEMA}, _path string")
    path = F.url_decode(F.replace("_path", F.lit("+"), F.lit("%2B")))
    folder = F.regexp_replace(F.regexp_replace(path, "/[^/]*$", ""), "^file:/+", "file:/")
    df = df.withColumns({"dir": folder, "doc": F.element_at(F.split(folder, "/"), -1)})
    return df.select("doc", *more, "page_index", "image_path", F.coalesce("text_lines", F.array()).alias("text_lines"), "full_text")


def read_heading_counts(spark: SparkSession, pattern: str) -> DataFrame:
    """doc, n_headings of heading files; 0 where the file is not JSON or has no such number."""
    files = read_files(spark, pattern)
    text = decode_lossy(F.col("content"))
    return files.select(F.col("parent").alias("doc"), F.coalesce(F.get_json_object(text, "$.n_headings").try_cast("int"), F.lit(0)).alias("n_headings"))


def read_texts(spark: SparkSession, base: str, name: str = "text_docling.txt", lossy: bool = True) -> DataFrame:
    """doc, path, text of all files of that name below base. Lossy: invalid bytes vanish; else they are an error."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", name).load(base)
    text = decode_lossy(F.col("content")) if lossy else F.decode("content", "UTF-8")
    return df.select(F.element_at(F.split("path", "/"), -2).alias("doc"), "path", text.alias("text")).orderBy("path")


def with_status(reports: DataFrame, markdown: DataFrame, pages: DataFrame, headings: DataFrame) -> DataFrame:
    """doc, status: what stands in a report's way to a rebuild: no_markdown, no_pages, no_headings, else ready."""
    flag = lambda df, name: df.select("doc").distinct().withColumn(name, F.lit(True))
    df = reports.join(flag(markdown, "_m"), "doc", "left").join(flag(pages, "_p"), "doc", "left").join(flag(headings, "_h"), "doc", "left")
    status = F.when(F.col("_m").isNull(), "no_markdown").when(F.col("_p").isNull(), "no_pages").when(F.col("_h").isNull(), "no_headings").otherwise("ready")
    return df.select("doc", status.alias("status"))


@dataclass
class Config:
    """Settings of a run; unknown keys are kept but unused."""

    pdf_input: str = ""
    output_dir: str = ""
    start_from: str | None = None
    file_list: str | None = None
    skip_existing: bool = False
    from_ocr_pdf: bool = False
    chunk_size: int | None = None
    docling: dict = field(default_factory=dict)
    other: dict = field(default_factory=dict)

    @classmethod
    def load(cls, path: str, **overrides: str | None) -> Config:
        """From a YAML file; truthy overrides win; a relative file list is sought beside the file; a null block is empty."""
        import yaml

        raw = yaml.safe_load(Path(path).read_text()) or {}
        raw |= {k: v for k, v in overrides.items() if v}
        if raw.get("file_list") and not os.path.isabs(raw["file_list"]):
            raw["file_list"] = str(Path(path).resolve().parent / raw["file_list"])
        raw["docling"] = raw.get("docling") or {}
        known = {k: v for k, v in raw.items() if k in cls.__dataclass_fields__}
        return cls(**known, other={k: v for k, v in raw.items() if k not in known})

    def stages(self) -> dict[str, bool | float | str | None]:
        """Which optional stages run."""
        d = self.docling
        figures = bool(d.get("extract_figures", False))
        return {
            "do_ocr": bool(d.get("do_ocr", True)),
            "extract_figures": figures,
            "figures_scale": float(d.get("figures_scale", 2.0)),
            "classify_figures": figures and bool(d.get("classify_figures", False)),
            "picture_description_model": d.get("picture_description_model"),
            "picture_description_base_url": d.get("picture_description_base_url", "http://localhost:11434"),
            "picture_description_timeout": float(d.get("picture_description_timeout", 120)),
            "picture_description_prompt": d.get("picture_description_prompt"),
        }
