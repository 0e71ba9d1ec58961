"""The three programs as plans: convert a corpus, backfill headings, extract headings."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafwork.functions import text as T
from leafwork.operators import adapters, chunks, geometry, headings, pages
from leafwork.sources import corpus, sinks
from leafwork.sources.shared import cut


def options_hash(config: corpus.Config) -> str:
    """What tells cached chunk results of different options apart."""
    return hashlib.sha256(json.dumps(config.docling, sort_keys=True, default=str).encode()).hexdigest()[:16]


def work_set(spark: SparkSession, config: corpus.Config) -> tuple[DataFrame, DataFrame]:
    """(documents to do, missing names) of a run."""
    names = None
    if config.file_list:
        with open(config.file_list, encoding="utf-8") as f:
            names = f.read().splitlines()
    docs, missing = corpus.list_pdfs(spark, config.pdf_input, config.start_from, names, config.from_ocr_pdf)
    docs = corpus.reject_collisions(corpus.with_report_stem(docs).dropDuplicates(["path"]))
    if config.skip_existing:
        done = corpus.list_reports(spark, config.output_dir).select(F.col("report").alias("report_stem"))
        docs = corpus.skip_completed(docs, done)
    return docs, missing


def searchable(items: DataFrame, registered: DataFrame, content: DataFrame, counts: DataFrame, pdf: Callable[[], adapters.PdfAdapter]) -> DataFrame:
    """doc, name, data, error of the PDF files with invisible text. Page heights come from the registered pages; an item on
    another page has that of the document's highest page."""
    heights = registered.groupBy("doc", "page_no").agg(F.max("b").alias("height"))
    highest = registered.groupBy("doc").agg(F.max("b").alias("highest"))
    placed = items.join(heights, ["doc", "page_no"], "left").join(highest, "doc").join(counts.select("doc", "n_pages"), "doc")
    commands = geometry.overlay_commands(placed, F.coalesce("height", "highest"), F.col("n_pages"))
    by_doc = commands.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("item_no", "page_index", "x", "y", "fontsize", "text"))).alias("commands"))
    by_doc = by_doc.withColumn("commands", F.transform("commands", lambda c: F.struct(*[c[k].alias(k) for k in ("page_index", "x", "y", "fontsize", "text")])))
    files = adapters.overlaid(content.join(counts.select("doc"), "doc").join(by_doc, "doc", "left"), pdf)
    return files.select("doc", F.concat("doc", F.lit("_ocr.pdf")).alias("name"), "data", "error")


def figure_files(
    parts: DataFrame, stages: dict, figures: Callable[[], adapters.FigureAdapter], captioner: Callable[[], adapters.CaptionAdapter] | None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(image files, manifests, errors as doc and status). Pictures are numbered over all chunks of a document, pages
    counted in the document. They are found once; a document with a chunk that fails has no files."""
    every = cut(adapters.extract_figures(parts, figures, stages["figures_scale"]))
    errors = every.where("error is not null").groupBy("doc").agg(F.min("error").alias("status"))
    df = every.drop("error").join(errors.select("doc"), "doc", "left_anti")
    n = F.row_number().over(Window.partitionBy("doc").orderBy("chunk_start", "pic_no")) - 1
    df = df.withColumns({"pic_no": n, "page": F.col("page_no") + F.col("chunk_start") - 1, "has_image": F.col("image").isNotNull()})
    best = F.array_sort(F.transform("predictions", lambda p: F.struct((-p["confidence"]).alias("c"), p["class_name"].alias("n"))))
    df = df.withColumn("class_name", F.try_element_at(best, F.lit(1))["n"] if stages["classify_figures"] else F.lit(None).cast("string"))
    named = geometry.named_figures(df)
    captioned = bool(stages["picture_description_model"]) and captioner is not None
    if captioned:
        said = adapters.captions(named, captioner, stages["picture_description_prompt"], stages["picture_description_timeout"])
        named = named.join(said, ["doc", "pic_no"], "left")
    else:
        named = named.withColumn("caption", F.lit(None).cast("string"))
    images = named.select("doc", F.concat(F.lit("figures/"), "file").alias("name"), F.col("image").alias("data"))
    docs = parts.select("doc").distinct().join(errors.select("doc"), "doc", "left_anti")
    return images, geometry.figure_manifest(named, docs, captioned), errors


def convert(
    spark: SparkSession,
    config: corpus.Config,
    pdf: Callable[[], adapters.PdfAdapter],
    ocr: Callable[[], adapters.OcrLayoutAdapter],
    cache_dir: str | None = None,
    figures: Callable[[], adapters.FigureAdapter] | None = None,
    captioner: Callable[[], adapters.CaptionAdapter] | None = None,
) -> DataFrame:
    """Runs the conversion and returns doc, status, n_pages. Colliding and failing documents get a status and no page
    file, so that a later run tries them again; a document fails if any of its chunks, figures or files does. Names of
    the file list without a file have the status `not found`.

    Recognition, figures and files are made once; PDF files with text and figures are written before each folder's page
    file. With cache_dir the recognised rows of each chunk are kept there by document, range and options, and read again.
    """
    docs, missing = work_set(spark, config)
    status = lambda df, text: df.select("doc", text.alias("status"), F.lit(0).alias("n_pages"))
    docs = cut(docs)
    listed = docs.where(~F.col("collides")).select(F.col("report_stem").alias("doc"), "path")
    bad = status(docs.where("collides").select(F.col("report_stem").alias("doc")).distinct(), F.lit("name collision"))
    bad = bad.unionByName(status(missing.select(F.col("stem").alias("doc")).distinct(), F.lit("not found")))
    if listed.isEmpty():
        return bad
    content = corpus.read_pdfs(spark, config.pdf_input, config.from_ocr_pdf).join(listed, "path").select("doc", "content")
    counts = cut(adapters.page_counts(content, pdf))
    bad = bad.unionByName(status(counts.where("n_pages is null"), F.col("error")))
    counts = counts.where("n_pages is not null")
    size = config.chunk_size or 0
    plan = chunks.plan_chunks(counts, size, "doc") if size else None
    whole = counts.where(~chunks.is_chunked(F.col("n_pages"), size or None)).select("doc", F.lit(0).alias("chunk_start"), F.col("n_pages").alias("chunk_end"))
    every = whole if plan is None else whole.unionByName(plan.select("doc", "chunk_start", "chunk_end"))
    work, reused = every, None
    if cache_dir:
        work = work.withColumn("options", F.lit(options_hash(config)))
        try:
            cache = spark.read.parquet(cache_dir)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            cache = None
        if cache is not None:
            keys = ("doc", "chunk_start", "chunk_end", "options")
            work, again = chunks.resume(work, cache, keys)
            reused = cut(cache.join(again, list(keys), "left_semi").drop("chunk_end", "options"))
            work = cut(work)  # the cache grows below
    stages = config.stages()
    parts = adapters.split_chunks(work.join(content, "doc"), pdf)
    rows = cut(adapters.recognise(parts, ocr, bool(stages["do_ocr"])))
    if cache_dir:
        rows.where("kind <> 'error'").join(work, ["doc", "chunk_start"]).write.mode("append").parquet(cache_dir)
    if reused is not None:
        rows = rows.unionByName(reused)
    failed = rows.where("kind = 'error'").groupBy("doc").agg(F.min("error").alias("status"))
    good = counts.join(failed.select("doc"), "doc", "left_anti")
    rows = rows.join(failed.select("doc"), "doc", "left_anti").withColumn("page_no", F.col("page_no") + F.col("chunk_start"))
    items = rows.where("kind = 'item'").withColumn("item_no", F.struct("chunk_start", "item_no"))
    registered = rows.where("kind = 'page'").select("doc", "page_no", "b")
    written = []
    if stages["do_ocr"]:
        written.append(cut(sinks.write_files(searchable(items, registered, content, good, pdf), config.output_dir)))
    if stages["extract_figures"] and figures is not None:
        pictures = every.join(good.select("doc"), "doc").join(content, "doc")
        images, manifests, errors = figure_files(adapters.split_chunks(pictures, pdf), stages, figures, captioner)
        written += [cut(sinks.write_files(images, config.output_dir)), cut(sinks.write_manifests(manifests, config.output_dir)), errors]
    for done in written:
        failed = failed.unionByName(done.where("status <> 'written'").groupBy("doc").agg(F.min("status").alias("status")))
    failed = cut(failed.groupBy("doc").agg(F.min("status").alias("status")))
    good = good.join(failed.select("doc"), "doc", "left_anti").select("doc")
    items, registered = (x.join(failed.select("doc"), "doc", "left_anti") for x in (items, registered))
    cells = rows.where("kind = 'cell'").select("doc", "page_no", "rect_no", "idx", "text", T.round4(F.col("confidence")).alias("confidence"), "l", "t", "r", "b")
    result = pages.page_results(items, cells.join(good, "doc", "left_semi"), registered.select("doc", "page_no"))
    texts = pages.document_text(result, good)
    found = headings.heading_records(headings.headings_of_texts(texts), good)
    line = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item_no", "line"))), lambda x: x["line"]), "\n\n")
    markdown = chunks.merge_texts(pages.item_lines(items).groupBy("doc", F.col("item_no.chunk_start").alias("chunk_start")).agg(line.alias("md")))
    records = sinks.document_records(result, texts, found, markdown)
    out = cut(sinks.write_folders(records, config.output_dir, config.docling.get("markdown_dir")))
    return out.unionByName(status(failed, F.col("status"))).unionByName(bad)


def rebuild(page_rows: DataFrame, markdown: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pages with full_text and n_matched, status) from page records, (doc, md) and the documents with a page file."""
    keys = headings.markdown_headings(T.exploded_lines(markdown, "md", "doc"))
    done = headings.rebuilt_pages(headings.promoted_lines(headings.page_lines(page_rows), keys))
    return done, corpus.with_status(docs, markdown, docs, keys)


def backfill(spark: SparkSession, base: str, subfolders: bool = False, dry_run: bool = False) -> DataFrame:
    """doc, status, n_matched for the reports below base; writes text files unless dry_run."""
    reports = corpus.list_reports(spark, base, subfolders)
    level = "*/*" if subfolders else "*"
    rows = corpus.read_pages(spark, f"{base}/{level}/ocr_docling.json", "dir").join(reports.select("dir"), "dir", "left_semi").drop("dir")
    md = corpus.read_files(spark, f"{base}/{level}/*.md").where("stem = parent")
    texts = md.select(F.col("parent").alias("doc"), F.decode("content", "UTF-8").alias("md"))
    done, status = rebuild(rows, texts, reports.select(F.col("report").alias("doc")))
    matched = done.groupBy("doc").agg(F.sum("n_matched").alias("n_matched"))
    out = status.join(reports.select(F.col("report").alias("doc"), "dir"), "doc").join(matched, "doc", "left")
    if not dry_run:
        ready = pages.document_text(done).join(out.where("status = 'ready'").select("doc", "dir"), "doc")
        _write_texts(ready)
    return out.select("doc", "status", F.coalesce("n_matched", F.lit(0)).alias("n_matched"))


def _write_texts(rows: DataFrame) -> None:
    def run(batches):
        for b in batches:
            for folder, text in zip(b["dir"], b["text"]):
                sinks._put(f"{folder.removeprefix('file:')}/text_docling.txt", text)
            yield b[["doc"]].astype(object)

    rows.mapInPandas(run, "doc string").count()


def extract(spark: SparkSession, base: str, force: bool = False, dry_run: bool = False) -> DataFrame:
    """written, skipped: headings.json beside each text file below base."""
    texts = corpus.read_texts(spark, base)
    have = corpus.list_files(spark, base, "headings.json", recursive=True).select(F.regexp_replace("path", "/[^/]*$", "").alias("dir"))
    texts = texts.withColumn("dir", F.regexp_replace("path", "/[^/]*$", ""))
    todo = texts if force else texts.join(have, "dir", "left_anti")
    summary = headings.extract_summary(texts.select(F.col("dir").alias("doc")), have.select(F.col("dir").alias("doc")), force).first()
    if not dry_run:
        keyed = todo.select(F.col("dir").alias("doc"), "text")
        records = headings.heading_records(headings.headings_of_texts(keyed), keyed)

        def run(batches):
            for b in batches:
                for folder, heads in zip(b["document"], b["headings"]):
                    folder = folder.removeprefix("file:")
                    rows = [{"page": int(h["page"]), "text": h["text"]} for h in heads]
                    sinks._put(f"{folder}/headings.json", json.dumps({"document": folder.rstrip("/").rsplit("/", 1)[-1], "n_headings": len(rows), "headings": rows}, ensure_ascii=False, indent=2))
                yield b[["document"]].astype(object)

        records.mapInPandas(run, "document string").count()
    return spark.createDataFrame([(summary["written"], summary["skipped"])], "written long, skipped long")
