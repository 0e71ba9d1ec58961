"""Page-range chunks: planning, resuming, merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_chunked(n_pages: Column, size: int | None) -> Column:
    """A document is chunked only if it has more pages than a chunk, and there is a chunk size."""
    return n_pages > size if size else F.lit(False)


def plan_chunks(docs: DataFrame, size: int, *keep: str) -> DataFrame:
    """keep, n_pages, chunk_start, chunk_end (exclusive), chunk_name of chunked documents; others give no rows."""
    starts = F.explode(F.sequence(F.lit(0), F.col("n_pages") - 1, F.lit(size)))
    df = docs.where((F.col("n_pages") > 0) & is_chunked(F.col("n_pages"), size)).select(*keep, "n_pages", starts.alias("chunk_start"))
    return df.withColumns({"chunk_end": F.least(F.col("chunk_start") + size, "n_pages"), "chunk_name": F.format_string("chunk_%05d", "chunk_start")})


def resume(plan: DataFrame, cache: DataFrame, keys: tuple[str, ...] = ("doc", "chunk_start", "chunk_end")) -> tuple[DataFrame, DataFrame]:
    """(work, reused): planned chunks without and with a cached result. The whole range is the key, and so should be
    a hash of the options (a further key), or results of another chunk size would be taken for these."""
    done = cache.select(*keys).distinct()
    return plan.join(done, list(keys), "left_anti"), plan.join(done, list(keys), "left_semi")


def offset_pages(pages: DataFrame) -> DataFrame:
    """Page numbers in the chunk become page numbers in the document."""
    return pages.withColumn("page_index", F.col("page_index") + F.col("chunk_start"))


def merge_texts(chunks: DataFrame, key: str = "doc", text: str = "md") -> DataFrame:
    """key, text: the chunks' texts in order, a blank line between; missing ones are left out."""
    ordered = F.transform(F.array_sort(F.collect_list(F.when(F.col(text).isNotNull(), F.struct("chunk_start", text)))), lambda x: x[text])
    return chunks.groupBy(key).agg(F.array_join(ordered, "\n\n").alias(text))
