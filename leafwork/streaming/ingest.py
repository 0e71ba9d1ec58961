"""Incremental ingest: new text files become headings, once each. An extension; the batch plans do not need it.

One file is one row until it is exploded, so carrying page numbers forward needs no state across batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leafwork.functions.text import decode_lossy
from leafwork.operators.headings import headings_of_texts


def text_stream(spark: SparkSession, base: str, name: str = "text_docling.txt") -> DataFrame:
    """doc, text of the files below base, as a stream."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", name).load(base)
    return files.select(F.element_at(F.split("path", "/"), -2).alias("doc"), decode_lossy(F.col("content")).alias("text"))


def ingest_headings(spark: SparkSession, base: str, out: str, checkpoint: str) -> StreamingQuery:
    """Appends the headings of files not seen before to the Parquet table `out`, and ends when none are left."""

    def batch(df: DataFrame, epoch: int) -> None:
        headings_of_texts(df).withColumn("epoch", F.lit(epoch)).write.mode("append").parquet(out)

    return text_stream(spark, base).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
