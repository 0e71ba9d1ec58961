"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafwork.sources.shared import cut, shared_folder


ROWS_PER_BATCH, BYTES_PER_BATCH = 1024, 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ROWS_PER_BATCH rows and about BYTES_PER_BATCH bytes in this session: rows here are
    whole texts, and ten thousand of them take too much of an executor's memory. Smaller settings stay."""
    for name, most in (("maxRecordsPerBatch", ROWS_PER_BATCH), ("maxBytesPerBatch", BYTES_PER_BATCH)):
        name = f"spark.sql.execution.arrow.{name}"
        if not 0 < int(spark.conf.get(name).removesuffix("b")) <= most:
            spark.conf.set(name, str(most))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, read by Spark so that any file system works."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder on whatever file system it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished steps now: its cleaner acts when the driver collects garbage,
    which may be long after what those steps made has been cut off."""
    gc.collect()
    spark._jvm.System.gc()


def cut_small(df: DataFrame, rows_per_part: int = 100_000) -> DataFrame:
    """cut(df), then in as few partitions as its number of rows asks for: small tables make few files when shuffled."""
    df = cut(df)
    return df.coalesce(1 + df.count() // rows_per_part)


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo folds; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(folds)).cast("int")


def unit_hash(*cols: str | Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the columns and the seed only."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11) / F.lit(float(1 << 53))


def bounded_sample(df: DataFrame, by: str, most: int | dict, seed: int, max_chars: int) -> tuple[DataFrame, dict]:
    """At most `most` rows of each value of `by` (or of those that a dict names): every row where there are fewer,
    else those with the smallest hashes. Also how many rows of each value there are.

    Rows whose text is null or longer than max_chars code points are not taken: what is collected has a bound
    of most * max_chars for each value. The choice depends on doc_id, the text and the seed, not on the partitioning;
    rows of one doc_id (or without any) pass the hash together, so where they are many the sample can be smaller.
    """
    df = df.where(F.col("text").isNotNull() & (F.char_length("text") <= max_chars) & F.col(by).isNotNull())
    totals = {r[by]: r["_n"] for r in df.groupBy(by).agg(F.count("*").alias("_n")).collect()}
    limits = [(v, min(1.0, 1.2 * m / n + 30 / n), m) for v, n in totals.items() if (m := most.get(v, 0) if isinstance(most, dict) else most)]
    kind = df.schema[by].dataType.simpleString()
    of_values = df.sparkSession.createDataFrame(limits, f"`{by}` {kind}, _share double, _most int")
    # A threshold on the hash of doc_id takes a few rows too many where they are read, before anything is shuffled; the
    # limit is exact.
    h = unit_hash("doc_id", seed=seed)
    df = df.where(h < F.lit(max((share for _, share, _ in limits), default=0.0)))
    few = F.broadcast(of_values) if len(limits) <= 1_000_000 else of_values
    rank = F.row_number().over(Window.partitionBy(by).orderBy("_hash", F.xxhash64("text")))
    taken = df.join(few, by).withColumn("_hash", h).where("_hash < _share").withColumn("_rank", rank)
    return taken.where("_rank <= _most").select(*df.columns), totals


def one_label(labels: DataFrame, label: str, key: str = "doc_id") -> DataFrame:
    """key and label, once for each key; keys whose labels contradict each other are left out."""
    each = labels.where(F.col(label).isin(0, 1)).groupBy(key).agg(F.min(label).alias(label), F.max(label).alias("_most"))
    return each.where(F.col(label) == F.col("_most")).select(key, label)
