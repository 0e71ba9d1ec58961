"""A training-data pipeline over `documents`: each stage is one operator, whose decisions take effect.

Stages: the quality classifier drops what it rejects; of each group of near copies one document stays; secrets are
masked; sources are mixed to target weights, which is the order of the rows and files; the last stage gives the
tokens. All but the last return the columns of `documents`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafwork.llm import common, jaccard, mixing, pieces, quality, secrets
from leafwork.llm.queries import tokenizer_path

MASK = "[secret]"
#: Near copies: sets of five-word shingles with a Jaccard similarity of 0.8 or more.
NEAR = jaccard.Bound(width=5, share=80, small=32)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones outside its held-out fold, predicts as good.

    A null text counts as empty. Columns of docs keep their values, whatever their names; repeated rows are rows of
    their own.
    """
    train = common.fold("doc_id", 4) != 2
    labels = common.one_label(common.table(spark, sf_dir, "labels").where(train), "quality")
    network = quality.fit_quality(docs.where(train).select("doc_id", "text").join(labels, "doc_id"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return quality.score_quality(docs.select(row, "text"), network).where("predicted = 1").select("row.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of near copies; of rows with one id in a group the one whose text
    has the smallest hash, of rows with one id and text the first by their columns. Texts without words are copies of
    nothing, so one row for each id and text stays. All rows without id stay."""
    found = jaccard.jaccard_join(docs.select("doc_id", "text"), bound=NEAR).where("doc_id is not null")
    own = F.coalesce("class_id", F.xxhash64("doc_id", "text_hash"))
    kept = found.groupBy("class_id", own.alias("_own")).agg(F.min(F.struct("doc_id", "text_hash")).alias("_k")).select("_k.*")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), row.alias("row"))
    first = F.row_number().over(Window.partitionBy("doc_id", "text_hash").orderBy("row"))
    rows = rows.where("doc_id is not null").join(kept, ["doc_id", "text_hash"], "left_semi").withColumn("_first", first).where("_first = 1")
    return rows.select("row.*").unionByName(docs.where("doc_id is null"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked and n_chars to match."""
    common.small_batches(spark)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    found = secrets.scan_secrets(docs.select(row, "text"), mask=MASK)
    changed = F.col("n_spans") > 0
    values = {"text": F.when(changed, F.col("masked")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        values["n_chars"] = F.when(changed, F.char_length("masked").cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("row.n_chars"))
    return found.select(*[values[c].alias(c) if c in values else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, ordered by the schedule: any stretch of rows has the sources in their weights' proportion.

    Repeated rows, null ids and columns of any name stay as they are; a null source is a source of its own.
    """
    return mixing.in_order(docs, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids_sha256, decoded_sha256 and the ids of each document."""
    common.small_batches(spark)
    return pieces.tokenize(docs.select("doc_id", "source", "text"), tokenizer_path()).select("doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_each),
    ("secret scans", mask_secrets),
    ("mixing sources", mix_sources),
    ("SentencePiece", tokenize),
]
#: SQL can express neither the network nor the merges; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each stage's result is written to the shared folder and read again.

    A result is deleted when the next one is written; the last one stays, as the returned rows are read from it.
    """
    folder = common.shared_folder(spark)
    docs, before = common.table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/pipeline-{uuid.uuid4().hex}-{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            common.delete(spark, before)
        before = path
    return docs
