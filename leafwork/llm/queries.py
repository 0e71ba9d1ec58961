"""The queries of this subpackage, one for each operator, and the SQL to check them by."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwork.llm import common, fingerprints, jaccard, language, line_rules, mixing, oracles, pieces, quality, secrets, sharding, toxicity


def tokenizer_path() -> str:
    """Where the vocabulary lies: the setting leafwork.tokenizer.path, else the public package's file."""
    import public_tokenizers

    spark = SparkSession.getActiveSession()
    return (spark and spark.conf.get("leafwork.tokenizer.path", None)) or public_tokenizers.path("piece_bpe_32k.model")


def op1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.tokenize(docs, tokenizer_path(), with_ids=False).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def labelled(spark: SparkSession, sf_dir: str, label: str, folds: int, held: int) -> DataFrame:
    """doc_id, text and label of the training rows: those outside the held-out fold."""
    labels = common.one_label(common.table(spark, sf_dir, "labels").where(common.fold("doc_id", folds) != held), label)
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text").where(common.fold("doc_id", folds) != held)
    return docs.join(labels, "doc_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = toxicity.fit_toxicity(labelled(spark, sf_dir, "toxic", 3, 1))
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", (common.fold("doc_id", 3) == 1).alias("held_out"))
    return toxicity.score_toxicity(docs, model).select("doc_id", "held_out", "score", "predicted", "n_passages", "passages")


def op3_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.filter_by_lines(common.table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(common.table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = language.fit_language_filters(docs.where(common.fold("doc_id", 3) != 1).select("doc_id", "text", "lang"))
    rows = docs.select("doc_id", "text", (common.fold("doc_id", 3) == 1).alias("held_out"))
    return language.identify_language(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.scan_secrets(docs).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_spans")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = common.table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return sharding.shuffle_into_shards(docs, "doc_id", 24).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(common.table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_copies")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    network = quality.fit_quality(labelled(spark, sf_dir, "quality", 4, 2))
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", (common.fold("doc_id", 4) == 2).alias("held_out"))
    return quality.score_quality(docs, network).select("doc_id", "held_out", "score", "predicted")


QUERIES = {f.__name__: f for f in (op1_pieces, op2_toxicity, op3_line_rules, op4_mixing, op5_fingerprints, op6_language, op7_secrets, op8_sharding, op9_jaccard, op10_quality)}
ORACLE_SQL: dict[str, str] = {"op3_line_rules": oracles.LINE_RULES, "op9_jaccard": oracles.JACCARD}
