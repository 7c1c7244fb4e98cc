"""Corpus preparation: stages over documents, each reading what the one before kept.

Every stage takes and returns the columns of documents; the last returns the
pieces of packed sequences. What a stage finds takes effect: rejected, repeated
and contaminated documents go, secrets are replaced in the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalogloom.llm import decontaminate, language, near_dedup, packing, secrets
from catalogloom.llm.shared import kept


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told clearly; ``und`` and ambiguous ones go."""
    found = language.predict(docs, language.train(docs))
    return found.where((F.col("lang_pred") != language.UNKNOWN) & ~F.col("ambiguous")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates; rows that repeat an id count once, rows without id stay."""
    chosen = near_dedup.near_duplicates(docs).where(F.col("kept") & F.col("doc_id").isNotNull())
    same = Window.partitionBy("doc_id").orderBy("text")
    single = docs.join(chosen.select("doc_id").distinct(), "doc_id", "left_semi").withColumn(
        "__no", F.row_number().over(same)).where("__no = 1")
    return single.select(*docs.columns).union(docs.where("doc_id is null"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.contamination(docs, items).where("n_hit = 0").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark; lengths follow."""
    found = secrets.scan(docs, carry=docs.columns)
    text = secrets.redacted(F.col("text"), F.col("spans"))
    return found.withColumn("text", text).withColumn("n_chars", F.when(
        F.size("spans") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", identify_language),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", decontaminated),
    ("secrets", redact_secrets),
    ("packing", pack_windows),
]

#: Language models, near-duplicate trees and token ids have no SQL; tests hold the run against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
