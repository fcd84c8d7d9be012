"""The corpus pipeline: stages applied in order to ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next stage's docs. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import decontaminate, language_id, packing, secret_scan, simhash_dedup
from shelfwise.llm.common import stage, table
from shelfwise.llm.queries import TOKENIZER, WORD_LIST


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents whose language is rejected go, the rest stay
    unchanged. Trained on the labelled documents of the stage's input."""
    model = language_id.fit(docs)
    return docs.where(language_id.predict(F.col("text"), model)["accepted"])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: one document of each near-duplicate group stays."""
    return simhash_dedup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: secrets are masked; n_chars follows the text."""
    masked = docs.withColumn("text", secret_scan.redacted(F.col("text"), WORD_LIST))
    return masked.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: every token of every document that is left, in sequences."""
    return packing.pack_documents(docs, *TOKENIZER)


STAGES = [("language_id", identify_language), ("simhash_dedup", drop_near_duplicates), ("decontaminate", drop_contaminated),
          ("secret_scan", mask_secrets), ("packing", pack_sequences)]

#: the language model, the fingerprints, the guess costs and the tokenizer are beyond SQL; tests check each stage by brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
