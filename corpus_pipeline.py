"""The corpus pipeline, from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and all that its predecessor kept; its
result is written as Parquet and read again. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.llm import bpe, chunks, crf, forest, templates
from cadence.llm.common import in_fold, saved, table, workdir
from cadence.llm.queries import VOCABULARY


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line CRF does not reject."""
    held_out = in_fold(F.col("doc_id"), 5, 0)
    judged = crf.classify(docs, table(spark, sf_dir, "labels"), ~held_out)
    return judged.where("predicted = 1").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages stay in their first place only; a document of which
    nothing is left goes, and n_chars follows the text."""
    clean = chunks.dedup_passages(docs).where("n_removed = 0 or trim(text) <> ''").select(docs.columns)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return clean


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates (similarity 0.8)."""
    return forest.without_near_duplicates(docs, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item, as it is or re-parameterised."""
    return templates.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of their decoding."""
    return bpe.digests(docs, VOCABULARY, with_ids=True, without=("text", "n_chars"))


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("bpe_tokens", tokenize),
]

#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), workdir(spark)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
