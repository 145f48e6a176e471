"""From raw documents to token ids: quality, near duplicates, benchmark leaks, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. Stages but the
last return the columns of ``documents``; what they decide is in the rows and texts they return.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oncolake.llm import byte_bpe, decontaminate, minhash, pii, quality
from oncolake.llm.shipping import small_batches
from oncolake.operators.staging import checkpoint_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. It learns from the labels of documents in ``docs``."""
    small_batches(spark)
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score_quality(docs, model, "__score")
    return scored.filter(F.col("__score") >= quality.THRESHOLD).drop("__score")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates: five words, 0.8."""
    small_batches(spark)
    return minhash.keep_one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    small_batches(spark)
    found = decontaminate.find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), name="__leaks")
    return found.filter(F.size("__leaks") == 0).drop("__leaks")


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by marks; ``n_chars`` follows where a text changed."""
    found = pii.find_pii(docs, pii.fit_pii(docs), name="__pii")
    clean = pii.redact(found, "__pii").withColumn(
        "n_chars", F.when(F.size("__pii") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    )
    # Where nothing was found the text stays as it came, null included.
    return clean.select(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id with the ids of its text, their number, and digests of ids and decoded bytes."""
    small_batches(spark)
    encoded = byte_bpe.encode_documents(docs.select("doc_id", "text"), *byte_bpe.multi_50k())
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [
    ("quality", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal data", pii_stage),
    ("tokens", token_stage),
]

#: No SQL: the stages hold trained models and tokenizers. Tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
