"""A training-corpus pipeline over the documents table, built from the operators of splitlab.llm.

Stages: low quality goes, one document of each near-duplicate group stays, documents that hold
benchmark items go, secrets are masked, texts become token ids. Each stage's result is written as
Parquet and read again. All stages keep the columns of documents but the last, which has ids for
the text. NULL and empty texts pass every filter that has no evidence against them: they hold no
benchmark item or secret, belong to no group, and score the prior of the quality labels.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splitlab.llm import bpe, decontaminate, jaccard, quality, secrets
from splitlab.llm.queries import GOOD_FROM, read, vocabulary_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose compression score predicts label 1."""
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    scored = quality.with_scores(docs, model, score_column="__score")
    return scored.where(F.col("__score") >= GOOD_FROM).select(*(f"`{c}`" for c in docs.columns))


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shingle similarity, the one with the least doc_id; repeated rows once."""
    found = jaccard.similar(docs)
    stay = found.where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(stay, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.union(docs.where("doc_id is null")).select(*(f"`{c}`" for c in docs.columns))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage holds question and answer of a benchmark item."""
    found = decontaminate.contamination(docs, read(spark, sf_dir, "benchmark"))
    return found.where(F.size("hits") == 0).select(*(f"`{c}`" for c in docs.columns))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked; n_chars follows the text."""
    out = secrets.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids for the text."""
    return bpe.encode(docs, vocabulary_path())


STAGES = [
    ("quality_classifier", good_quality),
    ("ngram_jaccard_join", one_per_group),
    ("benchmark_decontamination", without_benchmark),
    ("secret_scans", without_secrets),
    ("bpe_encoding", tokens),
]
ORACLE_SQL = None  # compression scores and BPE have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written below the cluster's shared folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{shared.rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
