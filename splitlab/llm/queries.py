"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from splitlab.llm import bpe, decontaminate, html, jaccard, merkle, mix, negatives, pii, quality, secrets, suffix, vptree, windows
from splitlab.llm import oracles

VOCABULARY = "byte_bpe_50k.json"
#: A document is predicted good from this score on.
GOOD_FROM = 0.3
NEIGHBOURS, PRUNING = 20, 2.0


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def of_kind(spans: str, kind: int) -> Column:
    """How many of ``spans`` are of a kind. (A second argument of the lambda would be an element's place.)"""
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("bigint")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents hold, one row per document and item."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that a document shares with one of a smaller id."""
    return windows.repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    scored = quality.with_scores(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [of_kind("secrets", k).alias(f"n_{secrets.KINDS[k]}") for k in range(3)]
    base = secrets.listed(F.filter("secrets", lambda x: x["kind"] < 3))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), secrets.listed("secrets").alias("spans"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.spans(read(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + x["end"] - x["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [of_kind("personal", k).alias(f"n_{pii.KINDS[k]}") for k in range(4)]
    base = secrets.listed(F.filter("personal", lambda x: x["kind"] < 4), pii.KINDS)
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), secrets.listed("personal", pii.KINDS).alias("spans"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(read(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary_path(), keep_ids=False).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"
    )


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return vptree.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=NEIGHBOURS, factor=PRUNING)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return merkle.manifest(read(spark, sf_dir, "documents").select(*merkle.FIELDS), tampered)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(read(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label=label)


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mixed(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_decontamination, op2_substring_dedup, op3_html_extraction, op4_quality, op5_secrets, op6_ngram_jaccard, op7_suffix_array, op8_pii, op9_bpe, op10_nearest,
              op11_merkle, op12_hard_negatives, op13_mixing)
}
ORACLES: dict[str, str] = {"op11_merkle": oracles.merkle(), "op12_hard_negatives": oracles.HARD_NEGATIVES, "op13_mixing": oracles.MIXING}
