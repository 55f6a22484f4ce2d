"""From raw documents to token ids: five stages, each on what the stage before kept.

    language          documents in no learned language go; a missing language is filled in
    near_duplicates   of each group of near copies the document of smallest id stays
    decontamination   documents that hold a benchmark item go
    secrets           secrets are masked in the text
    byte_bpe          texts become token ids, which decode to the same bytes
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from remarklab.llm import byte_bpe, decontaminate, language, secret_scan, simhash
from remarklab.llm.common import free_name, remainder
from remarklab.session import checkpoint_dir

RANKS, PATTERN = "byte_bpe_50k.tiktoken", public_tokenizers.PATTERN
# shingle length and largest bit distance of the near-duplicate stage
SHINGLE, DISTANCE = 3, 3


def set_aside(docs: DataFrame, *names: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with its columns of these names renamed, and the columns that bring its own back."""
    renamed = {}
    for c in docs.columns:
        if c.lower() in names:
            renamed[c] = free_name([*docs.columns, *renamed.values()], f"__own_{c}")
    return docs.withColumnsRenamed(renamed), [F.col(f"`{renamed.get(c, c)}`").alias(c) for c in docs.columns]


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that are in no learned language; fill a NULL ``lang`` with the prediction.

    Languages are learned from labelled documents, as the operator's query does. Without labels
    nothing is dropped, nor is a document whose own label was not learned.
    """
    counts = language.train(docs.where(remainder("doc_id", 3) != 1), "doc_id", "text", "lang")
    free, own = set_aside(docs, "lang_pred", "score", "bits_per_byte", "fit")
    found = language.identify(free, counts)
    unlearned = F.coalesce(~F.col("lang").cast("string").isin(list(counts)), F.lit(False))
    kept = found.where(unlearned | ~language.reject(F.col("lang_pred"), F.col("fit"), counts))
    filled = F.coalesce("lang", F.when(F.col("lang_pred") != language.UNKNOWN, F.col("lang_pred")))
    return kept.withColumn("lang", filled).select(*own)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the smallest id."""
    return simhash.keep_one(docs, "doc_id", "text", SHINGLE, DISTANCE)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold an item of the benchmark table."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, decontaminate.contaminated(docs, benchmark))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets by a mask; ``n_chars`` follows the text."""
    free, own = set_aside(docs, "secrets")
    masked = secret_scan.redact(secret_scan.scan_documents(free))
    changed = F.when(F.size("secrets") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", changed).select(*own)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (packed, little-endian unsigned 32-bit) of every text, and digests of the ids and of what they decode to."""
    path = public_tokenizers.path(RANKS)
    encoded = byte_bpe.encode_documents(docs, path, PATTERN, keep=["doc_id", "lang", "source", "n_chars"])
    decoded = byte_bpe.decode_documents(encoded, path, PATTERN)
    return decoded.select("doc_id", "lang", "source", "n_chars", "n_tokens", "token_ids",
                          F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("secrets", mask_secrets),
    ("byte_bpe", tokenize),
]

# language models, components and merges are beyond SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents table; each stage's rows are written to the shared folder and read again."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
