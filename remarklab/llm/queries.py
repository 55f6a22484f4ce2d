"""Registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from remarklab.llm import (
    byte_bpe, decontaminate, fingerprints, html_extract, language, lattice_lm, license_scan, merkle, native, pii, secret_scan,
    simhash, suffix_dedup, token_alignment)
from remarklab.llm.common import remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op3_byte_bpe(spark, sf_dir):
    """Encode every text and decode its ids again."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = byte_bpe.encode_documents(documents(spark, sf_dir), path, pattern, keep=["doc_id"])
    return byte_bpe.decode_documents(encoded, path, pattern).select(
        "doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op8_secret_scan(spark, sf_dir):
    """Secrets of every text: base kinds, and windows of high entropy."""
    found = secret_scan.scan_documents(documents(spark, sf_dir), keep=["doc_id"])
    of = lambda kind: F.filter("secrets", lambda s: s["kind"] == kind)
    base = F.filter("secrets", lambda s: s["kind"] != "entropy")
    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secret_scan.joined(base), 256).alias("base_sha256"),
        secret_scan.joined(F.col("secrets")).alias("spans"))


@query
def op6_simhash(spark, sf_dir):
    """SimHash fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=3, distance=3).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


@query
def op9_license_scan(spark, sf_dir):
    """License phrases and notices of every text."""
    found = license_scan.scan_documents(documents(spark, sf_dir), keep=["doc_id"])
    starts = F.transform("places", lambda p: p["start"].cast("bigint"))
    base = F.transform("places", lambda p: p["label"])
    more = F.transform(F.filter("notices", lambda n: n["best"]), lambda n: n["label"])
    listed = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        listed(base).alias("base_labels"), listed(F.concat(base, more)).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(
            F.coalesce(F.array_max(F.transform("notices", lambda n: n["containment"])), F.lit(0.0))).alias("score"))


@query
def op5_decontamination(spark, sf_dir):
    """Documents that hold benchmark items, with the share of the item's windows."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contaminated(documents(spark, sf_dir), benchmark).select(
        "doc_id", "item_id", "n_windows", "matched", "share", "reworded").distinct()


@query
def op2_language_id(spark, sf_dir):
    """Language of every text, learned from two thirds of the documents."""
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    counts = language.train(docs.where(remainder("doc_id", 3) != 1), "doc_id", "text", "lang")
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return language.identify(rows, counts, keep=["doc_id", "held_out"]).select(
        "doc_id", "held_out", "lang_pred", "score", "bits_per_byte", "fit")


@query
def op7_lattice_lm(spark, sf_dir):
    """Subword-lattice and word-count log probabilities of every text."""
    pieces = lattice_lm.load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    scored = lattice_lm.score_documents(documents(spark, sf_dir), pieces, remainder("doc_id", 10) != 0)
    held_out = F.coalesce(remainder("doc_id", 10) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op4_suffix_dedup(spark, sf_dir):
    """Repeated passages of 100 bytes in all texts: what is removed and what stays."""
    cleaned = suffix_dedup.remove_repeats(documents(spark, sf_dir), length=100)
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return cleaned.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                          F.sha2("kept", 256).alias("kept_sha256"))


@query
def op10_pii(spark, sf_dir):
    """Personal data in every text: base kinds, and candidates that the trees accept."""
    docs = documents(spark, sf_dir)
    found = pii.find_pii(docs.select("doc_id", "text"), pii.train(docs))
    base = F.filter("pii", lambda s: s["kind"].isin(*pii.BASE))

    def count(kind):
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in pii.BASE], F.sha2(native.joined(base), 256).alias("base_sha256"),
                        native.joined(F.col("pii")).alias("spans"))


@query
def op1_fingerprints(spark, sf_dir):
    """I-Match fingerprints of every text and its edited copy."""
    return fingerprints.near_copies(documents(spark, sf_dir))


@query
def op11_token_alignment(spark, sf_dir):
    """Groups and links between two tokenizers' tokens of every text, with the documents of the linked pairs."""
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    aligned = token_alignment.align_documents(
        documents(spark, sf_dir), a, b, public_tokenizers.PATTERN, keep=["doc_id"],
        groups=lambda written: F.when(written != "", F.sha2(written, 256)).otherwise(""))
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


@query
def op13_merkle_manifest(spark, sf_dir):
    """Digest tree over all documents, with every document's proof checked against a tampered or untouched leaf."""
    docs = documents(spark, sf_dir)
    around = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars")]
    tampered = F.when(remainder("doc_id", 3) == 0, merkle.leaf(*around, merkle.lower_ascii(F.col("text"))))
    leaves = docs.select("doc_id", "lang", merkle.leaf(*around, F.col("text")).alias("digest"), tampered.alias("tampered"))
    rows = merkle.manifest(leaves, "lang", "doc_id", "digest", keep=["doc_id", "tampered"])
    return rows.select(
        "doc_id", "leaf", "subroot", "root", merkle.digest(F.col("proof")).alias("proof_sha256"),
        merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


@query
def op12_html_extract(spark, sf_dir):
    """Main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = html_extract.extract_pages(pages, html_extract.train(spark), keep=["page_id", "url"])
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
