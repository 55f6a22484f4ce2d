"""Term features: relational term frequencies and TF-IDF, and their MLlib vector forms."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IDF, CountVectorizerModel, HashingTF
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import DEFAULTS
from ..functions.text import term_counts_of
from ..schema import c, compute_once
from ..session import cache_stage
from .joins import lookup_join

# a vocabulary of up to this many terms is broadcast
VOCABULARY_BROADCAST = DEFAULTS.broadcast_rows


def term_frequency(df: DataFrame, tokens: str = "tokens_cleaned", key: str = "id") -> DataFrame:
    """(key, term, tf) in long form, counted inside each row: no shuffle."""
    return df.select(c(key), F.explode(term_counts_of(c(tokens))).alias("x")).select(c(key), "x.term", "x.tf")


def term_counts(df: DataFrame, tokens: str = "tokens_cleaned", by: list[str] = ()) -> DataFrame:
    """(by ..., term, corpus_count, doc_count), and a row with term NULL that counts the rows.

    Rows bring their terms in order, each beside the one before it, and one mark for themselves; these
    are combined on the map side before the only shuffle, so no term or group is hot. A term that differs
    from the one before it is new in its row.
    """
    keys, gap = [c(x) for x in by], F.array(F.lit(None).cast("string"))
    sorted_rows = compute_once(df.select(*keys, c(tokens).alias("__terms")), "__terms", F.coalesce(
        F.sort_array("__terms"), F.array().cast("array<string>")))
    beside = F.arrays_zip(F.concat(gap, "__terms").alias("before"), F.concat("__terms", gap).alias("term"))
    is_mark = F.col("__pos") == F.col("__last")
    return (
        sorted_rows.select(*keys, F.size("__terms").alias("__last"), F.posexplode(beside).alias("__pos", "x"))
        .select(*keys, "x.before", "x.term", is_mark.alias("__mark"))
        .filter(F.col("term").isNotNull() | F.col("__mark"))
        .groupBy(*keys, "term")
        .agg(F.count("term").alias("corpus_count"), F.count_if(F.col("__mark") | ~F.col("term").eqNullSafe(F.col("before"))).alias("doc_count"))
    )


def top_terms(counts: DataFrame, vocab_size: int, min_df: float) -> DataFrame:
    """The most frequent terms of at least min_df rows, and the row with term NULL, which leads.

    At most ``vocab_size`` + 1 rows. A ``min_df`` below 1 is a share of all rows.
    """
    is_mark = F.col("term").isNull()
    bound = F.lit(float(min_df))
    if min_df < 1:
        bound = counts.agg(F.max(F.when(is_mark, F.col("doc_count")))).scalar() * float(min_df)
    kept = counts.filter(is_mark | (F.col("doc_count") >= bound))
    return kept.orderBy(is_mark.desc(), F.col("corpus_count").desc(), "term").limit(vocab_size + 1)


def vocabulary(
    df: DataFrame, vocab_size: int = 3000, min_df: float = 1.0, tokens: str = "tokens_cleaned"
) -> DataFrame:
    """(term, corpus_count, doc_count, idf): the most frequent terms of at least min_df rows.

    Ties go to the alphabetically first term. idf = ln((m + 1) / (doc_count + 1)) for m rows; m
    comes along with the terms, so the corpus is read once.
    """
    top = top_terms(term_counts(df, tokens), vocab_size, min_df)
    # a window over the vocab_size + 1 rows of the limit
    m = F.max(F.when(F.col("term").isNull(), F.col("doc_count"))).over(Window.partitionBy())
    idf = F.log((F.col("__m") + 1).cast("double") / (F.col("doc_count") + 1))
    return top.withColumn("__m", m).filter(F.col("term").isNotNull()).withColumn("idf", idf).drop("__m")


def tfidf(
    df: DataFrame, vocab_size: int = 3000, min_df: float = 1.0, tokens: str = "tokens_cleaned", key: str = "id",
) -> DataFrame:
    """(key, term, tf, tfidf) over the vocabulary, in long form.

    Terms are counted inside their row and meet the vocabulary in a broadcast join, so only the
    vocabulary itself needs a shuffle. It is broadcast if its rows and bytes are few enough, which is
    looked up first, on the stored vocabulary; a larger one is joined by a salted shuffle.
    """
    terms = cache_stage(vocabulary(df, vocab_size, min_df, tokens).select("term", "idf"), durable=True)
    return (
        lookup_join(term_frequency(df, tokens, key), terms, "term", max_rows=VOCABULARY_BROADCAST, salt_on=[key])
        .select(c(key), "term", "tf", (F.col("tf") * F.col("idf")).alias("tfidf"))
    )


@dataclass(frozen=True)
class TextVectors:
    """Fitted bag-of-words and IDF stages."""

    model: PipelineModel

    @property
    def vocabulary(self) -> list[str]:
        return self.model.stages[0].vocabulary

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)


def fit_count_vectors(
    df: DataFrame, vocab_size: int, min_df: float, tokens: str = "tokens_cleaned", out: str = "raw_features",
) -> CountVectorizerModel:
    """Bag-of-words vectors over ``vocabulary``.

    The fit of CountVectorizer leaves the order of equally frequent terms open, so that seeds
    would not reproduce a model; the vocabulary here is ordered by count and term. An empty one
    is refused rather than left to a later fit.
    """
    # at most vocab_size terms, which the model holds on the driver in any case
    top = vocabulary(df, max(int(vocab_size), 1), min_df, tokens).select("term", "corpus_count").collect()
    words = [r["term"] for r in sorted(top, key=lambda r: (-r["corpus_count"], r["term"]))]
    if not words:
        raise ValueError(f"no term occurs in at least {min_df} rows: lower min_df")
    return CountVectorizerModel.from_vocabulary(words, inputCol=tokens, outputCol=out)


def fit_text_vectors(
    df: DataFrame, vocab_size: int, min_df: float, tokens: str = "tokens_cleaned",
    counts: str = "raw_features", out: str = "features",
) -> TextVectors:
    """Bag-of-words and IDF stages, fitted on the rows."""
    bag = fit_count_vectors(df, vocab_size, min_df, tokens, counts)
    idf = IDF(inputCol=counts, outputCol=out).fit(bag.transform(df))
    return TextVectors(PipelineModel(stages=[bag, idf]))


def hashing_tfidf(
    df: DataFrame, num_features: int = 20000, tokens: str = "tokens_cleaned", out: str = "features"
) -> DataFrame:
    """Hashed term counts weighted by IDF; needs no vocabulary."""
    hashed = HashingTF(inputCol=tokens, outputCol="raw_features", numFeatures=num_features).transform(df)
    return IDF(inputCol="raw_features", outputCol=out).fit(hashed).transform(hashed)


def term_bucket(term: Column, buckets: int) -> Column:
    """Bucket of a term: the first 32 bits of its md5, modulo the number of buckets."""
    return F.conv(F.substring(F.md5(term.cast("binary")), 1, 8), 16, 10).cast("bigint") % buckets


def bucket_frequency(df: DataFrame, buckets: int = 20000, tokens: str = "tokens_cleaned", key: str = "id") -> DataFrame:
    """(key, bucket, tf) in long form: tokens counted by bucket inside each row, so terms that share one add up."""
    names = F.transform(c(tokens), lambda t: term_bucket(t, buckets).cast("string"))
    return df.select(c(key), F.explode(term_counts_of(names)).alias("x")).select(
        c(key), F.col("x.term").cast("bigint").alias("bucket"), F.col("x.tf").alias("tf"))


def bucket_tfidf(df: DataFrame, buckets: int = 20000, tokens: str = "tokens_cleaned", key: str = "id") -> DataFrame:
    """(key, bucket, tf, tfidf): hashed term frequencies and their weights, the relational form of ``hashing_tfidf``.

    A bucket's document frequency counts the rows with any of its terms; idf = ln((m + 1) / (that + 1)) for
    m rows. There are at most ``buckets`` of them, which is checked before they are broadcast.
    """
    counts = bucket_frequency(df, buckets, tokens, key)
    per_bucket = counts.groupBy("bucket").agg(F.count(F.lit(1)).alias("doc_count"))
    m = df.agg(F.count(F.lit(1)).alias("m")).scalar()
    idf = F.log((m + 1).cast("double") / (F.col("doc_count") + 1))
    weights = cache_stage(per_bucket.withColumn("idf", idf).select("bucket", "idf"), durable=True)
    return lookup_join(counts, weights, "bucket", max_rows=VOCABULARY_BROADCAST, salt_on=[key]).select(
        c(key), "bucket", "tf", (F.col("tf") * F.col("idf")).alias("tfidf"))
