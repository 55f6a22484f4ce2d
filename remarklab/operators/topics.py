"""Topic models: corpus selection, LDA, assignment, description and sentiment of topics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from ..config import DEFAULTS, Settings
from ..functions.scores import argmax_topic, max_topic_prob, safe_divide
from ..schema import c
from ..session import cache_stage
from .features import TextVectors, fit_text_vectors
from .profile import distribution
from .rows import hash_sample, keyword_filter, min_tokens, top_k

CATEGORIES = ("Positive", "Neutral", "Negative")


def topic_corpus(
    df: DataFrame, settings: Settings = DEFAULTS, keywords=None, strip_punct: bool = False,
    fraction: float | None = None, key: str = "id",
) -> DataFrame:
    """Comments long enough, on the subject, and (for a fraction below 1) sampled by key hash."""
    rows = keyword_filter(
        min_tokens(df, settings.min_tokens), settings.keywords if keywords is None else keywords,
        strip_punct=strip_punct,
    )
    fraction = settings.topic_sample_fraction if fraction is None else fraction
    return hash_sample(rows, key, fraction, settings.seed, purpose="topics")


@dataclass(frozen=True)
class TopicModel:
    vectors: TextVectors
    lda: LDAModel

    @property
    def k(self) -> int:
        return self.lda.getK()

    def save(self, path: str) -> None:
        self.vectors.model.write().overwrite().save(f"{path}/vectors")
        self.lda.write().overwrite().save(f"{path}/lda")


def fit_lda(
    df: DataFrame, k: int = DEFAULTS.num_topics, max_iter: int = DEFAULTS.topic_iterations,
    seed: int = DEFAULTS.seed, vocab_size: int = DEFAULTS.topic_vocab_size,
    min_df: float = DEFAULTS.topic_min_df, tokens: str = "tokens_cleaned", weights: str = "tfidf",
) -> TopicModel:
    """LDA over TF-IDF vectors, or over raw counts with ``weights='counts'``.

    Tokens and sparse vectors are kept (memory, then disk) for the passes of the fits, not the text.
    """
    slim = cache_stage(df.select(c(tokens).alias("tokens_cleaned")))
    column = "features" if weights == "tfidf" else "raw_features"
    lda = LDA(featuresCol=column, topicDistributionCol="topic_distribution", k=k, maxIter=max_iter, seed=seed)
    training = None
    try:
        vectors = fit_text_vectors(slim, vocab_size, min_df)
        training = cache_stage(vectors.transform(slim).select(column))
        return TopicModel(vectors, lda.fit(training))
    finally:
        for kept in (training, slim):
            if kept is not None:
                kept.unpersist()


def topic_assign(model: TopicModel, df: DataFrame) -> DataFrame:
    """Adds the topic mixture (array), the dominant topic and its probability."""
    out = model.lda.transform(model.vectors.transform(df))
    out = out.withColumn("topic_distribution", vector_to_array("topic_distribution"))
    return out.drop("raw_features", "features").withColumns(
        {
            "dominant_topic": argmax_topic(F.col("topic_distribution")),
            "topic_probability": max_topic_prob(F.col("topic_distribution")),
        }
    )


def vocabulary_table(model: TopicModel, df: DataFrame) -> DataFrame:
    """(term_index, term): the vocabulary of a fitted model as rows."""
    words = model.vectors.vocabulary
    return df.sparkSession.createDataFrame([(i, w) for i, w in enumerate(words)], "term_index int, term string")


def topic_terms(model: TopicModel, df: DataFrame, n: int = DEFAULTS.terms_per_topic) -> DataFrame:
    """(topic, rank, term, weight): the n heaviest terms per topic, ranks from 1."""
    described = model.lda.describeTopics(maxTermsPerTopic=n)
    pairs = described.select(
        "topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("pos", "x")
    ).select(
        "topic", (F.col("pos") + 1).alias("rank"), F.col("x.termIndices").alias("term_index"),
        F.col("x.termWeights").alias("weight"),
    )
    # k x n rows; the vocabulary side is bounded by vocab_size
    return vocabulary_table(model, df).join(F.broadcast(pairs), "term_index").select("topic", "rank", "term", "weight")


def topic_quality(model: TopicModel, df: DataFrame) -> DataFrame:
    """(log_perplexity, log_likelihood) of a corpus under the model.

    Inference runs once: the log perplexity is the negative log likelihood per unit of token weight.
    """
    column = model.lda.getFeaturesCol()
    features = cache_stage(model.vectors.transform(df).select(column))
    try:
        likelihood = float(model.lda.logLikelihood(features))
        weight = F.aggregate(vector_to_array(column), F.lit(0.0), lambda a, x: a + x)
        total = features.agg(F.sum(weight).alias("w")).head()["w"] or 0.0
    finally:
        features.unpersist()
    row = (-likelihood / total if total else 0.0, likelihood)
    return df.sparkSession.createDataFrame([row], "log_perplexity double, log_likelihood double")


# --- topics as relations -----------------------------------------------------------------------


def topic_counts(df: DataFrame, topic: str = "dominant_topic") -> DataFrame:
    """Rows and percentage per dominant topic, by topic."""
    return distribution(df, topic).orderBy(c(topic))


def topic_sentiment(df: DataFrame, topic: str = "dominant_topic", category: str = "sentiment_label") -> DataFrame:
    return (
        df.groupBy(c(topic).alias(topic), c(category).alias(category))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(c(topic), c(category))
    )


def pivot_topic_sentiment(
    df: DataFrame, topic: str = "dominant_topic", category: str = "sentiment_label",
    categories: tuple[str, ...] = CATEGORIES, digits: int = 2,
) -> DataFrame:
    """Topic x category counts with zeros, and the row percentages over all categories."""
    counts = df.groupBy(c(topic).alias(topic)).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(c(category) == name).alias(name.lower()) for name in categories],
    )
    shares = {
        f"{name.lower()}_pct": F.round(safe_divide(c(name.lower()) * 100.0, F.col("total")), digits)
        for name in categories
    }
    return counts.withColumns(shares).orderBy(c(topic))


def topic_tendency(pivot: DataFrame, topic: str = "dominant_topic", digits: int = 2) -> DataFrame:
    """Leaning and polarization of each topic from the counts of ``pivot_topic_sentiment``."""
    pos = safe_divide(F.col("positive") * 100.0, F.col("total"))
    neg = safe_divide(F.col("negative") * 100.0, F.col("total"))
    leaning = (
        F.when(pos > neg + 10, "Positive-leaning").when(neg > pos + 10, "Negative-leaning").otherwise("Neutral")
    )
    gap = F.abs(pos - neg)
    level = F.when(gap > 20, "High").when(gap > 10, "Medium").otherwise("Low")
    return pivot.select(
        c(topic), "positive_pct", "neutral_pct", "negative_pct", leaning.alias("tendency"),
        F.round(gap, digits).alias("polarization"), level.alias("polarization_level"),
    )


def topic_avg_sentiment(
    df: DataFrame, topic: str = "dominant_topic", score: str = "sentiment", digits: int = 6
) -> DataFrame:
    """Mean score over the rows that have one, and size, per topic that has any."""
    return (
        df.groupBy(c(topic).alias(topic))
        .agg(
            F.round(F.avg(c(score)), digits).alias("avg_sentiment"),
            F.count(F.lit(1)).alias("topic_size"),
            F.count(c(score)).alias("scored"),
        )
        .filter(F.col("scored") > 0)
        .drop("scored")
        .orderBy(c(topic))
    )


def topic_similarity(terms: DataFrame, k: int, n: int = 10, digits: int = 6) -> DataFrame:
    """Cosine between topics over the smoothed TF-IDF of their first n terms: k x k rows.

    idf = ln((1 + k) / (1 + df)) + 1, with topics as documents. Terms as a text vectoriser would
    read them: runs of word characters of length two or more.
    """
    words = (
        terms.filter(F.col("rank") <= n)
        .select("topic", F.explode(F.regexp_extract_all("term", F.lit(r"((?U)\b\w\w+\b)"), 1)).alias("w"))
        .groupBy("topic", "w")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    # k x n rows in all from here on
    same_word, same_topic = Window.partitionBy("w"), Window.partitionBy("topic")
    x = F.col("tf") * (F.log(F.lit(1.0 + k) / (1 + F.count(F.lit(1)).over(same_word))) + 1)
    weights = words.withColumn("x", x)
    unit = weights.select("topic", "w", (F.col("x") / F.sqrt(F.sum(F.col("x") * F.col("x")).over(same_topic))).alias("x"))
    # every topic's words look for their weight in each other topic: an equi join on (topic, word)
    left = unit.select(
        F.col("topic").alias("topic_a"), "w", F.col("x").alias("xa"),
        F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("topic_b"),
    )
    right = unit.select(F.col("topic").alias("topic_b"), "w", F.col("x").alias("xb"))
    dot = F.sum(F.coalesce(F.col("xa") * F.col("xb"), F.lit(0.0)))
    return left.join(right, ["topic_b", "w"], "left").groupBy("topic_a", "topic_b").agg(
        F.round(dot, digits).alias("similarity")
    )


def topic_coherence(terms: DataFrame, top: int = 5, digits: int = 6) -> DataFrame:
    """1 / (population variance of the heaviest weights + 1e-6) per topic."""
    return (
        terms.filter(F.col("rank") <= top)
        .groupBy("topic")
        .agg(F.round(1 / (F.var_pop("weight") + 1e-6), digits).alias("coherence"))
    )


def topic_top5_weight(terms: DataFrame, sizes: DataFrame, topic: str = "dominant_topic", top: int = 5, digits: int = 6) -> DataFrame:
    """Mean of the heaviest weights of each topic beside its size (0 for an empty topic)."""
    means = (
        terms.filter(F.col("rank") <= top).groupBy("topic").agg(F.round(F.avg("weight"), digits).alias("avg_weight"))
    )
    size = sizes.select(c(topic).alias("topic"), F.col("n").alias("topic_size"))
    return means.join(size, "topic", "left").select(
        "topic", "avg_weight", F.coalesce("topic_size", F.lit(0).cast("bigint")).alias("topic_size")
    )


def topic_keywords(terms: DataFrame, n: int = 10) -> DataFrame:
    """(topic, keywords, weights): the first n terms of each topic in rank order."""
    packed = F.sort_array(F.collect_list(F.struct("rank", "term", "weight")))
    rows = terms.filter(F.col("rank") <= n).groupBy("topic").agg(packed.alias("x"))
    return rows.select(
        "topic",
        F.transform("x", lambda x: x["term"]).alias("keywords"),
        F.transform("x", lambda x: x["weight"]).alias("weights"),
    )


def describe_topics(stats: DataFrame, terms: DataFrame, topic: str = "dominant_topic", n: int = 3) -> DataFrame:
    """Per-topic statistics with the topic's first keywords; ``undefined`` where it has none."""
    words = topic_keywords(terms, n).select(F.col("topic").alias(topic), F.array_join("keywords", ", ").alias("keywords"))
    return stats.join(F.broadcast(words), topic, "left").withColumn("keywords", F.coalesce("keywords", F.lit("undefined")))


def topic_summary(terms: DataFrame, sizes: DataFrame, pivot: DataFrame | None = None, topic: str = "dominant_topic", n: int = 10) -> DataFrame:
    """One row per topic: keywords, weights, document count, sentiment percentages."""
    out = topic_keywords(terms, n).join(
        sizes.select(c(topic).alias("topic"), F.col("n").alias("document_count")), "topic", "left"
    ).withColumn("document_count", F.coalesce("document_count", F.lit(0).cast("bigint")))
    if pivot is None:
        return out
    shares = pivot.select(
        c(topic).alias("topic"),
        F.struct(
            F.col("positive_pct").alias("positive"), F.col("neutral_pct").alias("neutral"),
            F.col("negative_pct").alias("negative"),
        ).alias("sentiment_distribution"),
    )
    return out.join(shares, "topic", "left")


def largest_topics(sizes: DataFrame, n: int = 3, topic: str = "dominant_topic") -> DataFrame:
    return top_k(sizes, "n", n, topic)
