"""Word frequencies and languages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.stopwords import default_stopwords
from ..functions.text import bind, keep_words, strip_punctuation
from ..schema import c, compute_once
from .rows import top_k, top_k_per_group


def word_counts(df: DataFrame, tokens: str = "tokens_cleaned") -> DataFrame:
    """(token, n) over all rows; counted on the map side before the shuffle."""
    return df.select(F.explode(c(tokens)).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def word_frequency(df: DataFrame, top_n: int = 50, tokens: str = "tokens_cleaned") -> DataFrame:
    return top_k(word_counts(df, tokens), "n", top_n, "token")


def word_frequency_by(
    df: DataFrame, label: str = "sentiment_category", top_n: int = 30, tokens: str = "tokens_cleaned",
    labels: tuple[str, ...] | None = ("Positive", "Negative"), name: str | None = None,
) -> DataFrame:
    """Most frequent words within every label, with rank; ranks only pre-aggregated counts."""
    rows = df if labels is None else df.filter(c(label).isin(list(labels)))
    name = name or label
    counts = (
        rows.select(c(label).alias(name), F.explode(c(tokens)).alias("token"))
        .groupBy(name, "token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return top_k_per_group(counts, name, "n", "token", top_n)


def raw_word_frequency(df: DataFrame, top_n: int = 100, col: str = "body") -> DataFrame:
    """Frequent words of uncleaned text: split at white space, keep letters and digits."""
    word = F.regexp_replace("word", r"\P{Alnum}+", "")
    counts = (
        df.select(F.explode(F.split(F.lower(c(col)), r"\s+")).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("word", word)
        .filter(F.col("word") != "")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )
    return top_k(counts, "n", top_n, "word")


# Language code to Spark's stop-word list name.
LANGUAGE_LISTS = {"de": "german", "en": "english", "es": "spanish", "fr": "french"}


def detect_language(col: Column, profiles: dict[str, tuple[str, ...]] | None = None) -> Column:
    """Language whose stop words occur most often in a text; no hit gives NULL.

    Equal counts go to the alphabetically first language. The word lists are hash sets inside
    the expression, so the text never leaves its row.
    """
    profiles = profiles or {code: default_stopwords(name) for code, name in LANGUAGE_LISTS.items()}
    tokens = strip_punctuation(F.split(F.lower(col), r"\s+"))

    def best(ts: Column) -> Column:
        hits = F.array(
            *[
                F.struct(F.size(keep_words(ts, words)).alias("hits"), F.lit(code).alias("code"))
                for code, words in sorted(profiles.items(), reverse=True)
            ]
        )
        return bind(hits, lambda h: F.reduce(h, F.get(h, F.lit(0)), lambda a, x: F.when(x["hits"] >= a["hits"], x).otherwise(a)))

    return bind(tokens, lambda ts: bind(best(ts), lambda b: F.when(b["hits"] > 0, b["code"])))


def add_language(df: DataFrame, col: str = "body", out: str = "language") -> DataFrame:
    return compute_once(df, out, detect_language(c(col)))


def language_distribution(df: DataFrame, col: str = "language") -> DataFrame:
    out = df.groupBy(c(col).alias("language")).agg(F.count(F.lit(1)).alias("n"))
    return out.orderBy(F.col("n").desc(), "language")
