"""Declared input schemas and safe access to column names that contain a dot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

COMMENT_SCHEMA = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("subreddit.id", T.StringType()),
        T.StructField("subreddit.name", T.StringType()),
        T.StructField("subreddit.nsfw", T.BooleanType()),
        T.StructField("created_utc", T.LongType()),
        T.StructField("permalink", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("sentiment", T.DoubleType()),
        T.StructField("score", T.IntegerType()),
    ]
)

CLEANED_COLUMNS = (
    "id", "subreddit.name", "created_utc", "timestamp", "body",
    "cleaned_body", "tokens_cleaned", "sentiment", "score",
)
SENTIMENT_COLUMNS = (*CLEANED_COLUMNS, "vader_sentiment", "sentiment_category")
TOPIC_COLUMNS = (
    "id", "subreddit.name", "timestamp", "cleaned_body", "tokens_cleaned", "sentiment",
    "vader_sentiment", "sentiment_category", "sentiment_label",
    "dominant_topic", "topic_probability",
)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def c(name: str) -> Column:
    """Column by its exact name, dots included."""
    return F.col(quoted(name))


def select_existing(df: DataFrame, columns) -> DataFrame:
    """Project the listed columns that exist, in the listed order."""
    present = set(df.columns)
    return df.select(*[c(name) for name in columns if name in present])


def compute_once(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Add a costly column that later filters and projections must not evaluate again.

    The optimizer pushes filters through a plain projection by copying its expressions into
    them, even below an exchange. A generator of one element is a border that it leaves alone.
    """
    kept = [c(x) for x in df.columns if x != name]
    return df.select(*kept, F.explode_outer(F.array(expr)).alias(name))


def missing_columns(df: DataFrame, columns) -> list[str]:
    present = set(df.columns)
    return [name for name in columns if name not in present]
