"""Descriptive statistics of a comment table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scores import bucketize_length, bucketize_score, safe_divide
from ..functions.times import year_month, year_of
from ..schema import c


def share(part: Column, total: Column, digits: int = 2) -> Column:
    return F.round(safe_divide(part * 100.0, total), digits)


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, with the row and column counts of the table."""
    columns = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"), F.lit(name).alias("column_name"),
                F.lit(kind).alias("data_type"),
            )
            for i, (name, kind) in enumerate(df.dtypes)
        ]
    )
    return (
        df.agg(F.count(F.lit(1)).alias("row_count"))
        .select("row_count", F.lit(len(df.columns)).alias("column_count"), F.explode(columns).alias("x"))
        .select("x.position", "x.column_name", "x.data_type", "row_count", "column_count")
    )


def completeness(df: DataFrame) -> DataFrame:
    """Per column: non-null count, null count, percentage complete. One pass for all columns."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count(c(name)).alias(f"__c{i}") for i, name in enumerate(df.columns)],
    )
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("column_name"), F.col(f"__c{i}").alias("non_null"))
            for i, name in enumerate(df.columns)
        ]
    )
    return counts.select("__n", F.explode(rows).alias("x")).select(
        "x.column_name",
        "x.non_null",
        (F.col("__n") - F.col("x.non_null")).alias("nulls"),
        share(F.col("x.non_null"), F.col("__n")).alias("pct_complete"),
    )


def describe(df: DataFrame, columns: dict[str, Column] | list[str], digits: int = 6) -> DataFrame:
    """Per column: count, mean, sample standard deviation, minimum, maximum; one pass."""
    if not isinstance(columns, dict):
        columns = {name: c(name) for name in columns}
    aggs = []
    for i, value in enumerate(columns.values()):
        v = value.cast("double")
        aggs += [
            F.struct(
                F.count(v).alias("n"),
                F.round(F.avg(v), digits).alias("mean"),
                F.round(F.stddev_samp(v), digits).alias("stddev"),
                F.min(v).alias("min"),
                F.max(v).alias("max"),
            ).alias(f"__s{i}")
        ]
    rows = F.array(
        *[F.struct(F.lit(name).alias("column_name"), F.col(f"__s{i}").alias("s")) for i, name in enumerate(columns)]
    )
    return df.agg(*aggs).select(F.explode(rows).alias("x")).select("x.column_name", "x.s.*")


def time_range(df: DataFrame, col: str = "timestamp") -> DataFrame:
    return df.agg(F.min(c(col)).alias("earliest"), F.max(c(col)).alias("latest"))


def count_by(df: DataFrame, key: str | Column, name: str | None = None) -> DataFrame:
    """Rows per key, most frequent first, ties by key."""
    column = c(key) if isinstance(key, str) else key
    name = name or (key if isinstance(key, str) else "key")
    out = df.groupBy(column.alias(name)).agg(F.count(F.lit(1)).alias("n"))
    return out.orderBy(F.col("n").desc(), c(name))


def count_by_year(df: DataFrame, col: str = "timestamp") -> DataFrame:
    return df.groupBy(year_of(c(col)).alias("year")).agg(F.count(F.lit(1)).alias("n")).orderBy("year")


def score_bucket_counts(df: DataFrame, col: str = "sentiment", rule: str = "raw") -> DataFrame:
    return count_by(df, bucketize_score(c(col), rule), "sentiment_range")


def length_bucket_counts(df: DataFrame, col: str = "body") -> DataFrame:
    return count_by(df, bucketize_length(F.length(c(col))), "length_range")


def with_share(counts: DataFrame, n: str = "n", digits: int = 2, few_groups: bool = True) -> DataFrame:
    """Adds each row's percentage of the total of an aggregated frame.

    ``few_groups`` says that the key is a class column, whose counts one task may add up; else
    the total is a scalar subquery.
    """
    if few_groups:
        total = F.sum(c(n)).over(Window.partitionBy())
    else:
        total = counts.agg(F.sum(c(n)).alias("t")).scalar()
    return counts.withColumn("percentage", share(c(n), total, digits))


def distribution(df: DataFrame, key: str, few_groups: bool = True) -> DataFrame:
    counts = df.groupBy(c(key).alias(key)).agg(F.count(F.lit(1)).alias("n"))
    return with_share(counts, few_groups=few_groups).orderBy(F.col("n").desc(), c(key))


def average_length(df: DataFrame, col: str = "body", digits: int = 6) -> DataFrame:
    return df.agg(F.round(F.avg(F.length(c(col))), digits).alias("average_length"))


def distinct_users(df: DataFrame, col: str, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Number of distinct authors, exact or by a mergeable sketch."""
    agg = F.approx_count_distinct(c(col), rsd) if approx else F.count_distinct(c(col))
    return df.agg(agg.alias("distinct_users"))


def key_stats(df: DataFrame, digits: int = 6) -> DataFrame:
    """One row of key figures of a cleaned corpus."""
    return df.agg(
        F.min("created_utc").alias("earliest"),
        F.max("created_utc").alias("latest"),
        F.round(F.avg("sentiment"), digits).alias("avg_sentiment"),
        F.round(F.avg(F.size("tokens_cleaned")), digits).alias("avg_tokens"),
        F.round(F.avg(F.length("cleaned_body")), digits).alias("avg_length"),
    )


def _category_counts(category: str) -> list[Column]:
    return [
        F.count_if(c(category) == label).alias(f"{label.lower()}_count")
        for label in ("Positive", "Negative", "Neutral")
    ]


def group_sentiment(
    df: DataFrame, key: str, score: str = "vader_sentiment", category: str = "sentiment_category",
    min_n: int = 1000, name: str | None = None, digits: int = 6,
) -> DataFrame:
    """Per group of at least ``min_n`` rows: size, mean score, rows per category."""
    out = df.groupBy(c(key).alias(name or key)).agg(
        F.count(F.lit(1)).alias("comment_count"),
        F.round(F.avg(c(score)), digits).alias("avg_sentiment"),
        *_category_counts(category),
    )
    return out.filter(F.col("comment_count") >= min_n).orderBy(
        F.col("comment_count").desc(), c(name or key)
    )


def monthly_sentiment(
    df: DataFrame, score: str = "vader_sentiment", category: str = "sentiment_category",
    time: str = "timestamp", digits: int = 6,
) -> DataFrame:
    counts = _category_counts(category)[:2]
    return (
        df.groupBy(year_month(c(time)).alias("year_month"))
        .agg(
            F.count(F.lit(1)).alias("comment_count"),
            F.round(F.avg(c(score)), digits).alias("avg_sentiment"),
            *counts,
        )
        .orderBy("year_month")
    )


def yearly_sentiment(
    df: DataFrame, score: str = "vader_sentiment", category: str = "sentiment_category",
    time: str = "timestamp", digits: int = 6,
) -> DataFrame:
    out = df.groupBy(year_of(c(time)).alias("year")).agg(
        F.count(F.lit(1)).alias("total_comments"),
        F.round(F.avg(c(score)), digits).alias("avg_sentiment"),
        *_category_counts(category),
    )
    for label in ("positive", "negative", "neutral"):
        ratio = safe_divide(F.col(f"{label}_count"), F.col("total_comments"))
        out = out.withColumn(f"{label}_ratio", F.round(ratio, digits))
    return out.orderBy("year")


def extremes(stats: DataFrame, key: str, score: str = "avg_sentiment", size: str = "total_comments") -> DataFrame:
    """Most positive, most negative and busiest key of an aggregated frame; ties: smallest key.

    One aggregate: the smallest of (measure, key) structs, so partial results combine.
    """
    k = c(key).cast("string")

    def first(measure: Column) -> Column:
        return F.min(F.when(measure.isNotNull(), F.struct(measure.alias("m"), k.alias("k"))))["k"]

    score_value, size_value = c(score).cast("double"), c(size).cast("double")
    return stats.agg(
        first(-score_value).alias("most_positive"),
        first(score_value).alias("most_negative"),
        first(-size_value).alias("busiest"),
    )


def daily_volume(df: DataFrame, time: str = "timestamp") -> DataFrame:
    return (
        df.groupBy(F.window(c(time), "1 day").alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("day_start"), "n")
        .orderBy("day_start")
    )


def weekly_sentiment(df: DataFrame, score: str = "vader_sentiment", time: str = "timestamp", digits: int = 6) -> DataFrame:
    """Mean score per tumbling week; weeks start on Thursdays, as the epoch did."""
    return (
        df.groupBy(F.window(c(time), "1 week").alias("w"))
        .agg(F.round(F.avg(c(score)), digits).alias("avg_sentiment"), F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("week_start"), "avg_sentiment", "n")
        .orderBy("week_start")
    )


# registers of a distinct sketch: 2 ** SKETCH_BITS, a relative standard error of about 1.04 / 2 ** (SKETCH_BITS / 2)
SKETCH_BITS = 12


def distinct_sketches(df: DataFrame, by: str, col: str, bits: int = SKETCH_BITS) -> DataFrame:
    """(by, n, sketch): a mergeable sketch of the distinct values of every group, of a few kilobytes at most; NULLs don't count.

    Stored, the sketches answer for any union of groups without reading the rows again.
    """
    return df.groupBy(c(by).alias(by)).agg(F.count(c(col)).alias("n"), F.hll_sketch_agg(c(col), bits).alias("sketch"))


def merge_sketches(sketches: DataFrame, key: Column, name: str = "key") -> DataFrame:
    """(name, n, estimate): rows and estimated distinct values of unions of groups, merged on the map side."""
    return sketches.groupBy(key.alias(name)).agg(F.sum("n").alias("n"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def within_error(estimate: Column, exact: Column, bits: int = SKETCH_BITS, deviations: float = 4.0) -> Column:
    """Whether an estimate lies within so many standard errors of the exact count, or one of a small count."""
    return F.abs(estimate - exact) <= F.greatest(exact * (deviations * 1.04 / 2 ** (bits / 2)), F.lit(1.0))
