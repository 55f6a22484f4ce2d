"""Windows, de-duplication and scoring of a stream of comments or events.

Late rows are accepted for a bounded delay, which also bounds the state. Event times without a
zone are read as UTC, since watermarks need a zoned timestamp.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..schema import c


def read_event_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int = 100, pattern: str = "*.parquet"
) -> DataFrame:
    """A folder of Parquet files as a stream, a bounded number of files per batch."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .option("pathGlobFilter", pattern)
        .parquet(path)
    )


def with_event_time(df: DataFrame, time: str = "ts", delay: str = "1 day") -> DataFrame:
    return df.withColumn(time, c(time).cast("timestamp")).withWatermark(time, delay)


def stream_daily_volume(df: DataFrame, time: str = "ts", delay: str = "1 day") -> DataFrame:
    """Rows per tumbling day."""
    return (
        with_event_time(df, time, delay)
        .groupBy(F.window(c(time), "1 day").alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("day_start"), "n")
    )


def stream_weekly_sentiment(
    df: DataFrame, score: str = "vader_sentiment", time: str = "ts", delay: str = "1 day", digits: int = 6
) -> DataFrame:
    """Mean score per tumbling week (from Thursday, as in the batch operator)."""
    return (
        with_event_time(df, time, delay)
        .groupBy(F.window(c(time), "1 week").alias("w"))
        .agg(F.round(F.avg(c(score)), digits).alias("avg_sentiment"), F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("week_start"), "avg_sentiment", "n")
    )


def stream_dedup(df: DataFrame, key: str = "event_id", time: str = "ts", delay: str = "1 day") -> DataFrame:
    """First row per key, remembered for as long as a copy may be late."""
    return with_event_time(df, time, delay).dropDuplicatesWithinWatermark([key])


def stream_score(
    df: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
    written: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Apply a batch scoring function to every micro-batch and store the rows once per batch.

    Each batch overwrites its own partition, so a batch repeated after a failure leaves no copies.
    ``written`` is called with a batch's number once its rows are stored, before the batch is committed.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        score(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if written is not None:
            written(batch_id)

    return (
        df.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
