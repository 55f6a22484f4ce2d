"""Driving streams over a feed that arrives in slots, up to its end.

Each slot's rows are added to the feed's folder, and the stream runs until it has read all there is
(``availableNow``), keeping its progress in its checkpoint. So the watermark that a slot's rows meet is that of
all slots before it, and a stream that fails goes on where it was when it is started again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schema import c
from ..session import checkpoint_dir
from .events import read_event_stream


def work_folder(spark: SparkSession, name: str = "stream") -> str:
    """A new folder in the shared one, for a feed, its sinks and their checkpoints."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def arrivals(rows: DataFrame, slots: int, feed: str, slot: str = "slot") -> Iterator[int]:
    """Add the rows of one slot after the other to the feed, in order; rows of later slots come with the last."""
    for n in range(slots):
        part = rows.filter(c(slot) == n) if n < slots - 1 else rows.filter(c(slot) >= n)
        part.drop(slot).write.mode("append").parquet(feed)
        yield n


def run_to_end(query: StreamingQuery) -> list[dict]:
    """Wait until a stream has read what there is; its progress, batch by batch."""
    query.awaitTermination()
    return [dict(p) for p in query.recentProgress]


def drive(
    rows: DataFrame, slots: int, folder: str, start: Callable[[DataFrame], StreamingQuery], attempts: int = 1, slot: str = "slot",
) -> list[dict]:
    """Run a stream over all slots; returns the progress of all batches.

    ``start`` gets the stream of the feed and starts it. A run that fails is started again up to ``attempts``
    times, from the checkpoint; the last failure is raised.
    """
    spark, feed = rows.sparkSession, f"{folder}/feed"
    schema = rows.drop(slot).schema
    progress: list[dict] = []
    for _ in arrivals(rows, slots, feed, slot):
        for attempt in range(attempts):
            try:
                progress += run_to_end(start(read_event_stream(spark, feed, schema)))
                break
            except StreamingQueryException:
                if attempt == attempts - 1:
                    raise
    remove_folder(spark, feed)
    return progress


def largest_state(progress: list[dict]) -> int:
    """Most rows that a stream's operators kept after any batch."""
    return max((sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in progress), default=0)


def repeated_feed(events: DataFrame, slot_days: int, late: dict[int, int], again: dict[int, int], key: str = "event_id", time: str = "ts") -> DataFrame:
    """A feed out of order: rows with the slot in which they arrive.

    Rows whose key is divisible by a number of ``late`` arrive so many days after their time, rows whose key is
    divisible by a number of ``again`` arrive once more so many days later. A slot has ``slot_days`` days, from the
    day of the first row.
    """
    first = events.agg(F.min(c(time)).alias("t")).first()["t"]
    day = F.unix_date(c(time).cast("date"))
    start = F.unix_date(F.lit(first).cast("date")) if first is not None else F.lit(0)
    lag = F.lit(0)
    for number, days in late.items():
        lag = F.when(c(key) % number == 0, days).otherwise(lag)
    copies = [F.lit(0)] + [F.when(c(key) % number == 0, days) for number, days in again.items()]
    return events.withColumn("__more", F.explode(F.array_compact(F.array(*copies)))).withColumn(
        "slot", F.floor((day - start + lag + F.col("__more")) / slot_days).cast("int")).drop("__more")
