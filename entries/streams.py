"""Queries that drive streams of events to their end and read their sinks."""

from pyspark.sql import functions as F

from remarklab.functions.scores import bucketize_score
from remarklab.sources.streams import append_stream
from remarklab.streaming import events as G, replay as R

from .common import query, table

# the feed: slots of eight days; rows that come five days late, and copies two and nine days later
SLOTS, SLOT_DAYS, LATE, AGAIN, DELAY = 4, 8, {10: 5}, {7: 2, 11: 9}, "2 days"
TIME = "yyyy-MM-dd HH:mm:ss"

FEED = f"""more AS (SELECT *, 0 AS lag FROM events UNION ALL SELECT *, 2 FROM events WHERE event_id % 7 = 0 UNION ALL SELECT *, 9 FROM events WHERE event_id % 11 = 0),
feed AS (SELECT *, least({SLOTS - 1}, CAST(floor((date_diff('day', (SELECT CAST(min(ts) AS DATE) FROM events), CAST(ts AS DATE))
  + lag + CASE WHEN event_id % 10 = 0 THEN 5 ELSE 0 END) / {SLOT_DAYS}) AS INTEGER)) AS slot FROM more),
latest AS (SELECT slot, max(epoch_ms(ts)) AS t FROM feed GROUP BY 1),
marks AS (SELECT slot, max(t) OVER (ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 2 * 86400000 AS mark FROM latest),
marked AS (SELECT feed.*, coalesce(mark, 0) * 1000 AS mark FROM feed JOIN marks USING (slot)),
last_mark AS (SELECT (max(t) - 2 * 86400000) * 1000 AS final_mark FROM latest)"""


def feed(spark, sf):
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return R.repeated_feed(events, SLOT_DAYS, LATE, AGAIN)


@query("stream_daily_windows", f"""WITH {FEED}
SELECT strftime(day, '%Y-%m-%d %H:%M:%S') AS day_start, count(*) AS n FROM (SELECT *, date_trunc('day', ts) AS day FROM marked)
WHERE epoch_us(day) + 86400000000 > mark AND epoch_us(day) + 86400000000 <= (SELECT final_mark FROM last_mark) GROUP BY 1""")
def stream_daily_windows(spark, sf):
    """Closed days of an out-of-order feed, in append mode: rows of days closed before they arrive are not counted."""
    folder = R.work_folder(spark)
    R.drive(feed(spark, sf), SLOTS, folder, lambda df: append_stream(
        G.stream_daily_volume(df, delay=DELAY), f"{folder}/days", f"{folder}/days-checkpoint"))
    return spark.read.schema("day_start timestamp, n bigint").parquet(f"{folder}/days").withColumn("day_start", F.date_format("day_start", TIME))


@query("stream_first_events", f"""WITH {FEED}, firsts AS (SELECT event_id, min(slot) AS slot FROM feed GROUP BY 1)
SELECT DISTINCT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM marked JOIN firsts USING (event_id, slot) WHERE epoch_us(ts) > mark""")
def stream_first_events(spark, sf):
    """One row per event of a feed with repeated and late rows; events that only come too late are left out."""
    folder = R.work_folder(spark)
    rows = feed(spark, sf)
    R.drive(rows, SLOTS, folder, lambda df: append_stream(G.stream_dedup(df, delay=DELAY), f"{folder}/firsts", f"{folder}/firsts-checkpoint"))
    kept = spark.read.schema(rows.drop("slot").schema).parquet(f"{folder}/firsts")
    return kept.select("event_id", F.date_format("ts", TIME).alias("ts"))


@query("stream_scores_after_failure", f"""WITH {FEED}
SELECT event_id, CASE WHEN s > 0.1 THEN 'Positive' WHEN s < -0.1 THEN 'Negative' ELSE 'Neutral' END AS sentiment_category, count(*) AS n
FROM (SELECT *, value / 100 - 0.2 AS s FROM feed) GROUP BY 1, 2""")
def stream_scores_after_failure(spark, sf):
    """Scores stored by batch; two batches fail between their write and their commit and run again."""
    folder = R.work_folder(spark)
    rows = feed(spark, sf)
    failures = [1, 1]

    def fail_once(batch_id: int) -> None:
        if batch_id in (1, 2) and failures[batch_id - 1]:
            failures[batch_id - 1] = 0
            raise RuntimeError(f"stopped after writing batch {batch_id}")

    def score(batch):
        return batch.withColumn("sentiment_category", bucketize_score(F.col("value") / 100 - 0.2, "label"))

    R.drive(rows, SLOTS, folder, lambda df: G.stream_score(df, score, f"{folder}/scores", f"{folder}/scores-checkpoint", written=fail_once), attempts=2)
    stored = spark.read.schema(rows.drop("slot").schema.add("sentiment_category", "string").add("batch", "integer")).parquet(f"{folder}/scores")
    return stored.groupBy("event_id", "sentiment_category").agg(F.count(F.lit(1)).alias("n"))
