import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from remarklab.sources.streams import append_stream
from remarklab.streaming import events as G, replay as R


@pytest.fixture(scope="module")
def feed(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    return R.repeated_feed(events, 4, {10: 3}, {3: 1, 7: 9}).select("event_id", "ts", "value", "slot")


def test_feed_is_out_of_order_with_copies(feed):
    rows = feed.collect()
    assert len(rows) == 1000 + 334 + 143
    by_id = {}
    for r in rows:
        by_id.setdefault(r.event_id, []).append(r.slot)
    assert sum(len(s) > 1 for s in by_id.values()) == len({i for i in by_id if i % 3 == 0 or i % 7 == 0})
    latest = {s: max(r.ts for r in rows if r.slot == s) for s in {r.slot for r in rows}}
    assert any(r.ts < latest[s] for r in rows for s in latest if s < r.slot)


def test_state_is_bounded_by_the_delay(spark, feed, tmp_path):
    """De-duplication remembers the ids of about the delay, not all."""
    def run(delay):
        folder = f"{tmp_path}/{delay.replace(' ', '-')}"
        progress = R.drive(feed, 7, folder, lambda df: append_stream(G.stream_dedup(df, delay=delay), f"{folder}/out", f"{folder}/cp"))
        return R.largest_state(progress), spark.read.parquet(f"{folder}/out"), progress

    short, kept, progress = run("1 day")
    long, everything, _ = run("40 days")
    assert everything.count() == everything.select("event_id").distinct().count() == 1000 == long
    # a slot has four days of thirty, and the delay one more
    assert 0 < short <= 300 and kept.count() == kept.select("event_id").distinct().count() < 1000
    assert sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"]) > 0
    assert not os.path.exists(f"{tmp_path}/1-day/feed")


def test_a_batch_stopped_before_its_commit_is_stored_once(spark, feed, tmp_path):
    seen, score = [], lambda b: b.withColumn("x", F.col("value") * 2)

    def stop(batch_id):
        seen.append(batch_id)
        if seen.count(batch_id) == 1:
            raise RuntimeError("stopped")

    R.drive(feed, 3, str(tmp_path), lambda df: G.stream_score(df, score, f"{tmp_path}/out", f"{tmp_path}/cp", written=stop), attempts=2)
    assert seen == [0, 0, 1, 1, 2, 2]
    got = spark.read.parquet(f"{tmp_path}/out").groupBy("event_id", "x").count().collect()
    want = feed.groupBy("event_id", (F.col("value") * 2).alias("x")).count().collect()
    assert sorted(got) == sorted(want)


def test_the_last_failure_is_raised(spark, feed, tmp_path):
    def stop(batch_id):
        raise RuntimeError("stopped")

    with pytest.raises(StreamingQueryException):
        R.drive(feed, 2, str(tmp_path), lambda df: G.stream_score(df, lambda b: b, f"{tmp_path}/out", f"{tmp_path}/cp", written=stop), attempts=2)
