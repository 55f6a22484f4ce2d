import json
import os
import re

import pytest
from pyspark.sql import functions as F

from entries.common import KEYWORDS, comments, lexicon, modifiers
from remarklab.config import Settings
from remarklab.operators.rows import recent_only
from remarklab.operators.topics import topic_corpus
from remarklab.plans.stages import Context, Paths, STAGES, run_stages, stages_report
from remarklab.schema import COMMENT_SCHEMA
from remarklab.session import cache_stage, checkpoint_dir
from remarklab.sources import readers, sinks
from remarklab.streaming import events as G

HEADER = "type,id,subreddit.id,subreddit.name,subreddit.nsfw,created_utc,permalink,body,sentiment,score\n"


def record(i, body, created="1661990368"):
    return f'comment,{i},2qh3l,news,false,{created},https://x/{i},"{body}",0.5,{i}\n'


@pytest.fixture()
def dump(tmp_path):
    path = tmp_path / "dump.csv"
    rows = [
        record(1, "plain text"), record(2, 'with ""quotes"" inside'), record(3, "two\nlines, and a comma"),
        record(4, "x" * 5000), record(5, ""), record(6, "ends with newline\n"), record(7, "bad time", "not a number"),
    ]
    path.write_text(HEADER + "".join(rows))
    return path


def by_id(df):
    return sorted(map(str, df.select(*[F.col(f"`{c}`") for c in df.columns]).collect()))


def test_csv_forms_agree(spark, dump):
    whole, split = readers.read_comments_csv(spark, str(dump)), readers.read_comments_csv_split(spark, str(dump))
    good_whole, bad_whole = readers.split_corrupt(whole.cache())
    good, bad = readers.split_corrupt(split.cache())
    assert by_id(good) == by_id(good_whole)
    assert good.count() == 6 and bad.count() == bad_whole.count() == 1
    bodies = {r.id: r.body for r in good.collect()}
    assert bodies["2"] == 'with "quotes" inside' and bodies["3"] == "two\nlines, and a comma"


def test_torn_records_are_read_whole(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + record(1, "tricky\ncomment,99,is only text") + record(2, "next"))
    (tmp_path / "b.csv").write_text(HEADER + record(3, "other file"))
    split = readers.read_comments_csv_split(spark, str(tmp_path))
    assert by_id(split) == by_id(readers.read_comments_csv(spark, str(tmp_path))) and split.count() == 3


def test_torn_files_are_read_in_splits(spark, tmp_path):
    """Bodies that hold the start of a record, over the borders of many small splits."""
    rows = []
    for i in range(300):
        body = "plain " * (i % 40)
        if i % 7 == 0:
            body = "\ncomment,1,a,b\n".join(["part " * (i % 50)] * (1 + i % 4)) + '\ncomment,""quoted""'
        rows.append(record(i, body))
    (tmp_path / "a.csv").write_text(HEADER + "".join(rows))
    (tmp_path / "b.csv").write_text(HEADER + "".join(record(1000 + i, "calm " * 9) for i in range(200)))
    whole = readers.read_comments_csv(spark, str(tmp_path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        split = readers.read_comments_csv_split(spark, str(tmp_path))
        assert split.rdd.getNumPartitions() > 5
        assert by_id(split) == by_id(whole) and split.count() == 500
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_sampled_dump(spark, tmp_path):
    rows = [record(i, f"text number {i}") for i in range(300)]
    (tmp_path / "d.csv").write_text(HEADER + "".join(rows))
    out = str(tmp_path / "s.parquet")
    readers.csv_to_parquet_sample(spark, str(tmp_path / "d.csv"), out, 0.1, exact=True)
    stored = spark.read.parquet(out)
    assert stored.count() == 30 and stored.columns == COMMENT_SCHEMA.fieldNames()


def test_first_available(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "plain"))
    spark.range(3).withColumn("x", F.lit(1)).write.parquet(str(tmp_path / "rich"))
    paths = [str(tmp_path / p) for p in ("missing", "plain", "rich")]
    assert readers.read_first_available(spark, paths).columns == ["id"]
    assert readers.read_first_available(spark, paths, ["x"]).columns == ["id", "x"]
    with pytest.raises(FileNotFoundError):
        readers.read_first_available(spark, paths, ["y"])


def test_stage_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", "news", None)], "id string, `subreddit.name` string, body string")
    path = str(tmp_path / "stage")
    sinks.write_stage(df, path, ["subreddit.name", "id", "nope", "body"])
    assert spark.read.parquet(path).columns == ["subreddit.name", "id", "body"]
    got = {r.column_name: (r.non_null, r.nulls) for r in sinks.verify_stage(spark, path).collect()}
    assert got == {"subreddit.name": (1, 0), "id": (1, 0), "body": (0, 1)}


def test_json_reports(spark, tmp_path):
    a = spark.createDataFrame([(1, "x")], "n int, `a.b` string")
    doc = sinks.report_document({"first": a, "second": spark.range(2)})
    sinks.write_json_report(doc, str(tmp_path / "r"))
    lines = "".join((tmp_path / "r" / p).read_text() for p in os.listdir(tmp_path / "r") if p.startswith("part"))
    assert json.loads(lines) == {"first": [{"n": 1, "a.b": "x"}], "second": [{"id": 0}, {"id": 1}]}
    with pytest.raises(ValueError):
        sinks.report_document({"rows": spark.range(3)}, max_rows=2)


def test_checkpoint_folder_is_the_named_one(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert checkpoint_dir(spark) == named
    df = cache_stage(spark.range(10).withColumn("x", F.rand(1)), durable=True)
    assert df.count() == 10 and "Scan ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()
    kept = cache_stage(spark.range(5))
    assert kept.storageLevel.useDisk and kept.storageLevel.useMemory
    kept.unpersist()


def test_all_stages(spark, sf, tmp_path):
    source = comments(spark, sf).drop("lang")
    source.coalesce(1).write.option("header", True).option("escape", '"').csv(str(tmp_path / "csv"))
    settings = Settings(
        sample_fraction=0.9, keywords=KEYWORDS, topic_sample_fraction=0.8, topic_min_df=3.0, topic_iterations=2,
        num_topics=3, num_trees=3, max_depth=3, group_min_size=2,
    )
    ctx = Context(spark, Paths(str(tmp_path / "csv"), str(tmp_path / "work")), settings, lexicon(spark), modifiers(spark))
    results = run_stages(ctx)
    assert [r.stage for r in results] == list(STAGES) and all(r.success for r in results), [r.error for r in results]
    metrics = {r.stage: r.metrics for r in results}
    assert 150 < metrics["extraction"]["sampled_rows"] < 200
    assert metrics["topics"]["num_topics"] == 3
    best = metrics["classification"]["best_model"]
    assert best["model"] in ("naive_bayes", "random_forest") and best["accuracy"] > 0
    stored = spark.read.parquet(ctx.paths.stage("sentiment"))
    # a folder per year, which a filter prunes; the time filter reaches the scan
    recent = recent_only(stored.filter("year >= 2020"), "2020-06-01")
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created_utc," in plan and re.search(r"PartitionFilters: \[[^]]*year#\d+ >= 2020", plan)
    every = spark.read.parquet(ctx.paths.stage("topics"))
    assert every.count() == topic_corpus(stored, settings, fraction=1.0).count()
    groups = {json.loads(x)["subreddit_name"] for x in spark.read.text(ctx.paths.report("profile_by_group")).toPandas()["value"]}
    assert groups == {r[0] for r in source.select("`subreddit.name`").distinct().collect()}
    assert "subreddit.name" in stored.columns and stored.count() == metrics["cleaning"]["final_records"]
    report = stages_report(spark, results).collect()
    assert len(report) == 6 and report[0].success_rate == 100.0
    sinks.write_json_report(stages_report(spark, results), ctx.paths.report("run"))


def test_failure_stops_and_skip(spark, tmp_path):
    ctx = Context(spark, Paths("/nowhere.csv", str(tmp_path)))
    results = run_stages(ctx)
    assert [(r.stage, r.success) for r in results] == [("extraction", False)]
    assert run_stages(ctx, skip=("extraction", "profile"))[0].stage == "cleaning"


# --- streams ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def event_files(spark, sf, tmp_path_factory):
    """The events in four files by time, the last one repeating some rows."""
    folder = tmp_path_factory.mktemp("events")
    events = spark.read.parquet(f"{sf}/events.parquet")
    for i in range(4):
        part = events.filter((F.col("event_id") >= i * 250) & (F.col("event_id") < (i + 1) * 250))
        if i == 3:
            part = part.unionByName(part.filter("event_id % 5 = 0"))
        part.coalesce(1).write.mode("append").parquet(str(folder))
    return str(folder), events


def collect_stream(df, mode, name, spark, tmp_path):
    query = (
        df.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / name)).start()
    )
    query.awaitTermination()
    return {tuple(r) for r in spark.table(name).collect()}


def test_stream_windows_equal_batch(spark, event_files, tmp_path):
    from remarklab.operators.profile import daily_volume, weekly_sentiment

    folder, events = event_files
    stream = G.stream_dedup(G.read_event_stream(spark, folder, events.schema, 1))
    ids = collect_stream(stream.select("event_id"), "append", "ids", spark, tmp_path)
    assert len(ids) == events.count()
    timed = spark.read.parquet(folder).withColumn("timestamp", F.col("ts").cast("timestamp"))
    batch = {tuple(r) for r in daily_volume(timed).collect()}
    source = G.read_event_stream(spark, folder, events.schema, 100)
    assert collect_stream(G.stream_daily_volume(source), "complete", "daily", spark, tmp_path) == batch
    closed = collect_stream(G.stream_daily_volume(source), "append", "closed", spark, tmp_path)
    last = timed.agg(F.max("timestamp").alias("t")).first().t
    import datetime as dt

    assert closed == {(d, n) for d, n in batch if d + dt.timedelta(days=1) <= last - dt.timedelta(days=1)}
    scored = source.withColumn("vader_sentiment", F.col("value") / 100)
    weekly = collect_stream(G.stream_weekly_sentiment(scored), "complete", "weekly", spark, tmp_path)
    want = weekly_sentiment(timed.withColumn("vader_sentiment", F.col("value") / 100))
    assert weekly == {tuple(r) for r in want.collect()}


def test_stream_scoring(spark, event_files, tmp_path):
    from remarklab.operators.sentiment import label_sentiment

    folder, events = event_files
    source = G.read_event_stream(spark, folder, events.schema, 1)
    out = str(tmp_path / "scored")
    query = G.stream_score(
        source, lambda b: label_sentiment(b.withColumn("vader_sentiment", F.col("value") / 100 - 0.2)), out, str(tmp_path / "cp")
    )
    query.awaitTermination()
    stored = spark.read.parquet(out)
    assert stored.count() == spark.read.parquet(folder).count()
    assert stored.filter("sentiment_category is null").count() == 0


def test_append_stream(spark, event_files, tmp_path):
    from remarklab.sources.streams import append_stream

    folder, events = event_files
    source = G.stream_daily_volume(G.read_event_stream(spark, folder, events.schema, 100))
    append_stream(source, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() > 20
