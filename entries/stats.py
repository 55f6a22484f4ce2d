"""Queries of the descriptive statistics."""

from pyspark.sql import functions as F

from remarklab.functions import scores as S
from remarklab.functions import times as T
from remarklab.operators import density as D
from remarklab.operators import profile as P
from remarklab.operators.sentiment import label_sentiment
from remarklab.schema import c

from .common import (
    COMMENTS, cleaned, comments, query, scored, table, with_cleaned, with_comments, with_gaps, with_scored,
)

TIME = "yyyy-MM-dd HH:mm:ss"
SQL_TIME = "'%Y-%m-%d %H:%M:%S'"


def timed(spark, sf):
    return comments(spark, sf, False).withColumn("timestamp", T.epoch_to_ts(c("created_utc")))


def event_comments(spark, sf):
    """Events as scored comments: the value, centred, plays the score."""
    e = table(spark, sf, "events")
    out = e.select(
        F.col("ts").cast("timestamp").alias("timestamp"), "user_id", "event_type",
        (F.col("value") / 100 - 0.2).alias("vader_sentiment"),
    )
    return label_sentiment(out)


EVENTS = """ev AS (SELECT ts, user_id, event_type, value / 100 - 0.2 AS vader_sentiment FROM events)"""


@query("table_profile", """WITH n AS (SELECT count(*) AS row_count FROM documents)
SELECT * , (SELECT row_count FROM n) AS row_count, 11 AS column_count FROM (VALUES
 (0, 'type', 'string'), (1, 'id', 'string'), (2, 'subreddit.id', 'string'), (3, 'subreddit.name', 'string'),
 (4, 'subreddit.nsfw', 'boolean'), (5, 'created_utc', 'bigint'), (6, 'permalink', 'string'), (7, 'body', 'string'),
 (8, 'sentiment', 'double'), (9, 'score', 'int'), (10, 'lang', 'string')) t(position, column_name, data_type)""")
def table_profile(spark, sf):
    return P.table_profile(comments(spark, sf, False))


COMPLETE = """SELECT column_name, non_null, n - non_null AS nulls, round(100.0 * non_null / n, 2) AS pct_complete FROM ("""


@query("completeness", with_gaps(COMPLETE + " UNION ALL ".join(
    f"""SELECT '{x}' AS column_name, count("{x}") AS non_null, count(*) AS n FROM comments"""
    for x in ("type", "id", "subreddit.id", "subreddit.name", "subreddit.nsfw", "created_utc", "permalink",
              "body", "sentiment", "score", "lang")) + ")"))
def completeness(spark, sf):
    return P.completeness(comments(spark, sf, False, gaps=True))


@query("verify_stage", COMPLETE + " UNION ALL ".join(
    f"SELECT '{x}' AS column_name, count({x}) AS non_null, count(*) AS n FROM labels" for x in ("doc_id", "quality", "toxic")) + ")")
def verify_stage(spark, sf):
    from remarklab.sources.sinks import verify_stage as verify

    return verify(spark, f"{sf}/labels.parquet")


def sql_describe(name: str, value: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS column_name, count({value}) AS n, round(avg({value}), 6) AS mean, "
        f"round(stddev_samp({value}), 6) AS stddev, CAST(min({value}) AS DOUBLE) AS min, "
        f"CAST(max({value}) AS DOUBLE) AS max FROM {source}"
    )


@query("describe_columns", with_comments(" UNION ALL ".join(
    [sql_describe("sentiment", "sentiment", "comments"), sql_describe("body_length", "length(body)", "comments"),
     sql_describe("score", "score", "comments")])))
def describe_columns(spark, sf):
    return P.describe(
        comments(spark, sf, False),
        {"sentiment": c("sentiment"), "body_length": F.length("body"), "score": c("score")},
    )


@query("time_range", with_comments(f"""SELECT strftime(min(ts), {SQL_TIME}) AS earliest, strftime(max(ts), {SQL_TIME}) AS latest FROM comments"""))
def time_range(spark, sf):
    return P.time_range(timed(spark, sf)).select(
        F.date_format("earliest", TIME).alias("earliest"), F.date_format("latest", TIME).alias("latest")
    )


@query("count_by_group", with_comments("""SELECT "subreddit.name" AS subreddit_name, count(*) AS n FROM comments GROUP BY 1"""))
def count_by_group(spark, sf):
    return P.count_by(comments(spark, sf, False), "subreddit.name", "subreddit_name")


@query("count_by_year", with_comments("SELECT CAST(year(ts) AS INTEGER) AS year, count(*) AS n FROM comments GROUP BY 1"))
def count_by_year(spark, sf):
    return P.count_by_year(timed(spark, sf))


@query("score_bucket_counts", with_comments("""SELECT CASE WHEN sentiment >= 0.1 THEN 'positive' WHEN sentiment <= -0.1 THEN 'negative'
       ELSE 'neutral' END AS sentiment_range, count(*) AS n FROM comments GROUP BY 1"""))
def score_bucket_counts(spark, sf):
    return P.score_bucket_counts(comments(spark, sf, False))


@query("length_bucket_counts", with_gaps("""SELECT CASE WHEN length(body) <= 50 THEN 'very_short' WHEN length(body) <= 200 THEN 'short'
       WHEN length(body) <= 500 THEN 'medium' WHEN length(body) <= 1000 THEN 'long' ELSE 'very_long' END AS length_range,
       count(*) AS n FROM comments GROUP BY 1"""))
def length_bucket_counts(spark, sf):
    return P.length_bucket_counts(comments(spark, sf, False, gaps=True))


@query("distribution", with_scored("""SELECT sentiment_category, count(*) AS n,
       round(100.0 * count(*) / (SELECT count(*) FROM scored), 2) AS percentage FROM scored GROUP BY 1"""))
def distribution(spark, sf):
    return P.distribution(scored(spark, sf), "sentiment_category")


CATS = """count(*) FILTER (sentiment_category = 'Positive') AS positive_count,
       count(*) FILTER (sentiment_category = 'Negative') AS negative_count,
       count(*) FILTER (sentiment_category = 'Neutral') AS neutral_count"""


@query("group_sentiment", with_scored(f"""SELECT "subreddit.name" AS subreddit_name, count(*) AS comment_count,
       round(avg(vader_sentiment), 6) AS avg_sentiment, {CATS} FROM scored GROUP BY 1 HAVING count(*) >= 10"""))
def group_sentiment(spark, sf):
    return P.group_sentiment(scored(spark, sf), "subreddit.name", min_n=10, name="subreddit_name")


@query("type_sentiment", with_scored(f"""SELECT type, count(*) AS comment_count,
       round(avg(vader_sentiment), 6) AS avg_sentiment, {CATS} FROM scored GROUP BY 1"""))
def type_sentiment(spark, sf):
    return P.group_sentiment(scored(spark, sf), "type", min_n=1)


@query("monthly_sentiment", with_scored("""SELECT strftime(ts, '%Y-%m') AS year_month, count(*) AS comment_count,
       round(avg(vader_sentiment), 6) AS avg_sentiment, count(*) FILTER (sentiment_category = 'Positive') AS positive_count,
       count(*) FILTER (sentiment_category = 'Negative') AS negative_count FROM scored GROUP BY 1"""))
def monthly_sentiment(spark, sf):
    return P.monthly_sentiment(scored(spark, sf))


YEARLY = f"""SELECT CAST(year(ts) AS INTEGER) AS year, count(*) AS total_comments, round(avg(vader_sentiment), 6) AS avg_sentiment,
       {CATS} FROM scored GROUP BY 1"""


@query("yearly_sentiment", with_scored(f"""SELECT *, round(positive_count / total_comments, 6) AS positive_ratio,
       round(negative_count / total_comments, 6) AS negative_ratio, round(neutral_count / total_comments, 6) AS neutral_ratio
       FROM ({YEARLY})"""))
def yearly_sentiment(spark, sf):
    return P.yearly_sentiment(scored(spark, sf))


@query("extremes_by_year", with_scored(f"""SELECT
       (SELECT CAST(year AS VARCHAR) FROM ({YEARLY}) ORDER BY avg_sentiment DESC, year LIMIT 1) AS most_positive,
       (SELECT CAST(year AS VARCHAR) FROM ({YEARLY}) ORDER BY avg_sentiment, year LIMIT 1) AS most_negative,
       (SELECT CAST(year AS VARCHAR) FROM ({YEARLY}) ORDER BY total_comments DESC, year LIMIT 1) AS busiest"""))
def extremes_by_year(spark, sf):
    return P.extremes(P.yearly_sentiment(scored(spark, sf)), "year")


GROUPED = """SELECT "subreddit.name" AS g, count(*) AS n, round(avg(vader_sentiment), 6) AS m FROM scored GROUP BY 1"""


@query("extremes_by_group", with_scored(f"""SELECT
       (SELECT g FROM ({GROUPED}) ORDER BY m DESC, g LIMIT 1) AS most_positive,
       (SELECT g FROM ({GROUPED}) ORDER BY m, g LIMIT 1) AS most_negative,
       (SELECT g FROM ({GROUPED}) ORDER BY n DESC, g LIMIT 1) AS busiest"""))
def extremes_by_group(spark, sf):
    groups = P.group_sentiment(scored(spark, sf), "subreddit.name", min_n=1, name="subreddit_name")
    return P.extremes(groups, "subreddit_name", size="comment_count")


@query("distinct_users", "SELECT count(DISTINCT user_id) AS distinct_users FROM events")
def distinct_users(spark, sf):
    return P.distinct_users(event_comments(spark, sf), "user_id")


@query("distinct_users_approx")
def distinct_users_approx(spark, sf):
    return P.distinct_users(event_comments(spark, sf), "user_id", approx=True)


@query("average_length", with_comments("SELECT round(avg(length(body)), 6) AS average_length FROM comments"))
def average_length(spark, sf):
    return P.average_length(comments(spark, sf, False))


@query("key_stats", with_cleaned("""SELECT min(created_utc) AS earliest, max(created_utc) AS latest, round(avg(sentiment), 6) AS avg_sentiment,
       round(avg(len(tokens_cleaned)), 6) AS avg_tokens, round(avg(length(cleaned_body)), 6) AS avg_length FROM cleaned"""))
def key_stats(spark, sf):
    return P.key_stats(cleaned(spark, sf))


@query("daily_volume", f"""SELECT strftime(date_trunc('day', ts), {SQL_TIME}) AS day_start, count(*) AS n FROM events GROUP BY 1""")
def daily_volume(spark, sf):
    return P.daily_volume(event_comments(spark, sf)).withColumn("day_start", F.date_format("day_start", TIME))


@query("weekly_sentiment", f"""WITH {EVENTS} SELECT strftime(time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01'), {SQL_TIME}) AS week_start,
       round(avg(vader_sentiment), 6) AS avg_sentiment, count(*) AS n FROM ev GROUP BY 1""")
def weekly_sentiment(spark, sf):
    return P.weekly_sentiment(event_comments(spark, sf)).withColumn("week_start", F.date_format("week_start", TIME))


@query("histogram", with_comments("""SELECT bin, round(lo + bin * w, 6) AS bin_start, coalesce(n, 0) AS n,
       round(coalesce(n, 0) / (total * w), 6) AS density FROM (
         SELECT CAST(unnest(range(50)) AS INTEGER) AS bin)
       CROSS JOIN (SELECT min(sentiment) AS lo, (max(sentiment) - min(sentiment)) / 50 AS w, count(sentiment) AS total FROM comments)
       LEFT JOIN (SELECT CAST(least(floor((sentiment - lo) / w), 49) AS INTEGER) AS bin, count(*) AS n
                  FROM comments, (SELECT min(sentiment) AS lo, (max(sentiment) - min(sentiment)) / 50 AS w FROM comments)
                  WHERE sentiment IS NOT NULL GROUP BY 1) USING (bin)"""))
def histogram(spark, sf):
    return D.histogram(comments(spark, sf, False), "sentiment", 50)


@query("histogram_by_group", with_comments("""SELECT subreddit_name, bin, round(-1.0 + bin * w, 6) AS bin_start, coalesce(n, 0) AS n,
       round(coalesce(n, 0) / (total * w), 6) AS density FROM (
         SELECT "subreddit.name" AS subreddit_name, count(sentiment) AS total, 2.0 / 30 AS w, CAST(unnest(range(30)) AS INTEGER) AS bin
         FROM comments GROUP BY 1)
       LEFT JOIN (SELECT "subreddit.name" AS subreddit_name, CAST(least(floor((sentiment + 1.0) / (2.0 / 30)), 29) AS INTEGER) AS bin, count(*) AS n
                  FROM comments WHERE sentiment IS NOT NULL GROUP BY 1, 2) USING (subreddit_name, bin)"""))
def histogram_by_group(spark, sf):
    out = D.histogram(comments(spark, sf, False), "sentiment", 30, -1.0, 1.0, by="subreddit.name")
    return out.withColumnRenamed("subreddit.name", "subreddit_name")


@query("histogram_own_bounds", """WITH v AS (SELECT o_orderstatus AS status, o_totalprice AS x FROM orders),
b AS (SELECT status, min(x) AS lo, (max(x) - min(x)) / 20 AS w, count(*) AS total FROM v GROUP BY 1),
n AS (SELECT status, CAST(least(floor((x - lo) / w), 19) AS INTEGER) AS bin, count(*) AS n FROM v JOIN b USING (status) GROUP BY 1, 2)
SELECT status, bin, round(lo + bin * w, 6) AS bin_start, coalesce(n, 0) AS n, round(coalesce(n, 0) / (total * w), 6) AS density
FROM (SELECT *, CAST(unnest(range(20)) AS INTEGER) AS bin FROM b) LEFT JOIN n USING (status, bin)""")
def histogram_own_bounds(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderstatus", "status")
    return D.histogram(orders, "o_totalprice", 20, by="status")


def sql_box(group: str, value: str, source: str) -> str:
    return f"""q AS (SELECT {group} AS g, {value} AS v FROM {source} WHERE {value} IS NOT NULL),
b AS (SELECT g, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM q GROUP BY g)
SELECT g, count(*) AS n, round(min(v), 6) AS min, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median,
       round(any_value(q3), 6) AS q3, round(max(v), 6) AS max,
       round(min(v) FILTER (v >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_low,
       round(max(v) FILTER (v <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high FROM q JOIN b USING (g) GROUP BY g"""


@query("box_stats_length", f"WITH {COMMENTS},\n" + sql_box('"subreddit.name"', "CAST(length(body) AS DOUBLE)", "comments"))
def box_stats_length(spark, sf):
    df = comments(spark, sf, False).select(c("subreddit.name").alias("g"), F.length("body").alias("body_length"))
    return D.box_stats(df, "body_length", "g")


@query("box_stats_price", "WITH " + sql_box("o_orderstatus", "o_totalprice", "orders"))
def box_stats_price(spark, sf):
    df = table(spark, sf, "orders").withColumnRenamed("o_orderstatus", "g")
    return D.box_stats(df, "o_totalprice", "g")


@query("exact_quantiles", " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS p, round(quantile_cont(o_totalprice, {p}), 6) AS value FROM orders"
    for p in (0.0, 0.01, 0.5, 0.9, 1.0)))
def exact_quantiles(spark, sf):
    out = D.exact_quantiles(table(spark, sf, "orders"), "o_totalprice", [0.0, 0.01, 0.5, 0.9, 1.0])
    return out.withColumn("value", F.round("value", 6))


GRID = [round(-1 + 0.04 * i, 2) for i in range(51)]


@query("score_density", with_comments(f"""SELECT x, round(sum(round(exp(-0.5 * ((x - v) / h) * ((x - v) / h)), 10)) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 6) AS density
       FROM (SELECT sentiment AS v FROM comments WHERE sentiment IS NOT NULL),
            (SELECT count(sentiment) AS n, round(stddev_samp(sentiment) * pow(count(sentiment), -0.2), 12) AS h FROM comments),
            (SELECT CAST(unnest({GRID}) AS DOUBLE) AS x) GROUP BY x"""))
def score_density(spark, sf):
    return D.score_density(comments(spark, sf, False), "sentiment", GRID)


RULES_SQL = """SELECT id,
  CASE WHEN sentiment >= 0.1 THEN 'positive' WHEN sentiment <= -0.1 THEN 'negative' ELSE 'neutral' END AS raw,
  CASE WHEN sentiment IS NULL THEN 'Unknown' WHEN sentiment > 0.05 THEN 'Positive' WHEN sentiment < -0.05 THEN 'Negative' ELSE 'Neutral' END AS vader,
  CASE WHEN sentiment IS NULL THEN 'Unknown' WHEN sentiment > 0.1 THEN 'Positive' WHEN sentiment < -0.1 THEN 'Negative' ELSE 'Neutral' END AS label,
  CASE WHEN sentiment >= 0.05 THEN 'positive' WHEN sentiment <= -0.05 THEN 'negative' ELSE 'neutral' END AS design FROM comments"""


@query("bucketize_score", with_comments(RULES_SQL))
def bucketize_score(spark, sf):
    return comments(spark, sf, False).select(
        "id", *[S.bucketize_score(c("sentiment"), rule).alias(rule) for rule in ("raw", "vader", "label", "design")]
    )


@query("bucketize_length", with_gaps("""SELECT id, CASE WHEN length(body) <= 50 THEN 'very_short' WHEN length(body) <= 200 THEN 'short'
       WHEN length(body) <= 500 THEN 'medium' WHEN length(body) <= 1000 THEN 'long' ELSE 'very_long' END AS length_range FROM comments"""))
def bucketize_length(spark, sf):
    return comments(spark, sf, False, gaps=True).select("id", S.bucketize_length(F.length("body")).alias("length_range"))


@query("epoch_to_time", with_comments(f"""SELECT id, strftime(ts, {SQL_TIME}) AS posted, CAST(year(ts) AS INTEGER) AS year, strftime(ts, '%Y-%m') AS year_month FROM comments"""))
def epoch_to_time(spark, sf):
    ts = T.epoch_to_ts(c("created_utc"))
    return comments(spark, sf, False).select(
        "id", T.epoch_to_text(c("created_utc")).alias("posted"), T.year_of(ts).alias("year"), T.year_month(ts).alias("year_month")
    )


@query("parse_twitter_time", f"""SELECT o_orderkey, strftime(o_orderdate, {SQL_TIME}) AS posted FROM orders""")
def parse_twitter_time(spark, sf):
    # order dates rendered the way the other source writes times
    text = F.date_format("o_orderdate", "EEE MMM dd HH:mm:ss '+0000' yyyy")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.date_format(T.parse_twitter_time(text), TIME).alias("posted")
    )


@query("lengths_and_counts", with_cleaned("""SELECT id, CAST(length(cleaned_body) AS INTEGER) AS characters, CAST(len(tokens_cleaned) AS INTEGER) AS tokens FROM cleaned"""))
def lengths_and_counts(spark, sf):
    from remarklab.functions.text import char_length, token_count

    return cleaned(spark, sf).select(
        "id", char_length(F.col("cleaned_body")).alias("characters"), token_count(F.col("tokens_cleaned")).alias("tokens")
    )


@query("safe_divide", with_comments("""SELECT id, CASE WHEN score = 0 THEN 0.0 ELSE round(sentiment / score, 6) END AS ratio,
       CASE WHEN score = 0 THEN 0.0 ELSE round(100.0 * 7 / score, 2) END AS pct,
       printf('%.2f', CAST(score AS DOUBLE) / 8) || '%' AS pct_text FROM comments WHERE sentiment IS NOT NULL"""))
def safe_divide(spark, sf):
    return comments(spark, sf, False).filter("sentiment is not null").select(
        "id",
        F.round(S.safe_divide(c("sentiment"), c("score")), 6).alias("ratio"),
        S.pct(F.lit(7), c("score")).alias("pct"),
        S.pct_text(c("score").cast("double") / 8).alias("pct_text"),
    )


@query("distinct_users_by_week", """WITH e AS (SELECT time_bucket(INTERVAL 7 DAY, CAST(ts AS DATE), DATE '1970-01-01') AS week, user_id FROM events)
SELECT strftime(week, '%Y-%m-%d') AS week_start, count(user_id) AS n, count(DISTINCT user_id) AS exact, true AS within FROM e GROUP BY week""")
def distinct_users_by_week(spark, sf):
    """Sketches per day, merged to weeks, beside the exact counts."""
    days = table(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))
    start = F.date_add(F.lit("1970-01-01").cast("date"), (F.floor(F.unix_date("day") / 7) * 7).cast("int"))
    merged = P.merge_sketches(P.distinct_sketches(days, "day", "user_id"), start, "week")
    exact = days.groupBy(start.alias("week")).agg(F.count_distinct("user_id").alias("exact"))
    return merged.join(exact, "week").select(
        F.date_format("week", "yyyy-MM-dd").alias("week_start"), "n", "exact", P.within_error(F.col("estimate"), F.col("exact")).alias("within"))
