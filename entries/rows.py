"""Queries of the row operators: filters, de-duplication, previews, samples."""

from pyspark.sql import functions as F

from remarklab.functions.times import epoch_to_ts
from remarklab.operators import rows as R
from remarklab.operators.corpus import add_clean_text, add_tokens
from remarklab.operators.classify import split_label_distribution
from remarklab.operators.sentiment import label_sentiment
from remarklab.schema import select_existing

from .common import (
    KEYWORDS, cleaned, comments, cleaned_sql, query, scored, sql_strings, table, turns,
    COMMENTS, TURNS, with_cleaned, with_comments, with_gaps, with_scored,
)


@query("read_parquet", """SELECT count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars, min(doc_id) AS first_id,
       max(doc_id) AS last_id FROM documents""")
def read_parquet(spark, sf):
    return table(spark, sf, "documents").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"),
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"),
    )


@query("select_existing", with_comments("""SELECT id, "subreddit.name" AS subreddit_name, score FROM comments"""))
def select_present(spark, sf):
    out = select_existing(comments(spark, sf, False), ["id", "subreddit.name", "no.such", "score"])
    return out.withColumnRenamed("subreddit.name", "subreddit_name")


@query("drop_empty", with_gaps("SELECT id, length(body) AS body_length FROM comments WHERE body IS NOT NULL AND body <> ''"))
def drop_empty(spark, sf):
    return R.drop_empty(comments(spark, sf, False, gaps=True)).select("id", F.length("body").cast("bigint").alias("body_length"))


@query("drop_null_result", lambda: f"""WITH {COMMENTS},
{cleaned_sql()} SELECT id, cleaned_body FROM tokenised""")
def drop_null_result(spark, sf):
    return R.drop_null_result(add_clean_text(R.drop_empty(comments(spark, sf)))).select("id", "cleaned_body")


@query("min_tokens", with_cleaned("SELECT id, len(tokens_cleaned) AS token_count FROM cleaned", 20))
def min_tokens(spark, sf):
    tokens = add_tokens(R.drop_null_result(add_clean_text(R.drop_empty(comments(spark, sf)))))
    return R.min_tokens(tokens, 20).select("id", F.size("tokens_cleaned").cast("bigint").alias("token_count"))


@query("keyword_filter", with_cleaned(
    f"SELECT id, len(tokens_cleaned) AS token_count FROM cleaned WHERE list_has_any(tokens_cleaned, [{sql_strings(KEYWORDS)}])"))
def keyword_filter(spark, sf):
    return R.keyword_filter(cleaned(spark, sf), KEYWORDS).select(
        "id", F.size("tokens_cleaned").cast("bigint").alias("token_count")
    )


@query("keyword_filter_stripped", with_cleaned(
    f"""SELECT id, len(tokens_cleaned) AS token_count FROM cleaned
        WHERE list_has_any(list_transform(tokens_cleaned, lambda t: trim(t, '.,!?;:')), [{sql_strings(KEYWORDS)}])"""))
def keyword_filter_stripped(spark, sf):
    return R.keyword_filter(cleaned(spark, sf), KEYWORDS, strip_punct=True).select(
        "id", F.size("tokens_cleaned").cast("bigint").alias("token_count")
    )


@query("keyword_table_filter", lambda: f"""WITH {COMMENTS}, {cleaned_sql()},
tok AS (SELECT id, unnest(tokens_cleaned) AS token FROM cleaned),
words AS (SELECT DISTINCT trim(event_type) AS token FROM events UNION SELECT DISTINCT lower(unnest(string_split(text, ' '))) FROM conversations)
SELECT id, len(tokens_cleaned) AS token_count FROM cleaned WHERE id IN (SELECT id FROM tok JOIN words USING (token))""")
def keyword_table_filter(spark, sf):
    said = table(spark, sf, "conversations").select(F.explode(F.split(F.lower("text"), " ")).alias("token"))
    words = said.union(table(spark, sf, "events").select(F.trim("event_type").alias("token")))
    return R.keyword_filter(cleaned(spark, sf), words, inline_rows=1000).select(
        "id", F.size("tokens_cleaned").cast("bigint").alias("token_count")
    )


@query("drop_unknown", with_comments("""SELECT id, CASE WHEN sentiment > 0.1 THEN 'Positive' WHEN sentiment < -0.1 THEN 'Negative'
       ELSE 'Neutral' END AS label FROM comments WHERE sentiment IS NOT NULL"""))
def drop_unknown(spark, sf):
    labelled = label_sentiment(comments(spark, sf, False), "sentiment", "label", "label")
    return R.drop_unknown(labelled, "label").select("id", "label")


@query("recent_only", with_comments("""SELECT id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS posted FROM comments
       WHERE ts >= TIMESTAMP '2014-01-01'"""))
def recent_only(spark, sf):
    timed = comments(spark, sf, False).withColumn("timestamp", epoch_to_ts(F.col("created_utc")))
    return R.recent_only(timed, "2014-01-01", "created_utc").select(
        "id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("posted")
    )


@query("both_scores", with_scored("""SELECT id, sentiment, vader_sentiment FROM scored
       WHERE sentiment IS NOT NULL AND vader_sentiment IS NOT NULL ORDER BY id LIMIT 10"""))
def both_scores(spark, sf):
    return R.both_scores(scored(spark, sf), n=10).select("id", "sentiment", "vader_sentiment")


@query("distinct_on", f"""WITH {TURNS} SELECT id, "subreddit.name" AS role, created_utc, body, sentiment, score FROM turns
       QUALIFY row_number() OVER (PARTITION BY id ORDER BY created_utc) = 1""")
def distinct_on(spark, sf):
    return R.distinct_on(turns(spark, sf), "id", ["created_utc"]).withColumnRenamed("subreddit.name", "role")


@query("distinct_on_narrow", f"""WITH {TURNS} SELECT id, "subreddit.name" AS role, created_utc, body, sentiment, score FROM turns
       QUALIFY row_number() OVER (PARTITION BY id ORDER BY created_utc) = 1""")
def distinct_on_narrow(spark, sf):
    out = R.distinct_on(turns(spark, sf), "id", ["created_utc"], narrow=True)
    return out.withColumnRenamed("subreddit.name", "role")


@query("head_samples", with_comments("""SELECT column_name, CAST(sample_no AS INTEGER) AS sample_no,
       CASE WHEN length(value) > 100 THEN substring(value, 1, 100) || '...' ELSE value END AS value FROM (
         SELECT 'permalink' AS column_name, row_number() OVER (ORDER BY id) AS sample_no, permalink AS value FROM comments
         UNION ALL SELECT 'body', row_number() OVER (ORDER BY id), body FROM comments
         UNION ALL SELECT 'subreddit.name', row_number() OVER (ORDER BY id), "subreddit.name" FROM comments
         UNION ALL SELECT 'score', row_number() OVER (ORDER BY id), CAST(score AS VARCHAR) FROM comments)
       WHERE sample_no <= 3"""))
def head_samples(spark, sf):
    return R.head_samples(comments(spark, sf, False), ["permalink", "body", "subreddit.name", "score"], 3, order="id")


@query("bernoulli_sample")
def bernoulli_sample(spark, sf):
    return R.bernoulli_sample(comments(spark, sf, False), 0.1).select("id")


@query("hash_sample", with_comments("SELECT id FROM comments WHERE substring(md5(id || ':42'), 1, 8) < '19999999'"))
def hash_sample(spark, sf):
    return R.hash_sample(comments(spark, sf, False), "id", 0.1).select("id")


@query("exact_sample", with_comments("""SELECT id, score FROM comments
       QUALIFY row_number() OVER (ORDER BY md5(id || ':42')) <= (SELECT CAST(floor(count(*) * 0.1 + 0.5) AS BIGINT) FROM comments)"""))
def exact_sample(spark, sf):
    return R.exact_sample(comments(spark, sf, False).select("id", "score"), "id", 0.1)


@query("train_test_split", with_comments("""SELECT id, CASE WHEN substring(md5(id || ':42:split'), 1, 8) < 'cccccccc'
       THEN 'train' ELSE 'test' END AS split FROM comments"""))
def train_test_split(spark, sf):
    train, test = R.train_test_split(comments(spark, sf, False).select("id"), "id", 0.8)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@query("train_test_split_random")
def train_test_split_random(spark, sf):
    train, test = R.train_test_split(comments(spark, sf, False).select("id"), "id", 0.8, mode="random")
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@query("split_label_distribution", with_comments("""SELECT CASE WHEN substring(md5(id || ':42:split'), 1, 8) < 'cccccccc' THEN 'train' ELSE 'test' END AS split,
       CASE WHEN sentiment > 0.1 THEN 'Positive' WHEN sentiment < -0.1 THEN 'Negative' ELSE 'Neutral' END AS label,
       count(*) AS n FROM comments WHERE sentiment IS NOT NULL GROUP BY 1, 2"""))
def split_labels(spark, sf):
    labelled = label_sentiment(comments(spark, sf, False), "sentiment", "label", "label")
    train, test = R.train_test_split(R.drop_unknown(labelled, "label"), "id", 0.8)
    return split_label_distribution(train, test, "label")


@query("sort_by_key", with_comments("""SELECT "subreddit.name" AS subreddit_name, max(score) AS top_score FROM comments GROUP BY 1 ORDER BY 1"""))
def sort_by_key(spark, sf):
    groups = comments(spark, sf, False).groupBy(F.col("`subreddit.name`").alias("subreddit_name"))
    return R.sort_by(groups.agg(F.max("score").alias("top_score")), "subreddit_name")
