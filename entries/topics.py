"""Queries of the topic operators.

Fitted models cannot be compared by value, so the relational operators run on a fixed topic
column (document number modulo 5) and on terms counted from it.
"""

from pyspark.sql import Window, functions as F

from remarklab.functions.scores import argmax_topic, bucketize_score, max_topic_prob
from remarklab.operators import topics as T
from remarklab.operators.density import box_stats
from remarklab.operators.rows import top_k_per_group
from remarklab.schema import c
from remarklab.session import cache_stage

from .common import COMMENTS, KEYWORDS, cleaned, cleaned_sql, comments, query, sql_strings, with_cleaned, with_comments

K = 5


def with_topic(df):
    number = F.col("id").cast("bigint")
    return df.withColumn("dominant_topic", (number % K).cast("int")).withColumn(
        "sentiment_label", bucketize_score(c("sentiment"), "label")
    )


TOPICAL = f"""topical AS (SELECT *, CAST(doc_id % {K} AS INTEGER) AS dominant_topic,
  CASE WHEN sentiment IS NULL THEN 'Unknown' WHEN sentiment > 0.1 THEN 'Positive' WHEN sentiment < -0.1 THEN 'Negative'
       ELSE 'Neutral' END AS sentiment_label FROM comments)"""


def with_topical(select: str) -> str:
    return f"WITH {COMMENTS},\n{TOPICAL}\n{select}"


def topical(spark, sf):
    return with_topic(comments(spark, sf, False))


def fixed_terms(spark, sf):
    """(topic, rank, term, weight): the commonest 15 words per fixed topic, weight their share."""
    counts = (
        with_topic(cleaned(spark, sf))
        .select(F.col("dominant_topic").alias("topic"), F.explode("tokens_cleaned").alias("term"))
        .groupBy("topic", "term")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    top = top_k_per_group(counts, "topic", "n", "term", 15)
    total = F.sum("n").over(Window.partitionBy("topic"))
    # 75 rows that every operator below reads more than once
    return cache_stage(top.select("topic", "rank", "term", F.round(F.col("n") / total, 8).alias("weight")), durable=True)


TERMS = f"""tt AS (SELECT topic, term, n, row_number() OVER (PARTITION BY topic ORDER BY n DESC, term) AS rank FROM (
  SELECT CAST(doc_id % {K} AS INTEGER) AS topic, term, count(*) AS n FROM (SELECT doc_id, unnest(tokens_cleaned) AS term FROM cleaned) GROUP BY 1, 2)),
terms AS (SELECT topic, CAST(rank AS INTEGER) AS rank, term, round(n / sum(n) OVER (PARTITION BY topic), 8) AS weight FROM tt WHERE rank <= 15)"""


def with_terms(select: str):
    return lambda: f"WITH {COMMENTS},\n{cleaned_sql()},\n{TERMS},\n{TOPICAL}\n{select}"


SIZES = "SELECT dominant_topic, count(*) AS n FROM topical GROUP BY 1"


@query("topic_corpus", with_cleaned(f"""SELECT id FROM cleaned WHERE list_has_any(tokens_cleaned, [{sql_strings(KEYWORDS)}])"""))
def topic_corpus(spark, sf):
    return T.topic_corpus(cleaned(spark, sf), keywords=KEYWORDS).select("id")


@query("topic_corpus_sampled", with_cleaned(f"""SELECT id FROM cleaned WHERE list_has_any(tokens_cleaned, [{sql_strings(KEYWORDS)}])
       AND substring(md5(id || ':42:topics'), 1, 8) < '{int(0.3 * 16**8):08x}'"""))
def topic_corpus_sampled(spark, sf):
    return T.topic_corpus(cleaned(spark, sf), keywords=KEYWORDS, fraction=0.3).select("id")


@query("argmax_topic", with_comments("""SELECT id, CAST(CASE WHEN doc_id % 11 = 0 THEN -1 WHEN a >= b AND a >= c THEN 0 WHEN b >= c THEN 1 ELSE 2 END AS INTEGER) AS topic,
       CASE WHEN doc_id % 11 = 0 THEN 0.0 ELSE greatest(a, b, c) END AS probability FROM (
         SELECT id, doc_id, CAST(doc_id % 3 AS DOUBLE) AS a, CAST(doc_id % 4 AS DOUBLE) AS b, CAST(doc_id % 5 AS DOUBLE) AS c FROM comments)"""))
def argmax(spark, sf):
    n = F.col("id").cast("bigint")
    mixture = F.when(n % 11 != 0, F.array(*[(n % m).cast("double") for m in (3, 4, 5)]))
    return comments(spark, sf, False).select(
        "id", argmax_topic(mixture).alias("topic"), max_topic_prob(mixture).alias("probability")
    )


@query("topic_counts", with_topical("SELECT dominant_topic, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM topical), 2) AS percentage FROM topical GROUP BY 1"))
def topic_counts(spark, sf):
    return T.topic_counts(topical(spark, sf))


@query("topic_sentiment", with_topical("SELECT dominant_topic, sentiment_label, count(*) AS n FROM topical GROUP BY 1, 2"))
def topic_sentiment(spark, sf):
    return T.topic_sentiment(topical(spark, sf))


PIVOT = """pivoted AS (SELECT dominant_topic, count(*) AS total, count(*) FILTER (sentiment_label = 'Positive') AS positive,
  count(*) FILTER (sentiment_label = 'Neutral') AS neutral, count(*) FILTER (sentiment_label = 'Negative') AS negative
  FROM topical GROUP BY 1),
shares AS (SELECT *, round(100.0 * positive / total, 2) AS positive_pct, round(100.0 * neutral / total, 2) AS neutral_pct,
  round(100.0 * negative / total, 2) AS negative_pct FROM pivoted)"""


def with_pivot(select: str) -> str:
    return f"WITH {COMMENTS},\n{TOPICAL},\n{PIVOT}\n{select}"


@query("pivot_topic_sentiment", with_pivot("SELECT * FROM shares"))
def pivot_topic_sentiment(spark, sf):
    return T.pivot_topic_sentiment(topical(spark, sf))


@query("topic_tendency", with_pivot("""SELECT dominant_topic, positive_pct, neutral_pct, negative_pct,
  CASE WHEN p > q + 10 THEN 'Positive-leaning' WHEN q > p + 10 THEN 'Negative-leaning' ELSE 'Neutral' END AS tendency,
  round(abs(p - q), 2) AS polarization,
  CASE WHEN abs(p - q) > 20 THEN 'High' WHEN abs(p - q) > 10 THEN 'Medium' ELSE 'Low' END AS polarization_level
  FROM (SELECT *, 100.0 * positive / total AS p, 100.0 * negative / total AS q FROM shares)"""))
def topic_tendency(spark, sf):
    return T.topic_tendency(T.pivot_topic_sentiment(topical(spark, sf)))


@query("topic_avg_sentiment", with_topical("""SELECT dominant_topic, round(avg(sentiment), 6) AS avg_sentiment, count(*) AS topic_size
       FROM topical GROUP BY 1 HAVING count(sentiment) > 0"""))
def topic_avg_sentiment(spark, sf):
    return T.topic_avg_sentiment(topical(spark, sf))


@query("largest_topics", with_topical(f"{SIZES} ORDER BY 2 DESC, 1 LIMIT 3"))
def largest_topics(spark, sf):
    return T.largest_topics(T.topic_counts(topical(spark, sf)), 3).select("dominant_topic", "n")


@query("topic_terms_fixed", with_terms("SELECT * FROM terms"))
def topic_terms_fixed(spark, sf):
    return fixed_terms(spark, sf)


@query("topic_similarity", with_terms(f"""SELECT a.topic AS topic_a, b.topic AS topic_b, round(coalesce(s, 0.0), 6) AS similarity FROM
  (SELECT DISTINCT topic FROM terms) a CROSS JOIN (SELECT DISTINCT topic FROM terms) b LEFT JOIN (
    SELECT x.topic AS ta, y.topic AS tb, sum(x.u * y.u) AS s FROM unit x JOIN unit y ON x.w = y.w GROUP BY 1, 2) d
  ON a.topic = d.ta AND b.topic = d.tb""".replace("unit x JOIN unit y", """
    (SELECT topic, w, x / sqrt(sum(x * x) OVER (PARTITION BY topic)) AS u FROM (SELECT topic, w, tf * (ln(6.0 / (1 + count(*) OVER (PARTITION BY w))) + 1) AS x FROM (
       SELECT topic, w, count(*) AS tf FROM (SELECT topic, unnest(regexp_extract_all(term, '\\b\\w\\w+\\b')) AS w FROM terms WHERE rank <= 10) GROUP BY 1, 2))) x JOIN
    (SELECT topic, w, x / sqrt(sum(x * x) OVER (PARTITION BY topic)) AS u FROM (SELECT topic, w, tf * (ln(6.0 / (1 + count(*) OVER (PARTITION BY w))) + 1) AS x FROM (
       SELECT topic, w, count(*) AS tf FROM (SELECT topic, unnest(regexp_extract_all(term, '\\b\\w\\w+\\b')) AS w FROM terms WHERE rank <= 10) GROUP BY 1, 2))) y""")))
def topic_similarity(spark, sf):
    return T.topic_similarity(fixed_terms(spark, sf), K)


@query("topic_coherence", with_terms("SELECT topic, round(1 / (var_pop(weight) + 1e-6), 2) AS coherence FROM terms WHERE rank <= 5 GROUP BY 1"))
def topic_coherence(spark, sf):
    return T.topic_coherence(fixed_terms(spark, sf), digits=2)


@query("topic_top5_weight", with_terms(f"""SELECT t.topic, round(avg(weight), 6) AS avg_weight, coalesce(any_value(s.n), 0) AS topic_size
       FROM terms t LEFT JOIN ({SIZES}) s ON t.topic = s.dominant_topic WHERE rank <= 5 GROUP BY 1"""))
def topic_top5_weight(spark, sf):
    return T.topic_top5_weight(fixed_terms(spark, sf), T.topic_counts(topical(spark, sf)))


@query("keyword_weight_boxes", with_terms("""SELECT topic, count(*) AS n, round(min(weight), 6) AS min, round(quantile_cont(weight, 0.25), 6) AS q1,
       round(quantile_cont(weight, 0.5), 6) AS median, round(quantile_cont(weight, 0.75), 6) AS q3, round(max(weight), 6) AS max
       FROM terms WHERE rank <= 10 GROUP BY 1"""))
def keyword_weight_boxes(spark, sf):
    return box_stats(fixed_terms(spark, sf).filter("rank <= 10"), "weight", "topic").drop("whisker_low", "whisker_high")


@query("describe_topics", with_terms(f"""SELECT s.dominant_topic, s.n, coalesce(string_agg(term, ', ' ORDER BY rank) FILTER (rank <= 3), 'undefined') AS keywords
       FROM ({SIZES}) s LEFT JOIN terms t ON t.topic = s.dominant_topic GROUP BY 1, 2"""))
def describe_topics(spark, sf):
    sizes = T.topic_counts(topical(spark, sf)).select("dominant_topic", "n")
    return T.describe_topics(sizes, fixed_terms(spark, sf))


@query("topic_summary", lambda: f"""WITH {COMMENTS},\n{cleaned_sql()},\n{TERMS},\n{TOPICAL},\n{PIVOT}
SELECT t.topic, string_agg(term, '|' ORDER BY rank) AS keywords, round(sum(weight), 6) AS weight_sum, any_value(s.total) AS document_count,
       any_value(positive_pct) AS positive, any_value(neutral_pct) AS neutral, any_value(negative_pct) AS negative
FROM terms t JOIN shares s ON t.topic = s.dominant_topic WHERE rank <= 10 GROUP BY 1""")
def topic_summary(spark, sf):
    rows = topical(spark, sf)
    out = T.topic_summary(fixed_terms(spark, sf), T.topic_counts(rows), T.pivot_topic_sentiment(rows))
    return out.select(
        "topic", F.array_join("keywords", "|").alias("keywords"),
        F.round(F.aggregate("weights", F.lit(0.0), lambda a, x: a + x), 6).alias("weight_sum"), "document_count",
        "sentiment_distribution.*",
    )


# --- fitted models: checked for shape here and for invariants in the tests ----------------------


def fitted(spark, sf, weights="tfidf", k=K):
    corpus = T.topic_corpus(cleaned(spark, sf), keywords=KEYWORDS, fraction=1.0).select(
        "id", "tokens_cleaned", "sentiment"
    )
    return T.fit_lda(corpus, k=k, min_df=5.0, weights=weights), corpus


@query("lda_topic_terms")
def lda_topic_terms(spark, sf):
    model, corpus = fitted(spark, sf)
    return T.topic_terms(model, corpus)


@query("lda_topic_assign")
def lda_topic_assign(spark, sf):
    model, corpus = fitted(spark, sf)
    return T.topic_assign(model, corpus).select("id", "dominant_topic", "topic_probability")


@query("lda_topic_quality")
def lda_topic_quality(spark, sf):
    model, corpus = fitted(spark, sf)
    return T.topic_quality(model, corpus)


@query("lda_topic_sentiment")
def lda_topic_sentiment(spark, sf):
    model, corpus = fitted(spark, sf)
    assigned = T.topic_assign(model, corpus).withColumn("sentiment_label", bucketize_score(c("sentiment"), "label"))
    pivot = T.pivot_topic_sentiment(assigned)
    return T.topic_summary(T.topic_terms(model, corpus), T.topic_counts(assigned), pivot).select(
        "topic", F.array_join("keywords", "|").alias("keywords"), "document_count"
    )


@query("lda_counts_terms")
def lda_counts_terms(spark, sf):
    model, corpus = fitted(spark, sf, "counts", 10)
    return T.topic_terms(model, corpus, 10)
