"""Queries of cross-validated tuning, on the quality labels of documents."""

from pyspark.sql import functions as F

from remarklab.config import Settings
from remarklab.operators import tuning as T

from .common import COMMENTS, cleaned, cleaned_sql, query, table

POINTS = {"smoothing": [0.1, 1.0], "vocab_size": [200, 2000]}
MIN_DF = 3

CV = """cv AS (SELECT c.id, c.tokens_cleaned, CASE WHEN quality = 1 THEN 'high' ELSE 'low' END AS label,
  CAST((CAST('0x' || substring(md5(c.id || ':42:fold'), 1, 8) AS BIGINT) * 3) >> 32 AS INTEGER) AS fold
  FROM cleaned c JOIN labels l ON l.doc_id = c.doc_id)"""

# counts of every fold's training part, and its vocabulary
FOLD_VOCABULARY = f"""tf AS (SELECT fold, label, id, term, count(*) AS tf FROM (SELECT fold, label, id, unnest(tokens_cleaned) AS term FROM cv) GROUP BY ALL),
folds AS (SELECT unnest([0, 1, 2]) AS held_out),
training AS (SELECT held_out, label, count(*) AS n_c, CAST(sum(count(*)) OVER (PARTITION BY held_out) AS BIGINT) AS m FROM folds JOIN cv ON fold <> held_out GROUP BY 1, 2),
frequent AS (SELECT held_out, term, CAST(sum(tf) AS BIGINT) AS corpus_count, count(*) AS doc_count FROM folds JOIN tf ON fold <> held_out
  GROUP BY 1, 2 HAVING count(*) >= {MIN_DF}),
vocab AS (SELECT v.*, ln((m + 1) / (doc_count + 1)) AS idf FROM (
  SELECT *, row_number() OVER (PARTITION BY held_out ORDER BY corpus_count DESC, term) AS rank FROM frequent) v
  JOIN (SELECT DISTINCT held_out, m FROM training) USING (held_out) WHERE rank <= {max(POINTS["vocab_size"])})"""

# each row scored by the model of its fold at every grid point
GRID = f"""grid AS (SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS point, smoothing, vocab_size FROM (
  SELECT unnest({POINTS["smoothing"]}) AS smoothing) CROSS JOIN (SELECT unnest({POINTS["vocab_size"]}::BIGINT[]) AS vocab_size) ORDER BY smoothing, vocab_size),
weights AS (SELECT v.held_out, v.term, v.rank, v.idf, k.label, coalesce(sum(tf), 0) * v.idf AS w FROM vocab v CROSS JOIN (SELECT DISTINCT label FROM cv) k
  LEFT JOIN tf ON tf.term = v.term AND tf.fold <> v.held_out AND tf.label = k.label
  GROUP BY v.held_out, v.term, v.rank, v.idf, k.label),
totals AS (SELECT held_out, point, smoothing, label, sum(w) + count(*) * smoothing AS total FROM weights JOIN grid ON rank <= vocab_size
  GROUP BY held_out, point, smoothing, label),
evidence AS (SELECT tf.id, t.point, t.label, sum(tf.tf * w.idf * (ln(w.w + t.smoothing) - ln(t.total))) AS s FROM tf
  JOIN weights w ON w.held_out = tf.fold AND w.term = tf.term JOIN grid g ON w.rank <= g.vocab_size
  JOIN totals t ON t.held_out = w.held_out AND t.point = g.point AND t.label = w.label GROUP BY ALL),
posterior AS (SELECT cv.id, cv.fold, cv.label AS truth, g.point, p.label,
  round(ln(n_c + smoothing) - ln(m + 2 * smoothing) + coalesce(s, 0), 9) AS score
  FROM cv JOIN training p ON p.held_out = cv.fold CROSS JOIN grid g LEFT JOIN evidence e ON e.id = cv.id AND e.point = g.point AND e.label = p.label),
guesses AS (SELECT id, fold, truth, point, label AS prediction FROM (
  SELECT *, row_number() OVER (PARTITION BY id, point ORDER BY score DESC, label) AS r FROM posterior) WHERE r = 1),
scores AS (SELECT point, smoothing, vocab_size, fold, count(*) AS n, count(*) FILTER (prediction = truth) AS hits,
  round(count(*) FILTER (prediction = truth) / count(*), 6) AS accuracy FROM guesses JOIN grid USING (point) GROUP BY ALL)"""


def with_cv(*parts: str):
    return lambda: f"WITH {COMMENTS},\n{cleaned_sql()},\n" + ",\n".join((CV, *parts[:-1])) + f"\n{parts[-1]}"


def quality(spark, sf):
    """Cleaned documents that have a quality label, with their fold."""
    labels = table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("id"), F.when(F.col("quality") == 1, "high").otherwise("low").alias("label"))
    return T.with_folds(cleaned(spark, sf).join(labels, "id").select("id", "tokens_cleaned", "label"))


def grid(spark):
    return T.grid_table(spark, **POINTS)


@query("cv_fold_sizes", with_cv("SELECT fold, label, count(*) AS n FROM cv GROUP BY 1, 2"))
def cv_fold_sizes(spark, sf):
    return T.fold_sizes(quality(spark, sf), "label")


@query("cv_fold_vocabulary", with_cv(FOLD_VOCABULARY, """SELECT held_out, term, CAST(rank AS INTEGER) AS rank, corpus_count, doc_count,
  round(idf, 9) AS idf FROM vocab"""))
def cv_fold_vocabulary(spark, sf):
    counts = T.fold_term_counts(quality(spark, sf), "label")
    return T.fold_vocabulary(counts, max(POINTS["vocab_size"]), MIN_DF).withColumn("idf", F.round("idf", 9))


def cv_predictions(spark, sf):
    return T.naive_bayes_grid_predictions(quality(spark, sf), grid(spark), "label", min_df=MIN_DF)


@query("cv_naive_bayes_predictions", with_cv(FOLD_VOCABULARY, GRID, "SELECT id, fold, truth AS label, point, prediction FROM guesses"))
def cv_naive_bayes_predictions(spark, sf):
    return cv_predictions(spark, sf)


@query("cv_naive_bayes_grid", with_cv(FOLD_VOCABULARY, GRID, "SELECT * FROM scores"))
def cv_naive_bayes_grid(spark, sf):
    return T.grid_scores(cv_predictions(spark, sf), grid(spark))


@query("cv_best_point", with_cv(FOLD_VOCABULARY, GRID, """SELECT point, smoothing, vocab_size, round(avg(accuracy), 6) AS mean_accuracy
  FROM scores GROUP BY ALL ORDER BY mean_accuracy DESC, point LIMIT 1"""))
def cv_best_point(spark, sf):
    return T.best_point(T.grid_scores(cv_predictions(spark, sf), grid(spark)))


@query("cv_random_forest_grid")
def cv_random_forest_grid(spark, sf):
    """Fitted forests have no twin in SQL; the folds, features and metrics around them have."""
    small = Settings(vocab_size=500)
    points = T.grid_table(spark, max_depth=[3, 6], num_trees=[10])
    rows = quality(spark, sf).withColumnRenamed("label", "sentiment_category").drop("fold")
    return T.cross_validate(rows, points, "random_forest", settings=small)
