"""Queries of word vectors and nearest neighbours."""

from pyspark.sql import functions as F

from remarklab.operators import embeddings as V
from remarklab.operators.features import vocabulary
from remarklab.session import cache_stage

from .common import COMMENTS, cleaned, cleaned_sql, query, table

WORDS, CONTEXTS, WINDOW, SEARCHED = 400, 40, 2, 20


@query("nearest_embeddings", """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
pairs AS (SELECT q.vec_id AS query, v.vec_id AS neighbour, round(list_cosine_similarity(q.e, v.e), 6) AS cosine
  FROM v q JOIN v ON q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id)
SELECT query, neighbour, cosine, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY cosine DESC, neighbour) AS INTEGER) AS rank FROM pairs) WHERE rank <= 10""")
def nearest_embeddings(spark, sf):
    """Every twentieth vector against all."""
    vectors = table(spark, sf, "embeddings")
    return V.nearest(vectors, vectors.filter("vec_id % 20 = 0"), 10, "vec_id", "embedding")


# the most frequent words, and the first of these as contexts
FREQUENT = f"""places AS (SELECT id, generate_subscripts(tokens_cleaned, 1) AS pos, unnest(tokens_cleaned) AS word FROM cleaned),
frequent AS (SELECT word, row_number() OVER (ORDER BY count(*) DESC, word) AS r FROM places GROUP BY 1 ORDER BY r LIMIT {WORDS}),
pairs AS (SELECT a.word, b.word AS context, count(*) AS n FROM places a JOIN places b
  ON a.id = b.id AND b.pos BETWEEN a.pos - {WINDOW} AND a.pos + {WINDOW} AND b.pos <> a.pos
  WHERE a.word IN (SELECT word FROM frequent) AND b.word IN (SELECT word FROM frequent WHERE r <= {CONTEXTS}) GROUP BY 1, 2),
weighted AS (SELECT word, context, n, greatest(ln(CAST(n AS DOUBLE) * CAST(sum(n) OVER () AS DOUBLE)
  / (CAST(sum(n) OVER (PARTITION BY word) AS DOUBLE) * CAST(sum(n) OVER (PARTITION BY context) AS DOUBLE))), 0.0) AS ppmi FROM pairs),
lengths AS (SELECT word, sqrt(sum(ppmi * ppmi)) AS len FROM weighted GROUP BY 1 HAVING sum(ppmi) > 0),
dots AS (SELECT a.word AS q, b.word AS l, sum(a.ppmi * b.ppmi) AS dot FROM weighted a JOIN weighted b USING (context) GROUP BY 1, 2)"""


def with_words(select: str):
    return lambda: f"WITH {COMMENTS},\n{cleaned_sql()},\n{FREQUENT}\n{select}"


def frequent(rows):
    top = vocabulary(rows, WORDS).orderBy(F.col("corpus_count").desc(), "term").select("term").collect()
    return [r["term"] for r in top]


def stored(spark, sf):
    """The cleaned tokens for several passes, cleaned once and kept as text, and what to release afterwards."""
    kept = cache_stage(cleaned(spark, sf).select(F.array_join("tokens_cleaned", " ").alias("text")))
    return kept.select(F.split("text", " ").alias("tokens_cleaned")), kept


def weights(spark, sf):
    rows, kept = stored(spark, sf)
    words = frequent(rows)
    # a row per pair of the two word lists
    counts = cache_stage(V.context_counts(rows, words, words[:CONTEXTS], WINDOW), durable=True)
    kept.unpersist()
    return V.ppmi(counts), words


@query("word_context_weights", with_words("SELECT word, context, n, round(ppmi, 9) AS ppmi FROM weighted"))
def word_context_weights(spark, sf):
    return weights(spark, sf)[0].withColumn("ppmi", F.round("ppmi", 9))


@query("similar_words", with_words(f"""SELECT query, neighbour, cosine, rank FROM (
  SELECT query, neighbour, cosine, CAST(row_number() OVER (PARTITION BY query ORDER BY cosine DESC, neighbour) AS INTEGER) AS rank FROM (
    SELECT q.word AS query, l.word AS neighbour, round(coalesce(dot, 0) / (q.len * l.len), 6) AS cosine
    FROM lengths q JOIN lengths l ON q.word <> l.word JOIN frequent f ON f.word = q.word AND f.r <= {SEARCHED}
    LEFT JOIN dots d ON d.q = q.word AND d.l = l.word)) WHERE rank <= 5"""))
def similar_words(spark, sf):
    """The most frequent words and the words that stand beside the same words."""
    weighted, words = weights(spark, sf)
    vectors = V.as_vectors(weighted, words[:CONTEXTS])
    return V.nearest(vectors, vectors.filter(F.col("word").isin(words[:SEARCHED])), 5, "word")


@query("mean_word_vectors", with_words(f"""SELECT id, n_words, p.i, round(coalesce(s, 0) / n_words, 6) AS x FROM (
  SELECT id, count(*) AS n_words FROM places WHERE word IN (SELECT word FROM weighted) GROUP BY 1)
  CROSS JOIN (SELECT word AS context, CAST(r - 1 AS INTEGER) AS i FROM frequent WHERE r <= {CONTEXTS}) p
  LEFT JOIN (SELECT id, context, sum(ppmi) AS s FROM places JOIN weighted USING (word) GROUP BY 1, 2) USING (id, context)"""))
def mean_word_vectors(spark, sf):
    """Mean vector of every document's frequent words, an element a row."""
    weighted, words = weights(spark, sf)
    means = V.mean_vectors(cleaned(spark, sf), V.as_vectors(weighted, words[:CONTEXTS]), CONTEXTS)
    return means.select("id", "n_words", F.posexplode("vector").alias("i", "x")).withColumn("x", F.round("x", 6))


@query("word2vec_neighbours")
def word2vec_neighbours(spark, sf):
    """Fitted vectors have no twin in SQL; the search over them has."""
    rows, kept = stored(spark, sf)
    vectors = V.word_vectors(V.fit_word2vec(rows, size=20, vocab_size=WORDS))
    searched = frequent(rows)[:SEARCHED]
    kept.unpersist()
    return V.nearest(vectors, vectors.filter(F.col("word").isin(searched)), 5, "word")
