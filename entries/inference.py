"""Queries of topic inference over a fixed topic-term table."""

from pyspark.sql import functions as F

from remarklab.operators import inference as I
from remarklab.operators.features import vocabulary

from .common import COMMENTS, cleaned, cleaned_sql, query

TOPICS, TERMS, ROUNDS, ALPHA = 3, 40, 4, 0.4


# a term's weight in topic k: by its rank among the most frequent terms
def weight(rank, k):
    return f"((({rank} * ({k} + 2)) % 7) + 1) / 200.0"


def sql_digamma(x: str) -> str:
    z = f"({x} + 6.0)"
    r = f"(1.0 / ({z} * {z}))"
    steps = " + ".join(f"1.0 / ({x} + {float(i)})" for i in range(6))
    return f"(ln({z}) - 0.5 / {z} - {r} * (1.0 / 12 - {r} * (1.0 / 120 - {r} * (1.0 / 252 - {r} / 240.0))) - ({steps}))"


def rounds_sql() -> str:
    parts = []
    for r in range(ROUNDS):
        parts.append(f"""e{r} AS (SELECT id, k, exp({sql_digamma('g')} - {sql_digamma('total')}) AS e FROM (
  SELECT *, sum(g) OVER (PARTITION BY id) AS total FROM g{r})),
n{r} AS (SELECT id, term, sum(e * w) + 1e-100 AS norm FROM e{r} JOIN doc USING (id, k) GROUP BY 1, 2),
g{r + 1} AS (SELECT id, k, {ALPHA} + any_value(e) * sum(tf / norm * w) AS g FROM e{r} JOIN doc USING (id, k) JOIN n{r} USING (id, term) GROUP BY 1, 2)""")
    return ",\n".join(parts)


@query("infer_topics", lambda: f"""WITH {COMMENTS},\n{cleaned_sql()},
tokens AS (SELECT id, unnest(tokens_cleaned) AS term FROM cleaned),
ranked AS (SELECT term, row_number() OVER (ORDER BY count(*) DESC, term) AS rank FROM tokens GROUP BY 1 ORDER BY rank LIMIT {TERMS}),
topics AS (SELECT CAST(unnest(range({TOPICS})) AS INTEGER) AS k),
doc AS (SELECT id, term, k, CAST(tf AS DOUBLE) AS tf, CAST({weight('rank', 'k')} AS DOUBLE) AS w FROM (
  SELECT id, term, count(*) AS tf FROM tokens GROUP BY 1, 2) JOIN ranked USING (term) CROSS JOIN topics),
g0 AS (SELECT DISTINCT id, k, CAST(1.0 AS DOUBLE) AS g FROM doc),
{rounds_sql()},
mix AS (SELECT id, k, g / sum(g) OVER (PARTITION BY id) AS share FROM g{ROUNDS}),
like_ AS (SELECT id, sum(tf * ln(p + 1e-100)) AS log_likelihood, CAST(sum(tf) AS BIGINT) AS n_terms FROM (
  SELECT id, term, any_value(tf) AS tf, sum(share * w) AS p FROM mix JOIN doc USING (id, k) GROUP BY 1, 2) GROUP BY 1)
SELECT id, n_terms, k AS topic, round(share, 6) AS share, round(log_likelihood, 5) AS log_likelihood FROM mix JOIN like_ USING (id)""")
def infer_topics(spark, sf):
    rows = cleaned(spark, sf)
    top = vocabulary(rows, TERMS).orderBy(F.col("corpus_count").desc(), "term").select("term").collect()
    table = spark.createDataFrame(
        [(r["term"], [((i * (k + 2)) % 7 + 1) / 200.0 for k in range(TOPICS)]) for i, r in enumerate(top, start=1)], "term string, weights array<double>")
    out = I.infer_topics(rows, table, TOPICS, ALPHA, ROUNDS)
    return out.select("id", "n_terms", F.posexplode("mixture").alias("topic", "share"), "log_likelihood").withColumns(
        {"share": F.round("share", 6), "log_likelihood": F.round("log_likelihood", 5)})
