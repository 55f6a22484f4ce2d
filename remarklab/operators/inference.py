"""Topic mixtures of texts under a given topic-term table, as expressions.

The mixture is the fixed point of the usual variational updates for latent Dirichlet allocation, after a fixed number
of rounds from the same start, so it needs no fitted model object and is the same under any partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import DEFAULTS
from ..functions.text import bind
from ..schema import c
from .features import term_frequency
from .joins import lookup_join

ROUNDS = 20


def digamma(x: Column) -> Column:
    """Digamma of a positive number: six steps up, then the asymptotic series (to about 1e-10)."""
    def series(z: Column) -> Column:
        r = 1.0 / (z * z)
        return F.log(z) - 0.5 / z - r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r / 240)))

    steps = 1.0 / x
    for i in range(1, 6):
        steps = steps + 1.0 / (x + float(i))
    return bind(x + 6.0, series) - steps


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def _dot(one: Column, other: Column) -> Column:
    return _sum(F.zip_with(one, other, lambda x, y: x * y))


def expected_weights(gamma: Column) -> Column:
    """exp of the expected log share of each topic under a Dirichlet with these parameters."""
    return bind(gamma, lambda g: bind(digamma(_sum(g)), lambda all_: F.transform(g, lambda x: F.exp(digamma(x) - all_))))


def fixed_point(terms: Column, topics: int, alpha: float, rounds: int = ROUNDS) -> Column:
    """Dirichlet parameters of a text's topics after ``rounds`` updates; ``terms`` is an array of (tf, weights by topic)."""
    zeros = F.array_repeat(F.lit(0.0), topics)

    def update(gamma: Column, _: Column) -> Column:
        def shares(e: Column) -> Column:
            found = F.aggregate(terms, zeros, lambda a, t: bind(
                t["tf"] / (_dot(e, t["weights"]) + 1e-100), lambda share: F.zip_with(a, t["weights"], lambda x, w: x + share * w)))
            return F.zip_with(found, e, lambda s, x: alpha + x * s)

        return bind(expected_weights(gamma), shares)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.array_repeat(F.lit(1.0), topics), update)


def infer_topics(
    df: DataFrame, topic_terms: DataFrame, topics: int, alpha: float | None = None, rounds: int = ROUNDS,
    tokens: str = "tokens_cleaned", key: str = "id", max_rows: int = DEFAULTS.broadcast_rows,
) -> DataFrame:
    """(key, n_terms, mixture, log_likelihood) of every row with a term of the table.

    ``topic_terms`` has (term, weights): the weight of a term in each topic. ``alpha`` is the prior of each
    topic, 1 / topics by default. ``mixture`` adds up to 1; ``log_likelihood`` is that of the row's known tokens under
    it. Terms are counted in their row, meet the table in a broadcast join (a salted one beyond ``max_rows``) and come
    back to the row; keys must be unique.
    """
    alpha = 1.0 / topics if alpha is None else alpha
    known = lookup_join(term_frequency(df, tokens, key), topic_terms.select("term", "weights"), "term", max_rows=max_rows, salt_on=[key])
    # a text's own terms, in their order
    rows = known.groupBy(c(key).alias(key)).agg(F.sort_array(F.collect_list(F.struct("term", F.col("tf").cast("double").alias("tf"), "weights"))).alias("__terms"))
    gamma = fixed_point(F.col("__terms"), topics, alpha, rounds)
    mixed = rows.withColumn("mixture", bind(gamma, lambda g: bind(_sum(g), lambda total: F.transform(g, lambda x: x / total))))
    likelihood = _sum(F.transform("__terms", lambda t: t["tf"] * F.log(_dot(F.col("mixture"), t["weights"]) + 1e-100)))
    n_terms = _sum(F.transform("__terms", lambda t: t["tf"])).cast("bigint")
    return mixed.select(c(key), n_terms.alias("n_terms"), "mixture", likelihood.alias("log_likelihood"))


def topic_term_table(model, vocabulary: list[str], df: DataFrame) -> DataFrame:
    """(term, weights) of a fitted model of the library: each topic's term probabilities, by term."""
    matrix = model.topicsMatrix().toArray()  # vocabulary x topics, on the driver with the model
    shares = matrix / matrix.sum(axis=0)
    return df.sparkSession.createDataFrame([(w, [float(x) for x in shares[i]]) for i, w in enumerate(vocabulary)], "term string, weights array<double>")
