import math

import pytest
from pyspark.ml.clustering import LDA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from remarklab.operators import inference as I
from remarklab.operators.features import fit_count_vectors


def test_digamma(spark):
    known = {1.0: -0.5772156649015329, 0.5: -1.9635100260214235, 0.1: -10.423754940411076, 10.0: 2.251752589066721, 1234.5: 7.118016238}
    df = spark.createDataFrame([(x,) for x in known], "x double").select("x", I.digamma(F.col("x")).alias("d"))
    for r in df.collect():
        assert r.d == pytest.approx(known[r.x], rel=1e-7)


def psi(x):
    total = 0.0
    while x < 20:
        total, x = total - 1 / x, x + 1
    return total + math.log(x) - 1 / (2 * x) - 1 / (12 * x * x) + 1 / (120 * x**4)


def brute(terms, topics, alpha, rounds):
    gamma = [1.0] * topics
    for _ in range(rounds):
        e = [math.exp(psi(g) - psi(sum(gamma))) for g in gamma]
        norm = [sum(x * w for x, w in zip(e, ws)) for _, ws in terms]
        gamma = [alpha + e[k] * sum(tf / n * ws[k] for (tf, ws), n in zip(terms, norm)) for k in range(topics)]
    return [g / sum(gamma) for g in gamma]


ROWS = [("1", ["a", "b", "a", "q"]), ("2", ["c"] * 9 + ["a"]), ("3", ["q"]), ("4", None), ("5", ["b", "c"])]
WEIGHTS = {"a": [0.7, 0.1], "b": [0.2, 0.3], "c": [0.1, 0.6]}


def test_mixtures_equal_the_updates(spark):
    df = spark.createDataFrame(ROWS, "id string, tokens_cleaned array<string>")
    table = spark.createDataFrame(list(WEIGHTS.items()), "term string, weights array<double>")
    for rows in (500_000, 0):  # broadcast, salted
        out = {r.id: r for r in I.infer_topics(df.repartition(3), table, 2, 0.3, 7, max_rows=rows).collect()}
        assert sorted(out) == ["1", "2", "5"]
        for i, tokens in ROWS:
            if i in out:
                terms = [(tokens.count(w), WEIGHTS[w]) for w in sorted(set(tokens)) if w in WEIGHTS]
                want = brute(terms, 2, 0.3, 7)
                assert out[i].mixture == pytest.approx(want, abs=1e-8) and sum(out[i].mixture) == pytest.approx(1)
                assert out[i].n_terms == sum(tf for tf, _ in terms)
                assert out[i].log_likelihood == pytest.approx(sum(tf * math.log(sum(m * w for m, w in zip(want, ws))) for tf, ws in terms), abs=1e-7)


def test_agrees_with_the_library_on_a_fitted_model(spark):
    """The library infers with expected logarithms of term weights, the table has their means: close, not equal."""
    docs = [(str(i), (["a", "b", "c"] if i % 2 else ["x", "y", "z"]) * (3 + i % 5) + (["a"] if i % 3 else ["x"])) for i in range(60)]
    df = spark.createDataFrame(docs, "id string, tokens_cleaned array<string>")
    bag = fit_count_vectors(df, 10, 1)
    model = LDA(k=2, maxIter=30, seed=5, featuresCol="raw_features").fit(bag.transform(df))
    want = {r.id: r.t for r in model.transform(bag.transform(df)).select("id", vector_to_array("topicDistribution").alias("t")).collect()}
    got = I.infer_topics(df, I.topic_term_table(model, bag.vocabulary, df), 2).collect()
    assert len(got) == 60
    for r in got:
        assert r.mixture == pytest.approx(want[r.id], abs=0.1) and (r.mixture[0] > 0.5) == (want[r.id][0] > 0.5)
