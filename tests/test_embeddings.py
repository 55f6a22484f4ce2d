import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from remarklab.operators import embeddings as V


def brute(items, queries, k):
    def unit(v):
        v = np.array(v, dtype=float)
        return v / np.linalg.norm(v)

    good = [(i, v) for i, v in items if i is not None and v is not None and len(v) == 3 and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for q, v in queries:
        found = sorted((-round(float(unit(v) @ unit(w)), 6) + 0.0, i) for i, w in good if i != q)[:k]
        out += [(q, i, -s + 0.0, r + 1) for r, (s, i) in enumerate(found)]
    return sorted(out)


def vectors(n, seed=1):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-1.0, 0.5, 1.0, 2.0]) for _ in range(3)]) for i in range(n)]
    rows += [(n, None), (None, [1.0, 1.0, 1.0]), (n + 1, [0.0, 0.0, 0.0]), (n + 2, [1.0, 2.0]), (n + 3, [1.0, None, 2.0]),
             (n + 4, [float("nan"), 1.0, 1.0]), (n + 5, [float("inf"), 1.0, 1.0]), (3, [1.0, 1.0, 1.0]), (4, [2.0, 2.0, 2.0])]
    return rows


def got(df):
    return sorted(tuple(r) for r in df.select("query", "neighbour", "cosine", "rank").collect())


@pytest.mark.parametrize("partitions, products, group_bytes", [(1, 1 << 22, 1 << 20), (5, 64, 1 << 20), (3, 1, 100)])
def test_nearest_equals_brute_force(spark, monkeypatch, partitions, products, group_bytes):
    """Many ties, odd vectors, equal keys, blocks of a few rows, several groups of queries."""
    monkeypatch.setattr(V, "PRODUCTS", products)
    rows = vectors(150)
    df = spark.createDataFrame(rows, "id bigint, vector array<double>").repartition(partitions)
    queries = [(i, v) for i, v in rows if i is not None and v is not None and i % 20 == 0 and i < 150]
    out = V.nearest(df, df.filter("id % 20 = 0"), 4, group_bytes=group_bytes)
    assert got(out) == brute(rows, queries, 4)


def test_nearest_of_words_and_fewer_items_than_k(spark):
    rows = [("b", [1.0, 0.0, 0.0]), ("a", [2.0, 0.0, 0.0]), ("é", [1.0, 1.0, 0.0]), ("z", [3.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "word string, v array<float>")
    assert got(V.nearest(df, df.filter("word = 'z'"), 9, "word", "v")) == [("z", "a", 1.0, 1), ("z", "b", 1.0, 2), ("z", "é", round(math.sqrt(0.5), 6), 3)]


def test_empty_tables(spark):
    df = spark.createDataFrame([], "id bigint, vector array<double>")
    full = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "id bigint, vector array<double>")
    assert got(V.nearest(df, df)) == got(V.nearest(full, df)) == got(V.nearest(df, full)) == []


def sentences(seed=5):
    rng = random.Random(seed)
    return [(f"d{i}", [rng.choice("abcdefgh") for _ in range(rng.randrange(9))] or None) for i in range(60)] + [("n", None), ("e", [])]


def test_context_counts_and_weights(spark):
    rows = sentences()
    df = spark.createDataFrame(rows, "id string, tokens_cleaned array<string>")
    want = {}
    for _, tokens in rows:
        for i, w in enumerate(tokens or []):
            for j in range(max(0, i - 2), min(len(tokens), i + 3)):
                if j != i and w in "abcd" and tokens[j] in "aef":
                    want[w, tokens[j]] = want.get((w, tokens[j]), 0) + 1
    out = V.ppmi(V.context_counts(df.repartition(3), list("abcd"), list("aef"))).collect()
    assert {(r.word, r.context): r.n for r in out} == want
    total = sum(want.values())
    for r in out:
        n_w, n_c = sum(n for (w, _), n in want.items() if w == r.word), sum(n for (_, c), n in want.items() if c == r.context)
        assert r.ppmi == pytest.approx(max(0.0, math.log(r.n * total / (n_w * n_c))), abs=1e-12)


def test_vectors_and_means(spark):
    weights = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 3.0), ("b", "y", 5.0)], "word string, context string, ppmi double")
    vectors = V.as_vectors(weights, ["y", "z", "x"])
    assert sorted((r.word, r.vector) for r in vectors.collect()) == [("a", [3.0, 0.0, 1.0]), ("b", [5.0, 0.0, 0.0])]
    df = spark.createDataFrame([("1", ["a", "b", "a", "q"]), ("2", ["q"]), ("3", None)], "id string, tokens_cleaned array<string>")
    out = V.mean_vectors(df, vectors, 3).collect()
    assert [(r.id, r.n_words, [round(x, 9) for x in r.vector]) for r in out] == [("1", 3, [round(11 / 3, 9), 0.0, round(2 / 3, 9)])]


def test_word2vec_keeps_the_vocabulary_bounded(spark):
    df = spark.createDataFrame([("1", ["a", "b", "a", "c"] * 20), ("2", ["a", "b", "d"] * 20)], "id string, tokens_cleaned array<string>")
    out = V.word_vectors(V.fit_word2vec(df, size=4, vocab_size=3, min_df=1)).collect()
    assert sorted(r.word for r in out) == ["a", "b", "c"] and all(len(r.vector) == 4 for r in out)


def test_word2vec_trains_in_more_tasks_on_more_words(spark, monkeypatch):
    from pyspark.ml.feature import Word2Vec

    df = spark.createDataFrame([(str(i), (["a", "b"] if i % 2 else ["c", "d"]) * 5) for i in range(100)], "id string, tokens_cleaned array<string>")
    seen = []
    monkeypatch.setattr(V, "Word2Vec", lambda **kw: seen.append(kw["numPartitions"]) or Word2Vec(**kw))
    V.fit_word2vec(df, size=4)
    monkeypatch.setattr(V, "WORDS_PER_TASK", 300)
    model = V.fit_word2vec(df, size=4)
    assert seen == [1, 4] and model.getVectors().count() == 4


def test_word_queries_clean_the_texts_once(spark, monkeypatch):
    from entries import embeddings as E

    cleaned_rows = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def tokens(i):
        cleaned_rows.add(1)
        return ["a", "b", f"w{i}", "b", "", "a"]

    rows = spark.range(40).select(F.col("id").cast("string").alias("id"), tokens.asNondeterministic()("id").alias("tokens_cleaned"))
    monkeypatch.setattr(E, "cleaned", lambda *_: rows)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    weighted, words = E.weights(spark, None)
    assert words[:3] == ["a", "b", ""] and weighted.count() > 0
    assert cleaned_rows.value == 40 and spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_context_counts_equal_a_count_by_hand(spark):
    import random
    from collections import Counter

    rng = random.Random(4)
    texts = [[rng.choice(["a", "b", "c", "d", None]) for _ in range(rng.randrange(9))] for _ in range(60)]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "tokens_cleaned array<string>")
    for words, contexts, window in ((["a", "b", "c"], ["b", "d"], 2), (["a"], ["a"], 3), (["a"], [], 2), (["a"], ["b"], 0)):
        want = Counter((t[i], t[j]) for t in texts for i in range(len(t)) for j in range(len(t))
                       if 0 < abs(i - j) <= window and t[i] in words and t[j] in contexts)
        assert {(r.word, r.context): r.n for r in V.context_counts(df, words, contexts, window).collect()} == want
