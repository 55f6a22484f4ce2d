import math

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from entries.common import cleaned
from entries.topics import with_topic
from remarklab.config import Settings
from remarklab.operators import classify as C
from remarklab.operators import evaluate as E
from remarklab.operators import features as X
from remarklab.operators import topics as T


@pytest.fixture(scope="module")
def docs(spark, sf):
    return with_topic(cleaned(spark, sf)).select("id", "cleaned_body", "tokens_cleaned", "sentiment", "dominant_topic").persist()


def test_relational_tfidf_equals_vectors(spark, docs):
    # a minimum frequency alone decides the vocabulary, so ties at its end cannot differ
    model = X.fit_text_vectors(docs, 10**6, 5)
    words = spark.createDataFrame([(i, w) for i, w in enumerate(model.vocabulary)], "i int, term string")
    vec = (
        model.transform(docs)
        .select("id", F.posexplode(vector_to_array("features")).alias("i", "w"))
        .join(words, "i").filter("w > 0").select("id", "term", F.round("w", 8).alias("w"))
    )
    rel = X.tfidf(docs, 10**6, 5).filter("tfidf > 0").select("id", "term", F.round("tfidf", 8).alias("w"))
    assert rel.count() > 1000
    assert vec.exceptAll(rel).count() == 0 and rel.exceptAll(vec).count() == 0


def test_vocabulary_share_and_ties(spark):
    df = spark.createDataFrame([("1", ["w", "z", "z"]), ("2", ["y", "x"]), ("3", None), ("4", [])], "id string, tokens_cleaned array<string>")
    rows = X.vocabulary(df, 3).collect()
    assert [(r.term, r.corpus_count, r.doc_count) for r in rows] == [("z", 2, 1), ("w", 1, 1), ("x", 1, 1)]
    assert rows[0].idf == pytest.approx(math.log(5 / 2))
    assert X.vocabulary(df, 10, 0.3).count() == 0 and X.vocabulary(df, 10, 0.25).count() == 4


def test_empty_vocabulary_is_refused(docs):
    with pytest.raises(ValueError):
        X.fit_text_vectors(docs, 100, 10**6)


def test_naive_bayes_closed_form_equals_fit(spark, docs):
    rows = C.prepare_labels_source(docs)
    indexed, mapping = C.index_labels(rows)
    features = C.fit_features(indexed.drop("dominant_topic"), vocab_size=10**6, min_df=8)
    model = C.train_naive_bayes(features.transform(indexed).select("features", "label"))
    closed = {(r.label, r.term): (r.pi, r.theta) for r in C.nb_params(rows, vocab_size=10**6, min_df=8, digits=9).collect()}
    pi, theta = model.pi.toArray(), model.theta.toArray()
    assert len(closed) == len(mapping.labels) * len(features.vocabulary)
    for i, label in enumerate(mapping.labels):
        for j, term in enumerate(features.vocabulary):
            assert closed[(label, term)][0] == pytest.approx(pi[i], abs=1e-8)
            assert closed[(label, term)][1] == pytest.approx(theta[i][j], abs=1e-8)


def test_lda_invariants(spark, docs):
    model = T.fit_lda(docs, k=3, max_iter=3, min_df=5)
    again = T.fit_lda(docs, k=3, max_iter=3, min_df=5)
    terms = T.topic_terms(model, docs, 10).orderBy("topic", "rank").collect()
    assert [tuple(r)[:3] for r in terms] == [tuple(r)[:3] for r in T.topic_terms(again, docs, 10).orderBy("topic", "rank").collect()]
    assert len(terms) == 30
    for t in range(3):
        weights = [r.weight for r in terms if r.topic == t]
        assert weights == sorted(weights, reverse=True)
    assigned = T.topic_assign(model, docs).select("topic_distribution", "dominant_topic", "topic_probability").collect()
    for r in assigned:
        # a row without any vocabulary term has a mixture of zeros, and the first topic
        total = sum(r.topic_distribution)
        assert total == pytest.approx(1.0) or (total == 0 and r.dominant_topic == 0)
        assert 0 <= r.dominant_topic < 3 and r.topic_probability == max(r.topic_distribution)
    quality = T.topic_quality(model, docs).first()
    assert quality.log_likelihood < 0 < quality.log_perplexity


def test_similarity_and_coherence(spark):
    rows = [(0, 1, "a1", 0.4), (0, 2, "b1", 0.2), (1, 1, "a1", 0.3), (1, 2, "c1", 0.3), (2, 1, "x", 0.5), (2, 2, "d1.", 0.5)]
    terms = spark.createDataFrame(rows, "topic int, rank int, term string, weight double")
    got = {(r.topic_a, r.topic_b): r.similarity for r in T.topic_similarity(terms, 3).collect()}
    shared, own = math.log(4 / 3) + 1, math.log(4 / 2) + 1
    assert got[(0, 1)] == got[(1, 0)] == pytest.approx(shared**2 / (shared**2 + own**2), abs=1e-6)
    assert got[(0, 2)] == 0 and got[(2, 2)] == 1 and len(got) == 9
    coherence = {r.topic: r.coherence for r in T.topic_coherence(terms).collect()}
    assert coherence[2] == pytest.approx(1e6) and coherence[0] == pytest.approx(1 / (0.01 + 1e-6))


def test_tendency_levels(spark):
    rows = [(0, "Positive")] * 7 + [(0, "Negative")] * 3 + [(1, "Neutral")] * 5 + [(2, "Negative")] * 6 + [(2, "Positive")] * 4 + [(2, "Unknown")] * 4
    df = spark.createDataFrame(rows, "dominant_topic int, sentiment_label string")
    got = {r.dominant_topic: (r.tendency, r.polarization_level) for r in T.topic_tendency(T.pivot_topic_sentiment(df)).collect()}
    assert got == {0: ("Positive-leaning", "High"), 1: ("Neutral", "Low"), 2: ("Negative-leaning", "Medium")}


def test_evaluation_equals_the_library(spark):
    rows = [(float(i % 3), float((i * 7) % 4 % 3)) for i in range(200)] + [(2.0, 0.0)] * 20
    df = spark.createDataFrame(rows, "label double, prediction double")
    got = E.evaluate(df, digits=10).first()
    for name, metric in (("accuracy", "accuracy"), ("f1", "f1"), ("precision", "weightedPrecision"), ("recall", "weightedRecall")):
        assert got[name] == pytest.approx(MulticlassClassificationEvaluator(metricName=metric).evaluate(df), abs=1e-9)
    grid = E.confusion_matrix(df, labels=[0.0, 1.0, 2.0, 3.0])
    assert grid.count() == 16 and grid.agg(F.sum("n")).first()[0] == df.count()


def test_best_model_ties(spark):
    rows = [("naive_bayes", 0.9, 0.5, 0.5, 0.5), ("random_forest", 0.8, 0.5, 0.6, 0.6)]
    table = spark.createDataFrame(rows, "model string, accuracy double, f1 double, precision double, recall double")
    assert E.best_model(table, "f1").first().model == "random_forest"
    assert E.best_model(table, "accuracy").first().model == "naive_bayes"
    even = table.withColumn("accuracy", F.lit(0.9))
    assert E.best_model(even, "accuracy").first().model == "naive_bayes"
    assert E.best_model(even, "accuracy", "last").first().model == "random_forest"


def test_experiment(spark, docs, tmp_path):
    run = C.run_experiment(docs, Settings(num_trees=5, max_depth=4))
    assert run.train.count() + run.test.count() == C.prepare_labels_source(docs).count()
    assert run.features.topic_features == 4
    for name, predicted in run.predictions.items():
        assert {r.predicted_label for r in predicted.select("predicted_label").collect()} <= set(run.labels)
    importance = C.feature_importance(run.models["random_forest"], run.features, docs)
    # the terms and the topics but the last
    assert importance.agg(F.sum("importance")).first()[0] == pytest.approx(1)
    assert importance.filter("term LIKE 'topic=%'").count() == 4
    values = [r.importance for r in importance.collect()]
    assert values == sorted(values, reverse=True)
    info = C.experiment_info(run.train, run.test, run.features, run.labels).first()
    assert info.dataset_size == info.train_size + info.test_size and info.num_classes == len(run.labels)
    from remarklab.sources.sinks import load_model, save_model

    save_model(run.features.model, str(tmp_path / "m"))
    loaded = load_model(str(tmp_path / "m")).transform(run.test).select("id", "features")
    assert loaded.exceptAll(run.features.transform(run.test).select("id", "features")).count() == 0


def test_one_topic_gives_no_topic_features(docs):
    single = docs.withColumn("dominant_topic", F.lit(0))
    assert C.topic_one_hot(single) is None
    assert C.fit_features(single).topic_features == 0


def test_unseen_topics_are_zeros(spark, docs):
    """A topic that training never saw, and the last one, have no column."""
    features = C.fit_features(docs.filter("dominant_topic < 3"))
    assert features.topic_features == 2
    rows = features.transform(docs.filter("dominant_topic = 4")).select("topic_features").limit(3).collect()
    assert rows and all(r.topic_features.toArray().tolist() == [0, 0] for r in rows)


def test_vocabulary_bounds_do_not_follow_the_rows(docs):
    whole, part = C.fit_features(docs, vocab_size=50, min_df=2), C.fit_features(docs.limit(60), vocab_size=50, min_df=2)
    assert len(whole.vocabulary) == len(part.vocabulary) == 50


def test_vocabulary_sizes():
    assert C.sized_vocabulary(5) == (1, 3.0) and C.sized_vocabulary(10**6) == (3000, 1000.0)


def test_labels_source_order(spark):
    base = "id string, cleaned_body string, sentiment double"
    df = spark.createDataFrame([("1", "some words here", 0.07), ("2", "more words", None)], base)
    assert [r.sentiment_category for r in C.prepare_labels_source(df).collect()] == ["Neutral"]
    with_score = df.withColumn("vader_sentiment", F.lit(0.07))
    assert [r.sentiment_category for r in C.prepare_labels_source(with_score).collect()] == ["Positive", "Positive"]
    given = with_score.withColumn("sentiment_category", F.lit("Negative"))
    assert {r.sentiment_category for r in C.prepare_labels_source(given).collect()} == {"Negative"}
    with pytest.raises(ValueError):
        C.prepare_labels_source(df.drop("sentiment"))
