import random

import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.sql import functions as F

from remarklab.config import Settings
from remarklab.operators import tuning as T
from remarklab.operators.features import fit_text_vectors


def rows(n=120, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        label = rng.choice(["a", "a", "b", "c"])
        words = [rng.choice([label * 2, label * 3, "x", "y", "z", f"w{rng.randrange(30)}"]) for _ in range(rng.randrange(12))]
        out.append((f"id{i}", words, label))
    return out


SCHEMA = "id string, tokens_cleaned array<string>, label string"


@pytest.fixture(scope="module")
def labelled(spark):
    return T.with_folds(spark.createDataFrame(rows(), SCHEMA))


@pytest.fixture(scope="module")
def grid(spark):
    return T.grid_table(spark, smoothing=[0.1, 1.0], vocab_size=[4, 100])


def test_folds_are_about_equal_and_independent_of_partitions(spark):
    df = spark.range(30000).select(F.col("id").cast("string").alias("id"))
    sizes = {r.fold: r["count"] for r in T.with_folds(df, folds=5).groupBy("fold").count().collect()}
    assert sorted(sizes) == [0, 1, 2, 3, 4] and all(5600 < n < 6400 for n in sizes.values())
    one, other = (T.with_folds(df.repartition(n), folds=5).filter("fold = 2").orderBy("id").collect() for n in (1, 7))
    assert one == other
    assert T.with_folds(df, folds=5, seed=1).filter("fold = 2").orderBy("id").collect() != one


def test_copies_of_a_key_share_a_fold(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "id string, x int")
    assert T.with_folds(df).select("id", "fold").distinct().count() == 2


def test_vocabulary_comes_from_the_training_part(spark, labelled):
    counts = T.fold_term_counts(labelled, "label")
    got = {(r.held_out, r.term): (r.rank, r.corpus_count, r.doc_count) for r in T.fold_vocabulary(counts, 10, 2).collect()}
    folds = {r.id: r.fold for r in labelled.collect()}
    for held_out in range(3):
        seen, docs = {}, {}
        for i, words, _ in rows():
            if folds[i] != held_out:
                for w in words:
                    seen[w] = seen.get(w, 0) + 1
                for w in set(words):
                    docs[w] = docs.get(w, 0) + 1
        best = sorted((w for w in seen if docs[w] >= 2), key=lambda w: (-seen[w], w))[:10]
        assert {w: got[held_out, w] for w in best} == {w: (i + 1, seen[w], docs[w]) for i, w in enumerate(best)}
    assert len(got) <= 30


def test_closed_form_predicts_like_the_fitted_model(spark, labelled, grid):
    """Every fold and grid point against a model fitted by the library on that fold's training part."""
    got = {(r.id, r.point): r.prediction for r in T.naive_bayes_grid_predictions(labelled, grid, "label", min_df=2).collect()}
    assert len(got) == 4 * len(rows())
    labels = ["a", "b", "c"]
    indexed = labelled.withColumn("y", F.when(F.col("label") == "a", 0.0).when(F.col("label") == "b", 1.0).otherwise(2.0))
    for p in grid.collect():
        for held_out in range(3):
            train, test = T.fold_split(indexed, held_out)
            vectors = fit_text_vectors(train, p.vocab_size, 2)
            model = NaiveBayes(featuresCol="features", labelCol="y", smoothing=p.smoothing).fit(vectors.transform(train))
            for r in model.transform(vectors.transform(test)).select("id", "rawPrediction", "prediction").collect():
                raw = sorted(r.rawPrediction, reverse=True)
                if raw[0] - raw[1] > 1e-6:
                    assert got[r.id, p.point] == labels[int(r.prediction)]


def test_scores_do_not_depend_on_partitions(spark, labelled, grid):
    def scores(df):
        found = T.grid_scores(T.naive_bayes_grid_predictions(df, grid, "label", min_df=2), grid)
        return sorted(map(tuple, found.collect())), T.best_point(found).collect()

    assert scores(labelled.repartition(1)) == scores(labelled.repartition(9, "label"))


def test_large_grids_are_scored_in_parts(spark, labelled, grid, monkeypatch):
    want = sorted(map(tuple, T.naive_bayes_grid_predictions(labelled, grid, "label", min_df=2).collect()))
    monkeypatch.setattr(T, "SUMS", 3)
    assert sorted(map(tuple, T.naive_bayes_grid_predictions(labelled, grid, "label", min_df=2).collect())) == want


def test_best_point_ties_go_to_the_first(spark):
    scores = spark.createDataFrame(
        [(0, 0.1, 0, 10, 5, 0.5), (0, 0.1, 1, 10, 7, 0.7), (1, 1.0, 0, 10, 6, 0.6), (1, 1.0, 1, 10, 6, 0.6), (2, 2.0, 0, 9, 1, 0.1), (2, 2.0, 1, 9, 1, 0.1)],
        "point int, smoothing double, fold int, n long, hits long, accuracy double")
    best = T.best_point(scores)
    assert [tuple(r) for r in best.collect()] == [(0, 0.1, 0.6)]
    assert T.tuned_settings(best) == Settings(smoothing=0.1)


def test_cross_validation_of_fitted_models(spark, labelled):
    df = labelled.drop("fold").withColumnRenamed("label", "sentiment_category").withColumn("dominant_topic", F.lit(1))
    points = T.grid_table(spark, num_trees=[3], max_depth=[1, 4])
    small = Settings(vocab_size=20, min_df=1.0)
    out = T.cross_validate(df, points, "random_forest", folds=2, settings=small).collect()
    assert [(r.point, r.max_depth, r.fold) for r in sorted(out)] == [(0, 1, 0), (0, 1, 1), (1, 4, 0), (1, 4, 1)]
    assert all(0 <= r.accuracy <= 1 and 0 <= r.f1 <= 1 for r in out)
    bayes = T.cross_validate(df, T.grid_table(spark, smoothing=[0.5]), "naive_bayes", folds=2, settings=small)
    assert bayes.count() == 2 and not spark.sparkContext._jsc.getPersistentRDDs().size()
