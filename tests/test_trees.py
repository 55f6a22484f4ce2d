import random

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from remarklab.operators import features as V, profile as P, trees as R


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        x = [rng.gauss(0, 1) for _ in range(5)]
        rows.append((i, x, float((x[0] > 0) + (x[1] * x[2] > 0.3))))
    df = spark.createDataFrame(rows, "id int, features array<double>, label double")
    return df.withColumn("v", array_to_vector("features"))


@pytest.mark.parametrize("kind", ["forest", "tree"])
def test_node_table_predicts_as_the_library(spark, labelled, kind):
    maker = RandomForestClassifier(numTrees=7, maxDepth=6, seed=3) if kind == "forest" else DecisionTreeClassifier(maxDepth=5)
    model = maker.setFeaturesCol("v").fit(labelled)
    nodes = R.forest_nodes(model, spark)
    assert nodes.filter("node = 0").count() == (7 if kind == "forest" else 1)
    want = {r.id: (r.p, r.prediction) for r in model.transform(labelled).select("id", vector_to_array("probability").alias("p"), "prediction").collect()}
    out = R.predict_nodes(labelled.select("id", "features"), nodes)
    for r in out.collect():
        assert r.probability == pytest.approx(want[r.id][0]) and r.prediction == want[r.id][1]
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


def test_odd_node_tables(spark):
    leaf = (0, 0, None, None, None, None, [0.5, 0.5])
    df = spark.createDataFrame([(1, [0.0, None]), (2, None)], "id int, features array<double>")
    got = R.predict_nodes(df, spark.createDataFrame([leaf], R.SCHEMA)).orderBy("id").collect()
    assert [(r.probability, r.prediction) for r in got] == [([0.5, 0.5], 0.0)] * 2
    split = [(0, 0, 1, 1.0, 1, 2, None), (0, 1, None, None, None, None, [1.0, 0.0]), (0, 2, None, None, None, None, [0.0, 1.0])]
    assert [r.prediction for r in R.predict_nodes(df, spark.createDataFrame(split, R.SCHEMA)).collect()] == [1.0, 1.0]
    for bad in ([(0, 1, None, None, None, None, [1.0])], [(0, 0, 0, 1.0, 0, 0, None)]):
        with pytest.raises(ValueError):
            R.predict_nodes(df, spark.createDataFrame(bad, R.SCHEMA))


def test_buckets_add_up_their_terms(spark):
    df = spark.createDataFrame([("1", ["a", "b", "a", "c"]), ("2", ["c"]), ("3", None)], "id string, tokens_cleaned array<string>")
    rows = {(r.id, r.bucket): r for r in V.bucket_tfidf(df, 1).collect()}
    assert {k: r.tf for k, r in rows.items()} == {("1", 0): 4, ("2", 0): 1}
    many = V.bucket_frequency(df, 10**6).collect()
    assert sorted((r.id, r.tf) for r in many) == [("1", 1), ("1", 1), ("1", 2), ("2", 1)]
    one = df.select(V.term_bucket(F.lit("a"), 2**32).alias("x")).first().x
    assert one == int("0cc175b9", 16)


def test_sketches_merge_within_their_error(spark):
    df = spark.range(60000).select((F.col("id") % 6).alias("day"), (F.col("id") * 7 % 25000).alias("user")).unionByName(
        spark.createDataFrame([(9, None), (9, 5)], "day bigint, user bigint"))
    days = P.distinct_sketches(df, "day", "user")
    merged = {r.key: r for r in P.merge_sketches(days, F.floor(F.col("day") / 3)).collect()}
    exact = {r.k: r.n for r in df.groupBy(F.floor(F.col("day") / 3).alias("k")).agg(F.count_distinct("user").alias("n")).collect()}
    assert {k: r.n for k, r in merged.items()} == {0: 30000, 1: 30000, 3: 1}
    for k, r in merged.items():
        assert spark.range(1).select(P.within_error(F.lit(r.estimate), F.lit(exact[k]))).first()[0]
