"""Queries of the classification and evaluation operators."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from remarklab.operators import classify as C
from remarklab.operators import evaluate as E
from remarklab.sources import sinks

from .common import COMMENTS, cleaned, cleaned_sql, comments, query, table
from .text import VOCAB
from .topics import K

LABELLED = """labelled AS (SELECT *, CASE WHEN sentiment > 0.1 THEN 'Positive' WHEN sentiment < -0.1 THEN 'Negative'
  ELSE 'Neutral' END AS sentiment_category FROM cleaned WHERE sentiment IS NOT NULL)"""


def with_labelled(select: str):
    return lambda: f"WITH {COMMENTS},\n{cleaned_sql()},\n{LABELLED}\n{select}"


def labelled(spark, sf):
    return C.prepare_labels_source(cleaned(spark, sf))


@query("prepare_labels_source", with_labelled("SELECT id, sentiment_category, CAST(len(tokens_cleaned) AS INTEGER) AS tokens FROM labelled"))
def prepare_labels_source(spark, sf):
    # without the tokens column, which is then made again from the text
    bare = cleaned(spark, sf).drop("tokens_raw", "tokens_cleaned")
    return C.prepare_labels_source(bare).select("id", "sentiment_category", F.size("tokens_cleaned").alias("tokens"))


@query("label_index", with_labelled("""SELECT label, n, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS DOUBLE) AS label_id
       FROM (SELECT sentiment_category AS label, count(*) AS n FROM labelled GROUP BY 1)"""))
def label_index(spark, sf):
    return C.label_index(labelled(spark, sf))


@query("index_labels", with_labelled("""SELECT id, label_id AS label FROM labelled JOIN (
       SELECT sentiment_category, CAST(row_number() OVER (ORDER BY count(*) DESC, sentiment_category) - 1 AS DOUBLE) AS label_id
       FROM labelled GROUP BY 1) USING (sentiment_category)"""))
def index_labels(spark, sf):
    return C.index_labels(labelled(spark, sf))[0].select("id", "label")


# fixed predictions: every fifth document is taken for the next class
def predictions(spark, sf):
    n = F.col("id").cast("bigint")
    return comments(spark, sf, False).select(
        "id",
        (n % 3).cast("double").alias("label"),
        F.when(n % 5 == 0, (n + 1) % 3).otherwise(n % 3).cast("double").alias("prediction"),
        F.when(n % 7 == 0, 0).when(n % 3 == 2, 0).otherwise(n % 3).cast("double").alias("other"),
    )


PREDICTED = """pred AS (SELECT id, CAST(doc_id % 3 AS DOUBLE) AS label,
  CAST(CASE WHEN doc_id % 5 = 0 THEN (doc_id + 1) % 3 ELSE doc_id % 3 END AS DOUBLE) AS prediction,
  CAST(CASE WHEN doc_id % 7 = 0 THEN 0 WHEN doc_id % 3 = 2 THEN 0 ELSE doc_id % 3 END AS DOUBLE) AS other FROM comments)"""


@query("sample_predictions", f"""WITH {COMMENTS},\n{PREDICTED} SELECT id, body, label, prediction FROM pred JOIN (
  SELECT id, body FROM comments) USING (id) ORDER BY id LIMIT 1000""")
def sample_predictions(spark, sf):
    rows = comments(spark, sf, False).select("id", "body").join(predictions(spark, sf), "id")
    return sinks.sample_predictions(rows, ["id", "body", "label", "prediction"])


def per_class(prediction: str = "prediction") -> str:
    return f"""k AS (SELECT unnest([0.0, 1.0, 2.0])::DOUBLE AS class),
cls AS (SELECT class, count(*) FILTER (label = class) AS support, count(*) FILTER ({prediction} = class) AS predicted,
  count(*) FILTER (label = class AND {prediction} = class) AS hits FROM pred, k GROUP BY 1),
pr AS (SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS precision, CASE WHEN support = 0 THEN 0 ELSE hits / support END AS recall FROM cls),
met AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM pr)"""


SUMMARY = """SELECT round(sum(hits) / sum(support), 6) AS accuracy, round(sum(f1 * support) / sum(support), 6) AS f1,
  round(sum(precision * support) / sum(support), 6) AS precision, round(sum(recall * support) / sum(support), 6) AS recall FROM met"""


def with_pred(select: str, prediction: str = "prediction") -> str:
    return f"WITH {COMMENTS},\n{PREDICTED},\n{per_class(prediction)}\n{select}"


@query("evaluate", with_pred(SUMMARY))
def evaluate(spark, sf):
    return E.evaluate(predictions(spark, sf))


@query("evaluate_missing_class", with_pred(SUMMARY, "other"))
def evaluate_missing_class(spark, sf):
    return E.evaluate(predictions(spark, sf), prediction="other")


@query("confusion_matrix", with_pred("""SELECT a.class AS label, b.class AS prediction, coalesce(n, 0) AS n FROM k a CROSS JOIN k b LEFT JOIN (
  SELECT label, other, count(*) AS n FROM pred GROUP BY 1, 2) c ON a.class = c.label AND b.class = c.other"""))
def confusion_matrix(spark, sf):
    return E.confusion_matrix(predictions(spark, sf), prediction="other")


@query("confusion_pivot", with_pred("""SELECT label, count(*) FILTER (prediction = 0) AS predicted_0, count(*) FILTER (prediction = 1) AS predicted_1,
  count(*) FILTER (prediction = 2) AS predicted_2 FROM pred GROUP BY 1"""))
def confusion_pivot(spark, sf):
    return E.confusion_pivot(predictions(spark, sf), [0, 1, 2])


@query("per_class_report", with_pred("""SELECT CAST(class AS VARCHAR) AS class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM met
  UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM met
  UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
         round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM met""", "other"))
def per_class_report(spark, sf):
    return E.per_class_report(predictions(spark, sf), prediction="other")


def compare(spark, sf):
    rows = predictions(spark, sf)
    return E.compare_models({"first": E.evaluate(rows), "second": E.evaluate(rows, prediction="other")})


def both_sql() -> str:
    renamed = per_class("other")
    for name in ("met", "cls", "pr"):
        renamed = renamed.replace(f"{name} AS (", f"{name}2 AS (").replace(f"FROM {name})", f"FROM {name}2)")
    renamed = renamed.split("\n", 1)[1].replace("FROM pr2ed", "FROM pred")
    return (f"WITH {COMMENTS},\n{PREDICTED},\n{per_class()},\n{renamed},\n"
            f"both_models AS (SELECT 'first' AS model, * FROM ({SUMMARY}) UNION ALL SELECT 'second', * FROM ({SUMMARY.replace('FROM met', 'FROM met2')}))")


@query("compare_models", lambda: both_sql() + " SELECT * FROM both_models")
def compare_models(spark, sf):
    return compare(spark, sf)


@query("best_model", lambda: both_sql() + " SELECT * FROM both_models ORDER BY f1 DESC, model DESC LIMIT 1")
def best_model(spark, sf):
    return E.best_model(compare(spark, sf), "f1")


@query("best_model_by_accuracy", lambda: both_sql() + " SELECT * FROM both_models ORDER BY accuracy DESC, model DESC LIMIT 1")
def best_model_by_accuracy(spark, sf):
    return E.best_model(compare(spark, sf), "accuracy")


@query("naive_bayes_closed_form", lambda: f"""WITH {COMMENTS},\n{cleaned_sql()},\n{LABELLED},\n{VOCAB.format(3000, 3).replace('FROM cleaned', 'FROM labelled')},
w AS (SELECT id, term, tf * ln(((SELECT count(*) FROM labelled) + 1) / (doc_count + 1)) AS x FROM tf JOIN vocab USING (term)),
sums AS (SELECT sentiment_category AS label, term, sum(x) AS x FROM w JOIN labelled USING (id) GROUP BY 1, 2),
sizes AS (SELECT sentiment_category AS label, count(*) AS n_c FROM labelled GROUP BY 1),
words_seen AS (SELECT DISTINCT term FROM sums)
SELECT sizes.label, v.term, round(ln(n_c + 1) - ln((SELECT count(*) FROM labelled) + (SELECT count(*) FROM sizes)), 6) AS pi,
  round(ln(coalesce(sums.x, 0) + 1) - ln((SELECT sum(x) FROM sums s2 WHERE s2.label = sizes.label) + (SELECT count(*) FROM words_seen)), 6) AS theta
FROM sizes CROSS JOIN words_seen v LEFT JOIN sums ON sums.label = sizes.label AND sums.term = v.term""")
def naive_bayes_closed_form(spark, sf):
    return C.nb_params(labelled(spark, sf), vocab_size=3000, min_df=3)


def with_topic(spark, sf):
    return cleaned(spark, sf).withColumn("dominant_topic", (F.col("id").cast("bigint") % K).cast("int"))


def experiment(spark, sf, *models):
    """Train and test on the quality labels of documents."""
    quality = table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("id"), F.when(F.col("quality") == 1, "high").otherwise("low").alias("sentiment_category"))
    return C.run_experiment(with_topic(spark, sf).join(quality, "id"), models=models)


TOPIC_INDEX = f"""topic AS (SELECT id, CAST(doc_id % {K} AS VARCHAR) AS label FROM cleaned),
topic_index AS (SELECT label, row_number() OVER (ORDER BY count(*) DESC, label) - 1 AS i FROM topic GROUP BY 1)"""


@query("topic_one_hot", lambda: f"""WITH {COMMENTS},\n{cleaned_sql()},\n{TOPIC_INDEX}
SELECT id, array_to_string(list_transform(range((SELECT count(*) - 1 FROM topic_index)), lambda j: CASE WHEN i = j THEN '1.0' ELSE '0.0' END), ',')
  AS topic_features FROM topic JOIN topic_index USING (label)""")
def topic_one_hot(spark, sf):
    out = C.topic_one_hot(with_topic(spark, sf).select("id", "dominant_topic"))
    return out.select("id", F.array_join(vector_to_array("topic_features"), ",").alias("topic_features"))


@query("assemble_features", lambda: f"""WITH {COMMENTS},\n{cleaned_sql()},\n{VOCAB.format(3000, 3)},\n{TOPIC_INDEX}
SELECT id, CAST((SELECT count(*) FROM vocab) + (SELECT count(*) - 1 FROM topic_index) AS INTEGER) AS width FROM cleaned""")
def assemble_features(spark, sf):
    df = with_topic(spark, sf).select("id", "tokens_cleaned", "dominant_topic")
    out = C.fit_features(df).transform(df)
    return out.select("id", F.size(vector_to_array("features")).alias("width"))


@query("naive_bayes_predictions")
def naive_bayes_predictions(spark, sf):
    run = experiment(spark, sf, "naive_bayes")
    return run.predictions["naive_bayes"].select("id", "sentiment_category", "label", "prediction", "predicted_label")


@query("random_forest_predictions")
def random_forest_predictions(spark, sf):
    run = experiment(spark, sf, "random_forest")
    return run.predictions["random_forest"].select("id", "sentiment_category", "label", "prediction", "predicted_label")


@query("model_comparison")
def model_comparison(spark, sf):
    run = experiment(spark, sf, "naive_bayes", "random_forest")
    return E.compare_models({name: E.evaluate(p) for name, p in run.predictions.items()})


@query("feature_importance")
def feature_importance(spark, sf):
    run = experiment(spark, sf, "random_forest")
    return C.top_features(C.feature_importance(run.models["random_forest"], run.features, run.train), 20)


@query("experiment_info", lambda: f"""WITH {COMMENTS},\n{cleaned_sql()},
run AS (SELECT c.id, c.tokens_cleaned, CASE WHEN quality = 1 THEN 'high' ELSE 'low' END AS label,
  substring(md5(c.id || ':42:split'), 1, 8) < 'cccccccc' AS in_train FROM cleaned c JOIN labels l ON l.doc_id = c.doc_id),
terms AS (SELECT term FROM (SELECT DISTINCT id, unnest(tokens_cleaned) AS term FROM run WHERE in_train) GROUP BY 1 HAVING count(*) >= 3),
sizes AS (SELECT label, count(*) AS n FROM run GROUP BY 1)
SELECT count(*) AS dataset_size, count(*) FILTER (in_train) AS train_size, count(*) FILTER (NOT in_train) AS test_size,
  CAST((SELECT least(count(*), 3000) FROM terms) AS INTEGER) AS feature_size, CAST((SELECT count(*) FROM sizes) AS INTEGER) AS num_classes,
  (SELECT string_agg(label, ',' ORDER BY n DESC, label) FROM sizes) AS class_labels FROM run""")
def experiment_info(spark, sf):
    run = experiment(spark, sf, "naive_bayes")
    info = C.experiment_info(run.train, run.test, run.features, run.labels)
    return info.withColumn("class_labels", F.array_join("class_labels", ","))
