"""Classifiers of the sentiment label from the text: features, training, prediction."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes, RandomForestClassifier
from pyspark.ml.feature import (
    CountVectorizerModel, IndexToString, OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler,
    VectorSlicer,
)
from pyspark.sql import DataFrame, Window, functions as F

from ..config import DEFAULTS, Settings
from ..functions.scores import bucketize_score
from ..functions.text import remove_stopwords, tokenize
from ..schema import c
from ..session import cache_stage
from .features import fit_text_vectors, term_counts, top_terms
from .rows import drop_unknown, top_k, train_test_split


def prepare_labels_source(df: DataFrame, out: str = "sentiment_category") -> DataFrame:
    """Rows with a known label and with tokens.

    The label is the category column if there is one, else the class of the lexicon score
    (threshold 0.05), else that of the given score (0.1). Missing tokens are made from the text.
    """
    if out not in df.columns:
        if "vader_sentiment" in df.columns:
            df = df.withColumn(out, bucketize_score(c("vader_sentiment"), "vader"))
        elif "sentiment" in df.columns:
            df = df.withColumn(out, bucketize_score(c("sentiment"), "label"))
        else:
            raise ValueError("no category and no score column to derive labels from")
    df = drop_unknown(df, out)
    if "tokens_cleaned" not in df.columns:
        df = df.withColumn("tokens_cleaned", remove_stopwords(tokenize(c("cleaned_body"))))
    return df


def label_index(df: DataFrame, label: str = "sentiment_category") -> DataFrame:
    """(label, n, label_id): ids by falling frequency, ties alphabetical. One row per class."""
    counts = df.groupBy(c(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    order = Window.orderBy(F.col("n").desc(), "label")
    return counts.withColumn("label_id", (F.row_number().over(order) - 1).cast("double"))


def index_labels(df: DataFrame, label: str = "sentiment_category", out: str = "label") -> tuple[DataFrame, StringIndexerModel]:
    """Adds the numeric label and returns the fitted mapping (its ``labels`` list the classes)."""
    model = StringIndexer(inputCol=label, outputCol=out, stringOrderType="frequencyDesc").fit(df)
    return model.transform(df), model


def topic_one_hot(df: DataFrame, topic: str = "dominant_topic", out: str = "topic_features") -> DataFrame | None:
    """One-hot topic vectors; None where fewer than two topics occur."""
    stages = _topic_stages(df, topic, out)
    return Pipeline(stages=stages).fit(df).transform(df) if stages else None


def _topic_stages(df: DataFrame, topic: str, out: str) -> list:
    """One column for each topic but the last (rarest); a topic not seen in training is all zeros, too."""
    n = df.select(c(topic)).na.drop().distinct().count() if topic in df.columns else 0
    if n < 2:
        return []
    return [
        StringIndexer(inputCol=topic, outputCol="topic_indexed", handleInvalid="keep"),
        OneHotEncoder(inputCols=["topic_indexed"], outputCols=["topic_encoded"]),
        VectorSlicer(inputCol="topic_encoded", outputCol=out, indices=list(range(n - 1))),
    ]


def assemble(df: DataFrame, inputs: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=inputs, outputCol=out).transform(df)


def sized_vocabulary(rows: int, settings: Settings = DEFAULTS) -> tuple[int, float]:
    """(vocabulary size, minimum document frequency) for a training set of ``rows`` rows, for those who ask for it.

    The vocabulary shrinks below 10 rows a term and rare terms go beyond 1,000 rows a count, so results
    for sizes apart don't compare; ``fit_features`` uses fixed bounds.
    """
    return max(min(settings.vocab_size, rows // 10), 1), max(settings.min_df, rows * 0.001)


@dataclass(frozen=True)
class Features:
    model: PipelineModel
    topic_features: int
    topic_labels: tuple[str, ...] = ()

    @property
    def vocabulary(self) -> list[str]:
        return next(s for s in self.model.stages if isinstance(s, CountVectorizerModel)).vocabulary

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)


def fit_features(
    train: DataFrame, vocab_size: int | None = None, min_df: float | None = None,
    topic: str = "dominant_topic", settings: Settings = DEFAULTS,
) -> Features:
    """TF-IDF and, if at least two topics occur, one-hot topics, fitted on training rows only.

    Vocabulary bounds default to those of the settings, whatever the number of rows.
    """
    text = fit_text_vectors(
        train, vocab_size or settings.vocab_size, settings.min_df if min_df is None else min_df, out="tfidf_features"
    )
    topics = _topic_stages(train, topic, "topic_features")
    inputs = ["tfidf_features", *(["topic_features"] if topics else [])]
    rest = Pipeline(stages=[*topics, VectorAssembler(inputCols=inputs, outputCol="features")])
    fitted = rest.fit(text.transform(train))
    labels = tuple(fitted.stages[0].labels[:-1]) if topics else ()
    return Features(PipelineModel(stages=[*text.model.stages, *fitted.stages]), len(labels), labels)


def train_naive_bayes(train: DataFrame, smoothing: float = DEFAULTS.smoothing, prediction: str = "prediction"):
    return NaiveBayes(
        featuresCol="features", labelCol="label", predictionCol=prediction, smoothing=smoothing,
        modelType="multinomial",
    ).fit(train)


def train_random_forest(
    train: DataFrame, num_trees: int = DEFAULTS.num_trees, max_depth: int = DEFAULTS.max_depth,
    seed: int = DEFAULTS.seed, prediction: str = "prediction",
):
    return RandomForestClassifier(
        featuresCol="features", labelCol="label", predictionCol=prediction, numTrees=num_trees,
        maxDepth=max_depth, seed=seed,
    ).fit(train)


def predict(model, df: DataFrame, labels: list[str] | None = None, out: str = "predicted_label") -> DataFrame:
    """Adds prediction and probability, and the predicted class name if ``labels`` are given."""
    scored = model.transform(df)
    if labels is None:
        return scored
    return IndexToString(inputCol=model.getPredictionCol(), outputCol=out, labels=list(labels)).transform(scored)


def nb_params(
    df: DataFrame, label: str = "sentiment_category", vocab_size: int = DEFAULTS.vocab_size,
    min_df: float = DEFAULTS.min_df, tokens: str = "tokens_cleaned",
    smoothing: float = DEFAULTS.smoothing, digits: int = 6,
) -> DataFrame:
    """(label, term, pi, theta) of a multinomial Naive Bayes over TF-IDF weights, in closed form.

    pi = ln(n_c + s) - ln(N + k s), theta = ln(w_ct + s) - ln(w_c + V s), one row per class and
    vocabulary term. As a term's idf is the same in every row, w_ct is its count in the class
    times its idf: counts per (class, term) from one pass are enough, no weights per row.
    """
    s = F.lit(float(smoothing))
    counts = term_counts(df, tokens, [label]).withColumnRenamed(label, "label")
    per_term = counts.groupBy("term").agg(
        F.sum("corpus_count").alias("corpus_count"),
        F.sum("doc_count").alias("doc_count"),
        # one entry per class
        F.map_from_entries(F.collect_list(F.struct("label", F.struct("corpus_count", "doc_count")))).alias("per_class"),
    )
    # vocab_size + 1 rows, then one per class: the row of term NULL holds the class sizes
    everywhere = Window.partitionBy()
    is_mark = F.col("term").isNull()
    top = top_terms(per_term, vocab_size, min_df).withColumns(
        {
            "classes": F.first(F.when(is_mark, F.col("per_class")), ignorenulls=True).over(everywhere),
            "n": F.max(F.when(is_mark, F.col("doc_count"))).over(everywhere),
        }
    ).filter(~is_mark)
    idf = F.log((F.col("n") + 1).cast("double") / (F.col("doc_count") + 1))
    in_label = F.element_at("per_class", F.col("label"))["corpus_count"]
    grid = top.select(
        "term", "n", "per_class", idf.alias("idf"), F.size("classes").alias("k"),
        F.explode("classes").alias("label", "size"),
    ).select(
        "label", "term", "n", "k", F.col("size.doc_count").alias("n_c"),
        (F.coalesce(in_label, F.lit(0).cast("bigint")) * F.col("idf")).alias("w_ct"),
    )
    in_class = Window.partitionBy("label")
    w_c, terms = F.sum("w_ct").over(in_class), F.count(F.lit(1)).over(in_class)
    return grid.select(
        "label",
        "term",
        F.round(F.log(F.col("n_c") + s) - F.log(F.col("n") + F.col("k") * s), digits).alias("pi"),
        F.round(F.log(F.col("w_ct") + s) - F.log(w_c + terms * s), digits).alias("theta"),
    )


def feature_importance(model, features: Features, df: DataFrame) -> DataFrame:
    """(feature_index, term, importance) of every feature, most important first; the importances add up to 1.

    Features are the terms of the vocabulary, then the topics, named ``topic=`` and their label.
    """
    weights = model.featureImportances.toArray()
    names = [*features.vocabulary, *(f"topic={x}" for x in features.topic_labels)]
    rows = [(i, w, float(weights[i])) for i, w in enumerate(names)]
    table = df.sparkSession.createDataFrame(rows, "feature_index int, term string, importance double")
    return table.orderBy(F.col("importance").desc(), "feature_index")


def top_features(importance: DataFrame, k: int = 20) -> DataFrame:
    return top_k(importance, "importance", k, "term")


def split_label_distribution(train: DataFrame, test: DataFrame, label: str = "sentiment_category") -> DataFrame:
    """(split, label, n) of both parts."""
    parts = train.select(F.lit("train").alias("split"), c(label).alias("label")).unionByName(
        test.select(F.lit("test").alias("split"), c(label).alias("label"))
    )
    return parts.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))


def experiment_info(train: DataFrame, test: DataFrame, features: Features, labels: list[str]) -> DataFrame:
    """One row: sizes of the data, the features and the classes."""
    counts = (
        train.select(F.lit(1).alias("in_train"))
        .unionByName(test.select(F.lit(0).alias("in_train")))
        .agg(
            F.count(F.lit(1)).alias("dataset_size"),
            F.count_if(F.col("in_train") == 1).alias("train_size"),
            F.count_if(F.col("in_train") == 0).alias("test_size"),
        )
    )
    return counts.withColumns(
        {
            "feature_size": F.lit(len(features.vocabulary)),
            "num_classes": F.lit(len(labels)),
            "class_labels": F.array(*[F.lit(x) for x in labels]),
        }
    )


@dataclass
class Experiment:
    """A finished train-and-test run."""

    labels: list[str]
    features: Features
    train: DataFrame
    test: DataFrame
    rows: DataFrame
    models: dict = field(default_factory=dict)
    predictions: dict[str, DataFrame] = field(default_factory=dict)


def run_experiment(
    df: DataFrame, settings: Settings = DEFAULTS, label: str = "sentiment_category", key: str = "id",
    models: tuple[str, ...] = ("naive_bayes", "random_forest"), keep: tuple[str, ...] = (),
) -> Experiment:
    """Label, split by key hash, fit the features on the training part, train, predict."""
    slim = prepare_labels_source(df, label)
    columns = [x for x in dict.fromkeys([key, label, "tokens_cleaned", "dominant_topic", *keep]) if x in slim.columns]
    # read by several fits and by whoever reads the predictions later: stored, so that nothing stays cached
    rows = cache_stage(slim.select(*[c(x) for x in columns]), durable=True)
    indexed, mapping = index_labels(rows, label)
    train, test = train_test_split(indexed, key, 1 - settings.test_ratio, settings.seed)
    features = fit_features(train, settings=settings)
    run = Experiment(list(mapping.labels), features, train, test, rows)
    vectors = cache_stage(features.transform(train).select("features", "label"))
    try:
        if "naive_bayes" in models:
            run.models["naive_bayes"] = train_naive_bayes(vectors, settings.smoothing)
        if "random_forest" in models:
            run.models["random_forest"] = train_random_forest(
                vectors, settings.num_trees, settings.max_depth, settings.seed
            )
    finally:
        vectors.unpersist()
    held_out = features.transform(test)
    for name, model in run.models.items():
        run.predictions[name] = predict(model, held_out, run.labels)
    return run
