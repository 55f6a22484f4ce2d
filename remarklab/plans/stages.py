"""Run the analysis stage by stage, with Parquet between the stages and one session for all."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import DEFAULTS, Settings
from ..functions.scores import ScoreRule, bucketize_score
from ..functions.times import epoch_to_ts
from ..functions.words import seed_lexicon, seed_modifiers
from ..operators import classify, corpus, evaluate, profile, sentiment, topics, words
from ..schema import CLEANED_COLUMNS, SENTIMENT_COLUMNS, TOPIC_COLUMNS, c
from ..sources import readers, sinks


@dataclass(frozen=True)
class Paths:
    """Where the dump is and where stages and reports go."""

    raw_csv: str
    work: str

    def stage(self, name: str) -> str:
        return f"{self.work}/{name}.parquet"

    def report(self, name: str) -> str:
        return f"{self.work}/reports/{name}"

    def model(self, name: str) -> str:
        return f"{self.work}/models/{name}"


@dataclass
class StageResult:
    stage: str
    success: bool
    seconds: float
    error: str | None = None
    metrics: dict = field(default_factory=dict)


@dataclass
class Context:
    spark: SparkSession
    paths: Paths
    settings: Settings = DEFAULTS
    lexicon: DataFrame | None = None
    modifiers: DataFrame | None = None


def _row(df: DataFrame) -> dict:
    return df.first().asDict()


def _write_by_year(df: DataFrame, path: str, columns) -> None:
    """A stage with a folder per year of posting, so that reads of recent years skip the others."""
    rows = df.withColumn("year", F.year(epoch_to_ts(c("created_utc"))))
    sinks.write_stage(rows, path, [*columns, "year"], partition_by="year")


def extract(ctx: Context) -> dict:
    """The dump, or a sample of it, as Parquet."""
    readers.csv_to_parquet_sample(
        ctx.spark, ctx.paths.raw_csv, ctx.paths.stage("sample"), ctx.settings.sample_fraction, ctx.settings.seed
    )
    return {"sampled_rows": ctx.spark.read.parquet(ctx.paths.stage("sample")).count()}


def profile_sample(ctx: Context) -> dict:
    """Descriptive statistics of the sample."""
    df = readers.read_comments_parquet(ctx.spark, ctx.paths.stage("sample"))
    timed = df.withColumn("timestamp", epoch_to_ts(c("created_utc")))
    reports = {
        "table": profile.table_profile(df),
        "completeness": profile.completeness(df),
        "time_range": profile.time_range(timed),
        "by_year": profile.count_by_year(timed),
        "by_group": profile.count_by(df, "subreddit.name", "subreddit_name"),
        "score": profile.describe(df, {"sentiment": c("sentiment"), "body_length": F.length("body")}),
        "score_ranges": profile.score_bucket_counts(df),
        "length_ranges": profile.length_bucket_counts(df),
    }
    for name, frame in reports.items():
        sinks.write_json_report(frame, ctx.paths.report(f"profile_{name}"))
    return {"reports": sorted(reports)}


def clean(ctx: Context) -> dict:
    """Clean and tokenise the sample; the figures come from the one-pass funnel."""
    df = readers.read_comments_parquet(ctx.spark, ctx.paths.stage("sample"))
    _write_by_year(corpus.clean_corpus(df, ctx.settings), ctx.paths.stage("cleaned"), CLEANED_COLUMNS)
    sinks.write_json_report(corpus.cleaning_funnel(df, ctx.settings), ctx.paths.report("cleaning_funnel"))
    cleaned = ctx.spark.read.parquet(ctx.paths.stage("cleaned"))
    sinks.write_json_report(corpus.quality_report(cleaned), ctx.paths.report("cleaning_quality"))
    steps = {r["step"]: r for r in ctx.spark.read.json(ctx.paths.report("cleaning_funnel")).collect()}
    return {
        "initial_records": steps["raw"]["rows_left"],
        "final_records": steps["tokenised"]["rows_left"],
        "data_retention_rate": steps["tokenised"]["retention_pct"],
    }


def score(ctx: Context) -> dict:
    """Lexicon sentiment and its breakdowns."""
    df = readers.read_comments_parquet(ctx.spark, ctx.paths.stage("cleaned"))
    lexicon = ctx.lexicon if ctx.lexicon is not None else seed_lexicon(ctx.spark)
    modifiers = ctx.modifiers if ctx.modifiers is not None else seed_modifiers(ctx.spark)
    s = ctx.settings
    rule = ScoreRule(s.negative_threshold, s.positive_threshold, False, *s.categories, "Unknown")
    scored = sentiment.label_sentiment(sentiment.lexicon_sentiment(df, lexicon, modifiers), rule=rule)
    _write_by_year(scored, ctx.paths.stage("sentiment"), SENTIMENT_COLUMNS)
    stored = ctx.spark.read.parquet(ctx.paths.stage("sentiment"))
    yearly = profile.yearly_sentiment(stored)
    groups = profile.group_sentiment(stored, "subreddit.name", min_n=ctx.settings.group_min_size, name="subreddit_name")
    shares = profile.distribution(stored, "sentiment_category")
    reports = {
        "distribution": shares,
        "by_group": groups,
        "by_year": yearly,
        "by_month": profile.monthly_sentiment(stored),
        "extremes": profile.extremes(yearly, "year"),
        "extremes_by_group": profile.extremes(groups, "subreddit_name", size="comment_count"),
        "words": words.word_frequency(stored, ctx.settings.top_words),
        "words_by_label": words.word_frequency_by(stored, top_n=ctx.settings.top_words_per_label),
        "comparison": sentiment.score_comparison(stored),
    }
    for name, frame in reports.items():
        sinks.write_json_report(frame, ctx.paths.report(f"sentiment_{name}"))
    return {"sentiment_distribution": [r.asDict() for r in shares.collect()]}


def model_topics(ctx: Context) -> dict:
    """Topic model of the comments on the subject."""
    s = ctx.settings
    df = readers.read_first_available(
        ctx.spark, [ctx.paths.stage("sentiment"), ctx.paths.stage("cleaned")], ["tokens_cleaned"]
    )
    # the model may be fitted on a sample; every comment on the subject gets a topic
    rows = topics.topic_corpus(df, s, fraction=1.0)
    model = topics.fit_lda(
        topics.topic_corpus(df, s), s.num_topics, s.topic_iterations, s.seed, s.topic_vocab_size, s.topic_min_df
    )
    column = "vader_sentiment" if "vader_sentiment" in df.columns else "sentiment"
    assigned = topics.topic_assign(model, rows).withColumn("sentiment_label", bucketize_score(c(column), "label"))
    sinks.write_stage(assigned, ctx.paths.stage("topics"), TOPIC_COLUMNS)
    stored = ctx.spark.read.parquet(ctx.paths.stage("topics"))
    terms = topics.topic_terms(model, rows, s.terms_per_topic)
    sizes, pivot = topics.topic_counts(stored), topics.pivot_topic_sentiment(stored)
    reports = {
        "summary": topics.topic_summary(terms, sizes, pivot),
        "quality": topics.topic_quality(model, rows),
        "terms": terms,
        "tendency": topics.topic_tendency(pivot),
        "similarity": topics.topic_similarity(terms, s.num_topics),
        "coherence": topics.topic_coherence(terms),
    }
    for name, frame in reports.items():
        sinks.write_json_report(frame, ctx.paths.report(f"topics_{name}"))
    model.save(ctx.paths.model("topics"))
    return {"num_topics": model.k, "vocabulary_size": len(model.vectors.vocabulary)}


def train_classifiers(ctx: Context) -> dict:
    """Naive Bayes and random forest on the sentiment label."""
    df = readers.read_first_available(
        ctx.spark, [ctx.paths.stage(x) for x in ("topics", "sentiment", "cleaned")], ["tokens_cleaned", "cleaned_body"]
    )
    run = classify.run_experiment(df, ctx.settings, keep=("cleaned_body",))
    # features and models are applied once; all figures come from what is stored
    kept = ["id", "cleaned_body", "sentiment_category", "label", "prediction", "predicted_label"]
    stored = {}
    for name, rows in run.predictions.items():
        path = ctx.paths.stage(f"predictions_{name}")
        sinks.write_stage(rows, path, kept)
        stored[name] = ctx.spark.read.parquet(path)
    comparison = evaluate.compare_models({name: evaluate.evaluate(p) for name, p in stored.items()})
    sinks.write_stage(comparison, ctx.paths.stage("model_comparison"))
    comparison = ctx.spark.read.parquet(ctx.paths.stage("model_comparison"))
    best = _row(evaluate.best_model(comparison, ctx.settings.best_by))
    predicted = stored[best["model"]]
    reports = {
        "experiment": classify.experiment_info(run.train, run.test, run.features, run.labels),
        "models": comparison,
        "classes": evaluate.per_class_report(predicted, "sentiment_category", "predicted_label"),
        "confusion": evaluate.confusion_matrix(predicted, "sentiment_category", "predicted_label", sorted(run.labels)),
        "split": classify.split_label_distribution(run.train, run.test),
    }
    if "random_forest" in run.models:
        importance = classify.feature_importance(run.models["random_forest"], run.features, run.train)
        reports["importance"] = classify.top_features(importance)
    for name, frame in reports.items():
        sinks.write_json_report(frame, ctx.paths.report(f"classifiers_{name}"))
    sample = sinks.sample_predictions(
        predicted, ["id", "cleaned_body", "sentiment_category", "label", "prediction"]
    )
    sinks.write_stage(sample, ctx.paths.stage("sample_predictions"))
    sinks.save_model(run.features.model, ctx.paths.model("features"))
    for name, model in run.models.items():
        model.write().overwrite().save(ctx.paths.model(name))
    return {"models_trained": sorted(run.models), "best_model": best}


STAGES: dict[str, Callable[[Context], dict]] = {
    "extraction": extract,
    "profile": profile_sample,
    "cleaning": clean,
    "sentiment": score,
    "topics": model_topics,
    "classification": train_classifiers,
}


def run_stages(ctx: Context, skip: tuple[str, ...] = (), stages: dict | None = None) -> list[StageResult]:
    """Run the stages in order, leaving out skipped ones and stopping at the first failure."""
    results = []
    for name, stage in (stages or STAGES).items():
        if name in skip:
            continue
        start = time.monotonic()
        try:
            metrics = stage(ctx)
        except Exception as error:
            results.append(StageResult(name, False, time.monotonic() - start, f"{type(error).__name__}: {error}"))
            break
        results.append(StageResult(name, True, time.monotonic() - start, None, metrics))
    return results


def stages_report(spark: SparkSession, results: list[StageResult]) -> DataFrame:
    """One row per stage run, with the share of successful stages and the stage's key figures."""
    done = sum(r.success for r in results)
    rate = round(100.0 * done / len(results), 2) if results else 0.0
    rows = [
        (r.stage, r.success, round(r.seconds, 3), r.error, json.dumps(r.metrics, default=str), len(results), done, rate)
        for r in results
    ]
    return spark.createDataFrame(
        rows,
        "stage string, success boolean, seconds double, error string, key_metrics string, "
        "total_stages int, successful_stages int, success_rate double",
    )
