"""Evaluation of predictions as grouped counts; predictions are never collected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scores import safe_divide
from ..schema import c

METRICS = ("accuracy", "f1", "precision", "recall")


def pair_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n): everything the metrics need, at most classes x classes rows."""
    return df.groupBy(c(label).alias("label"), c(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction", labels: list | None = None
) -> DataFrame:
    """Counts over the full label grid, zeros included, in long form, rows ordered by class.

    Without ``labels`` the classes are those that occur as label or as prediction.
    """
    counts = pair_counts(df, label, prediction)
    if labels is None:
        pair = F.explode(F.array("label", "prediction")).alias("k")
        classes = counts.select(pair).agg(F.sort_array(F.collect_set("k")).alias("ks")).scalar()
    else:
        classes = F.array(*[F.lit(x) for x in labels])
    kind = df.schema[label].dataType
    cells = counts.groupBy().agg(
        F.map_from_entries(F.collect_list(F.struct(F.struct("label", "prediction"), "n"))).alias("m")
    )
    grid = (
        cells.withColumn("ks", classes)
        .withColumn("label", F.explode("ks"))
        .withColumn("prediction", F.explode("ks"))
    )
    key = F.struct(F.col("label").cast(kind).alias("label"), F.col("prediction").cast(kind).alias("prediction"))
    value = F.coalesce(F.element_at("m", key), F.lit(0).cast("bigint"))
    return grid.select("label", "prediction", value.alias("n")).orderBy("label", "prediction")


def confusion_pivot(df: DataFrame, labels: list, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row per true class that occurs, one zero-filled column per listed class."""
    return (
        df.groupBy(c(label).alias("label"))
        .agg(*[F.count_if(c(prediction) == F.lit(x)).alias(f"predicted_{x}") for x in labels])
        .orderBy("label")
    )


def _class_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(class, support, predicted, hits) for every class that occurs on either side."""
    counts = pair_counts(df, label, prediction)
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.lit(True).alias("is_label")),
        F.struct(F.col("prediction").alias("class"), F.lit(False).alias("is_label")),
    )
    n, zero = F.col("n"), F.lit(0).cast("bigint")
    return (
        counts.select("n", (F.col("label") == F.col("prediction")).alias("hit"), F.explode(sides).alias("s"))
        .groupBy(F.col("s.class").alias("class"))
        .agg(
            F.sum(F.when(F.col("s.is_label"), n).otherwise(zero)).alias("support"),
            F.sum(F.when(~F.col("s.is_label"), n).otherwise(zero)).alias("predicted"),
            F.sum(F.when(F.col("s.is_label") & F.col("hit"), n).otherwise(zero)).alias("hits"),
        )
    )


def _with_class_metrics(classes: DataFrame) -> DataFrame:
    p, r = safe_divide(F.col("hits"), F.col("predicted")), safe_divide(F.col("hits"), F.col("support"))
    return classes.withColumns({"precision": p, "recall": r}).withColumn(
        "f1", safe_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    )


def evaluate(df: DataFrame, label: str = "label", prediction: str = "prediction", digits: int = 6) -> DataFrame:
    """One row: accuracy and support-weighted F1, precision and recall."""
    classes = _with_class_metrics(_class_counts(df, label, prediction))
    total = F.sum("support")

    def weighted(name: str) -> Column:
        return F.round(safe_divide(F.sum(F.col(name) * F.col("support")), total), digits).alias(name)

    return classes.agg(
        F.round(safe_divide(F.sum("hits"), total), digits).alias("accuracy"),
        weighted("f1"), weighted("precision"), weighted("recall"),
    )


def per_class_report(df: DataFrame, label: str = "label", prediction: str = "prediction", digits: int = 6) -> DataFrame:
    """Precision, recall, F1 and support per class, then their macro and weighted averages."""
    classes = _with_class_metrics(_class_counts(df, label, prediction))
    names = ("precision", "recall", "f1")
    per_class = classes.select(
        F.col("class").cast("string").alias("class"),
        *[F.round(F.col(x), digits).alias(x) for x in names],
        "support",
    )
    total = F.sum("support")
    averages = classes.agg(
        F.struct(F.lit("macro avg").alias("class"), *[F.avg(x).alias(x) for x in names]).alias("m"),
        F.struct(
            F.lit("weighted avg").alias("class"),
            *[safe_divide(F.sum(F.col(x) * F.col("support")), total).alias(x) for x in names],
        ).alias("w"),
        total.alias("support"),
    ).select("support", F.explode(F.array("m", "w")).alias("x"))
    return per_class.unionByName(
        averages.select("x.class", *[F.round(F.col(f"x.{x}"), digits).alias(x) for x in names], "support")
    )


def compare_models(metrics: dict[str, DataFrame]) -> DataFrame:
    """One row of metrics per model name."""
    out = None
    for name, frame in metrics.items():
        row = frame.select(F.lit(name).alias("model"), *METRICS)
        out = row if out is None else out.unionByName(row)
    return out


def best_model(comparison: DataFrame, by: str = "f1", ties: str | None = None) -> DataFrame:
    """The row of the highest metric; ties go to the alphabetically first or last model name.

    By default the last one on F1 (of the usual two, the random forest) and the first on accuracy.
    """
    names = F.struct("model", *METRICS)
    value = F.col(by)
    if (ties or ("first" if by == "accuracy" else "last")) == "first":
        best = F.min(F.struct((-value).alias("value"), names.alias("row")))
    else:
        best = F.max(F.struct(value.alias("value"), names.alias("row")))
    return comparison.agg(best.alias("x")).select("x.row.*")
