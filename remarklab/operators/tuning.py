"""Cross-validated tuning: folds by key hash, features per fold, a parameter grid as a table.

A row's fold depends on its key and the seed only, so folds, scores and the chosen parameters are the
same under any partitioning, and copies of a key never lie on both sides of a fold.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..config import DEFAULTS, Settings
from ..functions.scores import safe_divide
from ..functions.text import term_counts_of
from ..schema import c
from ..session import cache_stage
from .classify import fit_features, index_labels, predict, train_naive_bayes, train_random_forest
from .evaluate import METRICS, evaluate
from .features import term_counts
from .joins import lookup_join
from .rows import _key_hash, top_k_per_group

FOLDS = 3
# columns of a sum per grid point and class; a grid beyond it is scored in parts
SUMS = 200


def fold_number(key: str | list[str], folds: int = FOLDS, seed: int = DEFAULTS.seed) -> Column:
    """Fold of a row, from 0: equal parts of the key's hashes. Independent of samples and splits by the same seed."""
    digits = F.conv(F.substring(_key_hash(key, seed, "fold"), 1, 8), 16, 10).cast("bigint")
    return F.shiftright(digits * folds, 32).cast("int")


def with_folds(df: DataFrame, key: str | list[str] = "id", folds: int = FOLDS, seed: int = DEFAULTS.seed, out: str = "fold") -> DataFrame:
    return df.withColumn(out, fold_number(key, folds, seed))


def fold_split(df: DataFrame, held_out: int, fold: str = "fold") -> tuple[DataFrame, DataFrame]:
    """(training part, held-out part) of one fold."""
    return df.filter(c(fold) != held_out), df.filter(c(fold) == held_out)


def fold_sizes(df: DataFrame, label: str, fold: str = "fold") -> DataFrame:
    """(fold, label, n) of the held-out parts."""
    return df.groupBy(c(fold).alias("fold"), c(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def grid_table(spark: SparkSession, **values: list) -> DataFrame:
    """Every combination of the values, numbered in ``point`` in the order given (the last name varies fastest)."""
    rows = [(i, *combination) for i, combination in enumerate(product(*values.values()))]
    fields = [T.StructField(name, T._infer_type(given[0])) for name, given in values.items()]
    return spark.createDataFrame(rows, T.StructType([T.StructField("point", T.IntegerType()), *fields]))


def fold_term_counts(
    df: DataFrame, label: str, folds: int = FOLDS, tokens: str = "tokens_cleaned", fold: str = "fold",
) -> DataFrame:
    """(held_out, label, term, corpus_count, doc_count) of every fold's training part; term NULL counts its rows.

    The texts are read once for all folds: counts per fold are summed up over the other folds.
    """
    counts = term_counts(df.withColumn("__fold", c(fold)).withColumn("__label", c(label)), tokens, ["__fold", "__label"])
    others = F.filter(F.sequence(F.lit(0), F.lit(folds - 1)), lambda f: f != F.col("__fold"))
    return (
        counts.withColumn("held_out", F.explode(others))
        .groupBy("held_out", F.col("__label").alias("label"), "term")
        .agg(F.sum("corpus_count").alias("corpus_count"), F.sum("doc_count").alias("doc_count")))


def fold_vocabulary(
    counts: DataFrame, vocab_size: int = DEFAULTS.vocab_size, min_df: float = DEFAULTS.min_df,
) -> DataFrame:
    """(held_out, term, rank, corpus_count, doc_count, idf) over the counts of ``fold_term_counts``.

    The most frequent terms of at least min_df training rows of each fold; ties go to the
    alphabetically first term. idf = ln((m + 1) / (doc_count + 1)) for m training rows.
    """
    totals = counts.groupBy("held_out", "term").agg(
        F.sum("corpus_count").alias("corpus_count"), F.sum("doc_count").alias("doc_count"))
    rows = totals.filter(F.col("term").isNull()).select("held_out", F.col("doc_count").alias("__m"))
    terms = totals.filter(F.col("term").isNotNull() & (F.col("doc_count") >= float(min_df)))
    top = top_k_per_group(terms, "held_out", "corpus_count", "term", vocab_size)
    # one row per fold
    idf = F.log((F.col("__m") + 1).cast("double") / (F.col("doc_count") + 1))
    return top.join(F.broadcast(rows), "held_out").withColumn("idf", idf).drop("__m")


def naive_bayes_grid_params(counts: DataFrame, vocab: DataFrame, points: list[tuple[float, int]], labels: list[str]) -> DataFrame:
    """(held_out, term, idf, thetas): log probabilities of a term for every grid point and class, point by point.

    ``points`` are (smoothing, vocabulary size). Terms beyond a point's vocabulary weigh nothing there. The row of
    term NULL holds the classes' log priors, with an idf of 1.
    """
    of_label = {x: F.col("label") == x for x in labels}
    per_term = vocab.join(counts.filter("term IS NOT NULL").select("held_out", "label", "term", F.col("corpus_count").alias("__n")), ["held_out", "term"])
    wide = per_term.groupBy("held_out", "term", "rank", "idf").agg(
        *[(F.coalesce(F.sum(F.when(of_label[x], F.col("__n"))), F.lit(0)) * F.col("idf")).alias(f"__w{j}") for j, x in enumerate(labels)])
    # totals of a fold's vocabulary: a fold's window holds at most its vocabulary
    every = Window.partitionBy("held_out")
    thetas, totals = [], {}
    for i, (smoothing, size) in enumerate(points):
        inside = F.col("rank") <= size
        totals[f"__terms{i}"] = F.count_if(inside).over(every)
        for j in range(len(labels)):
            totals[f"__total{i}_{j}"] = F.sum(F.when(inside, F.col(f"__w{j}"))).over(every)
            value = F.log(F.col(f"__w{j}") + smoothing) - F.log(F.col(f"__total{i}_{j}") + F.col(f"__terms{i}") * smoothing)
            thetas.append(F.when(inside, value).otherwise(0.0))
    terms = wide.withColumns(totals).select("held_out", "term", "idf", F.array(*thetas).alias("thetas"))
    sizes = counts.filter("term IS NULL").groupBy("held_out").agg(
        F.sum("doc_count").alias("__n"), *[F.coalesce(F.sum(F.when(of_label[x], F.col("doc_count"))), F.lit(0)).alias(f"__n{j}") for j, x in enumerate(labels)])
    priors = [F.log(F.col(f"__n{j}") + s) - F.log(F.col("__n") + len(labels) * s) for s, _ in points for j in range(len(labels))]
    return terms.unionByName(sizes.select("held_out", F.lit(None).cast("string").alias("term"), F.lit(1.0).alias("idf"), F.array(*priors).alias("thetas")))


def naive_bayes_grid_predictions(
    df: DataFrame, grid: DataFrame, label: str, folds: int = FOLDS, min_df: float = DEFAULTS.min_df,
    tokens: str = "tokens_cleaned", key: str = "id", fold: str = "fold", digits: int = 9,
) -> DataFrame:
    """(key, fold, label, point, prediction): every row classified by the model that did not see its fold, at every grid point.

    ``grid`` has point, smoothing and vocab_size. The models are those of a multinomial Naive Bayes over
    TF-IDF weights, in closed form, for all folds and points from one pass over the texts; a second pass scores
    each row with sums over its own terms. Scores are compared after rounding, ties go to the first class.
    """
    points = [(r["smoothing"], r["vocab_size"]) for r in grid.orderBy("point").collect()]
    numbers = [r["point"] for r in grid.orderBy("point").select("point").collect()]
    counts = cache_stage(fold_term_counts(df, label, folds, tokens, fold), durable=True)
    # one row per class
    labels = [r[0] for r in counts.filter("term IS NULL").select("label").distinct().orderBy("label").collect()]
    step = max(1, SUMS // max(len(labels), 1))
    out = None
    for i in range(0, len(points), step):
        part = _predictions(df, counts, points[i:i + step], numbers[i:i + step], labels, label, min_df, tokens, key, fold, digits)
        out = part if out is None else out.unionByName(part)
    return out


def _predictions(df, counts, points, numbers, labels, label, min_df, tokens, key, fold, digits) -> DataFrame:
    vocab = fold_vocabulary(counts, max(size for _, size in points), min_df)
    # a fold's terms and its priors under one key
    named = F.concat_ws(":", F.col("held_out").cast("string"), F.col("term")).alias("__entry")
    params = cache_stage(naive_bayes_grid_params(counts, vocab, points, labels).select(named, "idf", "thetas"), durable=True)
    mark = F.array(F.struct(F.lit(None).cast("string").alias("term"), F.lit(1).cast("bigint").alias("tf")))
    entries = F.concat(mark, F.coalesce(term_counts_of(c(tokens)), F.slice(mark, 1, 0)))
    rows = df.select(c(key).alias("__key"), c(fold).alias("fold"), c(label).alias("label"), F.explode(entries).alias("x")).select(
        "__key", "fold", "label", F.concat_ws(":", F.col("fold").cast("string"), "x.term").alias("__entry"), F.col("x.tf").alias("__tf"))
    weight = F.col("__tf") * F.col("idf")
    n = len(labels)
    # partial sums of a row's terms meet before the shuffle: its terms are made in one task
    sums = lookup_join(rows, params, "__entry", salt_on=["__key"]).groupBy("__key", "fold", "label").agg(
        *[F.sum(weight * F.col("thetas")[i]).alias(f"__s{i}") for i in range(len(points) * n)])

    def best(i: int) -> Column:
        scores = [F.struct(F.round(F.col(f"__s{i * n + j}"), digits).alias("s"), F.lit(-j).alias("order"), F.lit(x).alias("label")) for j, x in enumerate(labels)]
        return (F.greatest(*scores) if len(scores) > 1 else scores[0])["label"]

    guesses = F.array(*[F.struct(F.lit(p).alias("point"), best(i).alias("prediction")) for i, p in enumerate(numbers)])
    return sums.select(F.col("__key").alias(key), "fold", "label", F.explode(guesses).alias("g")).select(key, "fold", "label", "g.point", "g.prediction")


def grid_scores(predictions: DataFrame, grid: DataFrame, digits: int = 6) -> DataFrame:
    """(point, grid columns, fold, n, hits, accuracy) of predictions on held-out rows."""
    counts = predictions.groupBy("point", "fold").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("prediction") == F.col("label")).alias("hits"))
    # the grid is a small table of the caller's
    return F.broadcast(grid).join(counts, "point").withColumn("accuracy", F.round(safe_divide(F.col("hits"), F.col("n")), digits))


def best_point(scores: DataFrame, by: str = "accuracy", digits: int = 6) -> DataFrame:
    """The grid point of the highest mean score over the folds, with that mean; ties go to the first point."""
    known = {"fold", "n", "hits", *METRICS}
    names = [x for x in scores.columns if x not in known]
    means = scores.groupBy(*names).agg(F.round(F.avg(by), digits).alias(f"mean_{by}"))
    order = F.struct((-F.col(f"mean_{by}")).alias("value"), F.col("point"), F.struct(*means.columns).alias("row"))
    return means.agg(F.min(order).alias("x")).select("x.row.*")


# what a grid may set for each classifier
TRAINERS: dict[str, Callable] = {
    "naive_bayes": lambda vectors, p, s: train_naive_bayes(vectors, p.get("smoothing", s.smoothing)),
    "random_forest": lambda vectors, p, s: train_random_forest(vectors, p.get("num_trees", s.num_trees), p.get("max_depth", s.max_depth), s.seed),
}


def cross_validate(
    df: DataFrame, grid: DataFrame, model: str, label: str = "sentiment_category", folds: int = FOLDS,
    key: str = "id", settings: Settings = DEFAULTS,
) -> DataFrame:
    """(point, grid columns, fold, n and the metrics) of a classifier fitted for every fold and grid point.

    Features are fitted on each fold's training part only, once per vocabulary size, and stored while its
    points are fitted. A fit is a job of its own over the whole training part; only its metrics, a row each, come back.
    """
    spark = df.sparkSession
    rows = cache_stage(with_folds(index_labels(df, label)[0], key, folds, settings.seed), durable=True)
    points = [r.asDict() for r in grid.orderBy("point").collect()]
    found = []
    for held_out in range(folds):
        train, test = fold_split(rows, held_out)
        for size in dict.fromkeys(p.get("vocab_size", settings.vocab_size) for p in points):
            features = fit_features(train, size, settings=settings)
            vectors = cache_stage(features.transform(train).select("features", "label"))
            try:
                for p in points:
                    if p.get("vocab_size", settings.vocab_size) == size:
                        fitted = TRAINERS[model](vectors, p, settings)
                        scored = predict(fitted, features.transform(test)).select("label", "prediction")
                        found.append((*p.values(), held_out, *evaluate(scored).first()))
            finally:
                vectors.unpersist()
    schema = T.StructType([*grid.schema.fields, T.StructField("fold", T.IntegerType()), *[T.StructField(m, T.DoubleType()) for m in METRICS]])
    return spark.createDataFrame(found, schema)


def tuned_settings(best: DataFrame, settings: Settings = DEFAULTS) -> Settings:
    """The settings with the values of the chosen grid point, for a final fit on all training rows."""
    from dataclasses import fields, replace

    row = best.first().asDict()
    return replace(settings, **{f.name: row[f.name] for f in fields(settings) if f.name in row})
