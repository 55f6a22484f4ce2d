"""Word vectors and nearest neighbours.

Vectors come from Word2Vec or from counts of neighbouring words (positive pointwise mutual information).
Neighbours by cosine are found with blocked matrix products: a group of queries of bounded size goes to
all tasks, each task multiplies it with the blocks of its own rows and keeps the best k per query, and
only those are shuffled. The items themselves never move.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from ..config import DEFAULTS
from ..schema import c, compute_once
from ..session import spread_small
from .features import vocabulary
from .joins import lookup_join
from .rows import top_k_per_group

# bytes of queries that are multiplied at once, and products that a task holds at once
GROUP_BYTES = 32 << 20
PRODUCTS = 1 << 22
# words that one task of a Word2Vec fit trains on
WORDS_PER_TASK = 1_000_000


def fit_word2vec(
    df: DataFrame, size: int = 50, vocab_size: int = DEFAULTS.vocab_size, min_df: float = DEFAULTS.min_df,
    tokens: str = "tokens_cleaned", partitions: int | None = None, iterations: int = 1, seed: int = DEFAULTS.seed,
) -> Word2VecModel:
    """Word2Vec over the most frequent terms of at least min_df rows.

    The fit holds all vectors on the driver and in every task, so the vocabulary is bounded: other
    words are left out of the sentences first. ``partitions`` train in parallel and average; by default
    there is one for every ``WORDS_PER_TASK`` words of the vocabulary in the text, so no task trains on more
    than its share of a large corpus.
    """
    found = vocabulary(df, vocab_size, min_df, tokens).select("term", "corpus_count").collect()  # at most vocab_size words
    known = [r["term"] for r in found]
    if partitions is None:
        partitions = max(1, math.ceil(sum(r["corpus_count"] for r in found) / WORDS_PER_TASK))
    kept = df.select(F.filter(c(tokens), lambda t: t.isin(known)).alias("__words")).filter(F.size("__words") > 1)
    return Word2Vec(
        vectorSize=size, minCount=1, numPartitions=partitions, maxIter=iterations, seed=seed, inputCol="__words", outputCol="__vector",
    ).fit(kept)


def word_vectors(model: Word2VecModel) -> DataFrame:
    """(word, vector) of a fitted model, vectors as arrays."""
    return model.getVectors().select("word", vector_to_array("vector").alias("vector"))


def context_counts(
    df: DataFrame, words: list[str], contexts: list[str], window: int = 2, tokens: str = "tokens_cleaned",
) -> DataFrame:
    """(word, context, n): how often a context word stands at most ``window`` places beside a word.

    Pairs are made inside their row and counted on the map side, so nothing but counts of the
    two lists' pairs is shuffled. Repeated words are counted at each of their places. A pair of places is made
    once; which of its words is the context is asked of the counts.
    """
    word_set, context_set = [F.lit(w) for w in words], [F.lit(w) for w in contexts]
    either = [F.lit(w) for w in dict.fromkeys([*words, *contexts])]
    # words of neither list become NULL, so that a pair with one is dropped without another look
    listed = compute_once(df.select(c(tokens).alias("__t")), "__t", F.transform("__t", lambda t: F.when(t.isin(either), t)))
    left = lambda d: F.greatest(F.size("__t") - d, F.lit(0))
    beside = [F.arrays_zip(F.slice("__t", 1, left(d)).alias("a"), F.slice("__t", d + 1, left(d)).alias("b")) for d in range(1, window + 1)]
    pairs = listed.select(F.explode(F.concat(F.array().cast("array<struct<a:string,b:string>>"), *beside)).alias("x")).select("x.*")
    counted = pairs.filter(F.col("a").isNotNull() & F.col("b").isNotNull()).filter(
        F.col("a").isin(context_set) | F.col("b").isin(context_set)).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    ways = F.array(*[F.struct(F.col(w).alias("word"), F.col(x).alias("context")) for w, x in ("ab", "ba")])
    both = counted.select("n", F.explode(ways).alias("x")).select("x.*", "n")
    return both.filter(F.col("word").isin(word_set) & F.col("context").isin(context_set)).groupBy("word", "context").agg(F.sum("n").alias("n"))


def ppmi(counts: DataFrame) -> DataFrame:
    """Adds ``ppmi``: the positive part of ln(n * total / (n of the word * n of the context))."""
    # one row per pair of the two word lists
    total, of_word, of_context = (F.sum("n").over(Window.partitionBy(*by)) for by in ((), ("word",), ("context",)))
    value = F.log(F.col("n").cast("double") * total / (of_word.cast("double") * of_context))
    return counts.withColumn("ppmi", F.greatest(value, F.lit(0.0)))


def as_vectors(weights: DataFrame, contexts: list[str], value: str = "ppmi") -> DataFrame:
    """(word, vector) of long-form weights: an element per context word in the order given, zero where there is no pair."""
    of = F.map_from_entries(F.collect_list(F.struct("context", value)))
    return weights.groupBy("word").agg(of.alias("m")).select(
        "word", F.transform(F.array(*[F.lit(x) for x in contexts]), lambda x: F.coalesce(F.element_at("m", x), F.lit(0.0))).alias("vector"))


def mean_vectors(df: DataFrame, vectors: DataFrame, size: int, tokens: str = "tokens_cleaned", key: str = "id") -> DataFrame:
    """(key, n_words, vector): the mean vector of a row's known words, each at every place; rows without any are left out."""
    words = df.select(c(key).alias("__key"), F.explode(c(tokens)).alias("word"))
    joined = lookup_join(words, vectors.select("word", "vector"), "word", salt_on=["__key"])
    means = joined.groupBy("__key").agg(F.count(F.lit(1)).alias("n_words"), *[F.avg(F.col("vector")[i]).alias(f"__m{i}") for i in range(size)])
    return means.select(F.col("__key").alias(key), "n_words", F.array(*[f"__m{i}" for i in range(size)]).alias("vector"))


def nearest(
    items: DataFrame, queries: DataFrame, k: int = 10, key: str = "id", vector: str = "vector",
    digits: int = 6, group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """(query, neighbour, cosine, rank): the k items of highest cosine for every query, exactly.

    Cosines are compared after rounding to ``digits``; ties go to the smaller key, so the result does not
    depend on blocks or partitions. A query is no neighbour of its own key. Rows whose key or vector is NULL,
    and vectors of length zero, with a NULL or infinite element or of another length, take no part. Queries
    come in groups of at most about ``group_bytes``; each group is one pass over the items.
    """
    kind = items.schema[key].dataType.simpleString()

    def plain(df: DataFrame) -> DataFrame:
        return df.select(c(key).alias("id"), c(vector).cast("array<double>").alias("v")).filter(
            F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))

    asked, rows = plain(queries), spread_small(plain(items))
    size = asked.agg(F.max(F.size("v")).alias("width"), F.count(F.lit(1)).alias("n")).first()
    width = size["width"] or 0
    groups = max(1, math.ceil(size["n"] * width * 8 / group_bytes))
    out = None
    for group in range(groups):
        part = asked.filter((F.size("v") == width) & (F.pmod(F.xxhash64("id"), F.lit(groups)) == group))
        found = _best_of_tasks(rows, part, k, width, kind, digits)
        out = found if out is None else out.unionByName(found)
    return top_k_per_group(out, "query", "cosine", "neighbour", k)


def _best_of_tasks(rows: DataFrame, part: DataFrame, k: int, width: int, kind: str, digits: int) -> DataFrame:
    """The best k items of every task for every query of a group."""
    table = part.toArrow()  # at most about a group's bytes
    ids = table.column("id").to_pylist()
    matrix = np.array(table.column("v").combine_chunks().flatten(), dtype=float).reshape(len(ids), width)
    length = np.linalg.norm(matrix, axis=1)
    shared = rows.sparkSession.sparkContext.broadcast(([i for i, x in zip(ids, length) if x > 0], matrix[length > 0] / length[length > 0, None]))
    most = PRODUCTS

    # refers to nothing of this package, so workers need not have it
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, unit = shared.value
        own = {q: j for j, q in enumerate(query_ids)}
        step = max(k + 1, most // max(len(own), 1))
        # the best pairs so far: query, cosine, key; and each query's k-th cosine
        kept = [np.zeros(0, dtype=np.int64), np.zeros(0), None]
        bound = np.full(len(own), -np.inf)
        for batch in batches:
            if not own:
                continue
            keys, lists = batch.column(0), batch.column(1)
            fitting = np.flatnonzero(np.diff(lists.offsets.to_numpy()) == width)
            for start in range(0, len(fitting), step):
                at = pa.array(fitting[start:start + step])
                block = np.array(lists.take(at).flatten(), dtype=float).reshape(len(at), width)
                names = keys.take(at).to_pylist()
                norm = np.linalg.norm(block, axis=1)
                with np.errstate(divide="ignore", invalid="ignore"):
                    cosine = np.round((block / norm[:, None]) @ unit.T, digits) + 0.0
                cosine[~(norm > 0)] = -np.inf
                for i, name in enumerate(names):
                    if name in own:
                        cosine[i, own[name]] = -np.inf
                least = bound
                if len(names) > k:
                    least = np.maximum(bound, np.partition(cosine, len(names) - k, axis=0)[len(names) - k])
                row, col = np.nonzero((cosine >= least) & (cosine > -np.inf))
                names = np.array(names)
                query = np.concatenate([kept[0], col])
                value = np.concatenate([kept[1], cosine[row, col]])
                name = names[row] if kept[2] is None else np.concatenate([kept[2], names[row]])
                order = np.lexsort((name, -value, query))
                query, value, name = query[order], value[order], name[order]
                place = np.arange(len(query)) - np.searchsorted(query, query)
                first = place < k
                kept = [query[first], value[first], name[first]]
                last = place == k - 1
                bound[query[last]] = value[last]
        if kept[2] is not None and len(kept[0]):
            yield pa.RecordBatch.from_arrays(
                [pa.array([query_ids[j] for j in kept[0]], batch.schema.field(0).type), pa.array(kept[2].tolist(), batch.schema.field(0).type), pa.array(kept[1])],
                names=["query", "neighbour", "cosine"])

    return rows.mapInArrow(best, f"query {kind}, neighbour {kind}, cosine double")
