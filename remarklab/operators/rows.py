"""Row selection: filters, de-duplication, previews, sampling, ranking."""

from __future__ import annotations

import math
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import DEFAULTS
from ..functions.lookup import few_rows, with_word_set
from ..functions.text import has_keyword, shorten, strip_token
from ..schema import c, compute_once, quoted, select_existing
from ..session import cache_stage
from .joins import content_key, fits, tokens_in

__all__ = [
    "select_existing", "drop_empty", "drop_null_result", "min_tokens", "keyword_filter",
    "drop_unknown", "recent_only", "both_scores", "distinct_on", "head_samples",
    "bernoulli_sample", "hash_sample", "exact_sample", "train_test_split", "top_k",
    "top_k_per_group", "sort_by",
]


def drop_empty(df: DataFrame, col: str = "body") -> DataFrame:
    return df.filter(c(col).isNotNull() & (c(col) != ""))


def drop_null_result(df: DataFrame, col: str = "cleaned_body") -> DataFrame:
    return df.filter(c(col).isNotNull())


def min_tokens(df: DataFrame, n: int = 5, col: str = "tokens_cleaned") -> DataFrame:
    return df.filter(F.size(c(col)) >= max(n, 1))


def keyword_filter(
    df: DataFrame, keywords, col: str = "tokens_cleaned", strip_punct: bool = False,
    inline_rows: int = DEFAULTS.inline_rows, max_rows: int = DEFAULTS.broadcast_rows,
) -> DataFrame:
    """Rows with at least one keyword among their tokens, ignoring case.

    A list is a hash-set test inside the row, and so is a (lower-case) keyword table of up to
    ``inline_rows`` rows. Of a larger table the ``inline_rows`` keywords that stand in most rows are tested
    inside the row, so rows with one of these don't move. Only the tokens of the others are joined to the keywords
    that occur at all; whether a row has a hit depends on its tokens alone, so hits find their rows by a
    digest of the tokens, not by an id.
    """
    if not isinstance(keywords, DataFrame):
        return df.filter(has_keyword(c(col), keywords, strip_punct))

    def prepared(token: Column) -> Column:
        return strip_token(F.lower(token)) if strip_punct else F.lower(token)

    rows = few_rows(keywords.select("token").distinct(), inline_rows)
    if rows is not None:
        test = with_word_set(rows, lambda known: F.exists(c(col), lambda t: known(prepared(t))))
        return df.filter(F.coalesce(test, F.lit(False)))
    prepared_words = F.array_distinct(F.transform(c(col), lambda t: prepared(t)))
    rows_of = df.select(F.explode(prepared_words).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    met = cache_stage(rows_of.join(keywords.select("token").distinct(), "token", "left_semi"), durable=True)
    common = few_rows(met.orderBy(F.desc("n"), "token").select("token").limit(inline_rows), inline_rows)
    test = with_word_set(common, lambda known: F.exists(c(col), lambda t: known(prepared(t))))
    tested = compute_once(df, "__sure", F.coalesce(test, F.lit(False)))
    names = [c(x) for x in df.columns]
    # the rows still open are few as a rule, and read twice
    rest = cache_stage(tested.filter(~F.col("__sure")).select(*names), durable=True)
    keyed = rest.withColumn("__key", content_key(c(col)))
    hits = tokens_in(keyed.select("__key", prepared_words.alias("__words")), met, "__words", "__key", max_rows).select("__key").distinct()
    return tested.filter("__sure").select(*names).unionByName(keyed.join(hits, "__key", "left_semi").select(*names))


def drop_unknown(df: DataFrame, col: str = "sentiment_category") -> DataFrame:
    return df.filter(c(col) != "Unknown")


def recent_only(df: DataFrame, cutoff: str, col: str = "created_utc") -> DataFrame:
    """Rows at or after ``cutoff`` (UTC); rows without a time go too.

    A column of epoch seconds is compared with a number, so the filter reaches the Parquet scan.
    """
    if dict(df.dtypes)[col] in ("bigint", "int"):
        start = datetime.fromisoformat(cutoff).replace(tzinfo=timezone.utc)
        return df.filter(c(col) >= int(start.timestamp()))
    return df.filter(c(col) >= F.lit(cutoff).cast("timestamp"))


def both_scores(
    df: DataFrame, left: str = "sentiment", right: str = "vader_sentiment",
    n: int | None = None, order: str = "id",
) -> DataFrame:
    """Rows where both scores are known; with ``n``, the first n of them by ``order``."""
    out = df.filter(c(left).isNotNull() & c(right).isNotNull())
    return out if n is None else out.orderBy(c(order)).limit(n)


def tie_break(df: DataFrame, key: str, order) -> Column:
    """A fixed order among rows of equal key and order columns: a hash of all other columns."""
    return F.xxhash64(*[c(x) for x in df.columns if x != key and x not in order])


def distinct_on(
    df: DataFrame, key: str, order: list[str], keep: str = "first", narrow: bool = False,
    max_rows: int = DEFAULTS.broadcast_rows,
) -> DataFrame:
    """One row per key: the first (or last) one in ``order``, ties decided by ``tie_break``.

    An aggregate of the whole row rather than a window, so each task reduces its rows to one per
    key before the shuffle and a key with very many copies costs no more than any other.

    ``narrow=True`` is for tables whose keys mostly occur once: a first look at the key column
    alone finds the repeated keys, and unless these are more than ``max_rows`` only their rows
    are shuffled. All other rows, and so nearly all the text, stay where they are. That look runs
    at once, while the plain form is as lazy as any other operator.
    """
    if narrow:
        # written to the shared folder, so that nothing stays cached
        repeated = cache_stage(
            df.groupBy(c(key).alias("__key")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("__key"),
            durable=True,
        )
        if fits(repeated, max_rows):
            same = c(key).eqNullSafe(F.col("__key"))
            once = df.join(F.broadcast(repeated), same, "left_anti")
            often = df.join(F.broadcast(repeated), same, "left_semi")
            return once.unionByName(distinct_on(often, key, order, keep))
    rest = [name for name in df.columns if name != key and name not in order]
    row = F.struct(*[c(x) for x in order], tie_break(df, key, order).alias("__tie"), *[c(x) for x in rest])
    pick = F.min if keep == "first" else F.max
    picked = df.groupBy(c(key)).agg(pick(row).alias("__row"))
    return picked.select(
        *[c(key) if name == key else F.col("__row")[name].alias(name) for name in df.columns]
    )


def head_samples(
    df: DataFrame, columns: list[str], n: int = 3, truncate: int = 100, order: str | None = None
) -> DataFrame:
    """Sample values in long form: (column_name, sample_no, value), long text shortened."""
    rows = df.orderBy(c(order)).limit(n) if order else df.limit(n)
    ordered = Window.orderBy(c(order)) if order else Window.orderBy(F.monotonically_increasing_id())
    numbered = rows.withColumn("sample_no", F.row_number().over(ordered))
    pairs = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                shorten(c(name).cast("string"), truncate).alias("value"),
            )
            for name in columns
        ]
    )
    return numbered.select("sample_no", F.explode(pairs).alias("p")).select(
        "p.column_name", "sample_no", "p.value"
    )


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Spark's own approximate sample; its rows depend on the partitioning."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def _key_hash(key: str | list[str], seed: int, purpose: str | None = None) -> Column:
    """Hash of key and seed. Selections made one after the other need different purposes: rows
    kept by a first cut at some hash value would all lie on one side of a later cut."""
    names = [key] if isinstance(key, str) else list(key)
    extra = [F.lit(purpose)] if purpose else []
    return F.md5(F.concat_ws(":", *[c(n).cast("string") for n in names], F.lit(str(seed)), *extra))


def _hex_bound(fraction: float) -> str:
    """Eight hexadecimal digits below which the given share of all hashes lies."""
    return format(min(int(fraction * 16**8), 16**8 - 1), "08x")


def hash_sample(
    df: DataFrame, key: str | list[str], fraction: float, seed: int = 42, purpose: str | None = None
) -> DataFrame:
    """Rows whose key hash falls into the given share: the same rows under any partitioning.

    A sample of a sample must name another ``purpose`` (or seed) to be independent of the first.
    """
    if fraction >= 1:
        return df
    return df.filter(F.substring(_key_hash(key, seed, purpose), 1, 8) < _hex_bound(fraction))


def train_test_split(
    df: DataFrame, key: str | list[str], train: float = 0.8, seed: int = 42, mode: str = "hash"
) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts: by key hash, or ``mode='random'`` with Spark's randomSplit."""
    if mode == "random":
        first, second = df.randomSplit([train, 1 - train], seed=seed)
        return first, second
    in_train = F.substring(_key_hash(key, seed, "split"), 1, 8) < _hex_bound(train)
    return df.filter(in_train), df.filter(~in_train)


# so many rows one task may sort
EDGE_ROWS = 1_000_000


def exact_sample(
    df: DataFrame, key: str | list[str], fraction: float | None = None, n: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """Exactly n (or round(fraction x N)) rows without replacement: those of the lowest hashes.

    No sort of the sample: a histogram over hash prefixes finds the prefix in which the n-th row
    lies, and only that prefix is refined, four hash digits at a time, until at most ``EDGE_ROWS``
    rows are left to rank. What lies below is one filter over one scan. Rows of equal key are told
    apart by a hash of the whole row, and copies equal in every column are counted, so no step
    gathers a hot key in one task.
    """
    if n is None:
        n = int(math.floor(df.count() * fraction + 0.5))
    if n <= 0:
        return df.limit(0)
    row_hash = F.md5(F.to_json(F.struct(*[c(x) for x in df.columns])))
    keyed = df.withColumn("__k", _key_hash(key, seed)).withColumn("__r", row_hash)
    columns = [c(x) for x in df.columns]
    sure, at_edge = F.lit(False), F.lit(True)
    for hash_name, start in (("__k", 1), ("__k", 5), ("__r", 1), ("__r", 5)):
        group = F.substring(hash_name, start, 4)
        # at most 65,536 rows
        counts = keyed.filter(at_edge).groupBy(group.alias("g")).count().orderBy("g").collect()
        below, edge = 0, None
        for r in counts:
            if below + r["count"] > n:
                edge = r
                break
            below += r["count"]
        if edge is None:
            return keyed.filter(sure | at_edge).select(*columns)
        n -= below
        sure, at_edge = sure | (at_edge & (group < edge["g"])), at_edge & (group == edge["g"])
        if n == 0:
            return keyed.filter(sure).select(*columns)
        if edge["count"] <= EDGE_ROWS:
            break
    # what is left is few rows, or agrees in 16 hash digits: copies of one row, up to chance
    copies = keyed.filter(at_edge).groupBy(*[c(x) for x in keyed.columns]).count()
    upto = F.sum("count").over(
        Window.orderBy("__k", "__r").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rest = (
        copies.withColumn("__upto", upto)
        .withColumn("__take", F.least("count", F.lit(n) - F.col("__upto") + F.col("count")))
        .filter("__take > 0")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "__take")))
        .select(*columns)
    )
    return keyed.filter(sure).select(*columns).unionByName(rest)


def top_k(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    """First k rows by a column descending, ties by ``tie`` ascending."""
    return df.orderBy(c(by).desc(), c(tie)).limit(k)


def top_k_per_group(
    df: DataFrame, key: str, by: str, tie: str, k: int, rank: str = "rank"
) -> DataFrame:
    """First k rows of every group, with their rank.

    Spark cuts each map task to k rows per group before the shuffle for k up to
    spark.sql.optimizer.windowGroupLimitThreshold; beyond it the rows are first ranked within
    salted parts of the group, which bounds what one task sorts.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    order = (c(by).desc(), c(tie))
    if k > limit:
        salt = F.pmod(F.xxhash64(c(tie)), F.lit(256))
        part = Window.partitionBy(c(key), F.col("__salt")).orderBy(*order)
        df = (
            df.withColumn("__salt", salt)
            .withColumn("__r", F.row_number().over(part))
            .filter(F.col("__r") <= k)
            .drop("__salt", "__r")
        )
    w = Window.partitionBy(c(key)).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def sort_by(df: DataFrame, *names: str) -> DataFrame:
    """Global ascending sort (range partitioned)."""
    return df.orderBy(*[F.col(quoted(n)) for n in names])
