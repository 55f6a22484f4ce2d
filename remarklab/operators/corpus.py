"""From raw comments to a cleaned, tokenised corpus, with its quality figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import DEFAULTS, Settings
from ..functions.lookup import few_rows, with_word_set
from ..functions.scores import safe_divide
from ..functions.text import bind, clean_text, remove_stopwords, tokenize
from ..functions.times import epoch_to_text
from ..schema import c, compute_once
from .joins import content_key, tokens_in
from .profile import describe
from .rows import distinct_on, drop_empty, drop_null_result, head_samples, min_tokens, tie_break


def add_clean_text(df: DataFrame, col: str = "body", min_length: int = DEFAULTS.min_text_length) -> DataFrame:
    return compute_once(df, "cleaned_body", clean_text(c(col), min_length))


def _tokens(text: Column, cleaned: bool = True) -> Column:
    return bind(
        tokenize(text, cleaned),
        lambda raw: F.struct(raw.alias("tokens_raw"), remove_stopwords(raw).alias("tokens_cleaned")),
    )


def add_tokens(df: DataFrame, col: str = "cleaned_body", cleaned: bool = True) -> DataFrame:
    kept = [c(x) for x in df.columns if x not in ("tokens_raw", "tokens_cleaned")]
    return compute_once(df, "__t", _tokens(c(col), cleaned)).select(*kept, "__t.*")


def clean_corpus(
    df: DataFrame, settings: Settings = DEFAULTS, dedup_order: tuple[str, ...] | None = ("created_utc",),
    narrow_dedup: bool = False,
) -> DataFrame:
    """De-duplicate, drop empty texts, add time, clean, tokenise, drop short comments.

    Only the de-duplication shuffles (with ``narrow_dedup`` just the rows whose id is repeated, see
    ``distinct_on``); all else happens inside the row. Empty texts go after it: an empty first copy still wins over a later
    one. ``dedup_order=None`` promises distinct ids.
    """
    unique = df if dedup_order is None else distinct_on(df, "id", list(dedup_order), narrow=narrow_dedup)
    timed = drop_empty(unique).withColumn("timestamp", epoch_to_text(c("created_utc")))
    made = bind(
        clean_text(c("body"), settings.min_text_length),
        lambda text: F.struct(
            text.alias("cleaned_body"), remove_stopwords(tokenize(text, cleaned=True), cleaned=True).alias("tokens_cleaned")
        ),
    )
    rows = compute_once(timed, "__x", made).select(*[c(x) for x in timed.columns], "__x.*")
    return min_tokens(drop_null_result(rows), settings.min_tokens)


def cleaning_funnel(
    df: DataFrame, settings: Settings = DEFAULTS, dedup_order: tuple[str, ...] = ("created_utc",)
) -> DataFrame:
    """Rows left after every cleaning step, rows removed by it and the share of all rows left.

    One pass. Every row gets one flag per step; the shuffle by id carries the flags of the copy
    that de-duplication keeps and the number of copies, but no text.
    """
    order = [x for x in dedup_order if x != "id"]
    made = bind(clean_text(c("body"), settings.min_text_length), lambda text: F.struct(
        text.isNotNull().alias("cleaned"),
        F.coalesce(
            F.size(remove_stopwords(tokenize(text, cleaned=True), cleaned=True)) >= max(settings.min_tokens, 1), F.lit(False)
        ).alias("enough"),
    ))
    slim = df.select(
        "id", *[c(x) for x in order], tie_break(df, "id", order).alias("__tie"),
        F.coalesce(c("body") != "", F.lit(False)).alias("__filled"), made.alias("__made"),
    )
    row = F.struct(*[c(x) for x in order], "__tie", "__filled", "__made")
    flagged = (
        slim.groupBy("id")
        .agg(F.count(F.lit(1)).alias("copies"), F.min(row).alias("row"))
        .select(
            "copies",
            F.col("row.__filled").alias("filled"),
            (F.col("row.__filled") & F.col("row.__made.cleaned")).alias("cleaned"),
            F.col("row.__made.enough").alias("enough"),
        )
    )
    steps = ("raw", "deduplicated", "non_empty", "cleaned", "tokenised")
    counts = flagged.agg(
        F.coalesce(F.sum("copies"), F.lit(0).cast("bigint")).alias("raw"),
        F.count(F.lit(1)).alias("deduplicated"),
        F.count_if("filled").alias("non_empty"),
        F.count_if("cleaned").alias("cleaned"),
        F.count_if(F.col("cleaned") & F.col("enough")).alias("tokenised"),
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("step_no"),
                F.lit(step).alias("step"),
                F.col(step).alias("rows_left"),
                (F.col(steps[max(i - 1, 0)]) - F.col(step)).alias("rows_removed"),
                F.round(safe_divide(F.col(step) * 100.0, F.col("raw")), 2).alias("retention_pct"),
            )
            for i, step in enumerate(steps)
        ]
    )
    return counts.select(F.explode(rows).alias("x")).select("x.*")


def quality_report(df: DataFrame, digits: int = 6) -> DataFrame:
    """Total and distribution figures of text lengths and token counts of a cleaned corpus."""
    return describe(
        df,
        {"text_length": F.length("cleaned_body"), "token_count": F.size("tokens_cleaned")},
        digits,
    )


def before_after_samples(df: DataFrame, n: int = 3, truncate: int = 100, order: str = "id") -> DataFrame:
    """The first n comments before and after cleaning, shortened."""
    return head_samples(df, ["body", "cleaned_body"], n, truncate, order)


def english_only_tokens(
    df: DataFrame, words: DataFrame, tokens: str = "tokens_cleaned", out: str = "tokens_final",
    inline_rows: int = DEFAULTS.inline_rows, max_rows: int = DEFAULTS.broadcast_rows,
) -> DataFrame:
    """Keep the tokens a one-column word table holds; rows left without tokens keep an empty array.

    NULL tokens stay NULL. A small word list is tested inside the row. A larger one is joined to the
    tokens; what is kept depends on the tokens alone, so it finds its rows by a digest of them.
    """
    rows = few_rows(words.select("token").distinct(), inline_rows)
    if rows is not None:
        return compute_once(df, out, with_word_set(rows, lambda known: F.filter(c(tokens), lambda t: known(t))))
    kept_columns = [c(x) for x in df.columns if x != out]
    keyed = df.withColumn("__key", content_key(c(tokens)))
    # rows with equal tokens give equal pairs: a set holds each once
    kept = (
        tokens_in(keyed, words, tokens, "__key", max_rows)
        .groupBy("__key")
        .agg(F.transform(F.array_sort(F.collect_set(F.struct("pos", "token"))), lambda x: x["token"]).alias("__kept"))
    )
    empty = F.array().cast("array<string>")
    final = F.when(c(tokens).isNotNull(), F.coalesce("__kept", empty)).alias(out)
    return keyed.join(kept, "__key", "left").select(*kept_columns, final)
