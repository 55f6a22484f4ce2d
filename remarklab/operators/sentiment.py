"""Rule-based sentiment from a word lexicon.

The rules are those of the published VADER paper (Hutto and Gilbert, 2014) that still apply to
lower-cased text without symbols: word valences, boosters and negations up to three words before,
the contrast of "but", and emphasis by ! and ?.

A lexicon is a table (token, valence); modifiers are a table (token, kind, weight) of kind
``booster`` (signed weight) or ``negate``. As in the published rules, a booster is never a hit itself,
and a word of the lexicon doesn't modify others.

Two more inputs are optional. ``SpecialCases`` names the words of the published rules for "never so",
"without doubt" and "least". Phrases are a table (phrase, valence) of two words or more, such as idioms: where a phrase's
words stand, the longest that ends there is one hit at its last word, in place of its words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..config import DEFAULTS
from ..functions.lookup import few_rows, with_word_map
from ..functions.scores import bucketize_score
from ..functions.text import bind, strip_token
from ..schema import c, compute_once
from .joins import content_key, fits, lookup_join
from .profile import describe
from .rows import both_scores

# Fixed values of the published rules.
BOOST = 0.293
NEGATION_FACTOR = -0.74
DISTANCE_WEIGHTS = (1.0, 0.95, 0.9)
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
EXCLAMATION, MAX_EXCLAMATIONS = 0.292, 4
QUESTION, MANY_QUESTIONS = 0.18, 0.96
NORMALISER = 15.0

AFFIRMATION_FACTOR = 1.25


@dataclass(frozen=True)
class SpecialCases:
    """Words of the published rules for phrases; ``never`` and ``without`` must be negations of the modifiers table.

    ``never`` with one of ``so`` between it and the hit strengthens it, ``without`` with ``doubt`` between leaves it as it is,
    and ``least`` right before it turns it, unless a word of ``at`` stands before that.
    """

    never: str = "never"
    so: tuple[str, ...] = ("so", "this")
    without: str = "without"
    doubt: str = "doubt"
    least: str = "least"
    at: tuple[str, ...] = ("at", "very")


ENTRY = {"valence": "double", "boost": "double", "negate": "boolean"}


def entries(lexicon: DataFrame, modifiers: DataFrame) -> DataFrame:
    """(token, valence, boost, negate): both tables as one, a row per token."""
    words = lexicon.select(
        "token", F.col("valence").cast("double").alias("valence"),
        F.lit(None).cast("double").alias("boost"), F.lit(False).alias("negate"),
    )
    mods = modifiers.select(
        "token", F.lit(None).cast("double").alias("valence"),
        F.when(F.col("kind") == "booster", F.col("weight").cast("double")).alias("boost"),
        (F.col("kind") == "negate").alias("negate"),
    )
    return words.unionByName(mods).groupBy("token").agg(
        F.max("valence").alias("valence"), F.max("boost").alias("boost"), F.max("negate").alias("negate")
    )


def _step(
    running: Column, modifier: Column, weight: Column | float, special: SpecialCases | None = None, near: list[Column] = (),
) -> Column:
    """Effect of one earlier word on the running valence; lexicon words have none.

    With special cases, ``near`` has the words up to this one, from the hit backwards.
    """
    boosted = running + F.signum(running) * F.coalesce(modifier["boost"], F.lit(0.0)) * weight
    factor = F.when(modifier["negate"], F.lit(NEGATION_FACTOR)).otherwise(F.lit(1.0))
    if special is not None and len(near) > 1:
        *between, word = near
        so = F.greatest(*[w.isin(*special.so) for w in between], F.lit(False))
        doubt = F.greatest(*[w == special.doubt for w in between], F.lit(False))
        factor = F.when((word == special.never) & so, AFFIRMATION_FACTOR).when((word == special.without) & doubt, 1.0).otherwise(factor)
    return F.when(modifier.isNull() | modifier["valence"].isNotNull(), running).otherwise(boosted * factor)


def _least(running: Column, modifier: Column, first: Column, second: Column, special: SpecialCases) -> Column:
    """The valence after the rule for "least" right before the hit."""
    applies = (first == special.least) & (modifier.isNull() | modifier["valence"].isNull()) & F.coalesce(~second.isin(*special.at), F.lit(True))
    return F.when(applies, running * NEGATION_FACTOR).otherwise(running)


PHRASE = {"phrases": "array<struct<words:array<string>,valence:double>>"}


def phrase_rows(phrases: DataFrame, limit: int = DEFAULTS.inline_rows) -> list[dict]:
    """Phrases by their last word, the longest first, as rows of a word table; more than ``limit`` are refused."""
    words = F.split(F.trim(F.col("phrase")), " +")
    table = phrases.select(words.alias("words"), F.col("valence").cast("double").alias("valence"))
    rows = table.filter(F.size("words") > 1).withColumn("hash", F.xxhash64(F.element_at("words", -1))).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} phrases")
    found: dict[str, dict] = {}
    for r in sorted(rows, key=lambda r: (-len(r["words"]), r["words"])):
        entry = found.setdefault(r["words"][-1], {"token": r["words"][-1], "hash": r["hash"], "phrases": []})
        entry["phrases"].append({"words": r["words"], "valence": r["valence"]})
    return list(found.values())


def _phrase_at(lookup, tokens: Column, i: Column) -> Column:
    """The longest phrase that ends at a place: its words and valence, or NULL."""
    return F.get(F.filter(lookup(F.get(tokens, i))["phrases"], lambda p: F.when(
        i + 1 >= F.size(p["words"]), F.slice(tokens, i + 2 - F.size(p["words"]), F.size(p["words"])) == p["words"]).otherwise(False)), F.lit(0))


def _covered(found: Column, i: Column, longest: int) -> Column:
    """Whether a later word ends a phrase that has this one."""
    ahead = [F.coalesce(F.size(F.get(found, i + d)["words"]) > d, F.lit(False)) for d in range(1, longest)]
    return F.greatest(*ahead, F.lit(False))


def _contrast(pos: Column, but_pos: Column) -> Column:
    """Weight of a hit relative to the first contrast word (position 0-based, -1: none)."""
    return (
        F.when((but_pos < 0) | (pos == but_pos), F.lit(1.0))
        .when(pos < but_pos, F.lit(BEFORE_BUT))
        .otherwise(F.lit(AFTER_BUT))
    )


def emphasis(text: Column) -> Column:
    """Extra weight of exclamation and question marks of a text."""
    def count(mark: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))

    shouts = F.least(count("!"), F.lit(MAX_EXCLAMATIONS)) * EXCLAMATION
    asks = bind(
        count("?"),
        lambda n: F.when(n <= 1, F.lit(0.0)).when(n <= 3, n * QUESTION).otherwise(F.lit(MANY_QUESTIONS)),
    )
    return shouts + asks


def compound(total: Column, extra: Column) -> Column:
    """Sum of valences to a score in [-1, 1]; rounding first hides the order of addition."""
    return bind(
        bind(F.round(total, 8), lambda s: s + F.signum(s) * extra),
        lambda x: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.round(x / F.sqrt(x * x + NORMALISER), 4))),
    )


def _score_in_row(text: Column, rows: list, but: str, special: SpecialCases | None, phrases: list[dict]) -> Column:
    longest = max((len(p["words"]) for r in phrases for p in r["phrases"]), default=1)

    def earlier(ctx: Column, i: Column, d: int, name: str) -> Column:
        return F.when(i >= d, F.get(ctx[name], i - d))

    def valence(ctx: Column, i: Column) -> Column:
        own = F.get(ctx["e"], i)["valence"]
        if phrases:
            own = F.coalesce(F.get(ctx["p"], i)["valence"], own)
        if special is None:
            before = F.array(*[F.struct(earlier(ctx, i, d, "e").alias("e"), F.lit(w).alias("w")) for d, w in enumerate(DISTANCE_WEIGHTS, start=1)])
            return F.reduce(before, own, lambda v, m: _step(v, m["e"], m["w"])) * _contrast(i, ctx["but"])
        near = F.array(*[F.struct(earlier(ctx, i, d, "e").alias("e"), earlier(ctx, i, d, "t").alias("t")) for d in (1, 2, 3)])

        def stepped(n: Column) -> Column:
            words = [n[d]["t"] for d in range(3)]
            value = own
            for d, w in enumerate(DISTANCE_WEIGHTS):
                value = _bound_step(value, n[d]["e"], w, special, words[:d + 1])
            return bind(value, lambda v: _least(v, n[0]["e"], words[0], words[1], special))

        return bind(near, stepped) * _contrast(i, ctx["but"])

    def total(ctx: Column) -> Column:
        def is_hit(e: Column, i: Column) -> Column:
            hit = e["valence"].isNotNull() & e["boost"].isNull()
            return (F.coalesce(hit, F.lit(False)) | F.get(ctx["p"], i).isNotNull()) & ~_covered(ctx["p"], i, longest) if phrases else hit

        hits = F.filter(F.transform(ctx["e"], lambda e, i: F.when(is_hit(e, i), i)), lambda i: i.isNotNull())
        return F.reduce(F.transform(hits, lambda i: valence(ctx, i)), F.lit(0.0), lambda a, v: a + v)

    def score(lookup, phrase_lookup=None) -> Column:
        tokens = F.transform(F.split(text, " "), lambda t: strip_token(t, 2))

        def context(ts: Column) -> Column:
            more = [ts.alias("t")] if special is not None else []
            if phrase_lookup is not None:
                more.append(F.transform(ts, lambda t, i: _phrase_at(phrase_lookup, ts, i)).alias("p"))
            return F.struct(
                F.transform(ts, lambda t: lookup(t)).alias("e"), (F.array_position(ts, but).cast("int") - 1).alias("but"), *more)

        return bind(bind(tokens, context), lambda ctx: compound(total(ctx), emphasis(text)))

    if not phrases:
        return F.when(text.isNotNull(), with_word_map(rows, ENTRY, score))
    return F.when(text.isNotNull(), with_word_map(rows, ENTRY, lambda lookup: with_word_map(phrases, PHRASE, lambda found: score(lookup, found))))


def _bound_step(value: Column, modifier: Column, weight: float, special: SpecialCases, near: list[Column]) -> Column:
    return bind(value, lambda v: _step(v, modifier, weight, special, near))


def _score_by_join(
    keyed: DataFrame, table: DataFrame, col: str, but: str, max_rows: int, special: SpecialCases | None, phrases: list[dict],
) -> DataFrame:
    """(__key, __total) for a lexicon too large for a constant: words and their neighbours are joined."""
    longest = max((len(p["words"]) for r in phrases for p in r["phrases"]), default=1)
    texts = compute_once(keyed.filter(c(col).isNotNull()).select("__key", c(col)), "__t", F.transform(
        F.split(c(col), " "), lambda t: strip_token(t, 2))).drop(col)
    size, gap = F.size("__t"), F.lit(None).cast("string")
    near = [F.col("__t").alias("token"), *[F.slice(F.concat(F.array(*[gap] * d), "__t"), 1, size).alias(f"p{d}") for d in (1, 2, 3)]]
    phrase, covered = F.lit(None).cast("double"), F.lit(False)
    if phrases:
        texts = compute_once(texts, "__p", with_word_map(phrases, PHRASE, lambda lookup: F.transform(
            "__t", lambda t, i: _phrase_at(lookup, F.col("__t"), i))))
        lengths = F.transform("__p", lambda p: F.size(p["words"]))
        near += [F.col("__p.valence").alias("phrase"), *[F.slice(lengths, d + 1, size).alias(f"n{d}") for d in range(1, longest)]]
        phrase = F.col("phrase")
        covered = F.greatest(*[F.coalesce(F.col(f"n{d}") > d, F.lit(False)) for d in range(1, longest)], F.lit(False))
    but_at = (F.array_position("__t", but).cast("int") - 1).alias("but")
    words = texts.select("__key", but_at, F.posexplode(F.arrays_zip(*near)).alias("pos", "x")).select("__key", "but", "pos", "x.*")
    # one look at the table's size for all four joins
    small = fits(table, max_rows)
    hits = lookup_join(
        words, table.filter("valence is not null and boost is null").select("token", F.col("valence").alias("v")),
        "token", "left", salt_on=["__key", "pos"], small=small,
    ).withColumn("v", F.when(~covered, F.coalesce(phrase, F.col("v"))))
    # the first word stays, hit or not: it tells how many rows have the text
    hits = hits.filter(F.col("v").isNotNull() | (F.col("pos") == 0)).select("__key", "pos", "but", "p1", "p2", "p3", "v")
    if not small:
        # texts that occur often give the same hits: one of each is enough for further shuffles
        hits = hits.dropDuplicates(["__key", "pos"])
    for d, w in enumerate(DISTANCE_WEIGHTS, start=1):
        side = table.select(F.col("token").alias(f"p{d}"), F.struct("valence", "boost", "negate").alias(f"m{d}"))
        hits = lookup_join(hits, side, f"p{d}", "left", salt_on=["__key", "pos"], small=small)
        hits = hits.withColumn("v", _step(F.col("v"), F.col(f"m{d}"), w, special, [F.col(f"p{n}") for n in range(1, d + 1)]))
    if special is not None:
        hits = hits.withColumn("v", _least(F.col("v"), F.col("m1"), F.col("p1"), F.col("p2"), special))
    total = F.sum(F.col("v") * _contrast(F.col("pos"), F.col("but")))
    return hits.groupBy("__key").agg((total / F.count_if(F.col("pos") == 0)).alias("__total"))


def lexicon_sentiment(
    df: DataFrame, lexicon: DataFrame, modifiers: DataFrame, col: str = "cleaned_body",
    out: str = "vader_sentiment", but: str = "but",
    inline_rows: int = DEFAULTS.inline_rows, max_rows: int = DEFAULTS.broadcast_rows,
    special: SpecialCases | None = None, phrases: DataFrame | None = None,
) -> DataFrame:
    """Adds a compound score in [-1, 1]; text without hits scores 0.0, NULL text NULL.

    A lexicon of up to ``inline_rows`` entries becomes a constant that each row looks its words
    up in: no shuffle, no join, no Python worker. A larger one is joined to the exploded words; a
    score depends on the text alone, so the sums find their rows by a digest of the text. Phrases
    (few, as a constant in either form) and special cases are applied if they are given.
    """
    table = entries(lexicon, modifiers)
    listed = phrase_rows(phrases) if phrases is not None else []
    rows = few_rows(table, inline_rows)
    if rows is not None:
        return compute_once(df, out, _score_in_row(c(col), rows, but, special, listed))
    keyed = df.withColumn("__key", content_key(c(col)))
    sums = _score_by_join(keyed, table, col, but, max_rows, special, listed)
    joined = keyed.join(sums, "__key", "left")
    score = compound(F.coalesce(F.col("__total"), F.lit(0.0)), emphasis(c(col)))
    kept = [c(x) for x in df.columns if x != out]
    return joined.select(*kept, F.when(c(col).isNotNull(), score).alias(out))


def label_sentiment(
    df: DataFrame, score: str = "vader_sentiment", out: str = "sentiment_category", rule: str = "vader"
) -> DataFrame:
    return df.withColumn(out, bucketize_score(c(score), rule))


def score_comparison(df: DataFrame, left: str = "sentiment", right: str = "vader_sentiment", digits: int = 6) -> DataFrame:
    """Figures of the given and the computed score over the rows that have both."""
    return describe(both_scores(df, left, right), [left, right], digits)
