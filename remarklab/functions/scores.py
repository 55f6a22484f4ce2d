"""Score classes, length classes, safe arithmetic and topic-mixture functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class ScoreRule:
    """Thresholds of a three-way split of a score in [-1, 1]."""

    low: float
    high: float
    inclusive: bool
    positive: str
    negative: str
    neutral: str
    missing: str


# The four score-class rules in use.
SCORE_RULES = {
    "raw": ScoreRule(-0.1, 0.1, True, "positive", "negative", "neutral", "neutral"),
    "vader": ScoreRule(-0.05, 0.05, False, "Positive", "Negative", "Neutral", "Unknown"),
    "label": ScoreRule(-0.1, 0.1, False, "Positive", "Negative", "Neutral", "Unknown"),
    "design": ScoreRule(-0.05, 0.05, True, "positive", "negative", "neutral", "neutral"),
}

# Upper bounds (characters) of the length classes.
LENGTH_CLASSES = (("very_short", 50), ("short", 200), ("medium", 500), ("long", 1000))
LONGEST_CLASS = "very_long"


def bucketize_score(col: Column, rule: str | ScoreRule = "vader") -> Column:
    """Class of a score under one of ``SCORE_RULES`` or a rule of your own."""
    r = SCORE_RULES[rule] if isinstance(rule, str) else rule
    above = col >= r.high if r.inclusive else col > r.high
    below = col <= r.low if r.inclusive else col < r.low
    return (
        F.when(col.isNull(), r.missing)
        .when(above, r.positive)
        .when(below, r.negative)
        .otherwise(r.neutral)
    )


def bucketize_length(length: Column, null_label: str = LONGEST_CLASS) -> Column:
    """Class of a character count; an unknown length falls into the last class by default."""
    out = F.when(length.isNull(), null_label)
    for label, bound in LENGTH_CLASSES:
        out = out.when(length <= bound, label)
    return out.otherwise(LONGEST_CLASS)


def safe_divide(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def pct(a: Column, b: Column, digits: int = 2) -> Column:
    """100 a / b rounded, and 0 where b is 0."""
    return F.round(safe_divide(a * 100.0, b), digits)


def pct_text(value: Column, digits: int = 2) -> Column:
    """A number as percentage text, such as ``12.50%``; halves go to the even digit."""
    return F.concat(F.format_string(f"%.{digits}f", F.bround(value, digits)), F.lit("%"))


def argmax_topic(mixture: Column) -> Column:
    """Index of the largest entry (the first of equals); -1 where there is no mixture."""
    best = F.array_position(mixture, F.array_max(mixture)).cast("int") - 1
    return F.coalesce(best, F.lit(-1))


def max_topic_prob(mixture: Column) -> Column:
    """Largest entry of a topic mixture; 0.0 where there is no mixture."""
    return F.coalesce(F.array_max(mixture), F.lit(0.0))
