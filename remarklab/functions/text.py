"""Text cleaning and token functions as native column expressions."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, functions as F

from .stopwords import default_stopwords

# Patterns of the two cleaning recipes. (?U) makes \S and \w Unicode-aware and
# (?d) lets the dot stop at line feeds only. The POSIX classes are ASCII sets, which the regex
# engine tests several times faster than the same sets written as ranges.
URL_PATTERN = r"(?U)https?://\S+|www\.\S+"
USER_PATTERN = r"(?U)/u/\w+"
GROUP_PATTERN = r"(?U)/r/\w+"
TAG_PATTERN = r"(?d)<.*?>"
# a run of other characters that is not a single space; a run beginning with a space has more than one
NOT_PLAIN_PATTERN = r"[^\p{Alnum}.,!?;:](?:(?<! )[^\p{Alnum}.,!?;:]*|[^\p{Alnum}.,!?;:]+)"
SPACE_PATTERN = r"\s+"
MENTION_PATTERN = r"(?U)@\w+"
HASHTAG_PATTERN = r"(?U)#\w+"
DIGIT_PATTERN = r"(?U)\d+"
NOT_LETTER_PATTERN = r"[^\p{Lower}\s]+"
TOKEN_PUNCTUATION = ".,!?;:"


def clean_text(col: Column, min_length: int = 10) -> Column:
    """Lower-case, drop links, mentions, entities and tags, keep plain characters.

    Texts with fewer than ``min_length`` characters left become NULL.
    """
    text = F.lower(col)
    text = _remove(text, URL_PATTERN, "://", "www.")
    text = _remove(text, USER_PATTERN, "/u/")
    text = _remove(text, GROUP_PATTERN, "/r/")
    text = F.replace(text, F.lit("&gt;"), F.lit(""))
    text = F.replace(text, F.lit("&lt;"), F.lit(""))
    text = F.replace(text, F.lit("&amp;"), F.lit("and"))
    text = _remove(text, TAG_PATTERN, "<")
    # a run of other characters and white space becomes one space
    text = F.trim(F.regexp_replace(text, NOT_PLAIN_PATTERN, " "))
    return bind(text, lambda t: F.when(F.length(t) >= min_length, t))


def _remove(text: Column, pattern: str, *needles: str) -> Column:
    """Remove a pattern, skipping the regex for texts without any of the strings it needs."""

    def removed(t: Column) -> Column:
        needed = t.contains(needles[0])
        for needle in needles[1:]:
            needed = needed | t.contains(needle)
        return F.when(needed, F.regexp_replace(t, pattern, "")).otherwise(t)

    return bind(text, removed)


def clean_text_strict(col: Column) -> Column:
    """Letters only: also drops mentions, hashtags, digits and punctuation; never NULLs a text."""
    text = F.lower(col)
    text = _remove(text, URL_PATTERN, "://", "www.")
    for pattern, needle in ((MENTION_PATTERN, "@"), (HASHTAG_PATTERN, "#"), (TAG_PATTERN, "<")):
        text = _remove(text, pattern, needle)
    for pattern in (DIGIT_PATTERN, NOT_LETTER_PATTERN):
        text = F.regexp_replace(text, pattern, "")
    return F.trim(F.regexp_replace(text, SPACE_PATTERN, " "))


def bind(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    Referring to a costly expression several times would let the optimizer inline, and so
    evaluate, it several times; a lambda argument is evaluated once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tokenize(col: Column, cleaned: bool = False) -> Column:
    """Lower-case and split at every white-space character, without trailing empty tokens.

    ``cleaned=True`` promises lower-case text with single inner spaces, split by a plain space.
    """
    if cleaned:
        return F.split(col, " ")
    return F.split(F.regexp_replace(F.lower(col), r"\s+$", ""), r"\s")


@lru_cache(maxsize=16)
def _literals(words: tuple[str, ...]) -> tuple[Column, ...]:
    """Literal columns of a word list, made once: each costs a call to the JVM."""
    return tuple(F.lit(w) for w in words)


def is_in(token: Column, words) -> Column:
    """Membership in a fixed word list; Spark turns it into a hash-set test."""
    return token.isin(list(_literals(tuple(words))))


def remove_stopwords(tokens: Column, words=None, cleaned: bool = False) -> Column:
    """Drop listed words, keeping order and repetitions; the list becomes a hash-set test.

    ``cleaned=True`` promises lower-case tokens.
    """
    words = default_stopwords() if words is None else words
    return F.filter(tokens, lambda t: ~is_in(t if cleaned else F.lower(t), words))


def strip_token(token: Column, min_left: int = 0) -> Column:
    """Trim sentence punctuation from both ends, unless at most ``min_left`` characters remain."""
    core = F.btrim(token, F.lit(TOKEN_PUNCTUATION))
    if min_left == 0:
        return core
    # all punctuation sorts before @: a look at both ends costs less than trimming
    plain = (token >= "@") & (F.substring(token, -1, 1) >= "@")
    return F.when(plain, token).when(F.length(core) > min_left, core).otherwise(token)


def strip_punctuation(tokens: Column) -> Column:
    """Trim sentence punctuation from every token and drop the tokens left empty."""
    return F.filter(F.transform(tokens, lambda t: strip_token(t)), lambda t: t != "")


def keep_words(tokens: Column, words) -> Column:
    """Keep the tokens of a word list small enough to travel with the plan."""
    return F.filter(tokens, lambda t: is_in(t, words))


def has_keyword(tokens: Column, keywords, strip_punct: bool = False) -> Column:
    """True if any token equals a keyword, ignoring case; NULL tokens give false."""
    def hit(token: Column) -> Column:
        token = F.lower(token)
        return is_in(strip_token(token) if strip_punct else token, keywords)

    return F.coalesce(F.exists(tokens, hit), F.lit(False))


def term_counts_of(tokens: Column) -> Column:
    """The distinct tokens of an array with their numbers: array of (term, tf), terms ascending.

    Sorting the array puts equal tokens side by side; a term counts from its first place to that
    of the next term. Nothing leaves the row.
    """

    def counted(s: Column) -> Column:
        first = F.filter(
            F.transform(s, lambda t, i: F.when((i == 0) | (F.get(s, i - 1) != t), i)), lambda i: i.isNotNull()
        )
        return bind(first, lambda at: F.transform(
            at,
            lambda p, j: F.struct(
                F.get(s, p).alias("term"), (F.coalesce(F.get(at, j + 1), F.size(s)) - p).cast("bigint").alias("tf")
            ),
        ))

    return bind(F.sort_array(F.filter(tokens, lambda t: t.isNotNull())), counted)


def token_count(tokens: Column) -> Column:
    return F.size(tokens)


def char_length(col: Column) -> Column:
    return F.length(col)


def shorten(col: Column, limit: int = 100) -> Column:
    """First ``limit`` characters and an ellipsis, or the whole text if it is not longer."""
    return F.when(F.length(col) > limit, F.concat(F.substring(col, 1, limit), F.lit("..."))).otherwise(col)
