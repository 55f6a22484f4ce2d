"""Joins with lookup tables: broadcast while the table is small, salted shuffle beyond."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import DEFAULTS
from ..functions.text import bind, strip_token
from ..schema import c

SALTS = 64


# a lookup table is broadcast up to so many bytes of its rows as text
BROADCAST_BYTES = 64 << 20


def fits(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a frame may be broadcast: few enough rows and few enough bytes.

    Reads no more than ``max_rows`` + 1 rows; their size is that of their JSON.
    """
    size = F.octet_length(F.to_json(F.struct(*[c(x) for x in df.columns])))
    row = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes")).head()
    return row["n"] <= max_rows and (row["bytes"] or 0) <= max_bytes


def content_key(*columns: Column) -> Column:
    """128 bits of the columns' values: rows with equal ones share it, whatever their ids; NULL values are values."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def lookup_join(
    left: DataFrame, table: DataFrame, on: str, how: str = "inner",
    max_rows: int = DEFAULTS.broadcast_rows, salt_on: list[str] | None = None, small: bool | None = None,
) -> DataFrame:
    """Join a large frame with a lookup table holding one row per ``on`` value.

    Up to ``max_rows`` the table is broadcast and the large side does not move. A larger table is
    copied once per salt and both sides are shuffled by (on, salt), so a token that makes up a
    third of the large side is still spread over ``SALTS`` tasks. ``salt_on`` names the columns
    of the large side whose hash is the salt (all of them by default). ``small`` tells whether the
    table fits, for callers that join it more than once and have looked already.
    """
    if fits(table, max_rows) if small is None else small:
        return left.join(F.broadcast(table), on, how)
    names = salt_on or left.columns
    salted = left.withColumn("__salt", F.pmod(F.xxhash64(*[c(n) for n in names]), F.lit(SALTS)))
    copies = table.withColumn(
        "__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))
    )
    return salted.join(copies, [on, "__salt"], how).drop("__salt")


def explode_tokens(
    df: DataFrame, tokens: str = "tokens_cleaned", key: str = "id", strip: bool = False
) -> DataFrame:
    """Long form (key, pos, token), positions from 0."""
    out = df.select(c(key), F.posexplode(c(tokens)).alias("pos", "token"))
    return out.withColumn("token", strip_token(F.col("token"), 2)) if strip else out


def token_lexicon_join(
    df: DataFrame, lexicon: DataFrame, tokens: str = "tokens_cleaned", key: str = "id"
) -> DataFrame:
    """(key, pos, token, valence) of every token found in the lexicon."""
    return lookup_join(
        explode_tokens(df, tokens, key, strip=True), lexicon.select("token", "valence"), "token",
        salt_on=[key, "pos"],
    ).select(c(key), "pos", "token", "valence")


def tokens_in(
    df: DataFrame, words: DataFrame, tokens: str = "tokens_cleaned", key: str = "id",
    max_rows: int = DEFAULTS.broadcast_rows,
) -> DataFrame:
    """(key, pos, token) of the tokens that a one-column word table holds (semi join)."""
    return lookup_join(explode_tokens(df, tokens, key), words.select("token").distinct(), "token",
                       "left_semi", max_rows, salt_on=[key, "pos"])


def tokens_not_in(df: DataFrame, words: DataFrame, tokens: str = "tokens_cleaned", key: str = "id") -> DataFrame:
    """(key, pos, token) of the tokens that a one-column word table lacks (anti join)."""
    return lookup_join(explode_tokens(df, tokens, key), words.select("token").distinct(), "token",
                       "left_anti", salt_on=[key, "pos"])


def preceding_tokens(
    df: DataFrame, tokens: str = "tokens_cleaned", key: str = "id", n: int = 3
) -> DataFrame:
    """(key, pos, token, prev_1 .. prev_n): every token with those before it.

    The neighbours are read from the token array of the row itself, so unlike a lag window over
    exploded tokens this neither shuffles nor sorts.
    """
    context = bind(
        c(tokens),
        lambda ts: F.transform(
            ts,
            lambda t, i: F.struct(
                t.alias("token"),
                *[F.when(i >= d, F.get(ts, i - d)).alias(f"prev_{d}") for d in range(1, n + 1)],
            ),
        ),
    )
    return df.select(c(key), F.posexplode(context).alias("pos", "x")).select(
        c(key), "pos", "x.token", *[f"x.prev_{d}" for d in range(1, n + 1)]
    )
