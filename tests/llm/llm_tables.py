"""Small tables with every edge that the operators must stand."""

import random

from pyspark.sql import types as T

# an extra column for many a name that operators use
CLASHES = ("fingerprint", "score", "spans", "n_tokens", "token_ids", "lang_pred", "secrets", "pii", "places", "word", "id", "text_key", "__text")


def words(n, seed, pool=400):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnopqrst") for _ in range(2 + rng.randrange(7))) if rng.random() < 0.2
                    else f"w{rng.randrange(pool)}x" for _ in range(n))


def edge_rows():
    """(doc_id, text, lang): NULLs, empty and very long texts, copies, repeated rows, equal ids, odd characters."""
    a, b = words(120, 1), words(90, 2)
    return [
        (0, a, "en"), (1, None, "en"), (2, "", None), (3, a, "de"), (4, a + " tail of it", None), (5, b, "en"), (5, b, "en"),
        (6, a, "en"), (6, b, "en"), (None, words(60, 3), "de"), (None, None, None), (7, "Ünï ©ödé 日本語 😀 ⠀ text " * 5, "de"),
        (8, words(30000, 4), "en"), (9, "   \n\t ", "en"), (10, "12345 !!! ???", None), (11, "ab " * 500, "de"),
        (12, a[:300] + " " + b[:300], "en"),
    ]


def table(spark, rows, clashes=()):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                           *[T.StructField(c, T.StringType()) for c in clashes]])
    return spark.createDataFrame([(*r, *(f"{c}!" for c in clashes)) for r in rows], schema)


def empty(spark):
    return table(spark, [])


def key(r):
    return tuple((x is None, x) for x in r)


def sorted_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)
