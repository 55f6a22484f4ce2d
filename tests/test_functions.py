import re
import string

import pytest
from pyspark.sql import functions as F

from remarklab.functions import scores as S
from remarklab.functions import text as X
from remarklab.functions import times as T
from remarklab.operators import words as W

TEXTS = [
    None, "", "short", "exactly 10", "Nine char", "Visit https://x.org/a?b=1 now, it is GOOD!",
    "www.site.com is a place\nwith lines", "/u/someone said /r/news is fine; u/other stays", "a &gt; b &lt; c &amp; d and more",
    "<p class='x'>tagged</p> text <br> here", "<open\ntag> over two lines stays", "don't won't it's café naïve ÉCOLE",
    "###$$$%%%^^^&&&***", "tabs\tand odd spaces everywhere", "https://é.org/ü tail of the link text",
    "/u/é_name1 wrote this sentence", "what?!;: ok... (really) [yes] {no}", "emoji \U0001f600 in the middle of text",
    "İstanbul and straße are cities", "x" * 3000, " leading and trailing   spaces  ",
    "<a>www.a.b</a>/u/x/r/y&amp;gt;", "/r/a/u/b joined forms here", "<<nested> tags> are odd things",
]


def plain_clean(text):
    """The cleaning rules, written from their description."""
    if text is None:
        return None
    text = text.lower()
    for pattern, to in [
        (r"https?://\S+|www\.\S+", ""), (r"/u/\w+", ""), (r"/r/\w+", ""), ("&gt;", ""), ("&lt;", ""),
        ("&amp;", "and"), ("<.*?>", ""), (r"[^a-zA-Z0-9\s.,!?;:]", " "), (r"\s+", " "),
    ]:
        text = re.sub(pattern, to, text)
    text = text.strip()
    return text if len(text) >= 10 else None


def test_clean_text_rules(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    got = {r.i: r.c for r in df.select("i", X.clean_text(F.col("t")).alias("c")).collect()}
    assert got == {i: plain_clean(t) for i, t in enumerate(TEXTS)}


def test_strict_cleaning(spark):
    df = spark.createDataFrame([("Hi @bob see #topic 123 <b>x</b> http://a.b OK!",), ("",), (None,)], "t string")
    got = [r.c for r in df.select(X.clean_text_strict(F.col("t")).alias("c")).collect()]
    assert got == ["hi see x ok", "", None]


def test_tokens(spark):
    df = spark.createDataFrame([("Hi, Climate.  The the climate ",), ("",), (None,)], "t string")
    rows = df.select(X.tokenize(F.col("t")).alias("t")).collect()
    assert [r.t for r in rows] == [["hi,", "climate.", "", "the", "the", "climate"], [""], None]
    kept = df.select(X.remove_stopwords(X.tokenize(F.col("t"))).alias("t")).collect()
    assert kept[0].t == ["hi,", "climate.", "", "climate"]


def test_keywords(spark):
    df = spark.createDataFrame([(["Ice"],), (["ice."],), ([],), (None,)], "t array<string>")
    exact = [r.k for r in df.select(X.has_keyword(F.col("t"), ["ice"]).alias("k")).collect()]
    loose = [r.k for r in df.select(X.has_keyword(F.col("t"), ["ice"], True).alias("k")).collect()]
    assert exact == [True, False, False, False] and loose == [True, True, False, False]


def test_term_counts_of(spark):
    df = spark.createDataFrame([(["b", "a", "b", None, "c", "b"],), ([],), (None,), (["x"],)], "t array<string>")
    got = [r.c and [tuple(x) for x in r.c] for r in df.select(X.term_counts_of(F.col("t")).alias("c")).collect()]
    assert got == [[("a", 1), ("b", 3), ("c", 1)], [], None, [("x", 1)]]


def test_score_rules(spark):
    values = [None, -1.0, -0.1, -0.0999, -0.05, -0.0499, 0.0, 0.05, 0.0501, 0.1, 0.1001, 1.0]
    want = {
        "raw": ["neutral", "negative", "negative"] + ["neutral"] * 6 + ["positive"] * 3,
        "vader": ["Unknown", "Negative", "Negative", "Negative"] + ["Neutral"] * 4 + ["Positive"] * 4,
        "label": ["Unknown", "Negative"] + ["Neutral"] * 8 + ["Positive"] * 2,
        "design": ["neutral"] + ["negative"] * 4 + ["neutral"] * 2 + ["positive"] * 5,
    }
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    for rule, labels in want.items():
        got = df.select("i", S.bucketize_score(F.col("v"), rule).alias("b")).orderBy("i").collect()
        assert [r.b for r in got] == labels, rule


def test_length_classes(spark):
    values = [None, 0, 50, 51, 200, 201, 500, 501, 1000, 1001]
    want = ["very_long", "very_short", "very_short", "short", "short", "medium", "medium", "long", "long", "very_long"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v int")
    got = df.select("i", S.bucketize_length(F.col("v")).alias("b")).orderBy("i").collect()
    assert [r.b for r in got] == want


def test_arithmetic(spark):
    df = spark.createDataFrame([(1.0, 0.0, 12.5), (1.0, 4.0, 0.625)], "a double, b double, p double")
    got = df.select(
        S.safe_divide(F.col("a"), F.col("b")).alias("d"), S.pct(F.col("a"), F.col("b")).alias("s"),
        S.pct_text(F.col("p")).alias("t"),
    ).collect()
    assert [tuple(r) for r in got] == [(0.0, 0.0, "12.50%"), (0.25, 25.0, "0.62%")]


def test_topic_mixture(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.4],), ([1.0],), (None,)], "m array<double>")
    got = df.select(S.argmax_topic(F.col("m")).alias("t"), S.max_topic_prob(F.col("m")).alias("p")).collect()
    assert [tuple(r) for r in got] == [(1, 0.4), (0, 1.0), (-1, 0.0)]


def test_times(spark):
    df = spark.createDataFrame([("1661990368",), ("not a number",), (None,)], "e string")
    assert [r.t for r in df.select(T.epoch_to_text(F.col("e")).alias("t")).collect()] == ["2022-08-31 23:59:28", None, None]
    tw = spark.createDataFrame([("Wed Oct 10 20:19:24 +0000 2018",), ("garbage",)], "c string")
    got = tw.select(F.date_format(T.parse_twitter_time(F.col("c")), "yyyy-MM-dd HH:mm:ss").alias("t")).collect()
    assert [r.t for r in got] == ["2018-10-10 20:19:24", None]


@pytest.mark.parametrize("text,code", [
    ("the cat is on the table", "en"), ("der hund und die katze sind nicht hier", "de"),
    ("le chat est dans la maison avec nous", "fr"), ("el perro está en la casa con nosotros", "es"),
    ("zzz qqq", None), (None, None),
])
def test_language(spark, text, code):
    df = spark.createDataFrame([(text,)], "body string")
    assert W.add_language(df).first().language == code


def test_punctuation_constant():
    assert set(X.TOKEN_PUNCTUATION) <= set(string.punctuation)


@pytest.mark.parametrize("language", ["english", "french", "german", "spanish"])
def test_shipped_stopwords_are_sparks(spark, language):
    from pyspark.ml.feature import StopWordsRemover

    from remarklab.functions.stopwords import default_stopwords

    assert default_stopwords(language) == tuple(StopWordsRemover.loadDefaultStopWords(language))
