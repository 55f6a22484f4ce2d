import random

import pytest
from pyspark.sql import functions as F

from remarklab.operators import density as D
from remarklab.operators import profile as P
from remarklab.operators import rows as R
from remarklab.operators.joins import lookup_join, preceding_tokens, tokens_in, tokens_not_in
from remarklab.schema import COMMENT_SCHEMA, select_existing
from remarklab.operators import corpus as C
from remarklab.operators.joins import fits
from remarklab.operators.sentiment import lexicon_sentiment


def test_distinct_on_order_and_ties(spark):
    df = spark.createDataFrame(
        [("a", 2, "late"), ("a", 1, "b"), ("a", 1, "a"), ("b", 5, None), (None, 1, "x"), (None, 0, "y"), ("c", 1, "z")],
        "id string, t int, body string",
    )
    results = []
    for options in ({}, {"narrow": True}, {"narrow": True, "max_rows": 1}):
        for parts in (1, 7):
            got = {r.id: (r.t, r.body) for r in R.distinct_on(df.repartition(parts), "id", ["t"], **options).collect()}
            assert got["a"][0] == 1 and got["b"] == (5, None) and got[None] == (0, "y") and len(got) == 4
            results.append(got)
    assert all(r == results[0] for r in results)
    last = {r.id: r.body for r in R.distinct_on(df, "id", ["t"], keep="last").collect()}
    assert last["a"] == "late"


def test_dotted_names_survive(spark):
    df = spark.createDataFrame([], COMMENT_SCHEMA)
    assert R.distinct_on(df, "id", ["created_utc"]).columns == df.columns
    assert select_existing(df, ["subreddit.name", "nope"]).columns == ["subreddit.name"]
    assert P.completeness(df).count() == 10 and P.table_profile(df).count() == 10


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("id"))
    ids = lambda x: sorted(r.id for r in x.collect())
    for n in (1, 16):
        parts = df.repartition(n)
        assert ids(R.hash_sample(parts, "id", 0.1)) == ids(R.hash_sample(df, "id", 0.1))
        assert ids(R.exact_sample(parts, "id", n=77)) == ids(R.exact_sample(df, "id", n=77))
    train, test = R.train_test_split(df, "id")
    assert train.count() + test.count() == 2000 and train.intersect(test).count() == 0
    assert 1500 < train.count() < 1700
    # selections made one after the other stay independent
    again = R.hash_sample(R.hash_sample(df, "id", 0.5), "id", 0.5, purpose="topics")
    first, second = R.train_test_split(again, "id")
    assert 400 < again.count() < 600 and 0.7 < first.count() / again.count() < 0.9 and second.count() > 0


def test_exact_sample_is_exact_with_hot_and_equal_rows(spark):
    # one key holds most rows, and half of those are equal in every column
    rows = [("hot", i % 2 * i) for i in range(400)] + [(f"k{i}", i) for i in range(100)]
    df = spark.createDataFrame(rows, "id string, v int").repartition(8)
    for n in (0, 1, 50, 100, 233, 300, 420, 499, 500):
        out = R.exact_sample(df, "id", n=n)
        assert out.count() == n
        assert out.exceptAll(df).count() == 0
    assert R.exact_sample(df, "id", 0.5).count() == 250


def test_top_k_per_group_beyond_the_window_limit(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), F.col("id").alias("t"), (F.col("id") % 97).alias("n"))
    got = R.top_k_per_group(df, "g", "n", "t", 1500)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "5000")
    try:
        want = R.top_k_per_group(df, "g", "n", "t", 1500)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_exact_sample_refines_large_edges(spark, monkeypatch):
    monkeypatch.setattr(R, "EDGE_ROWS", 0)
    test_exact_sample_is_exact_with_hot_and_equal_rows(spark)


def test_keyword_tables(spark):
    df = spark.createDataFrame([("1", ["Ice."]), ("2", ["sea"]), ("3", []), ("4", None)], "id string, tokens_cleaned array<string>")
    words = spark.createDataFrame([("ice",), ("sea",), ("sea",)], "token string")
    for strip, want in ((False, ["2"]), (True, ["1", "2"])):
        listed = R.keyword_filter(df, ["ice", "sea"], strip_punct=strip)
        inline, joined = (R.keyword_filter(df, words, strip_punct=strip, inline_rows=n) for n in (10, 0))
        for out in (listed, inline, joined):
            assert sorted(r.id for r in out.collect()) == want


def test_lookup_join_salts_large_tables(spark):
    left = spark.range(500).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("token"))
    table = spark.createDataFrame([("hot", 1), ("7", 2), ("none", 3)], "token string, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        small = lookup_join(left, table, "token", how)
        large = lookup_join(left, table, "token", how, max_rows=1)
        assert sorted(map(str, small.select(sorted(small.columns)).collect())) == sorted(map(str, large.select(sorted(large.columns)).collect()))


def test_semi_and_anti_parts(spark):
    df = spark.createDataFrame([("1", ["a", "b", "a", "c"]), ("2", ["c"])], "id string, tokens_cleaned array<string>")
    known = spark.createDataFrame([("a",), ("a",), ("c",)], "token string")
    assert sorted((r.id, r.pos, r.token) for r in tokens_in(df, known).collect()) == [("1", 0, "a"), ("1", 2, "a"), ("1", 3, "c"), ("2", 0, "c")]
    assert [(r.id, r.pos, r.token) for r in tokens_not_in(df, known).collect()] == [("1", 1, "b")]
    near = preceding_tokens(df).orderBy("id", "pos").collect()
    assert tuple(near[3]) == ("1", 3, "c", "a", "b", "a") and near[4].prev_1 is None


def test_exact_quantiles_of_a_large_skewed_group(spark):
    """More rows than the sketch can hold exactly, heavy ties, and a tiny second group."""
    big = spark.range(60000).select(
        F.lit("big").alias("g"),
        F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.sin(F.col("id").cast("double")) * 1000).alias("v"),
    )
    df = big.unionByName(spark.createDataFrame([("small", 1.0), ("small", 2.0), ("small", None)], "g string, v double"))
    ps = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(r.g, r.p): r.value for r in D.exact_quantiles(df, "v", ps, "g").collect()}
    want = df.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(p) for p in ps])).alias("q")).collect()
    for r in want:
        for p, q in zip(ps, r.q):
            assert abs(got[(r.g, p)] - q) < 1e-9
    assert len(got) == 14
    overall = {r.p: r.value for r in D.exact_quantiles(df, "v", ps).collect()}
    whole = df.agg(F.percentile("v", F.array(*[F.lit(p) for p in ps])).alias("q")).first().q
    assert all(abs(overall[p] - q) < 1e-9 for p, q in zip(ps, whole))
    box = D.box_stats(df, "v").first()
    assert abs(box.median - round(whole[3], 6)) < 1e-6 and box.n == 60002


def test_brackets_with_many_values_are_refined(spark, monkeypatch):
    """Brackets beyond the bound, ties at their ends and within, several groups: the same quantiles, and few values to rank."""
    n = 400000
    rows = spark.range(n).select(
        (F.col("id") % 2).cast("string").alias("g"),
        F.when(F.col("id") % 10 < 4, F.lit(0.0)).when(F.col("id") % 10 == 4, F.lit(3.0))
        .otherwise(F.exp((F.xxhash64("id") % 1000003) / 300000.0)).alias("v"))
    df = rows.unionByName(spark.createDataFrame([("few", 1.0), ("few", 2.0), ("none", None)], "g string, v double"))
    ps = [0.0, 0.2, 0.399999, 0.4, 0.5, 0.77, 1.0]
    seen = []
    refine = D._refine
    monkeypatch.setattr(D, "_refine", lambda *a: (seen.append(refine(*a)), seen[-1])[1])
    # brackets of a twentieth of the rows, to be cut to a thousand values
    monkeypatch.setattr(D, "SKETCH_ACCURACY", 200)
    got = {(r.g, r.p): r.value for r in D.exact_quantiles(df, "v", ps, "g", most=1000).collect()}
    want = df.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(p) for p in ps])).alias("q")).collect()
    for r in want:
        for p, q in zip(ps, r.q or []):
            assert abs(got[(r.g, p)] - q) < 1e-9
    assert len(got) == 3 * len(ps) and len(seen) == 1
    base = df.select(F.col("g").alias("__by"), "v").filter("v IS NOT NULL")
    ranked = D._inside(base, seen[0], "g").filter("v > b.lo AND v < b.hi").groupBy("__by", "b").agg(F.count_distinct("v").alias("n"))
    assert ranked.agg(F.max("n")).first()[0] <= 1500


def test_histogram_edges_and_empty(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (None,)], "v double")
    got = [(r.bin, r.n) for r in D.histogram(df, "v", 4).orderBy("bin").collect()]
    assert got == [(0, 1), (1, 0), (2, 1), (3, 1)]
    flat = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [r.n for r in D.histogram(flat, "v", 2).orderBy("bin").collect()] == [2, 0]


def test_share_of_many_groups(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"))
    few = P.distribution(df, "k").collect()
    many = P.distribution(df, "k", few_groups=False).collect()
    assert few == many and abs(sum(r.percentage for r in few) - 100) < 0.1


def test_zero_rows(spark):
    df = spark.createDataFrame([], COMMENT_SCHEMA)
    assert all(r.pct_complete == 0 for r in P.completeness(df).collect())
    assert P.describe(df, ["score"]).first().n == 0


def test_density_equals_direct_sum(spark):
    import math

    rng = random.Random(1)
    values = [round(rng.uniform(-1, 1), 3) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    n = len(values)
    mean = sum(values) / n
    h = math.sqrt(sum((v - mean) ** 2 for v in values) / (n - 1)) * n ** -0.2
    for r in D.score_density(df, "v", [-1.0, 0.0, 0.3]).collect():
        want = sum(math.exp(-0.5 * ((r.x - v) / h) ** 2) for v in values) / (n * h * math.sqrt(2 * math.pi))
        assert abs(r.density - want) < 2e-6


SAME_IDS = [("1", ["good", "x"]), ("1", ["y"]), (None, ["good"]), (None, ["z"]), ("2", None), ("1", ["good", "x"]), ("3", [])]


@pytest.mark.parametrize("options", [{}, {"inline_rows": 0}, {"inline_rows": 0, "max_rows": 0}])
def test_lookups_depend_on_the_tokens_only(spark, options):
    """Repeated and NULL ids: the same rows whether a word table is inlined, broadcast, or salted."""
    df = spark.createDataFrame(SAME_IDS, "id string, tokens_cleaned array<string>")
    words = spark.createDataFrame([("good",)], "token string")
    kept = R.keyword_filter(df, words, **options).collect()
    assert sorted((r.id or "", r.tokens_cleaned) for r in kept) == [("", ["good"]), ("1", ["good", "x"]), ("1", ["good", "x"])]
    out = C.english_only_tokens(df, words, **options).collect()
    got = sorted((r.id or "", r.tokens_cleaned or [], r.tokens_final if r.tokens_final is not None else "NULL") for r in out)
    assert got == [("", ["good"], ["good"]), ("", ["z"], []), ("1", ["good", "x"], ["good"]), ("1", ["good", "x"], ["good"]),
                   ("1", ["y"], []), ("2", [], "NULL"), ("3", [], [])]


@pytest.mark.parametrize("options", [{}, {"inline_rows": 0}, {"inline_rows": 0, "max_rows": 0}])
def test_scores_depend_on_the_text_only(spark, options):
    df = spark.createDataFrame(
        [("1", "a good day"), ("1", "plain thing"), (None, "good"), (None, None), ("1", "a good day")], "id string, cleaned_body string")
    lexicon = spark.createDataFrame([("good", 1.9)], "token string, valence double")
    modifiers = spark.createDataFrame([("not", "negate", None)], "token string, kind string, weight double")
    rows = lexicon_sentiment(df, lexicon, modifiers, **options).collect()
    got = sorted((r.id or "", r.cleaned_body or "", r.vader_sentiment) for r in rows if r.cleaned_body)
    assert got == [("", "good", 0.4404), ("1", "a good day", 0.4404), ("1", "a good day", 0.4404), ("1", "plain thing", 0.0)]
    assert [r.vader_sentiment for r in rows if r.cleaned_body is None] == [None]


def test_broadcast_is_bounded_by_bytes(spark):
    table = spark.createDataFrame([("x" * 1000,)] * 10, "token string")
    assert fits(table, 10) and not fits(table, 9) and not fits(table, 10, max_bytes=5000)


def test_histogram_bounds_per_group(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 1.0), ("b", 10.0), ("b", 11.0), ("c", None)], "g string, x double")
    got = {(r.g, r.bin): (r.bin_start, r.n) for r in D.histogram(df, "x", 2, by="g").collect()}
    assert got == {("a", 0): (0.0, 1), ("a", 1): (0.5, 1), ("b", 0): (10.0, 1), ("b", 1): (10.5, 1)}
    whole = {r.bin: r.n for r in D.histogram(df, "x", 2).collect()}
    assert whole == {0: 2, 1: 2}


def test_nothing_stays_cached(spark):
    """Neither narrow de-duplication, nor lookups, nor a cleaned corpus leave a persisted frame."""
    spark.catalog.clearCache()
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    df = spark.createDataFrame([("a", 1, "some text of a few words"), ("a", 2, "x"), ("b", 3, "other text of some words")],
                               "id string, created_utc bigint, body string")
    assert R.distinct_on(df, "id", ["created_utc"], narrow=True).count() == 2
    assert C.clean_corpus(df).count() <= 2
    words = spark.createDataFrame([("text",)], "token string")
    assert R.keyword_filter(C.clean_corpus(df), words, inline_rows=0).count() <= 2
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_quantiles_shuffle_few_rows(spark):
    """Values outside the brackets are counted in their tasks, not shuffled."""
    n = 60_000
    df = spark.range(n).select((F.col("id") * 7919 % n).cast("double").alias("x"))
    got = {r.p: r.value for r in D.exact_quantiles(df, "x", [0.25, 0.5, 0.999]).collect()}
    assert got == {p: pytest.approx(p * (n - 1)) for p in (0.25, 0.5, 0.999)}


def test_large_keyword_tables_meet_only_rows_without_a_common_keyword(spark, monkeypatch):
    rows = [(str(i), ["Common" if i % 10 else "plain", f"w{i}", None]) for i in range(200)] + [("none", None), ("none", [])]
    df = spark.createDataFrame(rows, "id string, tokens_cleaned array<string>")
    words = spark.createDataFrame([("common",), ("common",), (None,), *[(f"w{i}",) for i in range(0, 400, 4)]], "token string")
    want = sorted(str(i) for i in range(200) if i % 10 or i % 4 == 0)
    joined = []
    tokens_in = R.tokens_in
    monkeypatch.setattr(R, "tokens_in", lambda texts, *rest: joined.append(texts.count()) or tokens_in(texts, *rest))
    for options in ({"inline_rows": 1}, {"inline_rows": 1, "max_rows": 0}):
        out = R.keyword_filter(df, words, **options)
        assert out.columns == df.columns and sorted(r.id for r in out.collect()) == want
    assert joined == [22, 22]
