import math
import random

import pytest
from pyspark.sql import functions as F

from remarklab.functions.words import seed_lexicon, seed_modifiers
from remarklab.operators import corpus as C
from remarklab.operators.sentiment import SpecialCases, label_sentiment, lexicon_sentiment, phrase_rows, score_comparison

LEX = {"good": 1.9, "bad": -2.5, "great": 3.1, "ugly": -2.3, "ok": 0.9}
BOOST = {"very": 0.293, "barely": -0.293}
NEG = {"not", "never"}


def direct(text):
    """The rules applied word by word."""
    if text is None:
        return None
    words = []
    for w in text.split(" "):
        core = w.strip(".,!?;:")
        words.append(core if len(core) > 2 else w)
    but = words.index("but") if "but" in words else None
    total = 0.0
    for i, w in enumerate(words):
        if w not in LEX:
            continue
        v = LEX[w]
        for d, weight in ((1, 1.0), (2, 0.95), (3, 0.9)):
            if i < d or words[i - d] in LEX:
                continue
            p = words[i - d]
            if p in BOOST:
                v += math.copysign(1, v) * BOOST[p] * weight if v else 0
            if p in NEG:
                v *= -0.74
        if but is not None and i != but:
            v *= 0.5 if i < but else 1.5
        total += v
    total = round(total, 8)
    marks = min(text.count("!"), 4) * 0.292
    q = text.count("?")
    marks += 0 if q <= 1 else (q * 0.18 if q <= 3 else 0.96)
    if total > 0:
        total += marks
    elif total < 0:
        total -= marks
    return max(-1.0, min(1.0, round(total / math.sqrt(total * total + 15), 4)))


def frames(spark):
    lexicon = spark.createDataFrame(list(LEX.items()), "token string, valence double")
    mods = [(t, "booster", w) for t, w in BOOST.items()] + [(t, "negate", None) for t in NEG]
    return lexicon, spark.createDataFrame(mods, "token string, kind string, weight double")


def test_both_forms_equal_the_rules(spark):
    rng = random.Random(7)
    vocab = [*LEX, *BOOST, *NEG, "but", "the", "good,", "bad!", "great??", "ok.", "a", "words!!!", "?"]
    texts = [" ".join(rng.choices(vocab, k=rng.randint(1, 25))) for _ in range(300)] + [None, "", "nothing here", "not very good", "good"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, cleaned_body string")
    lexicon, mods = frames(spark)
    want = {str(i): direct(t) for i, t in enumerate(texts)}
    for options in ({}, {"inline_rows": 0}, {"inline_rows": 0, "max_rows": 1}):
        got = {r.id: r.vader_sentiment for r in lexicon_sentiment(df, lexicon, mods, **options).collect()}
        wrong = [(texts[int(i)], got[i], want[i]) for i in want if got[i] != want[i] and abs(got[i] - want[i]) > 1.01e-4]
        assert not wrong, wrong[:3]


def test_seed_lexicon_and_labels(spark):
    texts = [("1", "what a wonderful and helpful idea"), ("2", "this is a horrible disaster"), ("3", "the table is square"), ("4", None)]
    df = spark.createDataFrame(texts, "id string, cleaned_body string")
    scored = label_sentiment(lexicon_sentiment(df, seed_lexicon(spark), seed_modifiers(spark)))
    assert {r.id: r.sentiment_category for r in scored.collect()} == {"1": "Positive", "2": "Negative", "3": "Neutral", "4": "Unknown"}


def test_comparison_uses_rows_with_both(spark):
    df = spark.createDataFrame([(0.5, 0.1), (None, 0.2), (0.7, None)], "sentiment double, vader_sentiment double")
    assert [r.n for r in score_comparison(df).collect()] == [1, 1]


def test_clean_corpus_and_funnel_agree(spark):
    rows = [
        ("a", 2, "Second copy of the text, quite long words follow here today"),
        ("a", 1, "First copy of that text, many lovely words follow here today"),
        ("b", 1, None), ("c", 1, ""), ("d", 1, "tiny"), ("e", 1, "the and of to in is it on at by"),
        ("f", 1, "Plenty interesting content words appear inside sentence"), ("c", 2, "a later copy with very many good words does not count"),
    ]
    df = spark.createDataFrame(rows, "id string, created_utc long, body string")
    out = {r.id: r.cleaned_body for r in C.clean_corpus(df).collect()}
    assert set(out) == {"a", "f"} and out["a"].startswith("first copy")
    funnel = [(r.step, r.rows_left, r.rows_removed) for r in C.cleaning_funnel(df).orderBy("step_no").collect()]
    assert funnel == [("raw", 8, 0), ("deduplicated", 6, 2), ("non_empty", 4, 2), ("cleaned", 3, 1), ("tokenised", 2, 1)]


def test_english_only_keeps_order(spark):
    df = spark.createDataFrame([("1", ["b", "a", "x", "b"]), ("2", ["x"])], "id string, tokens_cleaned array<string>")
    words = spark.createDataFrame([("a",), ("b",)], "token string")
    for limit in (100, 0):
        got = {r.id: r.tokens_final for r in C.english_only_tokens(df, words, inline_rows=limit).collect()}
        assert got == {"1": ["b", "a", "b"], "2": []}


def test_empty_frame(spark):
    lexicon, mods = frames(spark)
    df = spark.createDataFrame([], "id string, cleaned_body string")
    assert lexicon_sentiment(df, lexicon, mods).agg(F.count(F.lit(1)).alias("n")).first().n == 0


@pytest.mark.parametrize("options", [{}, {"inline_rows": 0}])
def test_a_booster_in_the_lexicon_is_no_hit(spark, options):
    df = spark.createDataFrame([("1", "really"), ("2", "really good"), ("3", "good")], "id string, cleaned_body string")
    lexicon = spark.createDataFrame([("good", 1.9), ("really", 1.0)], "token string, valence double")
    modifiers = spark.createDataFrame([("really", "booster", 0.293)], "token string, kind string, weight double")
    got = {r.id: r.vader_sentiment for r in lexicon_sentiment(df, lexicon, modifiers, **options).collect()}
    assert got == {"1": 0.0, "2": 0.4404, "3": 0.4404}


PHRASES = {"bad good": 1.5, "very bad good": -1.0, "to die for": 3.0, "good but": 0.5, "never so": 2.0, "single": 9.0}
SPECIAL_NEG = {*NEG, "without"}


def direct_special(text):
    """Phrases and special cases word by word."""
    words = [w.strip(".,!?;:") if len(w.strip(".,!?;:")) > 2 else w for w in text.split(" ")]
    phrases = [p.split() for p in PHRASES if " " in p]
    ends = {}
    for j in range(len(words)):
        best = max((p for p in phrases if words[max(0, j + 1 - len(p)):j + 1] == p), key=len, default=None)
        if best:
            ends[j] = best
    covered = {i for j, p in ends.items() for i in range(j + 1 - len(p), j)}
    but = words.index("but") if "but" in words else None
    total = 0.0
    for i, w in enumerate(words):
        if i in covered or (i not in ends and w not in LEX):
            continue
        v = PHRASES[" ".join(ends[i])] if i in ends else LEX[w]
        for d, weight in ((1, 1.0), (2, 0.95), (3, 0.9)):
            if i < d or words[i - d] in LEX:
                continue
            p, between = words[i - d], words[i - d + 1:i]
            if p in BOOST:
                v += math.copysign(1, v) * BOOST[p] * weight if v else 0
            if p == "never" and {"so", "this"} & set(between):
                v *= 1.25
            elif not (p == "without" and "doubt" in between) and p in SPECIAL_NEG:
                v *= -0.74
        if i and words[i - 1] == "least" and not (i > 1 and words[i - 2] in ("at", "very")):
            v *= -0.74
        if but is not None and i != but:
            v *= 0.5 if i < but else 1.5
        total += v
    total = round(total, 8)
    return max(-1.0, min(1.0, round(total / math.sqrt(total * total + 15), 4)))


def test_phrases_and_special_cases_in_both_forms(spark):
    rng = random.Random(9)
    vocab = [*LEX, *BOOST, *SPECIAL_NEG, "but", "so", "this", "doubt", "least", "at", "to", "die", "for", "x"]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randrange(1, 14))) for _ in range(300)]
    texts += ["never so good", "without doubt great", "without any doubt bad", "at least good", "least good", "very bad good", "to die for", "die for"]
    lexicon, _ = frames(spark)
    mods = spark.createDataFrame([(t, "booster", w) for t, w in BOOST.items()] + [(t, "negate", None) for t in sorted(SPECIAL_NEG)],
                                 "token string, kind string, weight double")
    listed = spark.createDataFrame(list(PHRASES.items()), "phrase string, valence double")
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "cleaned_body string")
    for rows in (20000, 0):
        out = lexicon_sentiment(df, lexicon, mods, special=SpecialCases(), phrases=listed, inline_rows=rows)
        for r in out.collect():
            assert r.vader_sentiment == (None if r.cleaned_body is None else pytest.approx(direct_special(r.cleaned_body), abs=1e-4)), r.cleaned_body


def test_phrase_tables_are_bounded(spark):
    listed = spark.createDataFrame(list(PHRASES.items()), "phrase string, valence double")
    assert sum(len(r["phrases"]) for r in phrase_rows(listed)) == 5
    with pytest.raises(ValueError):
        phrase_rows(listed, 3)


def test_joined_words_are_summed_before_they_move(spark):
    """Only sums per text are shuffled while the lexicon is broadcast; copies of a text score as one."""
    from remarklab.operators import sentiment as S

    texts = ["a good day of the best", "the best", "good good but bad", "plain", "", "no good of the best of"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts * 3)] + [("n", None)], "id string, cleaned_body string")
    lexicon = spark.createDataFrame([("good", 1.9), ("bad", -2.5), ("best", 3.2), ("day", 0.1)], "token string, valence double")
    modifiers = spark.createDataFrame([("no", "negate", None), ("a", "booster", 0.293)], "token string, kind string, weight double")
    phrases = spark.createDataFrame([("of the best", 2.1), ("the best", 1.3)], "phrase string, valence double")

    def scores(**options):
        out = S.lexicon_sentiment(df, lexicon, modifiers, phrases=phrases, special=S.SpecialCases(), **options)
        return sorted((r.id, r.vader_sentiment) for r in out.collect()), out._jdf.queryExecution().executedPlan().toString()

    inline, _ = scores()
    small, plan = scores(inline_rows=0)
    large, _ = scores(inline_rows=0, max_rows=0)
    assert small == inline == large and len(inline) == 19
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "__key" in line]
    assert moved and not any("pos#" in line for line in moved)
