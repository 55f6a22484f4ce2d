"""Queries of the lexicon sentiment operators."""


from remarklab.operators import joins as J
from remarklab.operators import sentiment as S

from .common import (
    COMMENTS, CONTRAST, LEXICON, PHRASES, SPECIAL, cleaned, cleaned_sql, lexicon, modifiers, phrases, query, scored, with_scored,
)


@query("token_lexicon_join", lambda: f"""WITH {COMMENTS},\n{cleaned_sql()},
lx(token, valence) AS (VALUES {", ".join(f"('{t}', CAST({v} AS DOUBLE))" for t, v in LEXICON.items())}),
tok AS (SELECT id, unnest(tokens_cleaned) AS raw, CAST(generate_subscripts(tokens_cleaned, 1) - 1 AS INTEGER) AS pos FROM cleaned),
st AS (SELECT id, pos, CASE WHEN length(trim(raw, '.,!?;:')) > 2 THEN trim(raw, '.,!?;:') ELSE raw END AS token FROM tok)
SELECT id, pos, token, valence FROM st JOIN lx USING (token)""")
def token_lexicon_join(spark, sf):
    return J.token_lexicon_join(cleaned(spark, sf), lexicon(spark))


@query("lexicon_sentiment", with_scored("SELECT id, vader_sentiment FROM scored"))
def lexicon_sentiment(spark, sf):
    return S.lexicon_sentiment(cleaned(spark, sf), lexicon(spark), modifiers(spark), but=CONTRAST).select(
        "id", "vader_sentiment"
    )


@query("lexicon_sentiment_joined", with_scored("SELECT id, vader_sentiment FROM scored"))
def lexicon_sentiment_joined(spark, sf):
    """The form for lexicons too large for a constant."""
    return S.lexicon_sentiment(
        cleaned(spark, sf), lexicon(spark), modifiers(spark), but=CONTRAST, inline_rows=0
    ).select("id", "vader_sentiment")


@query("phrase_sentiment", with_scored("SELECT id, vader_sentiment FROM scored", special=SPECIAL, phrases=PHRASES))
def phrase_sentiment(spark, sf):
    """With the published rules for phrases, and a table of phrases."""
    return S.lexicon_sentiment(
        cleaned(spark, sf), lexicon(spark), modifiers(spark), but=CONTRAST, special=SPECIAL, phrases=phrases(spark)
    ).select("id", "vader_sentiment")


@query("phrase_sentiment_joined", with_scored("SELECT id, vader_sentiment FROM scored", special=SPECIAL, phrases=PHRASES))
def phrase_sentiment_joined(spark, sf):
    return S.lexicon_sentiment(
        cleaned(spark, sf), lexicon(spark), modifiers(spark), but=CONTRAST, inline_rows=0, special=SPECIAL, phrases=phrases(spark)
    ).select("id", "vader_sentiment")


@query("label_sentiment", with_scored("SELECT id, sentiment_category FROM scored"))
def label_sentiment(spark, sf):
    return scored(spark, sf).select("id", "sentiment_category")


def figures(name: str) -> str:
    return (f"SELECT '{name}' AS column_name, count({name}) AS n, round(avg({name}), 6) AS mean, round(stddev_samp({name}), 6) AS stddev, "
            f"min({name}) AS min, max({name}) AS max FROM scored WHERE sentiment IS NOT NULL AND vader_sentiment IS NOT NULL")


@query("score_comparison", with_scored(figures("sentiment") + " UNION ALL " + figures("vader_sentiment")))
def score_comparison(spark, sf):
    return S.score_comparison(scored(spark, sf))
