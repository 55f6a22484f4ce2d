"""The comment view over the test tables, in Spark and in SQL, and the query registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from remarklab.functions.stopwords import default_stopwords
from remarklab.operators.corpus import clean_corpus
from remarklab.operators.sentiment import SpecialCases, label_sentiment, lexicon_sentiment
from remarklab.session import spread_small

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, Callable[[], str] | str] = {}


def query(name: str, sql: Callable[[], str] | str | None = None):
    """Register a query under a name, with its SQL twin if SQL can express it."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str, spread: str | None = None) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread_small(df, spread) if spread else df


# --- comments: the documents table in the shape of a comment dump -----------------------------


# rows without a text, for the queries whose feature they are
GAPS = "CASE WHEN doc_id % 101 = 0 THEN NULL WHEN doc_id % 103 = 0 THEN '' ELSE text END"


def comments(spark: SparkSession, sf_dir: str, spread: bool = True, gaps: bool = False) -> DataFrame:
    """The documents as comments with whole texts; ``gaps`` empties a few for the tests of empty texts."""
    d = table(spark, sf_dir, "documents", "doc_id" if spread else None)
    return d.selectExpr(
        "'comment' AS type",
        "CAST(doc_id AS STRING) AS id",
        "concat('t5_', source) AS `subreddit.id`",
        "source AS `subreddit.name`",
        "doc_id % 41 = 0 AS `subreddit.nsfw`",
        "1262304000L + (doc_id * 2654435761L) % 400000000 AS created_utc",
        "concat('/c/', CAST(doc_id AS STRING)) AS permalink",
        f"{GAPS if gaps else 'text'} AS body",
        "CASE WHEN doc_id % 97 = 0 THEN NULL ELSE CAST((doc_id * 37) % 2001 - 1000 AS DOUBLE) / 1000 END AS sentiment",
        "CAST(doc_id % 50 - 5 AS INT) AS score",
        "lang",
    )


COMMENTS = """comments AS (
  SELECT 'comment' AS type, CAST(doc_id AS VARCHAR) AS id, 't5_' || source AS "subreddit.id",
         source AS "subreddit.name", doc_id % 41 = 0 AS "subreddit.nsfw",
         CAST(1262304000 + (doc_id * 2654435761) % 400000000 AS BIGINT) AS created_utc,
         '/c/' || CAST(doc_id AS VARCHAR) AS permalink,
         text AS body,
         CASE WHEN doc_id % 97 = 0 THEN NULL ELSE CAST((doc_id * 37) % 2001 - 1000 AS DOUBLE) / 1000 END AS sentiment,
         CAST(doc_id % 50 - 5 AS INTEGER) AS score, lang, doc_id,
         make_timestamp(CAST(1262304000 + (doc_id * 2654435761) % 400000000 AS BIGINT) * 1000000) AS ts
  FROM documents)"""
COMMENTS_GAPS = COMMENTS.replace("text AS body", f"{GAPS} AS body")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations table as comments with many rows per id."""
    d = table(spark, sf_dir, "conversations", "conv_id")
    return d.select(
        F.col("conv_id").cast("string").alias("id"),
        F.col("role").alias("subreddit.name"),
        (F.lit(1600000000).cast("bigint") - F.col("turn") * 3600).alias("created_utc"),
        F.col("text").alias("body"),
        (F.col("turn") / 10.0).cast("double").alias("sentiment"),
        F.col("turn").cast("int").alias("score"),
    )


TURNS = """turns AS (
  SELECT CAST(conv_id AS VARCHAR) AS id, role AS "subreddit.name",
         CAST(1600000000 - turn * 3600 AS BIGINT) AS created_utc, text AS body,
         CAST(turn AS DOUBLE) / 10 AS sentiment, CAST(turn AS INTEGER) AS score
  FROM conversations)"""


def sql_strings(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def sql_clean(col: str, min_length: int = 10) -> str:
    text = f"lower({col})"
    for pattern, to in (
        (r"https?://\S+|www\.\S+", ""), (r"/u/\w+", ""), (r"/r/\w+", ""), ("&gt;", ""), ("&lt;", ""),
        ("&amp;", "and"), (r"<.*?>", ""), (r"[^a-zA-Z0-9\s.,!?;:]", " "), (r"\s+", " "),
    ):
        text = f"regexp_replace({text}, '{pattern}', '{to}', 'g')"
    text = f"trim({text})"
    return f"CASE WHEN length({text}) >= {min_length} THEN {text} END"


def sql_tokens(col: str) -> str:
    return f"list_filter(string_split({col}, ' '), lambda t: t NOT IN ({sql_strings(default_stopwords())}))"


def cleaned_sql(source: str = "comments", minimum: int = 5) -> str:
    """CTEs ``cleaned_text`` and ``cleaned``, after a CTE named by ``source``."""
    return f"""cleaned_text AS (
  SELECT *, {sql_clean("body")} AS cleaned_body FROM {source} WHERE body IS NOT NULL AND body <> ''),
tokenised AS (
  SELECT *, {sql_tokens("cleaned_body")} AS tokens_cleaned FROM cleaned_text WHERE cleaned_body IS NOT NULL),
cleaned AS (SELECT * FROM tokenised WHERE len(tokens_cleaned) >= {minimum})"""


def with_cleaned(select: str, minimum: int = 5) -> Callable[[], str]:
    return lambda: f"WITH {COMMENTS},\n{cleaned_sql(minimum=minimum)}\n{select}"


def with_comments(select: str) -> str:
    return f"WITH {COMMENTS}\n{select}"


def with_gaps(select: str) -> str:
    return f"WITH {COMMENTS_GAPS}\n{select}"


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned corpus; document ids are distinct, so nothing is de-duplicated."""
    return clean_corpus(comments(spark, sf_dir), dedup_order=None)


# --- a lexicon of words that the test texts use -------------------------------------------------

# The test lexicon, modifiers and keywords.
LEXICON = {
    "rewh": 1.9, "thatin": 2.1, "ed": 0.9, "ing": 1.3, "th": 0.6, "st": -0.7, "ha": -1.2, "nd": -1.9,
    "re": -0.9, "es": 0.4, "en": -0.4, "ti": 2.6, "orre": -2.4, "ononst": -1.7, "inoran": 3.1,
    "hehely": -2.8, "orantion": 1.1, "er": -0.3, "ou": 0.8, "an": -0.6, "tion": 1.6, "ment": -1.5,
    "eau": 2.2, "oi": -2.0, "ai": 0.7, "sch": -1.1, "ung": 1.4, "keit": 2.9, "elle": -0.8, "ci": 0.2,
}
NEGATIONS = ("is", "was", "nicht", "pas", "no")
BOOSTERS = {"the": 0.293, "that": -0.293, "der": 0.293, "la": -0.293, "and": 0.293}
CONTRAST = "for"
# words in the places of "never so", "without doubt" and "at least", and phrases with valences
SPECIAL = SpecialCases(never="is", so=("the", "a"), without="was", doubt="and", least="in", at=("of", "and"))
PHRASES = {"of the": 1.2, "the of": -0.9, "and of the": 2.3, "ed the": -1.1, "th the": 1.7, "la de": 0.7, "the ing": -1.9, "der die": 0.4}
KEYWORDS = ("rewh", "thatin", "ononst", "hehely", "orantion", "eau", "keit")


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LEXICON.items()), "token string, valence double")


def modifiers(spark: SparkSession) -> DataFrame:
    rows = [(t, "negate", None) for t in NEGATIONS] + [(t, "booster", w) for t, w in BOOSTERS.items()]
    return spark.createDataFrame(rows, "token string, kind string, weight double")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned comments with lexicon score and category."""
    df = lexicon_sentiment(cleaned(spark, sf_dir), lexicon(spark), modifiers(spark), but=CONTRAST)
    return label_sentiment(df)


def phrases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(PHRASES.items()), "phrase string, valence double")


def factor_sql(d: int, special: SpecialCases | None) -> str:
    """Factor of the word ``d`` places before a hit."""
    plain = f"CASE WHEN n{d} THEN -0.74 ELSE 1.0 END"
    if special is None or d == 1:
        return plain
    so = " OR ".join(f"coalesce(p{k} IN ({sql_strings(special.so)}), false)" for k in range(1, d))
    doubt = " OR ".join(f"coalesce(p{k} = '{special.doubt}', false)" for k in range(1, d))
    return f"CASE WHEN p{d} = '{special.never}' AND ({so}) THEN 1.25 WHEN p{d} = '{special.without}' AND ({doubt}) THEN 1.0 ELSE {plain} END"


def phrase_sql(phrases: dict[str, float]) -> str:
    """CTE ``placed``: the words with the valence of the phrase that ends at them, and whether a later phrase has them."""
    listed = {n: ", ".join(f"('{p}', CAST({v} AS DOUBLE))" for p, v in phrases.items() if len(p.split()) == n) for n in (2, 3)}
    return f"""two(phrase, v) AS (VALUES {listed[2]}), three(phrase, v) AS (VALUES {listed[3]}),
ended AS (SELECT c.*, coalesce(three.v, two.v) AS phrase, CASE WHEN three.v IS NOT NULL THEN 3 WHEN two.v IS NOT NULL THEN 2 ELSE 1 END AS n_words FROM ctx c
  LEFT JOIN two ON two.phrase = c.p1 || ' ' || c.token LEFT JOIN three ON three.phrase = c.p2 || ' ' || c.p1 || ' ' || c.token),
placed AS (SELECT *, coalesce(lead(n_words, 1) OVER w >= 2, false) OR coalesce(lead(n_words, 2) OVER w >= 3, false) AS covered
  FROM ended WINDOW w AS (PARTITION BY id ORDER BY pos))"""


def score_sql(source: str = "cleaned", key: str = "id", special: SpecialCases | None = None, phrases: dict[str, float] | None = None) -> str:
    """CTE ``scores`` (id, vader_sentiment) and the steps before it, over ``source``."""
    lex = ", ".join(f"('{t}', {v})" for t, v in LEXICON.items())
    neg = ", ".join(f"('{t}')" for t in NEGATIONS)
    boost = ", ".join(f"('{t}', {w})" for t, w in BOOSTERS.items())
    steps, v = [], "v0"
    for d, w in ((1, 1.0), (2, 0.95), (3, 0.9)):
        steps.append(
            f"v{d} AS (SELECT *, CASE WHEN p{d} IS NULL OR lex{d} THEN {v} ELSE "
            f"({v} + sign({v}) * coalesce(b{d}, 0) * {w}) * ({factor_sql(d, special)}) END AS v{d} "
            f"FROM {'hits' if d == 1 else f'v{d - 1}'})"
        )
        v = f"v{d}"
    if special is not None:
        steps.append(f"v4 AS (SELECT * REPLACE (CASE WHEN p1 = '{special.least}' AND NOT lex1 AND coalesce(p2 NOT IN ({sql_strings(special.at)}), true) "
                     "THEN v3 * -0.74 ELSE v3 END AS v3) FROM v3)")
    if phrases is None:
        hits = "hits AS (SELECT ctx.*, CAST(val AS DOUBLE) AS v0, bpos FROM ctx LEFT JOIN buts USING (id) WHERE val IS NOT NULL)"
    else:
        hits = f"""{phrase_sql(phrases)},
hits AS (SELECT placed.*, CAST(coalesce(phrase, val) AS DOUBLE) AS v0, bpos FROM placed LEFT JOIN buts USING (id)
  WHERE NOT covered AND (phrase IS NOT NULL OR val IS NOT NULL))"""
    lags = ", ".join(
        f"lag(token, {d}) OVER w AS p{d}, lag(val, {d}) OVER w IS NOT NULL AS lex{d}, "
        f"lag(bst, {d}) OVER w AS b{d}, coalesce(lag(neg, {d}) OVER w, false) AS n{d}"
        for d in (1, 2, 3)
    )
    return f"""lex(token, valence) AS (VALUES {lex}), negs(token) AS (VALUES {neg}), boosts(token, w) AS (VALUES {boost}),
words AS (
  SELECT {key} AS id, generate_subscripts(string_split(cleaned_body, ' '), 1) AS pos,
         unnest(string_split(cleaned_body, ' ')) AS raw FROM {source}),
stripped AS (
  SELECT id, pos, CASE WHEN length(trim(raw, '.,!?;:')) > 2 THEN trim(raw, '.,!?;:') ELSE raw END AS token FROM words),
looked AS (
  SELECT s.*, l.valence AS val, b.w AS bst, n.token IS NOT NULL AS neg FROM stripped s
  LEFT JOIN lex l ON s.token = l.token LEFT JOIN boosts b ON s.token = b.token LEFT JOIN negs n ON s.token = n.token),
ctx AS (SELECT *, {lags} FROM looked WINDOW w AS (PARTITION BY id ORDER BY pos)),
buts AS (SELECT id, min(pos) AS bpos FROM stripped WHERE token = '{CONTRAST}' GROUP BY id),
{hits},
{", ".join(steps)},
sums AS (SELECT id, round(sum(v3 * CASE WHEN bpos IS NULL OR pos = bpos THEN 1.0 WHEN pos < bpos THEN 0.5 ELSE 1.5 END), 8) AS s
         FROM {"v3" if special is None else "v4"} GROUP BY id),
marks AS (SELECT {key} AS id, length(cleaned_body) - length(replace(cleaned_body, '!', '')) AS ex,
                 length(cleaned_body) - length(replace(cleaned_body, '?', '')) AS qu FROM {source}),
emph AS (SELECT id, least(ex, 4) * 0.292 + CASE WHEN qu <= 1 THEN 0.0 WHEN qu <= 3 THEN qu * 0.18 ELSE 0.96 END AS e FROM marks),
totals AS (SELECT emph.id, coalesce(s, 0.0) + sign(coalesce(s, 0.0)) * e AS x FROM emph LEFT JOIN sums USING (id)),
scores AS (SELECT id, round(x / sqrt(x * x + 15), 4) AS vader_sentiment FROM totals),
scored AS (SELECT c.*, s.vader_sentiment,
                  CASE WHEN s.vader_sentiment IS NULL THEN 'Unknown' WHEN s.vader_sentiment > 0.05 THEN 'Positive'
                       WHEN s.vader_sentiment < -0.05 THEN 'Negative' ELSE 'Neutral' END AS sentiment_category
           FROM {source} c JOIN scores s ON c.{key} = s.id)"""


def with_scored(select: str, **rules) -> Callable[[], str]:
    return lambda: f"WITH {COMMENTS},\n{cleaned_sql()},\n{score_sql(**rules)}\n{select}"
