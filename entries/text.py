"""Queries of the cleaning, token and word operators."""

from pyspark.sql import functions as F

from remarklab.functions import text as X
from remarklab.functions.stopwords import default_stopwords
from remarklab.operators import corpus as C
from remarklab.operators import joins as J
from remarklab.operators import words as W
from remarklab.operators import features as V
from remarklab.operators.features import hashing_tfidf, fit_text_vectors, term_frequency, tfidf, vocabulary
from remarklab.operators.rows import top_k_per_group

from .common import (
    COMMENTS, COMMENTS_GAPS, TURNS, cleaned, cleaned_sql, comments, query, scored, sql_clean, sql_strings, table, turns,
    with_cleaned, with_comments, with_scored,
)


@query("clean_text", lambda: f"SELECT page_id, {sql_clean('html')} AS cleaned_body FROM pages")
def clean_text(spark, sf):
    return table(spark, sf, "pages", "page_id").select("page_id", X.clean_text(F.col("html")).alias("cleaned_body"))


def sql_strict(col: str) -> str:
    text = f"lower({col})"
    for pattern in (r"https?://\S+|www\.\S+", r"@\w+", r"#\w+", r"<.*?>", r"\d+", r"[^a-z\s]"):
        text = f"regexp_replace({text}, '{pattern}', '', 'g')"
    return f"trim(regexp_replace({text}, '\\s+', ' ', 'g'))"


@query("clean_text_strict", lambda: f"SELECT page_id, {sql_strict('html')} AS cleaned_text FROM pages")
def clean_text_strict(spark, sf):
    return table(spark, sf, "pages", "page_id").select("page_id", X.clean_text_strict(F.col("html")).alias("cleaned_text"))


@query("tokenize", lambda: f"""WITH {COMMENTS},
{cleaned_sql()} SELECT id, array_to_string(string_split(cleaned_body, ' '), '|') AS tokens,
 CAST(len(string_split(cleaned_body, ' ')) AS INTEGER) AS n FROM tokenised""")
def tokenize(spark, sf):
    df = C.add_tokens(C.drop_null_result(C.add_clean_text(C.drop_empty(comments(spark, sf)))))
    return df.select("id", F.array_join("tokens_raw", "|").alias("tokens"), F.size("tokens_raw").alias("n"))


@query("remove_stopwords", lambda: f"""WITH {COMMENTS},
{cleaned_sql()} SELECT id, array_to_string(tokens_cleaned, '|') AS tokens FROM tokenised""")
def remove_stopwords(spark, sf):
    df = C.add_tokens(C.drop_null_result(C.add_clean_text(C.drop_empty(comments(spark, sf)))))
    return df.select("id", F.array_join("tokens_cleaned", "|").alias("tokens"))


# word list for the dictionary operators: the words of the question-and-answer table
WORDS_SQL = """dict AS (SELECT DISTINCT unnest(string_split_regex(lower(text), '[^a-z]+')) AS token FROM benchmark)"""


def dictionary(spark, sf):
    words = F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("token")
    return table(spark, sf, "benchmark").select(words).distinct()


ENGLISH = """SELECT c.id, coalesce(k.kept, '') AS kept FROM cleaned c LEFT JOIN (
  SELECT id, string_agg(token, '|' ORDER BY pos) AS kept FROM (
    SELECT id, unnest(tokens_cleaned) AS token, generate_subscripts(tokens_cleaned, 1) AS pos FROM cleaned)
  WHERE token IN (SELECT token FROM dict) GROUP BY id) k USING (id)"""


def english_sql():
    return f"WITH {COMMENTS},\n{cleaned_sql()},\n{WORDS_SQL}\n{ENGLISH}"


@query("english_only_tokens", english_sql)
def english_only_tokens(spark, sf):
    out = C.english_only_tokens(cleaned(spark, sf), dictionary(spark, sf))
    return out.select("id", F.array_join("tokens_final", "|").alias("kept"))


@query("english_only_tokens_joined", english_sql)
def english_only_tokens_joined(spark, sf):
    out = C.english_only_tokens(cleaned(spark, sf), dictionary(spark, sf), inline_rows=0)
    return out.select("id", F.array_join("tokens_final", "|").alias("kept"))


POSITIONS = """tok AS (SELECT id, unnest(tokens_cleaned) AS token, CAST(generate_subscripts(tokens_cleaned, 1) - 1 AS INTEGER) AS pos FROM cleaned)"""


def with_positions(select: str):
    return lambda: f"WITH {COMMENTS},\n{cleaned_sql()},\n{POSITIONS},\n{WORDS_SQL}\n{select}"


@query("tokens_in_dictionary", with_positions("SELECT id, pos, token FROM tok WHERE token IN (SELECT token FROM dict)"))
def tokens_in_dictionary(spark, sf):
    return J.tokens_in(cleaned(spark, sf), dictionary(spark, sf)).select("id", "pos", "token")


@query("tokens_not_in_dictionary", with_positions(
    "SELECT token, count(*) AS n FROM tok WHERE token NOT IN (SELECT token FROM dict) GROUP BY 1"))
def tokens_not_in_dictionary(spark, sf):
    left = J.tokens_not_in(cleaned(spark, sf), dictionary(spark, sf))
    return left.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query("preceding_tokens", with_positions("""SELECT id, pos, token, lag(token, 1) OVER w AS prev_1, lag(token, 2) OVER w AS prev_2,
       lag(token, 3) OVER w AS prev_3 FROM tok WINDOW w AS (PARTITION BY id ORDER BY pos)"""))
def preceding_tokens(spark, sf):
    return J.preceding_tokens(cleaned(spark, sf))


CORPUS = """SELECT id, strftime(make_timestamp(created_utc * 1000000), '%Y-%m-%d %H:%M:%S') AS timestamp, cleaned_body,
       array_to_string(tokens_cleaned, '|') AS tokens, sentiment, score FROM cleaned"""


@query("clean_corpus", lambda: f"""WITH {TURNS},
firsts AS (SELECT * FROM turns QUALIFY row_number() OVER (PARTITION BY id ORDER BY created_utc) = 1),
{cleaned_sql('firsts')} {CORPUS}""")
def clean_corpus(spark, sf):
    return C.clean_corpus(turns(spark, sf)).select(
        "id", "timestamp", "cleaned_body", F.array_join("tokens_cleaned", "|").alias("tokens"), "sentiment", "score"
    )


@query("clean_documents", with_cleaned(CORPUS))
def clean_documents(spark, sf):
    return cleaned(spark, sf).select(
        "id", "timestamp", "cleaned_body", F.array_join("tokens_cleaned", "|").alias("tokens"), "sentiment", "score"
    )


FUNNEL = """f AS (SELECT (SELECT count(*) FROM src) AS n0, (SELECT count(*) FROM firsts) AS n1,
       (SELECT count(*) FROM cleaned_text) AS n2, (SELECT count(*) FROM tokenised) AS n3, (SELECT count(*) FROM cleaned) AS n4)
SELECT CAST(step_no AS INTEGER) AS step_no, step, rows_left, rows_removed, round(100.0 * rows_left / n0, 2) AS retention_pct FROM (
  SELECT 0 AS step_no, 'raw' AS step, n0 AS rows_left, n0 - n0 AS rows_removed, n0 FROM f
  UNION ALL SELECT 1, 'deduplicated', n1, n0 - n1, n0 FROM f UNION ALL SELECT 2, 'non_empty', n2, n1 - n2, n0 FROM f
  UNION ALL SELECT 3, 'cleaned', n3, n2 - n3, n0 FROM f UNION ALL SELECT 4, 'tokenised', n4, n3 - n4, n0 FROM f)"""


def funnel_sql(view: str, name: str) -> str:
    return f"""WITH {view}, src AS (SELECT * FROM {name}),
firsts AS (SELECT * FROM src QUALIFY row_number() OVER (PARTITION BY id ORDER BY created_utc) = 1),
{cleaned_sql('firsts')}, {FUNNEL}"""


@query("cleaning_funnel", lambda: funnel_sql(COMMENTS_GAPS, "comments"))
def cleaning_funnel(spark, sf):
    return C.cleaning_funnel(comments(spark, sf, gaps=True))


@query("cleaning_funnel_duplicates", lambda: funnel_sql(TURNS, "turns"))
def cleaning_funnel_duplicates(spark, sf):
    return C.cleaning_funnel(turns(spark, sf))


def describe_sql(name: str, value: str) -> str:
    return (f"SELECT '{name}' AS column_name, count({value}) AS n, round(avg({value}), 6) AS mean, round(stddev_samp({value}), 6) AS stddev, "
            f"CAST(min({value}) AS DOUBLE) AS min, CAST(max({value}) AS DOUBLE) AS max FROM cleaned")


@query("quality_report", with_cleaned(describe_sql("text_length", "length(cleaned_body)") + " UNION ALL " + describe_sql("token_count", "len(tokens_cleaned)")))
def quality_report(spark, sf):
    return C.quality_report(cleaned(spark, sf))


@query("before_after_samples", with_cleaned("""SELECT column_name, CAST(sample_no AS INTEGER) AS sample_no,
       CASE WHEN length(value) > 100 THEN substring(value, 1, 100) || '...' ELSE value END AS value FROM (
         SELECT 'body' AS column_name, row_number() OVER (ORDER BY id) AS sample_no, body AS value FROM cleaned
         UNION ALL SELECT 'cleaned_body', row_number() OVER (ORDER BY id), cleaned_body FROM cleaned) WHERE sample_no <= 3"""))
def before_after_samples(spark, sf):
    return C.before_after_samples(cleaned(spark, sf))


COUNTS = "SELECT {0} AS {1}, count(*) AS n FROM {2} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {3}"


@query("word_frequency", with_cleaned(COUNTS.format("token", "token", "(SELECT unnest(tokens_cleaned) AS token FROM cleaned)", 50)))
def word_frequency(spark, sf):
    return W.word_frequency(cleaned(spark, sf), 50)


@query("word_frequency_by_label", with_scored("""SELECT sentiment_category, token, n, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY sentiment_category ORDER BY n DESC, token) AS rank FROM (
    SELECT sentiment_category, token, count(*) AS n FROM (SELECT sentiment_category, unnest(tokens_cleaned) AS token FROM scored)
    WHERE sentiment_category IN ('Positive', 'Negative') GROUP BY 1, 2)) WHERE rank <= 30"""))
def word_frequency_by_label(spark, sf):
    return W.word_frequency_by(scored(spark, sf), "sentiment_category", 30)


@query("word_frequency_by_language", with_cleaned("""SELECT lang, token, n, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, token) AS rank FROM (
    SELECT lang, token, count(*) AS n FROM (SELECT lang, unnest(tokens_cleaned) AS token FROM cleaned) GROUP BY 1, 2)) WHERE rank <= 20"""))
def word_frequency_by_language(spark, sf):
    return W.word_frequency_by(cleaned(spark, sf), "lang", 20, labels=None)


@query("raw_word_frequency", with_comments("""SELECT word, count(*) AS n FROM (
  SELECT regexp_replace(unnest(string_split_regex(lower(body), '\\s+')), '[^a-zA-Z0-9]', '', 'g') AS word FROM comments)
  WHERE word <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100"""))
def raw_word_frequency(spark, sf):
    return W.raw_word_frequency(comments(spark, sf), 100)


@query("top_k_per_group", "SELECT l_returnflag, l_suppkey, n, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY n DESC, l_suppkey) AS rank FROM (SELECT l_returnflag, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2)) WHERE rank <= 10")
def topk_groups(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy("l_returnflag", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return top_k_per_group(counts, "l_returnflag", "n", "l_suppkey", 10)


LANGS = (("de", "german"), ("en", "english"), ("es", "spanish"), ("fr", "french"))


def language_sql(select: str) -> str:
    words = ", ".join(f"SELECT '{code}' AS code, unnest([{sql_strings(default_stopwords(name))}]) AS token" for code, name in LANGS)
    words = words.replace(", SELECT '", " UNION ALL SELECT '")
    return f"""WITH {COMMENTS}, lists AS (SELECT DISTINCT * FROM ({words})),
tok AS (SELECT id, trim(unnest(string_split_regex(lower(body), '\\s+')), '.,!?;:') AS token FROM comments),
hits AS (SELECT id, code, count(*) AS n FROM tok JOIN lists USING (token) GROUP BY 1, 2),
best AS (SELECT id, code FROM hits QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, code) = 1),
found AS (SELECT c.id, c.lang, b.code AS language FROM comments c LEFT JOIN best b USING (id))
{select}"""


@query("detect_language", lambda: language_sql("SELECT id, lang, language FROM found"))
def detect_language(spark, sf):
    return W.add_language(comments(spark, sf)).select("id", "lang", "language")


@query("language_distribution", lambda: language_sql("SELECT language, count(*) AS n FROM found GROUP BY 1"))
def language_distribution(spark, sf):
    return W.language_distribution(W.add_language(comments(spark, sf)))


@query("term_frequency", with_cleaned("""SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(tokens_cleaned) AS term FROM cleaned) GROUP BY 1, 2"""))
def term_frequencies(spark, sf):
    return term_frequency(cleaned(spark, sf))


VOCAB = """tf AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(tokens_cleaned) AS term FROM cleaned) GROUP BY 1, 2),
vocab AS (SELECT term, CAST(sum(tf) AS BIGINT) AS corpus_count, count(*) AS doc_count FROM tf GROUP BY 1 HAVING count(*) >= {1} ORDER BY 2 DESC, 1 LIMIT {0})"""


@query("vocabulary", lambda: f"WITH {COMMENTS},\n{cleaned_sql()},\n{VOCAB.format(2000, 10)} SELECT *, round(ln(((SELECT count(*) FROM cleaned) + 1) / (doc_count + 1)), 6) AS idf FROM vocab")
def vocabulary_rows(spark, sf):
    return vocabulary(cleaned(spark, sf), 2000, 10).withColumn("idf", F.round("idf", 6))


@query("tfidf", lambda: f"""WITH {COMMENTS},\n{cleaned_sql()},\n{VOCAB.format(3000, 3)}
SELECT id, term, tf, round(tf * ln(((SELECT count(*) FROM cleaned) + 1) / (doc_count + 1)), 6) AS tfidf FROM tf JOIN vocab USING (term)""")
def tfidf_rows(spark, sf):
    return tfidf(cleaned(spark, sf), 3000, 3).withColumn("tfidf", F.round("tfidf", 6))


@query("tfidf_vectors", lambda: f"""WITH {COMMENTS},\n{cleaned_sql()},\n{VOCAB.format(3000, 3)},
w AS (SELECT id, sum(tf * ln(((SELECT count(*) FROM cleaned) + 1) / (doc_count + 1))) AS weight FROM tf JOIN vocab USING (term) GROUP BY 1)
SELECT id, round(coalesce(weight, 0), 4) AS weight FROM cleaned LEFT JOIN w USING (id)""")
def tfidf_vectors(spark, sf):
    from pyspark.ml.functions import vector_to_array

    df = cleaned(spark, sf)
    out = fit_text_vectors(df, 3000, 3).transform(df)
    weights = vector_to_array("features")
    return out.select("id", F.round(F.aggregate(weights, F.lit(0.0), lambda a, x: a + x), 4).alias("weight"))


@query("hashing_tfidf")
def hashing_tfidf_rows(spark, sf):
    from pyspark.ml.functions import vector_to_array

    out = hashing_tfidf(cleaned(spark, sf), 20000)
    weights = vector_to_array("features")
    return out.select("id", F.round(F.aggregate(weights, F.lit(0.0), lambda a, x: a + x), 4).alias("weight"))


@query("bucket_tfidf", with_cleaned("""SELECT id, bucket, tf, round(tf * ln(((SELECT count(*) FROM cleaned) + 1) / (count(*) OVER (PARTITION BY bucket) + 1)), 6) AS tfidf FROM (
  SELECT id, CAST('0x' || substring(md5(term), 1, 8) AS BIGINT) % 500 AS bucket, count(*) AS tf FROM (SELECT id, unnest(tokens_cleaned) AS term FROM cleaned) GROUP BY 1, 2)"""))
def bucket_tfidf(spark, sf):
    """Five hundred buckets, so that most hold several terms."""
    return V.bucket_tfidf(cleaned(spark, sf), 500).withColumn("tfidf", F.round("tfidf", 6))
