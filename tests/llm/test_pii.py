import random
import re

import pytest
from pyspark.sql import functions as F

from llm_tables import CLASHES, edge_rows, empty, table
from remarklab.llm import native, pii as P

BOOK = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    digits = [int(c) for c in reversed(number)]
    return sum(digits[::2]) % 10 == (-sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in value.split(".")),
            "card": lambda: 16 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 8 <= len(digits) <= 15}[kind]()


def by_the_book(text):
    return [(k, m.start(), m.end()) for k, p in BOOK.items() for m in re.finditer(p, text or "") if valid(k, m[0])]


def noise(rng):
    return rng.choice([
        "a@b", ".c", "@", ".", "-", "x_y%z", "12", "255", "256", "0001", "99999999999999999999", " ", "  ", "+", "(", ")", "1", "é", "😀", "\n",
        "4111111111111111", "4111-1111 1111-1111", "+1 (555) 123-4567", "me@mail.example.com", "10.0.0.1", "1.2.3.4.5.6.7.8", "+49 30", "٣",
        "5500005555555559", "378282246310005", "a@b.c_x@y.z", "x@y@z.com"])


def rows_of_noise():
    rng = random.Random(8)
    return [(i, "".join(noise(rng) for _ in range(25)), None) for i in range(150)]


def test_base_spans_equal_the_patterns(spark):
    rows = [*rows_of_noise(), *[(1000 + k, t, None) for k, (_, t, _) in enumerate(edge_rows())], (2000, None, None),
            (2001, "7" * 30000 + " a" * 100 + "b" * 30000 + "@c.d", None), (2002, "10.0.0.1 " * 3000, None), (2003, "+" + "1 " * 6 + "1" + "((" * 9000, None)]
    df = table(spark, rows, CLASHES)
    out = P.find_pii(df, P.Model())
    assert out.columns == [c for c in df.columns if c != "pii"] + ["pii"]
    for r in out.collect():
        assert [tuple(s)[:3] for s in r.pii] == by_the_book(r.text), r.doc_id
    assert out.count() == len(rows)


@pytest.mark.parametrize("block", [1, 3, 256])
def test_matches_are_placed_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(native, "BLOCK", block)
    texts = ["", "ab", "1", "é1😀22 333", "1" * 5, "a1" * 20, " ".join(str(i) for i in range(30)) + " end"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", native.matches(F.col("t"), "[0-9]+", 4, 3).alias("m")).collect():
        want = [(m.start(), m.end(), m[0]) for m in re.finditer("[0-9]+", r.t)]
        assert [tuple(x)[:3] for x in r.m] == want
        for x, m in zip(r.m, re.finditer("[0-9]+", r.t)):
            assert r.t[:m.start()].endswith(x.before) and r.t[m.end():].startswith(x.after)


def labelled_docs(spark):
    """Numbers after a call are phones, numbers after a count are none; both have the same forms."""
    rng = random.Random(2)
    rows = []
    for i in range(400):
        a, b = rng.randrange(200, 999), rng.randrange(1000, 9999)
        rows.append((i, f"call +1 ({a}) 555-{b} now" if i % 2 else f"count {a}{b}{a} of things", None))
    return table(spark, rows)


def test_trees_find_what_the_patterns_miss(spark):
    model = P.train(labelled_docs(spark))
    assert model.trees is not None and P.NUMBER in model.thresholds
    df = table(spark, [(1, "call (555) 555-1234 today", None), (2, "count 1234567890 of things", None), (3, "nothing here", None)], CLASHES)
    got = {r.doc_id: [tuple(s) for s in r.pii] for r in P.find_pii(df, model).collect()}
    assert [s[:3] for s in got[1]] == [("number", 5, 19)] and 0.5 <= got[1][0][3] <= 1
    assert got[2] == got[3] == []


def test_columns_score_as_the_library_does(spark):
    docs = labelled_docs(spark)
    model = P.train(docs)
    rows = P._with_matches(docs.select(F.col("text").alias("t")), "t", "base")
    flat = rows.select(F.explode(F.flatten(F.transform(f"{P.MARK}{P.NUMBER}", P._labelled(1)))).alias("c")).select("c.fields.*")
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    scored = model.trees.transform(VectorAssembler(inputCols=list(P.FEATURES), outputCol="features").transform(
        flat.withColumn("own", model.score(F.struct(*P.FEATURES)))))
    for r in scored.select("own", vector_to_array("probability").alias("p")).collect():
        assert r.own == pytest.approx(r.p[1])


def planted(n, first):
    """Contacts in forms that the base patterns miss."""
    rng = random.Random(first)
    out = []
    for i in range(n):
        phone = f"({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
        mail = f"john{i} (at) example{i} (dot) com"
        out.append((first + i, f"Some words, call me at {phone} or write to {mail} today", phone, mail))
    return out


def test_contacts_without_base_marks_are_found_with_them_in_training(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(3)
    contacts = planted(100, 10**6)
    counts = [(2 * 10**6 + i, f"it has {rng.randrange(10**9, 10**10)} parts of {rng.randrange(1000, 9999)}-{rng.randrange(1000, 9999)} on {rng.randrange(100, 999)} pages", None)
              for i in range(100)]
    df = docs.union(table(spark, [(i, t, None) for i, t, _, _ in contacts] + counts))
    model = P.train(df)
    assert set(model.thresholds) == {P.CONTACT, P.NUMBER}
    got = {r.doc_id: (r.text, [tuple(s) for s in r.pii]) for r in P.find_pii(df, model).collect()}
    base = {r.doc_id: [tuple(s) for s in r.pii] for r in P.find_pii(df, P.Model()).collect()}
    assert all([s for s in spans if s[0] in P.BASE] == base[i] for i, (_, spans) in got.items())
    found = [any(text[s[1]:s[2]] == phone for s in got[i][1]) for i, text, phone, _ in contacts]
    mails = [any(text[s[1]:s[2]].startswith(mail) for s in got[i][1]) for i, text, _, mail in contacts]
    assert sum(found) >= 90 and sum(mails) >= 90
    assert sum(bool(got[i][1]) for i, _, _ in counts) <= 5


def test_training_without_examples(spark):
    for docs in (empty(spark), table(spark, [(1, None, None), (2, "plain", None)]), table(spark, [(1, "call +1 (555) 555-1234", None)])):
        model = P.train(docs)
        assert model.trees is None or model.thresholds is not None
        assert P.find_pii(empty(spark), model).count() == 0


def test_redaction(spark):
    df = table(spark, [(1, "é me@mail.example.com or 10.0.0.1.", None), (2, None, None), (3, "clean", None)])
    out = {r.doc_id: r.text for r in P.redact(P.find_pii(df, P.Model())).collect()}
    assert out == {1: "é [EMAIL] or [IP].", 2: None, 3: "clean"}


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = P.find_pii(docs, P.train(docs))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange|Join", plan)


def test_training_takes_the_candidates_of_all_documents(spark, monkeypatch):
    """Beyond 20,000 documents and candidates nothing is left out."""
    seen = []

    class Trees:
        def __init__(self, **_):
            pass

        def fit(self, rows):
            seen.extend(rows.agg(F.sum("n"), F.count("n")).first())
            raise InterruptedError

    monkeypatch.setattr(P, "GBTClassifier", Trees)
    text = "if(id % 3 = 0, concat('write to a', id, '@example.com now'), concat('count ', 1000000000 + id, ' of things'))"
    docs = spark.range(45_000).selectExpr("id AS doc_id", f"{text} AS text")
    with pytest.raises(InterruptedError):
        P.train(docs)
    # 30,000 numbers, and three forms of 15,000 addresses; seven in ten are fitted
    assert seen[0] == pytest.approx(0.7 * 75_000, rel=0.03) and seen[1] < 5_000
