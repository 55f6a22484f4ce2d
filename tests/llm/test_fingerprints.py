import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from llm_tables import CLASHES, edge_rows, empty, table, words
from remarklab.llm import fingerprints as I


def test_edited_text_is_that_of_the_next_lower_id(spark):
    rows = [*edge_rows(), *((50 + 3 * i, words(30 + i, i) + " é😀", None) for i in range(40)), (-7, "low", None)]
    out = I.near_copies(table(spark, rows, CLASHES), least=1, share=1.0)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_chars, r.edited_sha256) for r in out.collect())
    assert len(got) == len(rows)
    single = [r for r in rows if [x[0] for x in rows].count(r[0]) == 1]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for i, text, _ in single:
        at = [r[0] for r in order].index(i)
        # the text that follows; among rows of equal id any may
        nexts = {r[1] or "" for r in order if r[0] == order[(at + 1) % len(order)][0]}
        text = text or ""
        k = len(text) // 3
        allowed = {hashlib.sha256((text[:len(text) - k] + n[:k]).encode()).hexdigest() for n in nexts}
        row = next(g for g in got if g[:2] == (i is None, i or 0))
        assert row[2] == len(text) and row[3] in allowed


@pytest.mark.parametrize("partitions", ["1", "4", "50"])
def test_next_text_over_ranges(spark, partitions):
    rng = random.Random(4)
    ids = rng.sample(range(-10**6, 10**6), 300) + list(range(10**12, 10**12 + 100))
    df = table(spark, [(i, f"text {i}", None) for i in ids])
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r.id: r.next_text for r in I.with_next(df, "doc_id", "text").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    order = sorted(ids, reverse=True)
    assert got == {i: f"text {order[(k + 1) % len(order)]}" for k, i in enumerate(order)}
    one = I.with_next(df.limit(1), "doc_id", "text").collect()
    assert len(one) == 1 and one[0].text == one[0].next_text


def terms_of(text):
    return {w.lower() for w in re.split(r"[\W_]+", text or "") if w}


def lexicon_of(texts, least, share):
    count = {}
    for t in texts:
        for w in terms_of(t):
            count[w] = count.get(w, 0) + 1
    return {w for w, n in count.items() if least <= n <= max(least, int(share * len(texts)))}, count


def hashes_of(spark, all_words):
    rows = spark.createDataFrame([(w,) for w in sorted(all_words)], "w string").select("w", F.xxhash64("w").alias("h")).collect()
    return {r.w: r.h % (1 << 64) for r in rows}


def plain_hashes(terms, hash_of):
    """All subsets' bytes, from the definition."""
    out = [[0] * I.SUBSETS for _ in range(I.LAYERS)]
    for w in terms:
        h = hash_of[w]
        layer, rest = 0, h >> 6
        while layer < I.LAYERS - 1 and rest & 3 == 0:
            layer, rest = layer + 1, rest >> 2
        out[layer][h & 63] ^= (h >> 40 & 0xFFFF) % 255 + 1
    return out


def read_hashes(fingerprint):
    """Subsets' bytes of a fingerprint: words are written highest byte first."""
    hashes = fingerprint.split(":")[2]
    assert len(hashes) == 2 * I.LAYERS * I.SUBSETS
    cells = [hashes[k:k + 16] for k in range(0, len(hashes), 16)]
    flat = [int(word[14 - 2 * b:16 - 2 * b], 16) for word in cells for b in range(8)]
    return [flat[k:k + I.SUBSETS] for k in range(0, len(flat), I.SUBSETS)]


def test_fingerprints_against_plain_reading(spark):
    rows = [(i, words(n, i, 300), None) for i, n in enumerate((3, 10, 15, 16, 40, 100, 300, 900, 2000))]
    rows += [(20 + i, rows[i][1], None) for i in range(len(rows))] + [(40, "Only here once", None), (41, "!!!", None)]
    df = table(spark, rows, CLASHES)
    out = I.fingerprint_documents(df, least=2, share=0.6)
    assert out.columns == [c for c in df.columns if c != "fingerprint"] + ["fingerprint"]
    got = {r.doc_id: r.fingerprint for r in out.collect()}
    lexicon, count = lexicon_of([t for _, t, _ in rows], 2, 0.6)
    hash_of = hashes_of(spark, count)
    beyond = {w for w, n in count.items() if n > int(0.6 * len(rows))}
    for i, t, _ in rows:
        if 2 * len(terms_of(t) & beyond) <= len(terms_of(t)):
            own = terms_of(t) & lexicon
            assert int(got[i].split(":")[0], 16) == len(own) and read_hashes(got[i]) == plain_hashes(own, hash_of)
    assert all(got[i] == got[20 + i] for i in range(9))


def edited(rows):
    """doc_id -> edited text, for distinct ids."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, text, _) in enumerate(order):
        third = len(text or "") // 3
        out[i] = (text or "")[:len(text or "") - third] + (order[(k + 1) % len(order)][1] or "")[:third]
    return out


@pytest.mark.parametrize("least, share", [(2, 0.5), (1, 1.0), (2, 0.1)])
def test_edited_fingerprints_are_those_of_their_texts(spark, least, share):
    """Cut, merged and rare words included: the fingerprint of an edited text is that of its terms in the lexicon."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 5))) for _ in range(300)]
    rows = [(3 * i, rng.choice([" ", ", ", "-"]).join(rng.choice(vocabulary) for _ in range(rng.randrange(60))), None)
            for i in range(60)] + [(1000, None, None), (1001, "word", None), (1002, "x" * 2000, None), (1003, "  ", None), (1004, "ab ab ab", None)]
    out = {r.doc_id: r for r in I.near_copies(table(spark, rows), least=least, share=share).collect()}
    lexicon, count = lexicon_of([t for _, t, _ in rows], least, share)
    changed = edited(rows)
    hash_of = hashes_of(spark, set(count) | {w for t in changed.values() for w in terms_of(t)})
    beyond = {w for w, n in count.items() if n > max(least, int(share * len(rows)))}
    checked = 0
    for i, text, _ in rows:
        for t, print_ in ((text or "", out[i].fingerprint), (changed[i], out[i].edited_fingerprint)):
            if 2 * len(terms_of(t) & beyond) <= len(terms_of(t)):
                own = terms_of(t) & lexicon
                assert int(print_.split(":")[0], 16) == len(own), (i, t)
                assert read_hashes(print_) == plain_hashes(own, hash_of)
                checked += 1
    assert checked > 10


def test_likeness_of_written_fingerprints(spark):
    rows = [(i, words(40 + 60 * (i % 4), i % 9, 300), None) for i in range(30)] + [(100, "", None)]
    out = I.near_copies(table(spark, rows))
    again = out.select("near_edited", I.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("read")).collect()
    assert len(again) == 31 and all(r.near_edited == r.read for r in again)


def test_single_row_is_its_own_next(spark):
    row = I.near_copies(table(spark, [(1, "one two three four five six", None)]), least=2).first()
    assert row.near_next == 1.0 and row.fingerprint.startswith("00000000:")


def jaccard(one, other):
    return len(one & other) / len(one | other) if one | other else 0.0


def test_likeness_is_close_to_the_share_of_equal_terms(spark):
    """Short and long texts at production parameters, with every share of equal terms."""
    rng = random.Random(2)
    rows = []
    for k in range(60):
        n = (30, 100, 400, 2000, 8000)[k % 5]
        base = [f"t{rng.randrange(40 * n)}" for _ in range(n)]
        share = rng.random()
        for copy in range(2):
            rows.append((4 * k + 2 * copy, " ".join(w if rng.random() < share else f"t{rng.randrange(40 * n)}" for w in base), None))
    # every word in at least two texts, so that all are in the band
    rows += [(1000 + i, t, None) for i, (_, t, _) in enumerate(rows)]
    out = {r.doc_id: r for r in I.near_copies(table(spark, rows)).collect()}
    texts, changed = {i: t for i, t, _ in rows}, edited(rows)
    lexicon, _ = lexicon_of(list(texts.values()), I.LEAST, I.SHARE)
    own = {i: terms_of(t) & lexicon for i, t in texts.items()}
    ids = sorted(texts)
    errors = []
    for k, i in enumerate(ids):
        errors.append((out[i].near_edited, jaccard(own[i], terms_of(changed[i]) & lexicon), len(own[i])))
        errors.append((out[i].near_next, jaccard(own[i], own[ids[k - 1]]), len(own[i])))
    assert all(got > 0.2 for got, want, _ in errors if want >= 0.5)
    for low, high in ((0, 200), (200, 1000), (1000, 9000)):
        part = [abs(got - want) for got, want, n in errors if low <= n < high]
        assert sum(part) / len(part) < 0.04 and max(part) < 0.25, (low, max(part))


def test_edges(spark):
    out = I.fingerprint_documents(table(spark, edge_rows(), CLASHES)).collect()
    by_text = {}
    for r in out:
        assert by_text.setdefault(r.text or "", r.fingerprint) == r.fingerprint
    assert len(out) == len(edge_rows())
    assert I.near_copies(empty(spark)).count() == 0 and I.fingerprint_documents(empty(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    docs = table(spark, edge_rows())
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = I.near_copies(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


@pytest.mark.parametrize("step", [1, 3])
def test_near_copies_of_a_third_of_the_rows(spark, step):
    """A group beyond the band, with ids side by side or each with a foreign text next to it."""
    base = words(120, 999, 3000).split()
    group = {step * i: " ".join([*base[:i], f"own{i}", *base[i + 1:]]) for i in range(30)}
    rows = [(i, group.get(i) or words(120, i, 3000), None) for i in range(90)]
    out = {r.doc_id: r for r in I.near_copies(table(spark, rows)).collect()}
    assert all(set(out[i].fingerprint.split(":")[2]) != {"0"} for i in group)
    assert sum(out[i].near_edited > 0 for i in group) > 20
    if step == 1:
        assert sum(out[i].near_next for i in range(1, 30)) / 29 > 0.5
