import random

import pytest

from llm_tables import CLASHES, edge_rows, empty, sorted_rows, table, words
from remarklab.llm import decontaminate as D

QUESTION = ("If a train leaves the station with 120 passengers and Alice counts 35 km of track before noon, "
            "how many hours does Alice wait until the 120 passengers arrive at the next station along the river?")


def bench(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def plain_windows(text):
    """Windows of one text as tuples of canonical words and their slots, without arrays."""
    import re

    out, previous = [], None
    for m in re.finditer(r"(?:[0-9A-Za-z\x80-\U0010ffff]|(?<=[0-9])[.,](?=[0-9]))+", text):
        w, low = m[0], m[0].translate({i: i + 32 for i in range(65, 91)})
        before = text[:m.start()]
        opening = not before or before[-1] in '.!?:;|\n\r"' or (before[-1] == " " and (len(before) < 2 or before[-2] in '.!?:;|\n\r"'))
        if w[0] in "0123456789" or low in D.NUMBERS:
            kind = "NUMBER"
        elif low in D.UNITS and previous == "NUMBER":
            kind = "UNIT"
        elif "A" <= w[0] <= "Z" and len(w) > 1 and not "A" <= w[1] <= "Z" and not opening:
            kind = "NAME"
        else:
            kind = None
        out.append((kind, low))
        previous = kind
    windows = []
    for i in range(len(out) - D.WINDOW + 1):
        own = out[i:i + D.WINDOW]
        if sum(k is None for k, _ in own) >= D.LITERALS:
            windows.append((i, tuple(k or w for k, w in own), [w for k, w in own if k]))
    return windows


def test_windows_equal_plain_reading():
    rng = random.Random(1)
    pool = ["Alice", "the", "USA", "3.5", "1,000", "km", "two", "Und", "déjà", "x9", "9x", "A", "end.", "a:", "|", "\n", "日本", "Mr.", "  ", "5", "kg"]
    for _ in range(60):
        text = " ".join(rng.choice(pool) for _ in range(40))
        want = plain_windows(text)
        owner, pos, hashes, _, _, _ = D.template_windows([None, text, ""])
        assert [p for p, _, _ in want] == pos.tolist() and set(owner.tolist()) <= {1}
        by_hash = {}
        for h, (_, w, _) in zip(hashes.tolist(), want):
            assert by_hash.setdefault(h, w) == w
        assert len(set(by_hash.values())) == len(by_hash)


def test_finds_copies_and_rewordings(spark):
    reworded = QUESTION.replace("120", "77").replace("Alice", "Robert").replace("35 km", "8 miles")
    broken = QUESTION.replace("Alice counts", "Robert counts").replace("120 passengers arrive", "9 passengers arrive")
    docs = table(spark, [
        (1, words(50, 1) + ". " + QUESTION + " " + words(40, 2), None), (2, "Start. " + reworded + " more words follow here", None),
        (3, "Start. " + broken, None), (4, QUESTION[:90] + words(30, 3), None), (5, words(200, 4), None), (6, "and then " + QUESTION, None),
        (6, "and then " + QUESTION, None), (None, QUESTION, None), (7, QUESTION + " " + QUESTION, None), *edge_rows()], CLASHES)
    items = [(0, QUESTION), (1, "too short"), (2, None), (3, "1 2 3 4 5 6 7 8 9 10"), (4, words(40, 50, 10**6))]
    found = D.contaminated(docs, bench(spark, items))
    got = sorted_rows(found, "doc_id", "item_id", "reworded")
    assert got == [(1, 0, False), (2, 0, True), (6, 0, False), (7, 0, False), (None, 0, False)]
    assert all(r.share == 1.0 or r.doc_id == 2 for r in found.collect())
    kept = D.drop_contaminated(docs, found)
    assert kept.columns == docs.columns
    left = sorted(str(r.doc_id) for r in kept.collect())
    want = sorted([str(i) for i, _, _ in edge_rows()] + ["3", "4", "5"])
    assert left == want


def test_share_against_counting(spark):
    rng = random.Random(2)
    items = [(i, words(rng.randrange(5, 60), 100 + i, 10**6)) for i in range(20)]
    rows = []
    for d in range(60):
        own = rng.choice(items)[1].split()
        cut = rng.randrange(len(own))
        own = own[:cut] + [f"other{d}"] * rng.randrange(2) + own[cut:]
        rows.append((d, "some filler first " + " ".join(own[: rng.randrange(5, len(own) + 2)]), None))
    got = {(r.doc_id, r.item_id): round(r.share, 9) for r in D.contaminated(table(spark, rows), bench(spark, items), threshold=0.3).collect()}
    want = {}
    for d, text, _ in rows:
        have = {w for _, w, _ in plain_windows(text)}
        for i, item in items:
            own = plain_windows(item)
            share = sum(w in have for _, w, _ in own) / len(own) if own else 0
            if share >= 0.3 - 1e-9:
                want[(d, i)] = round(share, 9)
    assert got == want and len(want) > 20


def test_empty_tables(spark):
    assert D.contaminated(empty(spark), bench(spark, [(0, QUESTION)])).count() == 0
    docs = table(spark, [(1, QUESTION, None)])
    none = D.contaminated(docs, bench(spark, []))
    assert none.count() == 0 and D.drop_contaminated(docs, none).count() == 1


@pytest.mark.parametrize("bits", [6, 24])
def test_filter_only_saves_work(spark, monkeypatch, bits):
    """A filter too small for the benchmark lets more windows through, and nothing else changes."""
    monkeypatch.setattr(D, "FILTER_BITS", bits)
    docs = table(spark, [(1, QUESTION, None), (2, words(100, 4), None)])
    assert sorted_rows(D.contaminated(docs, bench(spark, [(0, QUESTION)])), "doc_id") == [(1,)]


def test_copies_in_other_case(spark):
    names = "when Alice met Bob near Paris and Carol saw David with Erin in Rome before Frank left for Oslo again"
    docs = table(spark, [(10 * i + k, "so. " + change(text) + " and so on", None) for i, text in enumerate((QUESTION, names))
                         for k, change in enumerate((str, str.lower, str.upper, str.title))])
    for items in ([QUESTION, names], [QUESTION.upper(), names.lower()]):
        got = D.contaminated(docs, bench(spark, list(enumerate(items)))).collect()
        assert sorted((r.doc_id, r.item_id) for r in got) == [(10 * i + k, i) for i in (0, 1) for k in range(4)]
        assert all(r.share > 0.8 and not r.reworded for r in got)
    changed = names.replace("Alice", "Zoe").replace("Rome", "Bern")
    got = D.contaminated(table(spark, [(1, changed, None)]), bench(spark, [(0, names)])).collect()
    assert [r.reworded for r in got] == [True]


def test_items_without_a_regular_window(spark):
    items = ["What is 12 + 30?", "7 times 8 is 56 and 9 times 6 is 54", "Name a river", "Alice Bob Carol Dave Erin Frank", "forty two", "1 2 3 4 5 6 7"]
    docs = [(i, f"before it. {text} and more", None) for i, text in enumerate(items)]
    docs += [(10, "FORTY, two!", None), (11, "what is 12 and 30", None), (12, "7 6 5 4 3 2 1 1 2 3 4", None), (13, "alice bob carol dave erin frank", None),
             (14, "name some river", None)]
    got = sorted_rows(D.contaminated(table(spark, docs), bench(spark, list(enumerate(items)))), "doc_id", "item_id", "share")
    assert got == [(0, 0, 1.0), (1, 1, 1.0), (2, 2, 1.0), (3, 3, 1.0), (5, 5, 1.0), (10, 4, 1.0), (13, 3, 1.0)]


def test_one_changed_occurrence_drops_its_windows_only(spark):
    item = (words(25, 70, 10**6) + " near 120 boats for Alice " + words(25, 71, 10**6) + " then 120 carts by Alice " + words(25, 72, 10**6))
    once = item.replace("120 carts", "121 carts")
    other = item.replace("120 boats", "9 boats").replace("Alice then", "Zoe then")
    renamed = item.replace("120", "77").replace("Alice", "Zoe").replace("77 carts", "78 carts")
    rng = random.Random(3)
    scrambled = " ".join(str(rng.randrange(10**6)) if w.isdigit() else w for w in ("in 7 it is so " * 20).split())
    docs = table(spark, [(1, once, None), (2, other, None), (3, renamed, None), (4, scrambled, None)])
    got = {(r.doc_id, r.item_id): r for r in D.contaminated(docs, bench(spark, [(0, item), (1, "in 7 it is so " * 20)])).collect()}
    assert sorted(got) == [(1, 0), (2, 0), (3, 0)]
    total = len(plain_windows(item))
    for k, r in got.items():
        assert r.n_windows == total and 0.8 <= r.share < 1 and r.reworded, k
    assert got[(1, 0)].matched == total - 5


def with_boilerplate(n_items, n_docs):
    """Items that share a long sentence, documents with that sentence only, and some documents with whole items."""
    shared = words(40, 77, 5000)
    items = [(i, f"{shared} {words(9, 500 + i, 5000)}") for i in range(n_items)]
    rows = [(i, f"{words(10, 900 + i, 5000)} {shared} {words(10, 1900 + i, 5000)}", None) for i in range(n_docs)]
    rows += [(10**6 + i, f"{words(10, i, 5000)} {items[i][1]} {words(10, 50 + i, 5000)}", None) for i in range(5)]
    return items, rows


def test_a_sentence_of_all_items_joins_nothing(spark, monkeypatch):
    met = []
    candidates = D._candidate_windows
    monkeypatch.setattr(D, "_candidate_windows", lambda *a: (met.append(candidates(*a)), met[-1])[1])
    for n_items, n_docs in ((20, 50), (40, 100)):
        items, rows = with_boilerplate(n_items, n_docs)
        # two windows of three of an item are those of the shared sentence: not enough for all of it
        got = D.contaminated(table(spark, rows), bench(spark, items), threshold=0.9)
        assert sorted((r.doc_id - 10**6, r.item_id) for r in got.collect()) == [(i, i) for i in range(5)]
        # a whole item has at most 45 windows, in both forms
        assert met[-1].count() <= 5 * 2 * 45 * 2


def test_rare_windows_lose_nothing(spark, monkeypatch):
    rng = random.Random(6)
    sentences = [words(12, i, 200) for i in range(12)]
    items = [(i, " ".join(rng.choice(sentences) for _ in range(rng.randrange(1, 5)))) for i in range(30)] + [(50, QUESTION), (51, "two words"), (52, None), (53, "")]
    rows = [(i, " ".join(rng.choice(sentences) for _ in range(rng.randrange(1, 9))), None) for i in range(60)]
    rows += [(100, QUESTION.replace("120", "77"), None), (None, QUESTION, None), (None, QUESTION, None), (101, None, None), (102, items[0][1], None)] + edge_rows()
    df = table(spark, rows)
    columns = ("doc_id", "item_id", "n_windows", "matched", "share", "reworded")
    got = sorted_rows(D.contaminated(df, bench(spark, items)), *columns)
    monkeypatch.setattr(D, "_candidate_windows", lambda hits, known, sizes, threshold: hits.join(known, "hash"))
    assert got == sorted_rows(D.contaminated(df, bench(spark, items)), *columns) and len(got) > 30


def test_documents_go_also_when_they_are_many(spark, monkeypatch):
    rows = [(1, QUESTION, None), (2, "clean text of a few words", None), (None, QUESTION, None), (3, None, None)]
    df = table(spark, rows)
    found = D.contaminated(df, bench(spark, [(7, QUESTION)]))
    few = sorted_rows(D.drop_contaminated(df, found), "doc_id")
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    assert few == sorted_rows(D.drop_contaminated(df, found), "doc_id") == sorted_rows(df.where("doc_id > 1"), "doc_id")
