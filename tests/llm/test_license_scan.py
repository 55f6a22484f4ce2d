import random
import re

import pytest

from llm_tables import CLASHES, edge_rows, empty, table
from remarklab.llm import license_scan as L

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def by_counting(data, notices, threshold, block):
    """All blocks against all notices."""
    out, start = [], 0
    for line in data.split(b"\n"):
        words = WORD.findall(line)
        step = max(1, block // 2)
        for at in range(0, max(1, len(words) - block + step), step):
            own = set(words[at:at + block])
            for k, (_, notice) in enumerate(notices):
                wanted = set(notice.encode().split())
                share = len(wanted & own) / len(wanted)
                if share >= threshold - 1e-9:
                    out.append((start + at, k, share))
        start += len(words)
    return out


@pytest.mark.parametrize("seed", range(25))
def test_join_is_exact(seed):
    rng = random.Random(seed)
    pool = [w for _, n in L.NOTICES for w in n.split()] + ["filler", "words", "thé"] * 20
    lines = []
    for _ in range(12):
        label, notice = rng.choice(L.NOTICES)
        own = notice.split()
        keep = [w for w in own if rng.random() < 0.9] if rng.random() < 0.6 else []
        lines.append(" ".join(rng.choices(pool, k=rng.randrange(70)) + keep))
    data = "\n".join(lines).lower().encode()
    frequency = {w: rng.randrange(5) for w in pool}
    for threshold in (0.5, 0.8, 1.0):
        matcher = L.Matcher(L.NOTICES, frequency, threshold, 16)
        got = [(at, k, share) for at, words in matcher.blocks(data) for k, share, _ in matcher.match(words)]
        assert got == by_counting(data, L.NOTICES, threshold, 16)


def test_rows(spark):
    rows = [*edge_rows(), (20, "x\nLicensed under CC BY-NC 4.0. All RIGHTS\nreserved", None), (21, "GNU General Public License, cc by cc by", None)]
    df = table(spark, rows, CLASHES)
    out = {r.doc_id: r for r in L.scan_documents(df).where("doc_id >= 20").collect()}
    assert [(p.label, p.start) for p in out[20].places] == [("cc-by", 3), ("reserved", 8)]
    assert [(p.label, p.start) for p in out[21].places] == [("gpl", 1), ("cc-by", 4), ("cc-by", 6)]
    assert {n.label for n in out[20].notices if n.best} == {"cc-by-nc"}
    counts = {r.doc_id: (r.n_words, len(r.places)) for r in L.scan_documents(df).collect()}
    assert counts[1] == counts[2] == counts[9] == (0, 0) and counts[8][0] == 30000
    assert L.scan_documents(df).count() == len(rows)
    assert L.scan_documents(empty(spark)).count() == 0


def test_frequencies_cover_all_rows(spark):
    df = table(spark, [(i, "license " + ("apache " if i % 3 == 0 else "") * 2, None) for i in range(30)])
    assert L.word_frequencies(df, "text", {"license", "apache", "mit"}) == {"license": 30, "apache": 10}


def sliding(data, notices, threshold, block):
    """Best containment of every notice over all windows of the text, one word apart, across line breaks."""
    words, out = WORD.findall(data), {}
    for k, (_, notice) in enumerate(notices):
        wanted = set(notice.encode().split())
        share = max(len(wanted.intersection(words[at:at + block])) / len(wanted) for at in range(max(1, len(words) - block + 1)))
        if share >= threshold - 1e-9:
            out[k] = share
    return out


@pytest.mark.parametrize("seed", range(25))
def test_windows_are_exact_across_lines(seed):
    rng = random.Random(seed)
    words = []
    for _ in range(8):
        own = rng.choice(L.NOTICES)[1].split()
        for w in own:
            words += [w] * (rng.random() < 0.93) + ["filler"] * (rng.randrange(4) * (rng.random() < 0.4))
        words += rng.choices([*own, "words"], k=rng.randrange(30))
    data = "".join(w + rng.choice("   \n") for w in words).encode()
    for threshold, block in ((0.5, 16), (0.8, 48), (1.0, 48)):
        matcher = L.Matcher(L.NOTICES, {w: rng.randrange(5) for w in words}, threshold, block)
        got, tokens = {}, WORD.findall(data)
        for at, n, k, share, _ in matcher.scan(data, tokens):
            own = matcher.sets[k]
            assert n <= block and len(own.intersection(tokens[at:at + n])) / len(own) == share
            got[k] = max(got.get(k, 0), share)
        assert got == sliding(data, L.NOTICES, threshold, block)


def test_wrapped_notices_are_found(spark):
    texts = [
        ("bsd", "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that"),
        ("gpl", "it under the terms of the GNU General Public License as published by\nthe Free Software Foundation"),
        ("apache-2.0", " * You may obtain a copy of the License at\n *\n *     http://www.apache.org/licenses/LICENSE-2.0"),
        ("isc", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted"),
        ("mit", "one " * 30 + "permission is hereby granted free of " + "so " * 20 + "charge to any person obtaining a copy of this software")]
    df = table(spark, [(i, text, None) for i, (_, text) in enumerate(texts)])
    for r in L.scan_documents(df).collect():
        assert {n.label for n in r.notices if n.best} == {texts[r.doc_id][0]}


def test_many_copies_take_linear_time():
    text = ("licensed under the gnu lesser general public license\nversion 3 " * 20000).encode()
    matcher = L.Matcher(L.NOTICES, {}, 0.8)
    found = matcher.windows(WORD.findall(text))
    assert sum(L.NOTICES[k][0] == "lgpl" and b for _, _, k, _, b in found) == 20000
    assert not any(L.NOTICES[k][0] == "agpl" and b for _, _, k, _, b in found)
