import random

import numpy as np
import pytest

from llm_tables import CLASHES, edge_rows, empty, table, words
from remarklab.llm import suffix_dedup as D


def brute_force(rows, length):
    """Removed bytes of rows ordered by id: every string that started earlier."""
    seen, out = set(), []
    for _, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - length + 1):
            if data[s:s + length] in seen:
                gone[s:s + length] = True
            seen.add(data[s:s + length])
        out.append((len(data), gone))
    return out


def spans_of(gone):
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
    return [tuple(x) for x in edges.reshape(-1, 2).tolist()]


def check(spark, rows, length, **conf):
    got = sorted(D.remove_repeats(table(spark, [(i, t, None) for i, t in rows], CLASHES), length=length).collect(), key=lambda r: r.doc_id)
    for r, (i, text), (n, gone) in zip(got, rows, brute_force(rows, length), strict=True):
        data = np.frombuffer((text or "").encode(), np.uint8)
        assert (r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) == (i, n, spans_of(gone), data[~gone].tobytes()), i


def passages(seed, n, count=40):
    """Texts made of own words and of shared passages cut at random places."""
    rng = random.Random(seed)
    shared = [words(60, 1000 + k, 10**6) for k in range(6)] + ["line that repeats. " * 8, "aba" * 80]
    rows = []
    for i in range(count):
        parts = []
        for k in range(n):
            p = rng.choice(shared)
            a = rng.randrange(len(p))
            parts += [words(rng.randrange(12), rng.random(), 10**6), p[a:a + rng.randrange(20, 400)] if rng.random() < 0.8 else p]
        rows.append((i * 3, " ".join(parts)))
    return rows + [(500, rows[0][1]), (501, None), (502, ""), (503, "short"), (504, "z" * 700), (505, rows[3][1][5:])]


@pytest.mark.parametrize("seed,length", [(1, 100), (2, 40)])
def test_equals_brute_force(spark, seed, length):
    check(spark, passages(seed, 4), length)


def test_small_buckets_and_segments(spark, monkeypatch):
    """Classes are split over buckets, and texts over segments."""
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        rows = passages(5, 3, 25) + [(700 + i, "the same short passage " * 6 + f"end {i}") for i in range(60)]
        check(spark, rows, 60)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("seed", range(6))
def test_runs_cover_all_windows_alike(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(D, "SEGMENT", 512)
    common = bytes(rng.randrange(97, 103) for _ in range(900))
    data = np.frombuffer(bytes(rng.randrange(97, 100) for _ in range(rng.randrange(700))) + common, np.uint8)
    first, count, gram, content = D.runs(data, 50)
    assert (np.concatenate([np.arange(a, a + n) for a, n in zip(first, count)]) == np.arange(len(data) - 49)).all()
    # the same windows elsewhere belong to runs of the same grams
    other = np.frombuffer(common, np.uint8)
    ours = {bytes(data[s:s + 50]): g for a, n, g in zip(first, count, gram) for s in range(a, a + n)}
    for a, n, g in zip(*D.runs(other, 50)[:3]):
        for s in range(a, a + n):
            assert ours[bytes(other[s:s + 50])] == g


@pytest.mark.parametrize("buckets", [1, 2, 7, 40])
def test_buckets_decide_alone(buckets):
    """Any splitters: each bucket by itself finds the same first entries."""
    rng = np.random.default_rng(buckets)
    n = 600
    gram = rng.integers(0, 12, n).astype("<u8")
    entries = {"gram": gram, "content": (gram * 10 + rng.integers(0, 3, n).astype("<u8")), "id": rng.integers(0, 40, n).astype("<i8"),
               "digest": rng.integers(0, 2, n).astype("<u4"), "start": rng.integers(0, 5, n).astype("<u4"), "count": np.ones(n, "<u2")}
    splitters = D.choose_splitters(D._take(entries, rng.integers(0, n, 200)), buckets)
    bucket = D.bucket_of(entries, splitters)
    keys = list(zip(*(entries[k].tolist() for k in D.KEYS)))
    split = list(zip(*(splitters[k].tolist() for k in D.KEYS)))
    assert bucket.tolist() == [sum(s < k for s in split) for k in keys]
    least = {}
    for k in keys:
        least[k[:2]] = min(least.get(k[:2], k), k)
    classes = {}
    for k in keys:
        classes.setdefault(k[0], set()).add(k[1])
    for b in set(bucket.tolist()):
        own, repeat, border = D.compare_bucket(D._take(entries, np.flatnonzero(bucket == b)), splitters, b)
        got = list(zip(*(own[k].tolist() for k in D.KEYS)))
        assert got == sorted(got)
        assert [least[k[:2]] < k for k in got] == repeat.tolist()
        # every first entry of a gram with several classes is a border
        for k, is_border in zip(got, border.tolist()):
            if least[k[:2]] == k and len(classes[k[0]]) > 1:
                assert is_border or got[got.index(k)] == k and got.count(k) > 1
    packed = D.unpack(D.pack(entries))
    assert all((packed[k] == entries[k]).all() for k in entries)


def test_edges(spark):
    out = D.remove_repeats(table(spark, edge_rows(), CLASHES))
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append((r.n_bytes, sum(s.end - s.start for s in r.spans)))
    assert got[1] == got[2] == [(0, 0)] and got[0][0][1] == 0
    n = got[0][0][0]
    assert got[3] == [(n, n)] and got[5][0] == got[5][1] and got[5][0][1] == 0  # a row given twice is one document
    assert sorted(x[1] == x[0] for x in got[6]) == [True, True]
    assert len(got[None]) == 2 and sum(map(len, got.values())) == len(edge_rows())
    assert D.remove_repeats(empty(spark)).count() == 0


def test_sample_is_bounded_by_entries(spark, monkeypatch):
    """Texts of megabytes: the sample stays small, and the number of entries, from which buckets follow, is exact."""
    monkeypatch.setattr(D, "SAMPLE_ENTRIES", 1000)
    rng = np.random.default_rng(4)
    long = [bytes(rng.integers(97, 123, 1 << 21, dtype=np.uint8)).decode() for _ in range(3)]
    df = table(spark, [(i, t, None) for i, t in enumerate(long)] + [(10 + i, "short text " * 9, None) for i in range(5)])
    docs = D._documents(df, "doc_id", "text")
    want = sum(len(D.runs(np.frombuffer(t.encode(), np.uint8))[0]) for t in long)
    everything, n = D._sample(docs.where("id < 3"), D._run_entries(100), 1.0)
    assert n == want == len(everything["gram"])
    few, n = D._sample(docs.where("id < 3"), D._run_entries(100), 1000 / want)
    assert n == want and 800 < len(few["gram"]) < 1200
    seen = []
    sample = D._sample
    monkeypatch.setattr(D, "_sample", lambda *a: (seen.append(sample(*a)), seen[-1])[1])
    out = D.remove_repeats(df).collect()
    assert len(out) == 8 and all(len(entries["gram"]) < 1500 for entries, _ in seen)


def test_windows_have_two_hashes():
    """The hash of a window and that of its halves are apart, and tell the same windows from each other."""
    text = D.Substrings(np.frombuffer(words(200, 1).encode(), np.uint8))
    whole = text.windows(100)
    halves = D._mix(text.windows(50, 0, len(whole) - 1) * np.uint64(D._BASE) + text.windows(50, 50, len(whole) + 49))
    assert len(np.unique(halves)) == len(np.unique(whole)) and not (halves == whole).any()
