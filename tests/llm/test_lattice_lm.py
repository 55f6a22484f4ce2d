import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from llm_tables import CLASHES, edge_rows, empty, table, words
from remarklab.llm import lattice_lm as L
from remarklab.llm.common import remainder

PIECES = ["▁a", "b", "ab", "▁", "a", "ba", "▁ab", "bab", "é"]


def segmentations(text, pieces):
    if not text:
        yield []
    for n in range(1, len(text) + 1):
        if text[:n] in pieces or n == 1:
            for rest in segmentations(text[n:], pieces):
                yield [text[:n], *rest]


def weights():
    w = np.linspace(1, 2, len(PIECES) + 257)
    return np.log(w / w.sum())


def piece_weight(piece, w):
    if piece in PIECES:
        return w[PIECES.index(piece)]
    return sum(w[len(PIECES) + b] for b in piece.encode())


@pytest.mark.parametrize("word", ["a", "abab", "babab", "éaé", "x", "ab日b", "bbbbbbb"])
def test_marginal_is_the_sum_over_all_segmentations(word):
    w = weights()
    want, counts = 0.0, Counter()
    for pieces in segmentations("▁" + word, PIECES):
        p = math.exp(sum(piece_weight(x, w) for x in pieces))
        want += p
        for x in pieces:
            counts[x] += p
    many = L.Lattices(PIECES, w)
    assert many.single.log_probability(word.encode()) == pytest.approx(math.log(want) + w[-1])
    assert many.log_probabilities([word.encode()] * 3).tolist() == pytest.approx([math.log(want) + w[-1]] * 3)
    got = np.zeros(len(w))
    many.expected_counts([word.encode()], np.array([5]), got)
    for i, x in enumerate(PIECES):
        assert got[i] == pytest.approx(5 * counts[x] / want, abs=1e-9)
    bytes_expected = sum(n * len(x.encode()) for x, n in counts.items() if x not in PIECES)
    assert got[len(PIECES):].sum() == pytest.approx(5 * bytes_expected / want)


def test_long_words_and_batches_agree():
    own = L.load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    w = L.initial_weights(len(own))
    many = L.Lattices(own, w)
    sample = [x.encode() for x in words(200, 3).split()] + [b"x" * 500, "日本語テキスト".encode(), b"|", b"a" * 47, b"a" * 48, b"a" * 49]
    got = many.log_probabilities(sample)
    assert got.tolist() == pytest.approx([many.single.log_probability(x) for x in sample])
    times = np.arange(1, len(sample) + 1)
    one, two = np.zeros(len(w)), [0.0] * len(w)
    many.expected_counts(sample, times, one)
    for x, n in zip(sample, times.tolist()):
        many.single.expected_counts(x, n, two)
    assert one.tolist() == pytest.approx(two)


def by_counting(rows):
    tokens = [(i, (t or "").translate({k: k + 32 for k in range(65, 91)}).encode().split() + [None]) for i, t, _ in rows]
    c = Counter()
    for i, own in tokens:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            c.update(own)
    n, v = sum(c.values()), len(c)
    out = []
    for i, own in tokens:
        out.append((i, len(own), sum(c[x] > 0 for x in own), n, sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in own)))
    return out


@pytest.mark.parametrize("head", [1 << 17, 20, 1])
def test_base_scores(spark, monkeypatch, head):
    """The same whether words are broadcast or joined."""
    monkeypatch.setattr(L, "HEAD", head)
    rows = [*edge_rows(), *((100 + i, words(60, i, 40), None) for i in range(30)), (200, "K " * 80 + "x" * 100, None)]
    out = L.score_documents(table(spark, rows, CLASHES), PIECES, remainder("doc_id", 10) != 0)
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out.collect()))
    want = sorted((i is None, i or 0, a, b, n, round(s, 6)) for i, a, b, n, s in by_counting(rows))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want], rel=1e-9)


def test_scores_do_not_depend_on_the_head(spark, monkeypatch):
    docs = table(spark, [(i, words(50, i, 60), None) for i in range(40)])
    results = []
    for head in (1 << 17, 3):
        monkeypatch.setattr(L, "HEAD", head)
        results.append({r.doc_id: r.score for r in L.score_documents(docs, PIECES, F.col("doc_id") % 5 != 0).collect()})
    assert results[0] == pytest.approx(results[1])
    assert all(math.isfinite(x) and x < 0 for x in results[0].values())


def test_a_text_like_the_corpus_is_likelier(spark):
    own = L.load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    rows = [(i, words(80, i, 30), None) for i in range(60)] + [(100, words(80, 999, 30), None), (101, "zq xj vk wz qx " * 16, None)]
    out = {r.doc_id: r.score / r.n_tokens for r in L.score_documents(table(spark, rows), own, F.col("doc_id") < 60).collect()}
    assert out[100] > out[101] + 1


def test_empty_and_untrained(spark):
    assert L.score_documents(empty(spark), PIECES, F.lit(True)).count() == 0
    rows = L.score_documents(table(spark, [(1, "ab ab", None), (2, None, None)]), PIECES, F.lit(False)).orderBy("doc_id").collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]
    assert rows[0].score < 0 and rows[1].score == 0
