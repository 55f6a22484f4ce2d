import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from llm_tables import CLASHES, edge_rows, empty, table
from remarklab.llm import token_alignment as A
from remarklab.llm.queries import QUERIES

JSON, MODEL, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum")


@pytest.fixture(scope="module")
def libraries():
    first = tokenizers.Tokenizer.from_file(JSON)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=MODEL)


def spans(lengths):
    at = 0
    for n in lengths:
        yield at, at + n
        at += n


def groups_of(text, libraries):
    """Groups of (A ids, B ids), straight from the definition."""
    if not text:
        return []
    first, second = libraries
    letters = A.byte_alphabet()
    a = first.encode(" " + text, add_special_tokens=False).ids
    a_bytes = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
    b = second.encode(text)
    b_bytes = [bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
        return []
    a_ends = {end for _, end in spans(map(len, a_bytes))}
    common = sorted(a_ends & {end for _, end in spans(map(len, b_bytes))})
    out, start = [], 0
    for end in common:
        out.append(([i for i, (x, y) in zip(a, spans(map(len, a_bytes))) if start <= x and y <= end],
                    [i for i, (x, y) in zip(b, spans(map(len, b_bytes))) if start <= x and y <= end]))
        start = end
    return out


def brute_force(texts, libraries):
    groups = [groups_of(t, libraries) for t in texts]
    links = [Counter((x, y) for xs, ys in g for x in xs for y in ys) for g in groups]
    count = Counter(p for one in links for p in one)
    most = {}
    for (x, _), n in count.items():
        most[x] = max(most.get(x, 0), n)
    return [(sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(one.values()),
             ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g),
             sum(n for p, n in one.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in one.items()))
            for g, one in zip(groups, links)], count, links


def texts_of(rows):
    # brute force is quadratic in the groups of a text
    return [(i, t if t is None else t[:6000], lang) for i, t, lang in rows]


EXTRA = [
    (20, "<|endoftext|> and <s> and </s> <unk> <0x41>", None), (21, "a▁b is not given back", "en"), (22, " two  spaces\n\n\tand tabs ", "en"),
    (23, "a" * 700 + " " + "0123456789" * 20, None), (24, "日本語のテキスト 😀😀 ñandú ½ ² ③", "ja"), (25, "the the the the of the of the", "en"),
    (26, "\x00\x01 control", None), (27, " ", None), (28, "=" * 900 + "-" * 501, None),
]


def compare(out, rows, libraries):
    want, _, _ = brute_force([t for _, t, _ in rows], libraries)
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    got = sorted(((r.doc_id, *(r[c] for c in COLUMNS)) for r in out.collect()), key=key)
    assert got == sorted(((i, *w) for (i, _, _), w in zip(rows, want, strict=True)), key=key)


def test_equals_brute_force(spark, libraries):
    rows = texts_of(edge_rows()) + EXTRA
    df = table(spark, rows, (*CLASHES, "chunk", "plane", "groups", "N_A", "count_sum", "bucket"))
    out = A.align_documents(df.repartition(3), JSON, MODEL, PATTERN)
    assert {"fingerprint", "score", "lang"} < set(out.columns)
    compare(out, rows, libraries)


def test_many_chunks_buckets_and_salts(spark, libraries, monkeypatch):
    """Chunks of two documents, partial sums at every step, several salts."""
    rows = texts_of(edge_rows()) + EXTRA
    monkeypatch.setattr(A, "SPLITS_PER_SALT", 2)
    monkeypatch.setattr(A, "LANES", 4)
    out = A.align_documents(table(spark, rows).repartition(5), JSON, MODEL, PATTERN)
    compare(out, rows, libraries)


def test_pairs(spark, libraries):
    rows = texts_of(edge_rows()) + EXTRA
    _, count, links = brute_force([t for _, t, _ in rows], libraries)
    total = sum(links, Counter())
    got = {(r.a, r.b): (r.n_docs, r.n_links) for r in A.link_table(table(spark, rows), JSON, MODEL, PATTERN).collect()}
    assert got == {p: (n, total[p]) for p, n in count.items()}


def test_empty_table(spark):
    assert A.align_documents(empty(spark), JSON, MODEL, PATTERN).count() == 0


def test_query_on_nothing_but_empty_texts(spark, tmp_path):
    table(spark, [(1, None, None), (2, "", "en")]).write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op11_token_alignment"](spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in rows) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_query_digests(spark, sf, libraries):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").where("n_chars < 1500").collect()
    got = {r.doc_id: r for r in QUERIES["op11_token_alignment"](spark, sf).collect()}
    for r in docs:
        written = brute_force([r.text], libraries)[0][0][4]
        assert got[r.doc_id].groups_sha256 == (hashlib.sha256(written.encode()).hexdigest() if written else "")


def test_library_and_ranks_agree():
    data = A.read_file(JSON)
    fast, slow = A.ByteLevel(data, PATTERN), A.ByteLevel(data, None)
    assert fast.ranks is not None and slow.ranks is None
    for text in ("it's  odd\u0085  　x", "a" * 3000, " " * 300000, "\n \n" * 50):
        assert fast.encode(text).tolist() == slow.encode(text).tolist()


def test_long_runs_are_counted_without_expansion(spark):
    """A run whose tokens never end together is one group of many links."""
    text = "a" * 400001
    row = A.align_documents(table(spark, [(1, text, None)]), JSON, MODEL, PATTERN).first()
    assert row.n_links >= row.n_a and row.count_sum == row.n_links


def test_bitmaps_round_trip():
    rng = np.random.default_rng(1)
    documents = 300
    for share in (0.01, 0.05, 0.5, 1.0):
        lists = [np.flatnonzero(rng.random(documents) < share) for _ in range(40)] + [np.array([0]), np.arange(documents)]
        lists = [x for x in lists if len(x)]
        sizes = np.array([len(x) for x in lists])
        bits = A.compress(sizes, np.concatenate(lists), documents)
        assert A.popcounts(sizes, bits, documents).tolist() == sizes.tolist()
        got = sorted((int(w), int(o)) for which, ordinal in A.expand(sizes, bits, documents) for w, o in zip(which, ordinal))
        assert got == [(i, int(o)) for i, x in enumerate(lists) for o in x]


def test_chunks_stay_bounded(monkeypatch):
    monkeypatch.setattr(A, "CHUNK_PAIRS", 10)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([str(i) for i in range(9)])], names=["text"])
    monkeypatch.setattr(A, "slices", lambda b, c: (b.slice(i, 2) for i in range(0, b.num_rows, 2)))

    def align(texts):
        n = len(texts)
        keys = (np.arange(8 * n) << 16) | np.repeat(np.arange(n), 8)
        return [[0] * n] * 4 + [[""] * n, (keys, np.full(8 * n, 3))]

    out = list(A.chunks(iter([batch]), align, 2, 0))
    assert max(c for columns in out if columns[7][0] for c in columns[7]) <= 2
    assert {c for columns in out for c in columns[5]} == {(2 << 32) + i for i in range(5)}
