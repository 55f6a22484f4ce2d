import base64
import hashlib
import struct

import public_tokenizers
import pytest
import tiktoken

from llm_tables import CLASHES, edge_rows, empty, table
from remarklab.llm import byte_bpe as B

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_equals_the_library_and_decodes(spark, library):
    rows = [*edge_rows(), (20, "<|endoftext|> 's'RE  \n\n x" * 3, None), (21, "a" * 20000 + "ab" * 5000, None), (22, "⠀⣿\x00", None)]
    df = table(spark, rows, CLASHES)
    out = B.decode_documents(B.encode_documents(df, PATH, PATTERN), PATH, PATTERN)
    assert [c for c in out.columns if c in df.columns] == [c for c in df.columns if c not in ("n_tokens", "token_ids")] + ["n_tokens", "token_ids"]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, hashlib.md5(bytes(r.token_ids)).hexdigest(), bytes(r.decoded)) for r in out.collect())
    want = []
    for i, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        packed = struct.pack(f"<{len(ids)}I", *ids)
        want.append((i is None, i or 0, len(ids), hashlib.md5(packed).hexdigest(), (text or "").encode()))
    assert got == sorted(want)


def test_empty_table(spark):
    assert B.encode_documents(empty(spark), PATH, PATTERN).count() == 0


def test_model_refuses_gaps():
    with pytest.raises(ValueError):
        B.sentencepiece_model({b"a": 0, b"b": 2})


def test_cache_is_bounded(monkeypatch, library):
    monkeypatch.setattr(B, "CACHE_ENTRIES", 3)
    codec = B.Codec(B.sentencepiece_model(B.read_ranks(PATH)), PATTERN)
    text = "one two three four five six seven one two"
    assert struct.unpack("<9I", codec.encode(text)) == tuple(library.encode_ordinary(text)) and len(codec.cache) <= 3
