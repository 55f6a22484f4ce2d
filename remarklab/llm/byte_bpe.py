"""Byte-level BPE: a rank file as a sentencepiece BPE model, encoding and decoding of whole texts.

The rank file lists byte strings with their merge ranks. Every byte is written as one character of a
block of 256, so each entry is a piece of text, and the piece's score is its negative rank: the
processor's best-scored merge is then the merge of lowest rank. The normaliser is the identity, and a
text is cut into pre-tokens before the processor sees it, so no merge crosses a pre-token.
"""

from __future__ import annotations

import base64
import struct

import regex
from pyspark.sql import DataFrame

from remarklab.llm.common import append_columns, held

# first of the 256 characters that stand for the bytes
BYTE_BLOCK = 0x2800
TO_BLOCK = {b: BYTE_BLOCK + b for b in range(256)}
# pre-tokens that a worker remembers, and the longest that it remembers
CACHE_ENTRIES, CACHE_LENGTH = 300_000, 64
# a rank file beyond this size is refused: the model travels with every task
MODEL_BYTES = 64 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """The entries of a rank file (base64 token and rank on each line)."""
    with open(path, "rb") as file:
        data = file.read(MODEL_BYTES + 1)
    if len(data) > MODEL_BYTES:
        raise ValueError(f"{path} has more than {MODEL_BYTES} bytes")
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def as_block(token: bytes) -> str:
    """The bytes as characters of the block."""
    return token.decode("latin-1").translate(TO_BLOCK)


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """A serialised BPE model whose piece ids are the ranks; the unknown piece comes last.

    Ranks must run from 0 without gaps and all 256 bytes must have one.
    """
    ordered = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in ordered] != list(range(len(ordered))) or not all(bytes([b]) in ranks for b in range(256)):
        raise ValueError("ranks must run from 0 without gaps and cover all bytes")
    # piece: 1 text, 2 score, 3 type (1 normal, 2 unknown)
    pieces = [_field(1, as_block(t).encode()) + _field(2, -float(i)) + _field(3, 1) for i, t in enumerate(ordered)]
    pieces.append(_field(1, b"<unk>") + _field(2, -float(len(ordered))) + _field(3, 2))
    none = (1 << 64) - 1  # -1: no such piece
    trainer = _field(3, 2) + _field(4, len(pieces)) + _field(40, len(ordered)) + b"".join(_field(n, none) for n in (41, 42, 43))
    identity = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, identity)


class Codec:
    """Encoder and decoder over a serialised model."""

    def __init__(self, model: bytes, pattern: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(pattern).findall
        size = self.processor.get_piece_size() - 1
        pieces = [bytes(ord(c) - BYTE_BLOCK for c in self.processor.id_to_piece(i)) for i in range(size)]
        self.pieces = pieces
        # an entry that merges alone don't reach still encodes to itself when it is a whole pre-token
        whole = {as_block(p): i for i, p in enumerate(pieces)}
        got = self.processor.encode(list(whole), num_threads=1)
        self.exceptions = {text: [i] for (text, i), ids in zip(whole.items(), got) if ids != [i]}
        self.cache: dict[str, bytes] = {}

    def _encode(self, token: str) -> bytes:
        block = as_block(token.encode())
        ids = self.exceptions.get(block) or self.processor.encode(block)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(token) <= CACHE_LENGTH:
            if len(self.cache) >= CACHE_ENTRIES:
                self.cache.clear()
            self.cache[token] = packed
        return packed

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        known, slow = self.cache.get, self._encode
        return b"".join([known(t) or slow(t) for t in self.split(text or "")])

    def decode(self, ids: bytes | None) -> bytes:
        """The bytes that the ids stand for."""
        pieces = self.pieces
        return b"".join([pieces[i] for (i,) in struct.iter_unpack("<I", ids or b"")])


def codec(model: bytes, pattern: str) -> Codec:
    return held(("byte_bpe", model, pattern), lambda: Codec(model, pattern))


def encode_documents(df: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``n_tokens`` (bigint) and ``token_ids`` (binary, little-endian unsigned 32-bit) to every row.

    ``path`` is a rank file on the driver, ``pattern`` the pre-token pattern, whose matches must cover
    any text. NULL and empty texts get no ids (0, empty binary). Row order, repeated rows and other
    columns stay as they are; columns named like the new ones are replaced. An empty table gives an
    empty one. Nothing is shuffled.
    """
    model = sentencepiece_model(read_ranks(path))

    def make():
        encode = codec(model, pattern).encode

        def run(texts):
            packed = [encode(t) for t in texts]
            return [len(p) // 4 for p in packed], packed

        return run

    return append_columns(df, text, "n_tokens bigint, token_ids binary", make, keep)


def decode_documents(df: DataFrame, path: str, pattern: str, ids: str = "token_ids", keep: list[str] | None = None) -> DataFrame:
    """Add ``decoded`` (binary): the bytes of the packed ids; NULL ids decode to no bytes.

    The bytes of ``encode_documents`` are those of the text in UTF-8. Ids that are no piece fail.
    """
    model = sentencepiece_model(read_ranks(path))

    def make():
        decode = codec(model, pattern).decode
        return lambda values: [[decode(v) for v in values]]

    return append_columns(df, ids, "decoded binary", make, keep)
