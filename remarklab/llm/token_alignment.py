"""Alignment of two tokenizers: groups of tokens between common ends, linked id pairs, documents per pair.

A text is encoded by a byte-level vocabulary (A) and a sentencepiece model (B). Byte offsets where
tokens of both end cut the tokens into groups, and all A-B occurrences in a group are linked.

How many documents hold a pair is counted with inverted bitmaps. Each task numbers its documents in
chunks of at most 65,536; a chunk's postings are, for every linked pair, the bitmap of its documents,
compressed as 16-bit numbers or as bits, whichever is smaller, and multiplicity planes: plane k has
the documents in whose number of further links of the pair bit k - 1 is set. Bitmaps of a pair are
merged over chunks (their documents differ, so the OR is a union of containers) and popcounted: the
documents of the pair, and with the planes its links. The scores then travel back along the postings:
each document in a bitmap gets the pair's count as often as the planes say.

Postings are dealt out by a hash of the pair, so a pair in every document costs a bit a document, not
a row; no task holds more than a slice of the pair table and one chunk's postings at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from remarklab.llm.common import cut, free_name, ship_package, slices, small_batches

# documents and linked pairs that one chunk of postings holds at most (a single document may have more pairs)
CHUNK_DOCUMENTS, CHUNK_PAIRS = 1 << 16, 1 << 21
# pairs are hashed to BUCKETS, and LANES tasks share them for each salt
BUCKET_BITS, ORDINAL_BITS = 6, 16
BUCKETS, LANES = 1 << BUCKET_BITS, 16
# splits of the input whose postings meet in one task of a lane
SPLITS_PER_SALT = 64
PAIR_BITS = 63 - BUCKET_BITS - ORDINAL_BITS
# groups with more links are counted by distinct ids instead of being expanded
WIDE_GROUP = 4096
# pairs or documents that a task adds up before it hands on a partial sum
HELD = 1 << 22
# vocabulary files beyond this size are refused: they travel with every task
FILE_BYTES = 64 << 20


def read_file(path: str) -> bytes:
    with open(path, "rb") as file:
        data = file.read(FILE_BYTES + 1)
    if len(data) > FILE_BYTES:
        raise ValueError(f"{path} has more than {FILE_BYTES} bytes")
    return data


def byte_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies write for the 256 bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Encoder of a byte-level BPE file of the tokenizers library.

    Where merges are numbered like the ids they make, as usual, and the standard pattern splits, the
    same merges run as ranks, which is several times faster; texts that this refuses (very long runs
    of white space) and all other files go through the library.
    """

    def __init__(self, data: bytes, pattern: str | None):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        spec = json.loads(data)
        if spec["model"]["type"] != "BPE" or spec.get("normalizer"):
            raise ValueError("not a byte-level BPE file without normaliser")
        letters = byte_alphabet()
        vocabulary = {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec["added_tokens"]}}
        added = {t["id"] for t in spec["added_tokens"]}
        self.pieces = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            self.pieces[i] = piece.encode() if i in added else bytes(letters[c] for c in piece)
        self.library = tokenizers.Tokenizer.from_str(data.decode())
        self.library.encode_special_tokens = True
        self.ranks = None
        merged = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in spec["model"]["merges"]]
        if pattern and merged == list(range(256, 256 + len(merged))):
            import tiktoken

            ranks = {piece: i for i, piece in enumerate(self.pieces) if i not in added}
            self.ranks = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if self.ranks is not None:
            try:
                return self.ranks.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
            except BaseException as error:  # the splitter's stack is bounded; its error is no subclass of Exception
                if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.int64)


class Pieces:
    """Encoder of a sentencepiece model, with the bytes of its pieces."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.model.get_piece_size()
        self.pieces = [
            bytes([int(self.model.id_to_piece(i)[3:-1], 16)]) if self.model.is_byte(i)
            else self.model.id_to_piece(i).replace("▁", " ").encode() for i in range(size)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def codecs(a: bytes, b: bytes, pattern: str | None) -> tuple[ByteLevel, Pieces, Aligner]:
    first, second = ByteLevel(a, pattern), Pieces(b)
    return first, second, Aligner(first.pieces, second.pieces)


def exclusive(counts: np.ndarray) -> np.ndarray:
    """Sums of all counts before each one, and of all."""
    out = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts, out=out[1:])
    return out


class Aligner:
    """Groups and links of many texts at once, over the concatenated bytes of their tokens."""

    def __init__(self, a_pieces: list[bytes], b_pieces: list[bytes]):
        self.size_a, self.size_b = len(a_pieces), len(b_pieces)
        if (self.size_a * self.size_b).bit_length() > PAIR_BITS:
            raise ValueError(f"vocabularies have more than 2 ** {PAIR_BITS} pairs")
        self.a_bytes, self.b_bytes = pa.array(a_pieces, pa.binary()), pa.array(b_pieces, pa.binary())
        self.a_lengths = np.array([len(p) for p in a_pieces], dtype=np.int64)
        self.b_lengths = np.array([len(p) for p in b_pieces], dtype=np.int64)
        # what a token adds to the list of groups, by what follows it
        a_ids, b_ids = [str(i) for i in range(self.size_a)], [str(i) for i in range(self.size_b)]
        self.written = pa.array([x + "," for x in a_ids] + [x + "|" for x in a_ids]
                                + [x + "," for x in b_ids] + [x + ";" for x in b_ids] + b_ids)

    def _spelled(self, table: pa.Array, ids: list[np.ndarray]) -> bytes:
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        if not len(flat):
            return b""
        parts = table.take(pa.array(flat))
        end = np.frombuffer(parts.buffers()[1], dtype=np.int32)[len(parts)]
        return parts.buffers()[2].slice(0, int(end)).to_pybytes()

    def usable(self, sources: list[bytes], a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
        """Whether both tokenizers spell a text's bytes."""
        whole = b"".join(sources)
        if self._spelled(self.a_bytes, a) == whole and self._spelled(self.b_bytes, b) == whole:
            lengths = np.array([len(s) for s in sources])
            ok = np.array([self.a_lengths[i].sum() for i in a]) == lengths
            return ok & (np.array([self.b_lengths[i].sum() for i in b]) == lengths)
        return np.array([self._spelled(self.a_bytes, [i]) == s == self._spelled(self.b_bytes, [j])
                         for s, i, j in zip(sources, a, b, strict=True)], dtype=bool)

    def align(self, a_lists: list[np.ndarray], b_lists: list[np.ndarray]):
        """Numbers of tokens, groups and links per text, the written groups, and (text, pair, links) with its keys.

        The last result has two arrays: keys ``pair << 16 | text`` in any order, each once, and their links.
        """
        n_a = np.array([len(x) for x in a_lists], dtype=np.int64)
        n_b = np.array([len(x) for x in b_lists], dtype=np.int64)
        a = np.concatenate(a_lists) if len(a_lists) else np.zeros(0, np.int64)
        b = np.concatenate(b_lists) if len(b_lists) else np.zeros(0, np.int64)
        a_first, b_first = exclusive(n_a), exclusive(n_b)
        a_end, b_end = np.cumsum(self.a_lengths[a]), np.cumsum(self.b_lengths[b])
        marks = np.zeros((int(a_end[-1]) if len(a_end) else 0) + 1, dtype=np.uint8)
        marks[a_end] = 1
        marks[b_end] |= 2
        a_last, b_last = marks[a_end] == 3, marks[b_end] == 3
        # group of every token, tokens and links of every group
        closed_a, closed_b = exclusive(a_last), exclusive(b_last)
        a_group, b_group = closed_a[:-1], closed_b[:-1]
        groups = int(closed_a[-1])
        in_a, in_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        a_of, b_of = exclusive(in_a), exclusive(in_b)
        links = in_a * in_b
        first_group = closed_a[a_first]
        n_groups = np.diff(first_group)
        n_links = np.diff(exclusive(links)[first_group])
        return n_a, n_b, n_groups, n_links, self._write(
            a, b, a_group, b_group, a_last, b_last, a_of, b_of, a_first, b_first), self._pairs(
            a, b, a_group, in_a, in_b, a_of, b_of, links, first_group)

    def _write(self, a, b, a_group, b_group, a_last, b_last, a_of, b_of, a_first, b_first) -> pa.Array:
        """``a1,a2|b1;a3|b2,b3`` per text: the tokens in order of groups, each with the mark behind it."""
        order = np.empty(len(a) + len(b), dtype=np.int64)
        order[np.arange(len(a)) + b_of[a_group]] = a + self.size_a * a_last
        last_of_text = np.zeros(len(b), dtype=bool)
        ends = b_first[1:][np.diff(b_first) > 0] - 1
        last_of_text[ends] = True
        order[np.arange(len(b)) + a_of[b_group + 1]] = 2 * self.size_a + b + self.size_b * b_last + self.size_b * last_of_text
        parts = self.written.take(pa.array(order))
        data, offsets = parts.buffers()[2], np.frombuffer(parts.buffers()[1], dtype=np.int32)
        bounds = offsets[a_first + b_first].astype(np.int32) if len(order) else np.zeros(len(a_first), np.int32)
        return pa.StringArray.from_buffers(len(a_first) - 1, pa.py_buffer(bounds.tobytes()), data if len(order) else pa.py_buffer(b""))

    def _pairs(self, a, b, a_group, in_a, in_b, a_of, b_of, links, first_group):
        """Keys of the linked pairs of every text, each once, and their links."""
        wide = links > WIDE_GROUP
        repeats = np.where(wide, 0, in_b)[a_group]
        starts = exclusive(repeats)
        spread = np.repeat(b_of[a_group] - starts[:-1], repeats) + np.arange(starts[-1])
        text_of = np.repeat(np.arange(len(first_group) - 1), np.diff(first_group))
        keys = (np.repeat(a * self.size_b, repeats) + b[spread]) << ORDINAL_BITS | np.repeat(text_of[a_group], repeats)
        keys.sort()
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        counts = np.diff(np.append(first, len(keys)))
        keys = keys[first]
        if not wide.any():
            return keys, counts
        more, times = [keys], [counts]
        for g in np.flatnonzero(wide):
            left, n_left = np.unique(a[a_of[g]:a_of[g + 1]], return_counts=True)
            right, n_right = np.unique(b[b_of[g]:b_of[g + 1]], return_counts=True)
            more.append(((left[:, None] * self.size_b + right).ravel() << ORDINAL_BITS) | text_of[g])
            times.append((n_left[:, None] * n_right).ravel())
        keys, times = np.concatenate(more), np.concatenate(times)
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        return keys[first], np.add.reduceat(times, first)


def bucket_of(pair: np.ndarray) -> np.ndarray:
    """Bucket of a pair: upper bits of a multiplicative hash."""
    return ((pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def compress(sizes: np.ndarray, ordinals: np.ndarray, documents: int) -> bytes:
    """Bitmaps as containers: 16-bit numbers of small ones, then bits of those over a sixteenth of the documents."""
    dense = sizes > documents // 16
    in_dense = np.repeat(dense, sizes)
    out = ordinals[~in_dense].astype(np.uint16).tobytes()
    if not dense.any():
        return out
    starts = exclusive(sizes[dense])
    inside = ordinals[in_dense]
    parts = [out]
    # bits of so many bitmaps at a time that their bytes before packing stay within HELD
    step = max(1, HELD // documents)
    for i in range(0, len(starts) - 1, step):
        at = starts[i:i + step + 1]
        bits = np.zeros((len(at) - 1, documents), dtype=bool)
        bits[np.repeat(np.arange(len(at) - 1), np.diff(at)), inside[at[0]:at[-1]]] = True
        parts.append(np.packbits(bits, axis=1).tobytes())
    return b"".join(parts)


def expand(sizes: np.ndarray, bits: bytes, documents: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index of the bitmap, document) of every set bit, container kind by container kind."""
    dense = sizes > documents // 16
    few = np.flatnonzero(~dense)
    n = int(sizes[few].sum())
    yield np.repeat(few, sizes[few]), np.frombuffer(bits, dtype=np.uint16, count=n).astype(np.int64)
    many, width = np.flatnonzero(dense), (documents + 7) // 8
    step = max(1, HELD // documents)
    for i in range(0, len(many), step):
        block = many[i:i + step]
        raw = np.frombuffer(bits, dtype=np.uint8, offset=2 * n + i * width, count=len(block) * width).reshape(len(block), width)
        row, ordinal = np.nonzero(np.unpackbits(raw, axis=1, count=documents))
        yield block[row], ordinal


def popcounts(sizes: np.ndarray, bits: bytes, documents: int) -> np.ndarray:
    """Set bits of every bitmap: the length of its list, or the popcount of its bits."""
    dense = sizes > documents // 16
    if not dense.any():
        return sizes
    out, width = sizes.copy(), (documents + 7) // 8
    raw = np.frombuffer(bits, dtype=np.uint8, offset=2 * int(sizes[~dense].sum())).reshape(int(dense.sum()), width)
    out[dense] = np.bitwise_count(raw).sum(axis=1, dtype=np.int64)
    return out


class Postings:
    """The postings of one chunk: collects keys of its documents, then hands them out by bucket and plane."""

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.more: list[tuple[np.ndarray, np.ndarray]] = []
        self.documents = self.pairs = 0

    def add(self, keys: np.ndarray, links: np.ndarray, documents: int) -> None:
        keys = keys + self.documents
        self.keys.append(keys)
        again = links > 1
        if again.any():
            self.more.append((keys[again], links[again] - 1))
        self.documents += documents
        self.pairs += len(keys)

    def rows(self) -> Iterator[tuple[int, int, bytes, bytes, bytes]]:
        """(bucket, plane, pairs, sizes, bitmaps); plane 0 has the documents."""
        if not self.pairs:
            return
        yield from self._plane(0, np.concatenate(self.keys))
        if self.more:
            keys, further = (np.concatenate(x) for x in zip(*self.more, strict=True))
            for k in range(int(further.max()).bit_length()):
                yield from self._plane(k + 1, keys[(further >> k) & 1 == 1])

    def _plane(self, plane: int, keys: np.ndarray) -> Iterator[tuple[int, int, bytes, bytes, bytes]]:
        shift = PAIR_BITS + ORDINAL_BITS
        keys = bucket_of(keys >> ORDINAL_BITS) << shift | keys
        keys.sort()
        edges = np.append(np.searchsorted(keys, np.arange(BUCKETS) << shift), len(keys))
        for bucket in np.flatnonzero(np.diff(edges)):
            part = keys[edges[bucket]:edges[bucket + 1]] & ((1 << shift) - 1)
            pair, ordinals = part >> ORDINAL_BITS, part & ((1 << ORDINAL_BITS) - 1)
            first = np.flatnonzero(np.diff(pair, prepend=-1))
            sizes = np.diff(np.append(first, len(pair)))
            yield int(bucket), plane, pair[first].tobytes(), sizes.astype(np.int32).tobytes(), compress(sizes, ordinals, self.documents)


DOCUMENT = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string"
POSTING = "chunk bigint, ordinal int, documents int, bucket int, plane int, pairs binary, sizes binary, bits binary"


def chunks(batches: Iterator[pa.RecordBatch], align: Callable, task: int, kept: int) -> Iterator[list]:
    """Columns of document rows (with chunk and ordinal) and of posting rows, chunk by chunk."""
    number, postings = task << 32, Postings()

    def close():
        columns = list(zip(*postings.rows(), strict=True))
        if columns:
            n = len(columns[0])
            yield [[None] * n] * (kept + 5) + [[number] * n, [None] * n, [postings.documents] * n, *map(list, columns)]

    for batch in batches:
        for part in slices(batch, batch.num_columns - 1):
            rows = part.num_rows
            if postings.documents and (postings.documents + rows > CHUNK_DOCUMENTS or postings.pairs >= CHUNK_PAIRS):
                yield from close()
                number, postings = number + 1, Postings()
            *found, (keys, links) = align(part.column(kept).to_pylist())
            ordinals = list(range(postings.documents, postings.documents + rows))
            postings.add(keys, links, rows)
            yield [*part.columns[:kept], *found, [number] * rows, ordinals, *[[None] * rows] * 6]
    yield from close()


def alignments(df: DataFrame, a: str, b: str, pattern: str | None = None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Rows of two kinds: every document's groups, and the postings of every chunk of documents.

    ``a`` is a byte-level BPE file of the tokenizers library, ``b`` a sentencepiece model, ``pattern``
    the splitting pattern that ``a`` stands for (without it the library splits). Document rows have
    ``ordinal``, posting rows have ``plane``; ``documents_of`` and ``links_of`` read them.
    """
    ship_package(df.sparkSession)
    small_batches(df.sparkSession)
    new = T.StructType.fromDDL(f"{DOCUMENT}, {POSTING}")
    taken = {f.name.lower() for f in new} | {"n_best", "count_sum"}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    source = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias(free_name(kept, "__text")))
    fields = [T.StructField(f.name, f.dataType) for f in list(source.schema)[:-1]]
    out = T.StructType([*fields, *new])
    arrow = to_arrow_schema(out)
    files = read_file(a), read_file(b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second, aligner = codecs(*files, pattern)
        none = np.zeros(0, dtype=np.int64)

        def align(texts: list):
            spaced = [" " + t if t else "" for t in texts]
            a_ids = [first.encode(t) if t else none for t in spaced]
            b_ids = [np.array(x, dtype=np.int64) for x in second.encode([t or "" for t in texts])]
            b_ids = [y if t else none for t, y in zip(texts, b_ids, strict=True)]
            ok = aligner.usable([t.encode() for t in spaced], a_ids, b_ids)
            if not ok.all():
                a_ids = [x if y else none for x, y in zip(a_ids, ok, strict=True)]
                b_ids = [x if y else none for x, y in zip(b_ids, ok, strict=True)]
            return aligner.align(a_ids, b_ids)

        for columns in chunks(batches, align, TaskContext.get().partitionId(), len(kept)):
            yield pa.RecordBatch.from_arrays(
                [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(columns, arrow.types, strict=True)], schema=arrow)

    return source.mapInArrow(run, out)


def documents_of(rows: DataFrame) -> DataFrame:
    """The document rows: kept columns, counts, groups, chunk and ordinal."""
    return rows.where(F.col("plane").isNull()).drop("documents", "bucket", "plane", "pairs", "sizes", "bits")


def _dealt(rows: DataFrame) -> DataFrame:
    """Posting rows with their lane and salt."""
    salt = F.shiftright(F.col("chunk"), 32) / SPLITS_PER_SALT
    return rows.where(F.col("plane").isNotNull()).select(
        (F.col("bucket") % LANES).alias("lane"), F.floor(salt).alias("salt"), "bucket", "chunk", "documents", "plane", "pairs", "sizes", "bits")


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the bitmaps of each pair and count their bits: (bucket, pair, n_docs, n_links), perhaps in parts."""
    bucket, held, parts = None, 0, []

    def close():
        if not parts:
            return
        pair, docs, links = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        first = np.flatnonzero(np.diff(pair, prepend=-1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(first), bucket, dtype=np.int32)), pa.array(pair[first]),
             pa.array(np.add.reduceat(docs[order], first)), pa.array(np.add.reduceat(links[order], first))],
            names=["bucket", "pair", "n_docs", "n_links"])
        parts.clear()

    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != bucket or held > HELD:
                yield from close()
                bucket, held = row["bucket"], 0
            sizes = np.frombuffer(row["sizes"], dtype=np.int32).astype(np.int64)
            n = popcounts(sizes, row["bits"], row["documents"])
            pair = np.frombuffer(row["pairs"], dtype=np.int64)
            parts.append((pair, n, n) if row["plane"] == 0 else (pair, np.zeros_like(n), n << (row["plane"] - 1)))
            held += len(pair)
    yield from close()


def links_of(rows: DataFrame, size_b: int) -> DataFrame:
    """Every linked pair once: bucket, pair, a, b, ``n_docs`` (documents that hold it linked) and ``n_links``."""
    merged = (
        _dealt(rows).select("lane", "salt", "bucket", "documents", "plane", "pairs", "sizes", "bits")
        .repartition("lane", "salt").sortWithinPartitions("bucket")
        .mapInArrow(_counted, "bucket int, pair bigint, n_docs bigint, n_links bigint"))
    return merged.groupBy("bucket", "pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links")).select(
        "bucket", "pair", F.expr(f"pair div {size_b}").cast("int").alias("a"), (F.col("pair") % size_b).cast("int").alias("b"),
        "n_docs", "n_links")


def _returned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per document of the counts and best marks of its links, over the buckets and planes that a task sees."""
    bucket, table, held = None, [], 0
    pairs = counts = best = None
    sums: dict[int, np.ndarray] = {}

    def close():
        for chunk, (n_best, total) in sums.items():
            got = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(got), chunk, dtype=np.int64)), pa.array(got.astype(np.int32)), pa.array(n_best[got]), pa.array(total[got])],
                names=["chunk", "ordinal", "n_best", "count_sum"])
        sums.clear()

    for batch in batches:
        kinds = batch.column("chunk").is_null().to_numpy(zero_copy_only=False)
        at = 0
        while at < batch.num_rows:
            # a run of table rows of one bucket, or one row of postings
            here = batch.column("bucket")[at].as_py()
            if here != bucket:
                bucket, table, pairs = here, [], None
            if kinds[at]:
                buckets = batch.column("bucket").to_numpy()
                stop = at + int(np.argmin(np.append(kinds[at:] & (buckets[at:] == here), False)))
                table.append([batch.column(c).slice(at, stop - at).to_numpy(zero_copy_only=False) for c in ("pair", "n_docs", "best")])
                at = stop
                continue
            if pairs is None:
                pairs, counts, best = (np.concatenate(x) for x in zip(*table, strict=True))
                order = np.argsort(pairs)
                pairs, counts, best, table = pairs[order], counts[order], best[order].astype(np.int64), []
            row = {c: batch.column(c)[at].as_py() for c in ("chunk", "documents", "plane", "pairs", "sizes", "bits")}
            at += 1
            sizes = np.frombuffer(row["sizes"], dtype=np.int32).astype(np.int64)
            found = np.searchsorted(pairs, np.frombuffer(row["pairs"], dtype=np.int64))
            times = 1 << max(row["plane"] - 1, 0)
            if row["chunk"] not in sums:
                if held > HELD:
                    yield from close()
                    held = 0
                sums[row["chunk"]] = np.zeros((2, row["documents"]), dtype=np.int64)
                held += row["documents"]
            n_best, total = sums[row["chunk"]]
            for which, ordinal in expand(sizes, row["bits"], row["documents"]):
                hit = found[which]
                np.add.at(total, ordinal, counts[hit] * times)
                np.add.at(n_best, ordinal, best[hit] * times)
    yield from close()


def scores_of(rows: DataFrame, links: DataFrame) -> DataFrame:
    """(chunk, ordinal, n_best, count_sum) of every document with links.

    ``n_best`` counts the links whose pair has the most documents among all pairs of its A id;
    ``count_sum`` adds up the documents of the pairs of all links.
    """
    most = F.max("n_docs").over(Window.partitionBy("a"))  # at most one row per B id in a window
    table = links.withColumn("best", F.col("n_docs") == most)
    postings = _dealt(rows)
    last = (rows.rdd.getNumPartitions() - 1) // SPLITS_PER_SALT
    salts = F.sequence(F.lit(0).cast("bigint"), F.lit(max(last, 0)).cast("bigint"))
    copies = table.select(
        (F.col("bucket") % LANES).alias("lane"), F.explode(salts).alias("salt"),
        "bucket", "pair", "n_docs", "best")
    return (
        postings.unionByName(copies, allowMissingColumns=True).repartition("lane", "salt")
        .sortWithinPartitions("salt", "bucket", F.col("chunk").asc_nulls_first())
        .drop("lane", "salt")
        .mapInArrow(_returned, "chunk bigint, ordinal int, n_best bigint, count_sum bigint")
        .groupBy("chunk", "ordinal").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))


def align_documents(
    df: DataFrame, a: str, b: str, pattern: str | None = None, text: str = "text", keep: list[str] | None = None,
    groups: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Add n_a, n_b, n_groups, n_links, groups, n_best and count_sum to every row.

    ``groups`` writes each group's A ids and B ids in order (``a1,a2|b1;a3|b2,b3``); the function of
    that name replaces the column before rows are stored, for instance by a digest. NULL and empty
    texts, and texts whose bytes one of the tokenizers does not give back, have no tokens: zeros and
    an empty string. Rows are never matched by a key of theirs, so repeated rows, equal ids and NULL
    ids each stay a row and count as a document. Columns named like the new ones give way to them. An
    empty table gives an empty one. Texts of any length are taken whole: a long group is counted by its
    distinct ids, a long text is a chunk of its own.
    """
    rows = alignments(df, a, b, pattern, text, keep)
    if groups is not None:
        rows = rows.withColumn("groups", F.when(F.col("plane").isNull(), groups(F.col("groups"))))
    # read for the documents, for the counts and for the way back
    stored = cut(rows)
    size_b = len(Pieces(read_file(b)).pieces)
    scores = scores_of(stored, links_of(stored, size_b))
    return documents_of(stored).join(scores, ["chunk", "ordinal"], "left").withColumns({
        "n_best": F.coalesce("n_best", F.lit(0).cast("bigint")), "count_sum": F.coalesce("count_sum", F.lit(0).cast("bigint")),
    }).drop("chunk", "ordinal")


def link_table(df: DataFrame, a: str, b: str, pattern: str | None = None, text: str = "text") -> DataFrame:
    """The linked id pairs of a corpus: a, b, ``n_docs``, ``n_links``; each pair once."""
    stored = cut(alignments(df, a, b, pattern, text, keep=[]).where(F.col("plane").isNotNull()))
    return links_of(stored, len(Pieces(read_file(b)).pieces)).drop("bucket", "pair")
