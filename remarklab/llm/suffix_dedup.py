"""Removal of repeated passages: bucketed suffixes, sorted and compared across bucket boundaries.

Every byte that lies in a string of ``length`` bytes which also starts earlier (smaller id, or the same
document further left) is removed. Not every suffix is moved:

1. Each string of ``length`` bytes (a window) belongs to the suffix at its anchor, the position whose
   gram of ``length // 2`` bytes has the smallest hash in the window. Equal windows have their anchor at
   the same place. Neighbouring windows with one anchor form a run: one entry for about 24 bytes.
2. Entries are range-partitioned by gram, run content, id and start, at splitters taken from a sample
   of real entries. A bucket takes the keys above its lower splitter up to its upper one, so a bucket
   knows without asking that the lower splitter's class has an earlier member; a class of any size is
   split. Buckets are sorted by multikey sort (a key is looked at only where earlier ones tie) and
   neighbours compared. All but the first entry of a class of equal runs are repeats.
3. Runs that share a gram but not all of the run lie at the border of a repeat. For the first run of
   each such class the single windows are entered, bucketed, sorted and compared in the same way.

Entries, spans and texts travel packed, a row per task batch and bucket; texts meet their spans in
buckets of documents. Runs and windows are compared by two 64-bit hashes: a run by its gram's and its
own, a window by its own and one of its halves. A bucket holds about ``BUCKET`` entries; more data makes more
buckets. The sample of entries has a fixed size, whatever the corpus and the length of its texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from remarklab.llm.common import cut, ship_package, slices, small_batches

LENGTH = 100
# windows are numbered within segments of a text, so that ties between equal grams go to the right one
SEGMENT = 1 << 20
# entries per bucket; documents whose entries splitters are taken from, and about how many of these at most
BUCKET, SAMPLE_DOCS, SAMPLE_ENTRIES = 1 << 20, 2048, 1 << 17
# bytes of text for an entry, on average
ENTRY_BYTES = 24
# entries that a task deals out together
GATHER = 1 << 18

_BYTE = np.random.Generator(np.random.PCG64(20)).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
NO_ID = (1 << 63) - 1


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Substrings:
    """Hashes of substrings of a byte array, from prefix sums of a polynomial modulo 2 ** 64."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        if len(_powers[0]) <= n:
            size = max(n, 1 << 17)
            for i, base in enumerate((_BASE, _INVERSE)):
                _powers[i] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, base, np.uint64)]))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * _powers[0][:n], out=self.sums[1:])

    def windows(self, size: int, first: int = 0, last: int | None = None) -> np.ndarray:
        """Hashes of the strings of ``size`` bytes that start at ``first`` to ``last``."""
        stop = len(self.sums) - size if last is None else last + 1
        return _mix((self.sums[first + size:stop + size] - self.sums[first:stop]) * _powers[1][first:stop])

    def spans(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.sums[start + size] - self.sums[start]) * _powers[1][start]


def runs(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All runs of a text: first window, number of windows, gram hash, run hash."""
    parts = []
    gram, width = length // 2, length - length // 2 + 1
    for at in range(0, len(data) - length + 1, SEGMENT):
        own = data[at:at + SEGMENT + length - 1]
        text = Substrings(own)
        grams = text.windows(gram)
        low = np.uint64(2 * SEGMENT - 1)
        least = (grams & ~low) | (low - np.arange(len(grams), dtype=np.uint64))
        size = 1
        while size * 2 <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < width:
            least = np.minimum(least[:size - width], least[width - size:])
        anchor = (low - (least & low)).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1])
        count = np.diff(np.append(first, len(anchor)))
        place = anchor[first]
        content = _mix(text.spans(first, count + length - 1) + (count * 65537 + place - first).astype(np.uint64) * np.uint64(_BASE))
        parts.append((first + at, count, grams[place], content))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts))


# An entry: gram and content hash (for single windows the window's hash and another of its halves), id, digest, start, windows.
FIELDS = (("gram", "<u8"), ("content", "<u8"), ("id", "<i8"), ("digest", "<u4"), ("start", "<u4"), ("count", "<u2"))
Entries = dict[str, np.ndarray]


def _take(entries: Entries, index) -> Entries:
    return {k: v[index] for k, v in entries.items()}


def _join(parts: list[Entries]) -> Entries:
    return {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, t) for k, t in FIELDS}


def _columns(*columns: np.ndarray) -> bytes:
    """Arrays of numbers, compressed, each behind its length."""
    return _SQUEEZE.compress(b"".join(len(c).to_bytes(4, "little") + c.tobytes() for c in columns))


def _uncolumns(packed: bytes, *kinds: str) -> list[np.ndarray]:
    data, at, out = zstandard.decompress(packed), 0, []
    for kind in kinds:
        n = int.from_bytes(data[at:at + 4], "little")
        out.append(np.frombuffer(data, kind, n, at + 4))
        at += 4 + out[-1].nbytes
    return out


_SQUEEZE = zstandard.ZstdCompressor(level=3)


def _documents_of(entries: Entries) -> tuple[np.ndarray, np.ndarray]:
    """First entry of each run of entries of one document, and the runs' lengths."""
    n = len(entries["id"])
    new = np.ones(n, bool)
    new[1:] = (entries["id"][1:] != entries["id"][:-1]) | (entries["digest"][1:] != entries["digest"][:-1])
    at = np.flatnonzero(new)
    return at, np.diff(np.append(at, n)).astype("<u4")


def pack(entries: Entries) -> bytes:
    """Documents and places compressed, then the hashes, which nothing compresses."""
    at, sizes = _documents_of(entries)
    single = bool((entries["gram"] == entries["content"]).all())
    rest = _columns(entries["id"][at], entries["digest"][at], sizes, entries["start"], entries["count"])
    hashes = entries["gram"].tobytes() + (b"" if single else entries["content"].tobytes())
    return bytes([single]) + len(rest).to_bytes(4, "little") + rest + hashes


def unpack(payload: bytes) -> Entries:
    end = 5 + int.from_bytes(payload[1:5], "little")
    ids, digests, sizes, start, count = _uncolumns(payload[5:end], "<i8", "<u4", "<u4", "<u4", "<u2")
    gram = np.frombuffer(payload, "<u8", len(start), end)
    content = gram if payload[0] else np.frombuffer(payload, "<u8", len(start), end + gram.nbytes)
    return {"gram": gram, "content": content, "id": np.repeat(ids, sizes), "digest": np.repeat(digests, sizes), "start": start, "count": count}


KEYS = ("gram", "content", "id", "digest", "start")


def multikey_order(entries: Entries, keys: tuple[str, ...] = KEYS) -> np.ndarray:
    """Order by several keys: sort by one, then only the entries that tie, within their ties, by the next."""
    order = np.argsort(entries[keys[0]], kind="stable")
    todo = np.arange(len(order))  # places in the order that may still tie
    group = np.zeros(len(order), np.int64)
    values = entries[keys[0]][order]
    for key in keys[1:]:
        if not len(todo):
            break
        cutoff = np.ones(len(todo), bool)
        cutoff[1:] = (values[1:] != values[:-1]) | (group[1:] != group[:-1])
        group = np.cumsum(cutoff)
        tied = np.bincount(group)[group] > 1
        todo, group = todo[tied], group[tied]
        own = entries[key][order[todo]]
        inner = np.lexsort((own, group))
        order[todo] = order[todo[inner]]
        values, group = own[inner], group[inner]
    return order


def bucket_of(entries: Entries, splitters: Entries) -> np.ndarray:
    """Number of splitters below each entry."""
    low = np.searchsorted(splitters["gram"], entries["gram"], side="left")
    high = np.searchsorted(splitters["gram"], entries["gram"], side="right")
    unsure = np.flatnonzero(low < high)
    if len(unsure):
        n = len(unsure)
        both = {k: np.concatenate([entries[k][unsure], splitters[k]]) for k in KEYS}
        marker = np.concatenate([np.zeros(n, np.int8), np.ones(len(splitters["gram"]), np.int8)])
        order = np.lexsort((marker, *(both[k] for k in reversed(KEYS))))
        below = np.cumsum(marker[order])
        own = order < n
        low[unsure[order[own]]] = below[own]
    return low


def choose_splitters(sample: Entries, buckets: int) -> Entries:
    """``buckets - 1`` entries of the sample at equal distances in key order."""
    n = len(sample["gram"])
    sample = _take(sample, multikey_order(sample))
    return _take(sample, np.arange(1, min(buckets, n + 1)) * n // min(buckets, n + 1) if n else np.zeros(0, np.int64))


def compare_bucket(entries: Entries, splitters: Entries, bucket: int) -> tuple[Entries, np.ndarray, np.ndarray]:
    """The sorted bucket; which entries repeat an earlier one; which are first and share a gram with another class."""
    entries = _take(entries, multikey_order(entries))
    n = len(entries["gram"])
    gram = np.ones(n, bool)
    gram[1:] = entries["gram"][1:] != entries["gram"][:-1]
    cls = gram.copy()
    cls[1:] |= entries["content"][1:] != entries["content"][:-1]
    head = np.flatnonzero(cls)[np.cumsum(cls) - 1]  # first entry of each entry's class
    same = np.ones(n, bool)
    for k in KEYS[2:]:
        same &= entries[k] == entries[k][head]
    repeat = ~same  # an entry equal to the first is a row given twice
    alike = np.bincount(np.cumsum(gram) - 1, weights=cls)[np.cumsum(gram) - 1] > 1
    for b in (bucket - 1, bucket):  # lower and upper splitter
        if 0 <= b < len(splitters["gram"]):
            straddles = entries["gram"] == splitters["gram"][b]
            alike |= straddles
            if b == bucket - 1:
                repeat |= straddles & (entries["content"] == splitters["content"][b])
    return entries, repeat, cls & ~repeat & alike


def _documents(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """Columns id, digest and text; a NULL id comes last, a NULL text is empty."""
    column = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return df.select(F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(NO_ID)).alias("id"),
                     F.xxhash64(column).bitwiseAND(0xFFFFFFFF).alias("digest"), column.cast("binary").alias("__text"))


# a prime: which documents the sample takes
SHARES = 1_000_003


def _mark(entries: Entries) -> np.ndarray:
    """A number of each document that also its column expression gives."""
    return entries["id"] ^ entries["digest"].astype(np.int64)


Document = tuple[int, int, np.ndarray]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[Document]]:
    """Documents (id, digest, bytes) from columns id, digest and text."""
    for batch in batches:
        for part in slices(batch, 2):
            yield [(i, d, np.frombuffer(t, np.uint8)) for i, d, t in zip(*(c.to_pylist() for c in part.columns))]


def _of(i: int, d: int, first, count, gram, content) -> Entries:
    n = len(first)
    return {"gram": gram, "content": content, "id": np.full(n, i, "<i8"), "digest": np.full(n, d, "<u4"),
            "start": first.astype("<u4"), "count": count.astype("<u2")}


def _run_entries(length: int):
    """Entries of all runs of texts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[Entries]:
        for docs in _texts(batches):
            yield _join([_of(i, d, *runs(data, length)) for i, d, data in docs if len(data) >= length])

    return rows


def _window_entries(length: int):
    """Entries of the single windows of spans that have met their texts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[Entries]:
        for docs in _met(batches):
            parts = []
            for i, d, data, spans in docs:
                if len(spans):
                    text = Substrings(data)
                    for first, count in spans.tolist():
                        last, half = first + count - 1, length // 2
                        # equal windows by chance would need equal hashes of both halves as well
                        halves = text.windows(half, first, last) * np.uint64(_BASE) + text.windows(half, first + half, last + half)
                        parts.append(_of(i, d, np.arange(first, first + count), np.ones(count), text.windows(length, first, last), _mix(halves)))
            yield _join(parts)

    return rows


def _gathered(parts: Iterator[Entries]) -> Iterator[Entries]:
    """Entries of several batches together, so that a bucket gets few rows from a task."""
    held, total = [], 0
    for part in parts:
        held.append(part)
        total += len(part["gram"])
        if total >= GATHER:
            yield _join(held)
            held, total = [], 0
    if total:
        yield _join(held)


def _dealt(bucket: np.ndarray) -> list[np.ndarray]:
    """Indexes of the rows of each bucket, in their order."""
    order = np.argsort(bucket, kind="stable")
    return [g for g in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(g)]


def _sample(df: DataFrame, rows, rate: float) -> tuple[Entries, int]:
    """The entries of a few documents whose hash lies in the share ``rate``, on the driver, and the number of all of theirs."""
    bound = np.uint64(min(int(rate * (1 << 64)), (1 << 64) - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for entries in rows(batches):
            few = np.flatnonzero(_mix(entries["start"].astype(np.uint64) * np.uint64(_BASE) + _mark(entries).astype(np.uint64)) <= bound)
            yield pa.RecordBatch.from_arrays(
                [pa.array([pack(_take(entries, few))], pa.binary()), pa.array([len(entries["gram"])], pa.int64())], names=["entries", "n"])

    found = df.mapInArrow(run, "entries binary, n bigint").toArrow()
    return _join([unpack(p) for p in found["entries"].to_pylist()]), sum(found["n"].to_pylist())


def _windows_of(borders: DataFrame) -> int:
    """Number of single windows in packed spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [int(_uncolumns(p, "<i8", "<u4", "<u4", "<u4", "<u2")[4].sum(dtype=np.int64)) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64())], names=["n"])

    return borders.mapInArrow(run, "n bigint").agg(F.sum("n")).first()[0] or 0


PACKED = "bucket int, kind int, packed binary"
REPEAT, BORDER, TEXT = 0, 1, 2


def _packed(bucket: list[int], kind: int, packed: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int32()), pa.array([kind] * len(bucket), pa.int32()), pa.array(packed, pa.binary())],
        names=["bucket", "kind", "packed"])


def _repeats(df: DataFrame, rows, splitters: Entries, buckets: int, borders: bool, places: int) -> DataFrame:
    """Spans (start, count) of repeats, and of borders, packed by bucket of documents (``places`` of them)."""
    shared = df.sparkSession.sparkContext.broadcast(splitters)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for entries in _gathered(rows(batches)):
            bucket = bucket_of(entries, shared.value)
            groups = _dealt(bucket)
            yield _packed([int(bucket[g[0]]) for g in groups], 0, [pack(_take(entries, g)) for g in groups])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[int, list[Entries]] = {}
        for batch in batches:
            for b, payload in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                by.setdefault(b, []).append(unpack(payload))
        for b, parts in by.items():
            entries, repeat, border = compare_bucket(_join(parts), shared.value, b)
            parts.clear()
            for kind, chosen in ((REPEAT, repeat), (BORDER, border)) if borders else ((REPEAT, repeat),):
                own = _take(entries, np.flatnonzero(chosen))
                own = _take(own, np.lexsort((own["start"], own["digest"], own["id"])))
                place = _mark(own) % places
                groups = _dealt(place)
                yield _packed([int(place[g[0]]) for g in groups], kind, [_pack_spans(_take(own, g)) for g in groups])

    return df.mapInArrow(deal, PACKED).repartitionById(buckets, F.col("bucket")).mapInArrow(compare, PACKED)


def _pack_spans(entries: Entries) -> bytes:
    at, sizes = _documents_of(entries)
    return _columns(entries["id"][at], entries["digest"][at], sizes, entries["start"], entries["count"])


def _unpack_spans(packed: bytes, into: dict[tuple[int, int], list[np.ndarray]]) -> None:
    """Add the spans of each document, rows of (start, count)."""
    ids, digests, sizes, start, count = _uncolumns(packed, "<i8", "<u4", "<u4", "<u4", "<u2")
    spans = np.stack([start, count.astype("<u4")], 1)
    for i, d, own in zip(ids.tolist(), digests.tolist(), np.split(spans, np.cumsum(sizes)[:-1])):
        into.setdefault((i, d), []).append(own)


def _meeting(docs: DataFrame, spans: DataFrame, places: int) -> DataFrame:
    """Texts and the packed spans of their documents in the same partition, spans first."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _texts(batches):
            place = np.array([(i ^ d) % places for i, d, _ in own], np.int64)
            groups = _dealt(place)
            yield _packed([int(place[g[0]]) for g in groups], TEXT, [_pack_texts([own[i] for i in g.tolist()]) for g in groups])

    both = docs.mapInArrow(deal, PACKED).union(spans)
    return both.repartitionById(places, F.col("bucket")).sortWithinPartitions("bucket", "kind")


def _pack_texts(docs: list[Document]) -> bytes:
    ids, digests = np.array([x[0] for x in docs], "<i8"), np.array([x[1] for x in docs], "<u4")
    return _columns(ids, digests, np.array([len(x[2]) for x in docs], "<u4"), np.concatenate([x[2] for x in docs]))


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, int, np.ndarray, np.ndarray]]]:
    """Documents with their spans: what ``_meeting`` has brought together."""
    spans: dict[tuple[int, int], list[np.ndarray]] = {}
    none, last = [np.zeros((0, 2), "<u4")], None
    for batch in batches:
        for b, kind, packed in zip(*(c.to_pylist() for c in batch.columns)):
            if b != last:
                spans, last = {}, b
            if kind != TEXT:
                _unpack_spans(packed, spans)
                continue
            ids, digests, sizes, data = _uncolumns(packed, "<i8", "<u4", "<u4", "u1")
            texts = np.split(data, np.cumsum(sizes)[:-1])
            yield [(i, d, t, np.concatenate(spans.get((i, d), none))) for i, d, t in zip(ids.tolist(), digests.tolist(), texts)]


def cover(size: int, spans: np.ndarray, length: int) -> np.ndarray:
    """Mask of the bytes that the windows of (start, count) cover."""
    spans = spans.astype(np.int64)
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, spans[:, 0], 1)
    np.add.at(change, spans[:, 0] + spans[:, 1] + length - 1, -1)
    return np.cumsum(change[:-1]) > 0


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Rows (``id_col``, n_bytes, spans, kept), one per row of ``df``.

    ``spans`` are the maximal removed byte ranges (start, end exclusive) of the text in UTF-8, ``kept``
    the remaining bytes, concatenated (perhaps no valid UTF-8). Strings are judged on the input, and
    never cross documents. Ids are integers and give the order; NULL ids come last; documents that share
    an id are ordered by a hash of their text, and rows that repeat id and text are one document, each
    returned. NULL and empty texts have 0 bytes and no spans; an empty table gives an empty one.
    ``length`` is even and at least 16.
    """
    spark = df.sparkSession
    ship_package(spark)
    small_batches(spark)
    docs = _documents(df, id_col, text)
    total = df.count()
    share = min(1.0, SAMPLE_DOCS / max(1, total))
    bound = int(share * SHARES) + 1
    in_sample = F.pmod(F.col("id").bitwiseXOR(F.col("digest")), F.lit(SHARES)) < bound
    few, size = docs.where(in_sample), F.octet_length("__text").cast("bigint")
    bytes_of = docs.agg(F.sum(size).alias("all"), F.sum(F.when(in_sample, size)).alias("few")).first()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def buckets_for(entries: float) -> int:
        return max(least, int(entries) // BUCKET + 1)

    # entries of a byte of the sample stand for those of all bytes
    wanted = SAMPLE_ENTRIES * ENTRY_BYTES / max(1, bytes_of["few"] or 0)
    sample, entries = _sample(few, _run_entries(length), min(1.0, wanted))
    places = buckets = buckets_for(entries * (bytes_of["all"] or 0) / max(1, bytes_of["few"] or 0))
    found = cut(_repeats(docs, _run_entries(length), choose_splitters(sample, buckets), buckets, True, places))

    def of_few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, packed in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                ids, digests, sizes, start, count = _uncolumns(packed, "<i8", "<u4", "<u4", "<u4", "<u2")
                own = {"id": np.repeat(ids, sizes), "digest": np.repeat(digests, sizes), "start": start, "count": count}
                chosen = np.flatnonzero(_mark(own) % SHARES < bound)
                if len(chosen):
                    yield _packed([b], BORDER, [_pack_spans(_take(own, chosen))])

    borders = found.where(F.col("kind") == BORDER)
    windows = _windows_of(borders)
    wanted = SAMPLE_ENTRIES / max(1.0, windows * share)
    sample, _ = _sample(_meeting(few, borders.mapInArrow(of_few, PACKED), places), _window_entries(length), min(1.0, wanted))
    buckets = buckets_for(windows)
    at_borders = _meeting(docs.where(F.octet_length("__text") >= length), borders, places)
    single = _repeats(at_borders, _window_entries(length), choose_splitters(sample, buckets), buckets, False, places)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _met(batches):
            ranges, kept = [], []
            for _, _, data, spans in own:
                gone = cover(len(data), spans, length)
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                ranges.append([{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()])
                kept.append(data[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in own], pa.int64()), pa.array([len(x[2]) for x in own], pa.int64()),
                 pa.array(ranges, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                names=["id", "n_bytes", "spans", "kept"])

    whole = _meeting(docs, found.where(F.col("kind") == REPEAT).union(single), places)
    out = whole.mapInArrow(finish, "id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")
    own = F.when(F.col("id") != NO_ID, F.col("id")).cast(df.schema[id_col].dataType)
    return out.select(own.alias(id_col), "n_bytes", "spans", "kept")
