"""Benchmark decontamination by templates: typed placeholders, window joins, consistent slots.

Words are made canonical: numbers, names and units become typed placeholders (slots), other words are
lower-cased. Windows of canonical words with enough literal ones are hashed and joined between
documents and benchmark items. A question whose numbers or names were changed still shares its
windows; along one alignment every slot value of the item may meet one value in the document, and
windows in which it meets another don't count. A document that holds the threshold share of an item's windows is contaminated by it.

Capitals make names, so windows with names are also hashed with the names as literal words, for copies
in other case. An item without any window of enough literals is compared word by word: by windows of
its very words, or by one of all its words if it has fewer than a window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from remarklab.llm.common import cut, join_spread, ship_package, slices, small_batches

WINDOW, LITERALS, THRESHOLD = 5, 3, 0.8
# documents to be dropped that are broadcast (24 bytes each); more are joined by a shuffle
BROADCAST_ROWS = 1 << 20
# bits of the fixed-size filter that is sent to all tasks (2 MB), whatever the benchmark's size
FILTER_BITS = 24
# Units that may follow a number, and number words.
UNITS = ("km kg cm mm m g mg l ml s ms sec second seconds min minute minutes h hour hours day days week weeks month "
         "months year years mile miles inch inches foot feet yard yards lb lbs pound pounds oz ounce ounces dollar "
         "dollars cent cents euro euros percent degree degrees mph kmh hz khz mhz ghz w kw kb mb gb tb").split()
NUMBERS = ("two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
           "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million").split()

LITERAL, NUMBER, UNIT, NAME = 0, 1, 2, 3
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_SLOT_HASH = np.array([0, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)
_BYTES = np.arange(256)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LOWER = np.where(_UPPER, _BYTES + 32, _BYTES).astype(np.uint8)
_WORD = _DIGIT | _UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_STOP = np.isin(_BYTES, np.frombuffer(b".!?:;|\n\r\"", np.uint8))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _hash_words(low: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of words whose bytes follow each other in ``low``."""
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(low)) - np.repeat(first, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), _PRIME, np.uint64))
    return _mix(np.add.reduceat((low.astype(np.uint64) + np.uint64(1)) * powers[place], first) + lengths.astype(np.uint64))


def _hash_list(words: list[str]) -> np.ndarray:
    low = np.frombuffer("".join(words).encode(), np.uint8)
    return np.sort(_hash_words(low, np.array([len(w) for w in words])))


_UNIT_HASHES, _NUMBER_HASHES = _hash_list(UNITS), _hash_list(NUMBERS)


def canonical_words(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For all words of all texts: index of the text, literal hash, kind, and canonical hash.

    Words are runs of ASCII letters, digits and other characters beyond ASCII; a dot or comma between
    digits belongs to the number. A word that starts with a digit, or a number word, is a number; a unit
    word right behind a number is a unit; a capitalised word that doesn't start a sentence is a name.
    """
    data = [b"" if t is None else t.encode() for t in texts]
    buf = np.frombuffer(b"\n\n" + b"\n\n".join(data) + b"\n\n", np.uint8)
    word, digit = _WORD[buf], _DIGIT[buf]
    inner = (buf == 46) | (buf == 44)
    word[1:-1] |= inner[1:-1] & digit[:-2] & digit[2:]
    starts = np.flatnonzero(word[1:] & ~word[:-1]) + 1
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none.astype(np.uint64)
    lengths = np.flatnonzero(word[1:] & ~np.r_[word[2:], False]) + 2 - starts
    hashes = _hash_words(_LOWER[buf[word]], lengths)
    number = _DIGIT[buf[starts]] | np.isin(hashes, _NUMBER_HASHES)
    unit = np.isin(hashes, _UNIT_HASHES) & np.r_[False, number[:-1]]
    before, earlier = buf[starts - 1], buf[starts - 2]
    opening = _STOP[before] | ((before == 32) & _STOP[earlier])
    # capitalised: a capital, then a letter that is none
    name = _UPPER[buf[starts]] & (lengths > 1) & ~_UPPER[buf[starts + 1]] & ~opening
    kind = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, LITERAL)))
    ends = np.cumsum([2] + [len(d) + 2 for d in data])
    owner = np.searchsorted(ends, starts, side="right") - 1
    return owner, hashes, kind, np.where(kind == LITERAL, hashes, _SLOT_HASH[kind])


def _rolled(words: np.ndarray, window: int) -> np.ndarray:
    """Hashes, not mixed yet, of all windows."""
    n = len(words) - window + 1
    total = np.zeros(n, np.uint64)
    for j in range(window):
        total = total * _PRIME + words[j:j + n]
    return total


def _sums(flags: np.ndarray, window: int) -> np.ndarray:
    """How many flags are set in every window."""
    total = np.cumsum(np.r_[0, flags])
    return total[window:] - total[:-window]


def template_windows(texts: list, window: int = WINDOW, literals: int = LITERALS):
    """Text index, word index within the text, hash, and the canonical arrays, of windows with enough literals."""
    owner, hashes, kind, canonical = canonical_words(texts)
    n = len(owner) - window + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, hashes, kind, none
    at = np.flatnonzero((owner[:n] == owner[window - 1:]) & (_sums(kind == LITERAL, window) >= literals))
    first = np.searchsorted(owner, owner[at])  # first word of the window's text
    return owner[at], at - first, _mix(_rolled(canonical, window)[at]).view(np.int64), hashes, kind, at


def _forms(texts: list, window: int, literals: int, short: list[int] | None) -> Iterator[tuple]:
    """Windows in all their forms: text index, word index within the text, hash, literal hashes, kinds, place, size.

    Texts are items where ``short`` is None, else documents; ``short`` lists the sizes of items with fewer
    words than a window. An item has windows with literal names where it has regular ones, and windows of
    its very words only if it has no regular one. An item of fewer words than ``literals`` is only met by
    a document that has no other words.
    """
    owner, hashes, kind, canonical = canonical_words(texts)
    if not len(owner):
        return
    counts = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(counts) - counts
    bare = np.zeros(len(kind), kind.dtype)
    bare_texts = counts > 0  # items without a regular window
    n = len(owner) - window + 1
    found = []
    if n > 0:
        inside = owner[:n] == owner[window - 1:]
        regular = inside & (_sums(kind == LITERAL, window) >= literals)
        bare_texts[owner[:n][regular]] = False
        unnamed = np.where(kind == NAME, LITERAL, kind)
        named = inside & (_sums(kind == NAME, window) > 0)
        if short is None:
            named &= regular
            very = inside & bare_texts[owner[:n]]
        else:
            named &= _sums(unnamed == LITERAL, window) >= literals
            very = inside & (_sums(unnamed != LITERAL, window) > 0)  # others are the same in another form
        found += [(regular, canonical, kind, window), (named, np.where(kind == NAME, hashes, canonical), unnamed, window),
                  (very, hashes, bare, window)]
    for size in range(1, window) if short is None else short:
        n = len(owner) - size + 1
        if n <= 0:
            continue
        own = np.zeros(n, bool)
        own[first[counts == size]] = True
        if short is not None and size >= literals:
            own = owner[:n] == owner[size - 1:]
        found.append((own, hashes, bare, size))
    for flags, words, kinds, size in found:
        at = np.flatnonzero(flags)
        salt = np.uint64(0 if size == window else size)
        if len(at):
            yield owner[at], at - first[owner[at]], _mix(_rolled(words, size)[at] + salt).view(np.int64), hashes, kinds, at, size


def _slots(hashes: np.ndarray, kind: np.ndarray, at: np.ndarray, window: int) -> list[list[int]]:
    literal = hashes.view(np.int64)
    return [[int(literal[i + j]) for j in range(window) if kind[i + j] != LITERAL] for i in at.tolist()]


def _windows(df: DataFrame, ids: list[str], text: str, window: int, literals: int, bits: np.ndarray | None = None,
             short: list[int] | None = None) -> DataFrame:
    """One row per window of a text: the columns ``ids``, ``pos``, ``hash``, ``slots``, ``size``.

    The windows of documents are filtered by ``bits`` and have the sizes ``short`` beside ``window``; items have neither.
    """
    ship_package(df.sparkSession)
    small_batches(df.sparkSession)
    source = df.select(*ids, F.col(text).alias("__text")).where("__text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, len(ids)):
                for owner, pos, hashed, hashes, kind, at, size in _forms(part.column(len(ids)).to_pylist(), window, literals, short):
                    if bits is not None:
                        bit = hashed.view(np.uint64) & np.uint64((1 << FILTER_BITS) - 1)
                        hit = (bits[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
                        owner, pos, hashed, at = owner[hit], pos[hit], hashed[hit], at[hit]
                    if len(owner):
                        yield pa.RecordBatch.from_arrays(
                            [c.take(pa.array(owner)) for c in part.columns[:len(ids)]]
                            + [pa.array(pos, pa.int64()), pa.array(hashed, pa.int64()),
                               pa.array(_slots(hashes, kind, at, size), pa.list_(pa.int64())),
                               pa.array(np.full(len(owner), size), pa.int64())],
                            names=[*ids, "pos", "hash", "slots", "size"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name in ids)
    return source.mapInArrow(run, f"{schema}, pos bigint, hash bigint, slots array<bigint>, size bigint")


def window_filter(windows: DataFrame) -> np.ndarray:
    """A bit for each window hash, in a table of fixed size: at most 2 ** (FILTER_BITS - 6) rows reach the driver."""
    bit = F.col("hash").bitwiseAND((1 << FILTER_BITS) - 1)
    rows = (windows.groupBy(F.shiftright(bit, 6).alias("word"))
            .agg(F.bit_or(F.expr(f"shiftleft(1L, CAST((hash & {(1 << FILTER_BITS) - 1}) & 63 AS INT))")).alias("bits")).toArrow())
    table = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    if rows.num_rows:
        table[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return table


def rare_windows(known: DataFrame, sizes: DataFrame, threshold: float) -> DataFrame:
    """(hash, items): of every item the windows of which a document that holds it has at least one, by hash.

    Of n places, of which m must be met, the n - m + 1 whose windows the fewest items share; ties go to the first.
    """
    shared = known.groupBy("hash").agg(F.count_distinct("item").alias("n_items"))
    # the benchmark's windows: an item's are one group
    places = known.join(shared, "hash").groupBy("item", "item_pos").agg(F.sum("n_items").alias("n_items"))
    order = Window.partitionBy("item").orderBy("n_items", "item_pos")
    needed = F.ceil(F.col("n_windows") * threshold - 1e-9)
    chosen = places.withColumn("rank", F.row_number().over(order)).join(sizes, "item").where(F.col("rank") <= F.col("n_windows") - needed + 1)
    return known.join(chosen.select("item", "item_pos"), ["item", "item_pos"]).groupBy("hash").agg(F.collect_set("item").alias("items"))


def _candidate_windows(hits: DataFrame, known: DataFrame, sizes: DataFrame, threshold: float) -> DataFrame:
    """The windows that a document and an item have in common, of pairs that share one of the item's rare windows."""
    rare = rare_windows(known, sizes, threshold)
    met = join_spread(hits.select(F.struct("id", "text_key").alias("doc"), "hash"), rare, "hash", "doc")
    pairs = met.select("doc", F.explode("items").alias("item")).distinct()
    # as many rows as a document has windows, for each of its candidates
    windows = hits.withColumn("doc", F.struct("id", "text_key")).join(pairs, "doc").drop("doc")
    return windows.join(known, ["hash", "item"])


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id",
    item_text: str = "text", window: int = WINDOW, literals: int = LITERALS, threshold: float = THRESHOLD,
) -> DataFrame:
    """Pairs of documents and benchmark items that they hold, perhaps with other numbers, names or units.

    Rows (``id_col``, ``text_key``, ``item_col``, ``n_windows``, ``matched``, ``share``, ``reworded``):
    ``text_key`` is a hash of the text, so that documents with the same id but other texts stay apart;
    repeated rows give one. ``matched`` counts the item's windows that the document has along
    alignments with consistent slots, ``share`` is matched / n_windows, at least ``threshold``;
    ``reworded`` tells whether a slot value differs. Windows count in either form, with names as slots or
    as words in any case; an item without a window of ``literals`` literal words is compared word by word,
    and one of fewer than ``literals`` words is only met by a document without other words. NULL texts
    and items without words match nothing; empty tables give no rows.

    Only a filter of fixed size is broadcast. An item that a document holds has one of its rarest windows
    there (of n windows, of which m are needed, one of any n - m + 1), so documents and items meet by these
    first, and only such pairs are compared by all windows: a sentence that all items share joins nothing.
    """
    items = benchmark.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{item_text}`").alias("t"))
    wanted = _windows(items, ["item"], "t", window, literals)
    # an item's first word opens a sentence here, and may stand amid one in a document
    amid = _windows(items.withColumn("t", F.concat(F.lit("x "), "t")), ["item"], "t", window, literals)
    wanted = wanted.union(amid.where("pos = 1").withColumn("pos", F.lit(0).cast("bigint"))).distinct()
    bits = window_filter(wanted)
    short = sorted(r["size"] for r in wanted.where(F.col("size") < window).select("size").distinct().collect())  # fewer than ``window``
    known = wanted.drop("size").withColumnsRenamed({"pos": "item_pos", "slots": "item_slots"})
    sizes = known.groupBy("item").agg(F.count_distinct("item_pos").alias("n_windows"))

    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("text_key"), F.col(f"`{text}`").alias("t"))
    # stored, for it is read for the candidates and for their windows
    hits = cut(_windows(source, ["id", "text_key"], "t", window, literals, bits, short).drop("size"))
    pairs = F.arrays_zip(F.col("item_slots").alias("ours"), F.col("slots").alias("theirs"))
    aligned = (_candidate_windows(hits, known, sizes, threshold)
               .groupBy("id", "text_key", "item", (F.col("pos") - F.col("item_pos")).alias("shift"))
               .agg(F.collect_set(F.struct(F.col("item_pos").alias("at"), pairs.alias("slots"))).alias("windows"))
               .withColumn("values", F.array_distinct(F.flatten(F.transform("windows", lambda w: w["slots"])))))
    # a slot value of the item may meet one value only; an alignment has as many windows as the item at most
    ours = F.array_distinct(F.transform("values", lambda s: s["ours"]))
    consistent = F.size("values") == F.size(ours)
    changed = F.exists("values", lambda s: s["ours"] != s["theirs"])
    # of several values the one in most windows counts, of equally many the item's own; windows with others are left out,
    # and the alignment too unless most of its windows stay: a repeated template would add up over its alignments
    holding = lambda s: F.filter("windows", lambda w: F.array_contains(w["slots"], s))
    often = lambda s: F.struct(
        F.size(F.array_distinct(holding(s)["at"])).alias("n"), (s["ours"] == s["theirs"]).alias("own"), s.alias("slot"))
    main = F.transform(ours, lambda o: F.array_max(F.transform(F.filter("values", lambda s: s["ours"] == o), often))["slot"])
    chosen = aligned.withColumn("chosen", F.when(consistent, F.col("values")).otherwise(main))
    fits = F.filter("windows", lambda w: F.forall(w["slots"], lambda s: F.array_contains("chosen", s)))
    places = lambda windows: F.array_distinct(windows["at"])
    found = (chosen.withColumn("fits", F.when(consistent, F.col("windows")).otherwise(fits))
             .where(2 * F.size(places(F.col("fits"))) > F.size(places(F.col("windows"))))
             .select("id", "text_key", "item", changed.alias("changed"), F.explode("fits.at").alias("at"))
             .groupBy("id", "text_key", "item").agg(F.count_distinct("at").alias("matched"), F.every("changed").alias("reworded")))
    share = F.col("matched") / F.col("n_windows")
    return (found.join(sizes, "item").where(share >= threshold - 1e-9)
            .select(F.col("id").alias(id_col), "text_key", F.col("item").alias(item_col), "n_windows", "matched",
                    share.alias("share"), "reworded"))


def drop_contaminated(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``found`` (from ``contaminated``) doesn't list; NULL ids are compared as values."""
    bad = cut(found.select(F.col(f"`{id_col}`").alias("__id"), F.col("text_key").alias("__key")).distinct())
    if bad.count() <= BROADCAST_ROWS:
        # the texts then stay where they are
        bad = F.broadcast(bad)
    same = F.col(f"`{id_col}`").eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(f"`{text}`")) == F.col("__key"))
    return docs.join(bad, same, "left_anti")
