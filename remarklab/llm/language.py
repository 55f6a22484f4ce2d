"""Language identification by prediction by partial matching (PPM).

A text is read as its words (runs of letters, lower case, as UTF-8 bytes), each closed by a space; long
words are cut. For every language a tree of byte contexts of order 0 to ``ORDER`` holds how often each
byte followed; contexts reach back to the space before the word. The trees are frozen after training.
A byte costs -log2 of its share in the longest context that knows it, plus the escapes from longer
ones (method C: a context with t counts and d different bytes escapes with d / (t + d)); a byte that no
context knows costs 8 bits more. The language with the shortest exact code wins.

Contexts don't cross words, so a word costs the same wherever it stands, and a worker codes each
different word once. Languages are scored in slices, one after the other, so that the costs that a
worker holds are bounded however many languages there are.
"""

from __future__ import annotations

import math
import re
import sys
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from remarklab.llm.common import append_columns, free_name, held, ship_package, small_batches

ORDER = 4
# longest piece of a word, words that a worker remembers
WORD_LENGTH, CACHE_WORDS = 32, 200_000
# bounds of the training sample and of the model, for each language: rows and strings
SAMPLE_ROWS, STRINGS = 1500, 100_000
# numbers that a slice's cost table may hold
CELLS = 1 << 24
UNKNOWN = "und"


def ranges(kinds: str) -> str:
    """All characters whose Unicode category begins with one of ``kinds``, as the inside of a pattern's set."""
    points = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] in kinds]
    out = []
    for i, c in enumerate(points):
        if not i or points[i - 1] != c - 1:
            out.append([c, c])
        out[-1][1] = c
    return "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in out)


# letters and numbers that are no decimal digits, which for most texts is letters
FAST_WORD = re.compile(r"[^\W\d_]{1,%d}" % WORD_LENGTH)


@lru_cache(maxsize=1)
def word_pattern() -> re.Pattern:
    """A letter and the letters and marks behind it; digits and other numbers are no letters."""
    return re.compile(f"[{ranges('L')}][{ranges('LM')}]{{0,{WORD_LENGTH - 1}}}")


@lru_cache(maxsize=1)
def odd_characters() -> frozenset[str]:
    """Marks, and numbers that are no decimal digits: only texts with one of them need the exact pattern, which is slow."""
    every = map(chr, range(sys.maxunicode + 1))
    return frozenset(c for c in every if (kind := unicodedata.category(c))[0] == "M" or kind in ("No", "Nl"))


def words_of(text: str) -> list[str]:
    low = text.lower()
    if low.isascii() or odd_characters().isdisjoint(low):
        return FAST_WORD.findall(low)
    return word_pattern().findall(low)


def coded(word: str) -> bytes:
    """The space before a word, the word, and the space behind it."""
    return b" " + word.encode() + b" "


def count_strings(texts: Iterator[str], order: int = ORDER) -> Counter:
    """How often each context (up to ``order`` bytes) with its next byte occurs."""
    words: Counter = Counter()
    for text in texts:
        words.update(words_of(text))
    counts: Counter = Counter()
    for word, n in words.items():
        b = coded(word)
        for i in range(1, len(b)):
            for k in range(min(order, i) + 1):
                counts[b[i - k:i + 1]] += n
    return counts


class Model:
    """Frozen counts of all languages as cost vectors."""

    def __init__(self, counts: dict[str, dict[bytes, int]], order: int = ORDER, alphabet: int | None = None):
        self.order = order
        self.languages = sorted(counts)
        total = {lang: Counter() for lang in self.languages}
        kinds = {lang: Counter() for lang in self.languages}
        for lang in self.languages:
            for s, n in counts[lang].items():
                total[lang][s[:-1]] += n
                kinds[lang][s[:-1]] += 1
        size = len(self.languages)
        contexts = {c for lang in self.languages for c in total[lang]}
        # what leaving a context costs in each language (nothing where the language doesn't have it)
        self.escape = {c: i for i, c in enumerate(sorted(contexts))}
        escape = np.zeros((len(self.escape), size))
        for j, lang in enumerate(self.languages):
            for c, t in total[lang].items():
                escape[self.escape[c], j] = math.log2((t + kinds[lang][c]) / kinds[lang][c])
        # what a byte costs in the longest context of the union that knows it
        strings = sorted({s for lang in self.languages for s in counts[lang]}, key=lambda s: (len(s), s))
        self.known = {s: i for i, s in enumerate(strings)}
        cost = np.zeros((len(strings), size))
        empty = self.escape.get(b"")
        unknown = (escape[empty] if empty is not None else 0.0) + 8.0
        for i, s in enumerate(strings):
            # shorter contexts come first, so what a language without this string pays is known
            shorter = cost[self.known[s[1:]]] if len(s) > 1 and s[1:] in self.known else unknown
            cost[i] = shorter + (escape[self.escape[s[:-1]]] if len(s) > 1 else 0.0)
            for j, lang in enumerate(self.languages):
                n = counts[lang].get(s)
                if n:
                    c = s[:-1]
                    cost[i, j] = math.log2((total[lang][c] + kinds[lang][c]) / n)
        if empty is None:
            unknown = np.full(size, 8.0)
        # rows: costs of known strings, escapes, the unknown byte
        self.rows = np.vstack([cost, escape, np.broadcast_to(unknown, (1, size))]) if size else np.zeros((1, 0))
        self.first_escape, self.unknown = len(strings), len(strings) + len(self.escape)
        # bits of a byte in a code that uses all bytes seen in training alike, in any language
        self.uniform = math.log2(max(1, sum(len(s) == 1 for s in strings) if alphabet is None else alphabet))

    def parts(self, word: str) -> list[int]:
        """Rows whose sum is the cost of a word."""
        b = coded(word)
        out = []
        for i in range(1, len(b)):
            for k in range(min(self.order, i), -1, -1):
                row = self.known.get(b[i - k:i + 1])
                if row is not None:
                    out.append(row)
                    break
                if k:
                    left = self.escape.get(b[i - k:i])
                    if left is not None:
                        out.append(self.first_escape + left)
            else:
                out.append(self.unknown)
        return out


def slices_of(counts: dict[str, dict[bytes, int]], cells: int = CELLS) -> list[list[str]]:
    """The languages in order, in runs whose cost tables (strings and contexts by languages) hold about ``cells`` numbers at most."""
    out: list[list[str]] = []
    rows = 0
    for lang in sorted(counts):
        size = 2 * len(counts[lang])
        if not out or (rows + size) * (len(out[-1]) + 1) > cells:
            out.append([])
            rows = 0
        out[-1].append(lang)
        rows += size
    return out


class Scorer:
    """Code lengths of texts; remembers the costs of words."""

    def __init__(self, model: Model):
        self.model = model
        self.seen: dict[str, int] = {}
        width = 2 * len(model.languages) + 1
        self.words = min(CACHE_WORDS, max(CELLS // width, 1))
        self.costs = np.zeros((self.words, width))

    def code_lengths(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Sums of ``costs_of`` over each text's words."""
        out = []
        for words in texts:
            new = set(words).difference(self.seen)
            if len(self.seen) + len(new) > self.words:
                self.seen = {}
                new = set(words)
            if len(new) > self.words:  # one text with more different words: code them in pieces
                counts = Counter(words)
                out.append(sum((self.costs_of([w]) * n).sum(0) for w, n in counts.items()))
                continue
            if new:
                fresh = sorted(new)
                at = len(self.seen)
                self.costs[at:at + len(fresh)] = self.costs_of(fresh)
                self.seen.update(zip(fresh, range(at, at + len(fresh))))
            index = np.fromiter(map(self.seen.__getitem__, words), np.int64, len(words))
            out.append(self.costs[index].sum(0))
        return out

    def costs_of(self, words: list[str]) -> np.ndarray:
        """For every word: its bits in each language; its bytes in those that beat the uniform code, else 0; its bytes."""
        parts = [self.model.parts(w) for w in words]
        flat = np.fromiter((r for p in parts for r in p), np.int64)
        first = np.cumsum([0] + [len(p) for p in parts[:-1]])
        bits = np.add.reduceat(self.model.rows[flat], first, axis=0)
        size = np.array([[len(coded(w)) - 1] for w in words], float)
        return np.hstack([bits, (bits < size * self.model.uniform) * size, size])


def train(labelled: DataFrame, id_col: str, text: str, lang: str, sample_rows: int = SAMPLE_ROWS,
          strings: int = STRINGS, order: int = ORDER) -> dict[str, dict[bytes, int]]:
    """Counts per language from a bounded sample of labelled rows.

    The sample holds, of every label, the ``sample_rows`` rows of smallest id hash, whole texts; each
    language keeps its ``strings`` most frequent strings. That bounds what is learned of a language whatever
    the corpus; the driver holds all languages. NULL labels and texts teach nothing; without any labelled
    row the model is empty.
    """
    ship_package(labelled.sparkSession)
    small_batches(labelled.sparkSession)
    rows = labelled.where(F.col(f"`{lang}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("string").alias("i"), F.col(f"`{lang}`").cast("string").alias("l"), F.col(f"`{text}`").alias("t"))
    counted = rows.groupBy("l").count().collect()  # a row per language
    if not counted:
        return {}
    # a hash below the language's bound: twice the rows wanted are expected, so that the rank below is cheap
    span = 1 << 32
    shares = [(r["l"], min(span, max(1, span * 2 * sample_rows // r["count"] + 1))) for r in counted]
    hashed = F.xxhash64("i", F.lit(7)).bitwiseAND(span - 1)

    def below(frame: DataFrame, bounds: list, name: str) -> DataFrame:
        table = frame.sparkSession.createDataFrame(bounds, f"l string, {name} bigint")
        return frame.join(F.broadcast(table), "l")

    few = below(rows.withColumn("h", hashed), shares, "bound").where(F.col("h") < F.col("bound")).drop("bound")
    ranked = few.select("l", "h", "i").groupBy("l").agg(F.sort_array(F.collect_list("h")).alias("hs"))  # about 2 * sample_rows each
    cuts = ranked.select("l", F.element_at("hs", F.least(F.size("hs"), F.lit(sample_rows))).alias("c")).collect()
    sample = below(few, [tuple(r) for r in cuts], "cut").where((F.col("h") <= F.col("cut")) & F.col("t").isNotNull()).select("l", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list[str]] = {}
            for label, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by.setdefault(label, []).append(value)
            for label, texts in by.items():
                counts = count_strings(texts, order)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label] * len(counts), pa.string()), pa.array(list(counts), pa.binary()),
                     pa.array(list(counts.values()), pa.int64())], names=["l", "s", "n"])

    summed = sample.mapInArrow(run, "l string, s binary, n bigint").groupBy("l", "s").agg(F.sum("n").alias("n"))
    # one group per language, bounded by its sample
    frequent = Window.partitionBy("l").orderBy(F.desc("n"), "s")
    table = summed.withColumn("k", F.row_number().over(frequent)).where(F.col("k") <= strings).select("l", "s", "n").toArrow()
    counts: dict[str, dict[bytes, int]] = {}
    for label, s, n in zip(*(table[c].to_pylist() for c in ("l", "s", "n"))):
        counts.setdefault(label, {})[s] = n
    return counts


def scorer_of(name: str, model: Broadcast) -> Scorer:
    """The worker's scorer of a broadcast model; it keeps its words from task to task, one slice at a time."""
    return held(("language", name), lambda: Scorer(model.value))


SLICE = "lang string, bits double, rest double, coded double, fitting double"


def _score_slice(df: DataFrame, model: Broadcast, text: str, out: str) -> DataFrame:
    """Add a struct ``out``: the best language of a slice, its bits, the sum of 2 ** (its bits - bits), coded bytes, fitting bytes."""
    name = uuid.uuid4().hex

    def make():
        scorer = scorer_of(name, model)
        languages = scorer.model.languages

        def run(texts):
            words = [words_of(t) if t else [] for t in texts]
            found: list = [None] * len(words)
            n = len(languages)
            for i, sums in enumerate(scorer.code_lengths(words)):
                if words[i]:
                    bits = sums[:n]
                    best = int(np.argmin(bits))
                    rest = np.exp2(np.maximum(bits[best] - bits, -1000.0)).sum()
                    found[i] = {"lang": languages[best], "bits": float(bits[best]), "rest": float(rest), "coded": float(sums[-1]), "fitting": float(sums[n + best])}
            return [found]

        return run

    return append_columns(df, text, f"{out} struct<{SLICE.replace(' ', ':').replace(',:', ',')}>", make)


def identify(df: DataFrame, counts: dict[str, dict[bytes, int]], text: str = "text", order: int = ORDER,
             keep: list[str] | None = None) -> DataFrame:
    """Add ``lang_pred``, ``score``, ``bits_per_byte`` and ``fit`` to every row.

    ``lang_pred`` is the language with the shortest code (of equals the first by name), ``und`` for a
    text that is NULL or has no letter and where no language was learned; ``score`` is that language's
    posterior probability under equal priors (0 for ``und``); ``bits_per_byte`` is its code length per
    coded byte and ``fit`` the share of these bytes in words that the language codes in fewer bits than
    a code that uses all bytes seen in training alike (both NULL for ``und``). Repeated rows each get their own; columns named like the new ones are
    replaced; an empty table gives an empty one. Nothing is shuffled; a slice of languages is a pass over the texts.
    """
    new = {"lang_pred", "score", "bits_per_byte", "fit"}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    body = free_name(kept, "__text")
    rows = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias(body))
    alphabet = len({s for own in counts.values() for s in own if len(s) == 1})
    results = []
    for group in slices_of(counts, CELLS):
        results.append(free_name([*kept, body, *results], f"__slice{len(results)}"))
        model = df.sparkSession.sparkContext.broadcast(Model({lang: counts[lang] for lang in group}, order, alphabet))
        rows = _score_slice(rows, model, body, results[-1])
    if not results:
        none = F.lit(None).cast("double")
        return rows.select(*[F.col(f"`{c}`") for c in kept], F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                           none.alias("bits_per_byte"), none.alias("fit"))
    # the shortest code; of equals the earlier slice's, whose names come first
    order_of = [F.struct(F.col(r)["bits"].alias("bits"), F.lit(i).alias("i"), F.col(r).alias("r")) for i, r in enumerate(results)]
    best = (F.least(*order_of) if len(order_of) > 1 else order_of[0])["r"]
    # a language that is much longer than the best adds nothing
    rest = reduce(lambda a, b: a + b, [F.col(r)["rest"] * F.pow(F.lit(2.0), F.greatest(best["bits"] - F.col(r)["bits"], F.lit(-1000.0))) for r in results])
    found = F.col(results[0]).isNotNull()
    return rows.select(
        *[F.col(f"`{c}`") for c in kept],
        F.when(found, best["lang"]).otherwise(UNKNOWN).alias("lang_pred"), F.when(found, 1.0 / rest).otherwise(0.0).alias("score"),
        (best["bits"] / best["coded"]).alias("bits_per_byte"), (best["fitting"] / best["coded"]).alias("fit"))


# least share of a text that must fit its language
FIT = 0.3


def reject(lang_pred: Column, fit: Column, counts: dict[str, dict[bytes, int]]) -> Column:
    """Whether a text is in no learned language: undetermined, or most of it in words that don't fit.

    Single strings that no language explains, such as keys, don't matter. Without any learned language
    nothing is rejected.
    """
    return ((lang_pred == UNKNOWN) | (fit < FIT)) if counts else F.lit(False)
