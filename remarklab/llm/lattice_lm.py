"""Language-model scores of documents from a subword lattice.

The pieces of an existing vocabulary span a lattice over each word; every path from its start to its
end is a segmentation. With a probability per piece, the forward recursion in log space sums all paths
to the word's marginal probability. The vocabulary's own scores, which for merge vocabularies are
negative ranks, give the first probabilities (Zipf's law over ranks); one round of expected counts over
all training words, each weighted by its frequency, fits them to the corpus. No piece is added.

A word seen in training also is one arc of its own through the lattice, so a token's probability is
(1 - u) * c / N + u * lattice, with c its count among N training tokens and u the Good-Turing mass of
unseen words. Every text ends with one end token, which is never spelled.

Word statistics grow with the corpus and are never collected. Words with at least one in ``HEAD``
tokens (so at most ``HEAD`` of them) are sent to all tasks; the others meet their documents in a join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from remarklab.llm.common import cut, ship_package, slices, small_batches

# at most so many words are broadcast, each of at most HEAD_BYTES bytes
HEAD, HEAD_BYTES = 1 << 17, 64
# different words that a task counts before it passes them on
FLUSH = 400_000
# words whose lattices are summed together
TOGETHER = 20_000
SPACE = "▁"
NONE = -math.inf


def words_of(text: str | None) -> list[bytes]:
    """Runs without ASCII white space, A-Z in lower case, as UTF-8."""
    return (text or "").encode().lower().split()


def load_pieces(path: str) -> list[str]:
    """Pieces of a sentencepiece model in the order of their scores; bytes as ``<0xNN>`` come last.

    The vocabulary is bounded: files beyond a million pieces are refused.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    if size > 1_000_000:
        raise ValueError(f"{path} has {size} pieces")
    plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return [model.id_to_piece(i) for i in sorted(plain, key=lambda i: (-model.get_score(i), i))]


class Lattice:
    """Log probabilities of pieces, and sums over all segmentations.

    ``weights`` has a natural log probability for every piece, then for each of the 256 bytes, then for
    the end of a word. A character that is no piece is spelled by its bytes.
    """

    def __init__(self, pieces: list[str], weights: np.ndarray):
        self.table: dict[str, int] = {}
        for i, piece in enumerate(pieces):
            self.table[piece] = i
            for k in range(1, len(piece)):
                self.table.setdefault(piece[:k], -1)  # a prefix only
        self.first_byte = len(pieces)
        self.weights = weights.tolist()
        self.stop = self.weights[-1]

    def arcs(self, text: str) -> list[list[tuple[int, int, float]]]:
        """For each position the arcs that start there: end, piece, log probability (piece -1: bytes)."""
        get, weights, out = self.table.get, self.weights, []
        for i in range(len(text)):
            own = []
            for j in range(i + 1, len(text) + 1):
                k = get(text[i:j])
                if k is None:
                    break
                if k >= 0:
                    own.append((j, k, weights[k]))
            if not own or own[0][0] != i + 1:
                own.append((i + 1, -1, sum(weights[self.first_byte + b] for b in text[i].encode())))
            out.append(own)
        return out

    def forward(self, arcs: list) -> list[float]:
        """Log of the summed probability of all paths from the start to each position."""
        coming: list[list[float]] = [[] for _ in range(len(arcs) + 1)]
        coming[0].append(0.0)
        alpha = []
        exp, log = math.exp, math.log
        for i, values in enumerate(coming):
            if len(values) == 1:
                a = values[0]
            else:
                top = max(values)
                a = top + log(sum([exp(v - top) for v in values]))
            alpha.append(a)
            if i < len(arcs):
                for j, _, w in arcs[i]:
                    coming[j].append(a + w)
        return alpha

    def log_probability(self, word: bytes) -> float:
        """Natural log of the word's marginal probability, its end included."""
        return self.forward(self.arcs(SPACE + word.decode()))[-1] + self.stop

    def expected_counts(self, word: bytes, times: float, counts: list[float]) -> None:
        """Add the expected uses of every piece and byte in ``times`` occurrences of a word."""
        text = SPACE + word.decode()
        arcs = self.arcs(text)
        alpha = self.forward(arcs)
        whole = alpha[-1]
        exp, log = math.exp, math.log
        beta = [0.0] * len(alpha)
        for i in range(len(arcs) - 1, -1, -1):
            own = arcs[i]
            if len(own) == 1:
                beta[i] = own[0][2] + beta[own[0][0]]
            else:
                values = [w + beta[j] for j, _, w in own]
                top = max(values)
                beta[i] = top + log(sum([exp(v - top) for v in values]))
            for j, k, w in own:
                share = times * exp(min(0.0, alpha[i] + w + beta[j] - whole))
                if k >= 0:
                    counts[k] += share
                else:
                    for b in text[i].encode():
                        counts[self.first_byte + b] += share


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Lattices:
    """The recursions of ``Lattice`` for many words at once, words of equal length together."""

    SLOTS = 18
    LONGEST = 48  # longer words are left to ``Lattice``

    def __init__(self, pieces: list[str], weights: np.ndarray):
        self.single = Lattice(pieces, weights)
        self.weights = np.append(weights[:len(pieces)], -np.inf)  # the last stands for no piece
        self.first_byte, self.size = len(pieces), len(weights)
        self.width = max((len(p) for p in pieces), default=1)
        base = np.uint64(0x9E3779B97F4A7C15)
        inverse = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
        self.powers = np.cumprod(np.append(np.uint64(1), np.full(self.LONGEST + 1, base)))
        self.inverse = np.cumprod(np.append(np.uint64(1), np.full(self.LONGEST + 1, inverse)))
        if len(pieces) << 1 > 1 << self.SLOTS:
            self.SLOTS = (len(pieces) << 1).bit_length()
        # open addressing: a piece's key lies in its slot or in the next free one
        self.keys = np.zeros(1 << self.SLOTS, np.uint64)
        self.values = np.full(1 << self.SLOTS, -1, np.int64)
        by_length: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            by_length.setdefault(len(piece), []).append(i)
        for n, own in by_length.items():
            if n > self.LONGEST + 1:
                continue
            codes = np.frombuffer("".join(pieces[i] for i in own).encode("utf-32-le"), "<u4").reshape(-1, n)
            keys = self._keys(codes, np.array([0]), np.array([n]))[:, 0]
            for i, key in zip(own, keys.tolist()):
                at = key >> 64 - self.SLOTS
                while self.keys[at]:
                    at = at + 1 & (1 << self.SLOTS) - 1
                self.keys[at], self.values[at] = key, i

    def _keys(self, codes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hashes of the substrings from ``start`` to ``stop`` of every row."""
        n = codes.shape[1]
        sums = np.zeros((len(codes), n + 1), np.uint64)
        np.cumsum(_mix(codes.astype(np.uint64) + np.uint64(1)) * self.powers[:n], axis=1, out=sums[:, 1:])
        size = (stop - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return _mix((sums[:, stop] - sums[:, start]) * self.inverse[start] + size) | np.uint64(1)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Piece of every key, -1 for none."""
        flat = keys.ravel()
        at = (flat >> np.uint64(64 - self.SLOTS)).astype(np.int64)
        out = np.full(len(flat), -1, np.int64)
        todo = np.arange(len(flat))
        while len(todo):
            held = self.keys[at[todo]]
            hit = held == flat[todo]
            out[todo[hit]] = self.values[at[todo[hit]]]
            todo = todo[(held != 0) & ~hit]
            at[todo] = at[todo] + 1 & (1 << self.SLOTS) - 1
        return out.reshape(keys.shape)

    def _groups(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, list[str]]]:
        texts = [SPACE + w.decode() for w in words]
        sizes = np.array([len(t) for t in texts])
        for n in np.unique(sizes):
            index = np.flatnonzero(sizes == n)
            for part in np.array_split(index, len(index) * n * min(n, self.width) // 2_000_000 + 1):
                yield part, [texts[i] for i in part]

    def _arcs(self, texts: list[str]):
        """Codes, first and last position of each arc, the pieces, and the log probabilities, of words of one length."""
        n = len(texts[0])
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").reshape(-1, n)
        start, stop = np.array([(i, j) for j in range(1, n + 1) for i in range(max(0, j - self.width), j)]).T
        found = self._find(self._keys(codes, start, stop))
        weights = self.weights[found]
        # characters that are no piece are spelled by their bytes
        single = np.flatnonzero(stop - start == 1)
        rows, columns = np.nonzero(found[:, single] < 0)
        if len(rows):
            chars, inverse = np.unique(codes[rows, start[single[columns]]], return_inverse=True)
            cost = np.array([sum(self.single.weights[self.first_byte + b] for b in chr(c).encode()) for c in chars])
            weights[rows, single[columns]] = cost[inverse]
        return codes, start, stop, found, weights

    @staticmethod
    def _sum(values: np.ndarray) -> np.ndarray:
        """Log of the sum of exponentials along the rows."""
        top = values.max(1)
        return top + np.log(np.exp(values - top[:, None]).sum(1))

    def _forward(self, n: int, start, stop, weights) -> np.ndarray:
        alpha = np.zeros((len(weights), n + 1))
        for j in range(1, n + 1):
            own = np.flatnonzero(stop == j)
            alpha[:, j] = self._sum(alpha[:, start[own]] + weights[:, own])
        return alpha

    def log_probabilities(self, words: list[bytes]) -> np.ndarray:
        """Natural log of every word's marginal probability, its end included."""
        out = np.zeros(len(words))
        for index, texts in self._groups(words):
            if len(texts[0]) > self.LONGEST:
                out[index] = [self.single.log_probability(words[i]) for i in index]
                continue
            _, start, stop, _, weights = self._arcs(texts)
            out[index] = self._forward(len(texts[0]), start, stop, weights)[:, -1] + self.single.stop
        return out

    def expected_counts(self, words: list[bytes], times: np.ndarray, counts: np.ndarray) -> None:
        """Add the expected uses of every piece and byte in ``times`` occurrences of each word."""
        for index, texts in self._groups(words):
            n = len(texts[0])
            if n > self.LONGEST:
                own = [0.0] * self.size
                for i in index:
                    self.single.expected_counts(words[i], float(times[i]), own)
                counts += own
                continue
            codes, start, stop, found, weights = self._arcs(texts)
            alpha = self._forward(n, start, stop, weights)
            beta = np.zeros((len(texts), n + 1))
            for i in range(n - 1, -1, -1):
                own = np.flatnonzero(start == i)
                beta[:, i] = self._sum(weights[:, own] + beta[:, stop[own]])
            share = np.exp(np.minimum(0.0, alpha[:, start] + weights + beta[:, stop] - alpha[:, -1:])) * times[index][:, None]
            known = found >= 0
            counts += np.bincount(found[known], share[known], self.size)
            rows, columns = np.nonzero(~known & (share > 0))
            for c, x in zip(codes[rows, start[columns]].tolist(), share[rows, columns].tolist()):
                for b in chr(c).encode():
                    counts[self.first_byte + b] += x


def initial_weights(n_pieces: int) -> np.ndarray:
    """Zipf's law over the ranks of pieces; bytes and the end of a word like the middle of the list."""
    p = 1.0 / (np.arange(n_pieces) + 2.7)
    rest = np.full(257, 1.0 / (n_pieces / 2 + 2.7))
    rest[-1] = p.sum() / 2
    p = np.concatenate([p, rest])
    return np.log(p / p.sum())


def count_words(df: DataFrame, text: str, train: Column) -> DataFrame:
    """Rows (word, c, n): a word's occurrences in training rows and in all rows."""
    ship_package(df.sparkSession)
    small_batches(df.sparkSession)
    source = df.select(F.coalesce(train, F.lit(False)).alias("train"), F.col(f"`{text}`").alias("__text")).where("__text IS NOT NULL")

    def tables(learned: Counter, others: Counter) -> Iterator[pa.RecordBatch]:
        for counter, use in ((learned, 1), (others, 0)):
            n = np.fromiter(counter.values(), np.int64, len(counter))
            yield pa.RecordBatch.from_arrays([pa.array(list(counter), pa.binary()), pa.array(n * use), pa.array(n)], names=["word", "c", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned, others = Counter(), Counter()
        for batch in batches:
            for part in slices(batch, 1):
                for use, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    (learned if use else others).update(words_of(value))
                if len(learned) + len(others) >= FLUSH:
                    yield from tables(learned, others)
                    learned, others = Counter(), Counter()
        yield from tables(learned, others)

    return source.mapInArrow(run, "word binary, c bigint, n bigint").groupBy("word").agg(
        F.sum("c").alias("c"), F.sum("n").alias("n"))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Words and counts of several batches together."""
    words, counts = [], []
    for batch in batches:
        words += batch.column(0).to_pylist()
        counts += batch.column(1).to_pylist()
        if len(words) >= TOGETHER:
            yield words, np.array(counts, np.int64)
            words, counts = [], []
    if words:
        yield words, np.array(counts, np.int64)


def fit_pieces(words: DataFrame, pieces: list[str]) -> np.ndarray:
    """Log probabilities of pieces, bytes and the end of a word after one round of expected counts."""
    ship_package(words.sparkSession)
    first = initial_weights(len(pieces))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices, counts = Lattices(pieces, first), np.zeros(len(first))
        for words, times in _gathered(batches):
            lattices.expected_counts(words, times, counts)
            counts[-1] += times.sum()
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], names=["piece", "uses"])

    rows = (words.where("c > 0").select("word", "c").mapInArrow(run, "piece int, uses double")
            .groupBy("piece").agg(F.sum("uses").alias("uses")).toArrow())  # as many as pieces at most
    uses = np.zeros(len(first))
    uses[rows["piece"].to_numpy()] = rows["uses"].to_numpy()
    if not uses.any():
        return first
    uses += 0.1
    return np.log(uses / uses.sum())


def _spelled(words: DataFrame, pieces: list[str], weights: np.ndarray) -> DataFrame:
    """Add ``spelled``: the natural log of each word's lattice probability."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = Lattices(pieces, weights)
        for own, c in _gathered(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.binary()), pa.array(c), pa.array(lattices.log_probabilities(own))], names=["word", "c", "spelled"])

    return words.select("word", "c").mapInArrow(run, "word binary, c bigint, spelled double")


def score_documents(df: DataFrame, pieces: list[str], train: Column, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Log10 probabilities of every row's text under the lattice model and under add-0.1 word counts.

    Rows (``id_col``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``), one per
    row of ``df``; the model learns from the rows where ``train`` holds. Tokens are the words and one
    end; ``n_known`` counts those seen in training; ``base_score`` sums
    log10((c + 0.1) / (N + 0.1 * (V + 1))). NULL and empty texts have the end only. Rows that repeat an
    id and a text are scored once and returned as often as they come; an empty table gives an empty
    one. Without training rows base scores are 0 and the vocabulary's own scores spell all words.
    """
    spark = df.sparkSession
    words = cut(count_words(df, text, train))
    learned = df.where(train).count()
    row = words.agg(F.sum("c").alias("c"), F.sum("n").alias("n"), F.count_if(F.col("c") > 0).alias("v"),
                    F.count_if(F.col("c") == 1).alias("once")).head()
    tokens, kinds = (row["c"] or 0) + learned, (row["v"] or 0) + (learned > 0)
    weights = fit_pieces(words, pieces)
    unseen = min(0.5, ((row["once"] or 0) + 1) / (tokens + 2)) if tokens else 1.0
    below = math.log10(tokens + 0.1 * (kinds + 1))
    # at most HEAD words can reach this count
    frequent = (F.col("n") >= max(1, math.ceil((row["n"] or 0) / HEAD))) & (F.octet_length("word") <= HEAD_BYTES)

    log10 = math.log(10)
    spell = F.col("spelled") + math.log(unseen)
    seen = F.log(F.col("c") * ((1 - unseen) / max(1, tokens)))
    top = F.greatest(spell, seen)
    mixed = F.when(F.col("c") > 0, top + F.log(F.exp(spell - top) + F.exp(seen - top))).otherwise(spell) / log10
    costs = [(F.log10(F.col("c") + 0.1) - below).alias("base"), mixed.alias("score"), (F.col("c") > 0).cast("int").alias("known")]
    head_rows = _spelled(words.where(frequent), pieces, weights).select("word", *costs).toArrow()
    head = spark.sparkContext.broadcast({
        w: (b, s, k) for w, b, s, k in zip(*(head_rows[c].to_pylist() for c in ("word", "base", "score", "known")))})
    tail = _spelled(words.where(~frequent), pieces, weights).select(F.xxhash64("word").alias("word"), *costs)
    end = (math.log10(learned + 0.1) - below, math.log10((1 - unseen) * learned / tokens) if learned else 0.0, int(learned > 0))

    source = df.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.xxhash64(f"`{text}`"), F.lit(0)).alias("text_key"),
                       F.col(f"`{text}`").alias("__text"))
    names = ["id", "text_key", "word", "times", "rows", "tokens", "base", "score", "known"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, digest = head.value, xxhash.xxh64_intdigest
        for batch in batches:
            for part in slices(batch, 2):
                owner, word, times, one, size, base, score, seen_here = [], [], [], [], [], [], [], []
                keys = part.column(1).to_pylist()
                for i, value in enumerate(part.column(2).to_pylist()):
                    own = words_of(value)
                    b, s, k = end
                    rest = []
                    for w, t in Counter(own).items():
                        found = known.get(w)
                        if found is None:
                            rest.append(digest(w, 42))
                            times.append(t)
                        else:
                            b += t * found[0]
                            s += t * found[1]
                            k += t * found[2]
                    # the row's own line carries the head's sums; its key is spread and adds nothing
                    n = len(rest)
                    owner.extend([i] * (n + 1))
                    rest.append(keys[i] & 0xFFFFFFFFFFFFFFFF)
                    word.extend(rest)
                    times.append(0)
                    zeros = [0] * n
                    one += zeros + [1]
                    size += zeros + [len(own) + 1]
                    base += zeros + [b]
                    score += zeros + [s]
                    seen_here += zeros + [k]
                at = pa.array(owner, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), pa.array(np.array(word, np.uint64).view(np.int64)),
                     pa.array(times, pa.int32()), pa.array(one, pa.int32()), pa.array(size, pa.int64()),
                     pa.array(base, pa.float64()), pa.array(score, pa.float64()), pa.array(seen_here, pa.int64())], names=names)

    kind = source.schema["id"].dataType.simpleString()
    lines = source.mapInArrow(run, f"id {kind}, text_key bigint, word bigint, times int, `rows` int, tokens bigint, "
                                   "base double, score double, known bigint")
    priced = lines.join(tail.withColumnsRenamed({"base": "b", "score": "s", "known": "k"}), "word", "left")
    add = lambda own, price: F.sum(F.col(own) + F.col("times") * F.coalesce(F.col(price), F.lit(0))).alias(own)
    summed = priced.groupBy("id", "text_key").agg(
        F.sum("rows").alias("rows"), F.sum("tokens").alias("tokens"), add("base", "b"), add("score", "s"), add("known", "k"))
    # repeated rows were added up: share the sums among them
    return (summed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
            .select(F.col("id").alias(id_col), F.expr("tokens div rows").alias("n_tokens"), F.expr("known div rows").alias("n_known"),
                    F.lit(tokens).cast("bigint").alias("train_tokens"),
                    (F.col("base") / F.col("rows")).alias("base_score"), (F.col("score") / F.col("rows")).alias("score")))
