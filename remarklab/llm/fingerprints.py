"""I-Match fingerprints. DataFrame functions only.

The lexicon is the terms whose document frequency over the whole corpus lies in a band, so neither
words that are everywhere nor words that occur once take part. It is cut into randomised subsets: by
hash, a term belongs to one of ``LAYERS`` layers, of which each but the last holds three quarters of what
the layers before it leave, and in its layer to one of ``SUBSETS`` subsets. A fingerprint has a hash for every
subset, over all terms that the text has in it, so every term of the lexicon decides, whatever a text's
length. Hashes of terms are combined by XOR, which needs no order.

Subsets that agree tell how many terms differ: of the subsets of a layer with share p of the lexicon,
exp(-d p / SUBSETS) are expected to agree if d terms differ. Short texts and small changes show in the large layers,
long texts that differ much in the small ones. ``likeness`` reads d from all layers that are not exhausted.

No list of terms is stored or joined with the lexicon. A text is hashed on all its terms but those that are
everywhere, which is a short list; the terms that are too rare are then taken out again by a second XOR.
A rare term stands in one text only, so the count of all terms already says where.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from remarklab.llm.common import cut, free_name, join_spread
from remarklab.llm.native import let

LAYERS, SUBSETS = 5, 64
# a subset's hash is a byte, so a layer is SUBSETS / 8 words of 64 bits
WORDS = SUBSETS // 8
# a layer tells how many terms differ while so many of its subsets agree
AGREEING = 6
# the band: least document frequency (1 or 2), largest share of the documents
LEAST, SHARE = 2, 0.1
# terms beyond the band are at most the mean number of a text's terms divided by SHARE; more than this are refused
EVERYWHERE = 200_000

WORD = r"[\p{L}\p{N}]"


def share_of(layer: int) -> float:
    """Part of the lexicon that a layer holds."""
    return 4.0 ** -layer * (0.75 if layer < LAYERS - 1 else 1.0)


def text_key(text: Column) -> Column:
    """128 bits of a text."""
    return F.struct(F.xxhash64(text).alias("x"), F.xxhash64(F.lit(1), text).alias("y"))


def plain(text: Column) -> Column:
    """A text in lower case, letter by letter: the two small sigmas are one, as which of them it is depends on what follows."""
    return F.replace(F.lower(text), F.lit("\u03c2"), F.lit("\u03c3"))


def hashes(text: Column) -> Column:
    """Hashes of a plain text's words (runs of letters and digits), in order."""
    pieces = F.split(text, r"[^\p{L}\p{N}]+")
    # only the first and the last piece may be empty
    return F.array_remove(F.transform(pieces, lambda w: F.xxhash64(w)), F.xxhash64(F.lit("")))


def terms(text: Column) -> Column:
    """Hashes of the distinct words in lower case, in order of their first places."""
    return F.array_distinct(hashes(plain(text)))


def _shift(value: Column, bits: Column | int) -> Column:
    return F.call_function("shiftrightunsigned", value, bits if isinstance(bits, Column) else F.lit(bits))


def cell(t: Column) -> Column:
    """The word of the fingerprint that a term goes into, and its contribution."""
    # two zero bits more for each layer; the bit behind them ends the count
    y = _shift(t, 6).bitwiseOR(F.lit(1 << 2 * (LAYERS - 1)))
    layer = F.floor(F.bit_count(y.bitwiseAND(-y) - 1) / 2).cast("int")
    byte = _shift(t, 40).bitwiseAND(0xFFFF) % 255 + 1
    return F.struct(
        (layer * WORDS + _shift(t, 3).bitwiseAND(WORDS - 1).cast("int")).alias("w"),
        F.call_function("shiftleft", byte, (t.bitwiseAND(7) * 8).cast("int")).alias("x"))


class Lexicon:
    """Document frequencies of all terms: ``counted`` with term, n and, of terms in a single text, its key and the term's place.

    ``everywhere`` lists the terms beyond the band with the number of doublings of its upper end that reach them.
    """

    def __init__(self, df: DataFrame, text: str = "text", least: int = LEAST, share: float = SHARE):
        if least not in (1, 2):
            raise ValueError("least is 1 or 2: terms that are too rare are traced to a single text")
        self.least, self.most = least, max(least, int(share * df.count()))
        column = F.coalesce(F.col(f"`{text}`"), F.lit(""))
        lines = df.select(F.xxhash64(column).alias("key"), F.posexplode(terms(column)).alias("place", "term"))
        counts = lines.groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("key"), F.min("place").alias("place"))
        self.counted = cut(counts)
        beyond = self.counted.where(F.col("n") > self.most).select(
            "term", F.ceil(F.log2(F.col("n") / self.most)).cast("int").alias("level")).limit(EVERYWHERE + 1).collect()
        if len(beyond) > EVERYWHERE:
            raise ValueError(f"more than {EVERYWHERE} terms are in over a {share} of all texts: raise share")
        self.everywhere = {r["term"]: r["level"] for r in beyond}

    def level(self, name: str) -> Column:
        """0 for terms up to the band's upper end, else the doublings."""
        levels: dict[int, list[str]] = {}
        for t, level in self.everywhere.items():
            levels.setdefault(level, []).append(f"{t}L" if t != -(1 << 63) else "-9223372036854775807L - 1L")
        cases = " ".join(f"WHEN {name} IN ({', '.join(ts)}) THEN {level}" for level, ts in sorted(levels.items()))
        return F.expr(f"CASE {cases} ELSE 0 END") if cases else F.lit(0)

    def rare(self) -> DataFrame:
        """(key, rare): the terms of a text that are below the band, with their places among its distinct terms."""
        return self.counted.where(F.col("n") < self.least).groupBy("key").agg(F.collect_list(F.struct("term", "place")).alias("rare"))


def states(rows: DataFrame, by: list[str], sides: dict[str, Column], lexicon: Lexicon) -> DataFrame:
    """(``by``, a state per side): number and XOR of all terms, and the words of the fingerprint, rare terms included.

    Where ``rows`` are partitioned by one of the columns ``by``, nothing is shuffled. Where most of a text's
    terms lie beyond the band, as in a large group of near copies, its band is wider, up to the level of the middle term.
    """

    def mark(side: int, all_terms: Column) -> Column:
        return F.transform(all_terms, lambda t: F.struct(F.lit(side).alias("side"), t.alias("term")))

    marked = [mark(i, side) for i, side in enumerate(sides.values())]
    # a line without a term keeps rows that have none
    none = F.array(F.struct(F.lit(-1).alias("side"), F.lit(0).cast("bigint").alias("term")))
    lines = rows.select(*by, F.explode(F.concat(none, *marked)).alias("line")).select(*by, "line.*")
    placed = lines.withColumn("level", lexicon.level("term")).withColumn("cell", cell(F.col("term"))).select(*by, "side", "level", "term", "cell.*")
    entries = placed.groupBy(*by, "side", "level", "w").agg(
        F.bit_xor("x").alias("x"), F.count(F.lit(1)).cast("int").alias("n"), F.bit_xor("term").alias("whole"))
    gathered = entries.groupBy(*by).agg(F.collect_list(F.struct("side", "level", "w", "x", "n", "whole")).alias("__entries"))
    return gathered.select(*by, *[_state(F.col("__entries"), i).alias(name) for i, name in enumerate(sides)])


def _state(entries: Column, side: int) -> Column:
    def count(own: Column, most: Column) -> Column:
        return F.aggregate(own, F.lit(0), lambda a, e: a + F.when(e["level"] <= most, e["n"]).otherwise(0))

    def word(p: Column, w: Column) -> Column:
        band = F.coalesce(F.try_element_at(p["band"], w), F.lit(0).cast("bigint"))
        return F.when(p["level"] == 0, band).otherwise(F.aggregate(
            p["own"], band, lambda a, e: F.when((e["w"] == w) & e["level"].between(1, p["level"]), a.bitwiseXOR(e["x"])).otherwise(a)))

    def up_to(p: Column) -> Column:
        return F.struct(
            count(p["own"], p["level"]).cast("bigint").alias("n"),
            F.aggregate(p["own"], F.lit(0).cast("bigint"), lambda a, e: a.bitwiseXOR(e["whole"])).alias("whole"),
            F.transform(F.sequence(F.lit(0), F.lit(LAYERS * WORDS - 1)), lambda w: word(p, w)).alias("words"))

    def of(own: Column) -> Column:
        total = count(own, F.lit(64))
        # hardly any text has mostly terms beyond the band
        level = F.when(count(own, F.lit(0)) * 2 >= total, 0).otherwise(
            F.element_at(F.filter(F.sequence(F.lit(0), F.lit(64)), lambda x: count(own, x) * 2 >= total), 1))
        band = F.map_from_entries(F.transform(F.filter(own, lambda e: e["level"] == 0), lambda e: F.struct(e["w"], e["x"])))
        return let(F.struct(own.alias("own"), level.alias("level"), band.alias("band")), up_to)

    return let(F.filter(entries, lambda e: e["side"] == side), of)


def without(state: Column, removed: Column) -> Column:
    """A state without the rare terms ``removed`` (NULL: none)."""

    def of(p: Column) -> Column:
        return F.struct(
            (p["state"]["n"] - F.size(p["cells"])).alias("n"), p["state"]["whole"].alias("whole"),
            F.transform(p["state"]["words"], lambda x, i: F.aggregate(
                p["cells"], x, lambda a, c: F.when(c["w"] == i, a.bitwiseXOR(c["x"])).otherwise(a))).alias("words"))

    cells = F.transform(F.coalesce(removed, F.array().cast("array<bigint>")), cell)
    return let(F.struct(state.alias("state"), cells.alias("cells")), of)


def written(state: Column) -> Column:
    """``n:whole:hashes``: number of terms in the band, XOR of all terms, and the bytes of all subsets in hexadecimal."""
    return F.concat_ws(":", F.lpad(F.lower(F.hex(state["n"])), 8, "0"), F.lpad(F.lower(F.hex(state["whole"])), 16, "0"), F.lower(
        F.array_join(F.transform(state["words"], lambda x: F.lpad(F.hex(x), 16, "0")), "")))


def read(fingerprint: Column) -> Column:
    """The state that a fingerprint was written from."""
    start = 8 + 1 + 16 + 1  # where the hashes begin

    def number(first: Column | int, digits: int) -> Column:
        at = first if isinstance(first, Column) else F.lit(first)
        return F.conv(F.substring(fingerprint, at, F.lit(digits)), 16, -10).cast("bigint")

    return F.struct(number(1, 8).alias("n"), number(10, 16).alias("whole"), F.transform(
        F.sequence(F.lit(0), F.lit(LAYERS * WORDS - 1)), lambda w: number(w * 16 + start + 1, 16)).alias("words"))


def likeness(one: Column, other: Column) -> Column:
    """Estimated share of equal terms in the band among those of either text; 1 for equal fingerprints.

    The number of different terms comes from the subsets that agree, in all layers where at least ``AGREEING`` do.
    Subsets without a term on either side agree. A byte may agree by chance, which is taken off.
    """
    return state_likeness(read(one), read(other))


def state_likeness(one: Column, other: Column) -> Column:
    """``likeness`` of the states of two fingerprints."""

    def folded(v: Column, bits: int) -> Column:
        return v.bitwiseOR(_shift(v, bits))

    def different(x: Column, y: Column) -> Column:
        # bytes that are not zero: all bits of a byte are folded into its lowest
        return let(folded(x.bitwiseXOR(y), 4), lambda v: let(folded(v, 2), lambda w: F.bit_count(
            folded(w, 1).bitwiseAND(F.lit(0x0101010101010101)))))

    def estimate(p: Column) -> Column:
        known, share = F.lit(0.0), F.lit(0.0)
        for layer in range(LAYERS):
            k = F.get(p["agree"], F.lit(layer))
            equal = F.greatest((k / SUBSETS - 1 / 256) / (1 - 1 / 256), F.lit(0.01))
            known = known + F.when(k >= AGREEING, -F.log(equal) * SUBSETS).otherwise(0.0)
            share = share + F.when(k >= AGREEING, share_of(layer)).otherwise(0.0)
        total = (p["m"] + p["n"]).cast("double")
        # texts differ by as many terms as one has more, at least
        return let(F.greatest(F.when(share > 0, known / share).otherwise(total), F.abs(p["m"] - p["n"]).cast("double")), lambda d: F.when(
            total > 0, F.greatest((total - d) / (total + d), F.lit(0.0))).otherwise(0.0))

    def compare(p: Column) -> Column:
        unlike = F.zip_with(p["a"]["words"], p["b"]["words"], different)
        return let(unlike, lambda u: let(F.struct(p["a"]["n"].alias("m"), p["b"]["n"].alias("n"), F.transform(
            F.sequence(F.lit(0), F.lit(LAYERS - 1)), lambda layer: F.lit(SUBSETS) - F.aggregate(
                F.slice(u, layer * WORDS + 1, F.lit(WORDS)), F.lit(0), lambda a, x: a + x)).alias("agree")), estimate))

    return let(F.struct(one.alias("a"), other.alias("b")), lambda p: F.when(p["a"] == p["b"], 1.0).otherwise(compare(p)))


def fingerprint_documents(df: DataFrame, text: str = "text", least: int = LEAST, share: float = SHARE) -> DataFrame:
    """Add ``fingerprint`` to every row; equal texts have equal ones.

    NULL texts count as empty. A text without terms of the lexicon has zeros for hashes and keeps the XOR
    of all its terms; repeated rows stay; a column named ``fingerprint`` is replaced; an empty table
    gives an empty one.
    """
    column = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    own = [F.col(f"`{c}`") for c in df.columns if c.lower() != "fingerprint"]
    name = free_name(df.columns, "__key")
    lexicon = Lexicon(df, text, least, share)
    rows = df.select(F.monotonically_increasing_id().alias("row"), text_key(column).alias("k"), terms(column).alias("terms"))
    # one of all copies of a text
    texts = states(rows, ["row", "k"], {"own": F.col("terms")}, lexicon).groupBy("k").agg(F.first("own").alias("own"))
    rare = lexicon.rare().select("key", F.transform("rare", lambda r: r["term"]).alias("rare"))
    found = texts.join(rare, F.col("k.x") == F.col("key"), "left").select(
        F.col("k").alias(name), written(without(F.col("own"), F.col("rare"))).alias("fingerprint"))
    spread = free_name([*df.columns, name], "__row")
    keyed = df.select(*own, text_key(column).alias(name), F.monotonically_increasing_id().alias(spread))
    return join_spread(keyed, found, name, spread).drop(name, spread)


def with_next(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """Rows (bucket, place, id, text, next_text): each with the text of the next lower id; after the lowest comes the highest.

    NULL ids come last, equal ids in the order of a hash of their text; a single row is its own next.
    Rows are put into ranges of ids at approximate quantiles. The first row of each range is also put
    behind the range above, so no range needs another. Rows stay partitioned by ``bucket``, in which ``place`` numbers them.
    """
    spark = df.sparkSession
    source = df.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rank = F.coalesce(F.col("id").cast("bigint"), F.lit(-(1 << 63)))
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranks = df.select(F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(-(1 << 63))).alias("r"))
    cuts = ranks.agg(F.percentile_approx("r", [i / n for i in range(1, n)], 20 * n).alias("q")).head()["q"] if n > 1 else []
    bounds = F.array(*[F.lit(b).cast("bigint") for b in sorted(set(cuts or []))]).cast("array<bigint>")
    bucket = F.size(F.filter(bounds, lambda b: b < rank))
    tops = ranks.withColumn("id", F.col("r")).groupBy(bucket.alias("b")).agg(F.max("r").alias("top")).orderBy("b").collect()  # n at most
    above = {r["top"]: up["b"] for r, up in zip(tops, tops[1:] + tops[:1])}
    guest = F.lit(None).cast("int")
    if above:
        pairs = [F.lit(x) for top, b in above.items() for x in (top, b)]
        guest = F.try_element_at(F.create_map(*pairs).cast("map<bigint,int>"), rank)
    own = F.struct(bucket.alias("bucket"), F.lit(False).alias("guest"))
    places = F.when(guest.isNull(), F.array(own)).otherwise(F.array(own, F.struct(guest.alias("bucket"), F.lit(True).alias("guest"))))
    spread = source.select("id", "text", rank.alias("rank"), F.xxhash64("text").alias("h"), F.explode(places).alias("p")).select(
        "id", "text", "rank", "h", "p.*")
    order = Window.partitionBy("bucket").orderBy("guest", F.desc("rank"), "h")
    return spread.withColumns({"next_text": F.lead("text").over(order), "place": F.row_number().over(order)}).where("NOT guest").select(
        "bucket", "place", "id", "text", "next_text")


def _parts(own: Column, kept: Column, prefix: Column) -> Column:
    """The terms of an edited text from those of its two parts, and what tells which rare terms of the parts it has.

    ``own`` has the hashes of the whole first text, ``kept`` its start and ``prefix`` that of the other, both plain.
    Words at the parts' edges may be cut, and where two meet they are one: ``edges`` has the terms of all
    of these, cut, whole and merged. ``first`` and ``second`` count the distinct terms of each part without its last word, if that
    ends the part.
    """

    def at_end(text: Column) -> Column:
        return F.reverse(F.regexp_extract(F.reverse(text), rf"\A{WORD}+", 0))

    def nothing_if(empty: Column, value: Column) -> Column:
        return F.when(empty, F.array().cast("array<bigint>")).otherwise(F.array(value))

    def of(p: Column) -> Column:
        tail, head, end = p["tail"], p["head"], p["end"]
        whole = F.slice(p["own"], F.lit(1), p["n"] - (tail != "").cast("int"))
        rest = F.slice(p["other"], 1 + (head != "").cast("int"), F.size(p["other"]))
        seam = nothing_if((tail == "") & (head == ""), F.xxhash64(F.concat(tail, head)))
        return F.struct(
            F.array_distinct(F.concat(whole, seam, rest)).alias("changed"), F.size(F.array_distinct(whole)).alias("first"),
            F.size(F.array_distinct(F.slice(p["other"], F.lit(1), F.size(p["other"]) - (end != "").cast("int")))).alias("second"),
            F.array_distinct(F.concat(*[nothing_if(w == "", F.xxhash64(w)) for w in (tail, head, end, F.concat(tail, head))])).alias("edges"))

    return let(F.struct(
        own.alias("own"), F.regexp_count(kept, F.lit(f"{WORD}+")).alias("n"), hashes(prefix).alias("other"), at_end(kept).alias("tail"),
        F.regexp_extract(prefix, rf"\A{WORD}+", 0).alias("head"), at_end(prefix).alias("end")), of)


def near_copies(df: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = LEAST, share: float = SHARE) -> DataFrame:
    """Fingerprints of every text and of an edited copy, and their likeness.

    Rows (``id_col``, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).
    The edited copy has its last third replaced by the start of the next lower document's text. The
    lexicon comes from the unedited texts. NULL texts are empty.

    An edited text's terms are those of two parts of texts, but for the words at the parts' edges. A text's rare
    terms come with their places among its distinct terms, and the distinct terms of a part are the first
    so many of the text, so numbers tell which rare terms the edited text has; only the edges are looked up.
    """
    lexicon = Lexicon(df, text, least, share)
    rows = with_next(df, id_col, text)
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    kept, prefix = F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("next_text"), F.lit(1), third)
    parts = rows.withColumns({"kept": kept, "prefix": prefix}).withColumn("edited", F.concat("kept", "prefix"))
    head = ["bucket", "place", "id", "n_chars", "edited_sha256", "key", "next_key", "first", "second", "edges", "inside"]
    described = parts.select(
        "bucket", "place", "id", n.cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        text_key(F.col("text")).alias("key"), text_key(F.col("next_text")).alias("next_key"),
        let(hashes(plain(F.col("text"))), lambda own: F.struct(
            F.array_distinct(own).alias("own"), _parts(own, plain(F.col("kept")), plain(F.col("prefix"))).alias("parts"))).alias("both"))
    described = described.select("*", "both.own", "both.parts.*").withColumn("inside", F.array_intersect("edges", "changed"))
    narrow = cut(states(described.select(*head, "own", "changed"), head, {"own": F.col("own"), "changed": F.col("changed")}, lexicon))

    row = ["bucket", "place"]
    rare = cut(lexicon.rare())
    traced = F.explode("rare").alias("r")
    of_own = narrow.select(*row, "first", "edges", F.col("key.x").alias("key")).join(rare, "key").select(*row, "first", "edges", traced).select(
        *row, "r.term", F.lit(True).alias("own"), ((F.col("r.place") < F.col("first")) & ~F.array_contains("edges", F.col("r.term"))).alias("changed"))
    of_next = narrow.select(*row, "second", "edges", F.col("next_key.x").alias("key")).join(rare, "key").select(*row, "second", "edges", traced).select(
        *row, "r.term", F.lit(False).alias("own"), ((F.col("r.place") < F.col("second")) & ~F.array_contains("edges", F.col("r.term"))).alias("changed"))
    at_edges = narrow.select(*row, F.explode("inside").alias("term")).where(lexicon.level("term") == 0)
    known = lexicon.counted.where(F.col("n") >= lexicon.least).select("term")
    unknown = at_edges.join(known, "term", "left_anti").select(*row, "term", F.lit(False).alias("own"), F.lit(True).alias("changed"))
    each = of_own.union(of_next).union(unknown).groupBy(*row, "term").agg(F.max("own").alias("own"), F.max("changed").alias("changed"))
    removed = each.groupBy(*row).agg(
        F.collect_list(F.when(F.col("own"), F.col("term"))).alias("own_rare"), F.collect_list(F.when(F.col("changed"), F.col("term"))).alias("changed_rare"))
    found = cut(narrow.join(removed, row, "left").select(
        "id", "n_chars", "edited_sha256", "key", "next_key",
        without(F.col("own"), F.col("own_rare")).alias("own"), without(F.col("changed"), F.col("changed_rare")).alias("changed")))

    states_of = found.groupBy(F.col("key").alias("next_key")).agg(F.first("own").alias("next"))
    out = join_spread(found, states_of, "next_key", "id")
    return out.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", written(F.col("own")).alias("fingerprint"),
        written(F.col("changed")).alias("edited_fingerprint"),
        state_likeness(F.col("own"), F.col("changed")).alias("near_edited"), state_likeness(F.col("own"), F.col("next")).alias("near_next"))
