"""SimHash near-duplicates: fingerprints, multi-index hashing of them, connected components.

A fingerprint of 64 bits is cut into ``distance // 2 + 1`` segments, so two fingerprints within the
distance differ by at most one bit in one of them. Every fingerprint is stored once per segment; to
search, the Hamming ball of radius one around each segment is enumerated and its keys are looked up by
an equi-join. Of two segments that differ by one bit one has a 0 there; only that one flips it, so
each neighbour is met once. The whole distance is verified in the join.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from remarklab.llm.common import append_columns, cut, free_name, join_spread
from remarklab.llm.components import connected_components

# shingle hashes whose bits are counted at once
CHUNK = 1 << 16


def simhash(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Fingerprint as a signed 64-bit integer; 0 for a text without words.

    Words are runs without ASCII white space, A-Z in lower case; shingles are ``shingle`` words joined
    by spaces, repeats included, or all words if there are fewer. A bit is 1 if it is set in over half
    of the shingles' hashes.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:n - 1].tolist()]
    stops = (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        hashes = [digest(line[a:b], seed) for a, b in zip(starts[at:at + CHUNK], stops[at:at + CHUNK])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprint_documents(df: DataFrame, text: str = "text", shingle: int = 3, keep: list[str] | None = None) -> DataFrame:
    """Add ``fingerprint`` (bigint, the 64 bits as a signed number) to every row; NULL texts count as empty."""
    return append_columns(df, text, "fingerprint bigint",
                          lambda: lambda texts: [[simhash(t, shingle) for t in texts]], keep)


def fingerprint_links(fingerprints: DataFrame, distance: int = 3, column: str = "fingerprint") -> DataFrame:
    """Pairs (u, v) of the distinct values of ``column`` that differ by 1 to ``distance`` bits.

    A pair may come more than once. ``fingerprints`` must hold distinct values, which is what bounds a
    bucket: copies of a text are one row here however many there are.
    """
    segments = distance // 2 + 1
    edges = [64 * i // segments for i in range(segments + 1)]
    value = F.col(f"`{column}`")
    keys, probes = [], []

    def ball(i: int, segment, masks):
        return F.transform(F.filter(masks, lambda m: segment.bitwiseAND(m) == 0), lambda m: F.struct(
            F.lit(i).cast("tinyint").alias("segment"), segment.bitwiseXOR(m).alias("key"), (m == 0).alias("same")))

    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        ones = (1 << (high - low)) - 1
        mask = F.lit(ones if high - low < 64 else -1).cast("bigint")
        segment = F.shiftrightunsigned(value, low).bitwiseAND(mask)
        keys.append(F.struct(F.lit(i).cast("tinyint").alias("segment"), segment.alias("key")))
        flips = [1 << j if j < 63 else -(1 << 63) for j in range(high - low)] if distance else []
        masks = F.array(*[F.lit(m).cast("bigint") for m in [0, *flips]])
        probes.append(ball(i, segment, masks))
    table = fingerprints.select(value.alias("v"), F.explode(F.array(*keys)).alias("k")).select("v", "k.*")
    search = fingerprints.select(value.alias("u"), F.explode(F.flatten(F.array(*probes))).alias("k")).select("u", "k.*")
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))).between(1, distance)
    return (search.join(table, ["segment", "key"])
            .where(near & (~F.col("same") | (F.col("u") < F.col("v")))).select("u", "v"))


def _classes(rows: DataFrame, least: str, distance: int) -> DataFrame:
    """From rows (fingerprint, ``least``): rows (fingerprint, component, smallest).

    ``smallest`` is the smallest value of ``least`` in the component, which is named by its smallest
    fingerprint.
    """
    values = cut(rows.groupBy("fingerprint").agg(F.min(least).alias("own")))
    labels = connected_components(fingerprint_links(values.select("fingerprint"), distance))
    # only fingerprints with links need a common smallest value
    linked = values.join(labels.withColumnRenamed("node", "fingerprint"), "fingerprint")
    smallest = linked.groupBy("component").agg(F.min("own").alias("smallest"))
    members = linked.select("fingerprint", "component").join(smallest, "component")
    single = values.join(members, "fingerprint", "left")
    return single.select("fingerprint", F.coalesce("component", "fingerprint").alias("component"),
                         F.coalesce("smallest", "own").alias("smallest"))


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3,
) -> DataFrame:
    """Rows (``id_col``, fingerprint, component_id), one per row of ``df``.

    Fingerprints link at ``distance`` or fewer differing bits; ``component_id`` is the smallest id that
    links reach, the row's own included (NULL only where all ids of a component are). Texts without
    words have fingerprint zero and link like any other; repeated rows stay; an empty table gives an
    empty one. Texts are read once; only ids and fingerprints are shuffled.
    """
    rows = cut(fingerprint_documents(df, text, shingle, keep=[id_col]).select(F.col(f"`{id_col}`").alias("id"), "fingerprint"))
    classes = _classes(rows, "id", distance).select("fingerprint", F.col("smallest").alias("component_id"))
    return join_spread(rows, classes, "fingerprint", "id").select(F.col("id").alias(id_col), "fingerprint", "component_id")


def keep_one(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3,
) -> DataFrame:
    """The rows of ``df``, one of each near-duplicate component: that of the smallest id.

    NULL ids come last; rows of equal id are ordered by a hash of all their columns, and of rows that
    agree in all columns one stays. An empty table gives an empty one. Texts move once, to meet the
    keys of the rows that stay; components are found on ids and fingerprints alone.
    """
    key = F.struct(F.col(f"`{id_col}`").isNull().alias("none"), F.col(f"`{id_col}`").alias("id"),
                   F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    name = free_name(df.columns, "__key")
    keyed = df.withColumn(name, key)
    rows = cut(fingerprint_documents(keyed, text, shingle, keep=[name]).withColumnRenamed(name, "key"))
    components = _classes(rows, "key", distance)
    winners = components.groupBy("component").agg(F.min("smallest").alias("k"))
    times = rows.groupBy(F.col("key").alias("k")).agg(F.count("*").alias("times"))
    chosen = cut(winners.select("k").join(times, "k"))
    own = [F.col(f"`{c}`") for c in df.columns]

    def rows_of(keys: DataFrame) -> DataFrame:
        given, kept = F.col(f"`{name}`"), keys["k"]
        same = (given["none"] == kept["none"]) & given["id"].eqNullSafe(kept["id"]) & (given["row"] == kept["row"])
        return keyed.join(keys, same, "left_semi").select(*own)

    return rows_of(chosen.where("times = 1")).union(rows_of(chosen.where("times > 1")).dropDuplicates())
