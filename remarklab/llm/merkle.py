"""Merkle manifest of a dataset: a digest tree over its rows, with the proof of every row.

Rows of a group (here: a language) are the leaves of a subtree, in order of an id; every ``FANOUT``
consecutive nodes become a parent while there are several. The roots of the groups, in order of the
groups, are the leaves of the top tree in the same way.

Positions come from a range partitioning with offsets per partition. A block of aligned leaves makes its
lower subtree by itself. The rest is a butterfly: round by round, blocks whose numbers differ in one
base-``FANOUT`` digit only swap the roots they have so far, so each block of such a group hashes the same
parent and keeps its siblings. After the last round every block holds the root and the upper part of
the proof of all its leaves; nothing is passed down again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from remarklab.llm.common import cut, ship_package, small_batches

# children of a node; levels of the tree that a block makes by itself, so it has FANOUT ** LEVELS leaves
FANOUT, LEVELS = 8, 3
DIGEST = 64
PROOF = "array<struct<place:int,siblings:string>>"


def field(value: Column, null: str = "-") -> Column:
    """A value with its length in bytes in front, so that no two rows are written alike; ``-`` for NULL."""
    written = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(written).cast("string"), F.lit(":"), written), F.lit(null))


def leaf(*values: Column) -> Column:
    """Digest of a row: SHA-256 over its written values, as lowercase hex."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    # a text of one byte a character has no other letters, and lower() is several times faster
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def fold(digest: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to.

    Each level's siblings are written one after the other; the node goes in at its place.
    """
    return F.aggregate(proof, digest, lambda node, level: F.sha2(F.concat(
        F.substring(level["siblings"], F.lit(1), level["place"] * DIGEST), node,
        F.substring(level["siblings"], level["place"] * DIGEST + 1, F.length(level["siblings"]))), 256))


def digest(proof: Column) -> Column:
    """SHA-256 over all siblings of a proof, from the leaf's level up."""
    return F.sha2(F.array_join(F.transform(proof, lambda level: level["siblings"]), ""), 256)


def _parent(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def lower_tree(leaves: list[str], whole: bool, height: int) -> list[list[str]]:
    """The levels over a block's leaves, up to its root, which is at ``height`` in a block that is one of several."""
    levels = [leaves]
    while len(levels[-1]) > 1 if whole else len(levels) <= height:
        nodes = levels[-1]
        levels.append([_parent(nodes[i:i + FANOUT]) for i in range(0, len(nodes), FANOUT)])
    return levels


def lower_proofs(levels: list[list[str]]) -> Iterator[list[dict]]:
    """The proof of every leaf of a block, up to the block's root."""
    # for each level, the places and siblings of its nodes, each written once
    steps = []
    for nodes in levels[:-1]:
        steps.append([{"place": i % FANOUT, "siblings": "".join(
            nodes[i - i % FANOUT:i] + nodes[i + 1:i - i % FANOUT + FANOUT])} for i in range(len(nodes))])
    for i in range(len(levels[0])):
        proof = []
        for step in steps:
            proof.append(step[i])
            i //= FANOUT
        yield proof


def _sorted_leaves(rows: pa.ListArray, i: int) -> pa.StructArray:
    """The leaves of block ``i`` in order of their positions."""
    leaves = rows.slice(i, 1).flatten()
    return leaves.take(pc.sort_indices(pc.struct_field(leaves, "position")))


def block_roots(stored: DataFrame, levels: int) -> DataFrame:
    """(group, block, n_blocks, root) of stored blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots = []
            for i, n in enumerate(batch.column("n_blocks").to_pylist()):
                leaves = pc.struct_field(_sorted_leaves(batch.column("rows"), i), "leaf").to_pylist()
                roots.append(lower_tree(leaves, n == 1, levels)[-1][0])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("group", "block", "n_blocks")), pa.array(roots, pa.string())], names=["group", "block", "n_blocks", "root"])

    return stored.mapInArrow(run, "group string, block bigint, n_blocks bigint, root string")


def block_proofs(stored: DataFrame, upper: DataFrame, levels: int) -> DataFrame:
    """A row per leaf: its kept columns, and its lower proof with its block's upper one behind it."""
    kind = pa.list_(pa.struct([("place", pa.int32()), ("siblings", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.select(["n_blocks", "upper", "subroot", "root"]).to_pylist()
            for i, block in enumerate(known):
                rows = _sorted_leaves(batch.column("rows"), i)
                leaves = pc.struct_field(rows, "leaf")
                proofs = [p + block["upper"] for p in lower_proofs(lower_tree(leaves.to_pylist(), block["n_blocks"] == 1, levels))]
                same = [pa.array([block[c]] * len(rows), pa.string()) for c in ("subroot", "root")]
                yield pa.RecordBatch.from_arrays(
                    [pc.struct_field(rows, "kept"), leaves, *same, pa.array(proofs, kind)], names=["kept", "leaf", "subroot", "root", "proof"])

    kept = stored.schema["rows"].dataType.elementType["kept"].dataType.simpleString()
    return stored.join(upper, ["group", "block"]).mapInArrow(
        run, f"kept {kept}, leaf string, subroot string, root string, proof {PROOF}")


def positions(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``position``, the rank of a row in its ``group`` by ``order``, from 0, and the group's ``size``.

    ``rows`` must be stored. They are range-partitioned, so a group of any size is spread; per partition
    and group only a count goes further.
    """
    serial = F.monotonically_increasing_id()
    keys = ["group", *order]
    placed = cut(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__serial", serial))
    part = F.shiftright(F.col("__serial"), 33)
    counts = placed.groupBy("group", part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"), F.min("__serial").alias("__least"))
    # a row per partition of the data in a window
    over = Window.partitionBy("group")
    before = over.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "group", "__part", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__least")).alias("__offset"),
        F.sum("__n").over(over).alias("size"))
    return placed.withColumn("__part", part).join(offsets, ["group", "__part"]).withColumn(
        "position", F.col("__serial") + F.col("__offset")).drop("__part", "__offset", "__serial")


def blocks(placed: DataFrame, levels: int) -> DataFrame:
    """(group, block, n_blocks, rows): aligned positions with their digests and kept columns, in any order."""
    length = FANOUT ** levels
    return placed.groupBy("group", F.expr(f"position div {length}").alias("block")).agg(
        F.first(F.expr(f"(size + {length - 1}) div {length}")).alias("n_blocks"),
        F.collect_list(F.struct("position", "leaf", "kept")).alias("rows"))


def butterfly(roots: DataFrame) -> DataFrame:
    """Add ``upper``, the siblings of a block's subtree level by level, and make ``root`` the group's.

    Round r swaps between blocks that differ in digit r only: a block asks for the nodes of its group of
    ``FANOUT``, each from the block that has its own lower digits there (in a shorter last subtree, those
    modulo its length). All blocks of a group hash the parent; a group of blocks that is done keeps its root.
    """
    state = roots.withColumn("upper", F.array().cast(PROOF))
    most = state.agg(F.max("n_blocks")).first()[0] or 0
    span = 1  # blocks under a node of this round
    while span < most:
        state = cut(state)
        first = F.expr(f"(block div {span * FANOUT}) * {FANOUT}")
        last = F.least(first + FANOUT - 1, F.expr(f"(n_blocks - 1) div {span}"))
        ask = state.where(F.col("n_blocks") > span).select(
            "group", "n_blocks", F.col("block").alias("asks"), F.explode(F.sequence(first, last)).alias("node"))
        length = F.least(F.lit(span).cast("bigint"), F.col("n_blocks") - F.col("node") * span)
        source = F.col("node") * span + (F.col("asks") % span) % length
        answer = ask.select("group", "asks", "node", source.alias("block")).join(state.select("group", "block", "root"), ["group", "block"])
        run = answer.groupBy("group", "asks").agg(F.array_sort(F.collect_list(F.struct("node", "root"))).alias("run"))
        joined = state.join(run.withColumnRenamed("asks", "block"), ["group", "block"], "left")
        own = F.expr(f"block div {span}")
        level = F.struct(
            (own % FANOUT).cast("int").alias("place"),
            F.array_join(F.transform(F.filter("run", lambda x: x["node"] != own), lambda x: x["root"]), "").alias("siblings"))
        done = F.col("run").isNull()
        state = joined.select(
            "group", "block", "n_blocks",
            F.when(done, F.col("root")).otherwise(F.sha2(F.array_join(F.transform("run", lambda x: x["root"]), ""), 256)).alias("root"),
            F.when(done, F.col("upper")).otherwise(F.concat("upper", F.array(level))).alias("upper"))
        span *= FANOUT
    return state


def manifest(df: DataFrame, group: str, order: str, digests: str, keep: list[str] | None = None, levels: int = LEVELS) -> DataFrame:
    """Add ``leaf``, ``subroot``, ``root`` and ``proof`` to every row.

    The column ``digests`` has the leaves' digests (see ``leaf``) and becomes ``leaf``. ``proof`` lists,
    from the leaf's level over the group's root to the dataset's, the siblings of the row's node
    (lowercase hex, one after the other) and the place of the node among them; ``fold`` leads from a leaf
    to the root. Groups are ordered as UTF-8 bytes, the NULL group first; in a group a NULL id comes
    first, and equal ids go by their digest. Repeated rows are leaves of their own, each with its proof.
    Other columns of any name stay as they are; those named like the new ones give way to them. An empty
    table gives an empty one. The input is read once, so texts are only read where the digests are made.
    """
    ship_package(df.sparkSession)
    small_batches(df.sparkSession)
    new = {"leaf", "subroot", "root", "proof"}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new and c != digests]
    key = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("-"))
    # a struct of numbered fields keeps columns of any name out of the way
    rows = df.select(
        key.alias("group"), F.col(f"`{order}`").alias("order"), F.col(f"`{digests}`").alias("leaf"),
        F.struct(F.lit(None).cast("int").alias("none"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]).alias("kept"),
        F.monotonically_increasing_id().alias("tie"))
    # stored before it is range-partitioned, for the partitioning reads it twice; ties can then be split, too
    stored = cut(blocks(positions(cut(rows), ["order", "leaf", "tie"]), levels))
    states = cut(butterfly(cut(block_roots(stored, levels))))
    # the roots of the groups are the leaves of the top tree
    groups = cut(states.where("block = 0").select(
        F.lit("").alias("group"), F.col("group").alias("of"), F.col("root").alias("leaf"), F.struct(F.col("group").alias("of")).alias("kept")))
    top = cut(blocks(positions(groups, ["of"]), levels))
    top_states = butterfly(cut(block_roots(top, levels))).withColumn("subroot", F.col("root")).drop("n_blocks")
    roots = block_proofs(top, top_states, levels).select(
        F.col("kept.of").alias("group"), F.col("leaf").alias("subroot"), "root", F.col("proof").alias("top"))
    upper = states.drop("root", "n_blocks").join(roots, "group").withColumn("upper", F.concat("upper", "top")).drop("top")
    return block_proofs(stored, upper, levels).select(
        *[F.col(f"kept.c{i}").alias(c) for i, c in enumerate(kept)], "leaf", "subroot", "root", "proof")
