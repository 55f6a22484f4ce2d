"""Forests as a relation: a node table, and its evaluation inside the row.

A node table has a row per node: tree, node (0 is the root), feature, threshold, left, right and, at leaves
(``left`` is NULL), the share of each class. Rows go left where the feature is at most the threshold. The table
becomes a constant of the plan; each tree is followed by as many steps as it is deep, so a row meets no join and no model.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import bind

# nodes that a plan may carry as a constant
MAX_NODES = 200_000
SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, shares array<double>"
NODE = "struct<f:int,t:double,l:int,r:int,s:array<double>>"


def forest_nodes(model, spark: SparkSession) -> DataFrame:
    """The node table of a fitted random forest or decision tree classifier of the library."""
    trees = getattr(model, "trees", [model])
    rows: list[tuple] = []

    def walk(tree: int, node, number: list[int]) -> int:
        own = number[0]
        number[0] += 1
        at = len(rows)
        rows.append(())
        if node.subtreeDepth() == 0:
            stats = list(node.impurityStats().stats())
            total = sum(stats)
            rows[at] = (tree, own, None, None, None, None, [x / total if total else 0.0 for x in stats])
        else:
            split = node.split()
            if split.getClass().getSimpleName() != "ContinuousSplit":
                raise ValueError("only splits at a threshold can be written")
            left, right = walk(tree, node.leftChild(), number), walk(tree, node.rightChild(), number)
            rows[at] = (tree, own, split.featureIndex(), split.threshold(), left, right, None)
        return own

    for i, tree in enumerate(trees):
        walk(i, tree._java_obj.rootNode(), [0])
    return spark.createDataFrame(rows, SCHEMA)


def _read(nodes: DataFrame) -> tuple[list[list], int]:
    """The trees as lists of nodes by number, and the depth of the deepest."""
    rows = nodes.limit(MAX_NODES + 1).collect()
    if len(rows) > MAX_NODES:
        raise ValueError(f"more than {MAX_NODES} nodes")
    trees: dict[int, dict] = {}
    for r in rows:
        trees.setdefault(r["tree"], {})[r["node"]] = r
    out, deepest = [], 0
    for tree in sorted(trees):
        own = trees[tree]
        if sorted(own) != list(range(len(own))):
            raise ValueError(f"nodes of tree {tree} are not numbered from 0")
        depth, level = 0, [0]
        while below := [child for n in level if own[n]["left"] is not None for child in (own[n]["left"], own[n]["right"])]:
            depth, level = depth + 1, below
            if depth > len(own):
                raise ValueError(f"tree {tree} has a circle")
        deepest = max(deepest, depth)
        out.append([{"f": own[n]["feature"], "t": own[n]["threshold"], "l": own[n]["left"], "r": own[n]["right"], "s": own[n]["shares"]} for n in range(len(own))])
    return out, deepest


def class_shares(nodes: DataFrame, features: Column) -> Column:
    """Mean class shares of the leaves that a row reaches, from its array of feature values; a NULL value goes right."""
    trees, depth = _read(nodes)
    constant = F.from_json(F.lit(json.dumps(trees)), f"array<array<{NODE}>>")

    def leaf(tree: Column, values: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            return bind(F.get(tree, at), lambda n: F.when(n["l"].isNull(), at).when(
                F.coalesce(F.get(values, n["f"]) <= n["t"], F.lit(False)), n["l"]).otherwise(n["r"]))

        return F.get(tree, F.aggregate(F.sequence(F.lit(1), F.lit(max(depth, 1))), F.lit(0), step))["s"]

    def mean(votes: Column) -> Column:
        return F.transform(F.get(votes, F.lit(0)), lambda _, i: F.aggregate(votes, F.lit(0.0), lambda a, v: a + F.get(v, i)) / len(trees))

    return bind(features, lambda values: bind(F.transform(constant, lambda tree: leaf(tree, values)), mean))


def predict_nodes(df: DataFrame, nodes: DataFrame, features: str = "features", prediction: str = "prediction", shares: str = "probability") -> DataFrame:
    """Add the class shares of a node table and the class of the largest; of equal ones the first."""
    scored = df.withColumn(shares, class_shares(nodes, F.col(f"`{features}`")))
    return scored.withColumn(prediction, (F.array_position(shares, F.array_max(shares)) - 1).cast("double"))
