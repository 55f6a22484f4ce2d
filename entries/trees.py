"""Queries of forests as node tables."""

from pyspark.sql import functions as F

from remarklab.operators import trees as R

from .common import COMMENTS, comments, query

# A forest of three trees over length, words, capital letters, digits and question marks of a text.
NODES = [
    (0, 0, 0, 900.0, 1, 2, None), (0, 1, 3, 1.0, 3, 4, None), (0, 2, 1, 400.0, 5, 6, None), (0, 3, None, None, None, None, [0.7, 0.2, 0.1]),
    (0, 4, None, None, None, None, [0.1, 0.8, 0.1]), (0, 5, None, None, None, None, [0.3, 0.3, 0.4]), (0, 6, None, None, None, None, [0.0, 0.25, 0.75]),
    (1, 0, 2, 12.0, 1, 2, None), (1, 1, None, None, None, None, [0.6, 0.3, 0.1]), (1, 2, 0, 2500.0, 3, 4, None),
    (1, 3, 4, 0.0, 5, 6, None), (1, 4, None, None, None, None, [0.05, 0.15, 0.8]), (1, 5, None, None, None, None, [0.2, 0.7, 0.1]),
    (1, 6, None, None, None, None, [0.5, 0.25, 0.25]), (2, 0, None, None, None, None, [0.34, 0.36, 0.3]),
]
FEATURES = ("CAST(length(body) AS DOUBLE)", "CAST(length(body) - length(replace(body, ' ', '')) + 1 AS DOUBLE)")


def counted(sql_class: str) -> str:
    return f"CAST(length(body) - length(regexp_replace(body, '{sql_class}', '', 'g')) AS DOUBLE)"


def sql_nodes() -> str:
    def cell(v):
        return "NULL" if v is None else f"{v!r}::DOUBLE[]" if isinstance(v, list) else str(v)

    return ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in NODES)


@query("forest_predictions", lambda: f"""WITH RECURSIVE {COMMENTS},
nodes(tree, node, feature, threshold, l, r, shares) AS (VALUES {sql_nodes()}),
given AS (SELECT id, [{FEATURES[0]}, {FEATURES[1]}, {counted("[A-Z]")}, {counted("[0-9]")}, {counted("[?]")}] AS x FROM comments WHERE body IS NOT NULL),
walk AS (
  SELECT id, x, tree, 0 AS node FROM given CROSS JOIN (SELECT DISTINCT tree FROM nodes)
  UNION ALL
  SELECT w.id, w.x, w.tree, CASE WHEN w.x[n.feature + 1] <= n.threshold THEN n.l ELSE n.r END FROM walk w JOIN nodes n USING (tree, node) WHERE n.l IS NOT NULL),
votes AS (SELECT id, n.shares FROM walk JOIN nodes n USING (tree, node) WHERE n.l IS NULL),
means AS (SELECT id, sum(shares[1]) / 3 AS a, sum(shares[2]) / 3 AS b, sum(shares[3]) / 3 AS c FROM votes GROUP BY 1)
SELECT id, round(a, 6) AS p0, round(b, 6) AS p1, round(c, 6) AS p2, CASE WHEN round(a, 9) >= round(greatest(b, c), 9) THEN 0.0 WHEN round(b, 9) >= round(c, 9) THEN 1.0 ELSE 2.0 END::DOUBLE AS prediction FROM means""")
def forest_predictions(spark, sf):
    nodes = spark.createDataFrame(NODES, R.SCHEMA)
    body = F.col("body")

    def left(pattern):
        return (F.length(body) - F.length(F.regexp_replace(body, pattern, ""))).cast("double")

    rows = comments(spark, sf).filter(body.isNotNull()).select("id", F.array(
        F.length(body).cast("double"), (left(" ") + 1).cast("double"), left("[A-Z]"), left("[0-9]"), left("[?]")).alias("features"))
    out = R.predict_nodes(rows, nodes)
    return out.select("id", *[F.round(F.col("probability")[i], 6).alias(f"p{i}") for i in range(3)], "prediction")
