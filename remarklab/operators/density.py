"""The numbers behind histograms, box plots and density curves."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scores import safe_divide
from ..schema import c
from ..session import cache_stage


def histogram(
    df: DataFrame, col: str, bins: int = 50, lo: float | None = None, hi: float | None = None,
    by: str | None = None, digits: int = 6,
) -> DataFrame:
    """Equal-width bins with counts and densities; the last bin includes its upper edge.

    Bounds default to the minimum and maximum of the column, of each group with ``by``. Empty bins
    are listed too.
    """
    value = c(col).cast("double")
    group = [c(by).alias("__by")] if by else []
    names = ["__by"] if by else []
    values = df.select(*group, value.alias("__v"))
    if lo is None or hi is None:
        # one aggregate for both bounds
        found = values.groupBy(*names).agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
        values = _attach(values, found, by)
    for name, bound in (("__lo", lo), ("__hi", hi)):
        if bound is not None:
            values = values.withColumn(name, F.lit(float(bound)))
    bounded = (
        values.withColumn("__w", (F.col("__hi") - F.col("__lo")) / bins)
        .filter((F.col("__v") >= F.col("__lo")) & (F.col("__v") <= F.col("__hi")))
    )
    slot = F.when(
        F.col("__w") > 0, F.least(F.floor((F.col("__v") - F.col("__lo")) / F.col("__w")), F.lit(bins - 1))
    ).otherwise(F.lit(0))
    counts = bounded.groupBy(*names, slot.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.first("__lo").alias("lo"), F.first("__w").alias("w")
    )
    # one row per group: a fixed-length array of the counts of its bins
    packed = counts.groupBy(*names).agg(
        F.first("lo").alias("lo"),
        F.first("w").alias("w"),
        F.sum("n").alias("total"),
        *[F.sum(F.when(F.col("bin") == i, F.col("n"))).alias(f"__b{i}") for i in range(bins)],
    )
    cells = F.array(*[F.coalesce(F.col(f"__b{i}"), F.lit(0).cast("bigint")) for i in range(bins)])
    out = packed.select(*names, "lo", "w", "total", F.posexplode(cells).alias("bin", "n"))
    return out.select(
        *([F.col("__by").alias(by)] if by else []),
        "bin",
        F.round(F.col("lo") + F.col("bin") * F.col("w"), digits).alias("bin_start"),
        "n",
        F.round(safe_divide(F.col("n"), F.col("total") * F.col("w")), digits).alias("density"),
    )


# Percentile sketches answer within total / SKETCH_ACCURACY ranks.
SKETCH_ACCURACY = 10_000


# so many distinct values of a bracket one task may rank
RANKED_VALUES = 1_000_000
# parts into which a bracket with more of them is cut, once or more
PARTS = 100


def _attach(df: DataFrame, per_group: DataFrame, by: str | None) -> DataFrame:
    """Add the columns of a one-row-per-group frame; of a single row where there is no grouping.

    The join has no hint: the planner broadcasts the groups' rows if they are small enough.
    """
    if by:
        return df.join(per_group, "__by")
    names = [x for x in per_group.columns if x != "__by"]
    row = per_group.select(F.struct(*names).alias("x")).scalar()
    return df.withColumn("__one", row).select(*df.columns, *[F.col("__one")[x].alias(x) for x in names])


def _inside(base: DataFrame, brackets: DataFrame, by: str | None) -> DataFrame:
    """(group, v, b): every value with each bracket ``b`` of its group that it doesn't lie above."""
    return _attach(base, brackets, by).select("__by", "v", F.explode(F.filter("br", lambda b: F.col("v") <= b["hi"])).alias("b"))


def _refine(base: DataFrame, brackets: DataFrame, by: str | None, most: int) -> DataFrame:
    """Brackets with at most about ``most`` distinct values.

    A bracket with more is cut at the quantiles of a sketch of the values between its ends, and the parts
    next to the wanted position stay: each round leaves a few hundredths of the rows in between, whatever ties there are
    at the ends. What lies below is counted anew each time, so the result stays exact. A round is one pass over
    the values; of each bracket only counts and the sketch are gathered.
    """
    most = max(most, 10 * PARTS)  # parts of ten rows at least, so that the positions around a cut are kept
    lo, hi = F.col("b.lo"), F.col("b.hi")
    between = F.when((F.col("v") > lo) & (F.col("v") < hi), F.col("v"))
    while True:
        stats = cache_stage(_inside(base, brackets, by).groupBy("__by", "b").agg(
            F.count_if(F.col("v") <= lo).alias("below"), F.count(between).alias("n"), F.approx_count_distinct(between).alias("values"),
            F.percentile_approx(between, [i / PARTS for i in range(PARTS + 1)], SKETCH_ACCURACY).alias("q")), durable=True)
        if (stats.agg(F.max("values")).first()[0] or 0) <= most:
            return brackets
        place = F.floor((F.col("b.pos") - F.col("below")) / F.greatest(F.col("n") - 1, F.lit(1)) * PARTS).cast("int")
        large = F.col("values") > most
        left = F.when(large & (place >= 1), F.get("q", F.least(place - 1, F.lit(PARTS)))).otherwise(lo)
        right = F.when(large & (place + 2 <= PARTS), F.get("q", F.greatest(place + 2, F.lit(0)))).otherwise(hi)
        brackets = stats.groupBy("__by").agg(
            F.collect_list(F.struct(F.col("b.p").alias("p"), F.col("b.pos").alias("pos"), left.alias("lo"), right.alias("hi"))).alias("br"))


def exact_quantiles(
    df: DataFrame, col: str, probabilities: list[float], by: str | None = None, most: int = RANKED_VALUES,
) -> DataFrame:
    """Linearly interpolated quantiles, exact, in long form (by, p, value).

    The exact ``percentile`` aggregate keeps every distinct value of a group in one task. Here a
    bounded sketch first brackets each quantile, everything below a bracket is only counted, and
    just the values inside it (a few ten-thousandths of a large group, counted per distinct
    value) are shuffled and ranked. Where a bracket may still hold more than ``most`` distinct values it is
    refined first, so no task ranks more than about that.
    """
    name = "__by"
    base = df.select((c(by) if by else F.lit(0)).alias(name), c(col).cast("double").alias("v")).filter(
        F.col("v").isNotNull()
    )
    margin = 4.0 / SKETCH_ACCURACY
    lows = [max(p - margin, 0.0) for p in probabilities]
    highs = [min(p + margin, 1.0) for p in probabilities]
    bounds = base.groupBy(name).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("v").alias("min_v"),
        F.max("v").alias("max_v"),
        F.percentile_approx("v", [*lows, *highs], SKETCH_ACCURACY).alias("q"),
    )
    # a row per group
    bounds = cache_stage(bounds, durable=True)
    largest = bounds.agg(F.max("n")).first()[0] or 0
    k = len(probabilities)
    small = F.col("n") <= SKETCH_ACCURACY
    brackets = bounds.select(
        F.col(name),
        F.array(
            *[
                F.struct(
                    F.lit(float(p)).alias("p"),
                    (F.lit(float(p)) * (F.col("n") - 1)).alias("pos"),
                    F.when(small, F.col("min_v")).otherwise(F.col("q")[i]).alias("lo"),
                    F.when(small, F.col("max_v")).otherwise(F.col("q")[k + i]).alias("hi"),
                )
                for i, p in enumerate(probabilities)
            ]
        ).alias("br"),
    )
    # twice the margin and the sketch's own error, on both sides
    if largest > SKETCH_ACCURACY and largest * (2 * margin + 2 / SKETCH_ACCURACY) > most:
        brackets = _refine(base, brackets, by, most)
    placed = _inside(base, brackets, by)
    inside = F.col("v") >= F.col("b.lo")
    # each task counts the values below a bracket in one row, and those inside in one row per value
    ranked = (
        placed.groupBy(name, "b", F.when(inside, F.col("v")).alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn(
            "upto",
            F.sum("n").over(
                Window.partitionBy(name, "b").orderBy(F.col("v").asc_nulls_first())
                .rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        )
        .filter(F.col("v").isNotNull())
    )
    at = lambda index: F.min(F.when(F.col("upto") > index, F.col("v")))
    pos = F.col("b.pos")
    out = ranked.groupBy(name, "b").agg(at(F.floor(pos)).alias("a"), at(F.ceil(pos)).alias("z"))
    value = F.col("a") + (pos - F.floor(pos)) * (F.col("z") - F.col("a"))
    return out.select(*([F.col(name).alias(by)] if by else []), F.col("b.p").alias("p"), value.alias("value"))


def box_stats(df: DataFrame, col: str, by: str | None = None, digits: int = 6, approx: bool = False) -> DataFrame:
    """Quartiles, extremes and 1.5 x IQR whiskers, overall or per group."""
    name = "__by"
    base = df.select((c(by) if by else F.lit(0)).alias(name), c(col).cast("double").alias("v")).filter(
        F.col("v").isNotNull()
    )
    if approx:
        q = base.groupBy(name).agg(
            *[F.percentile_approx("v", p, SKETCH_ACCURACY).alias(a)
              for a, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))]
        )
    else:
        long = exact_quantiles(base, "v", [0.25, 0.5, 0.75], name if by else None)
        q = (long if by else long.withColumn(name, F.lit(0))).groupBy(name).agg(
            *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(a)
              for a, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))]
        )
    fences = q.withColumn("lo", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).withColumn(
        "hi", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    )
    whiskers = (
        _attach(base, fences, by)
        .groupBy(name)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("v").alias("min"),
            F.first("q1").alias("q1"),
            F.first("median").alias("median"),
            F.first("q3").alias("q3"),
            F.max("v").alias("max"),
            F.min(F.when(F.col("v") >= F.col("lo"), F.col("v"))).alias("whisker_low"),
            F.max(F.when(F.col("v") <= F.col("hi"), F.col("v"))).alias("whisker_high"),
        )
    )
    rounded = [F.round(F.col(x), digits).alias(x) for x in
               ("min", "q1", "median", "q3", "max", "whisker_low", "whisker_high")]
    return whiskers.select(*([F.col(name).alias(by)] if by else []), "n", *rounded)


def score_density(
    df: DataFrame, col: str, grid: list[float], digits: int = 6
) -> DataFrame:
    """Gaussian kernel density on a grid, Scott's bandwidth.

    One sum per grid point over the rows: no score meets the grid in a join, and only each task's
    partial sums are shuffled. Summing rounded kernel values keeps the result independent of the
    order of addition.
    """
    base = df.select(c(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
    stats = base.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("v").alias("s"))
    width = stats.select(F.round(F.col("s") * F.pow(F.col("n").cast("double"), F.lit(-0.2)), 12)).scalar()
    total = stats.select(F.col("n")).scalar()

    def kernel(x: float) -> Column:
        z = (F.lit(float(x)) - F.col("v")) / F.col("h")
        return F.round(F.exp(-0.5 * z * z), 10)

    sums = base.withColumn("h", width).agg(
        F.first("h").alias("h"), *[F.sum(kernel(x)).alias(f"__g{i}") for i, x in enumerate(grid)]
    )
    points = F.array(
        *[F.struct(F.lit(float(x)).alias("x"), F.col(f"__g{i}").alias("s")) for i, x in enumerate(grid)]
    )
    return (
        sums.withColumn("total", total)
        .select("h", "total", F.explode(points).alias("p"))
        .select(
            F.col("p.x").alias("x"),
            F.round(F.col("p.s") / (F.col("total") * F.col("h") * math.sqrt(2 * math.pi)), digits).alias("density"),
        )
    )
