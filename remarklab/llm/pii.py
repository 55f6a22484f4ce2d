"""Personal data: fixed patterns, and candidates that boosted trees accept. DataFrame functions only.

Patterns of four base kinds with their checks are always found. Beside them, generators of high recall
propose spans that may overlap. Features of a candidate's format and context go through gradient-boosted
trees, trained on the candidates of all documents. A candidate that overlaps a checked base span is
private, and so is the same contact written without the marks that the base patterns go by (a phone without
``+`` or country code, an address with ``(at)`` and ``(dot)``), in the same place. Candidates that may
be such contacts themselves, by a hint word in front or by their whole shape, are left out, as nobody has
labelled them; all others are not private. The trees are written out as column expressions, so scoring stays in
the row. Candidates of equal features are one weighted row. On a held-out part every generator gets the lowest score threshold at which the
precision of what it accepts, among contacts without base marks and candidates that are not private,
reaches ``PRECISION``.

Patterns are bounded or possessive, so Java's matcher neither recurses over long runs nor tries a run
again from each of its characters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from remarklab.llm.common import cut
from remarklab.llm.native import digits, luhn, matches

BASE = ("email", "ip", "card", "phone")
# Patterns of the base kinds. A match starts where a run starts or the last match ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# generators of further candidates
CONTACT, NUMBER = "contact", "number"
GENERATORS = {
    CONTACT: r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:@|[(\[][Aa][Tt][)\]]) ?[A-Za-z0-9-]{1,63}+"
             r"(?: ?(?:\.|[(\[][Dd][Oo][Tt][)\]]) ?[A-Za-z0-9-]{2,24}+){0,4}",
    NUMBER: r"(?<![0-9])\+?\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,18}(?![0-9])",
}
# what a text must hold before a pattern is tried
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]{2}|[0-9][ -][0-9]", "phone": r"\+[0-9]",
         CONTACT: r"@|[(\[][Aa][Tt][)\]]", NUMBER: r"[0-9][\x20().-]{0,2}[0-9]"}
# Words in front of personal data.
HINTS = (r"(?i)(?:tel|phone|call|mobile|fax|mail|contact|write|reach|ip|host|address|card|visa|account|iban|ssn|number|no\.?|id)"
         r"(?:[^A-Za-z0-9]{1,4}(?:me|us|him|her|them|at|on|to|is|my|our|the)){0,3}[^A-Za-z0-9]{0,4}$")
# spellings of the marks in addresses
AT, DOT = r" ?[(\[][Aa][Tt][)\]] ?", r" ?[(\[][Dd][Oo][Tt][)\]] ?"
# digits that a number without its base marks must still have
LEAST_DIGITS = 7
# the trees; every value of a feature with fewer than BINS values is a possible split
TREES, DEPTH, BINS = 12, 3, 256
PRECISION = 0.95

FEATURES = ("length", "n_digits", "n_letters", "n_separators", "n_groups", "longest_group", "plus", "at", "dots", "parentheses",
            "luhn", "same_digit", "before_letter", "before_digit", "before_mark", "after_letter", "after_digit", "after_mark", "hint",
            "generator")


def _removed(value: Column, kept: str) -> Column:
    return F.length(F.regexp_replace(value, f"[^{kept}]", ""))


def features(m: Column, generator: int) -> Column:
    """The features of a candidate as a struct of doubles in the order of ``FEATURES``."""
    value = m["value"]
    own = digits(value)
    groups = F.filter(F.split(value, "[^0-9]+"), lambda g: g != "")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    last, first = F.substring(m["before"], -1, 1), F.substring(m["after"], 1, 1)
    exprs = (
        F.length(value), F.length(own), _removed(value, "A-Za-z"), _removed(value, "\\x20().-"), F.size(groups),
        F.coalesce(F.array_max(F.transform(groups, lambda g: F.length(g))), F.lit(0)), flag(value.startswith("+")),
        flag(value.contains("@")), _removed(value, "."), flag(value.contains("(")), flag(luhn(F.substring(own, 1, 32))),
        flag(own.rlike(r"^(\d)\1*$")), flag(last.rlike("[A-Za-z]")), flag(last.rlike("[0-9]")), flag(last.rlike("[^A-Za-z0-9\\s]")),
        flag(first.rlike("[A-Za-z]")), flag(first.rlike("[0-9]")), flag(first.rlike("[^A-Za-z0-9\\s]")),
        flag(m["before"].rlike(HINTS)), F.lit(float(generator)))
    return F.struct(*[e.cast("double").alias(n) for e, n in zip(exprs, FEATURES, strict=True)])


def checked(kind: str, m: Column) -> Column:
    """Whether a match of a base pattern passes its check."""
    if kind == "ip":
        return F.forall(F.split(m["value"], r"\."), lambda p: F.coalesce(p.try_cast("bigint") <= 255, F.lit(False)))
    if kind == "card":
        # only numbers of the right length are worth the sum
        return F.when(F.length(m["value"]) < 16, False).otherwise(
            F.length(digits(m["value"])).between(16, 19) & luhn(digits(m["value"])))
    if kind == "phone":
        return F.length(digits(m["value"])).between(8, 15)
    return F.lit(True)


def _found(text: Column, name: str, pattern: str) -> Column:
    return F.when(text.rlike(NEEDS[name]), matches(text, pattern))


def _spans(kind: str, found: Column) -> Column:
    return F.transform(found, lambda m: F.struct(
        F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), F.lit(1.0).alias("score")))


# in front of the names of columns in between
MARK = "__remarklab_pii_"
SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def _with_matches(df: DataFrame, text: str, base: str) -> DataFrame:
    """Add ``base`` (checked spans of the base kinds) and a column of candidates per generator."""
    column = F.col(f"`{text}`")
    out = df.withColumns({f"{MARK}{k}": _found(column, k, p) for k, p in (PATTERNS | GENERATORS).items()})
    return out.withColumn(base, F.concat(*[_checked_spans(k) for k in BASE])).drop(*[f"{MARK}{k}" for k in BASE])


def _checked_spans(kind: str) -> Column:
    good = F.filter(f"{MARK}{kind}", lambda m: checked(kind, m))
    return F.coalesce(_spans(kind, good), F.array().cast(SPANS))


def _overlaps(base: Column, m: Column) -> Column:
    return F.exists(base, lambda s: (s["start"] < m["end"]) & (m["start"] < s["end"]))


def tree_margin(model, fields: Column) -> Column:
    """The ensemble's margin as a column: nested comparisons of feature values."""

    def node(n) -> Column:
        if n.getClass().getSimpleName() == "LeafNode":
            return F.lit(float(n.prediction()))
        split = n.split()
        return F.when(fields[FEATURES[split.featureIndex()]] <= float(split.threshold()), node(n.leftChild())).otherwise(
            node(n.rightChild()))

    total = F.lit(0.0)
    for tree, weight in zip(model.trees, model.treeWeights):
        total = total + node(tree._java_obj.rootNode()) * float(weight)
    return total


class Model:
    """Trees and the score threshold of each generator; None stands for no trees."""

    def __init__(self, trees=None, thresholds: dict[str, float] | None = None):
        self.trees, self.thresholds = trees, thresholds or {}

    def score(self, fields: Column) -> Column:
        return 1.0 / (1.0 + F.exp(-2.0 * tree_margin(self.trees, fields)))


def train(df: DataFrame, text: str = "text", precision: float = PRECISION) -> Model:
    """Fit trees and thresholds on the candidates of all documents.

    All forms of a candidate are in the fitted or all in the held-out part. Candidates that share label and
    features are counted on the map side, so what is shuffled and fitted are their distinct ones. Without candidates
    of both labels there are no trees, and only base spans will be found.
    """
    rows = _with_matches(df.select(F.col(f"`{text}`").alias("t")), "t", "base")
    each = F.concat(*[F.coalesce(F.flatten(F.transform(f"{MARK}{name}", _labelled(i))), F.array().cast(_LABELLED))
                      for i, name in enumerate(GENERATORS)])
    flat = rows.select(F.explode(each).alias("c"), F.xxhash64("t").alias("h")).select("c.*", "h")
    # all forms of a candidate on one side
    fit = (F.pmod(F.xxhash64("h", "start"), F.lit(10)) < 7).alias("fit")
    by = ["label", "free", "fit", *FEATURES]
    counted = cut(flat.select("label", "free", "fields.*", fit).groupBy(*by).agg(F.count(F.lit(1)).cast("double").alias("n")))
    kinds = {r["label"] for r in counted.where("fit").select("label").distinct().collect()}
    if len(kinds) < 2:
        return Model()
    # in a fixed order, as the library looks for splits in that of the rows
    ordered = counted.where("fit").repartition("label", *FEATURES).sortWithinPartitions(*by)
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(ordered)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=BINS, seed=1, cacheNodeIds=False, weightCol="n").fit(
        assembled.select("label", "features", "n"))
    model = Model(trees)
    packed = counted.where("NOT fit AND free").select("label", "n", F.struct(*FEATURES).alias("f"))
    binned = (packed.select(F.col("f")["generator"].cast("int").alias("g"), F.floor(model.score(F.col("f")) * 100).alias("bin"), "label", "n")
              .groupBy("g", "bin").agg(F.sum(F.col("label") * F.col("n")).alias("good"), F.sum("n").alias("n")).collect())  # 101 per generator
    for i, name in enumerate(GENERATORS):
        good = n = 0.0
        best = None
        for r in sorted((r for r in binned if r["g"] == i), key=lambda r: -r["bin"]):
            good, n = good + r["good"], n + r["n"]
            if good / n >= precision:
                best = max(0.5, r["bin"] / 100)
        if best is not None:
            model.thresholds[name] = best
    return model


_LABELLED = ("array<struct<start:int,label:double,free:boolean,fields:struct<" + ",".join(f"{n}:double" for n in FEATURES) + ">>>")


def _without_marks(m: Column, generator: int) -> list[Column]:
    """The values of a checked contact when it is written without the marks of the base patterns; NULL where there is no such form."""
    value = m["value"]
    if generator == list(GENERATORS).index(CONTACT):
        dotted = F.regexp_replace(value, r"\.", " (dot) ")
        return [F.when(value.contains("@"), v) for v in (F.replace(dotted, F.lit("@"), F.lit(" (at) ")), F.replace(value, F.lit("@"), F.lit("[at]")))]
    forms = (F.regexp_replace(value, r"^\+", ""), F.regexp_replace(value, r"^\+[0-9]{1,3}[ .-]?(?=[(0-9])", ""))
    return [F.when(value.startswith("+") & (F.length(digits(v)) >= LEAST_DIGITS), v) for v in forms]


def _may_be_contact(m: Column) -> Column:
    """Whether an unlabelled candidate has a hint word in front or, with its marks respelled, is an address."""
    plain = F.regexp_replace(F.regexp_replace(m["value"], AT, "@"), DOT, ".")
    return F.coalesce(m["before"].rlike(HINTS), F.lit(False)) | plain.rlike(r"^[^@]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+$")


def _labelled(generator: int):
    """Training rows of a candidate: none, one, or one per form of a checked contact."""

    def row(m: Column, value: Column, label: float, free: bool) -> Column:
        form = F.struct(m["start"].alias("start"), m["end"].alias("end"), value.alias("value"), m["before"].alias("before"), m["after"].alias("after"))
        return F.when(value.isNotNull(), F.struct(
            m["start"].alias("start"), F.lit(label).alias("label"), F.lit(free).alias("free"), features(form, generator).alias("fields")))

    def rows(m: Column) -> Column:
        forms = [row(m, m["value"], 1.0, False), *[row(m, v, 1.0, True) for v in _without_marks(m, generator)]]
        return F.when(_overlaps(F.col("base"), m), F.array_compact(F.array(*forms))).when(
            _may_be_contact(m), F.array().cast(_LABELLED)).otherwise(F.array(row(m, m["value"], 0.0, True)))

    return rows


def _accepted(name: str, generator: int, model: Model) -> Column:
    """Candidates clear of base spans whose score reaches the generator's threshold."""
    free = F.filter(f"{MARK}{name}", lambda m: ~_overlaps(F.col(f"{MARK}base"), m))
    fields = F.transform(free, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), features(m, generator).alias("f")))
    scored = F.transform(fields, lambda c: F.struct(
        F.lit(name).alias("kind"), c["start"].alias("start"), c["end"].alias("end"), model.score(c["f"]).alias("score")))
    chosen = F.filter(scored, lambda s: s["score"] >= model.thresholds[name])
    return F.coalesce(chosen, F.array().cast(SPANS))


def find_pii(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``pii`` (array of kind, start, end, score; code points, end exclusive) to every row.

    Base spans come first, by kind in the order of ``BASE``, then start, with score 1; then what the
    trees accept of each generator's candidates outside base spans. NULL and empty texts have none (an
    empty array); repeated rows each get their own; a column named ``pii`` is replaced; an empty table
    gives an empty one. Nothing is shuffled.
    """
    out = _with_matches(df.drop("pii"), text, f"{MARK}base")
    more = [_accepted(name, i, model) for i, name in enumerate(GENERATORS) if model.trees is not None and name in model.thresholds]
    return out.withColumn("pii", F.concat(f"{MARK}base", *more)).drop(f"{MARK}base", *[f"{MARK}{k}" for k in GENERATORS])


def redact(df: DataFrame, text: str = "text", spans: str = "pii") -> DataFrame:
    """Replace every maximal run of overlapping spans in ``text`` by the kind of its first, in brackets."""
    column = F.col(f"`{text}`")
    ordered = F.array_sort(F.transform(f"`{spans}`", lambda s: F.struct(s["start"], s["end"], s["kind"])))
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
    done = F.aggregate(ordered, start, lambda acc, s: F.when(
        s["start"] < acc["at"], F.struct(acc["done"].alias("done"), F.greatest(acc["at"], s["end"]).alias("at"))).otherwise(F.struct(
            F.concat(acc["done"], F.substring(column, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
            .alias("done"), s["end"].alias("at"))),
        lambda acc: F.concat(acc["done"], F.substring(column, acc["at"] + 1, F.length(column))))
    return df.withColumn(text, F.when(F.size(f"`{spans}`") > 0, done).otherwise(column))
