"""Column expressions that the native operators share: bound values and matches with positions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# matches that are placed together; the blocks are placed one behind the other
BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where ``body`` uses it within lambdas."""
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)


MATCH = "array<struct<start:int,end:int,value:string,before:string,after:string>>"


def matches(text: Column, pattern: str, before: int = 24, after: int = 16) -> Column:
    """All matches of a Java pattern, leftmost first without overlaps, as ``MATCH``.

    Positions are in code points, the end exclusive; ``before`` and ``after`` are up to so many
    characters of the text next to the match, not beyond the neighbouring matches. The pattern must not
    match the empty string. A match's place is the length of all pieces and matches before it; they are
    added up in blocks, so the time grows with the number of matches, not with its square.
    """
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)

    def place(block: Column, start: Column) -> Column:
        empty = F.array().cast(MATCH)
        return F.aggregate(block, F.struct(start.alias("at"), empty.alias("out")), lambda acc, m: F.struct(
            (acc["at"] + m["gap"] + F.length(m["value"])).alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + m["gap"]).alias("start"), (acc["at"] + m["gap"] + F.length(m["value"])).alias("end"),
                m["value"].alias("value"), m["before"].alias("before"), m["after"].alias("after")))).alias("out")))

    def placed(found: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / BLOCK).cast("int")),
                             lambda b: F.slice(found, b * BLOCK + 1, F.lit(BLOCK)))
        none = F.array().cast(f"array<{MATCH}>")
        return F.aggregate(
            blocks, F.struct(F.lit(0).alias("at"), none.alias("out")),
            lambda acc, block: let(place(block, acc["at"]), lambda r: F.struct(
                r["at"].alias("at"), F.concat(acc["out"], F.array(r["out"])).alias("out"))),
            lambda acc: F.flatten(acc["out"]))

    def zipped(both: Column) -> Column:
        gaps = both["pieces"]
        return F.transform(both["values"], lambda v, i: F.struct(
            F.length(F.get(gaps, i)).alias("gap"), v.alias("value"),
            F.substring(F.get(gaps, i), -before, before).alias("before"),
            F.substring(F.get(gaps, i + 1), 1, after).alias("after")))

    found = let(F.struct(values.alias("values"), pieces.alias("pieces")),
                lambda both: F.when(F.size(both["values"]) > 0, let(zipped(both), placed)))
    return F.coalesce(found, F.array().cast(MATCH))


def digits(value: Column) -> Column:
    """The ASCII digits of a string."""
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of at most 32 digits passes the Luhn check."""
    reverse = F.reverse(number)
    total = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.length(number), F.lit(1))), F.lit(0),
        lambda acc, i: acc + let(F.substring(reverse, i, F.lit(1)).try_cast("int"), lambda d: F.when(
            i % 2 == 1, d).when(d > 4, d * 2 - 9).otherwise(d * 2)))
    return F.coalesce((F.length(number) > 0) & (total % 10 == 0), F.lit(False))


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined in their order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
