"""Secret scanning: fixed patterns, and windows of high entropy over candidate strings.

A candidate is a run of token characters. It falls into the narrowest character class that holds it,
and a window slides over it; the window's Shannon entropy follows from character counts that change by
one character in and one out. Windows at or above the class's threshold are joined to one span. An
allow list and a check for the shape of ordinary words suppress candidates that are no secrets.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from remarklab.llm.common import append_columns

# Patterns of the base kinds, in order; letters of the key words in either case.
ASSIGN = re.compile(
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN_LENGTH, ACCESS_LENGTH = 6, 20

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
# character class, and the bits per character that a window of 20 must reach (a random one has about
# 3.4 of hexadecimal digits, 3.9 of letters of one case with digits, 4.1 of 64 characters)
CLASSES = (
    ("hex", re.compile(r"[0-9a-fA-F]+"), 3.0),
    ("lower", re.compile(r"[0-9a-z_-]+"), 3.6),
    ("upper", re.compile(r"[0-9A-Z_-]+"), 3.6),
    ("mixed", re.compile(r"[A-Za-z0-9+/_=-]+"), 3.75),
)
# what explains a part of a candidate: words of placeholders cover their part between slashes and equals
# signs, up to REACH characters on either side (one that stands alone there covers itself); digests of locked
# packages cover as many characters as they have; fillers and alphabets cover themselves
ALLOW = re.compile("(?P<word>example|placeholder|changeme|your[_-]|lorem)|sha256-.{,44}|sha512-.{,88}"
                   "|x{6,}|0{6,}|1{6,}|123456789|abcdefgh|qwerty|wjalrxutnfemi/k7mdeng/bpxrficyexamplekey")
REACH = 40
ALPHABETS = ("123456789", "abcdefgh")
# characters that follow each other where alphabets are written one behind the other
TURNS = {"za", "z0", "9a", "90"}
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
# letters, then perhaps digits (an identifier with a number), part by part
WORDLIKE = re.compile(r"(?:[A-Z]?[a-z]+|[A-Z]+)?[0-9]{0,4}(?:[-_/+=](?:[A-Z]?[a-z]+|[A-Z]+)?[0-9]{0,4})*")


def base_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans of the base kinds, each kind leftmost first without overlaps."""
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= ASSIGN_LENGTH:
            yield "assign", m.start(), m.end()
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= ACCESS_LENGTH:
                yield "access", m.start(), m.end()
    for m in HEX.finditer(text):
        yield "hex", m.start(), m.end()


def window_entropies(text: str, width: int) -> list[float]:
    """Bits per character of every window; a text shorter than the window is one window.

    With c the counts of a window of n characters, the entropy is log2 n - (sum of c log2 c) / n, and
    the sum changes by two terms a step.
    """
    n = min(width, len(text))
    if not n:
        return []
    part = [0.0] + [c * math.log2(c) for c in range(1, n + 1)]
    counts: dict[str, int] = {}
    total = 0.0
    out = []
    for i, c in enumerate(text):
        k = counts.get(c, 0)
        total += part[k + 1] - part[k]
        counts[c] = k + 1
        if i >= n:
            gone = text[i - n]
            k = counts[gone]
            total += part[k - 1] - part[k]
            counts[gone] = k - 1
        if i >= n - 1:
            out.append(math.log2(n) - total / n)
    return out


def suppressed(candidate: str) -> bool:
    """Whether the shape of ordinary words, numbers or identifiers explains a candidate."""
    if candidate.isalpha() or candidate.isdigit() or UUID.fullmatch(candidate) or WORDLIKE.fullmatch(candidate):
        return True
    return not any("0" <= c <= "9" for c in candidate)


def allowed(candidate: str) -> Iterator[tuple[int, int]]:
    """Parts of a candidate that the allow list explains, by start."""
    low = candidate.lower()
    follows = lambda i: ord(low[i]) == ord(low[i - 1]) + 1 or low[i - 1:i + 1] in TURNS
    for m in ALLOW.finditer(low):
        start, end = m.span()
        if m["word"]:
            left, right = max(0, start - REACH), end + REACH
            left = max(left, low.rfind("/", left, start) + 1, low.rfind("=", left, start) + 1)
            end = min([len(low), right, *(k for k in (low.find("/", end, right), low.find("=", end, right)) if k >= 0)])
            start = left
        elif m[0] in ALPHABETS:
            while 0 < start > m.start() - REACH and follows(start):
                start -= 1
            while end < min(len(low), m.end() + 2 * REACH) and follows(end):
                end += 1
        yield start, end


def remains(start: int, end: int, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What a sorted list of spans leaves of one, where it is as long as a window."""
    for a, b in [*taken, (end, end)]:
        if min(a, end) - start >= WINDOW:
            yield start, min(a, end)
        start = max(start, b)


def entropy_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """Joined windows of high entropy in every part of a candidate that the allow list leaves."""
    for m in CANDIDATE.finditer(text):
        if suppressed(m[0]):
            continue
        for low, high in remains(0, len(m[0]), sorted(allowed(m[0]))):
            part = m[0][low:high]
            if suppressed(part):
                continue
            threshold = next(t for _, shape, t in CLASSES if shape.fullmatch(part))
            start = end = -1
            for i, bits in enumerate(window_entropies(part, WINDOW)):
                if bits >= threshold - 1e-12:
                    if i > end:
                        if start >= 0:
                            yield "entropy", m.start() + low + start, m.start() + low + end
                        start = i
                    end = i + WINDOW
            if start >= 0:
                yield "entropy", m.start() + low + start, m.start() + low + end


def secret_spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end in code points), by start, then kind.

    Of entropy spans, what the others leave is reported where it is as long as a window.
    """
    if not text:
        return []
    order = lambda s: (s[1], KINDS.index(s[0]))
    spans = sorted(base_spans(text), key=order)
    starts = [s[1] for s in spans]
    reach = list(accumulate((s[2] for s in spans), max))  # furthest end so far
    extra = []
    for kind, start, end in entropy_spans(text):
        before = bisect_left(starts, end)  # base spans that start before this one ends
        first = bisect_right(reach, start)  # those before end before this one starts
        extra += [(kind, a, b) for a, b in remains(start, end, [s[1:] for s in spans[first:before]])]
    return sorted(spans + extra, key=order)


def scan_documents(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``secrets`` (array of kind, start, end; code points, end exclusive) to every row.

    Sorted by start, then by the order of ``KINDS``. NULL and empty texts have no secrets (an empty
    array); repeated rows each get their own; a column named ``secrets`` is replaced; an empty table
    gives an empty one. Whole texts are scanned and nothing is shuffled.
    """

    def make():
        def run(texts):
            return [[[{"kind": k, "start": a, "end": b} for k, a, b in secret_spans(t)] for t in texts]]

        return run

    return append_columns(df, text, "secrets array<struct<kind:string,start:int,end:int>>", make, keep)


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined in their order."""
    return F.array_join(F.transform(spans, lambda s: F.format_string("%s:%d:%d", s["kind"], s["start"], s["end"])), ",")


def redact(df: DataFrame, text: str = "text", spans: str = "secrets", mask: str = "[SECRET]") -> DataFrame:
    """Replace every maximal run of overlapping spans (by start) in ``text`` by ``mask``.

    NULL texts stay NULL and texts without spans stay as they are.
    """
    pieces = F.aggregate(
        F.col(f"`{spans}`"),
        F.struct(F.lit("").alias("done"), F.lit(0).alias("at")),
        lambda acc, s: F.when(s["start"] < acc["at"], F.struct(
            acc["done"].alias("done"), F.greatest(acc["at"], s["end"]).alias("at")))
        .otherwise(F.struct(
            F.concat(acc["done"], F.substring(F.col(f"`{text}`"), acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask)).alias("done"),
            s["end"].alias("at"))),
        lambda acc: F.concat(acc["done"], F.substring(F.col(f"`{text}`"), acc["at"] + 1, F.length(F.col(f"`{text}`")))))
    changed = F.when(F.size(F.col(f"`{spans}`")) > 0, pieces).otherwise(F.col(f"`{text}`"))
    return df.withColumn(text, changed)
