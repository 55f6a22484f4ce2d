"""License scanning: phrases, and an exact containment join of text blocks with license notices.

A block is a line, a window of a long line, or a window of the whole text that starts at any word and
may cross line breaks. A notice matches a block that holds at least ``threshold`` of its distinct
words. Words are ordered by their document frequency over the whole
corpus, rarest first. With t distinct words a notice needs o = ceil(threshold * t) of them, so a match
has one of the notice's first t - o + 1 words (prefix filter); the block must have o of the words that
notices use (length filter); and the words left on both sides behind the first common one must make
up o (position filter). What passes is counted. Windows over the whole text are only tried around the
prefix words, of notices of which the text has o words at all.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from remarklab.llm.common import append_columns, ship_package, small_batches

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# Phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
# Notices and their labels, in lower case, without punctuation.
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "licensed under the gnu lesser general public license version 3"),
    ("agpl", "licensed under the gnu affero general public license version 3"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl-2.0", "made available under the terms of the eclipse public license 2 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("reserved", "copyright all rights reserved"),
)
THRESHOLD = 0.8
# a longer line is cut into windows of BLOCK words, one every BLOCK // 2; a window of the text has BLOCK words at most
BLOCK = 48


class Matcher:
    """The notices with their words in a global order, indexed by prefix word."""

    def __init__(self, notices, frequency: dict[str, int], threshold: float, block: int = BLOCK):
        self.labels = [label for label, _ in notices]
        self.block = block
        words = sorted({w for _, notice in notices for w in notice.encode().split()})
        self.order = {w: i for i, w in enumerate(sorted(words, key=lambda w: (frequency.get(w.decode(), 0), w)))}
        self.sets, self.need, self.index, self.prefixes = [], [], {}, []
        for k, (_, notice) in enumerate(notices):
            ordered = sorted(set(notice.encode().split()), key=self.order.get)
            need = max(1, math.ceil(threshold * len(ordered) - 1e-9))
            self.sets.append(frozenset(ordered))
            self.need.append(need)
            self.prefixes.append(frozenset(ordered[: len(ordered) - need + 1]))
            for i, w in enumerate(ordered[: len(ordered) - need + 1]):
                self.index.setdefault(w, []).append((k, i))

    def match(self, words: list[bytes]) -> list[tuple[int, float, bool]]:
        """Notices (index, containment, whether it is the block's best) that a block of words holds.

        The best has the highest containment and, among those, the most words.
        """
        own = sorted({w for w in words if w in self.order}, key=self.order.get)
        seen, out = set(), []
        for j, w in enumerate(own):
            for k, i in self.index.get(w, ()):
                if k in seen:
                    continue
                seen.add(k)  # w is the first common word: earlier ones would have met the notice before
                need, size = self.need[k], len(self.sets[k])
                if len(own) < need or 1 + min(size - i - 1, len(own) - j - 1) < need:
                    continue
                common = len(self.sets[k].intersection(own))
                if common >= need:
                    out.append((k, common / size))
        rank = max(((share, len(self.sets[k])) for k, share in out), default=None)
        return [(k, share, (share, len(self.sets[k])) == rank) for k, share in sorted(out)]

    def blocks(self, data: bytes) -> Iterator[tuple[int, list[bytes]]]:
        """First word's index and words of every block that has a prefix word."""
        start = 0
        for line in data.split(b"\n"):
            words = WORD.findall(line)
            if not self.index.keys().isdisjoint(words):
                step = max(1, self.block // 2)
                for at in range(0, max(1, len(words) - self.block + step), step):
                    yield start + at, words[at:at + self.block]
            start += len(words)

    def narrowest(self, marks: list[tuple[int, bytes]], need: int) -> list[tuple[int, int, int]]:
        """Disjoint windows (distinct words, first, last index) with ``need`` of the marked words.

        A window is left out only if it overlaps one with as many words that is as narrow, or one with more.
        """
        counts: dict[bytes, int] = {}
        ends, left = [], 0
        for at, w in marks:
            counts[w] = counts.get(w, 0) + 1
            # words out of reach go, and those in front that stand in the window again
            while marks[left][0] <= at - self.block or counts[marks[left][1]] > 1:
                gone = marks[left][1]
                counts[gone] -= 1
                if not counts[gone]:
                    del counts[gone]
                left += 1
            if len(counts) >= need:
                ends.append((-len(counts), at - marks[left][0], at))
        chosen: list[tuple[int, int, int]] = []
        for n, width, last in sorted(ends):
            k = bisect_left(chosen, last - width, key=lambda c: c[2])  # the first that ends at or behind this one's start
            if k == len(chosen) or chosen[k][1] > last:
                chosen.insert(k, (-n, last - width, last))
        out = list(chosen)
        if chosen:  # what overlapped a chosen one may hold enough words beside it
            gaps = [(-1, chosen[0][1])] + [(a[2], b[1]) for a, b in zip(chosen, chosen[1:])] + [(chosen[-1][2], marks[-1][0] + 1)]
            for low, high in gaps:
                between = marks[bisect_right(marks, low, key=lambda m: m[0]):bisect_left(marks, high, key=lambda m: m[0])]
                if len(between) >= need:
                    out += self.narrowest(between, need)
        return out

    def windows(self, words: list[bytes]) -> list[tuple[int, int, int, float, bool]]:
        """Notices in windows of the whole text: first index, number of words, notice, containment, whether it is the best.

        Windows begin and end with a word of the notice. Best is what overlaps no window of another
        notice with higher containment or, among equal ones, more words.
        """
        have = self.order.keys() & set(words)
        wanted = [k for k, own in enumerate(self.sets) if len(own & have) >= self.need[k]]
        if not wanted:
            return []
        marks = [(i, w) for i, w in enumerate(words) if w in self.order]
        found = []
        for k in wanted:
            own = [m for m in marks if m[1] in self.sets[k]]
            regions: list[list[int]] = []
            for i in (i for i, w in own if w in self.prefixes[k]):  # all that shares a window with a prefix word
                if regions and i - self.block < regions[-1][1]:
                    regions[-1][1] = i + self.block
                else:
                    regions.append([i - self.block + 1, i + self.block])
            for low, high in regions:
                near = own[bisect_left(own, low, key=lambda m: m[0]):bisect_left(own, high, key=lambda m: m[0])]
                if len(near) >= self.need[k]:
                    found += [(first, last, k, n / len(self.sets[k])) for n, first, last in self.narrowest(near, self.need[k])]
        found.sort()
        rank = [(share, len(self.sets[k])) for _, _, k, share in found]
        best = [True] * len(found)
        for i, (_, last, _, _) in enumerate(found):
            for j in range(i + 1, len(found)):  # windows of one notice are disjoint, so few start within
                if found[j][0] > last:
                    break
                if rank[i] != rank[j]:
                    best[i if rank[i] < rank[j] else j] = False
        return [(first, last - first + 1, k, share, b) for (first, last, k, share), b in zip(found, best)]

    def scan(self, data: bytes, words: list[bytes]) -> list[tuple[int, int, int, float, bool]]:
        """All matches as in ``windows``: those of blocks, and those of windows that no block holds as well."""
        out, seen = [], {}
        for at, block in self.blocks(data):
            for k, share, best in self.match(block):
                out.append((at, len(block), k, share, best))
                seen.setdefault(k, []).append((at, at + len(block), share, best))
        for at, n, k, share, best in self.windows(words):
            spans = seen.get(k, ())
            i = bisect_right(spans, at, key=lambda s: s[0])
            # blocks are in order and two may hold a place
            if not any(s[1] >= at + n and s[2] >= share and s[3] >= best for s in spans[max(0, i - 2):i]):
                out.append((at, n, k, share, best))
        return sorted(out, key=lambda x: (x[0], x[2], x[1]))


def places(words: list[bytes], phrases: list[tuple[list[bytes], str]]) -> list[tuple[str, int]]:
    """Label and first word's index of every place where a phrase stands, by index."""
    out = []
    have = None
    for phrase, label in phrases:
        have = set(words) if have is None else have
        if have.issuperset(phrase):
            at = -1
            for _ in range(words.count(phrase[0])):
                at = words.index(phrase[0], at + 1)
                if words[at:at + len(phrase)] == phrase:
                    out.append((label, at))
    return sorted(out, key=lambda x: (x[1], x[0]))


def word_frequencies(df: DataFrame, text: str, words: set[str]) -> dict[str, int]:
    """Number of rows that hold each of a few given words, over all rows."""
    ship_package(df.sparkSession)
    small_batches(df.sparkSession)
    wanted = {w.encode() for w in words}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                counts.update(wanted.intersection(WORD.findall(value.lower())))
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    texts = df.select(F.col(f"`{text}`").cast("binary").alias("t")).where("t IS NOT NULL")
    rows = texts.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"]: r["n"] for r in rows.collect()}  # one row for each of ``words`` at most


SCHEMA = ("n_words bigint, places array<struct<label:string,start:int>>, "
          "notices array<struct<label:string,notice:int,start:int,words:int,containment:double,best:boolean>>")


def scan_documents(
    df: DataFrame, text: str = "text", notices=NOTICES, phrases=PHRASES, threshold: float = THRESHOLD,
    block: int = BLOCK, keep: list[str] | None = None,
) -> DataFrame:
    """Add the number of words, the places of phrases, and the blocks that hold a notice.

    ``n_words`` counts the words of the text with A-Z in lower case; ``places`` has label and word index
    of every place of a phrase; ``notices`` has, for every block and notice with a containment of at
    least ``threshold``, the label, the notice's index, the block's first word and length, the
    containment, and whether it is the block's best; by block, then notice. Of the windows of the whole
    text, a notice has the narrowest ones that don't overlap, where no line shows it already. NULL and empty texts have 0 words and empty arrays; repeated
    rows each get their own; columns named like the new ones are replaced; an empty table gives an
    empty one. The corpus is read twice: word order first, then the scan; only the few words of the
    notices are shuffled.
    """
    frequency = word_frequencies(df, text, {w for _, n in notices for w in n.split()})
    split = [(phrase.encode().split(), label) for phrase, label in phrases]

    def make():
        matcher = Matcher(notices, frequency, threshold, block)

        def run(texts):
            counts, found, matched = [], [], []
            for t in texts:
                data = (t or "").encode().lower()
                words = WORD.findall(data)
                counts.append(len(words))
                found.append([{"label": label, "start": at} for label, at in places(words, split)])
                matches = () if matcher.index.keys().isdisjoint(words) else matcher.scan(data, words)
                matched.append([
                    {"label": matcher.labels[k], "notice": k, "start": at, "words": n, "containment": share, "best": best}
                    for at, n, k, share, best in matches])
            return counts, found, matched

        return run

    return append_columns(df, text, SCHEMA, make, keep)
