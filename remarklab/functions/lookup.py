"""Word tables as constants inside an expression.

A table of up to some ten thousand words travels with the plan as one constant: an array of small
slots addressed by the hash of a word. A row looks its words up without join or shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .text import bind


def few_rows(table: DataFrame, limit: int) -> list | None:
    """The rows of a table with a ``token`` column, with their hashes, if there are at most limit."""
    rows = table.withColumn("hash", F.xxhash64("token")).limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def _slots(rows: list) -> int:
    return 1 << (max(len(rows), 1) - 1).bit_length()


def with_word_set(rows: list, body: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """``body`` receives a test of whether a token is among the rows."""
    n = _slots(rows)
    slots: list[list] = [[] for _ in range(n)]
    for r in rows:
        slots[r["hash"] % n].append(r["token"])
    constant = F.from_json(F.lit(json.dumps(slots)), "array<array<string>>")

    def test(all_slots: Column) -> Callable[[Column], Column]:
        return lambda t: F.array_contains(F.get(all_slots, F.pmod(F.xxhash64(t), F.lit(n)).cast("int")), t)

    return bind(constant, lambda s: body(test(s)))


def with_word_map(
    rows: list, fields: dict[str, str], body: Callable[[Callable[[Column], Column]], Column]
) -> Column:
    """``body`` receives a lookup of a token's fields, a struct that is NULL for unknown tokens."""
    n = _slots(rows)
    slots: list[dict] = [{} for _ in range(n)]
    for r in rows:
        slots[r["hash"] % n][r["token"]] = {name: r[name] for name in fields}
    entry = ",".join(f"{name}:{kind}" for name, kind in fields.items())
    constant = F.from_json(F.lit(json.dumps(slots)), f"array<map<string,struct<{entry}>>>")

    def lookup(all_slots: Column) -> Callable[[Column], Column]:
        return lambda t: F.get(all_slots, F.pmod(F.xxhash64(t), F.lit(n)).cast("int"))[t]

    return bind(constant, lambda s: body(lookup(s)))
