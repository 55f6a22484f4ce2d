import random

import pytest
import xxhash

from llm_tables import CLASHES, edge_rows, empty, sorted_rows, table, words
from remarklab.llm import simhash as S
from remarklab.llm.components import connected_components


def plain_simhash(text, n=3):
    own = (text or "").translate({i: i + 32 for i in range(65, 91)}).encode().split()
    if not own:
        return 0
    shingles = [b" ".join(own[i:i + n]) for i in range(len(own) - n + 1)] or [b" ".join(own)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(values, distance):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_components_equal_brute_force(spark):
    rng = random.Random(3)
    rows = list(edge_rows())
    for k in range(60):  # near copies: long texts with a word changed
        own = words(400, k % 12).split()
        own[rng.randrange(400)] = f"edit{k}"
        rows.append((100 + k, " ".join(own), None))
    df = table(spark, rows, CLASHES)
    got = sorted_rows(S.near_duplicates(df), "doc_id", "fingerprint", "component_id")
    values = [plain_simhash(t) for _, t, _ in rows]
    groups = components_of(values, 3)
    least = {}
    for (i, _, _), g in zip(rows, groups):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    want = [(i, v - (1 << 64) if v >> 63 else v, least.get(g)) for (i, _, _), v, g in zip(rows, values, groups)]
    assert got == sorted(want, key=lambda r: tuple((x is None, x) for x in r))
    assert len(set(groups)) < len(rows) - 20


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 5])
def test_links_lose_no_pair(spark, distance):
    rng = random.Random(distance)
    values = {rng.getrandbits(64) for _ in range(30)}
    for v in list(values):
        for flips in range(7):
            for b in rng.sample(range(64), flips):
                v ^= 1 << b
            values.add(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fingerprint bigint")
    got = {tuple(sorted(r)) for r in S.fingerprint_links(df, distance).collect()}
    mask = (1 << 64) - 1
    want = {tuple(sorted((a, b))) for a in signed for b in signed if a < b and ((a & mask) ^ (b & mask)).bit_count() <= distance}
    assert got == want


def test_one_of_each_group_stays(spark):
    rows = [(3, "a b c d", "x"), (1, "a b c d", "y"), (2, "other words here now", None), (2, "other words here now", None), (None, "a b c d", "z"),
            (None, "only one with null", None), (None, None, None), (9, "", None), (9, None, "q")]
    df = table(spark, rows, CLASHES)
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    got = sorted_rows(kept, "doc_id", "text")
    assert got[:2] == [(1, "a b c d"), (2, "other words here now")] and got[3] == (None, "only one with null")
    assert got[2][0] == 9 and not got[2][1] and len(got) == 4
    assert S.keep_one(empty(spark)).count() == 0 and S.near_duplicates(empty(spark)).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (300, 301), (301, 300)]
    random.Random(1).shuffle(edges)
    df = spark.createDataFrame(edges, "u bigint, v bigint")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100: 100}, **{200 + i: 100 for i in range(50)}, 300: 300, 301: 300}
    assert connected_components(df.limit(0)).count() == 0
