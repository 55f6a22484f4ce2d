import hashlib
import zlib
from functools import partial

import pytest
from pyspark.sql import functions as F

from llm_tables import CLASHES, edge_rows, empty, table
from remarklab.llm import merkle as M
from remarklab.llm.queries import QUERIES

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute_tree(leaves):
    """(root, siblings per leaf) level by level over the whole list."""
    proofs = [[] for _ in leaves]
    nodes = [(x, [i]) for i, x in enumerate(leaves)]
    while len(nodes) > 1:
        parents = []
        for at in range(0, len(nodes), 8):
            run = nodes[at:at + 8]
            for k, (_, below) in enumerate(run):
                for i in below:
                    proofs[i].append((k, [x for j, (x, _) in enumerate(run) if j != k]))
            parents.append((sha("".join(x for x, _ in run)), [i for _, below in run for i in below]))
        nodes = parents
    return nodes[0][0], proofs


def lower(text):
    return text if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_force(rows):
    """The query's result, from its contract."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = brute_tree([leaf(r) for r in groups[g]])
    root, tops = brute_tree([trees[g][0] for g in names])
    out = []
    for g, top in zip(names, tops):
        subroot, proofs = trees[g]
        for r, proof in zip(groups[g], proofs):
            proof = proof + top
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            node = leaf((*r[:4], lower(r[4]))) if tampered else leaf(r)
            for place, siblings in proof:
                node = sha("".join(siblings[:place] + [node] + siblings[place:]))
            out.append((r[0], leaf(r), subroot, root, sha("".join(x for _, s in proof for x in s)), node, node == root))
    return out


def key(r):
    return tuple((x is None, x) for x in r)


def store(spark, rows, folder):
    spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(3).write.parquet(
        f"{folder}/documents.parquet")


def run(spark, folder):
    out = QUERIES["op13_merkle_manifest"](spark, str(folder))
    return sorted((tuple(r) for r in out.collect()), key=key)


def documents(n, langs):
    return [(i * 7 % n, f"s{i % 5}" if i % 11 else None, langs[i % len(langs)], i if i % 13 else None, f"Text {i} of ÄÖ" if i % 17 else None)
            for i in range(n)]


@pytest.mark.parametrize("n, langs", [(1, ["en"]), (8, ["en"]), (9, ["en", None]), (65, [None]), (600, ["en", "en", "en", "de", None, "Zz", "é"])])
def test_query_equals_brute_force(spark, tmp_path, n, langs):
    rows = documents(n, langs)
    store(spark, rows, tmp_path)
    got = run(spark, tmp_path)
    assert got == sorted(brute_force(rows), key=key)
    assert {r[-1] for r in got} <= {True, False} and any(r[-1] for r in got)


def test_rounds_and_short_last_groups(spark, tmp_path, monkeypatch):
    """Blocks of eight leaves: several rounds, blocks and groups that end early, many groups."""
    monkeypatch.setattr(M, "manifest", partial(M.manifest, levels=1))
    rows = documents(700, ["en"]) + [(i, None, f"l{i % 70}", i, "x") for i in range(150)] + [(i, None, "de", 1, "Y") for i in range(73)]
    store(spark, rows, tmp_path)
    assert run(spark, tmp_path) == sorted(brute_force(rows), key=key)


def test_edges(spark, tmp_path):
    """NULLs everywhere, equal ids, repeated rows, empty and long texts."""
    rows = [(i, None, lang, None, text) for i, text, lang in edge_rows()] + [(None, None, None, None, None)] * 3 + [(4, "s", "en", 1, "Aa")] * 20
    store(spark, rows, tmp_path)
    assert run(spark, tmp_path) == sorted(brute_force(rows), key=key)


def test_empty_table(spark, tmp_path):
    store(spark, [], tmp_path)
    assert run(spark, tmp_path) == []
    df = empty(spark).withColumn("digest", M.leaf(F.col("text")))
    assert M.manifest(df, "lang", "doc_id", "digest").count() == 0


def test_columns_of_any_name(spark):
    names = (*CLASHES, "group", "order", "tie", "kept", "position", "block", "proof", "Root", "none", "c0", "a.b")
    df = table(spark, edge_rows(), names).withColumn("digest", M.leaf(F.col("doc_id"), F.col("text")))
    out = M.manifest(df, "lang", "doc_id", "digest")
    assert out.columns == [c for c in df.columns if c not in ("digest", "proof", "Root")] + ["leaf", "subroot", "root", "proof"]
    checked = out.select(M.fold(F.col("leaf"), F.col("proof")) == F.col("root"), F.col("group") == "group!", F.col("`a.b`") == "a.b!").collect()
    assert len(checked) == len(edge_rows()) and all(all(r) for r in checked)


def test_a_changed_leaf_or_proof_does_not_verify(spark):
    df = table(spark, [(i, f"t{i}", "en") for i in range(100)]).withColumn("digest", M.leaf(F.col("doc_id"), F.col("text")))
    out = M.manifest(df, "lang", "doc_id", "digest")
    wrong = out.where(M.fold(M.leaf(F.col("doc_id"), F.lit("u")), F.col("proof")) == F.col("root"))
    longer = out.where(M.fold(F.col("leaf"), F.slice("proof", 1, 1)) == F.col("root"))
    assert out.count() == 100 and wrong.count() == 0 and longer.count() == 0
