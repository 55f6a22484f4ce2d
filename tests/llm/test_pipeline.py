"""Pipeline stages on a small table, and all queries of the package."""

import hashlib

import pytest

import __spark_entry__ as entry
import corpus_pipeline as C
from conftest import SF
from llm_tables import CLASHES, empty, sorted_rows, table, words
from remarklab.llm import queries

QUESTION = "How many of the small brown boxes does the old sailor count before the seven ships leave the harbour at night?"


@pytest.fixture()
def folder(spark, tmp_path):
    spark.createDataFrame([(0, QUESTION)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def docs(spark):
    rows = [(i, words(60, i), "en") for i in range(30)]
    rows += [(40, rows[3][1], "en"), (41, rows[3][1], None), (42, "1234 !!!", "en"), (43, None, "en"), (44, "", None),
             (45, words(30, 77) + ". " + QUESTION, "en"), (46, words(40, 78) + " password = hunter2hunter2 " + words(9, 79), "en"), (None, words(50, 80), None)]
    df = table(spark, rows, CLASHES)
    return df.selectExpr("*", "'src' AS source", "CAST(length(text) AS BIGINT) AS n_chars")


def test_stages(spark, folder):
    frame = docs(spark)
    columns = frame.columns
    kept = None
    for k, (name, stage) in enumerate(C.STAGES):
        out = stage(spark, frame, folder)
        if k < len(C.STAGES) - 1:
            assert out.columns == columns, name
        out.write.parquet(f"{folder}/{k}")
        frame = spark.read.parquet(f"{folder}/{k}")
        ids = [r[0] for r in sorted_rows(frame, "doc_id")]
        if name == "language":
            assert ids == [*range(30), 40, 41, 45, 46, None]
            assert {r.lang for r in frame.collect()} == {"en"}
        elif name == "near_duplicates":
            assert ids == [*range(30), 45, 46, None]
        elif name == "decontamination":
            assert ids == [*range(30), 46, None]
        elif name == "secrets":
            kept = {r.doc_id: r for r in frame.collect()}
            assert "hunter2" not in kept[46].text and "[SECRET]" in kept[46].text and kept[46].n_chars == len(kept[46].text)
            assert all(kept[i].text == words(60, i) for i in range(30))
        else:
            assert ids == [*range(30), 46, None]
            for r in frame.collect():
                assert r.decoded_sha256 == hashlib.sha256(kept[r.doc_id].text.encode()).hexdigest()
                assert len(r.token_ids) == 4 * r.n_tokens


def test_empty_documents(spark, folder):
    frame = docs(spark).limit(0)
    for _, stage in C.STAGES:
        frame = stage(spark, frame, folder)
        assert frame.count() == 0


def test_run_is_the_stages(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    ids = [r.doc_id for r in C.run(spark, SF).collect()]
    assert len(set(ids)) == len(ids) and set(ids) <= {r.doc_id for r in frame.select("doc_id").collect()}
    assert 0 < len(ids) < frame.count()


def test_registered():
    assert set(queries.QUERIES) <= set(entry.queries()) and entry.queries()["pipeline"] is C.run
    assert {q.split("_")[0] for q in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert len(C.STAGES) == 5


def test_lost_files_of_the_package(tmp_path):
    """Without the package and the pipeline the entry still loads the other queries."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry.__file__))
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) == len(entry.QUERIES) and int(out[1]) == len(entry.ORACLES)


def test_empty_table_through_queries(spark, tmp_path):
    empty(spark).selectExpr("*", "'s' AS source", "0L AS n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, QUESTION)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "page_id bigint, url string, html string, lang string").write.parquet(f"{tmp_path}/pages.parquet")
    for name, query in queries.QUERIES.items():
        assert query(spark, str(tmp_path)).count() == 0, name
