import importlib
import os

import pytest

import __spark_entry__ as entry

DIRECTORY = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="no test tables here")


def test_queries_and_sql_agree():
    names, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(names) and len(names) >= 40


def test_works_without_the_training_data_operators(monkeypatch):
    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name.startswith("folioflow.llm") else real(name, *a))
    assert not any(n.startswith("p1_") for n in entry.queries()) and "p1_found" not in entry.oracle_sql()


@needs_data
def test_flagship(spark, monkeypatch):
    monkeypatch.setattr(entry, "FLAGSHIP_DIR", DIRECTORY)
    assert entry.entry(spark).count() > 0


@needs_data
@pytest.mark.parametrize("name", ["title_keys", "bm25_papers", "vector_papers", "ranking_metrics", "merged_papers", "topic_recall", "chunk_manifests", "page_markdown", "segments", "set_operations"])
def test_queries_match_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in os.listdir(DIRECTORY):
        con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{DIRECTORY}/{file}'")
    df = entry.queries()[name](spark, DIRECTORY)
    cursor = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    order = [columns.index(c) for c in df.columns]
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(repr(tuple(r[i] for i in order)) for r in cursor.fetchall())
