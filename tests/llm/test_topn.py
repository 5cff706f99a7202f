import random

import pytest

from folioflow.llm.topn import best_chunks, top_n_per_group

SCHEMA = "paper string, score double, idx int, p int, g string, item string, extra map<string,int>"


def brute(data, n):
    groups = {}
    for row in data:
        groups.setdefault(row[0], []).append(row)
    out = set()
    for key, members in groups.items():
        members.sort(key=lambda r: (r[1] is None, -(r[1] or 0), r[2] is None, r[2] or 0))
        out |= {(key, r[2], i) for i, r in enumerate(members[:n], 1)}
    return out


@pytest.mark.parametrize("heavy_rows", [10, 200, 10**9])
def test_equals_brute_force_whatever_is_heavy(spark, heavy_rows):
    rng = random.Random(3)
    data = [(rng.choice(["hot"] * 3 + ["a", "b", None]), rng.choice([1.0, 2.0, None, 3.5]), i, 1, "x", "y", {"k": 1}) for i in range(900)]
    got = top_n_per_group(spark.createDataFrame(data, SCHEMA), ["paper"], [("score", "desc"), ("idx", "asc")], 4, heavy_rows=heavy_rows)
    assert got.columns == [*SCHEMA.replace(",", " ").split()[0:1], "score", "idx", "p", "g", "item", "extra", "place"]
    assert {(r["paper"], r["idx"], r["place"]) for r in got.collect()} == brute(data, 4)


def test_ties_are_placed_alike_in_any_partitioning(spark):
    df = spark.createDataFrame([("a", 1.0, None, i, "g", "x" * 5000, None) for i in range(50)], SCHEMA)
    ways = [{(r["p"], r["place"]) for r in top_n_per_group(df.repartition(k), ["paper"], [("score", "desc")], 3, heavy_rows=h).collect()} for k, h in ((1, 5), (7, 5), (3, 500))]
    assert ways[0] == ways[1] == ways[2] and len(ways[0]) == 3


def test_repeated_rows_empty_table_small_n_and_clash(spark):
    df = spark.createDataFrame([("a", 1.0, 1, 1, "g", "", None)] * 3, SCHEMA)
    assert [r["place"] for r in top_n_per_group(df, ["paper"], [("score", "desc")], 5).orderBy("place").collect()] == [1, 2, 3]
    assert top_n_per_group(df, ["paper"], [("score", "desc")], 0).count() == 0
    assert top_n_per_group(df.limit(0), ["paper"], [("score", "desc")], 3).count() == 0
    assert [r["P"] for r in top_n_per_group(df, ["paper"], [("score", "desc")], 1, place="P").collect()] == [1]


def test_best_chunks(spark):
    nan, inf = float("nan"), float("inf")
    hits = [("bm25_fulltext", s, c) for s, c in [(1.0, "c1"), (3.0, "c1"), (3.0, "c2"), (nan, "c3"), (inf, "c3"), (-1.0, "c3"), (None, "c3"), (9.0, "none"), (2.0, None), (0.0, "c4")]]
    hits += [("vector", 99.0, "c3"), (None, 99.0, "c3"), hits[0]]
    chunks = [("c1", "A", 5), ("c2", "A", 4), ("c3", "A", 1), ("c4", "B", None), ("c4", "B", None), (None, "A", 9)]
    got = best_chunks(spark.createDataFrame(hits, "retriever_name string, score double, chunk_id string"), spark.createDataFrame(chunks, "chunk_id string, paper_id string, chunk_index int"))
    assert sorted(map(tuple, got.collect())) == [("A", 1, "c2"), ("A", 2, "c1"), ("B", 1, "c4")]
