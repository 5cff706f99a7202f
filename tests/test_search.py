import math

import pytest
from pyspark.sql import functions as F

from folioflow.functions import text, vector
from folioflow.operators import evaluate, fusion, rerank, search

CHUNKS = "paper_id string, chunk_index int, chunk_id string, text string, section_path array<string>"


def chunks(spark, rows):
    return spark.createDataFrame(rows, CHUNKS)


@pytest.mark.parametrize(("value", "tokens"), [("Agent memory，trajectory", ["agent", "memory", "trajectory"]), ("to be", ["to", "be"]), ("Don't a b stop", ["don't", "stop"]), ("", []), (None, [])])
def test_tokens(spark, value, tokens):
    assert spark.createDataFrame([(value,)], "x string").select(text.retrieval_tokens(F.col("x"))).first()[0] == tokens
    if value:
        assert text.query_terms(value) == list(dict.fromkeys(tokens))


def test_section_tokens_count_as_often_as_the_multiplier_says(spark):
    df = spark.createDataFrame([("memory of agents", ["Agent Memory"]), ("memory", []), ("memory", None)], "t string, s array<string>")
    assert [r[0] for r in df.select(text.section_weighted_tokens(F.col("t"), F.col("s"), 2)).collect()] == [["memory", "agents"] + ["agent", "memory"] * 2, ["memory"], ["memory"]]


def test_bm25_equals_a_direct_computation(spark):
    rows = [("p1", 0, "a", "memory memory agent", []), ("p1", 1, "b", "agent planning", ["Memory"]), ("p2", 0, "c", "nothing here", None), ("p3", 0, "d", "planning agent memory", [])]
    docs = {"a": ["memory", "memory", "agent"], "b": ["agent", "planning", "memory", "memory"], "c": ["nothing", "here"], "d": ["planning", "agent", "memory"]}
    average = sum(map(len, docs.values())) / 4
    got = {r["chunk_id"]: r for r in search.bm25_chunks(chunks(spark, rows), "agent memory", 10).collect()}
    assert set(got) == {"a", "b", "d"} and sorted(r["rank"] for r in got.values()) == [1, 2, 3]
    for name, row in got.items():
        want = 0.0
        for term in ("agent", "memory"):
            df, tf = sum(term in d for d in docs.values()), docs[name].count(term)
            want += math.log(1 + (4 - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(docs[name]) / average))
        assert row["score"] == pytest.approx(want) and row["terms"] == ["agent", "memory"] and row["coverage"] == 1.0


def test_bm25_papers_use_the_top_chunks_only(spark):
    hits = spark.createDataFrame([(i, "p", i, f"c{i}", s, ["agent"] if i < 4 else ["memory"]) for i, s in enumerate([4.0, 3.0, 2.0, 1.0], 1)], "rank int, paper_id string, chunk_index int, chunk_id string, score double, terms array<string>")
    row = search.bm25_papers(hits, "agent memory", 5).first()
    assert (row["best"], row["mean_top"], row["coverage"], row["scoring_chunks"], row["terms"]) == (4.0, 3.0, 0.5, 3, ["agent"])
    assert row["score"] == pytest.approx(4 + 1.5 + 0.25)


def test_empty_corpus_and_bad_parameters(spark):
    assert search.bm25_chunks(chunks(spark, []), "agent", 5).collect() == []
    with pytest.raises(ValueError):
        search.Bm25(b=2)


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0], 1.0), ([1.0, 0.0], [0.0, 1.0], 0.0), ([1.0, 0.0], [-1.0, 0.0], -1.0), ([0.0, 0.0], [1.0, 0.0], 0.0), ([1.0], [1.0, 0.0], None)], "a array<double>, b array<double>, want double")
    assert all(r[0] == r[1] for r in df.select(vector.cosine(F.col("a"), F.col("b")), "want").collect())


def test_vector_ranking_descends_on_ids(spark):
    df = spark.createDataFrame([("p1", "a", [1.0, 0.0]), ("p2", "b", [2.0, 0.0]), ("p3", "c", [0.0, 1.0]), ("p4", "d", [1.0]), ("p5", "e", [float("nan"), 1.0])], "paper_id string, chunk_id string, vector array<double>")
    got = search.vector_chunks(df, [1.0, 0.0], 5).orderBy("rank").collect()
    assert [(r["rank"], r["chunk_id"], r["score"]) for r in got] == [(1, "b", 1.0), (2, "a", 1.0), (3, "c", 0.0)]


def test_vector_papers(spark):
    hits = spark.createDataFrame([(1, "A", "x", 0.9), (2, "B", "y", 0.8), (3, "A", "z", 0.7), (4, "C", "w", 0.6)], "rank int, paper_id string, chunk_id string, score double")
    got = search.vector_papers(hits, 5, 2, 0.5, 0.5).orderBy("rank").collect()
    assert [(r["paper_id"], round(r["score"], 9)) for r in got] == [("A", 0.85), ("B", 0.8), ("C", 0.6)]


def ranking(spark, rows):
    return spark.createDataFrame(rows, "rank int, paper_id string, score double")


def test_fusion_ties_descend_on_id_and_single_lists_work(spark):
    got = fusion.fuse(ranking(spark, [(1, "a", 10.0), (2, "b", 5.0)]), ranking(spark, [(1, "b", 0.9), (2, "a", 0.1)]), 0.5, 0.5).orderBy("rank").collect()
    assert [(r["paper_id"], r["score"], r["rank_score"]) for r in got] == [("b", 0.5, 0.5), ("a", 0.5, 0.5)]
    only = fusion.fuse(ranking(spark, [(1, "a", 3.0)]), ranking(spark, []), 0.7, 0.3).first()
    assert (only["score"], only["primary_relative"], only["secondary_relative"]) == (0.7, 1.0, 0.0)
    with pytest.raises(ValueError):
        fusion.fuse(ranking(spark, []), ranking(spark, []), 0, 0)


def test_segments(spark):
    df = spark.createDataFrame([("k", "abcdefghij"), ("s", "abc"), ("n", None), ("e", "")], "id string, text string")
    got = rerank.segments(df, "text", 4, 1)
    assert [(r["char_start"], r["char_end"], r["segment"]) for r in got.where("id = 'k'").orderBy("segment_index").collect()] == [(0, 4, "abcd"), (3, 7, "defg"), (6, 10, "ghij")]
    assert {r["id"] for r in got.collect()} == {"k", "s"}
    ids = got.select(rerank.segment_id(F.col("id"), F.col("segment_index"), F.col("segment_count")).alias("i")).orderBy("i").collect()
    assert [r["i"] for r in ids] == ["k::rerank-segment-0000", "k::rerank-segment-0001", "k::rerank-segment-0002", "s"]
    blank = spark.createDataFrame([("b", "abcd    ef")], "id string, text string")
    assert [r["segment"] for r in rerank.segments(blank, "text", 4, 0, True).orderBy("char_start").collect()] == ["abcd", "ef"]


def test_reranked_papers_count_each_chunk_once(spark):
    df = spark.createDataFrame([("p", "c1", "s1", 0.9), ("p", "c1", "s2", 0.9), ("p", "c2", "s3", 0.5), ("q", "c3", "s4", 0.7)], "paper_id string, chunk_id string, segment_id string, score double")
    got = rerank.reranked_papers(df, 2).orderBy("rank").collect()
    assert [(r["paper_id"], round(r["score"], 9), r["chunks"]) for r in got] == [("p", 0.7, 2), ("q", 0.7, 1)]


def test_metrics_of_a_known_ranking(spark):
    judged = spark.createDataFrame([("c", "A", 3), ("c", "B", 2), ("c", "C", 1), ("c", "D", 0), ("none", "A", 0)], "case_id string, paper_id string, relevance int")
    ranked = spark.createDataFrame([("c", i, p) for i, p in enumerate("BDAC", 1)], "case_id string, rank int, paper_id string")
    got = {(r["case_id"], r["k"]): r for r in evaluate.ranking_metrics(ranked, judged, (1, 3, 4)).collect()}
    first = got["c", 1]
    assert (first["reciprocal_rank"], first["precision"]) == (1.0, 1.0)
    assert first["average_precision"] == pytest.approx(29 / 36) and first["recall"] == pytest.approx(1 / 3) and first["ndcg"] == pytest.approx(3 / 7)
    assert got["c", 3]["precision"] == pytest.approx(2 / 3) and got["c", 4]["precision"] == 0.75 and got["c", 4]["recall"] == 1.0
    assert (got["none", 3]["ndcg"], got["none", 3]["average_precision"], got["none", 3]["retrieved_count"]) == (0.0, 0.0, 0)
    summary = evaluate.macro_summary(evaluate.ranking_metrics(ranked, judged, (5,))).first()
    assert summary["cases"] == 2 and summary["hardest_case"] == "none"
    unknown = spark.createDataFrame([("c", 1, "Z")], "case_id string, rank int, paper_id string")
    assert evaluate.unknown_ranked(unknown, judged).count() == 1 and evaluate.unknown_ranked(ranked, judged).count() == 0
    with pytest.raises(ValueError):
        evaluate.ranking_metrics(ranked, judged, (0,))
