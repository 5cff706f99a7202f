from datetime import datetime

import pytest
from pyspark.sql import functions as F

from folioflow.functions import lookup
from folioflow.llm import survivors

PAPERS = (
    "record_no long, paper_id string, title string, accepted_by string, seen_in_sources array<string>, base_urls map<string,string>, "
    "source_name string, crawled_at timestamp, source_trust string"
)
REGISTRY = "source_name string, source_kind string, trust int"
SOURCES = [("arXiv", "preprint", 3), ("OpenReview", "review", 5), ("Nlas", "proceedings", 8)]


def day(n):
    return datetime(2026, 1, n)


def rows(*records):
    return [(*r, "a clashing column") for r in records]


def found(spark, records, registry=SOURCES):
    papers, names = spark.createDataFrame(rows(*records), PAPERS), spark.createDataFrame(registry, REGISTRY)
    return {r["paper_id"]: r for r in survivors.surviving_papers(papers.drop("source_trust").withColumn("sources_", F.lit(1)), names).collect()}


def test_each_field_from_its_best_record(spark):
    got = found(
        spark,
        [
            (1, "AB", "t", "arXiv 2025", ["arxiv ", "Nlas", "NLAS"], {"a": "https://x.example/1"}, "Nlas", day(1)),
            (2, "ab", "t", " NLAS  2025", ["unknown", None, ""], {"a": " https://x.example/1 ", "b": "http://y.example"}, "arXiv", None),
            (3, "Ab", "t", "Submitted to NLAS 2025", None, {"a": "https://", "b": None}, "OpenReview", day(3)),
            (3, "Ab", "t", "Submitted to NLAS 2025", None, {"a": "https://", "b": None}, "OpenReview", day(3)),
        ],
    )["ab"]
    assert (got["first_record"], got["last_record"]) == (1, 3)
    assert got["accepted_by"]["record"] == 2 and got["base_urls"]["record"] == 2 and got["seen_in_sources"]["record"] == 1
    assert got["base_urls"]["value"] == ["http://y.example", "https://x.example/1"] and got["seen_in_sources"]["value"] == ["arxiv", "nlas"]


def test_ties_go_by_trust_then_time_then_number(spark):
    records = [
        (5, "a", "t", "NLAS 2024", None, None, " OPENREVIEW\t", day(1)),
        (4, "a", "t", "NLAS 2025", None, None, "OpenReview", day(1)),
        (3, "a", "t", "NLAS 2026", None, None, "openreview", None),
        (2, "a", "t", "NLAS 2026", None, None, "no such source", day(9)),
        (1, "a", "t", "NLAS 2026", None, None, None, day(9)),
    ]
    assert found(spark, records)["a"]["accepted_by"]["record"] == 4


def test_missing_ids_nulls_and_unusable_values(spark):
    got = found(
        spark,
        [
            (1, None, "The  Title!", None, None, None, None, None),
            (2, " ", "the title", "N/A", [], {}, None, None),
            (3, None, None, "NLAS 2025", ["arXiv"], None, "arXiv", None),
            (4, None, "***", "NLAS 2025", ["arXiv"], None, "arXiv", None),
        ],
    )
    assert len(got) == 1
    only = next(iter(got.values()))
    assert (only["first_record"], only["last_record"]) == (1, 2) and only["accepted_by"] is None and only["base_urls"] is None and only["seen_in_sources"] is None


@pytest.mark.parametrize(
    ("value", "rank"),
    [
        ("NLAS Findings 2025", 2), ("Proc. of ICRM '24", 2), ("COGAI 2025 (Oral)", 2), ("ARXIV preprint 2023", 1), ("arxiv  2024 ", 1), (None, None), ("", None), ("  ", None),
        ("-", None), ("N/A", None), ("TBD", None), ("null", None), ("none", None), ("unknown", None), ("2024", None), ("NLAS 2022 - pending decision", None),
        ("Rejected from NLAS 2025", None), ("AIMR 2024 (withdrawn)", None), ("under review at ICRM 2023", None), ("Submitted to COGAI", None),
        ("NLAS 2023 Desk Rejected Submission", None),
    ],
)
def test_acceptance(spark, value, rank):
    assert spark.createDataFrame([(value,)], "x string").select(survivors.acceptance_rank(F.col("x"))).first()[0] == rank


def test_large_registry_is_joined_with_the_same_result(spark, monkeypatch):
    records = [(1, "a", "t", "NLAS", ["ARXIV", "x"], None, "arxiv", None), (2, "a", "t", "NLAS", ["nlas", " arXiv"], None, "Nlas ", None), (3, "b", "t", "NLAS", None, None, None, None)]
    few = found(spark, records)
    monkeypatch.setattr(survivors, "literal_lookup", lambda *a: lookup.literal_lookup(*a, rows=1))
    assert found(spark, records) == few and few["a"]["accepted_by"]["record"] == 2 and few["a"]["seen_in_sources"]["record"] == 2


def test_empty_tables(spark):
    assert found(spark, []) == {} and found(spark, [], []) == {}
    assert found(spark, [(1, "a", "t", "NLAS", ["arXiv"], None, "arXiv", None)], [])["a"]["seen_in_sources"] is None


def test_one_group_of_very_many_records(spark):
    papers = spark.range(20000).select(
        F.col("id").alias("record_no"), F.lit("A").alias("paper_id"), F.lit("t").alias("title"), F.lit("NLAS").alias("accepted_by"),
        F.array(F.lit("arXiv")).alias("seen_in_sources"), F.create_map(F.lit("u"), F.concat(F.lit("https://x.example/"), F.lit("y" * 300))).alias("base_urls"),
        F.lit("arXiv").alias("source_name"), F.lit(None).cast("timestamp").alias("crawled_at"),
    )
    got = survivors.surviving_papers(papers, spark.createDataFrame(SOURCES, REGISTRY)).collect()
    assert [(r["paper_id"], r["last_record"], r["base_urls"]["record"]) for r in got] == [("a", 19999, 0)]
