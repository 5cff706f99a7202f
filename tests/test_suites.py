import pytest
from pyspark.sql import functions as F

from folioflow.operators import evaluate, fusion, quality, search, store, suites
from folioflow.sources import records

CHUNKS = "paper_id string, chunk_index int, chunk_id string, text string, section_path array<string>"
ROWS = [("p1", 0, "a", "memory memory agent", []), ("p1", 1, "b", "agent planning", ["Memory"]), ("p2", 0, "c", "nothing here", None), ("p3", 0, "d", "planning agent memory", [])]


def test_cases_equal_single_searches(spark):
    chunks = spark.createDataFrame(ROWS, CHUNKS)
    got = suites.bm25_cases(chunks, [("x", "agent memory"), ("y", "planning here")], 10).collect()
    for case, query in (("x", "agent memory"), ("y", "planning here")):
        one = search.bm25_chunks(chunks, query, 10).collect()
        assert [(r["rank"], r["chunk_id"], round(r["score"], 9), r["coverage"]) for r in sorted(one)] == sorted((r["rank"], r["chunk_id"], round(r["score"], 9), r["coverage"]) for r in got if r["case_id"] == case)


def test_candidates_limit_statistics_and_hits(spark):
    chunks = spark.createDataFrame(ROWS, CHUNKS)
    own = spark.createDataFrame([("x", "p1"), ("x", "p1"), ("x", "p2")], "case_id string, paper_id string")
    got = suites.bm25_cases(chunks, [("x", "agent memory")], 10, own).collect()
    alone = search.bm25_chunks(chunks.where("paper_id <> 'p3'"), "agent memory", 10).collect()
    assert sorted((r["chunk_id"], round(r["score"], 9)) for r in got) == sorted((r["chunk_id"], round(r["score"], 9)) for r in alone)


def test_vector_cases_and_hybrid_suite(spark):
    chunks = spark.createDataFrame(ROWS, CHUNKS)
    vectors = spark.createDataFrame([("p1", "a", [1.0, 0.0]), ("p2", "c", [0.0, 1.0]), ("p3", "d", [1.0, 1.0]), ("p4", "e", [1.0])], "paper_id string, chunk_id string, vector array<double>")
    got = suites.vector_cases(vectors, [("x", [1.0, 0.0]), ("y", [0.0, 1.0])], 2).orderBy("case_id", "rank").collect()
    assert [(r["case_id"], r["chunk_id"]) for r in got] == [("x", "a"), ("x", "d"), ("y", "c"), ("y", "d")]
    judged = spark.createDataFrame([("x", "p1", 3), ("x", "p2", 0), ("x", "p3", 1)], "case_id string, paper_id string, relevance int")
    fused, metrics, summary = suites.hybrid_suite(chunks, vectors, [("x", "agent memory")], [("x", [1.0, 0.0])], judged, (1, 5))
    assert [r["paper_id"] for r in fused.orderBy("rank").collect()][0] == "p1" and summary.first()["macro_reciprocal_rank"] == 1.0 and metrics.count() == 2
    with pytest.raises(ValueError):
        suites.vector_cases(vectors, [])


def test_source_records(spark):
    df = spark.createDataFrame([("2401.01234v3", " A  title ", "An\nabstract", ["X", " "], "2024-01-02 00:00:00", "2024-02-02 00:00:00"), ("2401.1", "***", None, None, None, None)], "short_id string, title string, summary string, authors array<string>, published string, updated string")
    df = df.withColumn("published", F.col("published").cast("timestamp")).withColumn("updated", F.col("updated").cast("timestamp"))
    row = records.from_preprints(df).collect()
    assert len(row) == 1 and (row[0]["title"], row[0]["abstract"], len(row[0]["authors"]), row[0]["base_urls"]["arxiv_pdf_url"]) == ("A title", "An abstract", 1, "https://arxiv.org/pdf/2401.01234")
    history = [r[0] for r in df.select(records.version_history(F.col("short_id"), F.col("published"), F.col("updated"))).collect()]
    assert [tuple(x) for x in history[0]] == [("v3", "2024-01-02"), ("latest", "2024-02-02")] and [tuple(x) for x in history[1]] == [("v1", "")]
    notes = spark.createDataFrame([("f1", '{"title": {"value": "T"}, "authors": {"value": ["A B"]}, "keywords": ["k"], "pdf": "/pdf/x.pdf", "venue": "ICLR 2024 oral"}')], "forum string, content string")
    note = records.from_reviews(notes, "ICLR", 2024, "https://reviews.example").first()
    assert (note["title"], note["authors"][0]["name"], note["keywords"], note["base_urls"]["openreview_pdf_url"], note["more_urls"]["accept_type"]) == ("T", "A B", ["k"], "https://reviews.example/pdf/x.pdf", "Oral")
    volume = spark.createDataFrame([("T", "A, B", "abs", "u", "p", "2024", "1", "9")], "title string, authors_text string, abstract string, abs_url string, pdf_url string, publication_date string, firstpage string, lastpage string")
    assert [a["name"] for a in records.from_volume(volume, "V 2024", "http://v").first()["authors"]] == ["A", "B"]


def test_source_rules(spark):
    df = spark.createDataFrame([("Technical Track on ML", "Vol 38: Special Track", "Text Show more", "/virtual/2024/poster/77", "2026/03/17", "2024.main.12", " a1 "), ("IAAI Technical Track", None, "Abstract text", "x", None, "none", "a/b")], "t string, i string, a string, u string, d string, n string, p string")
    c = F.col
    got = [tuple(r) for r in df.select(records.track_type(c("t"), c("i")), records.kept_section(c("t"), ["technical track"], ["IAAI"]), records.issue_decision(c("t"), ["technical track"], ["IAAI"]), records.clean_abstract(c("a")), records.event_number(c("u")), records.dashed_date(c("d")), records.anthology_number(c("n")), records.safe_id(c("p"))).collect()]
    assert got == [("special", True, "KEEP", "Text", "77", "2026-03-17", 12, "a1"), ("technical", False, "MIXED", "text", "", "", 10**12, None)]
    pairs = spark.createDataFrame([(["A", "B"], ["X"]), (["A"], ["X", "Y"]), (None, None)], "n array<string>, a array<string>").select(records.paired(c("n"), c("a"))).collect()
    assert [[(x["name"], x["affiliation"]) for x in r[0]] for r in pairs] == [[("A", "X"), ("B", "")], [("A", "X")], []]
    checks = spark.sql("select array(named_struct('name', 'c', 'passed', true, 'score', 1D, 'weight', 2D, 'critical', false)) x").select(records.stored_checks(c("x"))).first()[0]
    assert checks["c"]["weight"] == 2.0


def test_saved_rankings_are_read_and_checked(spark):
    saved = [("a", '{"paper_search_result": {"hits": [{"paper_id": " x "}, {"paper_id": "y"}]}}'), ("b", "{}"), ("c", '{"paper_search_result": {"hits": [{"paper_id": " "}]}}'), ("d", '{"paper_search_result": {"hits": [{"paper_id": "x"}, {"paper_id": "x"}]}}'), ("e", None), ("f", "no json"), ("g", '{"paper_search_result": {"hits": []}}')]
    good, bad = evaluate.saved_ranking(spark.createDataFrame(saved, "case_id string, j string"), "j")
    assert [tuple(r) for r in good.orderBy("rank").collect()] == [("a", 1, "x"), ("a", 2, "y")]
    assert {tuple(r) for r in bad.collect()} == {("b", "no_hits"), ("c", "hit_without_id"), ("d", "repeated_id"), ("e", "no_hits"), ("f", "no_hits")}


def test_results_must_belong_to_the_dataset(spark):
    cases = spark.createDataFrame([("a", "q"), ("b", "r"), ("c", "s"), ("c", "s")], "case_id string, query string")
    results = spark.createDataFrame([("a", "q"), ("b", "other"), ("c", "s"), ("z", "q")], "case_id string, query string")
    assert {tuple(r) for r in evaluate.unsound_cases(results, cases).collect()} == {("b", "another_query"), ("c", "case_twice_in_dataset"), ("z", "unknown_case")}


def test_single_rows_united_ids_and_counters(spark):
    df = spark.createDataFrame([("k", 1), ("k", 1), ("l", 2)], "key string, n int")
    assert store.by_key(df, "key", "k").count() == 1 and store.by_key(df, "key", "none").count() == 0
    parts = [spark.createDataFrame(x, "paper_id string") for x in ([("b",), ("a",)], [("b",), ("c",)])]
    assert fusion.united_ids(*parts).first()["ids"] == ["a", "b", "c"]
    runs = spark.createDataFrame([("ok", True), ("ok", True), (None, False)], "status string, retried boolean")
    assert {tuple(r) for r in quality.run_counters(runs, ["status", "retried"]).collect()} == {("ok", "true", 2), ("<missing>", "false", 1), ("all", "all", 3)}
