import json

import pytest
from pyspark.sql import functions as F

from folioflow.sources import files, html, paged
from folioflow.streaming import ingest

CHUNK = {"chunk_id": "c1", "paper_id": "p1", "chunk_index": 0, "text": "line\nfeed", "char_count": 9, "section_path": ["A"], "page_start": 1, "page_end": 1}


def test_json_lines_with_bad_lines(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.jsonl").write_text(json.dumps(CHUNK) + "\n\n{broken\n")
    rows, bad = files.read_json_lines(spark, str(tmp_path), files.CHUNK)
    assert [r["text"] for r in rows.collect()] == ["line\nfeed"] and [r["line"] for r in bad.collect()] == ["{broken"]


def test_chunk_assets_are_written_once(spark, tmp_path):
    schema = "paper_id string, chunk_index bigint, chunk_id string, text string"
    first = spark.createDataFrame([("p1", 0, "a", "x"), ("p1", 1, "b", "y"), ("p2", 0, "c", "z")], schema)
    path = str(tmp_path / "assets")
    assert {tuple(r) for r in files.write_chunk_assets(first, path).collect()} == {("p1", "written"), ("p2", "written")}
    second = spark.createDataFrame([("p1", 1, "b", "y"), ("p1", 0, "a", "x"), ("p2", 0, "c", "changed")], schema)
    assert {tuple(r) for r in files.write_chunk_assets(second, path).collect()} == {("p1", "reused"), ("p2", "written")}
    chunks, missing = files.read_chunk_assets(spark, path, spark.createDataFrame([("p1",), ("p2",), ("p3",)], "paper_id string"))
    assert sorted((r["chunk_id"], r["text"]) for r in chunks.collect()) == [("a", "x"), ("b", "y"), ("c", "changed")] and [r[0] for r in missing.collect()] == ["p3"]


def test_id_list_and_folder_statistics(spark, tmp_path):
    path = tmp_path / "ids.txt"
    path.write_text("# head\n p2 \n\np1\na/b\np2\n")
    assert [r["paper_id"] for r in files.read_id_list(spark, str(path)).orderBy("position").collect()] == ["p2", "p1"]
    folder = tmp_path / "pdf"
    folder.mkdir()
    (folder / "a.pdf").write_bytes(b"%PDF-" + b"x" * 2000)
    (folder / "b.PDF").write_bytes(b"12")
    (folder / "c.pdf").write_bytes(b"%PDF-")
    (folder / "d.pdf").write_bytes(b"x" * 3000)
    assert {tuple(r) for r in files.folder_statistics(spark, str(folder)).collect()} == {(".pdf", 4, 5012)}
    assert {r["path"][-5:]: r["reason"] for r in files.pdf_reasons(spark, str(folder)).collect()} == {"a.pdf": None, "c.pdf": "too_small", "d.pdf": "bad_header"}


def test_evaluation_and_outcomes(spark, tmp_path):
    path = tmp_path / "eval.json"
    path.write_text(json.dumps({"dataset_id": "d", "cases": [{"case_id": "c", "query": "q", "tags": ["t"], "candidate_paper_ids": ["a", "b"], "judgments": [{"paper_id": "a", "relevance": 3}]}]}, indent=1))
    cases, judged = files.read_evaluation(spark, str(path))
    assert cases.first()["query"] == "q" and {tuple(r) for r in judged.collect()} == {("c", "a", 3), ("c", "b", 0)}
    flow = tmp_path / "flow.json"
    flow.write_text(json.dumps({"topic": "t", "outcomes": [{"paper_id": "x", "title": "X", "ready": True}, {"paper_id": "y", "ready": False}, {"paper_id": "x", "title": "Z", "ready": True}]}))
    assert [tuple(r) for r in files.read_ready_outcomes(spark, str(flow)).collect()] == [(0, "x", "X")]


def test_paged_source(spark):
    def fetch(part, options):
        yield from ((part, int(options["first"]) + i) for i in range(2))

    spark.dataSource.register(paged.paged_source("two_rows", "part string, n int", ["cs.AI", "cs.CL"], fetch))
    assert sorted(map(tuple, spark.read.format("two_rows").option("first", "5").load().collect())) == [("cs.AI", 5), ("cs.AI", 6), ("cs.CL", 5), ("cs.CL", 6)]


def test_scores_must_be_complete(spark):
    df = spark.createDataFrame([(i, f"t{i}" if i % 3 else None) for i in range(40)], "id int, text string")
    got = {r["id"]: r["score"] for r in paged.scored(df, "text", lambda texts: [float(t[1:]) for t in texts], 7).collect()}
    assert all(got[i] == (float(i) if i % 3 else None) for i in range(40))
    with pytest.raises(Exception, match="scores"):
        paged.scored(df, "text", lambda texts: [1.0], 7).collect()


def test_html(spark):
    page = '<html><meta name="Citation_Title" content="A &amp; B"><meta name="citation_author" content="X Y"><meta name="citation_author" content=" Z "><meta property="og:description" content="text"><a href="/1">one <b>two</b></a><a href="/2">x</a><a href="/1">again</a></html>'
    df = spark.createDataFrame([(page,), (None,), ("<p>broken",)], "p string")
    rows = df.select(html.article(F.col("p")).alias("a"), html.links(F.col("p")).alias("l"), html.meta_values(F.col("p"), "citation_AUTHOR").alias("m"), html.first_meta(F.col("p"), ["dc.title", "citation_title"]).alias("t")).collect()
    assert (rows[0]["a"]["title"], rows[0]["a"]["authors"], rows[0]["a"]["abstract"]) == ("A & B", ["X Y", "Z"], "text")
    assert [(x["href"], x["text"]) for x in rows[0]["l"]] == [("/1", "one two"), ("/2", "x")] and rows[0]["m"] == ["X Y", "Z"] and rows[0]["t"] == "A & B"
    assert rows[1]["a"]["title"] == "" and rows[2]["l"] == []


def test_merge_stream_and_event_counts(spark, tmp_path):
    source, folder = tmp_path / "in", str(tmp_path / "table")
    schema = "key string, seq int, title string, abstract string"
    spark.createDataFrame([("a", 1, "", "x"), ("a", 2, "T", "y"), ("b", 1, "B", None), (None, 1, "n", "n")], schema).write.parquet(f"{source}/1")
    run = lambda: ingest.merge_stream(spark.readStream.schema(schema).parquet(f"{source}/*"), folder, str(tmp_path / "cp"), "key", ["seq"], ["title", "abstract"]).awaitTermination()
    assert ingest.merged_table(spark, folder) is None
    run()
    spark.createDataFrame([("a", 0, "Late", "z"), ("b", 3, "C", "filled"), ("c", 1, "N", None)], schema).write.parquet(f"{source}/2")
    run()
    assert {tuple(r) for r in ingest.merged_table(spark, folder).collect()} == {("a", "Late", "z"), ("b", "B", "filled"), ("c", "N", None)}
    ingest.compact(spark, folder, f"{folder}-2")
    assert {tuple(r) for r in ingest.merged_table(spark, f"{folder}-2").collect()} == {("a", "Late", "z"), ("b", "B", "filled"), ("c", "N", None)}
    events = spark.sql("select timestamp_ntz'2026-01-01 10:00:00' ts, 'a' event_type, 1.0D value union all select timestamp_ntz'2026-01-01 23:00:00', 'a', 2.0D")
    row = ingest.event_counts(events).first()
    assert (row["n"], row["total"]) == (2, 3.0)
