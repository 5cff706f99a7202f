import hashlib
import json

import pytest
from pyspark.sql import functions as F

from folioflow.functions import hashing, vector
from folioflow.operators import assets, embed, rerank
from folioflow.sources import paged

CHUNK = (
    "chunk_id string, paper_id string, chunk_index bigint, text string, content_sha256 string, page_start bigint, page_end bigint, section_path array<string>, source_markdown_relative_path string, source_markdown_sha256 string, "
    "source_pdf_sha256 string, source_parser_name string, source_parser_version string, splitter_name string, splitter_version string, splitter_options map<string,bigint>, metadata string"
)


def chunk(no=0, text="some text", paper="p", section=("A",), markdown="m", options=None):
    return (f"{paper}-{no}", paper, no, text, hashlib.sha256((text or "").encode()).hexdigest(), 1, 2, list(section), "a.md", markdown, "pdf", "parser", "1", "blocks", "2", options or {"most": 3200, "a": 1}, "clash")


@pytest.mark.parametrize("section", [(), ("plain", "Ünïcode “x” \"q\" / \\"), ("tab\tline\nfeed\rback\bform\f",), ("\x01\x0b\x0e\x1f end", "literal \\u000B and \x0b", "\x7f  ")])
def test_chunk_ids_are_those_of_canonical_json(spark, section):
    row = chunk(section=section)
    fields = dict(zip([c.split()[0] for c in CHUNK.split(", ")], row))
    payload = {k: fields[k] for k in hashing.CHUNK_FIELDS if k != "schema_version"} | {"schema_version": 1}
    want = hashlib.sha256(json.dumps(payload, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    assert spark.createDataFrame([row], CHUNK).select(hashing.chunk_id()).first()[0] == want


def test_subchunks_count_without_gaps_and_keep_single_ids(spark):
    rows = [chunk(0, "a" * 10), chunk(1, "b" * 10 + " " * 20 + "c" * 5), chunk(2, ""), chunk(3, None), chunk(0, "a" * 10)]
    made = embed.chunk_embeddings(spark.createDataFrame(rows, CHUNK), lambda df, c: df.withColumn("vector", vector.token_hash_embedding(F.col(c), 8)), "m", "v", 8, 10, 2)
    got = sorted((r["chunk_id"], r["metadata"]["subchunk_index"], r["metadata"]["subchunk_count"], r["metadata"]["char_start"], r["metadata"]["is_subchunk"]) for r in made.collect())
    assert got[0] == ("p-0", 0, 1, 0, False) and [g[0] for g in got[1:]] == [f"p-1::subchunk-{i:04d}" for i in range(len(got) - 1)]
    assert len({g[2] for g in got[1:]}) == 1 and got[1][2] == len(got) - 1 and all(g[4] for g in got[1:])
    first = made.where("chunk_id = 'p-0'").first()
    assert first["embedding_id"] == hashlib.sha256("\n".join(["p-0", "m", "v", "8", first["source_chunk_sha256"]]).encode()).hexdigest() and len(first["vector"]) == 8


def test_vectors_from_a_service(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None), (3, "c")], "id int, text string")
    assert [r["vector"] for r in paged.embedded(df, "text", lambda texts: [[float(len(t)), 0.0] for t in texts], 2, batch=1).orderBy("id").collect()] == [[2.0, 0.0], None, [1.0, 0.0]]
    with pytest.raises(Exception, match="a vector of 1 numbers"):
        paged.embedded(df, "text", lambda texts: [[1.0] for _ in texts], 2).collect()


def test_evidence_is_merged_cut_and_ranked(spark):
    evidence = spark.createDataFrame(
        [("p", "c1", "x" * 25, "vector", 1), ("p", "c1", "x" * 25, "bm25", 0), ("p", "c2", "one", "vector", 1), ("p", "c2", "two", "vector", 1), ("q", "c3", "q text", "vector", 1), ("r", "c4", "r", "bm25", 0), ("", "c5", "t", "bm25", 0), ("p", "c6", "", "bm25", 0)],
        "paper_id string, chunk_id string, text string, source string, place int",
    )
    ranking = spark.createDataFrame([(1, "q"), (2, "p"), (3, "r")], "rank int, paper_id string")
    cut = rerank.rerank_segments(ranking, evidence, 2, 10, 2).orderBy("segment_id").collect()
    assert [r["segment_id"] for r in cut] == ["c1::rerank-segment-0000", "c1::rerank-segment-0001", "c1::rerank-segment-0002", "c2", "c3"]
    assert cut[0]["sources"] == ["bm25", "vector"] and [r["conflict"] for r in cut] == [False] * 3 + [True, False] and {r["original_rank"] for r in cut} == {1, 2}
    scored = spark.createDataFrame([("p", "c1", "c1", 0.5), ("z", "c9", "c9", 0.9)], "paper_id string, chunk_id string, segment_id string, score double")
    got = rerank.with_original_rank(rerank.reranked_papers(scored), ranking).orderBy("rank").collect()
    assert [(r["rank"], r["paper_id"], r["original_rank"]) for r in got] == [(1, "z", 0), (2, "p", 2)]
    texts = spark.createDataFrame([(3, 0.5), (1, 0.5), (2, None), (4, float("nan")), (5, 0.7)], "place int, score double")
    assert [r["place"] for r in rerank.ranked_texts(texts, "place", 2).orderBy("rank").collect()] == [5, 1]


def test_manifest_reasons(spark):
    chunks = spark.createDataFrame([chunk(i, paper=p) for p in "abcd" for i in range(3)] + [chunk(0, paper="a")], CHUNK).withColumn("folder", F.col("paper_id"))
    one = chunks.groupBy("folder").agg(*[F.min(c).alias(c) for c in ("paper_id", "splitter_name", "splitter_version", "source_markdown_sha256", "source_pdf_sha256", "source_parser_name", "source_parser_version")])
    one = one.withColumn("splitter_options", F.create_map(F.lit("most"), F.lit(3200).cast("bigint"), F.lit("a"), F.lit(1).cast("bigint"))).withColumn("chunks_path", F.lit("x"))
    made = one.join(assets.manifests(chunks).select(F.col("paper_id").alias("folder"), "chunk_count", "chunk_ids"), "folder").join(assets.lines_sha256(chunks).withColumnRenamed("paper_id", "folder"), "folder")
    expected = made.select("folder", *[F.col(c).alias(f"e_{c}") for c in ("paper_id", "splitter_name", "splitter_version", "chunks_path")], F.create_map(F.lit("a"), F.lit(1).cast("bigint"), F.lit("most"), F.lit(3200).cast("bigint")).alias("e_splitter_options"))
    reasons = lambda m, c: {r["folder"]: r["reason"] for r in assets.manifest_reasons(m, c, expected).collect()}
    assert reasons(made, chunks) == dict.fromkeys("abcd")
    gone = chunks.where("not (folder = 'a' and chunk_index = 1) and folder <> 'b'").withColumn("source_pdf_sha256", F.when(F.col("folder") == "c", F.lit(None)).otherwise(F.col("source_pdf_sha256")))
    assert reasons(made, gone) == {"a": "chunk_count", "b": "chunk_count", "c": "chunk_pdf_sha256", "d": None}
    assert assets.manifest_reasons(made.limit(0), chunks, expected).collect() == []
