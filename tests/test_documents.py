import pytest
from pyspark.sql import functions as F

from folioflow.functions import hashing, ids, lookup, text, vector
from folioflow.operators import assets, dossier, lexical, markdown, merge, quality, search, store
from folioflow.operators.markdown import ChunkSizes, blocks_of, chunks_of, heading_of

DOCUMENT = """<!-- page: 1 -->

1 Introduction

First paragraph of text.
It goes on.

| a | b |
|---|---|

$$ x = y $$

<!-- page: 2 -->

1.1 Background

Figure 1: a caption

2 Methods

THE LAST PART

### C.3 MEMORY DETAILS
"""


def test_blocks_carry_kind_page_and_section():
    blocks, warnings = blocks_of(DOCUMENT)
    assert [(b.kind, b.page, b.path) for b in blocks] == [
        ("heading", 1, ("1 Introduction",)), ("paragraph", 1, ("1 Introduction",)), ("table", 1, ("1 Introduction",)), ("formula", 1, ("1 Introduction",)), ("heading", 2, ("1 Introduction", "1.1 Background")),
        ("caption", 2, ("1 Introduction", "1.1 Background")), ("heading", 2, ("2 Methods",)), ("heading", 2, ("THE LAST PART",)), ("heading", 2, ("THE LAST PART", "C.3 MEMORY DETAILS")),
    ]
    assert warnings == [] and blocks_of("plain")[1] == ["missing_page_markers_assumed_page_1"]
    assert blocks_of("<!-- page: 2 -->\na\n\n<!-- page: 2 -->\nb")[1] == ["page_markers_not_strictly_increasing"]
    assert blocks_of(" \n ")[0] == []


@pytest.mark.parametrize(
    ("line", "level"),
    [("1.2 Title", 2), ("A short sentence.", 1), ("## Plain title", 2), ("# 2.1.3 Deep", 3), ("ABSTRACT", 1), ("Abstract", 1), ("WHOLE LINE LOUD", 1), ("ordinary text here", None), ("| 1 Table", None), ("x = y", None), ("1 " + "w" * 150, None)],
)
def test_headings(line, level):
    found = heading_of(line)
    assert (found and found.level) == level


def test_chunks_respect_sizes_and_repeat():
    paragraphs = [f"Paragraph {i} " + "with several words " * 20 for i in range(40)]
    body = "\n\n".join(paragraphs) + "\n\n" + "Long text. " * 800
    sizes = ChunkSizes(target=1200, most=1600, overlap=200, heading_break=400)
    got = chunks_of(body, sizes)
    assert got == chunks_of(body, sizes) and len(got) > 10 and all(len(c[0]) <= sizes.most for c in got)
    assert any(got[i + 1][0][:40] in got[i][0] for i in range(len(got) - 1))
    table = "| a |\n" * 1000
    assert len(chunks_of(table, sizes)) == 1
    with pytest.raises(ValueError):
        ChunkSizes(target=10, most=5)


def test_markdown_frames(spark):
    df = spark.createDataFrame([("d", DOCUMENT), ("n", None), ("e", "")], "paper_id string, markdown string")
    assert markdown.markdown_blocks(df, "paper_id").count() == 9
    chunks = markdown.markdown_chunks(df, "paper_id").collect()
    assert len(chunks) == 1 and (chunks[0]["page_start"], chunks[0]["page_end"], chunks[0]["section_path"]) == (1, 2, ["THE LAST PART", "C.3 MEMORY DETAILS"])


def test_title_key(spark):
    df = spark.createDataFrame([("Attention Is All You Need", None), ("  attention -- is ALL you need!", " "), ("***", None), (None, "AB")], "t string, p string")
    got = [tuple(r) for r in df.select(ids.paper_id_from_title(F.col("t")), ids.canonical_paper_id(F.col("p"), F.col("t"))).collect()]
    key = "37f63852cdfb06903c168047e6c126a27c055cd9"
    assert got == [(key, key), (key, key), (None, None), (None, "ab")]


def test_merge_fills_and_upgrades(spark):
    rows = [
        (1, "k", "arXiv", "arXiv 2024", "", None), (2, "k", "arXiv", "NLAS 2024", "Title", ["x"]), (3, "k", "Site", "", "Other", []), (4, "k", "Mirror", "ICRM 2024", None, ["y"]), (5, "k", "Third", "AIMR 2025", None, None),
        (1, "m", "Site", "", "T", None), (2, "m", "Site", "arXiv 2020", "U", None), (3, "m", "Site", "COGAI", None, None), (1, None, "Site", "v", "t", None),
    ]
    df = spark.createDataFrame(rows, "seq int, key string, source string, venue string, title string, cats array<string>")
    got = {r["key"]: r for r in merge.merged_records(df, "key", [F.col("seq")], ["title"], "venue", "source", "cats").collect()}
    assert (got["k"]["merged_title"], got["k"]["merged_venue"], got["k"]["sources"], got["k"]["categories"], got["k"]["arrivals"]) == ("Title", "ICRM 2024", ["Mirror", "Site", "Third", "arXiv"], ["x", "y"], 5)
    assert (got["m"]["merged_title"], got["m"]["merged_venue"]) == ("T", "arXiv 2020") and set(got) == {"k", "m"}


def test_migration(spark):
    df = spark.createDataFrame([(1, "v", 2, None), (2, None, None, "b")], "id int, old string, schema_version int, note string")
    got = merge.migrated(df, {"old": "new"}, {"new": F.lit(""), "note": F.lit("n"), "extra": F.lit(0)}, 4).orderBy("id").collect()
    assert [(r["new"], r["schema_version"], r["note"], r["extra"]) for r in got] == [("v", 4, "n", 0), ("", 4, "b", 0)]


def test_store_predicates_and_counts(spark):
    rows = [(1, "a", ["x"], {"u": "1"}, 0), (2, "", [], {}, None), (3, None, None, None, 5)]
    df = spark.createDataFrame(rows, "id int, s string, a array<string>, m map<string,string>, n int")
    assert [r["id"] for r in store.non_empty(df, ["s", "a", "m.u"]).collect()] == [1]
    assert [r["id"] for r in store.non_empty(df, ["n"]).orderBy("id").collect()] == [1, 3]
    assert [r["id"] for r in store.equals(df, "a", "x").collect()] == [1]
    assert {tuple(r) for r in store.group_counts(df, "s").collect()} == {("a", 1), ("<empty>", 1), ("<missing>", 1)}
    got = {r["field"]: (r["missing"], r["examples"]) for r in store.completeness(df, ["s", "m.u", "n", "id"], "id", 1).collect()}
    assert got == {"s": (2, [2]), "m.u": (2, [2]), "n": (1, [2]), "id": (0, None)}
    keys = spark.createDataFrame([(1,), (1,), (9,)], "k int")
    assert store.by_keys(df, "id", keys).count() == 1 and [r["id"] for r in store.missing_keys(df, "id", keys).collect()] == [9]


def test_backfill_skips_unusable(spark):
    candidates = spark.createDataFrame([(i, f"p{i}") for i in range(1, 6)], "rank int, paper_id string")
    states = spark.createDataFrame([("p1", "ok"), ("p2", None), ("p4", "ok"), ("p5", "ok")], "paper_id string, url string")
    assert [r["paper_id"] for r in store.backfilled(candidates, states, "paper_id", "rank", F.col("url").isNotNull(), 3).collect()] == ["p1", "p4", "p5"]
    assert [r["place"] for r in store.backfilled(candidates, states, "paper_id", "rank", F.col("url").isNotNull(), 3).collect()] == [1, 2, 3]


@pytest.mark.parametrize("literal", [0, 512])
def test_configured_values(spark, literal, monkeypatch):
    monkeypatch.setattr(lookup.literal_lookup, "__defaults__", (literal,))
    config = spark.createDataFrame([("a", "slow"), ("a", "fast"), (None, "x")], "host string, speed string")
    got = store.configured(spark.createDataFrame([("a",), ("b",), (None,)], "host string"), config, "host", "speed", "normal").collect()
    assert {(r["host"], r["speed"]) for r in got} == {("a", "slow"), ("b", "normal"), (None, "normal")}


def test_url_candidates_keep_where_they_came_from(spark):
    df = spark.createDataFrame([({"x": " u1 ", "y": "u1", "z": ""}, ("u2",))], "m map<string,string>, s struct<deep: string>")
    got = df.select(store.url_candidates(df, {"one": ["m.y", "m.z", "m.none"], "two": ["m.x", "s.deep"]}).alias("c")).first()["c"]
    assert [tuple(c) for c in got] == [("u1", "one", "m.y"), ("u2", "two", "s.deep")]


def test_numbers_over_all_rows(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") * 37 % 101).alias("v")).repartition(7)
    got = search.numbered_all(df, [F.desc("v"), F.asc("id")]).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 1001)) and [(-r["v"], r["id"]) for r in got] == sorted((-r["v"], r["id"]) for r in got)
    assert search.numbered_all(df.limit(0), [F.asc("id")]).count() == 0


def test_topic_recall_strict_then_loose(spark):
    rows = [("a", "Agent planning", "x"), ("b", "Planning only", "text"), ("c", "Other", "agents everywhere"), ("d", "", "agent planning"), ("e", "Unrelated", None)]
    df = spark.createDataFrame(rows, "paper_id string, title string, abstract string")
    fields = (lexical.TopicField("title", 4.0, 12.0), lexical.TopicField("abstract", 1.5, 6.0))
    got = [(r["paper_id"], r["score"], r["matched_fields"]) for r in lexical.topic_recall(df, "Agent planning", fields, 5).orderBy("rank").collect()]
    assert got == [("a", 25.0, ["title"]), ("b", 6.5, ["title"]), ("c", 4.0, ["abstract"])]
    assert [r["paper_id"] for r in lexical.topic_recall(df, "Agent planning", fields, 1).collect()] == ["a"]


def test_fuzzy_titles(spark):
    df = spark.createDataFrame([("a", "Memory in Agents"), ("b", "A Memory in Agents: Survey"), ("c", "Nothing alike"), ("d", None)], "paper_id string, title string")
    assert [(r["paper_id"], r["score"]) for r in lexical.fuzzy_titles(df, "memory in agents").collect()] == [("a", 1.0), ("b", 1.0)]
    assert [r["paper_id"] for r in lexical.fuzzy_titles(df, "memry in agents").collect()] == ["a", "b"]
    with pytest.raises(ValueError):
        lexical.fuzzy_titles(df, "!!!")


def test_quality(spark):
    body = "<!-- page: 1 -->\n\nGood Title\n\n" + "words " * 100 + "\n\n<!-- page: 2 -->\n\n" + "more " * 100
    good = {"status": "success", "page_count": 2, "pages": [(0, True), (1, True)]}
    bad = {"status": "failed", "page_count": 2, "pages": [(0, True), (1, False)]}
    size = len(body.replace("<!-- page: 1 -->", "").replace("<!-- page: 2 -->", "").strip())
    rows = [("ok", "Good Title", body, 2, size, good), ("odd", "Quite Another Name", body, 2, size, good), ("bad", "Good Title", body, 2, size, bad), ("none", "T", None, 2, 0, good), ("plain", "", body, 2, size, None), ("pages", "Good Title", body, 3, size, None)]
    df = spark.createDataFrame(rows, "id string, title string, markdown string, page_count int, char_count int, report struct<status:string,page_count:int,pages:array<struct<page_index:int,success:boolean>>>")
    got = {r["id"]: r for r in quality.quality_checks(df, "id").collect()}
    assert {k: r["status"] for k, r in got.items()} == {"ok": "passed", "odd": "warning", "bad": "rejected", "none": "rejected", "plain": "passed", "pages": "rejected"}
    assert got["none"]["score"] == 0.0 and got["ok"]["score"] >= 0.8 and sum(c["weight"] for c in got["plain"]["checks"]) == 12.0


def test_chunk_assets(spark):
    ok = ("a" * 64, "p", 0, "text", 4, "982d9e3eb996f559e633f4d194def3761d909f5a3b647d1a851fead67c32c9d1", 1, 1)
    rows = [ok, ("b" * 64, "p", 2, "text", 4, ok[5], 1, 1), ("c" * 64, "q", 0, "text", 5, ok[5], 1, 1), ("short", "r", 0, "text", 4, ok[5], 1, 1), ("d" * 64, "s", 0, "text", 4, "0" * 64, 1, 1), ("e" * 64, "t", 0, "text", 4, ok[5], 2, 1)]
    df = spark.createDataFrame(rows, "chunk_id string, paper_id string, chunk_index int, text string, char_count int, content_sha256 string, page_start int, page_end int")
    got = {r["chunk_id"][:1]: r["reason"] for r in assets.chunk_reasons(df.unionByName(df)).collect()}
    assert got == {"a": None, "b": "index_not_continuous", "c": "char_count_mismatch", "s": "bad_chunk_id", "d": "content_hash_mismatch", "e": "bad_pages"}
    assert [(r["paper_id"], r["chunk_count"]) for r in assets.manifests(df.unionByName(df)).orderBy("paper_id").collect()][0] == ("p", 2)


def test_hash_embedding(spark):
    df = spark.createDataFrame([("a b c",), ("A, b c!",), ("a b d",), ("???",), (" ",), (None,)], "t string")
    made = [r[0] for r in df.select(vector.token_hash_embedding(F.col("t"), 32)).collect()]
    assert made[0] == made[1] != made[2] and made[4] is None and made[5] is None and len(made[3]) == 32
    assert all(abs(sum(x * x for x in v) - 1) < 1e-9 for v in made[:4])


def test_text_functions(spark):
    df = spark.createDataFrame([("ICLR 2023 notable top 25%", 2048, "  a  b\nc  "), ("X 2024 spotlight", 0, "a|b"), ("Venue main", 10**15, None), (None, 1023, "x" * 9)], "v string, n bigint, t string")
    got = [tuple(r) for r in df.select(text.accept_type(F.col("v")), text.human_bytes(F.col("n")), text.preview(F.col("t"), 5, "..."), text.markdown_cell(F.col("t"))).collect()]
    assert got == [("Notable Top 25%", "2.00 KiB", "a b c", "a  b c"), ("Spotlight", "0.00 B", "a|b", "a\\|b"), ("Main", "909.49 TiB", "", ""), ("", "1023.00 B", "xxxxx...", "x" * 9)]
    urls = spark.createDataFrame([("https://A.B.example/x",), ("ftp://u@h.org:21/",), ("about:blank",), (None,)], "u string")
    assert [r[0] for r in urls.select(text.hostname(F.col("u"))).collect()] == ["a.b.example", "h.org", None, None]
    names = spark.createDataFrame([(" A, B ,, C",), (None,)], "n string")
    assert [r[0] for r in names.select(text.split_names(F.col("n"))).collect()] == [["A", "B", "C"], []]


def test_ids_and_json(spark):
    import hashlib
    import json

    df = spark.createDataFrame([("c", "m", "1", 64, "é/")], "a string, b string, v string, d int, s string")
    row = df.select(hashing.canonical_json({"z": F.col("d"), "a": F.col("s"), "n": F.lit(None).cast("string")}), hashing.embedding_id(F.col("a"), F.col("b"), F.col("v"), F.col("d"), F.col("s"))).first()
    assert row[0] == json.dumps({"a": "é/", "n": None, "z": 64}, ensure_ascii=False, separators=(",", ":"))
    assert row[1] == hashlib.sha256("c\nm\n1\n64\né/".encode()).hexdigest()


def test_literal_lookup_is_bounded(spark):
    df = spark.createDataFrame([(f"k{i}", i) for i in range(5)] + [(None, 9)], "k string, v int")
    found = lookup.literal_lookup(df, F.col("k"), F.col("v"))
    assert [r[0] for r in df.select(found(F.col("k"))).collect()] == [0, 1, 2, 3, 4, None]
    assert lookup.literal_lookup(df, F.col("k"), F.col("v"), rows=4) is None
    assert df.select(lookup.literal_lookup(df.limit(0), F.col("k"), F.col("v"))(F.col("k"))).first()[0] is None
    assert lookup.fresh_names(df, "K", "x") == ["K_", "x"]


def test_dossier(spark):
    ranking = spark.createDataFrame([(1, "p1", 2.5), (2, "p2", 1.0)], "rank int, paper_id string, score double")
    titles = spark.createDataFrame([("p1", "A | B")], "paper_id string, title string")
    evidence = spark.createDataFrame([("p1", 1, "c", "some  text", 1, 2, ["S"])], "paper_id string, rank int, chunk_id string, text string, page_start int, page_end int, section_path array<string>")
    whole = dossier.dossier(ranking, titles, evidence, "topic", "query")
    text_ = whole.first()["text"]
    assert "| 1 | A \\| B | 2.5000 |" in text_ and "| 2 | p2 | 1.0000 |" in text_ and "- p. 1-2 (S): some text" in text_ and "No evidence." in text_
    parts = whole.select(dossier.overview_of(F.col("text")).alias("o"), dossier.paper_sections(F.col("text"), 1).alias("s")).first()
    assert parts["o"].startswith("| rank |") and parts["s"].startswith("### 1. ") and "### 2." not in parts["s"]
