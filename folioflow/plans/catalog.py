"""All registered queries of the core and their SQL equivalents.

Every query runs over its whole tables. Floating sums are rounded on both sides, since engines add in different orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions import hashing, text, vector
from folioflow.functions.ids import canonical_paper_id, normalized_title, paper_id_from_title
from folioflow.operators import assets, dossier, embed, evaluate, fusion, lexical, markdown, merge, quality, rerank, search, store, suites
from folioflow.session import table
from folioflow.sources import html, records
from folioflow.streaming import ingest

QUERY = "retrieval of passages with uncertain agents and long documents"
TOPIC = "retrieval-augmented planning"
SECOND_TOPIC = "agents that are using memory"
TOPIC_FIELDS = (lexical.TopicField("title", 4.0, 12.0), lexical.TopicField("abstract", 1.5, 6.0), lexical.TopicField("seen_in_categories", 2.5, is_array=True))
URL_SOURCES = {"acl": ["base_urls.acl_anthology_pdf_url"], "pmlr": ["base_urls.pmlr_pdf_url"], "openreview": ["base_urls.openreview_pdf_url"], "official": ["base_urls.official_pdf_url"], "arxiv": ["base_urls.arxiv_pdf_url", "base_urls.arxiv_url"]}
CASES = (("c1", "relevance of cautious rankers"), ("c2", "memory and agents under private data"), ("c3", "translation of long documents"))


def _chunks(spark, directory):
    return table(spark, directory, "chunks").dropDuplicates(["chunk_id"])


def _papers(spark, directory):
    """Crawl records with their key, each once."""
    papers = table(spark, directory, "papers").dropDuplicates(["record_no"])
    return papers.withColumn("key", canonical_paper_id(F.col("paper_id"), F.col("title")))


def _vectors(spark, directory):
    rows = table(spark, directory, "chunk_embeddings")
    return rows.where((F.col("embedding_model_version") == "openai-compatible-64") & (F.size("vector") == 64))


def _query_vector() -> list[float]:
    """A fixed direction: alternating weights that fall with the place."""
    return [(1.0 if i % 2 == 0 else -1.0) / (1.0 + i) for i in range(64)]


def title_keys(spark, directory):
    papers = table(spark, directory, "papers").dropDuplicates(["record_no"])
    return papers.select("record_no", normalized_title(F.col("title")).alias("normalized"), paper_id_from_title(F.col("title")).alias("title_id"), canonical_paper_id(F.col("paper_id"), F.col("title")).alias("key"))


def chunk_tokens(spark, directory):
    tokens = text.retrieval_tokens(F.col("text"))
    counted = table(spark, directory, "chunks").select("chunk_id", F.size(tokens).alias("tokens"), F.size(F.array_distinct(tokens)).alias("distinct_tokens"), F.size(text.section_weighted_tokens(F.col("text"), F.col("section_path"))).alias("weighted"))
    return counted.dropDuplicates(["chunk_id"])


def bm25_chunks(spark, directory):
    return search.bm25_chunks(table(spark, directory, "chunks"), QUERY, 300).select("rank", "paper_id", "chunk_id", F.round("score", 6).alias("score"), F.round("coverage", 6).alias("coverage"), F.array_join("terms", " ").alias("terms"))


def bm25_papers(spark, directory):
    hits = search.bm25_chunks(table(spark, directory, "chunks"), QUERY, 300)
    papers = search.relative_to_top(search.bm25_papers(hits, QUERY, 50))
    return papers.select("rank", "paper_id", *[F.round(c, 6).alias(c) for c in ("score", "best", "mean_top", "coverage", "relative")], "scoring_chunks")


def vector_chunks(spark, directory):
    hits = search.vector_chunks(_vectors(spark, directory), _query_vector(), 300, "embedding_id")
    return hits.select("rank", "paper_id", "embedding_id", F.round("score", 6).alias("score"))


def vector_papers(spark, directory):
    hits = search.vector_chunks(_vectors(spark, directory), _query_vector(), 300, "embedding_id")
    return search.vector_papers(hits, 50).select("rank", "paper_id", *[F.round(c, 6).alias(c) for c in ("score", "best", "mean_top")], "scoring_chunks")


def hybrid_papers(spark, directory):
    lexical_side = search.bm25_papers(search.bm25_chunks(table(spark, directory, "chunks"), QUERY, 300), QUERY, 50)
    vector_side = search.vector_papers(search.vector_chunks(_vectors(spark, directory), _query_vector(), 300, "embedding_id"), 50)
    fused = fusion.fuse(lexical_side.select("rank", "paper_id", "score"), vector_side.select("rank", "paper_id", "score"), 0.7, 0.3, 60)
    return fused.select("rank", "paper_id", *[F.round(c, 6).alias(c) for c in ("score", "rank_score", "primary_relative", "secondary_relative")])


def vector_norms(spark, directory):
    rows = table(spark, directory, "chunk_embeddings").where(vector.is_usable(F.col("vector")))
    measured = rows.select("embedding_no", F.size("vector").alias("size"), F.round(vector.norm(F.col("vector")), 6).alias("norm"), F.round(vector.norm(vector.normalized(F.col("vector"))), 6).alias("unit"))
    return measured.dropDuplicates(["embedding_no"])


def segments(spark, directory):
    cut = rerank.segments(table(spark, directory, "md_blocks").select("block_no", "text"), "text", 3200, 200)
    hashed = cut.select("block_no", "segment_index", "segment_count", "char_start", "char_end", F.sha2("segment", 256).alias("segment_hash"), rerank.segment_id(F.col("block_no").cast("string"), F.col("segment_index"), F.col("segment_count")).alias("segment_id"))
    return hashed.dropDuplicates(["block_no", "segment_index"])


def reranked_papers(spark, directory):
    """Segments of chunks scored by their share of distinct query terms, aggregated to chunks and papers."""
    terms = text.query_terms(QUERY)
    cut = rerank.segments(table(spark, directory, "chunks").select("paper_id", "chunk_id", "text"), "text", 400, 50)
    hits = F.size(F.array_intersect(text.retrieval_tokens(F.col("segment")), F.array(*[F.lit(t) for t in terms])))
    scored = cut.select("paper_id", "chunk_id", rerank.segment_id(F.col("chunk_id"), F.col("segment_index"), F.col("segment_count")).alias("segment_id"), (hits / len(terms)).alias("score"))
    return rerank.reranked_papers(scored).select("rank", "paper_id", F.round("score", 6).alias("score"), "chunks")


def _hybrid_evidence(spark, directory):
    """The hybrid ranking of a query, and the chunks that its papers owe their places to: up to three of each retriever."""
    chunks = table(spark, directory, "chunks")
    texts = search.bm25_chunks(chunks, QUERY, 300)
    near = search.vector_chunks(_vectors(spark, directory), _query_vector(), 300, "chunk_id")
    papers = search.bm25_papers(texts, QUERY, 50), search.vector_papers(near, 50)
    ranking = fusion.fuse(*[p.select("rank", "paper_id", "score") for p in papers], 0.7, 0.3, 60)
    parts = []
    for place, (name, hits) in enumerate((("bm25", texts), ("vector", near))):
        best = search.numbered(hits, [F.asc("rank")], ["paper_id"], "p").where("p <= 3")
        parts.append(best.select("paper_id", F.substring_index("chunk_id", "::", 1).alias("chunk_id"), F.lit(name).alias("source"), F.lit(place).alias("place")))
    known = store.by_keys(chunks.select("chunk_id", "text"), "chunk_id", parts[0].unionByName(parts[1]).select("chunk_id")).dropDuplicates(["chunk_id"])
    return ranking, parts[0].unionByName(parts[1]).distinct().join(known, "chunk_id")


def rerank_segments(spark, directory):
    ranking, evidence = _hybrid_evidence(spark, directory)
    cut = rerank.rerank_segments(ranking, evidence, 40, 400, 50)
    return cut.select("original_rank", "paper_id", "segment_id", "segment_count", "char_start", "char_end", "conflict", F.array_join("sources", "+").alias("sources"), F.sha2("segment", 256).alias("segment_hash"))


def reranked_hybrid(spark, directory):
    """The segments of a hybrid ranking scored by their share of query terms, aggregated to papers beside their places before."""
    ranking, evidence = _hybrid_evidence(spark, directory)
    terms = text.query_terms(QUERY)
    hits = F.size(F.array_intersect(text.retrieval_tokens(F.col("segment")), F.array(*[F.lit(t) for t in terms])))
    scored = rerank.rerank_segments(ranking, evidence, 40, 400, 50).withColumn("score", hits / len(terms))
    return rerank.with_original_rank(rerank.reranked_papers(scored), ranking).select("rank", "original_rank", "paper_id", F.round("score", 6).alias("score"), "chunks")


def reranked_texts(spark, directory):
    """The hundred blocks with the largest share of the query's terms, ties in order of the blocks."""
    terms = text.query_terms(QUERY)
    hits = F.size(F.array_intersect(text.retrieval_tokens(F.col("text")), F.array(*[F.lit(t) for t in terms])))
    rows = table(spark, directory, "md_blocks").select("block_no", (hits / len(terms)).alias("score")).distinct()
    return rerank.ranked_texts(rows, "block_no", 100).select("rank", "block_no", F.round("score", 6).alias("score"))


def chunk_ids(spark, directory):
    rows = table(spark, directory, "chunks")
    return rows.select("chunk_id", hashing.chunk_id().alias("made_id")).dropDuplicates(["chunk_id"])


def subchunk_embeddings(spark, directory):
    """Every chunk embedded by token hashing, in sub-chunks of 300 characters."""
    made = embed.chunk_embeddings(table(spark, directory, "chunks"), lambda df, column: df.withColumn("vector", vector.token_hash_embedding(F.col(column), 128)), "token-hash", "v1", 128, 300, 40)
    m = F.col("metadata")
    return made.select("embedding_id", "chunk_id", m["source_chunk_id"].alias("source_chunk_id"), m["subchunk_index"].alias("subchunk_index"), m["subchunk_count"].alias("subchunk_count"), m["char_start"].alias("char_start"), m["char_end"].alias("char_end"), m["is_subchunk"].alias("is_subchunk"), F.size("vector").alias("size"), F.round(vector.norm(F.col("vector")), 6).alias("norm"))


def manifest_reasons(spark, directory):
    """Manifests of all papers with a fault in most, by the last two digits of the paper's id, checked against the chunks."""
    chunks = table(spark, directory, "chunks").withColumn("folder", F.col("paper_id"))
    fault = F.conv(F.substring("folder", -2, 2), 16, 10).cast("int") % 16
    some = ("splitter_name", "splitter_version", "source_markdown_sha256", "source_pdf_sha256", "source_parser_name", "source_parser_version")
    facts = chunks.groupBy("folder").agg(*[F.min(c).alias(c) for c in some], F.map_from_entries(F.min(F.array_sort(F.map_entries("splitter_options")))).alias("splitter_options"))
    made = assets.manifests(chunks).select(F.col("paper_id").alias("folder"), "paper_id", "chunk_count", "chunk_ids").join(facts, "folder").join(assets.lines_sha256(chunks).withColumnRenamed("paper_id", "folder"), "folder")
    made = made.withColumn("chunks_path", F.concat(F.lit("chunks/"), "folder"))
    expected = made.select("folder", *[F.col(c).alias(f"e_{c}") for c in ("paper_id", "splitter_name", "splitter_version", "splitter_options", "chunks_path")])
    wrong = {c: F.concat(F.coalesce(c, F.lit("")), F.lit("?")) for c in ("paper_id", "splitter_name", "splitter_version", "chunks_path", "lines_sha256", "source_markdown_sha256", "source_pdf_sha256", "source_parser_version")}
    wrong |= {"splitter_options": F.map_from_arrays(F.array(F.lit("target")), F.array(F.lit(1).cast("bigint"))), "chunk_count": F.col("chunk_count") + 1, "chunk_ids": F.reverse(F.array_append("chunk_ids", F.lit("?")))}
    order = ("paper_id", "splitter_name", "splitter_version", "splitter_options", "chunks_path", "chunk_count", "chunk_ids", "lines_sha256", "", "", "source_markdown_sha256", "source_pdf_sha256", "source_parser_version")
    planted = made
    for number, column in enumerate(order):
        if column:
            planted = planted.withColumn(column, F.when(fault == number, wrong[column]).otherwise(F.col(column)))
    broken = chunks.withColumn("paper_id", F.when(fault == 8, F.lit("another")).otherwise(F.col("paper_id"))).withColumn("chunk_index", F.when((fault == 9) & (F.col("chunk_index") == 0), F.lit(-1)).otherwise(F.col("chunk_index")))
    ids = planted.withColumn("lines_sha256", F.when(fault == 9, F.lit(None)).otherwise(F.col("lines_sha256")))
    actual = assets.lines_sha256(broken.withColumn("paper_id", F.col("folder"))).select(F.col("paper_id").alias("folder"), F.col("lines_sha256").alias("renewed"))
    ids = ids.join(actual, "folder").withColumn("lines_sha256", F.coalesce("lines_sha256", "renewed")).drop("renewed")
    return assets.distribution(assets.manifest_reasons(ids, broken, expected).select(F.coalesce("reason", F.lit("sound")).alias("reason")), ["reason"])


def _suite(spark, directory):
    """A ranking and judgments for each retriever and each paper-rich search: grades by the share of a hit's rank."""
    hits = table(spark, directory, "chunk_hits").dropDuplicates(["hit_no"]).where(F.col("paper_id").isNotNull() & F.col("score").isNotNull() & ~F.isnan("score"))
    best = hits.groupBy("search_id", "retriever_name", "paper_id").agg(F.max("score").alias("score"), F.min("hit_rank").alias("hit_rank"))
    case = F.concat_ws("/", "search_id", "retriever_name")
    ranked = search.numbered(best.select(case.alias("case_id"), "paper_id", "score"), [F.desc("score"), F.asc("paper_id")], ["case_id"])
    judged = best.select(case.alias("case_id"), "paper_id", F.when(F.col("hit_rank") <= 1, 3).when(F.col("hit_rank") <= 3, 2).when(F.col("hit_rank") <= 6, 1).otherwise(0).alias("relevance"))
    return ranked, judged


def ranking_metrics(spark, directory):
    ranked, judged = _suite(spark, directory)
    return evaluate.ranking_metrics(ranked, judged, (1, 3, 5, 10), 2).select("case_id", "k", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "ndcg", "reciprocal_rank", "average_precision")], "relevant_count", "retrieved_count")


def macro_summary(spark, directory):
    ranked, judged = _suite(spark, directory)
    summary = evaluate.macro_summary(evaluate.ranking_metrics(ranked, judged, (5,), 2), 5)
    return summary.select("cases", *[F.round(c, 6).alias(c) for c in summary.columns if c.startswith("macro_")])


def suite_fusion(spark, directory):
    """Both retrievers' rankings fused for every search at once."""
    hits = table(spark, directory, "chunk_hits").dropDuplicates(["hit_no"]).where(F.col("paper_id").isNotNull() & F.col("score").isNotNull() & ~F.isnan("score") & (F.abs("score") < float("inf")))
    best = hits.groupBy("search_id", "retriever_name", "paper_id").agg(F.max("score").alias("score"))
    ranked = search.numbered(best, [F.desc("score"), F.asc("paper_id")], ["search_id", "retriever_name"])
    sides = [ranked.where(F.col("retriever_name") == n).select("search_id", "rank", "paper_id", "score") for n in ("bm25_fulltext", "vector")]
    return fusion.fuse(*sides, 0.7, 0.3, 10, ("search_id",)).select("search_id", "rank", "paper_id", F.round("score", 6).alias("score"), F.round("rank_score", 6).alias("rank_score"))


def _case_vectors():
    base = _query_vector()
    return [(c, base[i:] + base[:i]) for i, (c, _) in enumerate(CASES)]


def suite_chunks(spark, directory):
    """Lexical hits of three cases, each over its own candidates: the papers that the text retriever, the vector retriever or any of them has hit."""
    hits = table(spark, directory, "chunk_hits").where("paper_id is not null").select("retriever_name", "paper_id").distinct()
    case = F.explode(F.array(F.when(F.col("retriever_name") == "bm25_fulltext", CASES[0][0]), F.when(F.col("retriever_name") == "vector", CASES[1][0]), F.lit(CASES[2][0])))
    candidates = hits.select(case.alias("case_id"), "paper_id").where("case_id is not null")
    return suites.bm25_cases(table(spark, directory, "chunks"), CASES, 100, candidates).select("case_id", "rank", "paper_id", "chunk_id", F.round("score", 6).alias("score"), F.round("coverage", 6).alias("coverage"))


def suite_vectors(spark, directory):
    return suites.vector_cases(_vectors(spark, directory), _case_vectors(), 100, "embedding_id").select("case_id", "rank", "paper_id", "embedding_id", F.round("score", 6).alias("score"))


def suite_hybrid(spark, directory):
    """The whole suite: fused rankings of three cases with grades by the papers' first digit, and their metrics."""
    chunks = table(spark, directory, "chunks")
    grade = F.explode(F.array(*[F.struct(F.lit(c).alias("case_id"), (F.conv(F.substring("paper_id", 1 + i, 1), 16, 10).cast("int") % 4).alias("relevance")) for i, (c, _) in enumerate(CASES)]))
    judged = chunks.select("paper_id").distinct().select("paper_id", grade.alias("g")).select("g.case_id", "paper_id", "g.relevance")
    _, metrics, _ = suites.hybrid_suite(chunks, _vectors(spark, directory), CASES, _case_vectors(), judged, (1, 5, 10), 20, 2, "embedding_id")
    return metrics.select("case_id", "k", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "ndcg", "reciprocal_rank", "average_precision")], "relevant_count", "retrieved_count")


def _graded(spark, directory):
    """Grades of all papers for three cases, by digits of their ids."""
    grade = F.explode(F.array(*[F.struct(F.lit(c).alias("case_id"), (F.conv(F.substring("paper_id", 1 + i, 1), 16, 10).cast("int") % 4).alias("relevance")) for i, (c, _) in enumerate(CASES)]))
    return table(spark, directory, "chunks").select("paper_id").distinct().select("paper_id", grade.alias("g")).select("g.case_id", "paper_id", "g.relevance")


def suite_token_hash(spark, directory):
    ranked, _, _ = suites.token_hash_suite(table(spark, directory, "chunks"), CASES, _graded(spark, directory), (1, 5, 10), 20, 2)
    return ranked.select("case_id", "rank", "paper_id", F.round("score", 6).alias("score"))


def suite_rerank(spark, directory):
    """The lexical rankings of three cases reranked by how many of a chunk's first tokens are query terms."""
    chunks = table(spark, directory, "chunks")
    hits = suites.bm25_cases(chunks, CASES, 200)
    ranking = suites.papers_of_cases(hits, 40, 3, 1.0, 0.5, 0.5)
    scored = hits.select("case_id", "paper_id", "chunk_id", F.col("chunk_id").alias("segment_id"), F.col("coverage").alias("score"))
    reranked, _, _ = suites.rerank_suite(ranking, scored.join(ranking.select("case_id", "paper_id"), ["case_id", "paper_id"], "left_semi"), _graded(spark, directory))
    return reranked.select("case_id", "rank", "original_rank", "paper_id", F.round("score", 6).alias("score"), "chunks")


def saved_rankings(spark, directory):
    """Rankings of all searches saved as JSON and read again: how many ids each holds, or why it isn't sound."""
    hits = table(spark, directory, "chunk_hits").dropDuplicates(["hit_no"]).where("paper_id is not null")
    saved = hits.groupBy(F.concat_ws("/", "search_id", "retriever_name").alias("case_id")).agg(F.array_sort(F.collect_list(F.struct("hit_rank", "hit_no", "paper_id"))).alias("l"))
    json = F.to_json(F.struct(F.struct(F.transform("l", lambda x: F.struct(x["paper_id"].alias("paper_id"))).alias("hits")).alias("paper_search_result")))
    good, bad = evaluate.saved_ranking(saved.select("case_id", json.alias("j")), "j")
    return good.groupBy("case_id").agg(F.lit("sound").alias("reason"), F.count(F.lit(1)).alias("ids")).unionByName(bad.select("case_id", "reason", F.lit(0).cast("bigint").alias("ids")))


def run_counters(spark, directory):
    """Outcomes of page recognition by backend, whether it succeeded, and whether it noted an error."""
    pages = table(spark, directory, "ocr_pages").dropDuplicates(["page_no"])
    return quality.run_counters(pages.select("backend_name", "success", (F.coalesce("error_note", F.lit("")) != "").alias("noted")), ["backend_name", "success", "noted"])


def run_summaries(spark, directory):
    """The macro summary of each retriever's rankings."""
    ranked, judged = _suite(spark, directory)
    metrics = evaluate.ranking_metrics(ranked, judged, (5,), 2).withColumn("run", F.substring_index("case_id", "/", -1))
    summary = evaluate.macro_summaries(metrics)
    return summary.select("run", "cases", *[F.round(c, 6).alias(c) for c in summary.columns if c.startswith("macro_")])


def missing_papers(spark, directory):
    """For each search the papers that one retriever has hit and the other hasn't, united."""
    hits = table(spark, directory, "chunk_hits").where("paper_id is not null").select("search_id", "retriever_name", "paper_id").distinct()
    texts, near = (hits.where(F.col("retriever_name") == n).select("search_id", "paper_id") for n in ("bm25_fulltext", "vector"))
    parts = [a.join(b, ["search_id", "paper_id"], "left_anti") for a, b in ((texts, near), (near, texts))]
    return fusion.united_ids(*parts, by=("search_id",)).select("search_id", F.array_join("ids", ",").alias("ids"))


def preprint_records(spark, directory):
    """Crawl records read as preprint results and projected to paper records."""
    papers = table(spark, directory, "papers").dropDuplicates(["record_no"])
    short = F.regexp_extract(F.coalesce(F.try_element_at("base_urls", F.lit("arxiv_url")), F.lit("")), r"/abs/(.+)$", 1)
    rows = papers.select("record_no", F.concat(short, F.lit("v2")).alias("short_id"), "title", F.col("abstract").alias("summary"), F.transform("authors", lambda a: a["name"]).alias("authors"))
    made = records.from_preprints(rows.withColumn("title", F.col("title")))
    return made.groupBy("paper_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("authors")).alias("authors"), F.max(F.length("abstract")).alias("longest"), F.max(F.element_at("base_urls", "arxiv_pdf_url")).alias("pdf"))


def venue_counts(spark, directory):
    return store.group_counts(table(spark, directory, "papers").dropDuplicates(["record_no"]), "accepted_by")


def source_statistics(spark, directory):
    rows = quality.backend_statistics(table(spark, directory, "ocr_pages"))
    return rows.withColumn("seconds", F.round("seconds", 3))


def field_completeness(spark, directory):
    rows = store.completeness(table(spark, directory, "papers").dropDuplicates(["record_no"]), ["title", "abstract", "authors", "accepted_by", "seen_in_sources", "base_urls", "base_urls.arxiv_pdf_url", "crawled_at"], "record_no")
    return rows.select("field", "total", "missing", F.array_join("examples", ",").alias("examples"))


def complete_records(spark, directory):
    rows = store.non_empty(table(spark, directory, "papers").dropDuplicates(["record_no"]), ["title", "abstract", "authors", "base_urls.arxiv_pdf_url"])
    return store.equals(rows, "seen_in_categories", "cs.CL").select("record_no", F.size("authors").alias("authors"))


def pdf_candidates(spark, directory):
    papers = table(spark, directory, "papers")
    found = store.url_candidates(papers, URL_SOURCES)
    first = F.get(found, 0)
    rows = papers.select("record_no", F.size(found).alias("candidates"), first["url"].alias("preferred"), first["source"].alias("source"), first["field"].alias("field"), text.hostname(first["url"]).alias("host"))
    return rows.withColumn("policy", text.domain_policy(F.col("host"), (("arxiv.example", "slow"), ("example", "normal")), "none")).dropDuplicates(["record_no"])


def hits_in_known_papers(spark, directory):
    hits = table(spark, directory, "chunk_hits").dropDuplicates(["hit_no"]).select("hit_no", "paper_id", "chunk_id")
    known = store.by_keys(hits, "chunk_id", table(spark, directory, "chunks").select("chunk_id"))
    unknown = store.missing_keys(table(spark, directory, "chunks"), "chunk_id", hits.select("chunk_id"))
    return known.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("paper_id").alias("papers")).select(F.lit("known").alias("part"), "n", "papers").unionByName(unknown.agg(F.count("chunk_id").alias("n")).select(F.lit("unknown").alias("part"), "n", F.lit(0).cast("bigint").alias("papers")))


def chunk_manifests(spark, directory):
    return assets.manifests(table(spark, directory, "chunks")).select("paper_id", "chunk_count", "page_start", "page_end", F.sha2(F.array_join("chunk_ids", "\n"), 256).alias("ids_hash"))


def chunk_reasons(spark, directory):
    return assets.distribution(assets.chunk_reasons(table(spark, directory, "chunks")).select(F.coalesce("reason", F.lit("sound")).alias("reason")), ["reason"])


def embedding_audit(spark, directory):
    return assets.embedding_audit(table(spark, directory, "chunk_embeddings"))


def embedding_distribution(spark, directory):
    columns = ["embedding_model", "embedding_model_version", "embedding_dimension", "size"]
    rows = table(spark, directory, "chunk_embeddings").withColumn("size", F.size("vector")).select("embedding_no", *columns)
    return assets.distribution(rows.dropDuplicates(["embedding_no"]), columns)


def embedding_ids(spark, directory):
    rows = table(spark, directory, "chunk_embeddings").where("source_chunk_sha256 is not null and embedding_dimension is not null")
    made = hashing.embedding_id(F.col("chunk_id"), F.col("embedding_model"), F.col("embedding_model_version"), F.col("embedding_dimension"), F.col("source_chunk_sha256"))
    return rows.select("embedding_no", made.alias("made_id"), hashing.looks_like_sha256(F.col("source_chunk_sha256")).alias("sound_hash")).dropDuplicates(["embedding_no"])


def splitter_fingerprints(spark, directory):
    made = hashing.fingerprint({"splitter_name": F.col("splitter_name"), "splitter_version": F.col("splitter_version"), "splitter_options": hashing.sorted_map(F.col("splitter_options"))})
    folder = F.concat_ws("/", F.lit("chunks"), F.substring("paper_id", 1, 2), F.substring("paper_id", 3, 2), "paper_id", text.safe_path_component(F.col("splitter_name")), F.concat(text.safe_path_component(F.col("splitter_version")), F.lit("-"), made))
    return table(spark, directory, "chunks").select("chunk_id", folder.alias("folder")).dropDuplicates(["chunk_id"]).groupBy("folder").agg(F.count(F.lit(1)).alias("n"))


def _topic(spark, directory, topic):
    rows = _papers(spark, directory).groupBy("key").agg(F.min(F.struct("record_no", "title", "abstract", "seen_in_categories")).alias("r")).select("key", "r.*")
    found = lexical.topic_recall(rows, topic, TOPIC_FIELDS, 50, key="key")
    return found.select("rank", "key", "title", F.round("score", 6).alias("score"), F.array_join("matched_fields", ",").alias("matched"))


def topic_recall(spark, directory):
    return _topic(spark, directory, TOPIC)


def topic_recall_stopwords(spark, directory):
    """A topic with words that only one of the two lists of stopwords has."""
    return _topic(spark, directory, SECOND_TOPIC)


def fuzzy_titles(spark, directory):
    rows = _papers(spark, directory).groupBy("key").agg(F.min("title").alias("title"))
    return lexical.fuzzy_titles(rows, "a study of federated paramters in industrial navigtion", 20, 0.65, key="key").select("key", F.round("score", 6).alias("score"))


def merged_papers(spark, directory):
    papers = _papers(spark, directory).withColumn("source", F.lower(F.trim(F.regexp_replace("source_name", r"\s+", " "))))
    merged = merge.merged_records(papers, "key", [F.col("ingested_at"), F.col("record_no")], ["title", "abstract"], "accepted_by", "source", "seen_in_categories")
    return merged.select("key", "merged_title", F.sha2("merged_abstract", 256).alias("abstract_hash"), "merged_accepted_by", F.array_join("sources", "|").alias("sources"), F.array_join("categories", "|").alias("categories"), "arrivals")


def migrated_papers(spark, directory):
    rows = merge.migrated(table(spark, directory, "papers").dropDuplicates(["record_no"]), {"accepted_by": "venue_text"}, {"venue_text": F.lit(""), "abstract": F.lit(""), "language": F.lit("en")}, 4)
    return rows.groupBy("schema_version", "language").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("venue_text") == "").alias("without_venue"), F.count_if(F.col("abstract") == "").alias("without_abstract"))


def set_operations(spark, directory):
    papers = table(spark, directory, "papers").dropDuplicates(["record_no"])
    sources = store.ordered_distinct(F.coalesce("seen_in_sources", F.array().cast("array<string>")))
    grown = store.set_add(sources, F.lit("arXiv"))
    return papers.select("record_no", F.array_join(sources, "|").alias("ordered"), F.array_join(grown, "|").alias("grown"), F.size(F.array_except(sources, F.array(F.lit("arXiv"), F.lit("OpenReview")))).alias("others"), F.array_join(F.array_sort(F.array_union(sources, F.coalesce("seen_in_categories", F.array().cast("array<string>")))), "|").alias("united"))


def title_functions(spark, directory):
    papers = table(spark, directory, "papers").dropDuplicates(["record_no"])
    title = F.col("title")
    return papers.select(
        "record_no", text.preview(title, 40).alias("short"), text.preview(title, 40, "...").alias("dotted"), text.markdown_cell(title).alias("cell"), text.safe_path_component(title).alias("component"),
        text.safe_name(title).alias("safe"), F.round(text.uppercase_share(title), 6).alias("uppercase"), text.accept_type(F.col("accepted_by")).alias("accept_type"), text.day_text(F.col("crawled_at")).alias("day"), text.local_iso(F.col("crawled_at")).alias("local"),
    )


def size_texts(spark, directory):
    return _chunks(spark, directory).groupBy("paper_id").agg(F.sum("char_count").alias("characters")).select("paper_id", text.human_bytes(F.col("characters")).alias("size"), text.asset_path(F.col("paper_id"), "pdf", "pdf").alias("path"))


def page_markdown(spark, directory):
    pages = table(spark, directory, "ocr_pages").dropDuplicates(["page_no"])
    return quality.page_markdown(pages).select("paper_id", "page_count", "char_count", F.sha2("markdown", 256).alias("markdown_hash"))


def _checked(spark, directory):
    pages = table(spark, directory, "ocr_pages").dropDuplicates(["page_no"])
    titles = _papers(spark, directory).groupBy("key").agg(F.min("title").alias("title")).withColumnRenamed("key", "paper_id")
    documents = quality.page_markdown(pages).join(quality.parse_reports(pages), "paper_id").join(titles, "paper_id", "left")
    return quality.quality_checks(documents, "paper_id")


def document_quality(spark, directory):
    failed = F.array_join(F.transform(F.filter("checks", lambda c: ~c["passed"]), lambda c: c["name"]), ",")
    return _checked(spark, directory).select("paper_id", F.round("score", 6).alias("score"), "status", failed.alias("failed"))


def document_checks(spark, directory):
    """Every check of every document but that of its title, whose likeness SQL doesn't have."""
    each = _checked(spark, directory).select("paper_id", F.explode("checks").alias("c")).where("c.name <> 'title_match'")
    return each.select("paper_id", "c.name", "c.passed", F.round("c.score", 6).alias("score"), "c.weight", "c.critical")


def _markdown(spark, directory):
    return quality.page_markdown(table(spark, directory, "ocr_pages").dropDuplicates(["page_no"]).where("success"))


def markdown_blocks(spark, directory):
    return markdown.markdown_blocks(_markdown(spark, directory), "paper_id").select("paper_id", "block_index", "kind", "page_start", F.array_join("section_path", " > ").alias("section"), F.sha2("text", 256).alias("text_hash"))


def markdown_chunks(spark, directory):
    return markdown.markdown_chunks(_markdown(spark, directory), "paper_id").select("paper_id", "chunk_index", "char_count", "content_sha256", "page_start", "page_end", F.array_join("section_path", " > ").alias("section"))


def token_hash_embeddings(spark, directory):
    """The embedding of every chunk by its size, length, four numbers, and the sum of all numbers by their places."""
    made = table(spark, directory, "chunks").select("chunk_id", vector.token_hash_embedding(F.col("text"), 128).alias("v"))
    v = F.col("v")
    whole = F.aggregate(F.transform(v, lambda x, i: x * (i + 1)), F.lit(0.0), lambda t, x: t + x)
    rows = made.select("chunk_id", F.size("v").alias("size"), F.round(vector.norm(v), 6).alias("norm"), *[F.round(v[i], 6).alias(f"v{i}") for i in (0, 1, 64, 127)], F.round(whole, 4).alias("by_place"))
    return rows.dropDuplicates(["chunk_id"])


def dossier_lines(spark, directory):
    hits = search.bm25_chunks(table(spark, directory, "chunks"), QUERY, 300)
    ranking = search.bm25_papers(hits, QUERY, 20)
    titles = _papers(spark, directory).groupBy("key").agg(F.min("title").alias("title")).withColumnRenamed("key", "paper_id")
    return dossier.overview_lines(ranking, titles)


def html_articles(spark, directory):
    """Article pages rendered from the papers and read again by their meta elements."""
    papers = table(spark, directory, "papers").dropDuplicates(["record_no"]).where("title is not null")
    pages = papers.select("record_no", html.rendered(F.col("title"), F.transform("authors", lambda a: a["name"]), F.col("abstract")).alias("page"))
    meta = html.article(F.col("page")).alias("a")
    return pages.select("record_no", meta).select("record_no", "a.title", F.array_join("a.authors", "|").alias("authors"), F.sha2("a.abstract", 256).alias("abstract_hash"))


def daily_events(spark, directory):
    counts = ingest.event_counts(table(spark, directory, "events"))
    return counts.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("total", 4).alias("total"))


def flagship(spark: SparkSession, directory: str) -> DataFrame:
    return hybrid_papers(spark, directory)


NAMES = (
    title_keys, chunk_tokens, bm25_chunks, bm25_papers, vector_chunks, vector_papers, hybrid_papers, vector_norms, segments, reranked_papers, rerank_segments, reranked_hybrid, reranked_texts, chunk_ids, subchunk_embeddings, manifest_reasons, ranking_metrics, macro_summary, suite_fusion, suite_chunks, suite_vectors, suite_hybrid, suite_token_hash, suite_rerank, saved_rankings, run_counters, run_summaries, missing_papers, preprint_records, venue_counts,
    source_statistics, field_completeness, complete_records, pdf_candidates, hits_in_known_papers, chunk_manifests, chunk_reasons, embedding_audit, embedding_distribution, embedding_ids, splitter_fingerprints,
    topic_recall, topic_recall_stopwords, fuzzy_titles, merged_papers, migrated_papers, set_operations, title_functions, size_texts, page_markdown, document_quality, document_checks, markdown_blocks, markdown_chunks, token_hash_embeddings, dossier_lines,
    html_articles, daily_events,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in NAMES}


def oracle_sql() -> dict[str, str]:
    from folioflow.plans.oracle import ORACLE

    return dict(ORACLE)
