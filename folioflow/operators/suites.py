"""Search and evaluation of many cases in one plan: every frame is keyed by ``case_id``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions.text import query_terms
from folioflow.functions.vector import cosine_with, is_usable, token_hash_embedding, token_hash_vector
from folioflow.operators import embed, evaluate, fusion
from folioflow.operators.search import Bm25, numbered, steady, term_counts
from folioflow.session import cut_lineage

#: Cases whose terms or vectors become literals of one plan.
MOST_CASES = 1000


def bm25_cases(chunks: DataFrame, cases: Sequence[tuple[str, str]], limit: int = 300, candidates: DataFrame | None = None, config: Bm25 = Bm25()) -> DataFrame:
    """``case_id, rank, paper_id, chunk_index, chunk_id, score, coverage`` for (case_id, query) pairs.

    With ``candidates`` (``case_id, paper_id``) each case sees, in statistics and hits, only the chunks of its own papers. The tokens of a chunk are
    compared with the terms of all cases at once, in one scan. Repeated rows count once.
    """
    if len(cases) > MOST_CASES:
        raise ValueError(f"more than {MOST_CASES} cases")
    asked = [(c, t, i, len(terms)) for c, q in cases for terms in (query_terms(q),) for i, t in enumerate(terms)]
    wanted = sorted({t for _, t, _, _ in asked})
    rows = term_counts(chunks, wanted, config)
    some = F.explode(F.filter(F.transform("tf", lambda n, i: F.struct(F.element_at(F.array(*[F.lit(t) for t in wanted]), i + 1).alias("term"), n.alias("tf"))), lambda x: x["tf"] > 0)).alias("x")
    counts = rows.select("paper_id", "chunk_index", "chunk_id", "length", some).select("paper_id", "chunk_index", "chunk_id", "length", "x.term", "x.tf")
    terms = chunks.sparkSession.createDataFrame(asked, "case_id string, term string, o int, terms int")
    matched = counts.join(terms, "term")
    if candidates is not None:
        matched = matched.join(candidates.select("case_id", "paper_id").distinct(), ["case_id", "paper_id"], "left_semi")
        totals = rows.join(candidates.select("case_id", "paper_id").distinct(), "paper_id").groupBy("case_id").agg(F.avg("length").alias("average"), F.count(F.lit(1)).alias("total"))
        matched = matched.join(totals, "case_id")
    else:
        one = rows.agg(F.avg("length").alias("average"), F.count(F.lit(1)).alias("total"))
        matched = matched.withColumn("average", one.select("average").scalar()).withColumn("total", one.select("total").scalar())
    frequency = matched.groupBy("case_id", "term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1.0 + (F.col("total") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (config.k1 + 1.0) / (F.col("tf") + config.k1 * (1.0 - config.b + config.b * F.col("length") / F.col("average")))
    scored = matched.join(frequency, ["case_id", "term"]).groupBy("case_id", "paper_id", "chunk_index", "chunk_id").agg(F.sum(part).alias("score"), (F.count(F.lit(1)) / F.first("terms")).alias("coverage"))
    ways = [steady("score"), F.desc("coverage"), F.asc("paper_id"), F.asc("chunk_index"), F.asc("chunk_id")]
    return numbered(scored.where("score > 0"), ways, ["case_id"]).where(F.col("rank") <= limit).select("case_id", "rank", "paper_id", "chunk_index", "chunk_id", "score", "coverage")


def vector_cases(embeddings: DataFrame, queries: Sequence[tuple[str, Sequence[float]]], top_k: int = 300, id_column: str = "chunk_id", candidates: DataFrame | None = None) -> DataFrame:
    """``case_id, rank, paper_id, <id_column>, score``: for every case the nearest vectors; each vector is compared with all queries where it lies."""
    if not queries or len(queries) > MOST_CASES or len({len(v) for _, v in queries}) != 1:
        raise ValueError(f"1 to {MOST_CASES} query vectors of one size")
    size = len(queries[0][1])
    fitting = embeddings.where((F.size("vector") == size) & is_usable(F.col("vector")))
    scores = F.array(*[F.struct(F.lit(c).alias("case_id"), cosine_with(F.col("vector"), v).alias("score")) for c, v in queries])
    rows = fitting.select("paper_id", id_column, scores.alias("all")).dropDuplicates([id_column]).select("paper_id", id_column, F.explode("all").alias("s")).select("s.case_id", "paper_id", id_column, "s.score")
    if candidates is not None:
        rows = rows.join(candidates.select("case_id", "paper_id").distinct(), ["case_id", "paper_id"], "left_semi")
    ways = [steady("score"), F.desc("paper_id"), F.desc(id_column)]
    return numbered(rows, ways, ["case_id"]).where(F.col("rank") <= top_k).select("case_id", "rank", "paper_id", id_column, "score")


def papers_of_cases(hits: DataFrame, limit: int | None, top: int, best_weight: float, mean_weight: float, coverage_weight: float = 0.0, descending_ids: bool = False) -> DataFrame:
    """``case_id, rank, paper_id, score`` from chunk hits of all cases; coverage is the largest among a paper's top chunks."""
    placed = numbered(hits, [steady("score"), F.asc("rank")], ["case_id", "paper_id"], "place").where(F.col("place") <= top)
    coverage = F.max("coverage") if coverage_weight else F.lit(0.0)
    papers = placed.groupBy("case_id", "paper_id").agg((best_weight * F.max("score") + mean_weight * F.avg("score") + coverage_weight * coverage).alias("score"))
    ways = [steady("score"), F.desc("paper_id") if descending_ids else F.asc("paper_id")]
    ranked = numbered(papers, ways, ["case_id"])
    return (ranked if limit is None else ranked.where(F.col("rank") <= limit)).select("case_id", "rank", "paper_id", "score")


def hybrid_suite(chunks: DataFrame, embeddings: DataFrame, cases: Sequence[tuple[str, str]], queries: Sequence[tuple[str, Sequence[float]]], judgments: DataFrame, ks: Sequence[int] = (1, 3, 5, 10), limit: int = 10, minimum_relevance: int = 1, id_column: str = "chunk_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fused rankings, their metrics and the macro summary of a suite; the candidates of a case are its judged papers."""
    own = judgments.select("case_id", "paper_id")
    lexical = papers_of_cases(bm25_cases(chunks, cases, candidates=own), None, 3, 1.0, 0.5, 0.5)
    near = papers_of_cases(vector_cases(embeddings, queries, id_column=id_column, candidates=own), None, 3, 0.7, 0.3, descending_ids=True)
    fused = fusion.fuse(lexical, near, 0.7, 0.3, limit, ("case_id",))
    metrics = evaluate.ranking_metrics(fused, judgments, ks, minimum_relevance)
    return fused, metrics, evaluate.macro_summary(metrics, 5 if 5 in ks else ks[0])


def token_hash_suite(chunks: DataFrame, cases: Sequence[tuple[str, str]], judgments: DataFrame, ks: Sequence[int] = (1, 3, 5, 10), limit: int = 10, minimum_relevance: int = 1, dimension: int = 128, max_chars: int = 3200, overlap_chars: int = 200) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rankings, metrics and macro summary of cases whose queries and chunks are embedded by token hashing; the candidates of a case are its judged papers."""
    made = embed.chunk_embeddings(chunks, lambda df, c: df.withColumn("vector", token_hash_embedding(F.col(c), dimension)), "token-hash", "v1", dimension, max_chars, overlap_chars)
    queries = [(case, token_hash_vector(query, dimension)) for case, query in cases]
    hits = vector_cases(cut_lineage(made.select("paper_id", "chunk_id", "vector")), queries, candidates=judgments.select("case_id", "paper_id"))
    ranked = papers_of_cases(hits, limit, 3, 0.7, 0.3, descending_ids=True)
    metrics = evaluate.ranking_metrics(ranked, judgments, ks, minimum_relevance)
    return ranked, metrics, evaluate.macro_summary(metrics, 5 if 5 in ks else ks[0])


def rerank_suite(ranking: DataFrame, segments: DataFrame, judgments: DataFrame, ks: Sequence[int] = (1, 3, 5, 10), minimum_relevance: int = 1, top_chunks: int = 3) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Reranked lists of all cases with their original ranks, metrics and macro summary.

    ``ranking`` has ``case_id, rank, paper_id``; ``segments`` has ``case_id, paper_id, chunk_id, segment_id, score``. Ways of ranking as in ``rerank.reranked_papers``.
    """
    best = numbered(segments, [steady("score"), F.desc("segment_id")], ["case_id", "paper_id", "chunk_id"], "p").where("p = 1").drop("p")
    top = numbered(best, [steady("score"), F.asc("segment_id")], ["case_id", "paper_id"], "p").where(F.col("p") <= top_chunks)
    papers = numbered(top.groupBy("case_id", "paper_id").agg(F.avg("score").alias("score"), F.count(F.lit(1)).alias("chunks")), [steady("score"), F.asc("paper_id")], ["case_id"])
    before = ranking.select("case_id", "paper_id", F.col("rank").alias("original_rank"))
    reranked = papers.join(before, ["case_id", "paper_id"], "left").withColumn("original_rank", F.coalesce("original_rank", F.lit(0)))
    metrics = evaluate.ranking_metrics(reranked, judgments, ks, minimum_relevance)
    return reranked.select("case_id", "rank", "paper_id", "score", "chunks", "original_rank"), metrics, evaluate.macro_summary(metrics, 5 if 5 in ks else ks[0])
