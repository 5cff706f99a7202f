"""Ranked retrieval: BM25 over chunks, cosine over vectors, and their aggregation to papers."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioflow.functions.lookup import fresh_names
from folioflow.functions.text import query_terms, section_weighted_tokens
from folioflow.functions.vector import cosine_with, is_usable
from folioflow.session import cut_lineage


@dataclass(frozen=True)
class Bm25:
    k1: float = 1.5
    b: float = 0.75
    section_multiplier: int = 2

    def __post_init__(self):
        if self.k1 <= 0 or not 0 <= self.b <= 1 or self.section_multiplier < 0:
            raise ValueError("k1 must be positive, b between 0 and 1, the multiplier not negative")


def steady(score: str) -> Column:
    """Descending by a score, without the last digits that depend on the order of summation."""
    return F.desc(F.round(score, 12))


def numbered(df: DataFrame, order: Sequence, by: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """``df`` with its place in ``order``, from 1, within ``by``; meant for frames already cut to a few rows per group."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*(by or [F.lit(0)])).orderBy(*order)))


def numbered_all(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """``df`` with its place in ``order``, from 1, for frames of any size: sorted by ranges, each of which counts on from those before it."""
    number = fresh_names(df, "number")[0]
    rows = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(number, F.monotonically_increasing_id()))
    sizes = dict(rows.groupBy(F.shiftright(number, 33).alias("p")).count().collect())
    before = dict(zip(sorted(sizes), accumulate((sizes[p] for p in sorted(sizes)), initial=0)))
    offsets = F.create_map(*[F.lit(x) for pair in before.items() for x in pair]) if before else F.create_map(F.lit(0).cast("bigint"), F.lit(0))
    place = F.try_element_at(offsets, F.shiftright(number, 33)) + F.col(number).bitwiseAND((1 << 33) - 1) + 1
    return rows.withColumn(name, place).drop(number)


def term_counts(chunks: DataFrame, terms: Sequence[str], config: Bm25 = Bm25()) -> DataFrame:
    """``paper_id, chunk_index, chunk_id, length, tf`` of every chunk: its weighted tokens and how often each of the terms is among them.

    One scan; no text leaves it. Repeated rows (equal chunk_id) count once.
    """
    tokens = section_weighted_tokens(F.col("text"), F.col("section_path"), config.section_multiplier)
    tf = F.transform(F.array(*[F.lit(t) for t in terms]), lambda t: F.size(F.filter("tokens", lambda x: x == t)))
    rows = chunks.select("paper_id", "chunk_index", "chunk_id", tokens.alias("tokens")).select("paper_id", "chunk_index", "chunk_id", F.size("tokens").alias("length"), tf.alias("tf"))
    return cut_lineage(rows.dropDuplicates(["chunk_id"]))


def bm25_chunks(chunks: DataFrame, query: str, limit: int = 300, config: Bm25 = Bm25()) -> DataFrame:
    """``rank, paper_id, chunk_index, chunk_id, score, coverage, terms``: the best chunks for a query.

    Statistics cover every chunk, matched or not, with section tokens counted as often as the multiplier says. Hits have a positive score.
    Order: score and coverage descending, then paper_id, chunk_index, chunk_id. ``terms`` are the matched query terms in query order. Repeated
    rows (equal chunk_id) count once. The corpus is read once; its totals and frequencies are one row of numbers.
    """
    terms = query_terms(query)
    rows = term_counts(chunks, terms, config)
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("average"), *[F.count_if(F.col("tf")[i] > 0).alias(f"df{i}") for i in range(len(terms))]).first()
    size = config.k1 * (1.0 - config.b + config.b * F.col("length") / (facts["average"] or 1.0))
    parts = [math.log(1.0 + (facts["n"] - facts[f"df{i}"] + 0.5) / (facts[f"df{i}"] + 0.5)) * F.col("tf")[i] * (config.k1 + 1.0) / (F.col("tf")[i] + size) for i in range(len(terms))]
    met = F.array_compact(F.array(*[F.when(F.col("tf")[i] > 0, F.lit(t)) for i, t in enumerate(terms)]))
    best = rows.where(F.exists("tf", lambda x: x > 0)).select("paper_id", "chunk_index", "chunk_id", reduce(add, parts, F.lit(0.0)).alias("score"), (F.size(met) / max(len(terms), 1)).alias("coverage"), met.alias("terms"))
    ways = [steady("score"), F.desc("coverage"), F.asc("paper_id"), F.asc("chunk_index"), F.asc("chunk_id")]
    top = best.where("score > 0").orderBy(*ways).limit(limit)
    return numbered(top, ways).select("rank", "paper_id", "chunk_index", "chunk_id", "score", "coverage", "terms")


def bm25_papers(hits: DataFrame, query: str, limit: int = 10, top: int = 3, mean_weight: float = 0.5, coverage_weight: float = 0.5) -> DataFrame:
    """``rank, paper_id, score, best, mean_top, coverage, scoring_chunks, terms`` from ``bm25_chunks``.

    score = best chunk + weighted mean of the top chunks + weighted share of query terms met in those chunks. Order: score descending, paper_id.
    """
    size = len(query_terms(query))
    placed = numbered(hits, [steady("score"), F.asc("rank"), F.asc("chunk_index")], ["paper_id"], "place").where(F.col("place") <= top)
    papers = placed.groupBy("paper_id").agg(
        F.max("score").alias("best"), F.avg("score").alias("mean_top"), F.count(F.lit(1)).alias("scoring_chunks"), F.array_distinct(F.flatten(F.collect_list("terms"))).alias("met")
    )
    ordered = F.filter(F.array(*[F.lit(t) for t in query_terms(query)]), lambda t: F.array_contains(F.col("met"), t))
    scored = papers.select("paper_id", "best", "mean_top", "scoring_chunks", ordered.alias("terms"), (F.size("met") / size).alias("coverage"))
    scored = scored.withColumn("score", F.col("best") + mean_weight * F.col("mean_top") + coverage_weight * F.col("coverage"))
    ways = [steady("score"), F.asc("paper_id")]
    return numbered(scored.orderBy(*ways).limit(limit), ways).select("rank", "paper_id", "score", "best", "mean_top", "coverage", "scoring_chunks", "terms")


def relative_to_top(hits: DataFrame) -> DataFrame:
    """``hits`` with ``relative``: the score in percent of the first hit's."""
    return hits.withColumn("relative", F.col("score") / hits.agg(F.max_by("score", -F.col("rank"))).scalar() * 100)


def vector_chunks(embeddings: DataFrame, query: Sequence[float], top_k: int = 300, id_column: str = "chunk_id") -> DataFrame:
    """``rank, paper_id, <id_column>, score``: the vectors of the query's size with the highest cosine.

    Order: score, paper_id and id, all descending. Repeated rows (equal id) count once; only scores are compared for it. Vectors of another size or with numbers that aren't finite are left out.
    """
    fitting = embeddings.where((F.size("vector") == len(query)) & is_usable(F.col("vector")))
    scored = fitting.select("paper_id", id_column, cosine_with(F.col("vector"), query).alias("score")).dropDuplicates([id_column])
    ways = [steady("score"), F.desc("paper_id"), F.desc(id_column)]
    return numbered(scored.orderBy(*ways).limit(top_k), ways).select("rank", "paper_id", id_column, "score")


def vector_papers(hits: DataFrame, limit: int = 5, top: int = 3, best_weight: float = 0.7, mean_weight: float = 0.3) -> DataFrame:
    """``rank, paper_id, score, best, mean_top, scoring_chunks``: weighted best and mean of a paper's top hits. Order: score, paper_id descending."""
    placed = numbered(hits, [steady("score"), F.asc("rank")], ["paper_id"], "place").where(F.col("place") <= top)
    papers = placed.groupBy("paper_id").agg(F.max("score").alias("best"), F.avg("score").alias("mean_top"), F.count(F.lit(1)).alias("scoring_chunks"))
    scored = papers.withColumn("score", best_weight * F.col("best") + mean_weight * F.col("mean_top"))
    ways = [steady("score"), F.desc("paper_id")]
    return numbered(scored.orderBy(*ways).limit(limit), ways).select("rank", "paper_id", "score", "best", "mean_top", "scoring_chunks")
