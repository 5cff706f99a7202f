"""Ranking metrics over any number of cases at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioflow.operators.search import numbered


def ranking_metrics(rankings: DataFrame, judgments: DataFrame, ks: Sequence[int] = (1, 3, 5, 10), minimum_relevance: int = 1) -> DataFrame:
    """``case_id, k, precision, recall, ndcg, reciprocal_rank, average_precision, relevant_count, retrieved_count``.

    ``rankings`` has ``case_id, rank, paper_id``; ``judgments`` has ``case_id, paper_id, relevance`` for every candidate (0 where unjudged). Precision
    divides by k and average precision by all relevant papers; the ideal order uses all grades. Metrics without a relevant paper are 0.
    """
    if not ks or min(ks) < 1 or len(set(ks)) != len(ks) or minimum_relevance not in (1, 2, 3):
        raise ValueError("k values must be positive and different, the minimum relevance 1, 2 or 3")
    judged = judgments.select("case_id", "paper_id", F.coalesce("relevance", F.lit(0)).alias("grade"))
    ranked = rankings.select("case_id", "rank", "paper_id").join(judged, ["case_id", "paper_id"], "left").fillna(0, ["grade"])
    relevant = (F.col("grade") >= minimum_relevance).cast("int")
    seen = F.sum(relevant).over(Window.partitionBy("case_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0))
    ranked = ranked.withColumn("relevant", relevant).withColumn("seen", seen).withColumn("gain", (F.pow(F.lit(2.0), "grade") - 1) / F.log2(F.col("rank") + 1))
    ideal = numbered(judged, [F.desc("grade"), F.asc("paper_id")], ["case_id"], "place").withColumn("gain", (F.pow(F.lit(2.0), "grade") - 1) / F.log2(F.col("place") + 1))

    def at(k: int, name: str):
        return F.sum(F.when(F.col(name) <= k, F.col("gain")).otherwise(0.0))

    wide = ideal.groupBy("case_id").agg(F.count_if(F.col("grade") >= minimum_relevance).alias("relevant_count"), *[at(k, "place").alias(f"ideal_{k}") for k in ks])
    actual = ranked.groupBy("case_id").agg(
        F.min(F.when(F.col("relevant") == 1, F.col("rank"))).alias("first"), F.sum(F.when(F.col("relevant") == 1, F.col("seen") / F.col("rank")).otherwise(0.0)).alias("precisions"),
        F.count(F.lit(1)).alias("retrieved_count"), *[at(k, "rank").alias(f"gain_{k}") for k in ks], *[F.sum(F.when(F.col("rank") <= k, F.col("relevant")).otherwise(0)).alias(f"found_{k}") for k in ks],
    )
    both = wide.join(actual, "case_id", "left")
    zero = F.lit(0.0)
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"ideal_{k}").alias("ideal"), F.coalesce(f"gain_{k}", zero).alias("gain"), F.coalesce(f"found_{k}", F.lit(0)).alias("found")) for k in ks]))
    rows = both.select("case_id", "relevant_count", F.coalesce("retrieved_count", F.lit(0)).alias("retrieved_count"), "first", "precisions", each.alias("m"))
    some = F.col("relevant_count") > 0
    return rows.select(
        "case_id", "m.k", (F.col("m.found") / F.col("m.k")).alias("precision"), F.when(some, F.col("m.found") / F.col("relevant_count")).otherwise(zero).alias("recall"),
        F.when(F.col("m.ideal") > 0, F.col("m.gain") / F.col("m.ideal")).otherwise(zero).alias("ndcg"), F.coalesce(1.0 / F.col("first"), zero).alias("reciprocal_rank"),
        F.when(some, F.coalesce("precisions", zero) / F.col("relevant_count")).otherwise(zero).alias("average_precision"), "relevant_count", "retrieved_count",
    )


def unknown_ranked(rankings: DataFrame, judgments: DataFrame) -> DataFrame:
    """Ranked papers outside their case's candidates; a sound ranking has none."""
    return rankings.join(judgments.select("case_id", "paper_id"), ["case_id", "paper_id"], "left_anti")


def saved_ranking(results: DataFrame, json: str, case: str = "case_id") -> tuple[DataFrame, DataFrame]:
    """``case_id, rank, paper_id`` from saved results as JSON (``paper_search_result.hits[].paper_id``), and ``case_id, reason`` of those that aren't sound.

    A result is left out if it has no list of hits, a hit without an id, or an id twice. Ranks count from 1 in order of the list.
    """
    schema = "struct<paper_search_result: struct<hits: array<struct<paper_id: string>>>>"
    ids = F.transform(F.from_json(json, schema)["paper_search_result"]["hits"], lambda h: F.trim(h["paper_id"]))
    read = results.select(F.col(case).alias("case_id"), ids.alias("ids"))
    blank = F.exists("ids", lambda x: F.coalesce(x, F.lit("")) == "")
    reason = F.when(F.col("ids").isNull(), "no_hits").when(blank, "hit_without_id").when(F.size(F.array_distinct("ids")) < F.size("ids"), "repeated_id")
    judged = read.withColumn("reason", reason)
    placed = judged.where("reason is null").select("case_id", F.posexplode("ids").alias("at", "paper_id"))
    return placed.select("case_id", (F.col("at") + 1).alias("rank"), "paper_id"), judged.where("reason is not null").select("case_id", "reason")


def unsound_cases(results: DataFrame, cases: DataFrame) -> DataFrame:
    """``case_id, reason`` of results (``case_id, query``) that don't belong to the dataset's ``cases`` (``case_id, query``): unknown, repeated, or of another query text."""
    known = cases.groupBy("case_id").agg(F.min("query").alias("asked"), F.count(F.lit(1)).alias("c"))
    counted = results.groupBy("case_id").agg(F.min("query").alias("low"), F.max("query").alias("high"), F.count(F.lit(1)).alias("n")).join(known, "case_id", "left")
    same = (F.col("low") == F.col("asked")) & (F.col("high") == F.col("asked"))
    reason = F.when(F.col("c").isNull(), "unknown_case").when(F.col("c") > 1, "case_twice_in_dataset").when(F.col("n") > 1, "case_twice_in_results").when(~F.coalesce(same, F.lit(False)), "another_query")
    return counted.select("case_id", reason.alias("reason")).where("reason is not null")


def macro_summaries(metrics: DataFrame, run: str = "run", k: int = 5) -> DataFrame:
    """``macro_summary`` of every run: one row each, with the column ``run``."""
    return metrics.where(F.col("k") == k).groupBy(run).agg(*_macro())


def _macro() -> list[Column]:
    means = [F.avg(c).alias(f"macro_{c}") for c in ("reciprocal_rank", "average_precision", "precision", "recall", "ndcg")]
    return [F.count(F.lit(1)).alias("cases"), *means, F.min_by("case_id", F.struct("average_precision", "case_id")).alias("hardest_case")]


def macro_summary(metrics: DataFrame, k: int = 5) -> DataFrame:
    """One row: the means over all cases and the case with the lowest average precision (the smaller id on a tie)."""
    return metrics.where(F.col("k") == k).agg(*_macro())
