"""Fusion of two rankings, keyed by case so that a whole suite is one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioflow.operators.search import numbered, steady


def normalized_scores(ranking: DataFrame, by: list[str]) -> DataFrame:
    """``ranking`` (``rank, paper_id, score``) with ``relative`` (min-max; 1 where all scores are equal) and ``rank_score`` (1 to 0 by rank)."""
    whole = Window.partitionBy(*(by or [F.lit(0)]))
    low, high, n = F.min("score").over(whole), F.max("score").over(whole), F.count(F.lit(1)).over(whole)
    relative = F.when(high == low, F.lit(1.0)).otherwise((F.col("score") - low) / (high - low))
    return ranking.withColumn("relative", relative).withColumn("rank_score", F.when(n == 1, F.lit(1.0)).otherwise(1.0 - (F.col("rank") - 1) / (n - 1)))


def united_ids(*parts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``*by, ids``: the ids of all parts (``*by, paper_id``) once each, in order of the alphabet."""
    every = parts[0].select(*by, "paper_id")
    for part in parts[1:]:
        every = every.unionByName(part.select(*by, "paper_id"))
    return every.groupBy(*by).agg(F.array_sort(F.collect_set("paper_id")).alias("ids"))


def fuse(primary: DataFrame, secondary: DataFrame, primary_weight: float = 0.7, secondary_weight: float = 0.3, limit: int = 10, by: tuple[str, ...] = ()) -> DataFrame:
    """``*by, rank, paper_id, score, rank_score, primary_relative, secondary_relative``; a paper missing on one side counts 0 there.

    Order: score, rank_score, paper_id, all descending. Each side is a ranking with one row per paper.
    """
    if primary_weight < 0 or secondary_weight < 0 or primary_weight + secondary_weight <= 0 or limit < 1:
        raise ValueError("weights must not be negative and not both 0, the limit must be positive")
    keys = [*by, "paper_id"]
    sides = [normalized_scores(x, list(by)).select(*keys, F.col("relative").alias(f"{n}_relative"), F.col("rank_score").alias(f"{n}_rank_score")) for n, x in (("primary", primary), ("secondary", secondary))]
    both = sides[0].join(sides[1], keys, "full").fillna(0.0)
    weighted = [primary_weight * F.col(f"primary_{x}") + secondary_weight * F.col(f"secondary_{x}") for x in ("relative", "rank_score")]
    scored = both.select(*keys, weighted[0].alias("score"), weighted[1].alias("rank_score"), "primary_relative", "secondary_relative")
    ranked = numbered(scored, [steady("score"), steady("rank_score"), F.desc("paper_id")], list(by))
    return ranked.where(F.col("rank") <= limit).select(*by, "rank", "paper_id", "score", "rank_score", "primary_relative", "secondary_relative")
