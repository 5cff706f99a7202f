"""Top N items within every group, with a hot-cold split (problem 3).

Exact group counts decide: the rows of heavy groups are range sorted by (group, order), so that one group spreads over many tasks; the range
is the salt, each range keeps its own best N, and a small merge follows. Light groups go through an ordinary window. The results are united.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioflow.session import cut_lineage

#: A group with more rows than this is heavy.
HEAVY_ROWS = 2_000
#: Heavy groups up to this number are marked by a broadcast of their keys; beyond it by a shuffled join.
BROADCAST_GROUPS = 100_000


def top_n_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[tuple[str, str]], n: int, place: str = "place", heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """The first ``n`` rows of every group by ``order`` (pairs of a column and "asc" or "desc"), with their ``place`` from 1.

    - A group with fewer rows gives what it has. ``n`` below 1 and an empty table give no rows.
    - Nulls in the order come last; a null in a group column makes a group of its own.
    - Rows equal in group and order are placed by a hash of the whole row, so the result doesn't depend on the partitioning; rows that are
      equal in every column are rows like any other.
    - Every column of the input stays; one named like ``place``, regardless of case, is replaced.
    - ``heavy_rows`` decides how a group is sorted, never what comes out.
    """
    kept = [c for c in df.columns if c.lower() != place.lower()]
    hashed = [F.to_json(F.struct(F.col(f"`{name}`"))) if "map<" in kind else F.col(f"`{name}`") for name, kind in df.dtypes]
    packed = df.select(
        F.struct(*[F.col(f"`{c}`") for c in group]).alias("g"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("item"), F.xxhash64(*hashed).alias("h"),
        *[F.col(f"`{c}`").alias(f"o{i}") for i, (c, _) in enumerate(order)],
    )
    keys = [F.desc_nulls_last(f"o{i}") if way == "desc" else F.asc_nulls_last(f"o{i}") for i, (_, way) in enumerate(order)] + [F.asc("h")]
    packed = cut_lineage(packed)
    heavy = cut_lineage(packed.groupBy("g").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > heavy_rows).select(F.col("g").alias("heavy")))
    if found := heavy.limit(BROADCAST_GROUPS + 1).count():
        same = packed["g"].eqNullSafe(heavy["heavy"])
        marked = F.broadcast(heavy) if found <= BROADCAST_GROUPS else heavy
        hot = packed.join(marked, same, "left_semi").repartitionByRange("g", *keys).withColumn("salt", F.spark_partition_id())
        best = _first(_first(hot, ["g", "salt"], keys, n), ["g"], keys, n).drop("salt")
        best = best.unionByName(_first(packed.join(marked, same, "left_anti"), ["g"], keys, n))
    else:
        best = _first(packed, ["g"], keys, n)
    return best.select(*[F.col("item").getField(c).alias(c) for c in kept], F.col("p").alias(place))


def _first(df: DataFrame, group: list[str], keys: list[Column], n: int) -> DataFrame:
    return df.withColumn("p", F.row_number().over(Window.partitionBy(*group).orderBy(*keys))).where(F.col("p") <= n)


def best_chunks(hits: DataFrame, chunks: DataFrame, n: int = 3, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """``paper_id, place, chunk_id``: the best chunks of each paper by full-text hits.

    Only hits of ``bm25_fulltext`` with a finite score of at least 0 on chunks that exist count; a chunk counts once, with its highest
    score, and belongs to the paper in ``chunks``. Ties go to the smaller chunk_index, then to the smaller chunk_id; null indexes come last.
    Repeated hits and chunks count once. Hits without score or chunk and chunks without id are left out.
    """
    finite = F.col("score").isNotNull() & ~F.isnan("score") & (F.col("score") >= 0) & (F.col("score") < float("inf"))
    scored = hits.where((F.col("retriever_name") == "bm25_fulltext") & finite).groupBy("chunk_id").agg(F.max("score").alias("score"))
    known = chunks.select("chunk_id", "paper_id", "chunk_index").where("chunk_id is not null").groupBy("chunk_id").agg(F.min(F.struct("paper_id", "chunk_index")).alias("c"))
    rows = scored.join(known, "chunk_id").select("c.paper_id", "chunk_id", "c.chunk_index", "score")
    return top_n_per_group(rows, ["paper_id"], [("score", "desc"), ("chunk_index", "asc"), ("chunk_id", "asc")], n, heavy_rows=heavy_rows).select("paper_id", "place", "chunk_id")
