"""Fixed-size segments of texts, and their scores aggregated back to chunks and papers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.operators.search import numbered, numbered_all, steady


def segments(df: DataFrame, text: str, max_chars: int = 3200, overlap_chars: int = 200, skip_blank: bool = False) -> DataFrame:
    """Every row once for each segment of its text: ``segment_index, segment_count, char_start, char_end, segment`` beside the other columns.

    A text within ``max_chars`` is one segment. Segments begin every ``max_chars - overlap_chars`` characters and the last ends with the text.
    ``skip_blank`` leaves out segments of white space. Null and empty texts leave no row.
    """
    if max_chars < 1 or not 0 <= overlap_chars < max_chars:
        raise ValueError("the overlap must be smaller than the size, and both not negative")
    step, size = max_chars - overlap_chars, F.length(F.col(text))
    last = F.when(size <= max_chars, F.lit(0)).otherwise(F.ceil((size - max_chars) / step).cast("int"))
    cuts = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct((i * step).cast("int").alias("s"), F.least(i * step + max_chars, size).cast("int").alias("e")))
    rows = df.where(size > 0).withColumn("_cuts", cuts)
    if skip_blank:
        rows = rows.withColumn("_cuts", F.filter("_cuts", lambda c: (size <= max_chars) | F.substring(F.col(text), c["s"] + 1, c["e"] - c["s"]).rlike(r"\S")))
    each = rows.withColumn("segment_count", F.size("_cuts")).select(*df.columns, "segment_count", F.posexplode("_cuts").alias("segment_index", "_cut"))
    return each.select(*df.columns, "segment_index", "segment_count", F.col("_cut.s").alias("char_start"), F.col("_cut.e").alias("char_end"), F.substring(F.col(text), F.col("_cut.s") + 1, F.col("_cut.e") - F.col("_cut.s")).alias("segment"))


def segment_id(chunk_id: Column, index: Column, count: Column, kind: str = "rerank-segment") -> Column:
    """The chunk's id, with a numbered suffix only where there are several segments."""
    return F.when(count == 1, chunk_id).otherwise(F.concat(chunk_id, F.lit(f"::{kind}-"), F.lpad(index.cast("string"), 4, "0")))


def reranked_papers(scored: DataFrame, top_chunks: int = 3) -> DataFrame:
    """``rank, paper_id, score, chunks`` from ``paper_id, chunk_id, segment_id, score``: the mean over a paper's best chunks of their best segment.

    A chunk's best segment: highest score, then the larger segment_id. A paper's best chunks: score descending, segment_id ascending.
    Order of papers: score descending, paper_id ascending.
    """
    best = numbered(scored, [steady("score"), F.desc("segment_id")], ["paper_id", "chunk_id"], "p").where("p = 1")
    top = numbered(best.drop("p"), [steady("score"), F.asc("segment_id")], ["paper_id"], "p").where(F.col("p") <= top_chunks)
    papers = top.groupBy("paper_id").agg(F.avg("score").alias("score"), F.count(F.lit(1)).alias("chunks"))
    return numbered_all(papers, [steady("score"), F.asc("paper_id")]).select("rank", "paper_id", "score", "chunks")


def merged_evidence(evidence: DataFrame) -> DataFrame:
    """``paper_id, chunk_id, text, sources, conflict`` from ``paper_id, chunk_id, text, source, place``: each chunk of a paper once.

    ``sources`` are in order of their first ``place``, then of name. A chunk with different texts is a conflict, and the smaller text stays. Rows
    without a paper, a chunk or a text are left out.
    """
    rows = evidence.where((F.trim("paper_id") != "") & (F.trim("chunk_id") != "") & (F.col("text") != "") & F.col("source").isNotNull())
    once = rows.groupBy("paper_id", "chunk_id", "source").agg(F.min("place").alias("place"), F.min("text").alias("low"), F.max("text").alias("high"))
    sources = F.transform(F.array_sort(F.collect_list(F.struct("place", "source"))), lambda x: x["source"])
    return once.groupBy("paper_id", "chunk_id").agg(F.min("low").alias("text"), sources.alias("sources"), (F.min("low") != F.max("high")).alias("conflict"))


def rerank_segments(ranking: DataFrame, evidence: DataFrame, papers: int, max_chars: int = 3200, overlap_chars: int = 200) -> DataFrame:
    """The segments of the first ``papers`` of a ranking (``rank, paper_id``), cut from their merged evidence.

    ``original_rank, paper_id, chunk_id, sources, conflict, segment_id, segment_index, segment_count, char_start, char_end, segment``.
    """
    if papers < 1:
        raise ValueError("the number of papers must be positive")
    first = ranking.where(F.col("rank") <= papers).select("paper_id", F.col("rank").alias("original_rank"))
    cut = segments(merged_evidence(evidence).join(first, "paper_id"), "text", max_chars, overlap_chars)
    named = cut.withColumn("segment_id", segment_id(F.col("chunk_id"), F.col("segment_index"), F.col("segment_count")))
    return named.select("original_rank", "paper_id", "chunk_id", "sources", "conflict", "segment_id", "segment_index", "segment_count", "char_start", "char_end", "segment")


def with_original_rank(reranked: DataFrame, ranking: DataFrame) -> DataFrame:
    """A reranked list with each paper's place in the ranking before it; 0 for a paper that wasn't there."""
    before = ranking.groupBy("paper_id").agg(F.min("rank").alias("original_rank"))
    return reranked.join(before, "paper_id", "left").withColumn("original_rank", F.coalesce("original_rank", F.lit(0)))


def ranked_texts(scored: DataFrame, index: str, limit: int, score: str = "score") -> DataFrame:
    """The first ``limit`` rows with ``rank``: score descending, then the text's place among those asked about. Scores that aren't finite are left out."""
    sound = scored.where(F.col(score).isNotNull() & ~F.isnan(score) & (F.abs(score) < float("inf")))
    ways = [F.desc(score), F.asc(index)]
    return numbered(sound.orderBy(*ways).limit(limit), ways)
