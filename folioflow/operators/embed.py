"""Chunks to embeddings, long chunks by sub-chunks with ids of their own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions.hashing import embedding_id
from folioflow.operators.rerank import segment_id, segments


def subchunks(chunks: DataFrame, max_chars: int = 3200, overlap_chars: int = 200) -> DataFrame:
    """The chunks cut into segments of up to ``max_chars``, without blank ones: ``embedding_chunk_id, subchunk_index, subchunk_count, char_start, char_end, segment`` beside their own columns.

    Segments count from 0 without gaps. A chunk of one segment keeps its id; others get a numbered suffix. Repeated chunks count once.
    """
    cut = segments(chunks, "text", max_chars, overlap_chars, skip_blank=True).withColumnRenamed("segment_index", "subchunk_index").withColumnRenamed("segment_count", "subchunk_count")
    named = cut.withColumn("embedding_chunk_id", segment_id(F.col("chunk_id"), F.col("subchunk_index"), F.col("subchunk_count"), "subchunk"))
    return named.dropDuplicates(["embedding_chunk_id"])


def chunk_embeddings(chunks: DataFrame, embed: Callable[[DataFrame, str], DataFrame], model: str, version: str, dimension: int, max_chars: int = 3200, overlap_chars: int = 200) -> DataFrame:
    """One row for each sub-chunk: ``embedding_id, chunk_id, paper_id, embedding_model, embedding_model_version, embedding_dimension, vector, source_chunk_sha256, metadata``.

    ``embed`` adds the column ``vector`` for a text column, by an expression or by a service (``sources.paged.embedded``). ``embedding_id`` follows from
    the sub-chunk's id, model, version, dimension and the chunk's hash; ``metadata`` says where in which chunk the text stood.
    """
    kept = subchunks(chunks.select("chunk_id", "paper_id", "chunk_index", "page_start", "page_end", "section_path", "source_markdown_relative_path", "content_sha256", "text"), max_chars, overlap_chars).drop("text")
    metadata = F.struct(
        "chunk_index", "page_start", "page_end", "section_path", "source_markdown_relative_path", F.col("chunk_id").alias("source_chunk_id"), "subchunk_index", "subchunk_count", "char_start", "char_end",
        (F.col("subchunk_count") > 1).alias("is_subchunk"),
    )
    made = embed(kept, "segment").withColumn("metadata", metadata)
    one = {"embedding_model": F.lit(model), "embedding_model_version": F.lit(version), "embedding_dimension": F.lit(dimension)}
    number = embedding_id(F.col("embedding_chunk_id"), *one.values(), F.col("content_sha256"))
    return made.select(number.alias("embedding_id"), F.col("embedding_chunk_id").alias("chunk_id"), "paper_id", *[v.alias(k) for k, v in one.items()], "vector", F.col("content_sha256").alias("source_chunk_sha256"), "metadata")
