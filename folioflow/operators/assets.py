"""Chunk assets: manifests, their consistency with the chunks, and the audit of embeddings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioflow.functions.hashing import looks_like_sha256, sorted_map, text_sha256


def manifests(chunks: DataFrame) -> DataFrame:
    """``paper_id, chunk_count, page_start, page_end, chunk_ids`` (in order of chunk_index); repeated chunks count once."""
    once = chunks.dropDuplicates(["chunk_id"])
    ids = F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "chunk_id"))), lambda x: x["chunk_id"])
    return once.groupBy("paper_id").agg(F.count(F.lit(1)).alias("chunk_count"), F.min("page_start").alias("page_start"), F.max("page_end").alias("page_end"), ids.alias("chunk_ids"))


def chunk_reasons(chunks: DataFrame) -> DataFrame:
    """``paper_id, chunk_id, reason``: the first rule that a chunk breaks, null if none: ids and hashes, counts, pages, running index.

    A chunk's own rules are settled in the scan, so no text is shuffled for the running index. Repeated chunks count once.
    """
    own = (
        F.when(~looks_like_sha256(F.col("chunk_id")), "bad_chunk_id").when(F.coalesce("text", F.lit("")) == "", "empty_text").when(F.col("char_count") != F.length("text"), "char_count_mismatch")
        .when(F.col("content_sha256") != text_sha256(F.col("text")), "content_hash_mismatch").when((F.col("page_start") < 1) | (F.col("page_end") < F.col("page_start")), "bad_pages")
    )
    once = chunks.select("paper_id", "chunk_id", "chunk_index", own.alias("own")).dropDuplicates(["chunk_id"])
    place = F.row_number().over(Window.partitionBy("paper_id").orderBy("chunk_index", "chunk_id")) - 1
    return once.withColumn("place", place).select("paper_id", "chunk_id", F.coalesce("own", F.when(F.col("chunk_index") != F.col("place"), "index_not_continuous")).alias("reason"))


def embedding_audit(embeddings: DataFrame) -> DataFrame:
    """One row: totals, distinct papers and chunks, sub-chunks, duplicates, longest offset, unusable sizes."""
    wrong = F.coalesce(F.size("vector") != F.col("embedding_dimension"), F.lit(True)).alias("wrong")
    m = "metadata"
    once = embeddings.select("embedding_no", "paper_id", "embedding_id", m, wrong).dropDuplicates(["embedding_no"])
    return once.agg(
        F.count(F.lit(1)).alias("embeddings"), F.count_distinct("paper_id").alias("papers"), F.count_distinct("embedding_id").alias("distinct_ids"),
        (F.count(F.lit(1)) - F.count_distinct("embedding_id")).alias("duplicate_ids"), F.count_if(f"{m}.is_subchunk").alias("subchunk_embeddings"),
        F.count_distinct(F.when(F.col(f"{m}.is_subchunk"), F.col(f"{m}.source_chunk_id"))).alias("split_chunks"), F.max(f"{m}.subchunk_count").alias("most_subchunks"),
        F.max(f"{m}.char_end").alias("longest_offset"), F.count_if("wrong").alias("wrong_dimension"),
    )


def distribution(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def lines_sha256(chunks: DataFrame) -> DataFrame:
    """``paper_id, lines_sha256``: the hash of the hashes of a paper's chunk lines, in order of chunk_index; no texts are gathered."""
    line = F.sha2(F.to_json(F.struct("chunk_id", "chunk_index", "content_sha256")), 256)
    each = chunks.select("paper_id", "chunk_id", "chunk_index", line.alias("h")).dropDuplicates(["paper_id", "chunk_id"])
    ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "chunk_id", "h"))), lambda x: x["h"]), "")
    return each.groupBy("paper_id").agg(F.sha2(ordered, 256).alias("lines_sha256"))


def manifest_reasons(manifest: DataFrame, chunks: DataFrame, expected: DataFrame) -> DataFrame:
    """``folder, reason``: the first check that a paper's manifest fails against its chunks, null if none.

    ``manifest`` has ``folder`` (the paper whose asset it is), ``paper_id, splitter_name, splitter_version, splitter_options, chunks_path, chunk_count, chunk_ids,
    lines_sha256, source_markdown_sha256, source_pdf_sha256, source_parser_name, source_parser_version``; ``expected`` has ``folder`` and what the first five of
    these must be, as ``e_...``; ``chunks`` has ``folder`` beside the fields of chunks. Eight checks of the manifest come before five of its chunks: paper,
    running index, source text, source file, parser. Repeated chunks count once.
    """
    own = ("paper_id", "chunk_index", "source_markdown_sha256", "source_pdf_sha256", "source_parser_name", "source_parser_version")
    once = chunks.select("folder", "chunk_id", "content_sha256", *own).dropDuplicates(["folder", "chunk_id"])
    hashes = lines_sha256(once.select(F.col("folder").alias("paper_id"), "chunk_id", "chunk_index", "content_sha256")).select(F.col("paper_id").alias("folder"), F.col("lines_sha256").alias("actual_sha256"))
    missing = [F.count_if(F.col(c).isNull()).alias(f"no_{c}") for c in own]
    ids = F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "chunk_id"))), lambda x: x["chunk_id"])
    ranges = [f(c).alias(f"{n}_{c}") for c in own for n, f in (("low", F.min), ("high", F.max))]
    facts = once.groupBy("folder").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("chunk_index").alias("places"), ids.alias("ids"), *ranges, *missing)
    both = manifest.join(expected, "folder").join(facts, "folder", "left").join(hashes, "folder", "left")

    def same(column: str) -> Column:
        return F.col(f"low_{column}").eqNullSafe(F.col(column)) & F.col(f"high_{column}").eqNullSafe(F.col(column)) & ((F.col(f"no_{column}") == 0) | F.col(column).isNull())

    checks = {
        "paper_id": F.col("paper_id").eqNullSafe(F.col("e_paper_id")), "splitter_name": F.col("splitter_name").eqNullSafe(F.col("e_splitter_name")), "splitter_version": F.col("splitter_version").eqNullSafe(F.col("e_splitter_version")),
        "splitter_options": F.to_json(sorted_map(F.col("splitter_options"))).eqNullSafe(F.to_json(sorted_map(F.col("e_splitter_options")))), "chunks_path": F.col("chunks_path").eqNullSafe(F.col("e_chunks_path")),
        "chunk_count": F.col("chunk_count") == F.coalesce("n", F.lit(0)), "chunk_ids": F.col("chunk_ids").eqNullSafe(F.coalesce("ids", F.array().cast("array<string>"))), "chunks_sha256": F.col("lines_sha256").eqNullSafe(F.col("actual_sha256")),
        "chunk_paper_id": same("paper_id"), "chunk_index": (F.col("low_chunk_index") == 0) & (F.col("high_chunk_index") == F.col("n") - 1) & (F.col("places") == F.col("n")),
        "chunk_markdown_sha256": same("source_markdown_sha256"), "chunk_pdf_sha256": same("source_pdf_sha256"), "chunk_parser": same("source_parser_name") & same("source_parser_version"),
    }
    reason = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()])
    return both.select("folder", reason.alias("reason"))
