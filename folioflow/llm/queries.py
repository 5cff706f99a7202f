"""The queries of the problems, each over its whole tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import encoding, matching, neighbors, ocr, packing, splitting, survivors, topn, truncation
from folioflow.session import table


def p1_found(spark: SparkSession, directory: str) -> DataFrame:
    best = survivors.surviving_papers(table(spark, directory, "papers"), table(spark, directory, "source_registry"))
    several = best.where(F.col("first_record") != F.col("last_record"))
    fields = ("accepted_by", "base_urls", "seen_in_sources")
    long = several.select("paper_id", F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"{f}.record").alias("record_no")) for f in fields])).alias("x"))
    return long.select("paper_id", "x.field_name", "x.record_no").where("record_no is not null")


def p1_surviving_records(spark: SparkSession, directory: str) -> DataFrame:
    """The surviving record of every paper with its values."""
    best = survivors.surviving_papers(table(spark, directory, "papers"), table(spark, directory, "source_registry"))
    values = [
        F.col("accepted_by.value").alias("accepted_by"), F.array_join("base_urls.value", " ").alias("base_urls"),
        F.array_join("seen_in_sources.value", "|").alias("seen_in_sources"),
    ]
    return best.select("paper_id", *values)


def p2_found(spark: SparkSession, directory: str) -> DataFrame:
    return neighbors.similar_pairs(table(spark, directory, "chunk_embeddings"))


def p3_found(spark: SparkSession, directory: str) -> DataFrame:
    return topn.best_chunks(table(spark, directory, "chunk_hits"), table(spark, directory, "chunks"))


def _matches(spark: SparkSession, directory: str) -> DataFrame:
    return matching.match_entries(table(spark, directory, "papers"), table(spark, directory, "venue_entries"))


def p4_found(spark: SparkSession, directory: str) -> DataFrame:
    return _matches(spark, directory).select("paper_id", "entry_no")


def p4_matches(spark: SparkSession, directory: str) -> DataFrame:
    return _matches(spark, directory).select("paper_id", "entry_no", "rule", F.round("confidence", 6).alias("confidence"))


def _pieces(spark: SparkSession, directory: str) -> DataFrame:
    return splitting.pieces_to_make(table(spark, directory, "md_blocks"), table(spark, directory, "subchunk_audit"))


def p5_found(spark: SparkSession, directory: str) -> DataFrame:
    return _pieces(spark, directory).where("piece_count > 1 and piece_index = 0").select("block_no")


def p5_pieces(spark: SparkSession, directory: str) -> DataFrame:
    return _pieces(spark, directory).select("block_no", "paper_id", "section_path", "kind", "piece_index", "piece_count", "char_start", "char_end", "piece")


def p6_found(spark: SparkSession, directory: str) -> DataFrame:
    return ocr.lines_to_repair(table(spark, directory, "ocr_pages"))


def p6_paragraphs(spark: SparkSession, directory: str) -> DataFrame:
    return ocr.paragraphs(table(spark, directory, "ocr_pages"))


def p7_ids(spark: SparkSession, directory: str) -> DataFrame:
    documents = table(spark, directory, "documents")
    return documents.select("doc_id", encoding.token_ids(spark)(F.col("text")).alias("ids"))


def p8_containers(spark: SparkSession, directory: str) -> DataFrame:
    """A text's first line asks and bears no loss, the rest answers; a text of one line bears loss throughout. At most 24 texts and 2,032 loss-bearing tokens a container."""
    documents = table(spark, directory, "documents")
    first = F.when(F.contains("text", F.lit("\n")), F.substring_index("text", "\n", 1))
    return packing.fill_containers(documents, "doc_id", "text", prompt=first, max_segments=24, max_loss=2032)


def p8_fill(spark: SparkSession, directory: str) -> DataFrame:
    """One row: how full the containers of p8_containers are, and how many of them each limit keeps from taking more."""
    placed = p8_containers(spark, directory)
    each = placed.groupBy("container").agg(F.sum(F.col("token_end") - F.col("token_start")).alias("tokens"), F.count(F.lit(1)).alias("segments"), F.sum("loss").alias("loss"))
    return each.agg(F.count(F.lit(1)).alias("containers"), F.sum("tokens").alias("tokens"), F.round(F.avg(F.col("tokens") / 2048), 4).alias("mean_fill"), F.max("tokens").alias("most_tokens"), F.count_if(F.col("segments") == 24).alias("full_of_segments"), F.count_if(F.col("loss") >= 2032).alias("full_of_loss"))


def _judged(spark: SparkSession, directory: str) -> DataFrame:
    return truncation.cut_texts(table(spark, directory, "documents"), "text", "doc_id", F.lower(F.trim("lang")), F.col("source"))


def p9_found(spark: SparkSession, directory: str) -> DataFrame:
    return _judged(spark, directory).where("truncated").select("doc_id")


def p9_share_by_source(spark: SparkSession, directory: str) -> DataFrame:
    return truncation.truncation_by_source(_judged(spark, directory))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p1_found": p1_found, "p1_surviving_records": p1_surviving_records, "p2_found": p2_found, "p3_found": p3_found, "p4_found": p4_found, "p4_matches": p4_matches, "p5_found": p5_found, "p5_pieces": p5_pieces, "p6_found": p6_found, "p6_paragraphs": p6_paragraphs, "p7_ids": p7_ids, "p8_containers": p8_containers, "p8_fill": p8_fill, "p9_found": p9_found, "p9_share_by_source": p9_share_by_source}


P1_RECORDS = r"""
WITH registry AS (SELECT lower(trim(source_name)) AS name, trust FROM source_registry),
records AS (
  SELECT DISTINCT ON (record_no) *,
    CASE WHEN coalesce(trim(paper_id), '') <> '' THEN lower(trim(paper_id))
         WHEN trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g')) <> '' THEN sha1(trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g'))) END AS pid,
    lower(trim(regexp_replace(accepted_by, '\s+', ' ', 'g'))) AS venue,
    lower(trim(regexp_replace(source_name, '\s+', ' ', 'g'))) AS src
  FROM papers),
ranked AS (
  SELECT r.*, g.trust,
    CASE WHEN venue IS NULL OR regexp_matches(venue, '^([^\p{L}\p{N}]*|unknown|none|null|nil|nan|tbd|tba|n ?/? ?a|n\. ?a\.?|not available|undefined|missing|todo|test)$')
           OR regexp_matches(venue, '\b(submit\w*|submission\w*|pending|review|reviewed|withdraw\w*|withdrew|reject\w*|declined|retracted|unpublished)\b') OR NOT regexp_matches(venue, '\p{L}{2}') THEN NULL
         WHEN regexp_matches(venue, 'arxiv|preprint|\bcorr\b') THEN 1 ELSE 2 END AS acceptance,
    list_sort(list_distinct(list_filter(list_transform(map_values(base_urls), lambda x: trim(x)), lambda x: regexp_matches(x, '^https?://[^/]+\.[^/.]')))) AS urls,
    list_sort(list_filter(list_distinct(list_transform(seen_in_sources, lambda x: lower(trim(regexp_replace(x, '\s+', ' ', 'g'))))),
      lambda x: list_contains(l.names, x))) AS sources
  FROM records r CROSS JOIN (SELECT list(name) AS names FROM registry) l LEFT JOIN registry g ON g.name = r.src
  WHERE pid IS NOT NULL),
"""
P1_BEST = (
    P1_RECORDS
    + """
long AS (
  SELECT pid, 'accepted_by' AS field_name, record_no, acceptance AS score, trust, crawled_at FROM ranked
  UNION ALL SELECT pid, 'base_urls', record_no, nullif(len(urls), 0), trust, crawled_at FROM ranked
  UNION ALL SELECT pid, 'seen_in_sources', record_no, nullif(len(sources), 0), trust, crawled_at FROM ranked),
best AS (
  SELECT * FROM long WHERE score IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY pid, field_name ORDER BY score DESC, trust DESC NULLS LAST, crawled_at DESC NULLS LAST, record_no) = 1)
"""
)
P1_FOUND = (
    P1_BEST
    + """
SELECT pid AS paper_id, field_name, record_no FROM best
WHERE pid IN (SELECT pid FROM records GROUP BY pid HAVING count(DISTINCT record_no) > 1)
"""
)
P1_SURVIVING = (
    P1_BEST
    + """
SELECT p.pid AS paper_id, max(trim(r.accepted_by, ' ')) FILTER (b.field_name = 'accepted_by') AS accepted_by, max(array_to_string(r.urls, ' ')) FILTER (b.field_name = 'base_urls') AS base_urls,
  max(array_to_string(r.sources, '|')) FILTER (b.field_name = 'seen_in_sources') AS seen_in_sources
FROM (SELECT DISTINCT pid FROM ranked) p LEFT JOIN best b ON b.pid = p.pid LEFT JOIN ranked r ON r.pid = b.pid AND r.record_no = b.record_no GROUP BY p.pid
"""
)
P3_FOUND = """
WITH scored AS (
  SELECT chunk_id, max(score) AS score FROM chunk_hits
  WHERE retriever_name = 'bm25_fulltext' AND isfinite(score) AND score >= 0 GROUP BY chunk_id),
placed AS (
  SELECT c.paper_id, row_number() OVER (PARTITION BY c.paper_id ORDER BY s.score DESC, c.chunk_index, c.chunk_id) AS place, c.chunk_id
  FROM scored s JOIN (SELECT DISTINCT chunk_id, paper_id, chunk_index FROM chunks) c USING (chunk_id))
SELECT paper_id, place, chunk_id FROM placed WHERE place <= 3
"""

P5_FOUND = """
WITH body AS (
  SELECT DISTINCT block_no, length(trim(text, (SELECT string_agg(chr(c::INT), '') FROM (SELECT unnest([9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, 8232, 8233, 8239, 8287, 12288]
      || range(8192, 8203)) AS c)))) AS n FROM md_blocks),
pieces AS (SELECT DISTINCT block_no, embedding_model, subchunk_count, subchunk_index, char_start, char_end FROM subchunk_audit),
linked AS (
  SELECT *, lag(char_end) OVER w AS before_end, lag(char_start) OVER w AS before_start FROM pieces
  WINDOW w AS (PARTITION BY block_no, embedding_model, subchunk_count ORDER BY subchunk_index)),
good AS (
  SELECT block_no, max(char_end) FILTER (subchunk_index = subchunk_count - 1) AS last_end FROM linked
  GROUP BY block_no, embedding_model, subchunk_count
  HAVING count(*) = subchunk_count AND min(subchunk_index) = 0 AND max(subchunk_index) = subchunk_count - 1 AND count(DISTINCT subchunk_index) = subchunk_count
    AND min(char_start) FILTER (subchunk_index = 0) = 0 AND max(char_end - char_start) <= 3200 AND min(char_end - char_start) > 0
    AND coalesce(bool_and(least(before_end, char_end) - greatest(before_start, char_start) BETWEEN 1 AND 200) FILTER (subchunk_index > 0), true))
SELECT block_no FROM body WHERE n > 3200 AND NOT EXISTS (SELECT 1 FROM good WHERE good.block_no = body.block_no AND good.last_end = body.n)
"""


def oracle_sql() -> dict[str, str]:
    return {"p1_found": P1_FOUND, "p1_surviving_records": P1_SURVIVING, "p3_found": P3_FOUND, "p5_found": P5_FOUND}
