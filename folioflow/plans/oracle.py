"""SQL equivalents of the core's queries, as DuckDB runs them on the same tables."""

from __future__ import annotations

# Fixed values, written out here on their own: words that a retrieval query leaves out, the terms of the queries, and what a venue text calls an acceptance.
STOPWORDS = "a an and are as at be by for from in is it of on or that the this to was were with".split()
QUERY_TERMS = ["retrieval", "passages", "uncertain", "agents", "long", "documents"]
CASE_TERMS = {"c1": ["relevance", "cautious", "rankers"], "c2": ["memory", "agents", "under", "private", "data"], "c3": ["translation", "long", "documents"]}
ACCEPTANCES = (("notable top 25%", "Notable Top 25%"), ("notable top 5%", "Notable Top 5%"), ("spotlight", "Spotlight"), ("oral", "Oral"), ("poster", "Poster"))


def _values(items) -> str:
    return ", ".join(f"('{x}', {i})" for i, x in enumerate(items, 1))


STOPS = "[" + ", ".join(f"'{w}'" for w in STOPWORDS) + "]"
RECORDS = r"""
records AS (
  SELECT DISTINCT ON (record_no) *, trim(regexp_replace(regexp_replace(lower(title), '[^a-z0-9]', ' ', 'g'), ' +', ' ', 'g')) AS normalized FROM papers ORDER BY record_no),
keyed AS (
  SELECT *, nullif(normalized, '') IS NOT NULL AS named, CASE WHEN normalized <> '' THEN sha1(normalized) END AS title_id,
    CASE WHEN coalesce(trim(paper_id, ' '), '') <> '' THEN lower(trim(paper_id, ' ')) WHEN normalized <> '' THEN sha1(normalized) END AS key FROM records)
"""
TOKENS = rf"""
once AS (SELECT DISTINCT ON (chunk_id) * FROM chunks ORDER BY chunk_id),
raw AS (
  SELECT *, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+(?:''[a-z0-9]+)?') AS t,
    regexp_extract_all(lower(array_to_string(section_path, ' ')), '[a-z0-9]+(?:''[a-z0-9]+)?') AS s FROM once),
kept AS (
  SELECT *, list_filter(t, lambda x: length(x) >= 2 AND NOT list_contains({STOPS}, x)) AS tk, list_filter(s, lambda x: length(x) >= 2 AND NOT list_contains({STOPS}, x)) AS sk FROM raw),
tokenized AS (
  SELECT paper_id, chunk_index, chunk_id, CASE WHEN len(tk) > 0 THEN tk ELSE t END AS body, CASE WHEN len(sk) > 0 THEN sk ELSE coalesce(s, []) END AS section FROM kept),
weighted AS (SELECT paper_id, chunk_index, chunk_id, list_concat(list_concat(body, section), section) AS tokens FROM tokenized)
"""
BM25 = rf"""
{TOKENS},
terms(term, o) AS (VALUES {_values(QUERY_TERMS)}),
totals AS (SELECT count(*) AS n, avg(len(tokens)) AS average FROM weighted),
counts AS (
  SELECT paper_id, chunk_index, chunk_id, len(tokens) AS length, term, o, len(list_filter(tokens, lambda x: x = term)) AS tf
  FROM weighted CROSS JOIN terms),
matched AS (SELECT * FROM counts WHERE tf > 0),
df AS (SELECT term, count(*) AS df FROM matched GROUP BY term),
scored AS (
  SELECT paper_id, chunk_index, chunk_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * length / average))) AS score,
    count(*) / {len(QUERY_TERMS)}.0 AS coverage, string_agg(term, ' ' ORDER BY o) AS terms, list(term) AS met
  FROM matched JOIN df USING (term) CROSS JOIN totals GROUP BY ALL),
hits AS (SELECT row_number() OVER (ORDER BY round(score, 9) DESC, coverage DESC, paper_id, chunk_index, chunk_id) AS rank, * FROM scored QUALIFY rank <= 300),
placed AS (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY score DESC, rank) AS place FROM hits),
by_paper AS (
  SELECT paper_id, max(score) AS best, avg(score) AS mean_top, count(*) AS scoring_chunks, len(list_distinct(flatten(list(met)))) / {len(QUERY_TERMS)}.0 AS coverage
  FROM placed WHERE place <= 3 GROUP BY paper_id),
bm25_papers AS (
  SELECT row_number() OVER (ORDER BY round(best + 0.5 * mean_top + 0.5 * coverage, 9) DESC, paper_id) AS rank, *, best + 0.5 * mean_top + 0.5 * coverage AS score
  FROM by_paper QUALIFY rank <= 50)
"""
DIRECTION = "list_transform(range(64), lambda i: (CASE WHEN i % 2 = 0 THEN 1.0 ELSE -1.0 END) / (1.0 + i))::DOUBLE[]"
VECTORS = f"""
usable AS (
  SELECT DISTINCT ON (embedding_no) * FROM chunk_embeddings
  WHERE embedding_model_version = 'openai-compatible-64' AND len(vector) = 64 AND len(list_filter(vector, lambda x: x IS NULL OR NOT isfinite(x))) = 0 ORDER BY embedding_no),
compared AS (
  SELECT paper_id, embedding_id, CASE WHEN list_sum(list_transform(vector, lambda x: x * x)) = 0 THEN 0.0 ELSE list_cosine_similarity(vector, {DIRECTION}) END AS score FROM usable),
near AS (SELECT row_number() OVER (ORDER BY round(score, 12) DESC, paper_id DESC, embedding_id DESC) AS rank, * FROM compared QUALIFY rank <= 300),
near_placed AS (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY score DESC, rank) AS place FROM near),
near_papers AS (SELECT paper_id, max(score) AS best, avg(score) AS mean_top, count(*) AS scoring_chunks FROM near_placed WHERE place <= 3 GROUP BY paper_id),
vector_papers AS (
  SELECT row_number() OVER (ORDER BY round(0.7 * best + 0.3 * mean_top, 12) DESC, paper_id DESC) AS rank, *, 0.7 * best + 0.3 * mean_top AS score FROM near_papers QUALIFY rank <= 50)
"""


def _normalized(name: str, source: str, by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    keys = f"{by}, " if by else ""
    return f"""{name} AS (
  SELECT {keys}paper_id, CASE WHEN max(score) OVER w = min(score) OVER w THEN 1.0 ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END AS relative,
    CASE WHEN count(*) OVER w = 1 THEN 1.0 ELSE 1.0 - (rank - 1) / (count(*) OVER w - 1.0) END AS rank_score FROM {source} WINDOW w AS ({part}))"""


SUITE = """
sound AS (SELECT DISTINCT ON (hit_no) * FROM chunk_hits WHERE paper_id IS NOT NULL AND score IS NOT NULL AND NOT isnan(score) ORDER BY hit_no),
best AS (SELECT search_id || '/' || retriever_name AS case_id, paper_id, max(score) AS score, min(hit_rank) AS hit_rank FROM sound GROUP BY ALL),
ranked AS (
  SELECT case_id, paper_id, row_number() OVER (PARTITION BY case_id ORDER BY score DESC, paper_id) AS rank,
    CASE WHEN hit_rank <= 1 THEN 3 WHEN hit_rank <= 3 THEN 2 WHEN hit_rank <= 6 THEN 1 ELSE 0 END AS grade FROM best),
graded AS (
  SELECT *, (grade >= 2)::INT AS relevant, sum((grade >= 2)::INT) OVER (PARTITION BY case_id ORDER BY rank) AS seen, (pow(2, grade) - 1) / log2(rank + 1) AS gain,
    row_number() OVER (PARTITION BY case_id ORDER BY grade DESC, paper_id) AS place FROM ranked),
wide AS (
  SELECT case_id, k, sum(relevant) AS relevant_count, count(*) AS retrieved_count, sum(CASE WHEN rank <= k THEN relevant ELSE 0 END) AS found,
    sum(CASE WHEN rank <= k THEN gain ELSE 0 END) AS gain, sum(CASE WHEN place <= k THEN (pow(2, grade) - 1) / log2(place + 1) ELSE 0 END) AS ideal,
    min(CASE WHEN relevant = 1 THEN rank END) AS first, sum(CASE WHEN relevant = 1 THEN seen / rank ELSE 0 END) AS precisions
  FROM graded CROSS JOIN (SELECT unnest([1, 3, 5, 10]) AS k) GROUP BY case_id, k),
metrics AS (
  SELECT case_id, k, found / k AS precision, CASE WHEN relevant_count > 0 THEN found / relevant_count ELSE 0.0 END AS recall, CASE WHEN ideal > 0 THEN gain / ideal ELSE 0.0 END AS ndcg,
    coalesce(1.0 / first, 0.0) AS reciprocal_rank, CASE WHEN relevant_count > 0 THEN precisions / relevant_count ELSE 0.0 END AS average_precision, relevant_count, retrieved_count FROM wide)
"""
TRIMMED = "list_filter(list_transform({0}, lambda x: trim(x, ' ')), lambda x: x <> '')"

ORACLE = {
    "title_keys": f"WITH {RECORDS} SELECT record_no, normalized, title_id, key FROM keyed",
    "chunk_tokens": f"WITH {TOKENS} SELECT chunk_id, len(body) AS tokens, len(list_distinct(body)) AS distinct_tokens, len(tokens) AS weighted FROM tokenized JOIN weighted USING (chunk_id)",
    "bm25_chunks": f"WITH {BM25} SELECT rank, paper_id, chunk_id, round(score, 6) AS score, round(coverage, 6) AS coverage, terms FROM hits",
    "bm25_papers": f"""WITH {BM25} SELECT rank, paper_id, round(score, 6) AS score, round(best, 6) AS best, round(mean_top, 6) AS mean_top, round(coverage, 6) AS coverage,
      round(score / (SELECT score FROM bm25_papers WHERE rank = 1) * 100, 6) AS relative, scoring_chunks FROM bm25_papers""",
    "vector_chunks": f"WITH {VECTORS} SELECT rank, paper_id, embedding_id, round(score, 6) AS score FROM near",
    "vector_papers": f"WITH {VECTORS} SELECT rank, paper_id, round(score, 6) AS score, round(best, 6) AS best, round(mean_top, 6) AS mean_top, scoring_chunks FROM vector_papers",
    "hybrid_papers": f"""WITH {BM25}, {VECTORS}, {_normalized("p", "bm25_papers")}, {_normalized("s", "vector_papers")},
      fused AS (SELECT coalesce(p.paper_id, s.paper_id) AS paper_id, coalesce(p.relative, 0.0) AS primary_relative, coalesce(s.relative, 0.0) AS secondary_relative,
        0.7 * coalesce(p.relative, 0.0) + 0.3 * coalesce(s.relative, 0.0) AS score, 0.7 * coalesce(p.rank_score, 0.0) + 0.3 * coalesce(s.rank_score, 0.0) AS rank_score
        FROM p FULL JOIN s ON p.paper_id = s.paper_id)
      SELECT row_number() OVER (ORDER BY round(score, 9) DESC, round(rank_score, 9) DESC, paper_id DESC) AS rank, paper_id, round(score, 6) AS score, round(rank_score, 6) AS rank_score,
        round(primary_relative, 6) AS primary_relative, round(secondary_relative, 6) AS secondary_relative FROM fused QUALIFY rank <= 60""",
    "vector_norms": """WITH usable AS (SELECT DISTINCT ON (embedding_no) embedding_no, vector FROM chunk_embeddings
        WHERE len(vector) > 0 AND len(list_filter(vector, lambda x: x IS NULL OR NOT isfinite(x))) = 0 ORDER BY embedding_no),
      measured AS (SELECT embedding_no, len(vector) AS size, sqrt(list_sum(list_transform(vector, lambda x: x * x))) AS norm FROM usable)
      SELECT embedding_no, size, round(norm, 6) AS norm, (CASE WHEN norm = 0 THEN 0.0 ELSE 1.0 END)::DOUBLE AS unit FROM measured""",
    "segments": """WITH once AS (SELECT DISTINCT block_no, text FROM md_blocks WHERE length(text) > 0),
      cut AS (SELECT *, CASE WHEN length(text) <= 3200 THEN 1 ELSE ((length(text) - 3200 + 2999) // 3000) + 1 END AS n FROM once),
      each AS (SELECT block_no, text, n AS segment_count, unnest(range(n)) AS i FROM cut)
      SELECT block_no, i AS segment_index, segment_count, i * 3000 AS char_start, least(i * 3000 + 3200, length(text)) AS char_end, sha256(substring(text, i * 3000 + 1, 3200)) AS segment_hash,
        CASE WHEN segment_count = 1 THEN block_no::VARCHAR ELSE block_no || '::rerank-segment-' || lpad(i::VARCHAR, 4, '0') END AS segment_id FROM each""",
    "reranked_papers": rf"""WITH once AS (SELECT DISTINCT ON (chunk_id) paper_id, chunk_id, text FROM chunks WHERE length(text) > 0 ORDER BY chunk_id),
      cut AS (SELECT *, CASE WHEN length(text) <= 400 THEN 1 ELSE ((length(text) - 400 + 349) // 350) + 1 END AS n FROM once),
      each AS (SELECT *, unnest(range(n)) AS i FROM cut),
      tokens AS (SELECT *, regexp_extract_all(lower(substring(text, i * 350 + 1, 400)), '[a-z0-9]+(?:''[a-z0-9]+)?') AS t FROM each),
      scored AS (SELECT paper_id, chunk_id, CASE WHEN n = 1 THEN chunk_id ELSE chunk_id || '::rerank-segment-' || lpad(i::VARCHAR, 4, '0') END AS segment_id,
        len(list_intersect(t, [{", ".join(f"'{t}'" for t in QUERY_TERMS)}])) / {len(QUERY_TERMS)}.0 AS score FROM tokens),
      best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY paper_id, chunk_id ORDER BY score DESC, segment_id DESC) = 1),
      top AS (SELECT * FROM best QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY score DESC, segment_id) <= 3),
      averaged AS (SELECT paper_id, avg(score) AS score, count(*) AS chunks FROM top GROUP BY paper_id)
      SELECT row_number() OVER (ORDER BY round(score, 12) DESC, paper_id) AS rank, paper_id, round(score, 6) AS score, chunks FROM averaged""",
    "ranking_metrics": f"""WITH {SUITE} SELECT case_id, k, round(precision, 6) AS precision, round(recall, 6) AS recall, round(ndcg, 6) AS ndcg, round(reciprocal_rank, 6) AS reciprocal_rank,
      round(average_precision, 6) AS average_precision, relevant_count, retrieved_count FROM metrics""",
    "macro_summary": f"""WITH {SUITE} SELECT count(*) AS cases, round(avg(reciprocal_rank), 6) AS macro_reciprocal_rank, round(avg(average_precision), 6) AS macro_average_precision,
      round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall, round(avg(ndcg), 6) AS macro_ndcg FROM metrics WHERE k = 5""",
    "suite_fusion": f"""WITH sound AS (SELECT DISTINCT ON (hit_no) * FROM chunk_hits WHERE paper_id IS NOT NULL AND isfinite(score) ORDER BY hit_no),
      best AS (SELECT search_id, retriever_name, paper_id, max(score) AS score FROM sound GROUP BY ALL),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY search_id, retriever_name ORDER BY score DESC, paper_id) AS rank FROM best),
      a AS (SELECT * FROM ranked WHERE retriever_name = 'bm25_fulltext'), b AS (SELECT * FROM ranked WHERE retriever_name = 'vector'),
      {_normalized("p", "a", "search_id")}, {_normalized("s", "b", "search_id")},
      fused AS (SELECT coalesce(p.search_id, s.search_id) AS search_id, coalesce(p.paper_id, s.paper_id) AS paper_id, 0.7 * coalesce(p.relative, 0.0) + 0.3 * coalesce(s.relative, 0.0) AS score,
        0.7 * coalesce(p.rank_score, 0.0) + 0.3 * coalesce(s.rank_score, 0.0) AS rank_score FROM p FULL JOIN s ON p.search_id = s.search_id AND p.paper_id = s.paper_id)
      SELECT search_id, row_number() OVER (PARTITION BY search_id ORDER BY score DESC, rank_score DESC, paper_id DESC) AS rank, paper_id, round(score, 6) AS score, round(rank_score, 6) AS rank_score
      FROM fused QUALIFY rank <= 10""",
    "venue_counts": f"WITH {RECORDS} SELECT CASE WHEN accepted_by IS NULL THEN '<missing>' WHEN accepted_by = '' THEN '<empty>' ELSE accepted_by END AS group_value, count(*) AS n FROM records GROUP BY 1",
    "source_statistics": """WITH once AS (SELECT DISTINCT ON (page_no) * FROM ocr_pages ORDER BY page_no)
      SELECT backend_name, count(*) AS pages, count(*) FILTER (success) AS successful, count(*) FILTER (coalesce(error_note, '') <> '') AS with_error, count(DISTINCT paper_id) AS papers,
        sum(coalesce(length(text), 0)) AS characters, round(sum(coalesce(duration_seconds, 0)), 3) AS seconds, max(page_index) AS last_page FROM once GROUP BY backend_name""",
    "field_completeness": f"""WITH {RECORDS},
      lacking AS (
        SELECT record_no, unnest([{{'f': 'title', 'e': coalesce(title, '') = ''}}, {{'f': 'abstract', 'e': coalesce(abstract, '') = ''}}, {{'f': 'authors', 'e': coalesce(len(authors), 0) = 0}},
          {{'f': 'accepted_by', 'e': coalesce(accepted_by, '') = ''}}, {{'f': 'seen_in_sources', 'e': coalesce(len(seen_in_sources), 0) = 0}}, {{'f': 'base_urls', 'e': coalesce(cardinality(base_urls), 0) = 0}},
          {{'f': 'base_urls.arxiv_pdf_url', 'e': coalesce(base_urls['arxiv_pdf_url'], '') = ''}}, {{'f': 'crawled_at', 'e': crawled_at IS NULL}}]) AS x FROM records)
      SELECT x.f AS field, count(*) AS total, count(*) FILTER (x.e) AS missing, array_to_string(list_sort(list(record_no) FILTER (x.e))[1:3], ',') AS examples FROM lacking GROUP BY x.f""",
    "complete_records": f"""WITH {RECORDS} SELECT record_no, len(authors) AS authors FROM records
      WHERE title <> '' AND abstract <> '' AND len(authors) > 0 AND coalesce(base_urls['arxiv_pdf_url'], '') <> '' AND list_contains(seen_in_categories, 'cs.CL')""",
    "pdf_candidates": f"""WITH {RECORDS},
      listed AS (SELECT record_no, list_filter([{{'u': trim(base_urls[k], ' '), 'k': k}} FOR k IN ['acl_anthology_pdf_url', 'pmlr_pdf_url', 'openreview_pdf_url', 'official_pdf_url', 'arxiv_pdf_url', 'arxiv_url']], lambda x: x.u <> '') AS found FROM records),
      first AS (SELECT record_no, len(list_distinct(list_transform(found, lambda x: x.u))) AS candidates, found[1].u AS preferred, found[1].k AS k,
        lower(nullif(regexp_extract(found[1].u, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '')) AS host FROM listed)
      SELECT record_no, coalesce(candidates, 0) AS candidates, preferred, split_part(k, '_', 1) AS source, 'base_urls.' || k AS field, host,
        CASE WHEN host = 'arxiv.example' OR ends_with(host, '.arxiv.example') THEN 'slow' WHEN host = 'example' OR ends_with(host, '.example') THEN 'normal' ELSE 'none' END AS policy FROM first""",
    "hits_in_known_papers": """WITH hits AS (SELECT DISTINCT ON (hit_no) * FROM chunk_hits ORDER BY hit_no)
      SELECT 'known' AS part, count(*) AS n, count(DISTINCT paper_id) AS papers FROM hits WHERE chunk_id IN (SELECT chunk_id FROM chunks)
      UNION ALL SELECT 'unknown', count(DISTINCT chunk_id), 0 FROM hits WHERE chunk_id NOT IN (SELECT chunk_id FROM chunks WHERE chunk_id IS NOT NULL)""",
    "chunk_manifests": """WITH once AS (SELECT DISTINCT ON (chunk_id) * FROM chunks ORDER BY chunk_id)
      SELECT paper_id, count(*) AS chunk_count, min(page_start) AS page_start, max(page_end) AS page_end, sha256(string_agg(chunk_id, chr(10) ORDER BY chunk_index, chunk_id)) AS ids_hash FROM once GROUP BY paper_id""",
    "chunk_reasons": """WITH once AS (SELECT DISTINCT ON (chunk_id) * FROM chunks ORDER BY chunk_id),
      placed AS (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY chunk_index, chunk_id) - 1 AS place FROM once)
      SELECT CASE WHEN NOT regexp_full_match(chunk_id, '[0-9a-fA-F]{64}') THEN 'bad_chunk_id' WHEN coalesce(text, '') = '' THEN 'empty_text' WHEN char_count <> length(text) THEN 'char_count_mismatch'
        WHEN content_sha256 <> sha256(text) THEN 'content_hash_mismatch' WHEN page_start < 1 OR page_end < page_start THEN 'bad_pages' WHEN chunk_index <> place THEN 'index_not_continuous' ELSE 'sound' END AS reason, count(*) AS n
      FROM placed GROUP BY 1""",
    "embedding_audit": """WITH once AS (SELECT DISTINCT ON (embedding_no) * FROM chunk_embeddings ORDER BY embedding_no)
      SELECT count(*) AS embeddings, count(DISTINCT paper_id) AS papers, count(DISTINCT embedding_id) AS distinct_ids, count(*) - count(DISTINCT embedding_id) AS duplicate_ids,
        count(*) FILTER (metadata.is_subchunk) AS subchunk_embeddings, count(DISTINCT metadata.source_chunk_id) FILTER (metadata.is_subchunk) AS split_chunks, max(metadata.subchunk_count) AS most_subchunks,
        max(metadata.char_end) AS longest_offset, count(*) FILTER (coalesce(len(vector) <> embedding_dimension, true)) AS wrong_dimension FROM once""",
    "embedding_distribution": """WITH once AS (SELECT DISTINCT ON (embedding_no) * FROM chunk_embeddings ORDER BY embedding_no)
      SELECT embedding_model, embedding_model_version, embedding_dimension, len(vector) AS size, count(*) AS n FROM once GROUP BY ALL""",
    "embedding_ids": """WITH once AS (SELECT DISTINCT ON (embedding_no) * FROM chunk_embeddings WHERE source_chunk_sha256 IS NOT NULL AND embedding_dimension IS NOT NULL ORDER BY embedding_no)
      SELECT embedding_no, sha256(concat_ws(chr(10), chunk_id, embedding_model, embedding_model_version, embedding_dimension::VARCHAR, source_chunk_sha256)) AS made_id,
        regexp_full_match(source_chunk_sha256, '[0-9a-fA-F]{64}') AS sound_hash FROM once""",
    "splitter_fingerprints": r"""WITH once AS (SELECT DISTINCT ON (chunk_id) * FROM chunks ORDER BY chunk_id),
      made AS (SELECT paper_id, splitter_name, splitter_version, '{"splitter_name":"' || splitter_name || '","splitter_options":{' ||
        array_to_string(list_transform(list_sort(map_entries(splitter_options)), lambda e: '"' || e.key || '":' || e.value), ',') || '},"splitter_version":"' || splitter_version || '"}' AS payload FROM once)
      SELECT concat_ws('/', 'chunks', substring(paper_id, 1, 2), substring(paper_id, 3, 2), paper_id, trim(regexp_replace(splitter_name, '[^A-Za-z0-9._-]+', '-', 'g'), '.-_'),
        trim(regexp_replace(splitter_version, '[^A-Za-z0-9._-]+', '-', 'g'), '.-_') || '-' || substring(sha256(payload), 1, 16)) AS folder, count(*) AS n FROM made GROUP BY 1""",
    "merged_papers": f"""WITH {RECORDS},
      seq AS (SELECT *, lower(trim(regexp_replace(source_name, '\\s+', ' ', 'g'), ' ')) AS source, row_number() OVER (PARTITION BY key ORDER BY ingested_at, record_no) AS o FROM keyed WHERE key IS NOT NULL),
      marked AS (SELECT *, row_number() OVER (PARTITION BY key, source ORDER BY o) = 1 AS new_source FROM seq),
      first AS (SELECT key, min_by(title, o) FILTER (coalesce(title, '') <> '') AS merged_title, min_by(abstract, o) FILTER (coalesce(abstract, '') <> '') AS merged_abstract,
        min_by(accepted_by, o) FILTER (coalesce(accepted_by, '') <> '') AS venue, min(o) FILTER (coalesce(accepted_by, '') <> '') AS at, string_agg(DISTINCT source, '|' ORDER BY source) AS sources,
        array_to_string(list_sort(list_distinct(flatten(list(seen_in_categories)))), '|') AS categories, count(*) AS arrivals FROM marked GROUP BY key),
      better AS (SELECT m.key, min_by(m.accepted_by, m.o) AS formal FROM marked m JOIN first f ON f.key = m.key
        WHERE m.new_source AND m.o > f.at AND trim(coalesce(m.accepted_by, ''), ' ') <> '' AND NOT starts_with(lower(trim(m.accepted_by, ' ')), 'arxiv') GROUP BY m.key)
      SELECT f.key, merged_title, sha256(merged_abstract) AS abstract_hash, CASE WHEN starts_with(lower(trim(venue, ' ')), 'arxiv') AND formal IS NOT NULL THEN formal ELSE venue END AS merged_accepted_by,
        sources, coalesce(categories, '') AS categories, arrivals FROM first f LEFT JOIN better b ON b.key = f.key""",
    "migrated_papers": f"""WITH {RECORDS} SELECT greatest(coalesce(schema_version, 0), 4) AS schema_version, 'en' AS language, count(*) AS n, count(*) FILTER (coalesce(accepted_by, '') = '') AS without_venue,
      count(*) FILTER (coalesce(abstract, '') = '') AS without_abstract FROM records GROUP BY 1""",
    "size_texts": """WITH once AS (SELECT DISTINCT ON (chunk_id) * FROM chunks ORDER BY chunk_id), sizes AS (SELECT paper_id, sum(char_count) AS c FROM once GROUP BY paper_id)
      SELECT paper_id, CASE WHEN c < 1024 THEN printf('%.2f B', c::DOUBLE) WHEN c < 1048576 THEN printf('%.2f KiB', c / 1024.0) ELSE printf('%.2f MiB', c / 1048576.0) END AS size,
        'pdf/' || substring(paper_id, 1, 2) || '/' || substring(paper_id, 3, 2) || '/' || paper_id || '.pdf' AS path FROM sizes""",
    "page_markdown": """WITH once AS (SELECT DISTINCT ON (page_no) *, trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(13)) AS t FROM ocr_pages ORDER BY page_no)
      SELECT paper_id, count(DISTINCT page_index) AS page_count, sum(length(t)) AS char_count,
        sha256(string_agg('<!-- page: ' || (page_index + 1) || ' -->' || chr(10) || chr(10) || t, chr(10) || chr(10) ORDER BY page_index) || chr(10)) AS markdown_hash FROM once GROUP BY paper_id""",
    "dossier_lines": f"""WITH {BM25}, {RECORDS}, titles AS (SELECT key AS paper_id, min(title) AS title FROM keyed GROUP BY key)
      SELECT rank, '| ' || rank || ' | ' || trim(replace(replace(coalesce(nullif(trim(title, ' '), ''), p.paper_id), '|', '\\|'), chr(10), ' '), ' ') || ' | ' || printf('%.4f', score) || ' |' AS line
      FROM bm25_papers p LEFT JOIN titles USING (paper_id) WHERE rank <= 20""",
    "html_articles": f"""WITH {RECORDS} SELECT record_no, trim(regexp_replace(title, '\\s+', ' ', 'g'), ' ') AS title,
      coalesce(array_to_string(list_filter(list_transform(authors, lambda a: trim(regexp_replace(a.name, '\\s+', ' ', 'g'), ' ')), lambda x: x <> ''), '|'), '') AS authors,
      sha256(coalesce(trim(regexp_replace(abstract, '\\s+', ' ', 'g'), ' '), '')) AS abstract_hash FROM records WHERE title IS NOT NULL""",
    "daily_events": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
}
_FLAT = "trim(regexp_replace(regexp_replace(lower({0}), '[^a-z0-9]', ' ', 'g'), ' +', ' ', 'g'))"


def _topic(terms: list[str], phrase: str) -> str:
    def met(column: str) -> str:
        return " + ".join(f"contains({column}, '{t}')::INT" for t in terms)

    return rf"""WITH {RECORDS},
      docs AS (SELECT DISTINCT ON (key) key, title, coalesce(abstract, '') AS abstract, coalesce(array_to_string(seen_in_categories, ' '), '') AS cats FROM keyed WHERE key IS NOT NULL ORDER BY key, record_no),
      found AS (SELECT *, lower(coalesce(title, '') || chr(1) || abstract || chr(1) || cats) AS whole FROM docs),
      strict AS (SELECT * FROM found WHERE {" AND ".join(f"contains(whole, '{t}')" for t in terms)} ORDER BY key LIMIT 1000),
      loose AS (SELECT * FROM found WHERE ({" OR ".join(f"contains(whole, '{t}')" for t in terms)}) AND (SELECT count(*) FROM strict) < 50 ORDER BY key LIMIT (SELECT 1000 - count(*) FROM strict)),
      pool AS (SELECT * FROM strict UNION ALL SELECT * FROM loose WHERE key NOT IN (SELECT key FROM strict)),
      flat AS (SELECT *, {_FLAT.format("coalesce(title, '')")} AS t, {_FLAT.format("abstract")} AS a, {_FLAT.format("cats")} AS c FROM pool),
      scored AS (SELECT key, trim(title, ' ') AS title,
        4.0 * ({met("t")}) + 1.5 * ({met("a")}) + 2.5 * ({met("c")}) + 12.0 * contains(t, '{phrase}')::INT + 6.0 * contains(a, '{phrase}')::INT
        + 5.0 / {len(terms)} * ({" + ".join(f"(contains(t, '{t}') OR contains(a, '{t}') OR contains(c, '{t}'))::INT" for t in terms)}) AS score,
        concat_ws(',', CASE WHEN regexp_matches(a, '{"|".join(terms)}') THEN 'abstract' END, CASE WHEN regexp_matches(c, '{"|".join(terms)}') THEN 'seen_in_categories' END,
          CASE WHEN regexp_matches(t, '{"|".join(terms)}') THEN 'title' END) AS matched FROM flat)
      SELECT row_number() OVER (ORDER BY round(score, 9) DESC, lower(title), key) AS rank, key, title, round(score, 6) AS score, matched FROM scored WHERE score > 0 AND title <> '' QUALIFY rank <= 50"""


ORACLE["topic_recall"] = _topic(["retrieval", "augmented", "planning"], "retrieval augmented planning")
ORACLE["topic_recall_stopwords"] = _topic(["agents", "that", "using", "memory"], "agents that are using memory")
_ORDERED = TRIMMED.format("coalesce(seen_in_sources, [])")
ORACLE["set_operations"] = f"""WITH {RECORDS},
  raw AS (SELECT record_no, {_ORDERED} AS l, coalesce(seen_in_categories, []) AS cats FROM records),
  lists AS (SELECT record_no, list_filter(l, lambda x, i: list_position(l, x) = i) AS u, cats FROM raw)
  SELECT record_no, array_to_string(u, '|') AS ordered, array_to_string(CASE WHEN list_contains(u, 'arXiv') THEN u ELSE list_append(u, 'arXiv') END, '|') AS grown,
    len(list_filter(u, lambda x: x <> 'arXiv' AND x <> 'OpenReview')) AS others, array_to_string(list_sort(list_distinct(list_concat(u, cats))), '|') AS united FROM lists"""
_SHORT = "trim(regexp_replace(coalesce(title, ''), '\\s+', ' ', 'g'), ' ')"
ORACLE["title_functions"] = f"""WITH {RECORDS}, flat AS (SELECT *, {_SHORT} AS f, trim(coalesce(accepted_by, ''), ' ') AS v FROM records)
  SELECT record_no, CASE WHEN length(f) > 40 THEN substring(f, 1, 40) ELSE f END AS short, CASE WHEN length(f) > 40 THEN rtrim(substring(f, 1, 40), ' ') || '...' ELSE f END AS dotted,
    trim(replace(replace(coalesce(title, ''), '|', '\\|'), chr(10), ' '), ' ') AS cell, nullif(trim(regexp_replace(title, '[^A-Za-z0-9._-]+', '-', 'g'), '.-_'), '') AS component,
    translate(trim(title, ' '), '/\\: -', '_____') AS safe, round(CASE WHEN len(regexp_extract_all(coalesce(title, ''), '\\p{{L}}')) > 0 THEN len(regexp_extract_all(title, '\\p{{Lu}}')) / len(regexp_extract_all(title, '\\p{{L}}')) ELSE 0.0 END, 6) AS uppercase,
    CASE {" ".join(f"WHEN contains(lower(v), '{p}') THEN '{n}'" for p, n in ACCEPTANCES)}
      ELSE upper(substring(regexp_extract(lower(v), '(\\S*)$', 1), 1, 1)) || substring(regexp_extract(lower(v), '(\\S*)$', 1), 2) END AS accept_type,
    coalesce(strftime(crawled_at, '%Y-%m-%d'), '') AS day, strftime(crawled_at + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S') || '+08:00' AS local FROM flat"""

_ASKED = ", ".join(f"('{c}', '{t}', {len(terms)})" for c, terms in CASE_TERMS.items() for t in terms)
ORACLE["suite_chunks"] = f"""WITH {TOKENS},
  terms(case_id, term, terms) AS (VALUES {_ASKED}),
  sets AS (SELECT DISTINCT CASE retriever_name WHEN 'bm25_fulltext' THEN 'c1' WHEN 'vector' THEN 'c2' END AS case_id, paper_id FROM chunk_hits WHERE retriever_name IN ('bm25_fulltext', 'vector') UNION SELECT 'c3', paper_id FROM chunk_hits),
  own AS (SELECT s.case_id, w.* FROM weighted w JOIN sets s ON w.paper_id = s.paper_id),
  totals AS (SELECT case_id, count(*) AS n, avg(len(tokens)) AS average FROM own GROUP BY case_id),
  counts AS (SELECT o.case_id, paper_id, chunk_index, chunk_id, len(tokens) AS length, term, terms, len(list_filter(tokens, lambda x: x = term)) AS tf FROM own o JOIN terms t ON t.case_id = o.case_id),
  matched AS (SELECT * FROM counts WHERE tf > 0),
  df AS (SELECT case_id, term, count(*) AS df FROM matched GROUP BY ALL),
  scored AS (SELECT case_id, paper_id, chunk_index, chunk_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * length / average))) AS score, count(*) / any_value(terms) AS coverage
    FROM matched JOIN df USING (case_id, term) JOIN totals USING (case_id) GROUP BY ALL)
  SELECT case_id, row_number() OVER (PARTITION BY case_id ORDER BY round(score, 9) DESC, coverage DESC, paper_id, chunk_index, chunk_id) AS rank, paper_id, chunk_id, round(score, 6) AS score, round(coverage, 6) AS coverage
  FROM scored QUALIFY rank <= 100"""
ORACLE["suite_vectors"] = f"""WITH {VECTORS},
  turned AS (SELECT c AS case_id, list_concat(d[i + 1:], d[1:i])::DOUBLE[] AS q FROM (SELECT {DIRECTION} AS d), (VALUES ('c1', 0), ('c2', 1), ('c3', 2)) AS v(c, i)),
  each AS (SELECT case_id, paper_id, embedding_id, CASE WHEN list_sum(list_transform(vector, lambda x: x * x)) = 0 THEN 0.0 ELSE list_cosine_similarity(vector, q) END AS score FROM usable CROSS JOIN turned)
  SELECT case_id, row_number() OVER (PARTITION BY case_id ORDER BY round(score, 12) DESC, paper_id DESC, embedding_id DESC) AS rank, paper_id, embedding_id, round(score, 6) AS score FROM each QUALIFY rank <= 100"""
ORACLE["preprint_records"] = f"""WITH {RECORDS}
  SELECT title_id AS paper_id, count(*) AS n, max(len(list_filter(coalesce(authors, []), lambda a: trim(a.name, ' ') <> ''))) AS authors, max(length(trim(regexp_replace(coalesce(abstract, ''), '\\s+', ' ', 'g'), ' '))) AS longest,
    max('https://arxiv.org/pdf/' || regexp_extract(coalesce(base_urls['arxiv_url'], ''), '/abs/(.+)$', 1)) AS pdf FROM keyed WHERE title_id IS NOT NULL GROUP BY title_id"""

_SEGMENTED = rf"""
fused AS (SELECT coalesce(p.paper_id, s.paper_id) AS paper_id, 0.7 * coalesce(p.relative, 0.0) + 0.3 * coalesce(s.relative, 0.0) AS score, 0.7 * coalesce(p.rank_score, 0.0) + 0.3 * coalesce(s.rank_score, 0.0) AS rank_score
  FROM p FULL JOIN s ON p.paper_id = s.paper_id),
hybrid AS (SELECT row_number() OVER (ORDER BY round(score, 9) DESC, round(rank_score, 9) DESC, paper_id DESC) AS rank, paper_id FROM fused QUALIFY rank <= 60),
near_chunks AS (
  SELECT DISTINCT ON (e.embedding_no) c.paper_id, c.score, e.chunk_id FROM compared c JOIN chunk_embeddings e ON e.embedding_id = c.embedding_id),
near_ranked AS (SELECT row_number() OVER (ORDER BY round(score, 12) DESC, paper_id DESC, chunk_id DESC) AS rank, * FROM near_chunks QUALIFY rank <= 300),
evidence AS (
  SELECT paper_id, chunk_id, 'bm25' AS source FROM (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY rank) AS p FROM hits) WHERE p <= 3
  UNION SELECT paper_id, split_part(chunk_id, '::', 1), 'vector' FROM (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY rank) AS p FROM near_ranked) WHERE p <= 3),
merged AS (SELECT e.paper_id, e.chunk_id, string_agg(DISTINCT source, '+' ORDER BY source) AS sources, any_value(c.text) AS text FROM evidence e JOIN once c ON c.chunk_id = e.chunk_id WHERE length(c.text) > 0 GROUP BY ALL),
cut AS (SELECT h.rank AS original_rank, m.*, CASE WHEN length(text) <= 400 THEN 1 ELSE ((length(text) - 400 + 349) // 350) + 1 END AS n FROM merged m JOIN hybrid h ON h.paper_id = m.paper_id WHERE h.rank <= 40),
each AS (SELECT *, unnest(range(n)) AS i FROM cut),
segmented AS (SELECT original_rank, paper_id, chunk_id, CASE WHEN n = 1 THEN chunk_id ELSE chunk_id || '::rerank-segment-' || lpad(i::VARCHAR, 4, '0') END AS segment_id, n AS segment_count, i * 350 AS char_start,
  least(i * 350 + 400, length(text)) AS char_end, sources, substring(text, i * 350 + 1, 400) AS segment FROM each)
"""
_HYBRID = f"""{BM25}, {VECTORS}, {_normalized("p", "bm25_papers")}, {_normalized("s", "vector_papers")}, {_SEGMENTED}"""
_TERM_LIST = "[" + ", ".join(f"'{t}'" for t in QUERY_TERMS) + "]"
ORACLE["rerank_segments"] = f"WITH {_HYBRID} SELECT original_rank, paper_id, segment_id, segment_count, char_start, char_end, false AS conflict, sources, sha256(segment) AS segment_hash FROM segmented"
ORACLE["reranked_hybrid"] = f"""WITH {_HYBRID},
  weighed AS (SELECT *, len(list_intersect(regexp_extract_all(lower(segment), '[a-z0-9]+(?:''[a-z0-9]+)?'), {_TERM_LIST})) / {len(QUERY_TERMS)}.0 AS score FROM segmented),
  best_segments AS (SELECT * FROM weighed QUALIFY row_number() OVER (PARTITION BY paper_id, chunk_id ORDER BY score DESC, segment_id DESC) = 1),
  top_segments AS (SELECT * FROM best_segments QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY score DESC, segment_id) <= 3),
  averaged AS (SELECT paper_id, any_value(original_rank) AS original_rank, avg(score) AS score, count(*) AS chunks FROM top_segments GROUP BY paper_id)
  SELECT row_number() OVER (ORDER BY round(score, 12) DESC, paper_id) AS rank, original_rank, paper_id, round(score, 6) AS score, chunks FROM averaged"""
ORACLE["reranked_texts"] = f"""WITH blocks AS (SELECT DISTINCT block_no, len(list_intersect(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+(?:''[a-z0-9]+)?'), {_TERM_LIST})) / {len(QUERY_TERMS)}.0 AS score FROM md_blocks)
  SELECT row_number() OVER (ORDER BY score DESC, block_no) AS rank, block_no, round(score, 6) AS score FROM blocks QUALIFY rank <= 100"""
ORACLE["chunk_ids"] = r"""WITH once AS (SELECT DISTINCT ON (chunk_id) * FROM chunks ORDER BY chunk_id)
  SELECT chunk_id, sha256('{"chunk_index":' || chunk_index || ',"content_sha256":"' || content_sha256 || '","page_end":' || page_end || ',"page_start":' || page_start || ',"paper_id":"' || paper_id || '","schema_version":1,"section_path":'
    || to_json(section_path) || ',"source_markdown_sha256":"' || source_markdown_sha256 || '","source_parser_name":"' || source_parser_name || '","source_parser_version":"' || source_parser_version || '","source_pdf_sha256":"' || source_pdf_sha256
    || '","splitter_name":"' || splitter_name || '","splitter_options":{' || array_to_string(list_transform(list_sort(map_entries(splitter_options)), lambda e: '"' || e.key || '":' || e.value), ',') || '},"splitter_version":"' || splitter_version || '"}') AS made_id FROM once"""
ORACLE["subchunk_embeddings"] = r"""WITH once AS (SELECT DISTINCT ON (chunk_id) chunk_id, content_sha256, text FROM chunks WHERE length(text) > 0 ORDER BY chunk_id),
  cut AS (SELECT *, CASE WHEN length(text) <= 300 THEN 1 ELSE ((length(text) - 300 + 259) // 260) + 1 END AS n FROM once),
  pieces AS (SELECT *, unnest(range(n)) AS place FROM cut),
  kept AS (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY place) - 1 AS i, count(*) OVER (PARTITION BY chunk_id) AS c FROM pieces WHERE n = 1 OR regexp_matches(substring(text, place * 260 + 1, 300), '\S')),
  named AS (SELECT *, CASE WHEN c = 1 THEN chunk_id ELSE chunk_id || '::subchunk-' || lpad(i::VARCHAR, 4, '0') END AS own FROM kept)
  SELECT sha256(own || chr(10) || 'token-hash' || chr(10) || 'v1' || chr(10) || '128' || chr(10) || content_sha256) AS embedding_id, own AS chunk_id, chunk_id AS source_chunk_id, i AS subchunk_index, c AS subchunk_count, place * 260 AS char_start,
    least(place * 260 + 300, length(text)) AS char_end, c > 1 AS is_subchunk, 128 AS size, 1.0::DOUBLE AS norm FROM named"""
ORACLE["manifest_reasons"] = """WITH papers_of AS (
    SELECT paper_id, ('0x' || right(paper_id, 2))::INT % 16 AS fault, count(DISTINCT chunk_id) AS n, min(chunk_index) = 0 AND max(chunk_index) = count(DISTINCT chunk_id) - 1 AND count(DISTINCT chunk_index) = count(DISTINCT chunk_id) AS running,
      count(DISTINCT source_markdown_sha256) = 1 AS one_markdown, count(DISTINCT source_pdf_sha256) = 1 AS one_pdf, count(DISTINCT source_parser_name) = 1 AND count(DISTINCT source_parser_version) = 1 AS one_parser FROM chunks GROUP BY paper_id)
  SELECT CASE WHEN fault < 8 THEN ['paper_id', 'splitter_name', 'splitter_version', 'splitter_options', 'chunks_path', 'chunk_count', 'chunk_ids', 'chunks_sha256'][fault + 1] WHEN fault = 8 THEN 'chunk_paper_id'
    WHEN fault = 9 OR NOT running THEN 'chunk_index' WHEN fault = 10 OR NOT one_markdown THEN 'chunk_markdown_sha256' WHEN fault = 11 OR NOT one_pdf THEN 'chunk_pdf_sha256' WHEN fault = 12 OR NOT one_parser THEN 'chunk_parser' ELSE 'sound' END AS reason,
    count(*) AS n FROM papers_of GROUP BY 1"""
ORACLE["token_hash_embeddings"] = r"""WITH once AS (SELECT DISTINCT ON (chunk_id) chunk_id, text FROM chunks ORDER BY chunk_id),
  tokens AS (SELECT chunk_id, lower(unnest(regexp_extract_all(text, '[A-Za-z0-9_]+'))) AS t FROM once),
  placed AS (SELECT chunk_id, ('0x' || substring(sha256(t), 1, 16))::UBIGINT % 128 AS b, CASE WHEN ('0x' || substring(sha256(t), 17, 2))::INT % 2 = 0 THEN 1.0 ELSE -1.0 END AS sign FROM tokens),
  summed AS (SELECT chunk_id, b, sum(sign) AS x FROM placed GROUP BY ALL),
  lengths AS (SELECT chunk_id, sqrt(sum(x * x)) AS l FROM summed GROUP BY chunk_id),
  unit AS (SELECT chunk_id, b, x / l AS v FROM summed JOIN lengths USING (chunk_id))
  SELECT chunk_id, 128 AS size, round(sqrt(sum(v * v)), 6) AS norm, round(coalesce(sum(v) FILTER (b = 0), 0.0), 6) AS v0, round(coalesce(sum(v) FILTER (b = 1), 0.0), 6) AS v1, round(coalesce(sum(v) FILTER (b = 64), 0.0), 6) AS v64,
    round(coalesce(sum(v) FILTER (b = 127), 0.0), 6) AS v127, round(sum(v * (b::INT + 1)), 4) AS by_place FROM unit GROUP BY chunk_id"""
ORACLE["document_checks"] = r"""WITH once AS (SELECT DISTINCT ON (page_no) *, trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(13)) AS t FROM ocr_pages ORDER BY page_no),
  papers_of AS (SELECT paper_id, count(DISTINCT page_index) AS pages, sum(length(t)) AS chars, string_agg('<!-- page: ' || (page_index + 1) || ' -->' || chr(10) || chr(10) || t, chr(10) || chr(10) ORDER BY page_index) || chr(10) AS md,
    count(*) AS rows_of, count(*) FILTER (success) AS good FROM once GROUP BY paper_id),
  known AS (SELECT DISTINCT paper_id FROM papers_of),
  measured AS (SELECT *, length(regexp_replace(regexp_replace(md, '<!--\s*page:\s*\d+\s*-->', '', 'g'), '^\s+|\s+$', '', 'g')) AS actual, len(regexp_extract_all(md, '<!--\s*page:\s*\d+\s*-->')) AS markers FROM papers_of),
  rated AS (SELECT *, CASE WHEN greatest(chars, actual) = 0 THEN 1.0 ELSE least(chars, actual) / greatest(chars, actual) END AS ratio, actual / pages AS per_page FROM measured),
  listed AS (SELECT paper_id, unnest([
    {'name': 'markdown_exists', 'passed': true, 'score': 1.0::DOUBLE, 'weight': 2.0::DOUBLE, 'critical': true}, {'name': 'page_count_valid', 'passed': pages > 0, 'score': (pages > 0)::INT::DOUBLE, 'weight': 2.0::DOUBLE, 'critical': true},
    {'name': 'page_markers_match', 'passed': markers = pages, 'score': least(markers / pages, 1.0)::DOUBLE, 'weight': 2.0::DOUBLE, 'critical': true}, {'name': 'markdown_non_empty', 'passed': actual > 0, 'score': (actual > 0)::INT::DOUBLE, 'weight': 2.0::DOUBLE, 'critical': true},
    {'name': 'char_count_consistency', 'passed': ratio >= 0.95, 'score': ratio::DOUBLE, 'weight': 1.0::DOUBLE, 'critical': false}, {'name': 'average_chars_per_page', 'passed': per_page >= 100, 'score': least(per_page / 500, 1.0)::DOUBLE, 'weight': 1.0::DOUBLE, 'critical': false},
    {'name': 'parse_report', 'passed': good = pages AND rows_of = pages, 'score': least(good / pages, 1.0)::DOUBLE, 'weight': 2.0::DOUBLE, 'critical': true}]) AS c FROM rated)
  SELECT paper_id, c.name AS name, c.passed AS passed, round(c.score, 6) AS score, c.weight AS weight, c.critical AS critical FROM listed"""
ORACLE["suite_hybrid"] = f"""WITH {TOKENS}, {VECTORS},
  terms(case_id, term, terms) AS (VALUES {_ASKED}),
  totals AS (SELECT count(*) AS n, avg(len(tokens)) AS average FROM weighted),
  matched AS (SELECT * FROM (SELECT t.case_id, paper_id, chunk_index, chunk_id, len(tokens) AS length, term, terms, len(list_filter(tokens, lambda x: x = term)) AS tf FROM weighted CROSS JOIN terms t) WHERE tf > 0),
  df AS (SELECT case_id, term, count(*) AS df FROM matched GROUP BY ALL),
  scored AS (SELECT case_id, paper_id, chunk_index, chunk_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * length / average))) AS score, count(*) / any_value(terms) AS coverage
    FROM matched JOIN df USING (case_id, term) CROSS JOIN totals GROUP BY ALL),
  lexical_hits AS (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY round(score, 9) DESC, coverage DESC, paper_id, chunk_index, chunk_id) AS rank FROM scored QUALIFY rank <= 300),
  lexical_top AS (SELECT *, row_number() OVER (PARTITION BY case_id, paper_id ORDER BY round(score, 12) DESC, rank) AS place FROM lexical_hits QUALIFY place <= 3),
  lexical AS (SELECT case_id, paper_id, score, row_number() OVER (PARTITION BY case_id ORDER BY round(score, 9) DESC, paper_id) AS rank FROM (
    SELECT case_id, paper_id, max(score) + 0.5 * avg(score) + 0.5 * max(coverage) AS score FROM lexical_top GROUP BY ALL)),
  turned AS (SELECT c AS case_id, list_concat(d[i + 1:], d[1:i])::DOUBLE[] AS q FROM (SELECT {DIRECTION} AS d), (VALUES ('c1', 0), ('c2', 1), ('c3', 2)) AS v(c, i)),
  all_papers AS (SELECT DISTINCT paper_id FROM chunks),
  vector_hits AS (SELECT case_id, paper_id, score, row_number() OVER (PARTITION BY case_id ORDER BY round(score, 12) DESC, paper_id DESC, embedding_id DESC) AS rank FROM (
    SELECT case_id, paper_id, embedding_id, CASE WHEN list_sum(list_transform(vector, lambda x: x * x)) = 0 THEN 0.0 ELSE list_cosine_similarity(vector, q) END AS score FROM usable CROSS JOIN turned WHERE paper_id IN (SELECT paper_id FROM all_papers)) QUALIFY rank <= 300),
  vector_top AS (SELECT *, row_number() OVER (PARTITION BY case_id, paper_id ORDER BY round(score, 12) DESC, rank) AS place FROM vector_hits QUALIFY place <= 3),
  near_side AS (SELECT case_id, paper_id, score, row_number() OVER (PARTITION BY case_id ORDER BY round(score, 12) DESC, paper_id DESC) AS rank FROM (
    SELECT case_id, paper_id, 0.7 * max(score) + 0.3 * avg(score) AS score FROM vector_top GROUP BY ALL)),
  {_normalized("p", "lexical", "case_id")}, {_normalized("s", "near_side", "case_id")},
  fused AS (SELECT coalesce(p.case_id, s.case_id) AS case_id, coalesce(p.paper_id, s.paper_id) AS paper_id, 0.7 * coalesce(p.relative, 0.0) + 0.3 * coalesce(s.relative, 0.0) AS score, 0.7 * coalesce(p.rank_score, 0.0) + 0.3 * coalesce(s.rank_score, 0.0) AS rank_score
    FROM p FULL JOIN s ON p.case_id = s.case_id AND p.paper_id = s.paper_id),
  ranking AS (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY round(score, 9) DESC, round(rank_score, 9) DESC, paper_id DESC) AS rank FROM fused QUALIFY rank <= 20),
  judged AS (SELECT case_id, paper_id, ('0x' || substring(paper_id, i, 1))::INT % 4 AS grade FROM all_papers CROSS JOIN (VALUES ('c1', 1), ('c2', 2), ('c3', 3)) AS v(case_id, i)),
  ideal AS (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY grade DESC, paper_id) AS place FROM judged),
  ks AS (SELECT unnest([1, 5, 10]) AS k),
  wide AS (SELECT case_id, k, count(*) FILTER (grade >= 2) AS relevant_count, sum(CASE WHEN place <= k THEN (pow(2, grade) - 1) / log2(place + 1) ELSE 0 END) AS ideal FROM ideal CROSS JOIN ks GROUP BY ALL),
  met AS (SELECT r.case_id, r.rank, coalesce(grade, 0) AS grade, (coalesce(grade, 0) >= 2)::INT AS relevant, sum((coalesce(grade, 0) >= 2)::INT) OVER (PARTITION BY r.case_id ORDER BY r.rank) AS seen FROM ranking r LEFT JOIN judged j ON j.case_id = r.case_id AND j.paper_id = r.paper_id),
  actual AS (SELECT case_id, k, count(*) AS retrieved_count, sum(CASE WHEN rank <= k THEN relevant ELSE 0 END) AS found, sum(CASE WHEN rank <= k THEN (pow(2, grade) - 1) / log2(rank + 1) ELSE 0 END) AS gain, min(CASE WHEN relevant = 1 THEN rank END) AS first,
    sum(CASE WHEN relevant = 1 THEN seen / rank ELSE 0 END) AS precisions FROM met CROSS JOIN ks GROUP BY ALL)
  SELECT case_id, k, round(found / k, 6) AS precision, round(CASE WHEN relevant_count > 0 THEN found / relevant_count ELSE 0.0 END, 6) AS recall, round(CASE WHEN ideal > 0 THEN gain / ideal ELSE 0.0 END, 6) AS ndcg, round(coalesce(1.0 / first, 0.0), 6) AS reciprocal_rank,
    round(CASE WHEN relevant_count > 0 THEN precisions / relevant_count ELSE 0.0 END, 6) AS average_precision, relevant_count, retrieved_count FROM wide JOIN actual USING (case_id, k)"""
ORACLE["run_counters"] = """WITH once AS (SELECT DISTINCT ON (page_no) * FROM ocr_pages ORDER BY page_no),
  counted AS (SELECT coalesce(backend_name, '<missing>') AS backend_name, coalesce(success::VARCHAR, '<missing>') AS success, (coalesce(error_note, '') <> '')::VARCHAR AS noted, count(*) AS n FROM once GROUP BY ALL)
  SELECT * FROM counted UNION ALL SELECT 'all', 'all', 'all', sum(n)::BIGINT FROM counted"""
ORACLE["run_summaries"] = f"""WITH {SUITE} SELECT split_part(case_id, '/', -1) AS run, count(*) AS cases, round(avg(reciprocal_rank), 6) AS macro_reciprocal_rank, round(avg(average_precision), 6) AS macro_average_precision,
  round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall, round(avg(ndcg), 6) AS macro_ndcg FROM metrics WHERE k = 5 GROUP BY 1"""
ORACLE["missing_papers"] = """WITH sides AS (SELECT search_id, paper_id, count(DISTINCT retriever_name) AS n FROM chunk_hits WHERE paper_id IS NOT NULL AND retriever_name IN ('bm25_fulltext', 'vector') GROUP BY ALL)
  SELECT search_id, string_agg(paper_id, ',' ORDER BY paper_id) AS ids FROM sides WHERE n = 1 GROUP BY search_id"""
ORACLE["saved_rankings"] = """WITH once AS (SELECT DISTINCT ON (hit_no) * FROM chunk_hits WHERE paper_id IS NOT NULL ORDER BY hit_no),
  saved AS (SELECT search_id || '/' || retriever_name AS case_id, list(trim(paper_id, ' ')) AS ids FROM once GROUP BY 1)
  SELECT case_id, CASE WHEN len(list_filter(ids, lambda x: x = '')) > 0 THEN 'hit_without_id' WHEN len(list_distinct(ids)) < len(ids) THEN 'repeated_id' ELSE 'sound' END AS reason,
    CASE WHEN len(list_filter(ids, lambda x: x = '')) = 0 AND len(list_distinct(ids)) = len(ids) THEN len(ids) ELSE 0 END AS ids FROM saved"""
_LEXICAL = ORACLE["suite_hybrid"][ORACLE["suite_hybrid"].index("  terms(case_id") : ORACLE["suite_hybrid"].index("  turned AS")]
ORACLE["suite_rerank"] = f"""WITH {TOKENS}, {_LEXICAL.replace("rank <= 300", "rank <= 200")}
  ranking AS (SELECT * FROM lexical WHERE rank <= 40),
  best AS (SELECT h.case_id, h.paper_id, h.chunk_id, h.coverage AS score, row_number() OVER (PARTITION BY h.case_id, h.paper_id ORDER BY round(h.coverage, 12) DESC, h.chunk_id) AS p FROM lexical_hits h JOIN ranking USING (case_id, paper_id)),
  averaged AS (SELECT case_id, paper_id, avg(score) AS score, count(*) AS chunks FROM best WHERE p <= 3 GROUP BY ALL)
  SELECT case_id, row_number() OVER (PARTITION BY case_id ORDER BY round(a.score, 12) DESC, paper_id) AS rank, r.rank AS original_rank, paper_id, round(a.score, 6) AS score, chunks FROM averaged a JOIN ranking r USING (case_id, paper_id)"""
_QUERY_TOKENS = ", ".join(f"('{c}', '{t}')" for c, q in (("c1", "relevance of cautious rankers"), ("c2", "memory and agents under private data"), ("c3", "translation of long documents")) for t in q.split())
ORACLE["suite_token_hash"] = rf"""WITH once AS (SELECT DISTINCT ON (chunk_id) chunk_id, paper_id, text FROM chunks WHERE length(text) > 0 ORDER BY chunk_id),
  cut AS (SELECT *, CASE WHEN length(text) <= 3200 THEN 1 ELSE ((length(text) - 3200 + 2999) // 3000) + 1 END AS n FROM once),
  pieces AS (SELECT *, unnest(range(n)) AS place FROM cut),
  kept AS (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY place) - 1 AS i, count(*) OVER (PARTITION BY chunk_id) AS c, substring(text, place * 3000 + 1, 3200) AS piece FROM pieces WHERE n = 1 OR regexp_matches(substring(text, place * 3000 + 1, 3200), '\S')),
  named AS (SELECT paper_id, CASE WHEN c = 1 THEN chunk_id ELSE chunk_id || '::subchunk-' || lpad(i::VARCHAR, 4, '0') END AS own, piece FROM kept),
  tokens AS (SELECT own, lower(unnest(regexp_extract_all(piece, '[A-Za-z0-9_]+'))) AS t FROM named UNION ALL SELECT * FROM (VALUES {_QUERY_TOKENS}) AS q(own, t)),
  summed AS (SELECT own, ('0x' || substring(sha256(t), 1, 16))::UBIGINT % 128 AS b, sum(CASE WHEN ('0x' || substring(sha256(t), 17, 2))::INT % 2 = 0 THEN 1.0 ELSE -1.0 END) AS x FROM tokens GROUP BY ALL),
  unit AS (SELECT own, b, x / sqrt(sum(x * x) OVER (PARTITION BY own)) AS v FROM summed),
  compared AS (SELECT q.own AS case_id, u.own, sum(u.v * q.v) AS score FROM unit u JOIN unit q ON q.b = u.b AND q.own IN ('c1', 'c2', 'c3') AND u.own NOT IN ('c1', 'c2', 'c3') GROUP BY ALL),
  every AS (SELECT case_id, paper_id, n.own, coalesce(score, 0.0) AS score FROM named n CROSS JOIN (VALUES ('c1'), ('c2'), ('c3')) AS c(case_id) LEFT JOIN compared USING (case_id, own)),
  hits AS (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY round(score, 12) DESC, paper_id DESC, own DESC) AS rank FROM every QUALIFY rank <= 300),
  top AS (SELECT *, row_number() OVER (PARTITION BY case_id, paper_id ORDER BY round(score, 12) DESC, rank) AS p FROM hits QUALIFY p <= 3),
  papers_of AS (SELECT case_id, paper_id, 0.7 * max(score) + 0.3 * avg(score) AS score FROM top GROUP BY ALL)
  SELECT case_id, row_number() OVER (PARTITION BY case_id ORDER BY round(score, 12) DESC, paper_id DESC) AS rank, paper_id, round(score, 6) AS score FROM papers_of QUALIFY rank <= 20"""
