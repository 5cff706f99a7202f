"""Content hashes, record ids and canonical JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def looks_like_sha256(value: Column) -> Column:
    return F.coalesce(value.rlike("^[0-9a-fA-F]{64}$"), F.lit(False))


def canonical_json(fields: dict[str, Column]) -> Column:
    """Compact JSON with sorted keys; nulls are kept. Control characters are escaped in upper-case hexadecimal."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


#: Control characters whose escapes have letters, which JSON allows in both cases.
LETTERED = [f"{c:04X}" for c in (*range(0x0B, 0x10), *range(0x1A, 0x20)) if chr(c) not in "\f\r"]


def lower_escapes(json: Column) -> Column:
    """JSON with its control characters escaped in lower-case hexadecimal."""
    for code in LETTERED:
        json = F.regexp_replace(json, rf"(?<!\\)((?:\\\\)*)\\u{code}", rf"$1\\u{code.lower()}")
    return json


# The fields that identify a chunk.
CHUNK_FIELDS = (
    "chunk_index", "content_sha256", "page_end", "page_start", "paper_id", "schema_version", "section_path", "source_markdown_sha256", "source_parser_name", "source_parser_version", "source_pdf_sha256", "splitter_name",
    "splitter_options", "splitter_version",
)


def chunk_id(schema_version: int = 1, prefix: str = "") -> Column:
    """The id of a chunk from its fields: SHA-256 of their canonical JSON, with the options' keys in order; ``prefix`` leads to a struct that holds them."""
    fields = {f: F.col(prefix + f) for f in CHUNK_FIELDS if f != "schema_version"}
    fields["splitter_options"] = sorted_map(fields["splitter_options"])
    return F.sha2(lower_escapes(canonical_json({**fields, "schema_version": F.lit(schema_version)})), 256)


def record_id(fields: dict[str, Column]) -> Column:
    """SHA-256 of the canonical JSON."""
    return F.sha2(canonical_json(fields), 256)


def embedding_id(chunk_id: Column, model: Column, version: Column, dimension: Column, chunk_sha256: Column) -> Column:
    """SHA-256 of the five fields, one a line."""
    return F.sha2(F.concat_ws("\n", chunk_id, model, version, dimension.cast("string"), chunk_sha256), 256)


def fingerprint(fields: dict[str, Column], digits: int = 16) -> Column:
    """The first digits of the record id."""
    return F.substring(record_id(fields), 1, digits)


def sorted_map(values: Column) -> Column:
    """A map with its keys in order, as canonical JSON needs it; null stays null."""
    return F.map_from_entries(F.array_sort(F.map_entries(values)))
