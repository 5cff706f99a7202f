"""Rows of different sources as paper records of one schema, and the small rules that the sources need."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.ids import paper_id_from_title
from folioflow.functions.text import absolute_url, accept_type, collapsed, day_text, split_names, without_version

VERSION = 4


def people(names: Column) -> Column:
    """An array of names as authors without affiliation and homepage; blank names are left out."""
    kept = F.filter(F.coalesce(names, F.array().cast("array<string>")), lambda n: F.trim(n) != "")
    return F.transform(kept, lambda n: F.struct(F.trim(n).alias("name"), F.lit("").alias("affiliation"), F.lit("").alias("homepage")))


def paper_record(rows: DataFrame, title: Column, authors: Column, abstract: Column, accepted_by: Column, urls: dict[str, Column], more: dict[str, Column] | None = None, keywords: Column | None = None) -> DataFrame:
    """``paper_id, title, authors, abstract, accepted_by, keywords, base_urls, more_urls, schema_version``; rows without a usable title are left out."""
    def table(entries: dict[str, Column] | None) -> Column:
        pairs = [x for k, v in (entries or {}).items() for x in (F.lit(k), F.coalesce(v, F.lit("")))]
        return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")

    made = rows.select(
        paper_id_from_title(title).alias("paper_id"), title.alias("title"), authors.alias("authors"), F.coalesce(abstract, F.lit("")).alias("abstract"), accepted_by.alias("accepted_by"),
        F.coalesce(keywords if keywords is not None else F.lit(None), F.array().cast("array<string>")).alias("keywords"), table(urls).alias("base_urls"), table(more).alias("more_urls"), F.lit(VERSION).alias("schema_version"),
    )
    return made.where("paper_id is not null")


def from_preprints(rows: DataFrame, base: str = "https://arxiv.org") -> DataFrame:
    """From ``short_id, title, summary, authors, published, updated, categories``: the version suffix goes, white space is collapsed."""
    plain = without_version(F.col("short_id"))
    urls = {"arxiv_url": F.concat(F.lit(f"{base}/abs/"), plain), "arxiv_pdf_url": F.concat(F.lit(f"{base}/pdf/"), plain)}
    return paper_record(rows, collapsed(F.col("title")), people(F.col("authors")), collapsed(F.col("summary")), F.lit("arXiv"), urls)


def version_history(short_id: Column, published: Column, updated: Column) -> Column:
    """The known versions with their days: the id's own, and the latest where it was updated on another day."""
    own = F.nullif(F.regexp_extract(short_id, r"(v\d+)$", 1), F.lit(""))
    first = F.struct(F.coalesce(own, F.lit("v1")).alias("version"), day_text(published).alias("date"))
    latest = F.struct(F.lit("latest").alias("version"), day_text(updated).alias("date"))
    changed = (day_text(updated) != "") & (day_text(updated) != day_text(published))
    return F.when(changed, F.array(first, latest)).otherwise(F.array(first))


def content_value(content: Column, key: str) -> Column:
    """A value of a JSON object that is given plainly or as {"value": ...}, as text; empty where missing."""
    wrapped, plain = F.get_json_object(content, f"$.{key}.value"), F.get_json_object(content, f"$.{key}")
    return F.coalesce(wrapped, plain, F.lit(""))


def content_list(content: Column, key: str) -> Column:
    """As ``content_value``, for a list of texts; empty where it is no list."""
    return F.coalesce(F.from_json(content_value(content, key), "array<string>"), F.array().cast("array<string>"))


def from_reviews(rows: DataFrame, venue: str, year: int, base: str) -> DataFrame:
    """From ``forum, content`` (JSON of a review note)."""
    content = F.col("content")
    pdf, more = absolute_url(content_value(content, "pdf"), base), absolute_url(content_value(content, "supplementary_material"), base)
    urls = {"openreview_forum_url": F.concat(F.lit(f"{base}/forum?id="), F.col("forum")), "openreview_pdf_url": pdf}
    made = paper_record(rows.withColumn("kind", accept_type(content_value(content, "venue"))), collapsed(content_value(content, "title")), people(content_list(content, "authors")), collapsed(content_value(content, "abstract")), F.lit(f"{venue} {year}"), urls, {"supplementary_material_url": more, "accept_type": F.col("kind")}, content_list(content, "keywords"))
    return made


def from_volume(rows: DataFrame, accepted_by: str, volume_url: str) -> DataFrame:
    """From ``title, authors_text, abstract, abs_url, pdf_url, publication_date, firstpage, lastpage`` of a proceedings volume."""
    urls = {"pmlr_abs_url": F.col("abs_url"), "pmlr_pdf_url": F.col("pdf_url")}
    more = {"pmlr_volume_url": F.lit(volume_url), "pmlr_publication_date": F.col("publication_date"), "pmlr_firstpage": F.col("firstpage"), "pmlr_lastpage": F.col("lastpage")}
    return paper_record(rows, F.col("title"), people(split_names(F.col("authors_text"))), F.col("abstract"), F.lit(accepted_by), urls, more)


def clean_abstract(text: Column) -> Column:
    """Without the words of a folding button at its end, and without a leading label."""
    return F.trim(F.regexp_replace(F.trim(F.regexp_replace(F.trim(F.coalesce(text, F.lit(""))), r"Show (more|less)$", "")), r"^Abstract\s*", ""))


def event_number(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"/virtual/\d+/poster/(\d+)", 1)


def track_type(track: Column, issue: Column) -> Column:
    """special if issue or track says so, technical if the track does, else empty; the issue goes first."""
    a, b = F.lower(F.coalesce(issue, F.lit(""))), F.lower(F.coalesce(track, F.lit("")))
    return F.when(a.contains("special track") | b.contains("special track"), "special").when(b.contains("technical track"), "technical").otherwise("")


def kept_section(title: Column, include: Sequence[str], exclude: Sequence[str]) -> Column:
    """Whether a section title has one of the included words and none of the excluded ones, regardless of case."""
    low = F.lower(F.coalesce(title, F.lit("")))
    some, none = F.lit(False), F.lit(False)
    for word in include:
        some = some | low.contains(word.lower())
    for word in exclude:
        none = none | low.contains(word.lower())
    return some & ~none


def issue_decision(title: Column, include: Sequence[str], exclude: Sequence[str]) -> Column:
    """KEEP with only included words, MIXED with both kinds, SKIP otherwise."""
    has, bad = kept_section(title, include, ()), kept_section(title, exclude, ())
    return F.when(has & ~bad, "KEEP").when(has & bad, "MIXED").otherwise("SKIP")


def dashed_date(value: Column) -> Column:
    return F.translate(F.coalesce(value, F.lit("")), "/", "-")


def anthology_number(anthology_id: Column) -> Column:
    """The number that ends an anthology id, for numeric sorting; a large one where there is none."""
    return F.coalesce(F.nullif(F.regexp_extract(anthology_id, r"\.(\d+)$", 1), F.lit("")).cast("bigint"), F.lit(10**12))


def paired(names: Column, affiliations: Column) -> Column:
    """Authors with the affiliation at the same place; a missing one is empty, surplus ones are left out."""
    both = F.arrays_zip(F.coalesce(names, F.array().cast("array<string>")).alias("n"), F.coalesce(affiliations, F.array().cast("array<string>")).alias("a"))
    return F.transform(F.filter(both, lambda x: x["n"].isNotNull()), lambda x: F.struct(x["n"].alias("name"), F.coalesce(x["a"], F.lit("")).alias("affiliation"), F.lit("").alias("homepage")))


def safe_id(value: Column) -> Column:
    """The trimmed id; null where it is blank or has a path separator."""
    clean = F.trim(value)
    return F.when((clean != "") & ~clean.rlike(r"[/\\]"), clean)


def stored_checks(checks: Column) -> Column:
    """An array of named checks as a map from name to the rest."""
    return F.map_from_entries(F.transform(checks, lambda c: F.struct(c["name"].alias("key"), F.struct(c["passed"].alias("passed"), c["score"].alias("score"), c["weight"].alias("weight"), c["critical"].alias("critical")).alias("value"))))
