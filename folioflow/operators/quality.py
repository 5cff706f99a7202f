"""Quality checks of parsed documents as column expressions: weighted score, critical failures, status."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.ids import normalized_title

PAGE_MARKER = r"<!--\s*page:\s*\d+\s*-->"


@dataclass(frozen=True)
class Thresholds:
    average_chars: int = 100
    expected_chars: int = 500
    char_ratio: float = 0.95
    title_similarity: float = 0.60
    passing_score: float = 0.80


def count_ratio(reported: Column, actual: Column) -> Column:
    """The smaller over the larger count; 1 where both are 0."""
    return F.when(F.greatest(reported, actual) == 0, F.lit(1.0)).otherwise(F.least(reported, actual) / F.greatest(reported, actual))


def _title_similarity(titles: pd.Series, beginnings: pd.Series) -> pd.Series:
    import re
    from difflib import SequenceMatcher

    def flat(text: str) -> str:
        return " ".join(re.sub(r"[^a-z0-9\s]", " ", (text or "").lower()).split())

    def of(title, beginning):
        title = flat(title)
        if not title or title in flat(beginning):
            return 1.0
        return max((SequenceMatcher(None, title, line).ratio() for line in map(flat, (beginning or "").splitlines()) if line), default=0.0)

    return pd.Series([of(t, b) for t, b in zip(titles, beginnings)], dtype=float)


def quality_checks(documents: DataFrame, key: str, limits: Thresholds = Thresholds()) -> DataFrame:
    """``<key>, checks, score, status`` of ``title, markdown, page_count, char_count, report`` (a struct with status, page_count, pages[].success; nullable).

    ``checks`` is an array of (name, passed, score, weight, critical). A document without Markdown is rejected with score 0. Any critical failure
    rejects; any other failure, or a weighted mean below the passing score, is a warning. A skipped title or report check weighs 1.
    """
    body = F.col("markdown")
    text = F.trim(F.regexp_replace(body, PAGE_MARKER, ""))
    actual, pages = F.length(F.regexp_replace(text, r"^\s+|\s+$", "")), F.coalesce("page_count", F.lit(0))
    markers = F.regexp_count(body, F.lit(PAGE_MARKER))
    per_page = F.when(pages > 0, actual / pages).otherwise(F.lit(0.0))
    ratio = count_ratio(F.coalesce("char_count", F.lit(0)), actual)
    named = F.coalesce(normalized_title(F.col("title")), F.lit("")) != ""
    similar = F.when(named, F.pandas_udf(_title_similarity, "double")(F.col("title"), F.substring(body, 1, 5000))).otherwise(F.lit(1.0))
    good = F.coalesce(F.size(F.filter("report.pages", lambda p: p["success"])), F.lit(0))
    reported = F.col("report").isNotNull()
    sound = (F.col("report.status") == "success") & (F.col("report.page_count") == pages) & (F.size("report.pages") == pages) & (good == pages)

    def check(name: str, passed: Column, score: Column, weight, critical: bool) -> Column:
        return F.struct(F.lit(name).alias("name"), F.coalesce(passed, F.lit(False)).alias("passed"), score.cast("double").alias("score"), F.lit(weight).cast("double").alias("weight") if not isinstance(weight, Column) else weight.cast("double").alias("weight"), F.lit(critical).alias("critical"))

    one, zero = F.lit(1.0), F.lit(0.0)
    checks = F.array(
        check("markdown_exists", F.lit(True), one, 2.0, True),
        check("page_count_valid", pages > 0, F.when(pages > 0, one).otherwise(zero), 2.0, True),
        check("page_markers_match", (pages > 0) & (markers == pages), F.when(pages > 0, F.least(markers / pages, one)).otherwise(zero), 2.0, True),
        check("markdown_non_empty", actual > 0, F.when(actual > 0, one).otherwise(zero), 2.0, True),
        check("char_count_consistency", ratio >= limits.char_ratio, ratio, 1.0, False),
        check("average_chars_per_page", per_page >= limits.average_chars, F.least(per_page / limits.expected_chars, one), 1.0, False),
        check("title_match", similar >= limits.title_similarity, similar, F.when(named, 1.5).otherwise(1.0), False),
        check("parse_report", ~reported | sound, F.when(~reported, one).when(pages > 0, F.least(good / pages, one)).otherwise(zero), F.when(reported, 2.0).otherwise(1.0), True),
    )
    missing = F.array(check("markdown_exists", F.lit(False), zero, 2.0, True))
    rows = documents.select(key, F.when(body.isNull(), missing).otherwise(checks).alias("checks"))
    weight = F.aggregate("checks", F.lit(0.0), lambda a, c: a + c["weight"])
    score = F.aggregate("checks", F.lit(0.0), lambda a, c: a + c["weight"] * c["score"]) / weight
    rejected = F.exists("checks", lambda c: c["critical"] & ~c["passed"])
    doubtful = F.exists("checks", lambda c: ~c["critical"] & ~c["passed"]) | (score < limits.passing_score)
    return rows.select(key, "checks", score.alias("score"), F.when(rejected, "rejected").when(doubtful, "warning").otherwise("passed").alias("status"))


def page_markdown(pages: DataFrame) -> DataFrame:
    """``paper_id, markdown, page_count, char_count``: each paper's pages in order, each after a marker with its number (index + 1)."""
    part = F.struct("page_index", F.concat(F.lit("<!-- page: "), (F.col("page_index") + 1).cast("string"), F.lit(" -->\n\n"), F.btrim(F.coalesce("text", F.lit("")), F.lit(" \t\r\n"))).alias("t"))
    return pages.groupBy("paper_id").agg(
        F.concat(F.array_join(F.transform(F.array_sort(F.collect_set(part)), lambda p: p["t"]), "\n\n"), F.lit("\n")).alias("markdown"),
        F.count_distinct("page_index").alias("page_count"), F.sum(F.length(F.btrim(F.coalesce("text", F.lit("")), F.lit(" \t\r\n")))).alias("char_count"),
    )


def parse_reports(pages: DataFrame) -> DataFrame:
    """``paper_id, report``: a parse report's status, page count and pages from its page rows."""
    page = F.struct("page_index", F.coalesce("success", F.lit(False)).alias("success"))
    rows = pages.groupBy("paper_id").agg(F.array_sort(F.collect_set(page)).alias("pages"))
    good = F.size(F.filter("pages", lambda p: p["success"]))
    status = F.when(good == F.size("pages"), "success").when(good > 0, "partial").otherwise("failed")
    return rows.select("paper_id", F.struct(status.alias("status"), F.size("pages").alias("page_count"), "pages").alias("report"))


def backend_statistics(pages: DataFrame) -> DataFrame:
    """One row for each ``backend_name``: pages, successes, errors, papers, characters, seconds, last page index. Repeated pages count once."""
    facts = pages.select("page_no", "backend_name", "paper_id", "page_index", "duration_seconds", F.coalesce("success", F.lit(False)).alias("fine"), (F.coalesce("error_note", F.lit("")) != "").alias("failed"), F.coalesce(F.length("text"), F.lit(0)).alias("size"))
    return facts.dropDuplicates(["page_no"]).groupBy("backend_name").agg(
        F.count(F.lit(1)).alias("pages"), F.count_if("fine").alias("successful"), F.count_if("failed").alias("with_error"), F.count_distinct("paper_id").alias("papers"), F.sum("size").alias("characters"),
        F.sum(F.coalesce("duration_seconds", F.lit(0.0))).alias("seconds"), F.max("page_index").alias("last_page"),
    )


def run_counters(results: DataFrame, by: list[str], total: str = "all") -> DataFrame:
    """``*by, n`` for every combination of the outcome columns, and a last kind of row with ``total`` in all of them; null outcomes count as <missing>."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit("<missing>")).alias(c) for c in by]
    counts = results.select(*named).groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return counts.unionByName(counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(*[F.lit(total).alias(c) for c in by], "n"))
