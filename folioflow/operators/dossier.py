"""Evidence dossiers and briefs as Markdown lines, built by column expressions and joined in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.text import markdown_cell, preview

OVERVIEW = "## Ranked Paper Overview"


def overview_lines(ranking: DataFrame, titles: DataFrame) -> DataFrame:
    """``rank, line``: a table row for each ranked paper with its title (the id where there is none) and score to four decimals."""
    named = ranking.join(titles, "paper_id", "left").withColumn("shown", F.coalesce(F.nullif(F.trim("title"), F.lit("")), "paper_id"))
    line = F.concat(F.lit("| "), F.col("rank").cast("string"), F.lit(" | "), markdown_cell(F.col("shown")), F.lit(" | "), F.format_string("%.4f", "score"), F.lit(" |"))
    return named.select("rank", line.alias("line"))


def evidence_lines(evidence: DataFrame, per_paper: int = 3, characters: int = 300) -> DataFrame:
    """``paper_id, lines``: quotes of a paper's first chunks by rank, each with its pages and section."""
    from pyspark.sql.window import Window

    first = evidence.withColumn("p", F.row_number().over(Window.partitionBy("paper_id").orderBy("rank", "chunk_id"))).where(F.col("p") <= per_paper)
    quote = F.concat(F.lit("- p. "), F.col("page_start").cast("string"), F.lit("-"), F.col("page_end").cast("string"), F.lit(" ("), F.array_join("section_path", " > "), F.lit("): "), preview(F.col("text"), characters, "..."))
    return first.groupBy("paper_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p", quote.alias("q")))), lambda x: x["q"]), "\n").alias("lines"))


def dossier(ranking: DataFrame, titles: DataFrame, evidence: DataFrame, topic: str, query: str) -> DataFrame:
    """One row ``text``: the whole dossier of a ranking (already cut to its top papers)."""
    rows = overview_lines(ranking, titles).join(ranking.select("rank", "paper_id"), "rank").join(titles, "paper_id", "left").join(evidence_lines(evidence), "paper_id", "left")
    section = F.concat(F.lit("### "), F.col("rank").cast("string"), F.lit(". "), markdown_cell(F.coalesce("title", "paper_id")), F.lit("\n\n"), F.coalesce("lines", F.lit("No evidence.")))
    made = rows.agg(F.array_sort(F.collect_list(F.struct("rank", "line", section.alias("section")))).alias("all"))
    head = f"# Topic Evidence Dossier\n\n- Workflow topic: `{topic}`\n- Retrieval query: `{query}`\n\n{OVERVIEW}\n\n| rank | paper | score |\n|---:|---|---:|\n"
    table = F.array_join(F.transform("all", lambda x: x["line"]), "\n")
    return made.select(F.concat(F.lit(head), table, F.lit("\n\n"), F.array_join(F.transform("all", lambda x: x["section"]), "\n\n"), F.lit("\n")).alias("text"))


def overview_of(text: Column) -> Column:
    """The overview section of a dossier, without its heading; empty where there is none."""
    return F.btrim(F.regexp_extract(text, rf"(?s){OVERVIEW}\n(.*?)(?=\n#|\z)", 1), F.lit(" \n"))


def paper_sections(text: Column, n: int) -> Column:
    """The first ``n`` paper sections of a dossier."""
    return F.array_join(F.transform(F.slice(F.split(text, r"(?m)^### "), 2, n), lambda s: F.concat(F.lit("### "), F.rtrim(s))), "\n\n")
