"""Best representative of each duplicate group, field by field (problem 1).

Each group of records becomes one surviving record. For every field one aggregate takes the maximum of a composite struct (rank of the
record for this field, tie-breaks, value), so all fields of a group come out of a single shuffle with map-side combination; no group is ever
collected, and a group that holds a third of all rows reaches its reducer as one partial row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.ids import canonical_paper_id
from folioflow.functions.lookup import fresh_names, literal_lookup


@dataclass(frozen=True)
class SurvivingField:
    """``value`` survives from the usable record with the largest ``ranks``, compared in order. ``value`` and ``ranks`` must be orderable (no maps)."""

    name: str
    value: Column
    usable: Column
    ranks: tuple[Column, ...] = ()


def surviving_records(
    df: DataFrame, key: Column, record: Column, fields: Sequence[SurvivingField], tie_breaks: Sequence[Column] = (), key_name: str = "group_key"
) -> DataFrame:
    """One row per group: ``key_name``, ``first_record``, ``last_record`` and, for each field, a struct (record, value).

    - ``record`` is a number that names the record. Equal ranks go to the larger ``tie_breaks``, in order, then to the smaller record.
    - Nulls: a row whose key is null belongs to no group and is left out; a null rank or tie-break is the smallest; a usable record may have
      a null value; a null record loses every tie and doesn't count in first and last. A field without a usable record is null.
    - Repeated rows change nothing. An empty table gives no rows. Other columns are ignored, whatever their names.
    """
    ranked = df.select(
        key.alias("k"),
        record.alias("r"),
        *[
            F.when(
                f.usable,
                F.struct(
                    *[x.alias(f"rank{i}") for i, x in enumerate(f.ranks)],
                    *[x.alias(f"tie{i}") for i, x in enumerate(tie_breaks)],
                    (-record).alias("latest"),
                    f.value.alias("value"),
                ),
            ).alias(f"f{i}")
            for i, f in enumerate(fields)
        ],
    ).where("k is not null")
    best = ranked.groupBy("k").agg(F.min("r").alias("low"), F.max("r").alias("high"), *[F.max(f"f{i}").alias(f"f{i}") for i in range(len(fields))])
    return best.select(
        F.col("k").alias(key_name),
        F.col("low").alias("first_record"),
        F.col("high").alias("last_record"),
        *[
            F.when(F.col(f"f{i}").isNotNull(), F.struct((-F.col(f"f{i}.latest")).alias("record"), F.col(f"f{i}.value").alias("value"))).alias(f.name)
            for i, f in enumerate(fields)
        ],
    )


def cleaned(text: Column) -> Column:
    """White space collapsed and trimmed, lower case."""
    return F.lower(F.trim(F.regexp_replace(text, r"[\s\u00a0]+", " ")))


# Words that stand for no value, and words of papers that aren't accepted.
PLACEHOLDER = r"^([^\p{L}\p{N}]*|unknown|none|null|nil|nan|tbd|tba|n ?/? ?a|n\. ?a\.?|not available|undefined|missing|todo|test)$"
NOT_ACCEPTED = r"\b(submit\w*|submission\w*|pending|review|reviewed|withdraw\w*|withdrew|reject\w*|declined|retracted|unpublished)\b"
PREPRINT = r"arxiv|preprint|\bcorr\b"


def acceptance_rank(accepted_by: Column) -> Column:
    """2 for an acceptance by a venue, 1 for a preprint, null where the value isn't usable."""
    text = cleaned(accepted_by)
    return F.when(
        text.isNotNull() & ~text.rlike(PLACEHOLDER) & ~text.rlike(NOT_ACCEPTED) & text.rlike(r"\p{L}{2}"), F.when(text.rlike(PREPRINT), 1).otherwise(2)
    )


def complete_addresses(base_urls: Column) -> Column:
    """The different complete http(s) addresses among a map's values, sorted; empty for a null map."""
    values = F.transform(F.map_values(base_urls), lambda x: F.regexp_replace(x, r"^[\s\u00a0]+|[\s\u00a0]+$", ""))
    whole = F.filter(values, lambda x: x.rlike(r"^(?i:https?)://[^\s/?#]+\.[^\s/?#.]+([/?#:]\S*)?$"))
    return F.coalesce(F.array_sort(F.array_distinct(whole)), F.array().cast("array<string>"))


def known_sources(papers: DataFrame, registry: DataFrame, record: str) -> DataFrame:
    """``papers`` with ``source_trust`` (null where source_name is unknown) and ``sources``, the different registered names of seen_in_sources.

    The registry becomes a literal map while it is small; beyond that both are looked up by joins on the cleaned name.
    """
    names = registry.select(cleaned(F.col("source_name")).alias("name"), F.col("trust").alias("trust"))
    trust, listed, member = fresh_names(papers, "source_trust", "sources", "member")
    own = F.coalesce(F.array_distinct(F.transform("seen_in_sources", cleaned)), F.array().cast("array<string>"))
    if (lookup := literal_lookup(names, F.col("name"), F.col("trust"))) is not None:
        return papers.select("*", lookup(cleaned(F.col("source_name"))).alias(trust), F.array_sort(F.filter(own, lambda x: lookup(x).isNotNull())).alias(listed))
    single = names.where("name is not null").groupBy("name").agg(F.max("trust").alias("trust"))
    seen = (
        papers.select(F.col(record).alias("r"), F.explode(own).alias(member))
        .join(single.select(F.col("name").alias(member)), member)
        .groupBy("r")
        .agg(F.array_sort(F.collect_set(member)).alias("found"))
    )
    joined = papers.join(single, cleaned(papers["source_name"]) == single["name"], "left").join(seen, papers[record] == seen["r"], "left")
    return joined.select(*[papers[c] for c in papers.columns], single["trust"].alias(trust), F.coalesce(seen["found"], F.array().cast("array<string>")).alias(listed))


def surviving_papers(papers: DataFrame, registry: DataFrame) -> DataFrame:
    """The surviving record of each paper: ``paper_id`` and, as structs (record, value), accepted_by, base_urls and seen_in_sources.

    Records belong together by paper_id regardless of case and, where it is missing or blank, by the id of their title; a record with
    neither belongs to no paper. accepted_by: a venue before a preprint, anything else isn't usable. base_urls: most different complete
    addresses. seen_in_sources: most different registered sources. Ties: trust of source_name, latest crawled_at, smallest record_no.
    """
    wanted = papers.select("record_no", "paper_id", "title", "accepted_by", "seen_in_sources", "base_urls", "source_name", "crawled_at")
    rows = known_sources(wanted, registry, "record_no").withColumn("addresses", complete_addresses(F.col("base_urls"))).withColumn("acceptance", acceptance_rank(F.col("accepted_by")))
    return surviving_records(
        rows,
        canonical_paper_id(F.col("paper_id"), F.col("title")),
        F.col("record_no"),
        [
            SurvivingField("accepted_by", F.trim("accepted_by"), F.col("acceptance").isNotNull(), (F.col("acceptance"),)),
            SurvivingField("base_urls", F.col("addresses"), F.size("addresses") > 0, (F.size("addresses"),)),
            SurvivingField("seen_in_sources", F.col("sources"), F.size("sources") > 0, (F.size("sources"),)),
        ],
        (F.col("source_trust"), F.col("crawled_at")),
        key_name="paper_id",
    )
