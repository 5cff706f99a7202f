"""Topic recall over metadata fields by substrings: all terms first, any term as fallback, scored and cut."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, and_, or_

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioflow.functions.ids import normalized_title
from folioflow.functions.text import TOPIC_STOPWORDS, query_terms, value_text


@dataclass(frozen=True)
class TopicField:
    """A searched field: the weight of a term in it and of the whole topic phrase (0: doesn't count)."""

    name: str
    term_weight: float
    phrase_weight: float = 0.0
    is_array: bool = False


def topic_recall(papers: DataFrame, topic: str, fields: Sequence[TopicField], limit: int, key: str = "paper_id", title: str = "title", pool: int = 1000) -> DataFrame:
    """``rank, <key>, title, score, matched_fields``: papers for a topic.

    Papers with all terms come first; only if they are fewer than ``limit`` are those with any term added, up to ``pool`` rows in all (rows
    that already are in count against it). Terms are found as substrings: in the raw fields for recall, in normalised ones for the score. Pools are
    cut in order of the key. Papers without a title or with a score of 0 are left out. Order: score descending, title in lower case, key.
    """
    terms = query_terms(topic, TOPIC_STOPWORDS)
    phrase = " ".join(query_terms(topic, ()))
    raw = {f.name: F.lower(value_text(F.col(f.name), f.is_array)) for f in fields}

    def has(term: str) -> Column:
        return reduce(or_, [c.contains(term) for c in raw.values()])

    strict = papers.where(reduce(and_, [has(t) for t in terms])).orderBy(key).limit(pool)
    enough = strict.agg(F.count(F.lit(1))).scalar()
    loose = papers.where(reduce(or_, [has(t) for t in terms])).orderBy(key).limit(pool)
    loose = loose.withColumn("_p", F.row_number().over(Window.orderBy(key))).where((enough < limit) & (F.col("_p") <= pool - enough)).drop("_p")
    rows = strict.unionByName(loose.join(strict.select(key), key, "left_anti"))
    for i, f in enumerate(fields):
        rows = rows.withColumn(f"_n{i}", normalized_title(value_text(F.col(f.name), f.is_array)))
    parts, matched, found = [], [], []
    for i, f in enumerate(fields):
        here = [F.col(f"_n{i}").contains(t) for t in terms]
        parts += [F.when(h, f.term_weight).otherwise(0.0) for h in here]
        hit = reduce(or_, here)
        if f.phrase_weight and phrase:
            parts.append(F.when(F.col(f"_n{i}").contains(phrase), f.phrase_weight).otherwise(0.0))
            hit = hit | F.col(f"_n{i}").contains(phrase)
        matched.append(F.when(hit, f.name))
        found.append(here)
    covered = reduce(add, [F.when(reduce(or_, [h[j] for h in found]), 1.0).otherwise(0.0) for j in range(len(terms))])
    scored = rows.select(key, F.trim(title).alias("title"), (reduce(add, parts) + covered / len(terms) * 5.0).alias("score"), F.array_sort(F.array_compact(F.array(*matched))).alias("matched_fields"))
    ways = [F.desc("score"), F.asc(F.lower("title")), F.asc(key)]
    top = scored.where((F.coalesce("title", F.lit("")) != "") & (F.col("score") > 0)).orderBy(*ways).limit(limit)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*ways))).select("rank", key, "title", "score", "matched_fields")


def fuzzy_titles(papers: DataFrame, query: str, limit: int = 10, least: float = 0.65, key: str = "paper_id", title: str = "title") -> DataFrame:
    """``<key>, title, score`` of the papers whose title resembles the query: 1 where it contains it, else the matching-blocks ratio.

    Titles that contain the query as it stands are looked at first, 5 times ``limit`` of them; only without any is every title compared. Order: score
    descending, key.
    """
    wanted = " ".join(re.sub(r"[^a-z0-9\s]", " ", query.lower()).split())
    if not wanted:
        raise ValueError("the query is empty")

    def ratios(titles: pd.Series) -> pd.Series:
        from difflib import SequenceMatcher

        return titles.map(lambda t: 1.0 if wanted in t else SequenceMatcher(None, wanted, t).ratio())

    rows = papers.select(key, title, normalized_title(F.col(title)).alias("_n"))
    exact = rows.where(F.lower(title).contains(query.lower())).orderBy(key).limit(limit * 5)
    none = exact.agg(F.count(F.lit(1))).scalar() == 0
    pool = exact.unionByName(rows.where(none)).where(F.col("_n") != "")
    scored = pool.select(key, F.col(title).alias("title"), F.pandas_udf(ratios, "double")("_n").alias("score"))
    return scored.where(F.col("score") >= least).orderBy(F.desc("score"), F.asc(key)).limit(limit)
