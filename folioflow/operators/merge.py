"""Fill-only merge of records that arrive one after the other, as order-aware aggregates without a per-key fold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.text import is_empty


def first_values(df: DataFrame, key: str, order: Sequence[Column], fields: Sequence[str]) -> DataFrame:
    """``key`` and for each field its first non-empty value in ``order``, as ``merged_<field>``; what a field has once is never overwritten."""
    kinds, place = dict(df.dtypes), F.struct(*order)
    return df.groupBy(key).agg(*[F.min_by(F.when(~is_empty(F.col(f), kinds[f]), F.col(f)), F.when(~is_empty(F.col(f), kinds[f]), place)).alias(f"merged_{f}") for f in fields])


def is_preprint(venue: Column) -> Column:
    return F.lower(F.trim(venue)).startswith("arxiv")


def merged_venue(df: DataFrame, key: str, order: Sequence[Column], venue: str, source: str) -> DataFrame:
    """``key, merged_<venue>``: the first non-empty venue; a preprint gives way to the first formal venue that a source not yet seen brings.

    A formal venue stays. A later record of a source that was seen before never changes a venue.
    """
    rows = df.select(F.col(key).alias("k"), F.struct(*order).alias("o"), F.col(source).alias("s"), F.col(venue).alias("v"))
    filled = F.col("v").isNotNull() & (F.col("v") != "")
    start = rows.where(filled).groupBy("k").agg(F.min(F.struct("o", "v")).alias("first"))
    arrivals = rows.groupBy("k", "s").agg(F.min(F.struct("o", "v")).alias("a"))
    formal = arrivals.where(F.col("a.v").isNotNull() & (F.trim("a.v") != "") & ~is_preprint(F.col("a.v")))
    later = formal.join(start, "k").where(F.col("a.o") > F.col("first.o")).groupBy("k").agg(F.min("a").alias("better"))
    both = start.join(later, "k", "left")
    value = F.when(is_preprint(F.col("first.v")) & F.col("better").isNotNull(), F.col("better.v")).otherwise(F.col("first.v"))
    return both.select(F.col("k").alias(key), value.alias(f"merged_{venue}"))


def merged_records(df: DataFrame, key: str, order: Sequence[Column], fields: Sequence[str], venue: str, source: str, category: str | None = None) -> DataFrame:
    """One row per key: merged fields, the upgraded venue, ``sources`` and ``categories`` seen, and ``arrivals`` (an edit a record).

    ``category`` names an array column. Sets are in order of the values. A key that is null makes no record.
    """
    rows = df.where(F.col(key).isNotNull())
    out = first_values(rows, key, order, fields).join(merged_venue(rows, key, order, venue, source), key, "left")
    sets = [F.array_sort(F.collect_set(source)).alias("sources"), F.count(F.lit(1)).alias("arrivals")]
    if category:
        sets.append(F.array_sort(F.array_distinct(F.flatten(F.collect_set(category)))).alias("categories"))
    return out.join(rows.groupBy(key).agg(*sets), key)


def migrated(df: DataFrame, renames: dict[str, str], defaults: dict[str, Column], version: int, version_column: str = "schema_version") -> DataFrame:
    """Columns renamed, missing columns and nulls filled with typed defaults, the version raised to at least ``version``."""
    for old, new in renames.items():
        if old in df.columns:
            df = df.withColumn(new, F.coalesce(new, old)).drop(old) if new in df.columns else df.withColumnRenamed(old, new)
    for name, default in defaults.items():
        df = df.withColumn(name, F.coalesce(F.col(name), default) if name in df.columns else default)
    return df.withColumn(version_column, F.greatest(F.coalesce(version_column, F.lit(0)), F.lit(version)))
