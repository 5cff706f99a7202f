"""Document-store style access: predicates, nested fields, group counts, completeness, lookups, ordered sets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.lookup import literal_lookup
from folioflow.functions.text import is_empty
from folioflow.operators.search import numbered


def field(df: DataFrame, path: str) -> tuple[Column, str]:
    """A field by dotted path with its type; a last part after a map is a key of it, null where missing."""
    head, _, rest = path.partition(".")
    column, kind = F.col(f"`{head}`"), dict(df.dtypes)[head]
    if not rest:
        return column, kind
    if kind.startswith("map"):
        return F.try_element_at(column, F.lit(rest)), kind[4:-1].split(",", 1)[1]
    nested = df.select(F.col(path).alias("x"))
    return F.col(path), nested.dtypes[0][1]


def combined(conditions: Sequence[Column | None], how=and_) -> Column:
    """All (or, with ``or_``, any) of the given conditions; missing ones are left out, none at all is true."""
    given = [c for c in conditions if c is not None]
    return reduce(how, given) if given else F.lit(True)


def non_empty(df: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Rows in which every listed field is there and not empty; 0 and false aren't empty."""
    return df.where(combined([~is_empty(*field(df, p)) for p in paths]))


def equals(df: DataFrame, path: str, value) -> DataFrame:
    """Rows whose field equals the value; an array field matches by any element."""
    column, kind = field(df, path)
    return df.where(F.array_contains(column, value) if kind.startswith("array") else column == value)


def by_key(df: DataFrame, key: str, value) -> DataFrame:
    """The row with this key, or none; of repeated rows one."""
    return df.where(F.col(f"`{key}`") == value).limit(1)


def by_keys(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows whose key is in the first column of ``keys``."""
    return df.join(keys.select(F.col(keys.columns[0]).alias(key)).distinct(), key, "left_semi")


def missing_keys(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The keys that no row has."""
    return keys.select(F.col(keys.columns[0]).alias(key)).distinct().join(df, key, "left_anti")


def group_counts(df: DataFrame, path: str, where: Column | None = None) -> DataFrame:
    """``group_value, n`` in order of the value; null counts as <missing>, the empty string as <empty>."""
    column, _ = field(df, path)
    value = F.when(column.isNull(), "<missing>").when(column.cast("string") == "", "<empty>").otherwise(column.cast("string"))
    return df.where(combined([where])).groupBy(value.alias("group_value")).agg(F.count(F.lit(1)).alias("n"))


def completeness(df: DataFrame, paths: Sequence[str], key: str, examples: int = 3) -> DataFrame:
    """``field, total, missing, examples``: how many rows lack each field, and the smallest keys among them, in one scan."""
    empties = [is_empty(*field(df, p)) for p in paths]
    counted = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(e).alias(f"m{i}") for i, e in enumerate(empties)])
    long = counted.select("total", F.explode(F.array(*[F.struct(F.lit(p).alias("field"), F.col(f"m{i}").alias("missing")) for i, p in enumerate(paths)])).alias("x")).select("x.field", "total", "x.missing")
    lacking = df.select(F.col(key).alias("k"), F.explode(F.array_compact(F.array(*[F.when(e, F.lit(p)) for e, p in zip(empties, paths)]))).alias("field"))
    from pyspark.sql.window import Window

    first = lacking.withColumn("p", F.row_number().over(Window.partitionBy("field").orderBy("k"))).where(F.col("p") <= examples)
    return long.join(first.groupBy("field").agg(F.array_sort(F.collect_list("k")).alias("examples")), "field", "left")


def ordered_distinct(column: Column) -> Column:
    """An array's elements once each, in order of first appearance, without nulls and blanks."""
    return F.array_distinct(F.filter(F.transform(column, lambda x: F.trim(x)), lambda x: x != ""))


def set_add(array: Column, value: Column) -> Column:
    """The array with the value at its end unless it has it."""
    return F.when(F.array_contains(F.coalesce(array, F.array().cast("array<string>")), value), array).otherwise(F.array_append(F.coalesce(array, F.array().cast("array<string>")), value))


def url_candidates(df: DataFrame, sources: dict[str, Sequence[str]]) -> Column:
    """An array of ``url, source, field``: the trimmed values under dotted paths, in the order given, each address once where it came first.

    ``sources`` names for each source its paths, which may lead into maps and nested fields; nulls and blanks are left out.
    """
    found = [F.struct(F.trim(field(df, p)[0]).alias("url"), F.lit(s).alias("source"), F.lit(p).alias("field")) for s, paths in sources.items() for p in paths]
    some = F.filter(F.array(*found), lambda c: c["url"].isNotNull() & (c["url"] != ""))
    urls = F.transform(some, lambda c: c["url"])
    return F.filter(some, lambda c, i: F.array_position(urls, c["url"]) == i + 1)


def backfilled(candidates: DataFrame, states: DataFrame, key: str, rank: str, usable: Column, limit: int) -> DataFrame:
    """The first ``limit`` candidates whose joined state is usable, with ``place`` from 1 by ``rank``, so that those behind fill up; a candidate without a state has nulls."""
    return numbered(candidates.join(states, key, "left").where(usable).orderBy(rank).limit(limit), [F.asc(rank)], name="place")


def configured(df: DataFrame, config: DataFrame, key: str, value: str, default: str) -> DataFrame:
    """``df`` with ``value``: the configured one of each row's key, or the default. A small table becomes a literal map, a larger one is joined."""
    lookup = literal_lookup(config, F.col(key), F.col(value))
    if lookup is not None:
        return df.withColumn(value, F.coalesce(lookup(F.col(key)), F.lit(default)))
    known = config.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(value).alias(value))
    return df.join(known, key, "left").withColumn(value, F.coalesce(value, F.lit(default)))

