"""Lookups in small tables, with a checked size, and names that clash with no column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows a table may have to become a literal map in the plan; a larger one is joined.
LITERAL_ROWS = 512


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """The given names, lengthened until none equals a column of ``df``, regardless of case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def literal_lookup(df: DataFrame, key: Column, value: Column, rows: int = LITERAL_ROWS) -> Callable[[Column], Column] | None:
    """A function from a key column to its value (null where unknown), or None when ``df`` has more than ``rows`` distinct keys.

    Null keys are left out; of several values of one key the largest counts. At most ``rows + 1`` rows come to the driver.
    """
    small = df.select(key.alias("k"), value.alias("v")).where("k is not null").groupBy("k").agg(F.max("v").alias("v"))
    found = small.limit(rows + 1).collect()
    if len(found) > rows:
        return None
    if not found:
        kind = dict(small.dtypes)["v"]
        return lambda column: F.when(column.isNull() & column.isNotNull(), F.lit(None)).cast(kind)
    entries = F.create_map(*[F.lit(x) for row in sorted(found) for x in row])
    return lambda column: F.try_element_at(entries, column)
