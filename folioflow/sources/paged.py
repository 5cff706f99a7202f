"""A Python data source over anything that is fetched in pages per partition, and a batch caller for model services.

Both take the fetching or scoring function as an argument, so they need no network of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def paged_source(name: str, schema: str, parts: Sequence[str], fetch: Callable[[str, dict], Iterator[tuple]]) -> type[DataSource]:
    """A data source class to register: one partition for each of ``parts`` (a category, a volume), rows from ``fetch(part, options)``."""
    wanted = list(parts)

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.options = dict(options)

        def partitions(self):
            return [InputPartition(p) for p in wanted]

        def read(self, partition):
            yield from fetch(partition.value, self.options)

    class Source(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return schema

        def reader(self, schema):
            return Reader(self.options)

    return Source


def scored(df: DataFrame, text: str, score: Callable[[list[str]], list[float]], batch: int = 16, name: str = "score") -> DataFrame:
    """``df`` with a score for each text, asked for in batches; a null text gets null, and an answer of another length is an error."""
    return _asked(df, text, score, batch, name, None)


def embedded(df: DataFrame, text: str, embed: Callable[[list[str]], list[Sequence[float]]], dimension: int, batch: int = 16, name: str = "vector") -> DataFrame:
    """``df`` with a vector of ``dimension`` numbers for each text, asked for in batches; null for a null text, and an error for another answer."""
    return _asked(df, text, embed, batch, name, dimension)


def _asked(df: DataFrame, text: str, ask: Callable, batch: int, name: str, dimension: int | None) -> DataFrame:
    from pyspark.sql import types as T

    schema = T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType() if dimension is None else T.ArrayType(T.DoubleType()))])

    def made(answer):
        if dimension is None:
            return float(answer)
        if len(answer) != dimension:
            raise ValueError(f"a vector of {len(answer)} numbers, not {dimension}")
        return [float(x) for x in answer]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = pd.Series([None] * len(frame), index=frame.index, dtype="object")
            known = frame.index[frame[text].notna()]
            for at in range(0, len(known), batch):
                rows = known[at : at + batch]
                answers = ask(frame.loc[rows, text].tolist())
                if len(answers) != len(rows):
                    raise ValueError(f"{len(rows)} texts, but {len(answers)} {'scores' if dimension is None else 'vectors'}")
                out.loc[rows] = pd.Series([made(x) for x in answers], index=rows, dtype="object")
            yield frame.assign(**{name: out.astype("float64") if dimension is None else out})

    return df.mapInPandas(run, schema)
