"""Vector arithmetic over arrays of numbers, in double precision."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left.cast("array<double>"), right.cast("array<double>"), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector.cast("array<double>"), F.lit(0.0), lambda s, x: s + x * x))


def cosine(left: Column, right: Column) -> Column:
    """0 where a vector has no length; null where the sizes differ."""
    size = norm(left) * norm(right)
    return F.when(F.size(left) == F.size(right), F.when(size == 0, F.lit(0.0)).otherwise(dot(left, right) / size))


def cosine_with(vector: Column, query: Sequence[float]) -> Column:
    """The cosine with a constant vector: one pass over the vector, the constant's norm folded in."""
    constant = F.array(*[F.lit(float(x)) for x in query])
    length = float(sum(x * x for x in query)) ** 0.5
    size = norm(vector) * length
    return F.when(F.size(vector) == len(query), F.when(size == 0, F.lit(0.0)).otherwise(dot(vector, constant) / size))


def normalized(vector: Column) -> Column:
    length = norm(vector)
    return F.when(length == 0, vector.cast("array<double>")).otherwise(F.transform(vector.cast("array<double>"), lambda x: x / length))


def is_usable(vector: Column) -> Column:
    """Not null, not empty, all numbers finite."""
    return F.coalesce((F.size(vector) > 0) & F.forall(vector.cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def _embedded(texts: pd.Series, dimension: int) -> pd.Series:
    import hashlib
    import math
    import re

    known: dict[str, tuple[int, float]] = {}

    def place(token: str) -> tuple[int, float]:
        if token not in known:
            digest = hashlib.sha256(token.encode()).digest()
            known[token] = int.from_bytes(digest[:8], "big") % dimension, 1.0 if digest[8] % 2 == 0 else -1.0
        return known[token]

    def of(text):
        text = (text or "").strip()
        if not text:
            return None
        tokens = [t.lower() for t in re.findall(r"[A-Za-z0-9_]+", text)]
        values = [0.0] * dimension
        if tokens:
            for token in tokens:
                bucket, sign = place(token)
                values[bucket] += sign
        else:
            raw = b"".join(hashlib.sha256(f"{i}\n{text}".encode()).digest() for i in range(-(-dimension // 32)))
            values = [b / 127.5 - 1.0 for b in raw[:dimension]]
        length = math.sqrt(sum(v * v for v in values))
        return values if length == 0 else [v / length for v in values]

    return texts.map(of)


def token_hash_vector(text: str, dimension: int = 128) -> list[float] | None:
    """``token_hash_embedding`` of one text."""
    return _embedded(pd.Series([text]), dimension)[0]


def token_hash_embedding(text: Column, dimension: int = 128) -> Column:
    """Signed token hashing into ``dimension`` buckets, of unit length; a text without tokens is hashed whole; null for a blank text."""
    if dimension < 1:
        raise ValueError("the dimension must be positive")
    return F.pandas_udf(lambda texts: _embedded(texts, dimension), "array<double>")(text)
