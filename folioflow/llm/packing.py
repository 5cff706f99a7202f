"""Filling fixed-capacity containers with texts (problem 8).

Method: vector bin packing with the dot-product heuristic. A segment is a vector (tokens, 1 segment, loss-bearing tokens), each relative to
its limit. An open container takes, again and again, the fitting segment with the largest weighted dot product with what is left in it; the
weights are the dimensions' total demands. Segments with equal vectors are interchangeable, so a step looks at distinct vectors only.

The sizes are dealt out to tasks by key, in a number that follows from the rows alone, and sorted there, so every cluster gives the same
containers. A task packs in blocks and hands the unfinished containers of a block on to the next. Only keys and sizes move and are held, never
texts. A task leaves at most one unfinished container more than its last block needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.encoding import VOCABULARY, token_counts

#: Segments that are packed together; a bound on memory and time for a step, not on what is packed.
BLOCK = 65_536


#: Rows a task packs, on average; the more, the less room is left.
ROWS_A_TASK = 32_768


def segments_of(tokens: int, loss: int | None, capacity: int) -> list[tuple[int, int, int]]:
    """(start, end, loss-bearing tokens) of a text's segments: one, unless the text alone exceeds a container."""
    bearing = None if loss is None else tokens - min(max(loss, 0), tokens)
    cuts = [(s, min(s + capacity, tokens)) for s in range(0, max(tokens, 1), capacity)]
    return [(s, e, max(0, e - (s + 1 if bearing is None else max(s, bearing)))) for s, e in cuts]


def pack(sizes: np.ndarray, limits: np.ndarray) -> list[list[int]]:
    """Containers as lists of row numbers of ``sizes`` (n x dimensions); every row fits into an empty container."""
    if not len(sizes):
        return []
    kinds, kind = np.unique(sizes, axis=0, return_inverse=True)
    order = np.argsort(kind.ravel(), kind="stable")
    bounds = np.concatenate([[0], np.cumsum(np.bincount(kind.ravel(), minlength=len(kinds)))])
    stacks = [order[a:b].tolist()[::-1] for a, b in zip(bounds, bounds[1:])]
    scale = np.maximum(limits, 1).astype(float)
    demand = (sizes / scale).sum(0)
    weighted = kinds / scale * (demand / max(demand.sum(), 1e-9))
    kinds = kinds.copy()
    containers = []
    while len(kinds):
        left, content = limits.copy(), []
        while True:
            fits = np.flatnonzero((kinds <= left).all(1))
            if not len(fits):
                break
            best = fits[np.argmax(weighted[fits] @ (left / scale))]
            content.append(stacks[best].pop())
            left = left - kinds[best]
            if not stacks[best]:
                del stacks[best]
                kinds, weighted = np.delete(kinds, best, 0), np.delete(weighted, best, 0)
        containers.append(content)
    return containers


def fill_containers(
    df: DataFrame, key: str, text: str, capacity: int = 2048, max_segments: int = 64, prompt: Column | None = None, max_loss: int | None = None, path: str = VOCABULARY, block: int = BLOCK
) -> DataFrame:
    """``key``, ``piece``, ``token_start``, ``token_end``, ``loss``, ``container``, ``slot``: where each text, or each piece of an oversized one, goes.

    A container holds at most ``capacity`` tokens, ``max_segments`` segments and ``max_loss`` loss-bearing tokens (default: ``capacity``).
    ``prompt`` is the beginning of a text that bears no loss; where it is null, every token of a segment but the first bears loss.

    - A text is never split unless it alone has more than ``capacity`` tokens; such a one is cut into consecutive pieces (from 0), all but the last
      as long as can be. A segment that alone bears more loss than ``max_loss`` stays whole, and nothing else that bears loss is put beside it.
    - Null and empty texts have no tokens and one segment with start and end 0. Null keys and repeated keys or rows are packed as they come,
      each row for itself. The empty table gives no rows; other columns are ignored.
    - Container numbers are unique; those of one task follow one another. The same rows give the same containers, however they are partitioned.
    """
    if capacity < 1 or max_segments < 1 or (max_loss is not None and max_loss < 1):
        raise ValueError("limits must be at least 1")
    most_loss = capacity if max_loss is None else max_loss
    count = token_counts(df.sparkSession, path)
    tasks = max(1, -(-df.count() // ROWS_A_TASK))
    asked = F.lit(None).cast("int") if prompt is None else F.when(prompt.isNotNull(), count(prompt))
    rows = df.select(F.col(f"`{key}`").alias("key"), count(F.col(f"`{text}`")).alias("tokens"), asked.alias("asked"))
    rows = rows.select("key", "tokens", F.greatest(F.col("tokens") - F.col("asked"), F.when(F.col("asked").isNotNull(), 0)).alias("loss"))
    rows = rows.repartition(tasks, "key", "tokens").sortWithinPartitions("key", "tokens", "loss")
    kind = rows.schema["key"].dataType.simpleString()
    limits = np.array([capacity, max_segments, most_loss])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        keys, cuts, waiting = [], [], 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal keys, cuts, number
            every = pa.concat_arrays(keys) if keys else None
            table = np.array(cuts, np.int64).reshape(-1, 5)
            done = pack(np.column_stack([table[:, 3] - table[:, 2], np.ones(len(table), np.int64), np.minimum(table[:, 4], most_loss)]), limits)
            kept = [] if last or not done else done.pop()
            if done:
                take = np.concatenate(done).astype(np.int64)
                holds = np.array([len(c) for c in done])
                place = np.repeat(np.arange(len(done)), holds)
                slot = np.arange(len(take)) - np.repeat(np.cumsum(holds) - holds, holds)
                columns = [every.take(pa.array(table[take, 0])), *[pa.array(table[take, i].astype(np.int32)) for i in (1, 2, 3, 4)], pa.array(number + place), pa.array(slot.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "piece", "token_start", "token_end", "loss", "container", "slot"])
                number += len(done)
            kept.sort()
            keys = [every.take(pa.array(table[kept, 0]))] if kept else []
            cuts = [(i, *table[k, 1:]) for i, k in enumerate(kept)]

        for batch in batches:
            base = sum(map(len, keys))
            keys.append(batch.column(0))
            for i, (tokens, bearing) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                cuts += [(base + i, j, *x) for j, x in enumerate(segments_of(tokens, bearing, capacity))]
            if len(cuts) - waiting >= block:
                yield from flush(False)
                waiting = len(cuts)
        if cuts:
            yield from flush(True)

    out = rows.mapInArrow(packed, f"key {kind}, piece int, token_start int, token_end int, loss int, container bigint, slot int")
    return out.withColumnRenamed("key", key)
