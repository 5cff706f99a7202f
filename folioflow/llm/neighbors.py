"""Most similar vectors for every vector, with a permutation index (problem 2).

Every vector is represented by its nearest pivots in order (its permutation). It is posted in the inverted files of its first pivots; in an
inverted file the others are ranked by the footrule distance of the permutations, and the cosine is taken of the best of them only. The pivots
are a bounded sample of the different directions, so that copies of one vector don't take the places of others; every usable vector is posted.

At scale: vectors equal in every number are one distinct vector, which carries its smallest ids, so a group of copies is never paired with
itself. Postings carry the vector in a lossless compact form, so reranking needs no join back. Neighbouring pivots form a cell, which is
searched by one task, so a vector travels once for each cell of its first pivots and not once for each of them. As pivots are drawn from the vectors
they are dense where these are dense. A cell that is large all the same is searched by several tasks, each with its own part of the
queries, which its members pass by in chunks: memory stays bounded, nothing is left out, and what is found doesn't depend on the size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioflow.session import cut_lineage


@dataclass(frozen=True)
class PermutationIndex:
    """Parameters; ``vectors_per_pivot`` with the bounds gives the number of pivots per dimension, all of them sampled vectors.

    ``reranked`` is how many of a file's vectors are compared by cosine, for each query and each ``chunk`` of the file.
    """

    prefix: int = 8
    postings: int = 5
    vectors_per_pivot: int = 128
    least_pivots: int = 64
    reranked: int = 192
    chunk: int = 16_384

    def pivots(self, sizes: dict[int, int]) -> dict[int, int]:
        """The number of pivots of each dimension; ``PIVOT_BYTES`` are shared out in proportion to the vectors."""
        every = max(sum(sizes.values()), 1)
        most = {d: min(MOST_PIVOTS, PIVOT_BYTES * n // every // (4 * d)) for d, n in sizes.items()}
        return {d: max(self.least_pivots, min(n // self.vectors_per_pivot, most[d])) for d, n in sizes.items()}

    def cells(self, pivots: int, vectors: int) -> int:
        """How many cells the pivots are put into, so that a cell has a few thousand members and at least one pivot."""
        members_per_pivot = max(1, vectors * self.postings // pivots)
        return max(1, pivots // max(1, min(32, self.chunk // (2 * members_per_pivot))))


#: Versions that may come to the driver, bytes of pivots of all dimensions that are broadcast, and the largest number a permutation can hold.
VERSIONS, PIVOT_BYTES, MOST_PIVOTS = 1_000, 32_000_000, 65_535
#: Tasks of the search at most; there are as many as chunks of postings. Large cells up to this number are sent to all tasks; more are joined by a shuffle.
MOST_TASKS, SENT_CELLS = 20_000, 500_000
#: Steps from cosine 0 to 1 in the order of pivots; coarser than the noise of single precision.
STEPS = 2**18


def usable_vectors(df: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """``embedding_no, version, vector`` of the usable rows (the version as a number), and by dimension about how many there are.

    Usable: embedding_dimension is the vector's size and its version's dimension, all numbers finite, not all zero. The version's
    dimension is the one that most of its rows have both declared and in fact (the smaller on a tie). Null ids are left out.
    """
    agreed = df.where(F.size("vector") == F.col("embedding_dimension")).groupBy("embedding_model_version", "embedding_dimension").count()
    top = agreed.groupBy("embedding_model_version").agg(F.max(F.struct("count", (-F.col("embedding_dimension")).alias("d"))).alias("m"))
    found = top.select("embedding_model_version", (-F.col("m.d")).cast("int"), "m.count").limit(VERSIONS + 1).collect()
    if len(found) > VERSIONS:
        raise ValueError(f"more than {VERSIONS} versions")
    pairs = sorted((v, d) for v, d, _ in found if v is not None and d > 0)
    sizes = {d: sum(n for _, e, n in found if e == d) for _, d in pairs}
    rule = F.lit(False)
    for dimension in sorted(sizes):
        rule = rule | ((F.col("embedding_dimension") == dimension) & F.col("embedding_model_version").isin(*[v for v, d in pairs if d == dimension]))
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)) & F.exists("vector", lambda x: x != 0)
    rows = df.where(rule & (F.size("vector") == F.col("embedding_dimension")) & finite & F.col("embedding_no").isNotNull())
    numbers = F.create_map(*[F.lit(x) for i, (v, _) in enumerate(pairs) for x in (v, i)]) if pairs else F.create_map(F.lit(""), F.lit(0))
    return rows.select("embedding_no", F.try_element_at(numbers, F.col("embedding_model_version")).alias("version"), F.col("vector").cast("array<double>").alias("vector")), sizes


def pack_vector(row: np.ndarray) -> bytes:
    """The numbers without loss: as two-byte integers over a power of ten where that gives back every number, else as doubles."""
    for digits in range(7):
        scaled = np.rint(row * 10.0**digits)
        if np.abs(scaled).max() > 32767:
            break
        if (scaled / 10.0**digits == row).all():
            return bytes([digits]) + scaled.astype("<i2").tobytes()
    return b"\xff" + row.astype("<f8").tobytes()


def unpack_vectors(packed: pa.Array) -> np.ndarray:
    """The vectors of one dimension, as doubles; all at once where they are packed alike."""
    offsets = packed.buffers()[1]
    starts = np.frombuffer(offsets, np.int32)[packed.offset : packed.offset + len(packed) + 1]
    data, width = np.frombuffer(packed.buffers()[2], np.uint8)[starts[0] : starts[-1]], int(starts[1] - starts[0])
    if len(data) == width * len(packed) and (np.diff(starts) == width).all():
        table = data.reshape(len(packed), width)
        if (table[:, 0] != 255).all():
            return np.ascontiguousarray(table[:, 1:]).view("<i2") / (10.0 ** table[:, 0].astype(float))[:, None]
        if (table[:, 0] == 255).all():
            return np.ascontiguousarray(table[:, 1:]).view("<f8")
    packed = packed.to_pylist()
    out = [np.frombuffer(b, "<f8", offset=1) if b[0] == 255 else np.frombuffer(b, "<i2", offset=1) / 10.0 ** b[0] for b in packed]
    return np.vstack(out)


def nearest_pivots(unit: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The numbers of the ``prefix`` nearest pivots in order; cosines that are equal in steps of ``1 / STEPS`` by the pivot's number."""
    out, numbers = np.empty((len(unit), prefix), np.uint16), np.arange(len(pivots))
    kind = np.int32 if STEPS * (len(pivots) + 1) < 2**31 else np.int64
    rows = max(1, 8_000_000 // max(len(pivots), 1))
    for at in range(0, len(unit), rows):
        # One number for the step of the cosine and the pivot: no two are equal, so a tie can't be cut anywhere.
        ranked = np.rint((unit[at : at + rows] @ pivots.T) * -STEPS).astype(kind) * kind(len(pivots)) + numbers.astype(kind)
        out[at : at + rows] = np.sort(np.partition(ranked, prefix - 1, axis=1)[:, :prefix], axis=1) % len(pivots)
    return out


def file_neighbors(pivot: int, queries: np.ndarray, members: np.ndarray, query_rows: np.ndarray, member_rows: np.ndarray, vectors: tuple[np.ndarray, np.ndarray], least: float, index: PermutationIndex) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Within the inverted file of ``pivot``: (query row, other row, cosine rounded to 9 decimals) of the others with at least ``least``.

    ``queries`` and ``members`` are the permutations of the rows ``query_rows`` and ``member_rows`` of ``vectors``, which are of unit length, in
    double and in single precision. The members are ranked by
    footrule distance: for prefixes of equal length it falls as the sum, over shared pivots, of the smaller of the two weights
    grows, where a pivot's weight is the prefix length minus its position. The cosine is taken of those that reach the distance of the ``reranked``-th;
    those whom the query also meets in the file of a nearer pivot are left to that file.
    """
    (size, prefix), reranked = members.shape, index.reranked
    (units, single), posted = vectors, prefix - index.postings
    nearer = (queries == pivot).argmax(1)
    order = np.argsort(-nearer, kind="stable")
    queries, query_rows, nearer = queries[order], query_rows[order], nearer[order]
    names, local = np.unique(members, return_inverse=True)
    local = local.reshape(members.shape)
    weight = np.zeros((len(names) + 1, size), np.uint8)
    for i in range(prefix):
        weight[local[:, i], np.arange(size)] = prefix - i
    capped = [np.minimum(weight, np.uint8(prefix - i)) for i in range(prefix)]
    place = np.searchsorted(names, queries)
    asked = np.where(names[np.minimum(place, len(names) - 1)] == queries, place, len(names))
    itself = np.minimum(np.searchsorted(member_rows, query_rows), size - 1)
    is_member = np.flatnonzero(member_rows[itself] == query_rows)
    near_by, step, out = single[member_rows], max(1, min(256, 1_000_000 // size)), []
    for at in range(0, len(queries), step):
        rows = asked[at : at + step]
        near = capped[0][rows[:, 0]]
        for i in range(1, prefix):
            near += capped[i][rows[:, i]]
        for i in range(int(nearer[at])):
            asking = int(np.searchsorted(-nearer[at : at + step], -i))
            near[:asking] *= weight[rows[:asking, i]] <= max(posted, 0)
        own = is_member[(is_member >= at) & (is_member < at + step)]
        near[own - at, itself[own]] = 0
        cut = np.maximum(np.partition(near, size - reranked, axis=1)[:, size - reranked], 1)[:, None] if size > reranked + 1 else np.uint8(1)
        a, b = np.divmod(np.flatnonzero(near >= cut), size)
        for part in range(0, len(a), 8192):
            x, y = query_rows[at + a[part : part + 8192]], b[part : part + 8192]
            close = np.flatnonzero(np.einsum("ij,ij->i", single[x], near_by[y]) >= least - 1e-5)
            x, y = x[close], member_rows[y[close]]
            exact = np.round(np.minimum(np.einsum("ij,ij->i", units[x], units[y]), 1.0), 9)
            keep = exact >= least
            out.append((x[keep], y[keep], exact[keep]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))


def directions(vectors: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each vector's direction, equal for copies and for scaled copies."""
    scaled = (vectors / np.abs(vectors).max(axis=1)[:, None]).astype("<f4") + np.float32(0)
    return np.array([int.from_bytes(hashlib.blake2b(row.tobytes(), digest_size=8).digest(), "little", signed=True) for row in scaled], np.int64)


def _by_dimension(vectors: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each dimension: itself, the places of its vectors, and these as a table."""
    length, flat = np.diff(vectors.offsets.to_numpy()), vectors.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(length) - length
    for dimension in np.unique(length):
        rows = np.flatnonzero(length == dimension)
        yield int(dimension), rows, flat[starts[rows][:, None] + np.arange(dimension)]


def _distinct_directions(df: DataFrame, most: dict[int, int]) -> dict[int, np.ndarray]:
    """By dimension, up to ``most`` vectors of different directions: those with the smallest hashes, so that copies, also scaled ones, count once."""

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for dimension, rows, values in _by_dimension(batch.column(1)):
                hashes, numbers = directions(values), ids[rows]
                if dimension in kept:
                    hashes, numbers = np.concatenate([kept[dimension][0], hashes]), np.concatenate([kept[dimension][1], numbers])
                order = np.lexsort((numbers, hashes))
                hashes, first = np.unique(hashes[order], return_index=True)
                kept[dimension] = hashes[: most[dimension]], numbers[order][first][: most[dimension]]
        for dimension, (hashes, numbers) in kept.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hashes), dimension, np.int32)), pa.array(hashes), pa.array(numbers)], names=["dimension", "direction", "embedding_no"])

    found = df.select("embedding_no", "vector").mapInArrow(smallest, "dimension int, direction bigint, embedding_no bigint")
    first = found.groupBy("dimension", "direction").agg(F.min("embedding_no").alias("embedding_no"))
    place = F.row_number().over(Window.partitionBy("dimension").orderBy("direction"))
    chosen = first.withColumn("place", place).where(F.col("place") <= max(most.values(), default=0))
    sample = df.join(F.broadcast(chosen), ["embedding_no"]).where(F.size("vector") == F.col("dimension")).groupBy("dimension", "place").agg(F.min("vector").alias("vector")).collect()
    out: dict[int, list] = {}
    for dimension, place, vector in sorted(sample, key=lambda r: (r["dimension"], r["place"])):
        if place <= most[dimension]:
            out.setdefault(dimension, []).append(vector)
    return {d: np.array(v, float) for d, v in out.items()}


def cells_of(pivots: np.ndarray, cells: int) -> np.ndarray:
    """The cell of each pivot: the nearest of the first ``cells`` pivots, which are as random as any."""
    out = np.empty(len(pivots), np.int32)
    for at in range(0, len(pivots), 4096):
        out[at : at + 4096] = (pivots[at : at + 4096] @ pivots[:cells].T).argmax(1)
    return out


def _encoded(df: DataFrame, sizes: dict[int, int], index: PermutationIndex) -> tuple[DataFrame, Broadcast]:
    """``embedding_no, version, key, packed, permutation, cells`` of usable vectors, and by dimension the cell of each pivot.

    ``key`` is equal for equal vectors of a version, ``permutation`` holds numbers of two bytes, ``cells`` are those of the first pivots.
    """
    chosen = _distinct_directions(df, index.pivots(sizes))
    pivots = {d: (v / np.sqrt((v * v).sum(1))[:, None]).astype(np.float32) for d, v in chosen.items()}
    cells = {d: cells_of(v, min(len(v), index.cells(len(v), sizes[d]))) for d, v in pivots.items()}
    context = df.sparkSession.sparkContext
    shared, cell_of = context.broadcast(pivots), context.broadcast(cells)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions, vectors = batch.columns
            for dimension, rows, values in _by_dimension(vectors):
                unit = (values / np.sqrt((values * values).sum(1))[:, None]).astype(np.float32)
                order = nearest_pivots(unit, shared.value[dimension], min(index.prefix, len(shared.value[dimension])))
                version = versions.take(pa.array(rows))
                packed = [pack_vector(v) for v in values]
                keys = [hashlib.blake2b(p, digest_size=16, key=b"%d" % v).digest() for p, v in zip(packed, version.to_pylist())]
                among = cell_of.value[dimension][order[:, : index.postings]]
                columns = [ids.take(pa.array(rows)), version, pa.array(keys, pa.binary()), pa.array(packed, pa.binary()), pa.array([x.tobytes() for x in order], pa.binary()), pa.array([sorted(set(x)) for x in among.tolist()], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, names=["embedding_no", "version", "key", "packed", "permutation", "cells"])

    return df.mapInArrow(encode, "embedding_no bigint, version int, key binary, packed binary, permutation binary, cells array<int>"), cell_of


def _distinct(encoded: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Equal vectors once, as ``version, ids, packed, permutation, cells`` with their ``k + 1`` smallest ids, and ``key, ids`` of those that came more than once.

    Only keys and ids are sorted; the vectors that came once stay where they are while the others' keys are few enough to be sent to all.
    """
    place = F.dense_rank().over(Window.partitionBy("key").orderBy("embedding_no"))
    counted = encoded.select("key", "embedding_no").withColumn("place", place).where(F.col("place") <= k + 1)
    several = cut_lineage(counted.groupBy("key").agg(F.array_sort(F.collect_set("embedding_no")).alias("ids"), F.count(F.lit(1)).alias("c")).where("c > 1").select("key", "ids"))
    known = encoded.join(several, "key", "left")
    once = known.where("ids is null").select("version", F.array("embedding_no").alias("ids"), "packed", "permutation", "cells")
    rest = known.where(F.col("embedding_no") == F.col("ids")[0]).groupBy("key", "version").agg(*[F.first(c).alias(c) for c in ("ids", "packed", "permutation", "cells")])
    return once.unionByName(rest.drop("key")), several


#: Bits of a row's place in the search: the version, the cell and the block, and the last bit for rows that are members only.
BLOCK_BITS, CELL_BITS = 24, 17


def _posted(distinct: DataFrame, index: PermutationIndex) -> DataFrame:
    """``place, member``: ``distinct`` once for each of its cells, and of a large cell for each of its blocks.

    In exactly one of the blocks a row is a query; in all it is a member. ``place`` tells version, cell, block and, last, whether it is
    only a member; ``member`` holds the permutation's length, ids, permutation and vector in one stretch of bytes.
    """
    number = F.shiftleft(F.col("version").cast("bigint"), CELL_BITS) + F.col("cell")
    ids = F.aggregate("ids", F.lit(b""), lambda t, x: F.concat(t, F.unhex(F.lpad(F.hex(x), 16, "0"))))
    head = F.unhex(F.lpad(F.hex(F.length("permutation") * 256 + F.size("ids")), 4, "0"))
    whole = distinct.select("version", "cells", F.col("ids")[0].alias("id"), F.concat(head, ids, "permutation", "packed").alias("member"))
    each = whole.select("version", F.explode("cells").alias("cell"), "id", "member").select(number.alias("number"), "id", "member")
    sizes = distinct.select("version", F.explode("cells").alias("cell")).groupBy(number.alias("number")).agg(F.count(F.lit(1)).alias("c"))
    large = cut_lineage(sizes.where(F.col("c") > index.chunk).select("number", F.ceil(F.col("c") / index.chunk).cast("int").alias("blocks")))
    many = large.limit(SENT_CELLS + 1).count()
    divided = each.withColumn("blocks", F.lit(1))
    if many:
        found = each.join(F.broadcast(large) if many <= SENT_CELLS else large, "number", "left")
        divided = found.withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    rows = divided.select("number", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "member")
    block = F.shiftleft(F.col("number"), BLOCK_BITS) + F.col("block")
    return rows.select((F.shiftleft(block, 1) + (F.col("own") != F.col("block")).cast("int")).alias("place"), "member")


def _taken_apart(members: pa.Array) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """The permutations, ids and unit vectors of ``member`` values of one cell."""
    ids, orders, vectors = [], [], []
    for raw in members.to_pylist():
        prefix, n = raw[0], raw[1]
        at = 2 + 8 * n
        ids.append(np.frombuffer(raw, ">i8", n, 2))
        orders.append(raw[at : at + prefix])
        vectors.append(raw[at + prefix :])
    table = unpack_vectors(pa.array(vectors, pa.binary()))
    return np.frombuffer(b"".join(orders), "<u2").reshape(len(orders), -1), ids, table / np.sqrt((table * table).sum(1))[:, None]


def most_similar(df: DataFrame, k: int = 5, least: float = 0.85, index: PermutationIndex = PermutationIndex()) -> DataFrame:
    """``embedding_no, other, cosine``: for each usable vector its up to ``k`` most similar others of its version with at least ``least``.

    Cosines are rounded to 9 decimals; among equals the smaller id goes first. See ``usable_vectors`` for which rows count; repeated rows
    count once; equal vectors under several ids are each other's neighbours. A version with one vector and the empty table give no rows.
    Of what the index finds everything is exact; it may miss a neighbour that shares none of the first pivots.
    """
    usable, sizes = usable_vectors(df)
    rows, cell_of = _encoded(usable, sizes, index)
    encoded = cut_lineage(rows)
    distinct, several = _distinct(encoded, k)
    tasks = max(1, min(MOST_TASKS, sum(sizes.values()) * index.postings // index.chunk))
    rows = _posted(distinct, index).repartition(tasks, F.shiftright("place", 1)).sortWithinPartitions("place")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, parts in _groups(batches, index.chunk):
            yield from _best_of_cell(block, parts, cell_of.value, k, least, index)

    found = rows.mapInArrow(search, "a bigint, b bigint, cosine double")
    near = F.struct((-F.col("cosine")).alias("d"), F.col("b").alias("id"))
    best = found.groupBy("a").agg(F.slice(F.array_sort(F.collect_set(near)), 1, k).alias("near"))

    copies = several.where(F.size("ids") > 1).select("key", F.col("ids")[0].alias("a"), F.transform("ids", lambda x: F.struct(F.lit(-1.0).alias("d"), x.alias("id"))).alias("own"))
    members = encoded.select("key", F.col("embedding_no").alias("member")).join(copies.select("key", "a"), "key").select("a", "member").distinct()
    lists = best.join(copies.select("a", "own"), "a", "full")
    nothing = F.array().cast("array<struct<d:double,id:bigint>>")
    lists = lists.select("a", F.array_sort(F.concat(F.coalesce("own", nothing), F.coalesce("near", nothing))).alias("near"))
    lists = lists.join(members, "a", "left").select(F.coalesce("member", "a").alias("embedding_no"), "near")
    chosen = F.slice(F.filter("near", lambda x: x["id"] != F.col("embedding_no")), 1, k)
    return lists.select("embedding_no", F.explode(chosen).alias("x")).select("embedding_no", F.col("x.id").alias("other"), (-F.col("x.d")).alias("cosine"))


def similar_pairs(df: DataFrame, k: int = 5, least: float = 0.85, index: PermutationIndex = PermutationIndex()) -> DataFrame:
    """``embedding_no_a, embedding_no_b``: each pair once, smaller id first, in which one is among the other's ``k`` most similar."""
    near = most_similar(df, k, least, index)
    return near.select(F.least("embedding_no", "other").alias("embedding_no_a"), F.greatest("embedding_no", "other").alias("embedding_no_b")).distinct()


def _groups(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[tuple[int, Iterator[tuple[bool, pa.Array]]]]:
    """For each block of a cell in turn its number and its members: first the queries, whole, then the others in chunks. Rows arrive sorted."""

    def pieces() -> Iterator[tuple[int, pa.Array]]:
        for batch in batches:
            if batch.num_rows:
                places = batch.column(0).to_numpy()
                starts = np.concatenate([[0], np.flatnonzero(places[1:] != places[:-1]) + 1, [len(places)]])
                for start, end in zip(starts, starts[1:]):
                    for at in range(start, end, chunk):
                        yield int(places[start]), batch.column(1).slice(at, min(at + chunk, end) - at)

    def arrays(parts: Iterator) -> Iterator[tuple[bool, pa.Array]]:
        for place, run in groupby(parts, key=lambda x: x[0]):
            asks, waiting = place % 2 == 0, []
            for _, piece in run:
                if not asks and waiting and sum(map(len, waiting)) + len(piece) > chunk:
                    yield asks, pa.concat_arrays(waiting)
                    waiting = []
                waiting.append(piece)
            yield asks, pa.concat_arrays(waiting)

    for block, parts in groupby(pieces(), key=lambda x: x[0] >> 1):
        yield block, arrays(parts)


def _best_of_cell(block: int, parts: Iterator[tuple[bool, pa.Array]], cell_of: dict[int, np.ndarray], k: int, least: float, index: PermutationIndex) -> Iterator[pa.RecordBatch]:
    """``a, b, cosine`` for one block of a cell: of each query the ``k`` best that the inverted files of the cell's pivots hold."""
    queries, best = None, []
    cell = (block >> BLOCK_BITS) & ((1 << CELL_BITS) - 1)
    for asking, members in parts:
        if queries is None and not asking:
            return
        orders, ids, units = _taken_apart(members)
        copies = np.array([len(x) for x in ids])
        flat, start = np.concatenate(ids).astype(np.int64), np.cumsum(copies) - copies
        if asking:
            queries = (orders, units, flat[start])
        at = 0 if asking else len(queries[0])
        every = units if asking else np.vstack([queries[1], units])
        single = every.astype(np.float32)
        mine = cell_of[units.shape[1]] == cell
        asked, posted = (_by_pivot(x[:, : index.postings], mine) for x in (queries[0], orders))
        for pivot, held in posted.items():
            rows = asked.get(pivot)
            if rows is None or (asking and len(rows) < 2):
                continue
            row, other, cosine = file_neighbors(pivot, queries[0][rows], orders[held], rows, held + at, (every, single), least, index)
            other = other - at
            often = copies[other]
            row, cosine, place = np.repeat(row, often), np.repeat(cosine, often), np.repeat(start[other], often)
            best.append((row, flat[place + np.arange(len(place)) - np.repeat(np.cumsum(often) - often, often)], cosine))
        best = [_top(best, k)] if best else []
    if best and len(best[0][0]):
        row, other, cosine = best[0]
        yield pa.RecordBatch.from_arrays([pa.array(queries[2][row]), pa.array(other), pa.array(cosine)], names=["a", "b", "cosine"])


def _by_pivot(orders: np.ndarray, mine: np.ndarray) -> dict[int, np.ndarray]:
    """The rows posted under each pivot of the cell."""
    rows, places = np.nonzero(mine[orders])
    names = orders[rows, places]
    order = np.argsort(names, kind="stable")
    pivots, starts = np.unique(names[order], return_index=True)
    return dict(zip(pivots.tolist(), np.split(rows[order], starts[1:])))


def _top(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row its ``k`` best others, each once; among equal cosines the smaller id."""
    row, other, cosine = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((other, -cosine, row))
    row, other, cosine = row[order], other[order], cosine[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (other[1:] != other[:-1])
    row, other, cosine = row[new], other[new], cosine[new]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[keep], other[keep], cosine[keep]
