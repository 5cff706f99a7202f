import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from folioflow.llm import neighbors
from folioflow.llm.neighbors import PermutationIndex, most_similar, pack_vector, similar_pairs, unpack_vectors

SCHEMA = "embedding_no long, embedding_model_version string, embedding_dimension long, vector array<double>, version string, key int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)


def brute(rows, k=5, least=0.85):
    out, by = set(), {}
    for no, version, _, vector in {r[0]: r for r in rows}.values():
        by.setdefault(version, []).append((no, vector))
    for members in by.values():
        no, x = np.array([m[0] for m in members]), np.array([m[1] for m in members])
        unit = x / np.sqrt((x * x).sum(1))[:, None]
        cosine = np.round(np.minimum(unit @ unit.T, 1), 9)
        for i in range(len(no)):
            others = [j for j in np.lexsort((no, -cosine[i])) if j != i and cosine[i, j] >= least][:k]
            out |= {(min(no[i], no[j]), max(no[i], no[j])) for j in others}
    return out


def clustered(seed, count, dimension, size, spread, version="v"):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(count):
        centre = rng.normal(size=dimension)
        for _ in range(size):
            rows.append((len(rows) + 1, version, dimension, (centre + spread * rng.normal(size=dimension)).round(3).tolist()))
    return rows


def test_recall_against_brute_force(spark):
    rows = clustered(1, 120, 32, 12, 0.3)
    rows += [(10_000 + n, "w", d, v) for n, _, d, v in clustered(2, 10, 16, 6, 0.25)]
    want = brute(rows)
    got = {tuple(r) for r in similar_pairs(frame(spark, rows + rows[:50])).collect()}
    assert len(want & got) >= 0.97 * len(want) and len(got - want) <= 0.03 * len(want)
    assert all(a < b for a, b in got)


def test_equal_and_scaled_vectors(spark):
    rows = [(n, "v", 3, [1.0, 2.0, 2.0]) for n in range(1, 40)] + [(50, "v", 3, [2.0, 4.0, 4.0]), (0, "v", 3, [0.5, 1.0, 1.0]), (60, "v", 3, [-1.0, 0.0, 0.0])]
    near = most_similar(frame(spark, rows)).collect()
    lists = {}
    for r in near:
        lists.setdefault(r["embedding_no"], []).append(r["other"])
    assert sorted(lists[30]) == [0, 1, 2, 3, 4] and sorted(lists[2]) == [0, 1, 3, 4, 5] and sorted(lists[50]) == [0, 1, 2, 3, 4] and sorted(lists[0]) == [1, 2, 3, 4, 5]
    assert 60 not in lists and {r["cosine"] for r in near} == {1.0}
    assert {tuple(r) for r in similar_pairs(frame(spark, rows)).collect()} == brute(rows)


def test_unusable_rows_and_empty_table(spark):
    good = [(1, "v", 2, [1.0, 0.1]), (2, "v", 2, [1.0, 0.2]), (3, "v", 2, [1.0, 0.3])]
    bad = [
        (4, "v", 3, [1.0, 0.1]), (5, "v", 3, [1.0, 0.1, 0.0]), (6, "v", 2, [0.0, 0.0]), (7, "v", 2, [float("nan"), 1.0]), (8, "v", 2, [float("inf"), 1.0]),
        (9, "v", 2, [None, 1.0]), (10, "v", 2, None), (11, "v", None, [1.0, 0.1]), (12, None, 2, [1.0, 0.1]), (None, "v", 2, [1.0, 0.1]), (13, "v", 2, []), (14, "w", 2, [1.0, 0.1]),
    ]
    assert {tuple(r) for r in similar_pairs(frame(spark, good + bad)).collect()} == {(1, 2), (1, 3), (2, 3)}
    assert similar_pairs(frame(spark, [])).collect() == [] and similar_pairs(frame(spark, bad[:3])).collect() == []


@pytest.mark.parametrize("chunk", [7, 50, 16_384])
def test_large_cells_are_searched_in_blocks_without_loss(spark, chunk):
    rows = clustered(3, 40, 16, 10, 0.15)
    got = {tuple(r) for r in similar_pairs(frame(spark, rows), index=PermutationIndex(least_pivots=16, chunk=chunk)).collect()}
    want = brute(rows)
    assert len(want & got) >= 0.98 * len(want)


def test_one_cell_holds_nearly_all(spark):
    rng = np.random.default_rng(6)
    rows = [(i, "v", 8, (np.ones(8) + 0.01 * rng.normal(size=8)).round(6).tolist()) for i in range(300)] + [(1000 + i, "v", 8, rng.normal(size=8).round(3).tolist()) for i in range(30)]
    small = {tuple(r) for r in similar_pairs(frame(spark, rows), index=PermutationIndex(least_pivots=4, chunk=20)).collect()}
    assert len(brute(rows) & small) >= 0.98 * len(brute(rows))


def test_recall_beside_a_vector_with_a_third_of_the_rows(spark):
    rng = np.random.default_rng(4)
    hot = rng.normal(size=32).round(3)
    beside = hot + 0.5 * rng.normal(size=(120, 1, 32)) + 0.05 * rng.normal(size=(120, 2, 32))
    vectors = np.vstack([beside.reshape(-1, 32).round(3), rng.normal(size=(3000, 32)).round(3), np.tile(hot, (800, 1)), hot * np.arange(2, 802)[:, None]])
    rows = [(i, "v", 32, v) for i, v in enumerate(vectors.tolist())]
    got = {tuple(r) for r in similar_pairs(frame(spark, rows), index=PermutationIndex(least_pivots=1024)).collect()}
    assert sum((i, i + 1) in got for i in range(0, 240, 2)) >= 0.97 * 120


def test_pivots_are_distinct_directions_and_ties_go_by_number(spark):
    rows = [(i, "v", 2, [3.0 * i, 4.0 * i]) for i in range(1, 50)] + [(100, "v", 2, [1.0, 0.0]), (101, "v", 2, [-1.0, -0.0]), (101, "v", 2, [-1.0, -0.0])]
    chosen = neighbors._distinct_directions(frame(spark, rows).select("embedding_no", "vector"), {2: 10})
    assert sorted(map(tuple, chosen[2].tolist())) == [(-1.0, 0.0), (1.0, 0.0), (3.0, 4.0)]
    pivots = np.vstack([np.tile([[1.0, 0.0]], (300, 1)), [[0.6, 0.8]]]).astype(np.float32)
    assert neighbors.nearest_pivots(np.array([[1.0, 0.0], [0.999, 0.0447]], np.float32), pivots, 8).tolist() == [list(range(8))] * 2


@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=20))
def test_packed_vectors_come_back_whole(values):
    for row in (np.array(values), np.round(np.array(values) / 1e6, 3)):
        assert (unpack_vectors(pa.array([b"x", pack_vector(row), pack_vector(row)], pa.binary())[1:])[1] == row).all()
    mixed = pa.array([pack_vector(np.array([0.5, 1.0])), pack_vector(np.array([1 / 3, 1.0])), pack_vector(np.array([0.25, 1.0]))], pa.binary())
    assert unpack_vectors(mixed).tolist() == [[0.5, 1.0], [1 / 3, 1.0], [0.25, 1.0]]


def test_number_of_pivots_is_bounded_for_all_dimensions_together():
    index = PermutationIndex()
    assert index.pivots({64: 10}) == {64: 64} and index.pivots({2: 10**9}) == {2: neighbors.MOST_PIVOTS}
    many = index.pivots({d: 10**9 // d for d in range(64, 4096, 64)})
    assert sum(4 * d * n for d, n in many.items()) <= neighbors.PIVOT_BYTES + sum(4 * d * index.least_pivots for d in many)
    assert index.cells(1000, 128_000) > 1 and index.cells(1000, 10**9) == 1000
    with pytest.raises(AttributeError):
        index.prefix = 3
