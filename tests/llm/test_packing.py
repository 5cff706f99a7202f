import os
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioflow.llm import encoding
from folioflow.llm.packing import fill_containers, pack, segments_of

needs_vocabulary = pytest.mark.skipif(not os.path.exists(encoding.VOCABULARY), reason="no vocabulary file here")


@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 20)), max_size=80), st.integers(1, 6))
def test_pack_keeps_every_limit_and_every_row(rows, segments):
    sizes = np.array([(a, 1, min(b, 20)) for a, b in rows], np.int64).reshape(-1, 3)
    limits = np.array([50, segments, 20])
    containers = pack(sizes, limits)
    assert sorted(i for c in containers for i in c) == list(range(len(rows)))
    assert all((sizes[c].sum(0) <= limits).all() for c in containers)


@given(st.integers(0, 500), st.one_of(st.none(), st.integers(-3, 600)), st.integers(1, 90))
def test_segments_cover_the_text_and_only_oversized_ones_are_cut(tokens, loss, capacity):
    parts = segments_of(tokens, loss, capacity)
    assert parts[0][0] == 0 and parts[-1][1] == tokens and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
    assert all(e - s <= capacity and 0 <= x <= e - s for s, e, x in parts) and (len(parts) == 1) == (tokens <= capacity)
    if loss is not None:
        assert sum(x for *_, x in parts) == min(max(loss, 0), tokens)


def test_every_limit_can_bind():
    rng = np.random.default_rng(2)
    tokens = rng.integers(5, 60, 3000)
    sizes = np.column_stack([tokens, np.ones(3000, int), tokens // 2])
    for limits, column in (([1000, 10**6, 10**6], 0), ([10**6, 7, 10**6], 1), ([10**6, 10**6, 300], 2)):
        containers = pack(sizes, np.array(limits))
        assert max(sizes[c].sum(0)[column] for c in containers) == limits[column] and len(containers) >= sizes[:, column].sum() / limits[column]


def test_little_room_is_left():
    rng = np.random.default_rng(1)
    tokens = np.minimum(rng.lognormal(5, 1, 5000).astype(int) + 1, 2048)
    containers = pack(np.column_stack([tokens, np.ones(5000, int), tokens - 1]), np.array([2048, 64, 2048]))
    assert tokens.sum() / (2048 * len(containers)) > 0.98


@needs_vocabulary
def test_containers_do_not_depend_on_the_partitions(spark):
    df = spark.createDataFrame([(i, "word " * (i * 37 % 900), i % 9) for i in range(400)], "doc_id long, text string, own int")
    prompt = F.when(F.col("own") < 5, F.substring("text", 1, 300))
    runs = [{tuple(r) for r in fill_containers(x, "doc_id", "text", prompt=prompt, max_loss=1500, max_segments=9).collect()} for x in (df.repartition(5), df.orderBy(F.desc("doc_id")).coalesce(1))]
    assert runs[0] == runs[1]
    loss_of = defaultdict(int)
    for key, _, start, end, bears, container, _ in runs[0]:
        loss_of[container] += min(bears, 1500)
    assert max(loss_of.values()) <= 1500


@needs_vocabulary
@pytest.mark.parametrize("block", [7, 65536])
def test_texts(spark, block):
    texts = ["word " * n for n in (1, 3, 900, 5000, 40, 40, 700, 0)] + [None, "", "文" * 3000] + ["same text"] * 30
    df = spark.createDataFrame([(i % 40, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, container int").repartition(2)
    got = fill_containers(df, "doc_id", "text", max_segments=8, block=block).collect()
    tokens, segments, pieces = defaultdict(int), defaultdict(list), defaultdict(list)
    for r in got:
        tokens[r["container"]] += r["token_end"] - r["token_start"]
        segments[r["container"]].append(r["slot"])
        pieces[r["doc_id"]].append((r["token_start"], r["token_end"]))
    assert max(tokens.values()) <= 2048 and all(sorted(s) == list(range(len(s))) and len(s) <= 8 for s in segments.values())
    assert set(pieces) == {i % 40 for i in range(len(texts))}
    long = sorted(pieces[3])
    assert len(long) > 1 and long[0] == (0, 2048) and all(a[1] == b[0] for a, b in zip(long, long[1:]))
    assert pieces[8] == [(0, 0)] and pieces[9] == [(0, 0)]
    assert fill_containers(df.limit(0), "doc_id", "text").count() == 0
    with pytest.raises(ValueError):
        fill_containers(df, "doc_id", "text", capacity=0)
