import os
import random

import pytest

from folioflow.llm import encoding

pytestmark = pytest.mark.skipif(not os.path.exists(encoding.VOCABULARY), reason="no vocabulary file here")
PARTS = ["a", "b", "aa", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "　", "​", "é", "中", "文", "1", "²", "!", "…", "'s", "'S", "😀", "́", "<|endoftext|>", "\r\n", "﻿", "\x00", "aaaa", " The", "ab" * 9]


@pytest.fixture(scope="module")
def public():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(encoding.VOCABULARY)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def lists(encoder, texts):
    ids, offsets = encoder.encode(texts)
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


def test_equals_the_public_tokenizer_on_random_text(public):
    rng = random.Random(5)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 15))) for _ in range(4000)]
    encoder = encoding.PairIndexEncoder(encoding.read_vocabulary())
    assert lists(encoder, texts) == [public(t) for t in texts]
    assert encoder.counts(texts).tolist() == [len(public(t)) for t in texts]


def test_forgetting_pieces_changes_nothing(public, monkeypatch):
    monkeypatch.setattr(encoding, "PIECES_KEPT", 5)
    encoder = encoding.PairIndexEncoder(encoding.read_vocabulary())
    for texts in (["one two three four", "five six"], ["one seven", "eight two"], ["a b c d e f g h"]):
        assert lists(encoder, texts) == [public(t) for t in texts]


def test_column(spark, public):
    texts = [None, "", "   ", "plain text", "plain text", "x" * 200_000, "词" * 20_000, "<|endoftext|>"]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, ids_ string")
    got = {r["doc_id"]: r for r in df.select("*", encoding.token_ids(spark)(df["text"]).alias("ids"), encoding.token_counts(spark)(df["text"]).alias("n")).collect()}
    for i, t in enumerate(texts):
        assert got[i]["ids"] == (public(t) if t else []) and got[i]["n"] == len(got[i]["ids"])
    assert df.limit(0).select(encoding.token_ids(spark)(df["text"]).alias("ids")).collect() == []


def test_too_large_a_vocabulary_is_refused(monkeypatch):
    monkeypatch.setattr(encoding, "VOCABULARY_BYTES", 10)
    with pytest.raises(ValueError):
        encoding.read_vocabulary()
