import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioflow.llm.splitting import Pieces, landmarks, piece_bounds, pieces_to_make, split_texts

SMALL = Pieces(limit=60, overlap=10, least=15, window=4, landmark_every=8, reach=12)


def sound(text, bounds, sizes):
    assert bounds[0][0] == 0 and bounds[-1][1] == len(text)
    assert all(0 < e - s <= sizes.limit for s, e in bounds)
    assert all(1 <= a[1] - b[0] <= sizes.overlap and a[0] < b[0] for a, b in zip(bounds, bounds[1:]))


@settings(max_examples=200)
@given(st.text(alphabet=st.sampled_from("ab \n.,é中。😀́‍🇩🇪"), min_size=1, max_size=400))
def test_pieces_are_sound(text):
    sound(text, piece_bounds(text, SMALL), SMALL)


@pytest.mark.parametrize("text", ["x" * 20_000, "́" * 9000, "词" * 9000, "word " * 3000, "🇩🇪" * 5000, "\n" * 9000, "One sentence here. " * 900])
def test_long_texts_of_any_kind(text):
    sound(text, piece_bounds(text, Pieces()), Pieces())


def test_cuts_are_at_natural_boundaries():
    text = " ".join(f"Sentence number {i} is here." for i in range(900))
    bounds = piece_bounds(text, Pieces())
    assert all(text[e - 2 : e] == ". " for _, e in bounds[:-1]) and all(text[s - 1] == " " for s, _ in bounds[1:])


def test_an_edit_alters_only_pieces_near_it():
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) + rng.choice(["", "", ".", ",", ".\n\n"]) for _ in range(12_000))
    pieces = [text[s:e] for s, e in piece_bounds(text, Pieces())]
    edited = text[:30_000] + "an inserted remark " + text[30_000:]
    after = [edited[s:e] for s, e in piece_bounds(edited, Pieces())]
    assert len(set(pieces) - set(after)) <= 4


def test_a_landmark_depends_only_on_its_window():
    a, b = landmarks("q" * 7 + "the same text " * 40, 8, 5), landmarks("z" * 100 + "the same text " * 40, 8, 5)
    assert {x - 7 for x in a if x > 20} == {x - 100 for x in b if x > 113}
    with pytest.raises(ValueError):
        Pieces(limit=100, overlap=100)


def test_rows(spark):
    rows = [(1, "  short text \n", ["A", "B"], 9), (2, "Some words here. " * 400, None, 9), (3, None, ["C"], 9), (4, " \t\n", [], 9), (5, "", [], 9), (1, "  short text \n", ["A", "B"], 9)]
    df = spark.createDataFrame(rows, "block_no long, text string, section_path array<string>, Char_Start int")
    got = split_texts(df, "text").collect()
    assert got[0].asDict().keys() == {"block_no", "section_path", "Char_Start", "piece_index", "piece_count", "char_start_", "char_end", "piece"}
    assert [(r["char_start_"], r["char_end"], r["piece"], r["section_path"]) for r in got if r["block_no"] == 1] == [(0, 10, "short text", ["A", "B"])] * 2
    long, body = sorted((r for r in got if r["block_no"] == 2), key=lambda r: r["piece_index"]), ("Some words here. " * 400).strip()
    sound(body, [(r["char_start_"], r["char_end"]) for r in long], Pieces())
    assert all(r["piece"] == body[r["char_start_"] : r["char_end"]] and r["piece_count"] == len(long) for r in long)
    assert {r["block_no"] for r in got} == {1, 2} and split_texts(df.limit(0), "text").collect() == []


def test_good_pieces_spare_a_block(spark):
    text = "w" * 6500
    good = [(0, 3200), (3100, 6250), (6100, 6500)]
    cases = {
        1: (good, 3), 2: (good[:2], 3), 3: ([(1, 3200), *good[1:]], 3), 4: ([(0, 3200), (3200, 6300), (6200, 6500)], 3), 5: ([(0, 3200), (2999, 6100), (6000, 6500)], 3),
        6: ([(0, 3201), (3100, 6250), (6100, 6500)], 3), 7: ([*good[:2], (6100, 6499)], 3), 8: ([], 0), 9: ([(0, 6500)], 1), 10: (good, 3), 11: (good, None),
    }
    audit = [(b, i, n, s, e, "m") for b, (p, n) in cases.items() for i, (s, e) in enumerate(p)]
    audit += audit[:2] + [(None, 0, 1, 0, 6500, "m"), (12, 0, 1, 0, 5, "m"), (10, 0, 1, 0, 9, None)]
    blocks = [(b, f"　 {text} \n") for b in cases] + [(1, f"　 {text} \n"), (12, "small"), (13, None), (None, text), (14, " " * 4000 + "x" * 3200), (15, "x" * 3201)]
    found = pieces_to_make(
        spark.createDataFrame(blocks, "block_no long, text string"),
        spark.createDataFrame(audit, "block_no long, subchunk_index long, subchunk_count long, char_start long, char_end long, embedding_model string"),
    )
    assert {r["block_no"] for r in found.collect()} == {2, 3, 4, 5, 6, 7, 8, 9, 11, 15}
