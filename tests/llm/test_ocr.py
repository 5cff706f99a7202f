import random

import pytest

from folioflow.llm import ocr
from folioflow.llm.ocr import lines_to_repair, numbers_of, paragraphs, shape_of

WORDS = "network training improves reliable estimation because several measurements differ between independent laboratories and careful documentation supports every conclusion drawn here".split()
SCHEMA = "page_no long, paper_id string, page_index long, success boolean, text string, state string"


def book(seed=3, papers=40):
    """Pages with what was planted in them: (page_no, line_no, kind)."""
    rng, rows, truth, page = random.Random(seed), [], set(), 0
    for p in range(papers):
        title, first = f"On {rng.choice(WORDS).title()} Methods for {rng.choice(WORDS).title()} Systems", rng.randint(1, 300)
        head = ["AIMR 2024", "Smithson et al.", title][p % 3]
        words = [rng.choice(WORDS) for _ in range(900)]
        at = 0
        for index in range(6):
            page += 1
            lines = []
            if index == 0:
                lines += [title, ""]
            else:
                lines.append(head)
                truth.add((page, 1, "running_line"))
            for _ in range(16):
                line = []
                while sum(map(len, line)) + len(line) < 48:
                    word = words[at % len(words)]
                    at += 1
                    if rng.random() < 0.12 and len(line) > 2:
                        word += "."
                    line.append(word)
                kinds = []
                if rng.random() < 0.1:
                    spot = next((i for i, w in enumerate(line) if "e" in w and len(w) > 5), None)
                    if spot is not None:
                        line[spot] = line[spot].replace("e", "c", 1)
                        kinds.append("misread")
                divided = rng.random() < 0.15 and len(words[at % len(words)]) > 7
                if divided:
                    word = words[at % len(words)]
                    line.append(word[:4] + "-")
                    words[at % len(words)] = word[4:]
                    kinds.append("hyphen")
                lines.append(" ".join(line))
                truth |= {(page, len(lines), k) for k in kinds}
            if index % 2:
                lines.insert(9, "")
                truth = {(a, b + (a == page and b >= 10), k) for a, b, k in truth}
            lines.append([f"{first + index}", f"- {first + index} -", f"Page {first + index} of 400"][p % 3])
            truth.add((page, len(lines), "page_number"))
            rows.append((page, f"paper{p}", index, True, ("\r\n" if p % 4 == 0 else "\n").join(lines), "clash"))
    return rows, truth


@pytest.fixture(scope="module")
def planted(spark):
    rows, truth = book()
    return rows, truth, {tuple(r) for r in lines_to_repair(spark.createDataFrame(rows + rows[:7], SCHEMA)).collect()}


def test_planted_lines_are_found(planted):
    _, truth, got = planted
    for kind in ("running_line", "page_number", "hyphen", "misread"):
        a, b = {t for t in truth if t[2] == kind}, {t for t in got if t[2] == kind}
        assert len(a & b) > 0.9 * len(a) and len(a & b) > 0.9 * len(b), kind


def test_the_model_decides_lines_it_was_not_trained_on(spark):
    (learnt_from, _), (rows, truth) = book(seed=5), book(seed=8)
    watched = []
    for some in (learnt_from, rows):
        parsed = ocr.page_lines(ocr.readable_pages(spark.createDataFrame(some, SCHEMA)))
        watched.append(parsed.join(ocr._told(parsed), "page_no", "left"))
    model = ocr.LineModel(ocr.train(watched[0]))
    for state, kind in ((ocr.RUNNING, "running_line"), (ocr.NUMBER, "page_number")):
        got = set()
        for r in watched[1].collect():
            told = {t["line_no"]: t for t in r["told"] or []}
            labels = model.best([ocr.features(a, b, r["page_index"], told.get(i)) for i, (a, b) in enumerate(zip(r["regions"], r["shapes"]), 1)])
            got |= {(r["page_no"], i, kind) for i, s in enumerate(labels, 1) if s == state}
        want = {t for t in truth if t[2] == kind}
        assert len(want & got) >= 0.98 * len(want) and len(want & got) >= 0.98 * len(got), kind


def test_an_interior_line_may_be_a_running_line():
    """No rule settles a line: what the counts say decides, inside a page as at its edge."""
    counts = {("place", ocr.RUNNING, "M"): 50, ("look", ocr.RUNNING, "title 3 yes"): 50, ("number", ocr.RUNNING, "-"): 50, ("heads", ocr.RUNNING, "-"): 50, ("place", ocr.BODY, "M"): 50, ("look", ocr.BODY, "low 1 -"): 50, ("number", ocr.BODY, "-"): 50, ("heads", ocr.BODY, "-"): 50}
    model = ocr.LineModel(counts)
    assert model.best([("M", "low 1 -", "-", "-"), ("M", "title 3 yes", "-", "-"), ("-", "blank 1 -", "-", "-")]) == [ocr.BODY, ocr.RUNNING, ocr.BREAK]


def test_confusions_are_learnt_and_likenesses_are_not(spark):
    right = {w: 4000 for w in ("planner", "reader", "network", "kernel", "memory", "signal", "reward", "context", "dinner", "manner")}
    read = {w.replace("e", "ε", 1): 3 for w in right if "e" in w}
    counts = {**right, **read, "dimmer": 40, "manned": 300, "Fεnjorgor": 1, "résumé": 5}
    got = {r["word"]: r["meant"] for r in ocr.misread_words(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert {w for w, m in got.items() if m} == set(read) and all(got[w] == w.replace("ε", "e") for w in read)


def test_paragraphs_go_on_over_every_page(spark, monkeypatch):
    monkeypatch.setattr(ocr, "RANGE", 3)
    rows = [(i, "a", i, True, f"word{i} goes on and every line ends without a stop here\nin small letters that never end and go", "") for i in range(11)]
    rows = [(n, p, i, s, t if i == 0 else "and " + t, x) for n, p, i, s, t, x in rows]
    got = paragraphs(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 1 and all(f"word{i} " in got[0]["text"] for i in range(11))


def test_many_misread_words_are_joined_by_shuffle(spark, planted, monkeypatch):
    monkeypatch.setattr(ocr, "BROADCAST_BYTES", -1)
    assert {tuple(r) for r in lines_to_repair(spark.createDataFrame(planted[0], SCHEMA)).collect()} == planted[2]


def test_paragraphs_are_continuous_and_clean(spark):
    rows, _ = book(papers=12)
    rows += [(901, "x", 0, True, None, ""), (902, "x", 1, True, "", ""), (903, None, 0, True, "Good planning of careful measurements-", "")]
    got = paragraphs(spark.createDataFrame(rows, SCHEMA)).collect()
    text = " ".join(r["text"] for r in got if r["paper_id"])
    assert "AIMR" not in text and "et al" not in text and "Page" not in text and "- " not in text
    words = [w.strip(".") for w in text.split()]
    assert sum(w in set(WORDS) for w in words) > 0.97 * len(words)
    assert any(r["first_page_no"] and len(r["text"]) > 800 for r in got) and "x" not in {r["paper_id"] for r in got}


def test_edge_cases(spark):
    rows = [
        (1, "a", 0, True, None, ""), (2, "a", 1, True, "", ""), (3, "a", 2, False, "some text-\n", ""), (4, None, None, True, "one word-\nly line", ""), (None, "a", 3, True, "some text", ""),
        (5, "a", 4, None, "some text", ""), (6, "b", 0, True, " \n\r\n", ""), (7, "b", 1, True, "x" * 50_000, ""), (8, "b", 2, True, "a b\n" * 5000, ""),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r["page_no"] for r in lines_to_repair(df).collect()} <= {4, 7, 8}
    assert lines_to_repair(df.limit(0)).collect() == []


@pytest.mark.parametrize(("line", "values"), [("184", [184]), ("[9]", [9]), ("— 12 —", [12]), ("- 9 -", [9]), ("Page 9 of 253", [9]), ("1 8 4", [184]), ("xiv", [14]), ("l9", [19]), ("9O", [90]), ("l", [1, 50]), ("21.4", []), ("7  8", []), ("to 76.", []), ("mild", []), ("", [])])
def test_page_number_forms(line, values):
    assert numbers_of(line) == values


@pytest.mark.parametrize(("line", "shape"), [("", "blank"), ("74.6  95.8", "figures"), ("6.1 Spectral threshold", "section"), ("Norilova and others    9", "credit"), ("lower start of", "low"), ("AIMR 2022", "title"), ("A Study of Compact Embeddings in", "title"), ("This ends here.", "end")])
def test_shapes(line, shape):
    assert shape_of(line) == shape
