"""Noise in text from scanned pages (problem 6).

Method: a hidden Markov model labels every line of a page as running line, page number, body, heading, stray figures or break, from layout
features: place on the page, shape, repetition of the line on other pages of the paper and on page edges of the corpus, agreement of
a number with the page's index. A few plain cases give the first counts; from then on the model decides every line with text (Viterbi) and
its counts are re-estimated from its own labels over all pages. Body lines are reassembled into paragraphs. Words divided at a line's
end are settled by the corpus' own word counts, and misread words by confusions learnt from the corpus: a pair of stretches is one if it
turns frequent words into rare ones evenly, in as many different words as its rate lets expect.

At scale: each text is read once for its lines; what a line needs to know of other pages comes by joins on (paper, line), (paper, offset)
and (paper, page), so no paper is gathered in one task; only the model's counts, bounded by states times feature values, reach the driver.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioflow.session import cut_lineage, release

STATES = ("running_line", "page_number", "body", "heading", "figures", "break")
RUNNING, NUMBER, BODY, HEADING, FIGURES, BREAK = range(6)
#: Lines from the top and from the bottom of a page that count as its edges.
EDGE = 3
#: Rounds of re-estimation, the count added to every feature value and transition, and how far below the best state (in logarithms) a state is still followed.
ROUNDS, SMOOTH, BEAM = 1, 0.05, 15.0
#: Occurrences that say where a line of the corpus stands, and the share of them at page edges from which it is known as one of edges.
SEEN, AT_EDGE = 5, 0.8
#: Bytes of misread words that are broadcast; more are joined by a shuffle.
BROADCAST_BYTES = 16_000_000
#: A word met so often can be what a rarer one was read for; a confusion needs so many different words, and this share of those its rate lets expect.
WORD_MET, CONFUSED_WORDS, EVENLY = 5, 3, 0.3
#: A rare word is misread if that is this many times as probable as a chance likeness, and if it isn't this many times as frequent as that lets expect.
ODDS, EXCESS = 4.0, 10.0
#: Places without a chance likeness that are taken as seen before any is counted.
UNSEEN = 1000
#: Distinct words a task keeps before it passes on what it has counted.
WORDS_KEPT = 1_000_000

# Signs that look alike to a scanner, for comparing lines; the marks of divided words, and numerals.
ALIKE = str.maketrans("i1!|ef0@5$96hu", "llllccoassgbbb")
MARKS = "-‐‑¬­"
ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}
ROMAN_FORM = re.compile(r"m{0,3}(cm|cd|d?c{0,4})(xc|xl|l?x{0,4})(ix|iv|v?i{0,4})")
NUMERAL = r"(?:[0-9lIOo|]{1,5}|[0-9lIOo|](?: [0-9lIOo|]){1,4}|[ivxlcdmIVXLCDM]{1,12})"
PAGE_NUMBER = re.compile(rf"[\[({{<—–\-·•*~|. ]*(?:page|pg\.?|p\.|seite|página)?\s*({NUMERAL})(?:\s*(?:of|/|von|de)\s*{NUMERAL})?[\])}}>—–\-·•*~| ]*", re.IGNORECASE)
FIGURE_LINE = re.compile(r"[\d\s.,%±+\-–—/()]*\d[\d\s.,%±+\-–—/()]*")
SECTION = re.compile(r"\d{1,2}(?:\.\d{1,2}){0,3}\.? [A-Z][^.]{0,80}")
#: What may stand around a word without being part of it.
AROUND = ".,;:?\"'()[]{}<>“”‘’«»…—–*"
CREDIT = re.compile(r"\b(?:et al\.|and others)(?:\s+\d+)?$|^\d+\s{2,}\D|\D\s{2,}\d+$")
LONG_WORD = re.compile(r"[^\W\d_]{4,}")
NUMBERS_IN = re.compile(r"\b[\dlIO]*\d[\dlIO]*\b")
DIGIT = re.compile(r"\d")
NOT_WORD = re.compile(r"[^\w]")


def numbers_of(line: str) -> list[int]:
    """The values a line that is nothing but a page number can have; empty for any other line."""
    found = PAGE_NUMBER.fullmatch(line)
    if not found:
        return []
    token, out = found.group(1).replace(" ", ""), []
    digits = re.sub(r"[lI|]", "1", re.sub(r"[Oo]", "0", token))
    if digits.isdigit():
        out.append(int(digits))
    low = token.lower()
    if low and set(low) <= set(ROMAN) and ROMAN_FORM.fullmatch(low):
        values = [ROMAN[c] for c in low]
        out.append(sum(-v if any(w > v for w in values[i + 1 :]) else v for i, v in enumerate(values)))
    return list(dict.fromkeys(out))


def line_key(line: str) -> str:
    """Letters in a form in which most misreadings of a line are equal to it; numbers, signs and white space are left out."""
    key = (NUMBERS_IN.sub("", line) if DIGIT.search(line) else line).lower().translate(ALIKE)
    for read, stood in (("cl", "d"), ("rn", "m"), ("ln", "m"), ("rl", "n"), ("ll", "b")):
        key = key.replace(read, stood)
    return NOT_WORD.sub("", key)


def shape_of(line: str) -> str:
    if not line:
        return "blank"
    first, last = line[0], line[-1]
    if numbers_of(line):
        return "number"
    if last != "." and FIGURE_LINE.fullmatch(line):
        return "figures"
    if first.isdigit() and SECTION.fullmatch(line):
        return "section"
    if CREDIT.search(line):
        return "credit"
    if last not in ".?!,;:-" and ". " not in line:
        words = LONG_WORD.findall(line)
        if words and sum(w[0].isupper() for w in words) >= 0.7 * len(words):
            return "title"
    if first.islower():
        return "low-end" if last in ".?!" else "low"
    return "end" if last in ".?!" else "text"


def regions_of(shapes: list[str]) -> list[str]:
    """T0-T2 and B0-B2 for the first and last lines with text, M for the others, - for blank lines."""
    full = [i for i, x in enumerate(shapes) if x != "blank"]
    region = dict.fromkeys(full, "M") | {full[k]: f"T{k}" for k in range(min(EDGE, len(full)))}
    for k in range(min(EDGE, len(full))):
        if 2 * k < len(full) or region[full[-1 - k]] == "M":
            region[full[-1 - k]] = f"B{k}"
    return [region.get(i, "-") for i in range(len(shapes))]


def divided_end(line: str) -> tuple[str, str] | None:
    """(word, mark) of a line whose last word has a mark of division behind it, else None."""
    if not line or line[-1] not in MARKS or line[-2:-1].isspace() or len(line) < 2:
        return None
    word = line[:-1].rsplit(None, 1)[-1].lstrip(AROUND + MARKS)
    return (word, line[-1]) if word and word[0].isalnum() else None


def words_of(line: str) -> list[str]:
    """The words of a line without what stands around them, hyphenated ones whole, without a divided last one."""
    tokens = line.split()
    if line and line[-1] in MARKS:
        tokens = tokens[:-1]
    return [w for w in (t.strip(AROUND) for t in tokens) if w]


def small(word: str) -> str:
    """Lower case for words that only begin with a capital; names with capitals inside stay."""
    low = word.lower()
    return low if word[1:] == low[1:] else word


FEATURES = ("place", "look", "number", "heads")


def features(region: str, shape: str, page_index: int | None, told: dict | None) -> tuple[str, ...]:
    """The values of ``FEATURES``: place; shape and repetition, which depend on each other; number; title. ``told`` is what other pages say."""
    place = "firstT0" if page_index == 0 and region == "T0" else region
    again, edge_only, number, heads = (told[k] for k in ("again", "edge_only", "number", "heads")) if told else (None,) * 4
    repeats = f"{min(max(again or 1, 1), 3)} {edge_only or '-'}"
    return place, f"{shape} {repeats}", number or "-", heads or "-"


def plain_case(values: tuple[str, ...]) -> int | None:
    """The state of a line in a plain case, which only seeds the model's first counts; None for all others."""
    place, look, number, heads = values
    edge, (shape, again, edge_only) = place[0] in "TBf", look.split()
    if shape == "number" and number in ("agrees", "differs"):
        return NUMBER if number == "agrees" and edge else FIGURES
    if shape == "figures":
        return FIGURES
    if shape == "section":
        return HEADING
    if place == "firstT0" and shape == "title":
        return HEADING
    if edge and shape in ("title", "credit", "text") and edge_only != "no" and (again == "3" or heads == "title" or edge_only == "yes"):
        return RUNNING
    if shape in ("end", "low-end", "low", "text") and again == "1" and edge_only != "yes" and (not edge or shape != "text"):
        return BODY
    return None


class LineModel:
    """Log probabilities of transitions and, feature by feature, of emissions, from counts; a blank line is a break and nothing else is."""

    def __init__(self, counts: dict[tuple[str, int, str], float]):
        n = len(STATES)
        start, step = [SMOOTH] * n, [[SMOOTH] * n for _ in range(n)]
        seen: dict[tuple[int, str], list[float]] = defaultdict(lambda: [SMOOTH] * n)
        sizes = [1 + len({v for k, _, v in counts if k == feature}) for feature in FEATURES]
        totals = [[SMOOTH * size] * n for size in sizes]
        for (kind, state, value), times in counts.items():
            if kind == "start":
                start[state] += times
            elif kind == "step":
                step[state][int(value)] += times
            else:
                f = FEATURES.index(kind)
                seen[f, value][state] += times
                totals[f][state] += times
        self.start = [math.log(x / sum(start)) for x in start]
        self.step = [[math.log(x / sum(row)) for x in row] for row in step]
        self.unseen = [[math.log(SMOOTH / t) for t in row] for row in totals]
        self.seen = {key: [math.log(x / totals[key[0]][s]) for s, x in enumerate(row)] for key, row in seen.items()}
        self.known: dict[tuple[str, ...], list[tuple[int, float]]] = {}

    def states(self, values: tuple[str, ...]) -> list[tuple[int, float]]:
        """The states a line can have, with the logarithm of its features' probability there; those far below the best are left out."""
        if values not in self.known:
            if values[0] == "-":
                self.known[values] = [(BREAK, 0.0)]
            else:
                rows = [self.seen.get((f, v), self.unseen[f]) for f, v in enumerate(values)]
                scores = [(s, sum(row[s] for row in rows)) for s in range(BREAK)]
                least = max(x for _, x in scores) - BEAM
                self.known[values] = [(s, x) for s, x in scores if x >= least]
        return self.known[values]

    def best(self, sequence: list[tuple[str, ...]]) -> list[int]:
        """The most probable states (Viterbi)."""
        if not sequence:
            return []
        front = [(s, self.start[s] + x) for s, x in self.states(sequence[0])]
        backs, step = [], self.step
        for values in sequence[1:]:
            after, back = [], {}
            for s, x in self.states(values):
                came, score = max(((p, y + step[p][s]) for p, y in front), key=lambda c: c[1])
                back[s] = came
                after.append((s, score + x))
            front = after
            backs.append(back)
        states = [max(front, key=lambda c: c[1])[0]]
        for back in reversed(backs):
            states.append(back[states[-1]])
        return states[::-1]


def _counted(sequence: list[tuple[str, ...]], states: list[int | None], into: Counter) -> None:
    """Adds a page's labels to the counts: (values, state) and ("start" or "step", ...); unlabelled lines count nowhere."""
    into.update((values, state) for values, state in zip(sequence, states) if state is not None)
    if states and states[0] is not None:
        into["start", states[0]] += 1
    into.update(("step", a, b) for a, b in zip(states, states[1:]) if a is not None and b is not None)


def readable_pages(pages: DataFrame) -> DataFrame:
    """``page_no, paper_id, page_index, text`` of recognised pages with text, repeated rows once; null numbers are left out."""
    rows = pages.where(F.col("page_no").isNotNull() & F.coalesce("success", F.lit(False)) & (F.btrim("text", F.lit(" \t\r\n")) != ""))
    rows = rows.select("page_no", "paper_id", F.col("page_index").cast("int").alias("page_index"), "text")
    return rows.groupBy("page_no").agg(F.min(F.struct("paper_id", "page_index", "text")).alias("x")).select("page_no", "x.*")


LINES = "lines array<string>, shapes array<string>, regions array<string>, keys array<string>, fresh array<boolean>, numbers array<array<bigint>>"


def page_lines(pages: DataFrame) -> DataFrame:
    """``page_no, paper_id, page_index`` and, line by line, ``LINES``: the line without white space around it and what it tells of itself.

    ``fresh`` marks the first of equal lines at a page's edges. Each text is parsed here and nowhere else.
    """
    kinds = [pa.list_(pa.string())] * 4 + [pa.list_(pa.bool_()), pa.list_(pa.list_(pa.int64()))]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(3).to_pylist():
                lines = [x.strip() for x in text.split("\n")]
                shapes = [shape_of(x) for x in lines]
                regions = regions_of(shapes)
                keys = [line_key(x) for x in lines]
                met: set[str] = set()
                fresh = [r[0] in "TB" and k not in met and not met.add(k) for r, k in zip(regions, keys)]
                out.append((lines, shapes, regions, keys, fresh, [numbers_of(x) if s == "number" else [] for x, s in zip(lines, shapes)]))
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=[*batch.schema.names[:3], *[x.split()[0] for x in LINES.split(", ")]])

    return pages.mapInArrow(parse, f"page_no bigint, paper_id string, page_index int, {LINES}")


def _told(lines: DataFrame) -> DataFrame:
    """``page_no, told``: for the lines of which other pages say something, ``line_no, again, edge_only, number, heads``.

    - ``again``: on how many pages of the paper the line stands at an edge. ``edge_only``: whether the corpus has it at edges (yes) or
      elsewhere (no); both are shares of what was seen, so they mean the same at every size.
    - ``number``: whether a number follows the paper's page numbers. ``heads``: whether a line is the paper's title or its beginning.
    Pages without a paper are a paper each.
    """
    paper = F.coalesce("paper_id", F.concat(F.lit("\0"), F.col("page_no").cast("string"))).alias("paper")
    zipped = F.posexplode(F.arrays_zip("keys", "regions", "shapes", "fresh", "numbers")).alias("at", "l")
    each = lines.select("page_no", paper, "page_index", zipped).select("page_no", "paper", "page_index", (F.col("at") + 1).alias("line_no"), "l.*")
    keyed = each.where("keys <> ''").select("page_no", "paper", "page_index", "line_no", "keys", "regions", "shapes", "fresh")
    inner = F.col("regions") == "M"
    of_paper = cut_lineage(keyed.groupBy("paper", "keys").agg(F.count_if("fresh").alias("again"), F.count_if(inner).alias("inside"), F.count_if(~inner).alias("outside")))
    share = F.col("outside") / (F.col("outside") + F.col("inside"))
    only = F.when((F.col("inside") > 1) & (share < AT_EDGE), "no").when((F.col("outside") >= SEEN) & (share >= AT_EDGE), "yes").otherwise("-")
    of_corpus = of_paper.groupBy("keys").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).where("inside + outside > 1").select("keys", only.alias("edge_only"))
    facts = of_paper.join(of_corpus, "keys").where("again > 1 or edge_only <> '-'").select("paper", "keys", "again", "edge_only")
    places = keyed.select("page_no", "line_no", "paper", "keys").join(facts, ["paper", "keys"]).select("page_no", "line_no", "again", "edge_only")

    numbers = each.where("shapes = 'number' and page_index is not null").select("page_no", "paper", "page_index", "line_no", F.explode("numbers").alias("n")).withColumn("offset", F.col("n") - F.col("page_index"))
    offsets = numbers.select("paper", "offset", "page_no").distinct().groupBy("paper", "offset").agg(F.count(F.lit(1)).alias("pages"))
    most = offsets.groupBy("paper").agg(F.max("pages").alias("most"))
    judged = numbers.join(offsets, ["paper", "offset"]).join(most, "paper")
    verdict = F.when((F.col("pages") >= 2) & (F.col("pages") * 2 > F.col("most")), "agrees").when(F.col("most") >= 2, "differs").otherwise("alone")
    numbered = judged.groupBy("page_no", "line_no").agg(F.min(verdict).alias("number"))

    titles = keyed.where("page_index = 0 and regions = 'T0' and length(keys) > 3").groupBy("paper").agg(F.min("keys").alias("title"))
    maybe = keyed.where("page_index <> 0 and shapes in ('title', 'credit', 'section') and length(keys) > 3").join(titles, "paper").where(F.startswith("title", "keys"))
    headed = maybe.select("page_no", "line_no", F.lit("title").alias("heads"))
    every = places.unionByName(numbered, True).unionByName(headed, True).groupBy("page_no", "line_no").agg(*[F.max(c).alias(c) for c in ("again", "edge_only", "number", "heads")])
    told = F.struct("line_no", F.col("again").cast("int").alias("again"), "edge_only", "number", "heads")
    out = cut_lineage(every.groupBy("page_no").agg(F.collect_list(told).alias("told")))
    release(of_paper)
    return out


def _sequences(batch: pa.RecordBatch) -> Iterator[list[tuple[str, ...]]]:
    for index, shapes, regions, told in zip(*(batch.column(c).to_pylist() for c in ("page_index", "shapes", "regions", "told"))):
        known = {t["line_no"]: t for t in told or []}
        yield [features(region, shape, index, known.get(i)) for i, (region, shape) in enumerate(zip(regions, shapes), 1)]


def train(pages: DataFrame) -> dict[tuple[str, int, str], float]:
    """The model's counts over all pages (``page_index, shapes, regions, told``): first from plain cases, then from its own labels."""
    learnt: dict | None = None
    for _ in range(1 + ROUNDS):

        def count(batches: Iterator[pa.RecordBatch], learnt=learnt) -> Iterator[pa.RecordBatch]:
            counts: Counter = Counter()
            model = learnt and LineModel(learnt)
            for batch in batches:
                for sequence in _sequences(batch):
                    states = model.best(sequence) if model else [BREAK if v[0] == "-" else plain_case(v) for v in sequence]
                    _counted(sequence, states, counts)
            sums: Counter = Counter()
            for key, times in counts.items():
                if key[0] in ("start", "step"):
                    sums[key[0], key[1], str(key[2]) if len(key) > 2 else ""] += times
                elif key[1] != BREAK:
                    for feature, value in zip(FEATURES, key[0]):
                        sums[feature, key[1], value] += times
            columns = list(zip(*((*k, n) for k, n in sums.items()))) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int32(), pa.string(), pa.int64()))], names=["kind", "state", "value", "n"])

        sums = pages.select("page_index", "shapes", "regions", "told").mapInArrow(count, "kind string, state int, value string, n bigint").groupBy("kind", "state", "value").agg(F.sum("n").alias("n"))
        learnt = {(r["kind"], r["state"], r["value"]): r["n"] for r in sums.collect()}
    return learnt


def labelled_pages(pages: DataFrame) -> DataFrame:
    """``page_no, paper_id, page_index, lines, states`` of every readable page: its lines and the state of each."""
    parsed = cut_lineage(page_lines(readable_pages(pages)))
    told = _told(parsed)
    joined = parsed.join(told, "page_no", "left")
    watched = cut_lineage(joined.select("page_no", "page_index", "shapes", "regions", "told"))
    learnt = train(watched)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LineModel(learnt)
        for batch in batches:
            states = pa.array([model.best(sequence) for sequence in _sequences(batch)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), states], names=["page_no", "states"])

    states = watched.mapInArrow(label, "page_no bigint, states array<int>")
    out = cut_lineage(parsed.select("page_no", "paper_id", "page_index", "lines").join(states, "page_no"))
    release(parsed, told, watched)
    return out


def _taken_apart(pages: DataFrame) -> DataFrame:
    """What the body of labelled pages says of words, told apart by ``kind``; one reading of all texts.

    - ``part``: ``word`` as ``small`` spells it, hyphens parted, with its count ``n``; a word after a divided one is left out, as it may be its rest.
    - ``form``: ``word`` in small letters with its hyphens. - ``top``: the first body line of a page and the ``word`` it begins with.
    - ``end``: a body line with a divided ``word``, its ``mark``, and within the page the ``tail`` that begins the next body line ``at_line``.
    """
    fields = [("kind", pa.string()), ("page_no", pa.int64()), ("line_no", pa.int32()), ("word", pa.string()), ("n", pa.int64()), ("mark", pa.string()), ("tail", pa.string()), ("at_line", pa.int32())]

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, forms = Counter(), Counter()

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 8
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])

        def counted() -> pa.RecordBatch:
            sums: Counter = Counter()
            for word, n in parts.items():
                for piece in word.split("-"):
                    if piece:
                        sums[small(piece)] += n
            rows = [("part", None, None, w, n, None, None, None) for w, n in sums.items()] + [("form", None, None, w, n, None, None, None) for w, n in forms.items()]
            parts.clear()
            forms.clear()
            return batch_of(rows)

        for batch in batches:
            rows = []
            for page, lines, states in zip(*(batch.column(c).to_pylist() for c in ("page_no", "lines", "states"))):
                body = [(i, x) for i, (x, s) in enumerate(zip(lines, states), 1) if s == BODY]
                open_, first = None, True
                for i, line in body:
                    words = words_of(line)
                    forms.update(w.lower() for w in words)
                    begin = words[0] if words else line.split(None, 1)[0].strip(AROUND + MARKS)
                    if first:
                        rows.append(("top", page, i, begin, None, None, None, None))
                        first = False
                    if open_:
                        rows.append(("end", page, open_[0], open_[1], None, open_[2], begin, i))
                        words = words[1:]
                    parts.update(words)
                    end = divided_end(line)
                    open_ = end and (i, *end)
                if open_:
                    rows.append(("end", page, open_[0], open_[1], None, open_[2], None, None))
            yield batch_of(rows)
            if len(parts) + len(forms) > WORDS_KEPT:
                yield counted()
        yield counted()

    kinds = "kind string, page_no bigint, line_no int, word string, n bigint, mark string, tail string, at_line int"
    return cut_lineage(pages.select("page_no", "lines", "states").mapInArrow(take, kinds))


def divided_words(pages: DataFrame, taken: DataFrame) -> DataFrame:
    """``page_no, line_no, head, mark, tail, at_page, at_line``: the divided words, with what begins the page's next body line or the paper's next page.

    ``tail`` is null where there is neither.
    """
    ends = taken.where("kind = 'end'").select("page_no", "line_no", F.col("word").alias("head"), "mark", "tail", F.when(F.col("at_line").isNotNull(), F.col("page_no")).alias("at_page"), "at_line")
    where = pages.where("paper_id is not null and page_index is not null").select("page_no", "paper_id", "page_index")
    tops = taken.where("kind = 'top'").select("page_no", "line_no", "word").join(where, "page_no")
    tops = tops.groupBy("paper_id", (F.col("page_index") - 1).alias("page_index")).agg(F.min(F.struct("page_no", "line_no", "word")).alias("t"))
    last = ends.where("at_line is null").drop("tail", "at_page", "at_line").join(where, "page_no", "left").join(tops, ["paper_id", "page_index"], "left")
    return ends.where("at_line is not null").unionByName(last.select("page_no", "line_no", "head", "mark", F.col("t.word").alias("tail"), F.col("t.page_no").alias("at_page"), F.col("t.line_no").alias("at_line")))


def _holes(words: pd.Series) -> pd.Series:
    """For every stretch of one or two characters of a word: a hash of its place and of what stands around it, the place and the length."""
    base, size = 1_000_003, (1 << 61) - 1

    def of(word: str) -> list[tuple[int, int, int]]:
        n, out = len(word), []
        after = [0] * (n + 1)
        for i in range(n - 1, -1, -1):
            after[i] = (after[i + 1] * base + ord(word[i]) + 1) % size
        before = 0
        for i in range(n):
            for length in (1, 2):
                if i + length <= n and n > length:
                    out.append(((before * 31 + after[i + length] * 17 + i) % size, i + 1, length))
            before = (before * base + ord(word[i]) + 1) % size
        return out

    return words.map(of)


def misread_words(counts: DataFrame) -> DataFrame:
    """``word, meant`` from ``word, n``: words that a scanner made of more frequent ones, by confusions learnt from these counts.

    Two words that differ in one stretch of one or two characters are a pair of a rare and a frequent form. A pair of stretches is a
    confusion if the frequent words that show it are about as many as its rate lets expect of words that have the stretch; likenesses of
    the language cling to a few words. A rare word is misread if some frequent word gives rise to it by a confusion far more
    probably than chance does, chance being what the other pairs show, and in about the expected number.
    A name with a confused sign between letters is misread whether or not its right form is known; ``meant`` is then empty if it isn't.
    """
    rows = counts.where(F.length("word") >= 3)
    found = F.explode(F.pandas_udf(_holes, "array<struct<key: bigint, at: int, size: int>>")("word")).alias("h")
    holes = cut_lineage(rows.where(F.col("word").rlike(r"\p{L}")).select("word", "n", found).select("word", "n", "h.key", F.expr("substring(word, h.at, h.size)").alias("piece")))
    strong = holes.where((F.col("n") >= WORD_MET) & F.col("word").rlike(r"^\p{L}+$"))
    right = strong.select("key", F.col("word").alias("meant"), F.col("n").alias("m"), F.col("piece").alias("stood"))
    ends = (F.substring("piece", 1, 1) != F.substring("stood", 1, 1)) & (F.substring("piece", -1, 1) != F.substring("stood", -1, 1))
    pairs = cut_lineage(holes.join(right, "key").where(ends & (F.col("n") < F.col("m"))).select("word", "n", "meant", "m", F.col("piece").alias("read"), "stood").distinct())

    rare = pairs.where("m >= 10 * n")
    shown = rare.groupBy("read", "stood").agg(F.count_distinct("meant").alias("words"), F.count(F.lit(1)).alias("pairs"), F.sum("n").alias("times"))
    chances = strong.select(F.col("piece").alias("stood"), F.col("n").alias("m")).groupBy("stood", F.floor(F.log2("m")).alias("step")).agg(F.count(F.lit(1)).alias("w"), F.sum("m").alias("m"))
    total = chances.groupBy("stood").agg(F.sum("m").alias("places"), F.sum("w").alias("kinds"))
    rated = shown.join(total, "stood").withColumn("rate", F.col("times") / F.col("places"))
    expected = rated.select("read", "stood", "rate").join(chances, "stood").groupBy("read", "stood").agg(F.sum(F.col("w") * (1 - F.exp(-F.col("rate") * F.col("m") / F.col("w")))).alias("expected"))
    even = (F.col("words") >= CONFUSED_WORDS) & (F.col("words") >= EVENLY * F.col("expected"))
    patterns = cut_lineage(rated.join(expected, ["read", "stood"]).withColumn("even", even))
    chance = patterns.where("not even").agg(((F.coalesce(F.sum("pairs"), F.lit(0)) + 1) / (F.coalesce(F.sum("kinds"), F.lit(0)) + UNSEEN)).alias("c"))
    confusions = patterns.where("even").select("read", "stood", "rate")

    made = pairs.join(confusions, ["read", "stood"]).withColumn("mean", F.col("m") * F.col("rate")).withColumn("c", chance.scalar())
    likely = (1 - F.exp(-F.col("mean")) >= ODDS * F.col("c")) & (F.col("n") <= EXCESS * (F.col("mean") + 1))
    best = made.where(likely).groupBy("word").agg(F.max_by("meant", F.struct("mean", "meant")).alias("meant"))
    signs = confusions.where((F.length("read") == 1) & ~F.col("read").rlike(r"\p{L}")).groupBy(F.col("read").alias("sign")).agg(F.max_by("stood", F.struct("rate", "stood")).alias("stood"))
    odd = rows.where(F.col("word").rlike(r"\p{Ll}[^\p{L}\p{M}'’.,/&+_]+\p{L}")).select("word", F.explode(F.array_distinct(F.regexp_extract_all("word", F.lit(r"(?<=\p{Ll})([^\p{L}\p{M}'’.,/&+_])(?=\p{L})")))).alias("sign"))
    names = odd.join(signs, "sign").select("word").distinct().join(best, "word", "left_anti").select("word", F.lit("").alias("meant"))
    return best.unionByName(names)


def lines_to_repair(pages: DataFrame) -> DataFrame:
    """``page_no, line_no, kind`` of the lines to be repaired; a line can have several kinds. Lines count from 1, split at line feeds.

    - Failed pages, null and blank texts and null page numbers have no lines; a page without paper_id is a paper of its own, and
      its divided words go on within the page only. A null page_index agrees with no page number.
    - Repeated rows count once. Very long pages, lines and words are read whole. The empty table gives no rows; other columns are ignored.
    """
    labelled = labelled_pages(pages)
    state = F.explode(F.filter(F.transform("states", lambda s, i: F.struct((i + 1).cast("int").alias("line_no"), s.alias("state"))), lambda x: x["state"].isin(RUNNING, NUMBER))).alias("x")
    furniture = labelled.select("page_no", state).select("page_no", "x.line_no", F.when(F.col("x.state") == RUNNING, STATES[RUNNING]).otherwise(STATES[NUMBER]).alias("kind"))
    hyphens, words = _settle(labelled)
    return furniture.unionByName(hyphens.select("page_no", "line_no", F.lit("hyphen").alias("kind"))).unionByName(words.select("page_no", "line_no", F.lit("misread").alias("kind")).distinct())


def _settle(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The body lines whose last word was divided (with ``joined``), and those with a misread word (with ``word`` and ``meant``)."""
    taken = _taken_apart(labelled)
    counted = cut_lineage(taken.where("kind in ('part', 'form')").groupBy("kind", "word").agg(F.sum("n").alias("n")))
    counts = counted.where("kind = 'form'").select(F.col("word").alias("form"), "n")
    begun = counts.where(F.col("form").contains("-")).select(F.concat(F.substring_index("form", "-", 1), F.lit("-")).alias("form"), "n").groupBy("form").agg(F.sum("n").alias("n"))

    ends = cut_lineage(divided_words(labelled, taken))
    tail = F.coalesce("tail", F.lit(""))
    first_part = F.lower(F.element_at(F.split("head", "-"), -1))
    asked = {"as_one": F.concat("head", tail), "as_two": F.concat("head", F.lit("-"), tail), "compounding": F.concat(first_part, F.lit("-")), "tail_alone": tail}
    forms = ends.select("page_no", "line_no", F.explode(F.array(*[F.struct(F.lit(k).alias("role"), F.lower(v).alias("form")) for k, v in asked.items()])).alias("f")).select("page_no", "line_no", "f.role", "f.form")
    met = forms.join(counts.unionByName(begun), "form").groupBy("page_no", "line_no").agg(*[F.max(F.when(F.col("role") == k, F.col("n"))).alias(k) for k in asked])
    pairs = ends.join(met, ["page_no", "line_no"], "left").fillna(0, list(asked))
    soft = F.col("mark").isin("¬", "­")
    goes_on = F.col("tail").isNull() | F.col("tail").rlike(r"^\p{Ll}")
    whole = F.when(F.col("as_one") + F.col("as_two") > 0, F.col("as_one") >= F.col("as_two")).otherwise(~((F.col("compounding") > 0) & (F.col("tail_alone") > 0)))
    divided = F.when(soft, True).when(~goes_on, False).when(F.col("tail").isNull(), F.col("compounding") == 0).otherwise(whole)
    hyphens = cut_lineage(pairs.where(divided).select("page_no", "line_no", "head", "tail", "at_page", "at_line", F.concat("head", tail).alias("joined")))

    joints = hyphens.where("tail is not null").select("*", _small(F.col("joined")).alias("word"))
    parts = counted.where("kind = 'part'").select("word", "n").unionByName(joints.groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    wrong = cut_lineage(misread_words(parts.groupBy("word").agg(F.sum("n").alias("n"))))
    in_lines = _lines_with(labelled, wrong)
    rest = hyphens.where("at_page is not null").select(F.col("at_page").alias("page_no"), F.col("at_line").alias("line_no"), F.lit(True).alias("begins"))
    in_lines = in_lines.join(rest, ["page_no", "line_no", "begins"], "left_anti")
    split = joints.join(wrong, "word").withColumn("same", F.expr("substring(meant, 1, length(head)) = substring(word, 1, length(head)) and meant <> ''"))
    of_head = split.where("not same").select("page_no", "line_no", "word", "meant")
    of_tail = split.where("same").select(F.col("at_page").alias("page_no"), F.col("at_line").alias("line_no"), "word", "meant")
    return hyphens, in_lines.select("page_no", "line_no", "word", "meant").unionByName(of_head).unionByName(of_tail)


def _lines_with(labelled: DataFrame, wrong: DataFrame) -> DataFrame:
    """``page_no, line_no, begins, word, meant`` of the misread words of body lines; ``begins`` says of the first word that it is it.

    The words go to the tasks while they are few enough in bytes; else lines and words are joined by a shuffle.
    """
    few = (wrong.agg(F.sum(F.length("word") + F.length("meant") + 100)).first()[0] or 0) <= BROADCAST_BYTES
    known = labelled.sparkSession.sparkContext.broadcast({r["word"]: r["meant"] for r in wrong.collect()}) if few else None

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meant = known.value if known else None
        for batch in batches:
            out = []
            for page, lines, states in zip(*(batch.column(c).to_pylist() for c in ("page_no", "lines", "states"))):
                for i, (line, state) in enumerate(zip(lines, states), 1):
                    if state == BODY:
                        words = [(j, p) for j, w in enumerate(words_of(line)) for p in map(small, w.split("-"))]
                        out += [(page, i, j == 0, w, None) for j, w in words] if meant is None else [(page, i, j == 0, w, meant[w]) for j, w in words if w in meant]
            columns = list(zip(*out)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["page_no", "line_no", "begins", "word", "meant"])

    rows = labelled.select("page_no", "lines", "states").mapInArrow(look, "page_no bigint, line_no int, begins boolean, word string, meant string")
    return rows if few else rows.drop("meant").join(wrong, "word").select("page_no", "line_no", "begins", "word", "meant")


def _small(word: Column) -> Column:
    """``small`` as a column expression."""
    low = F.lower(word)
    return F.when(F.expr("substring({w}, 2) = substring(lower({w}), 2)".format(w="joined")), low).otherwise(word)


#: Pages of a paper that are followed in one window; ranges are then linked with one another.
RANGE = 1000


def paragraphs(pages: DataFrame) -> DataFrame:
    """``paper_id, first_page_no, paragraph, text``: the body of each paper as continuous paragraphs, numbered from 0 on the page they begin.

    Running lines, page numbers, headings and stray figures are left out, divided words are joined and misread words replaced by what they
    were read for. A paragraph ends at a blank line or heading; at a page's end it goes on with the next page if that begins in small
    letters, or if the word at its end was divided. What ``lines_to_repair`` says of nulls, repeats and empty tables holds.
    """
    labelled = labelled_pages(pages)
    hyphens, words = _settle(labelled)
    wrong = words.where("meant <> ''").groupBy("page_no", "line_no").agg(F.collect_set(F.struct("word", "meant")).alias("wrong"))
    lines = labelled.select("page_no", "paper_id", "page_index", F.posexplode(F.arrays_zip("lines", "states")).alias("at", "l")).select("page_no", "paper_id", "page_index", (F.col("at") + 1).alias("line_no"), F.col("l.lines").alias("line"), F.col("l.states").alias("state"))
    order = Window.partitionBy("page_no").orderBy("line_no")
    ended = F.lag(F.col("state").isin(BREAK, HEADING)).over(order)
    kept = lines.where(F.col("state").isin(BODY, BREAK, HEADING)).withColumn("opens", F.coalesce(ended, F.lit(False)) & (F.col("state") == BODY)).where(F.col("state") == BODY)
    local = kept.withColumn("part", F.sum(F.col("opens").cast("int")).over(order)).withColumn("top", F.row_number().over(order) == 1)
    low = F.max(F.when(F.col("top"), F.col("line").rlike(r"^[^\p{L}\p{N}]*\p{Ll}"))).alias("goes_on")
    per_page = local.groupBy("page_no", "paper_id", "page_index").agg(low, F.max("part").alias("parts"), F.min("part").alias("least"))
    heads = hyphens.where(F.col("at_page") != F.col("page_no")).select(F.col("at_page").alias("page_no"), F.lit(True).alias("divided")).distinct()
    per_page = per_page.join(heads, "page_no", "left").withColumn("goes_on", F.col("goes_on") | F.coalesce("divided", F.lit(False)))
    before = per_page.where("paper_id is not null").select("paper_id", (F.col("page_index") + 1).alias("page_index"), F.lit(True).alias("has_before")).distinct()
    per_page = cut_lineage(per_page.join(before, ["paper_id", "page_index"], "left").withColumn("follows", F.col("goes_on") & F.coalesce("has_before", F.lit(False))).withColumn("range", F.floor(F.col("page_index") / RANGE)))
    begins = F.when(~F.col("follows") | (F.col("parts") > F.col("least")), F.struct("page_no", "parts"))
    chain = Window.partitionBy("paper_id", "range", F.when(F.col("paper_id").isNull(), F.col("page_no"))).orderBy("page_index", "page_no")
    ranges = per_page.where("paper_id is not null").groupBy("paper_id", "range").agg(F.max_by(begins, F.when(begins.isNotNull(), F.struct("page_index", "page_no"))).alias("last"))
    carried = ranges.withColumn("carried", F.last("last", True).over(Window.partitionBy("paper_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))).where("carried is not null").select("paper_id", "range", "carried")
    linked = per_page.withColumn("open", F.last(begins, True).over(chain.rowsBetween(Window.unboundedPreceding, -1))).join(carried, ["paper_id", "range"], "left")
    linked = linked.select("page_no", "follows", F.coalesce("open", "carried").alias("open"), F.col("least").alias("first_part"))
    named = local.join(linked, "page_no").withColumn("joins", F.col("follows") & (F.col("part") == F.col("first_part")) & F.col("open").isNotNull())
    named = named.withColumn("first_page_no", F.when(F.col("joins"), F.col("open.page_no")).otherwise(F.col("page_no"))).withColumn("paragraph", F.when(F.col("joins"), F.col("open.parts")).otherwise(F.col("part")))
    repaired = named.join(hyphens.select("page_no", "line_no", F.lit(True).alias("cut")), ["page_no", "line_no"], "left").join(wrong, ["page_no", "line_no"], "left")

    def capital(x: Column) -> Column:
        return F.concat(F.upper(F.substring(x, 1, 1)), F.substr(x, F.lit(2)))

    mended = F.aggregate(F.coalesce("wrong", F.array().cast("array<struct<word:string,meant:string>>")), F.col("line"), lambda t, x: F.replace(F.replace(t, x["word"], x["meant"]), capital(x["word"]), capital(x["meant"])))
    ends_open = F.col("line").rlike(rf"\w[{MARKS}]\s*$")
    text = F.when(F.coalesce("cut", F.lit(False)), F.regexp_replace(mended, rf"[{MARKS}]\s*$", "")).when(ends_open, mended).otherwise(F.concat(mended, F.lit(" ")))
    pieces = repaired.select("paper_id", "first_page_no", "paragraph", "page_index", "page_no", "line_no", text.alias("t"))
    whole = pieces.groupBy("paper_id", "first_page_no", "paragraph").agg(F.array_sort(F.collect_list(F.struct("page_index", "page_no", "line_no", "t"))).alias("all"))
    return whole.select("paper_id", "first_page_no", "paragraph", F.trim(F.array_join(F.transform("all", lambda x: x["t"]), "")).alias("text"))
