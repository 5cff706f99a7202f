"""Text cut off by field limits (problem 9).

Method: a backward character n-gram model. For the final context of a text, read backwards from its end, the model compares how often that
context ends a text with how often the text goes on after it, over all positions of the whole corpus, interpolated from short to long
contexts. The log-odds are held against a threshold per language and column, which lies in the valley between the two groups that the
scores of the language form; what a language has too few texts to show is filled in from all texts. A context is read within its line; how the line begins (a keyword list, a reference, a table row) is part of
it, so that ends without a full stop are learnt as well.

Counting is by distinct word: a task counts its words, the words' counts are summed over the corpus, and only then do contexts arise.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.session import cut_lineage

#: Longest context in characters, and the same for writing without blanks.
ORDER, ORDER_DENSE = 8, 3
#: Weight of the shorter context in the interpolation; a longer context takes part when it was met this often and at most half as often
#: as the last one that took part, so that the same few occurrences aren't counted as evidence again and again.
WEIGHT, MET = 4.0, 100
#: Words are shorter than this; longer stretches are counted by their windows of ``ORDER_DENSE`` characters.
WORD = 40
#: A word's first characters, up to this many less one, are counted together with as many characters before the word.
SHORT = 4
#: Distinct words a task keeps before it passes on what it has counted.
WORDS_KEPT = 1_000_000
#: Bins of log-odds a unit, texts of the whole corpus that are added to a language's own, and how much higher than a valley its lower bank must be.
BINS, BORROWED, BANK = 4, 200, 2.0

# Marks that say that more followed, and what transfers put behind a text.
MARK = re.compile(r"(?:…|\.{3}|(?:read|show|see) (?:more|full text)|continue reading|�)$", re.IGNORECASE)
IN_BRACKETS = re.compile(r"\.{2,}|…|truncated|cut|continued|shortened|snip|more", re.IGNORECASE)
TRAILER = re.compile(r"(?:\[end of (?:page|text|document|file)\]|</?\w{1,10}/?>|&nbsp;)$", re.IGNORECASE)
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u200b\u2028\u2029\u202f\u205f\u3000\ufeff\x00"
#: No mark or trailer of the two patterns above is longer than this; those of any length are looked for without a pattern.
LONGEST = 32
TAGGED = re.compile(r"[^\W\d_][^:\n]{0,22}:|\[\d+\]|\d{1,3}[.)]|[^\w\s]{1,3}")
DIGIT = re.compile(r"\d")


def line_tag(line: str) -> str:
    """How a line begins where that says what it is: a short heading with a colon, a number in brackets, a sign. Empty for prose."""
    found = TAGGED.match(line)
    return DIGIT.sub("0", found.group()) if found else ""


def ending(text: str | None) -> tuple[str, str, bool] | None:
    """(tag of the last line, its final context of up to ``ORDER`` characters, whether a mark says that more followed); None for a blank text."""
    end = (text or "").rstrip(BLANKS)
    while end:
        if (found := TRAILER.search(end[-LONGEST:])) and end[-1] in "]>;":
            end = end[: len(end) - len(found.group())].rstrip(BLANKS)
        elif end[-1] in "]}" and (bare := end.rstrip("]}"))[-1:] in ("'", '"'):
            end = bare[:-1].rstrip(BLANKS)
        else:
            break
    if not end:
        return None
    if mark := MARK.search(end[-LONGEST:]):
        return "", end[: len(end) - len(mark.group())].rstrip(".")[-ORDER:], True
    if end[-1] in "])" and (at := max(end.rfind("["), end.rfind("("))) >= 0 and IN_BRACKETS.fullmatch(end[at + 1 : -1].strip()):
        return "", end[:at][-ORDER:], True
    head, _, line = end.rpartition("\n")
    inside = head.count("```") % 2 == 1
    before, _, word = line.rpartition(" ")
    context = (" " + word)[-ORDER:] if len(word) >= SHORT else before[-SHORT:] + " " + word
    if len(word) >= WORD or not word[-1].isascii():
        context = context[-ORDER_DENSE:]
    return ("```" if inside and not line.startswith("```") else line_tag(line)), DIGIT.sub("0", context), False


def _count(texts: Iterator[str | None], words: dict[str, Counter], heads: dict[str, Counter]) -> None:
    for text in texts:
        if not text:
            continue
        fenced, inside = "```" in text, False
        for line in text.split("\n"):
            if not line:
                continue
            tag = "```" if inside and not line.startswith("```") else line_tag(line)
            parts = line.split(" ")
            words[tag].update(parts)
            heads[tag].update([p[-SHORT:] + " " + t[: SHORT - 1] for p, t in zip(["", *parts], parts)])
            if fenced and line.count("```") % 2:
                inside = not inside


def _rows(words: dict[str, Counter], heads: dict[str, Counter]) -> list[tuple[str, str, int, int]]:
    """(tag, stretch, first position that counts, times): positions before it are only context."""
    total: Counter = Counter()
    for tag, counter in words.items():
        for word, n in counter.items():
            if len(word) >= WORD:
                word = DIGIT.sub("0", " " + word)
                for i in range(SHORT + 1, len(word) + 1):
                    total[tag, word[i - ORDER_DENSE : i], ORDER_DENSE] += n
            elif len(word) >= SHORT:
                total[tag, DIGIT.sub("0", " " + word), SHORT + 1] += n
    for tag, counter in heads.items():
        for pair, n in counter.items():
            if pair[-1] != " ":
                total[tag, DIGIT.sub("0", pair), pair.rindex(" ") + 2] += n
    return [(*k, n) for k, n in total.items()]


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """``tag, stretch, start, n`` over all texts of the table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, heads = defaultdict(Counter), defaultdict(Counter)

        def passed() -> pa.RecordBatch:
            rows = _rows(words, heads)
            words.clear()
            heads.clear()
            columns = list(zip(*rows)) or [(), (), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int32(), pa.int64()))], names=["tag", "stretch", "start", "n"])

        for batch in batches:
            _count(batch.column(0).to_pylist(), words, heads)
            if sum(map(len, [*words.values(), *heads.values()])) > WORDS_KEPT:
                yield passed()
        yield passed()

    rows = df.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, "tag string, stretch string, start int, n bigint")
    return rows.groupBy("tag", "stretch", "start").agg(F.sum("n").alias("n"))


def final_contexts(df: DataFrame, text: str, key: Column, language: Column, source: Column) -> DataFrame:
    """``key, language, source, tag, context, marked`` of every row; tag and context are null for blank texts."""

    @F.arrow_udf("struct<tag: string, context: string, marked: boolean>")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("tag", pa.string()), ("context", pa.string()), ("marked", pa.bool_())])
        for batch in batches:
            ends = [ending(t) for t in batch.to_pylist()]
            yield pa.array([None if e is None else dict(zip(("tag", "context", "marked"), e)) for e in ends], kind)

    return df.select(key.alias("key"), language.alias("language"), source.alias("source"), read(F.col(f"`{text}`")).alias("e")).select("key", "language", "source", "e.tag", "e.context", "e.marked")


def _suffixes(context: Column) -> Column:
    """The context's last 1, 2, ... characters."""
    return F.transform(F.sequence(F.lit(1), F.length(context)), lambda k: F.substring(context, -k, k))


def end_log_odds(ends: DataFrame, counts: DataFrame) -> DataFrame:
    """``tag, context, ended, score``: for each distinct final context how many texts end in it and the log-odds of an end there.

    The text that is judged doesn't count as evidence for its own end.
    """
    finals = ends.where(F.col("context").isNotNull() & ~F.col("marked")).groupBy("tag", "context").agg(F.count(F.lit(1)).alias("ended"))
    finals = cut_lineage(finals)
    orders = finals.select("tag", "context", "ended", F.explode(_suffixes(F.col("context"))).alias("c"))
    ended = orders.groupBy("tag", "c").agg(F.sum("ended").alias("ended_here"))
    places = counts.select("tag", "stretch", "n", F.explode(F.sequence("start", F.length("stretch"))).alias("i"))
    windows = places.select("tag", "n", F.expr(f"substring(stretch, greatest(1, i - {ORDER - 1}), least(i, {ORDER}))").alias("window")).groupBy("tag", "window").agg(F.sum("n").alias("n"))
    seen = windows.select("tag", "n", F.explode(_suffixes(F.col("window"))).alias("c")).groupBy("tag", "c").agg(F.sum("n").alias("met"))
    known = cut_lineage(ended.join(seen, ["tag", "c"], "left").select("tag", "c", "ended_here", F.greatest(F.coalesce("met", F.lit(0)), F.col("ended_here")).alias("met")))
    together = orders.join(known, ["tag", "c"]).groupBy("tag", "context").agg(F.first("ended").alias("ended"), F.array_sort(F.collect_list(F.struct(F.length("c").alias("k"), "ended_here", "met"))).alias("all"))
    everywhere = known.where(F.length("c") == 1).agg((F.sum("ended_here") / F.sum("met")).alias("q"))
    together = together.withColumn("everywhere", F.coalesce(everywhere.scalar(), F.lit(0.0)).cast("double"))
    start = F.struct(F.col("everywhere").alias("q"), F.lit(1 << 62).alias("met"))
    share = F.aggregate(
        "all",
        start,
        lambda a, x: F.when(
            (x["k"] == 1) | ((x["met"] >= MET) & (x["met"] * 2 <= a["met"])),
            F.struct(((x["ended_here"] - 1 + WEIGHT * a["q"]) / (x["met"] - 1 + WEIGHT)).alias("q"), x["met"].alias("met")),
        ).otherwise(a),
        lambda a: a["q"],
    )
    return together.select("tag", "context", "ended", F.log(F.greatest(share, F.lit(1e-300)) / (1 - F.least(share, F.lit(0.999999)))).alias("score"))


def valley(counts: dict[int, float]) -> float | None:
    """The bin between the main group, that of most texts, and a group below it: where the higher place below stands out most; the middle of the best.

    None if there is no group below. Heights are sums over a unit of log-odds, each with one text more, so that a few texts make no group.
    """
    if not counts:
        return None
    low, high = min(counts) - BINS, max(counts) + BINS
    bins = [float(counts.get(b, 0.0)) for b in range(low, high + 1)]
    smooth = [1.0 + sum(bins[max(0, i - BINS // 2) : i + BINS // 2 + 1]) for i in range(len(bins))]
    main = smooth.index(max(smooth))
    stand = [a / h for a, h in zip(accumulate(smooth[: main + 1], max), smooth)]
    best = max(stand)
    if best < BANK:
        return None
    at = [i for i, x in enumerate(stand) if x > best * 0.999]
    return low + at[len(at) // 2]


def thresholds(scored: DataFrame) -> tuple[DataFrame, float]:
    """``language, threshold`` of every language, and the threshold of all texts, from ``language, score``.

    A language's own texts are joined by ``BORROWED`` that are spread as those of all languages are, so a rare language comes near
    the threshold of all and a frequent one has its own, without a size at which that changes. Without a second group nothing is below.
    """
    bins = scored.where("score is not null").groupBy("language", F.round(F.col("score") * BINS).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    bins = cut_lineage(bins)
    every = {r["bin"]: r["n"] for r in bins.groupBy("bin").agg(F.sum("n").alias("n")).collect()}
    total = sum(every.values())
    pooled = valley(every)

    def own(rows: pd.DataFrame) -> pd.DataFrame:
        counts = {b: BORROWED * n / total for b, n in every.items()}
        for b, n in zip(rows["bin"], rows["n"]):
            counts[b] += n
        at = valley(counts)
        at = pooled if at is None else at
        return pd.DataFrame({"language": rows["language"].iloc[:1], "threshold": [float("-inf") if at is None else at / BINS]})

    per = bins.where("language is not null").groupBy("language").applyInPandas(own, "language string, threshold double")
    return per, float("-inf") if pooled is None else pooled / BINS


def cut_texts(df: DataFrame, text: str, key: str, language: Column, source: Column) -> DataFrame:
    """``key``, ``source``, ``language``, ``score``, ``truncated`` for every row: whether the text lacks its end.

    ``score`` is the log-odds of an end in the final context, null where a mark says that more followed (truncated) and for null, empty
    and blank texts (not truncated). White space and what a transfer put behind the text are passed over. Null languages take the threshold
    of all texts; null sources and keys are kept. Repeated rows and texts are judged alike, each row for itself, and each is evidence. The
    empty table gives no rows; other columns are ignored. Very long texts are read whole.
    """
    ends = cut_lineage(final_contexts(df, text, F.col(f"`{key}`"), language, source))
    judged = F.col("context").isNotNull() & ~F.col("marked")
    scores = end_log_odds(ends, word_counts(df, text))
    scored = cut_lineage(ends.where(judged).join(scores.select("tag", "context", "score"), ["tag", "context"]).select("key", "source", "language", "score"))
    own, general = thresholds(scored)
    limit = F.coalesce("threshold", F.lit(general))
    found = scored.join(own, "language", "left").select("key", "source", "language", "score", (F.col("score") < limit).alias("truncated"))
    rest = ends.where(~F.coalesce(judged, F.lit(False))).select("key", "source", "language", F.lit(None).cast("double").alias("score"), F.coalesce("marked", F.lit(False)).alias("truncated"))
    return found.unionByName(rest).withColumnRenamed("key", key)


def truncation_by_source(judged: DataFrame) -> DataFrame:
    """``source, texts, truncated, share`` from the rows of ``cut_texts``; a null source is one of its own."""
    counts = judged.groupBy("source").agg(F.count(F.lit(1)).alias("texts"), F.count_if("truncated").alias("truncated"))
    return counts.withColumn("share", F.round(F.col("truncated") / F.col("texts"), 6))
