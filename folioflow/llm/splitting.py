"""Splitting oversized texts at natural boundaries (problem 5).

Method: content-defined chunking. A rolling hash over the characters marks landmarks; the next cut is the first landmark that keeps the piece
within its minimum and maximum, moved to the nearest natural boundary. A cut depends only on the cut before and the text after it, so after
an edit the cuts fall together again at a landmark and only pieces near the edit change.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.functions.lookup import fresh_names
from folioflow.session import cut_lineage

# Every character that is white space by its Unicode property or by convention.
WHITE = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: Natural boundaries, the strongest first; a cut falls at the end of a match.
BOUNDARIES = (
    re.compile(r"\n[ \t]*\n\s*"),
    re.compile(r"\n\s*"),
    re.compile(r"[.!?][\"')\]]*\s+|[。！？][”’）」』]*\s*"),
    re.compile(r"[;:,][\"')\]]*\s+|[，；：、]\s*"),
    re.compile(r"\s+"),
)
JOINING = re.compile("[̀-ͯ҃-҉֑-ֽً-ٟऀ-ःऺ-ॏัิ-ฺ᪰-᫿᷀-᷿‌‍⃐-⃿︀-️︠-︯\U0001f3fb-\U0001f3ff\U000e0020-\U000e007f]")


@dataclass(frozen=True)
class Pieces:
    """Sizes in characters (code points). Every piece but the first repeats between 1 and ``overlap`` characters of the one before."""

    limit: int = 3200
    overlap: int = 200
    least: int = 1200
    window: int = 32
    landmark_every: int = 512
    reach: int = 400

    def __post_init__(self):
        if not (1 <= self.overlap < self.limit and 1 <= self.least <= self.limit - self.overlap and self.window >= 1 and self.landmark_every >= 1 and self.reach >= 0):
            raise ValueError("sizes must allow pieces within the limit")


def landmarks(text: str, window: int, every: int) -> np.ndarray:
    """Positions (after the hashed window) at which the rolling hash of the last ``window`` characters is one in ``every``."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    if len(codes) < window:
        return np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        mixed = (codes + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * _powers(len(codes)), dtype=np.uint64)])
        rolled = (sums[window:] - sums[:-window]) * _powers(len(codes), inverse=True)[: len(codes) - window + 1]
        rolled ^= rolled >> np.uint64(31)
        rolled *= np.uint64(0xBF58476D1CE4E5B9)
        rolled ^= rolled >> np.uint64(32)
    return np.flatnonzero(rolled % np.uint64(every) == 0) + window


BASE = 0x5851F42D4C957F2D


def _powers(n: int, inverse: bool = False) -> np.ndarray:
    """1, b, b², ... modulo 2^64 for the odd base or its inverse, so that a window's hash doesn't depend on its place."""
    base, out, size = (pow(BASE, -1, 1 << 64) if inverse else BASE), np.ones(1, np.uint64), 1
    with np.errstate(over="ignore"):
        while size < n:
            out = np.concatenate([out, out * np.uint64(pow(base, size, 1 << 64))])
            size *= 2
    return out[:n]


def _nearest(text: str, low: int, high: int, at: int) -> int:
    """The strongest kind of boundary in [low, high] decides; of its ends the one nearest to ``at``, the earlier on a tie."""
    for kind in BOUNDARIES:
        ends = [m.end() for m in kind.finditer(text, max(0, low - 1), high) if low <= m.end() <= high]
        if ends:
            return min(ends, key=lambda e: (abs(e - at), e))
    cut = at
    while cut > low and (JOINING.match(text, cut) or text[cut - 1] == "‍" or _paired_flag(text, cut)):
        cut -= 1
    return cut if cut > low else at


def _paired_flag(text: str, cut: int) -> bool:
    """Whether a cut would part the two letters of a flag."""
    start = cut
    while start > 0 and "\U0001f1e6" <= text[start - 1] <= "\U0001f1ff" and cut - start < 64:
        start -= 1
    return cut < len(text) and "\U0001f1e6" <= text[cut] <= "\U0001f1ff" and (cut - start) % 2 == 1


def piece_bounds(text: str, sizes: Pieces) -> list[tuple[int, int]]:
    """(start, end) of the pieces; the whole text is one piece while it is within the limit."""
    if len(text) <= sizes.limit:
        return [(0, len(text))]
    marks, most = landmarks(text, sizes.window, sizes.landmark_every), sizes.limit - sizes.overlap
    bounds, begin = [(0, 0)], 0
    while len(text) - begin > most:
        low, high = begin + sizes.least, begin + most
        i = np.searchsorted(marks, low)
        at = int(marks[i]) if i < len(marks) and marks[i] <= high else high
        cut = _nearest(text, max(low, at - sizes.reach), min(high, at + sizes.reach), at)
        bounds[-1] = (bounds[-1][0], cut)
        reach = min(sizes.overlap, cut - begin)
        bounds.append((_nearest(text, cut - reach, cut - 1, cut - reach), cut))
        begin = cut
    bounds[-1] = (bounds[-1][0], len(text))
    return bounds


def stripped(text: Column) -> Column:
    """The text without the white space around it."""
    return F.btrim(text, F.lit(WHITE))


def split_texts(df: DataFrame, text: str, sizes: Pieces = Pieces()) -> DataFrame:
    """Every row once for each piece of its text, with ``piece_index``, ``piece_count``, ``char_start``, ``char_end`` and ``piece``.

    Offsets count characters of the text without the white space around it. All columns of the input but the text stay (a section path
    goes with every piece); one whose name clashes with a new column, regardless of case, keeps its name and the new column gets a longer
    one, by underscores.

    - A text within the limit is one piece; null and blank texts have no piece and leave no row.
    - A text without any boundary is cut at landmarks, or at the most where there is none, never inside a joined character.
    - Equal texts are cut alike, repeated rows are rows like any other, and the empty table gives no rows.
    """
    others = [c for c in df.columns if c != text]
    names = fresh_names(df.select(*[F.col(f"`{c}`") for c in others]), "piece_index", "piece_count", "char_start", "char_end", "piece")
    kind = T.ArrayType(T.StructType([T.StructField("s", T.IntegerType()), T.StructField("e", T.IntegerType())]))

    @F.pandas_udf(kind)
    def bounds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([[{"s": s, "e": e} for s, e in piece_bounds(t, sizes)] for t in batch], dtype=object)

    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("other"), stripped(F.col(f"`{text}`")).alias("body")).where("body <> ''")
    whole = F.array(F.struct(F.lit(0).alias("s"), F.length("body").alias("e"))).cast("array<struct<s:int,e:int>>")
    short = rows.where(F.length("body") <= sizes.limit).withColumn("cuts", whole)
    cut = rows.where(F.length("body") > sizes.limit).withColumn("cuts", bounds("body"))
    each = short.unionByName(cut).select("other", "body", F.size("cuts").alias("n"), F.posexplode("cuts").alias("i", "cut"))
    return each.select(
        *[F.col("other").getField(c).alias(c) for c in others],
        *[x.alias(n) for x, n in zip((F.col("i"), F.col("n"), F.col("cut.s"), F.col("cut.e"), F.substring("body", F.col("cut.s") + 1, F.col("cut.e") - F.col("cut.s"))), names)],
    )


def soundly_split(blocks: DataFrame, audit: DataFrame, sizes: Pieces = Pieces()) -> DataFrame:
    """``block_no`` of the blocks for which ``audit`` holds good pieces. ``blocks`` has ``block_no`` (unique) and ``characters``.

    Pieces of one block, model and count belong together; repeated rows count once. They are good if the indexes are 0 to the count less 1,
    each once, the first starts at 0, the last ends with the text, none is longer than the limit or empty, and each shares 1 to
    ``overlap`` characters with the one before. Pieces are compared with their neighbours by a join on the index, so a block with very many
    rows isn't gathered in one task.
    """
    run = ["block_no", "embedding_model", "subchunk_count"]
    rows = audit.select(*run, F.col("subchunk_index").alias("i"), F.col("char_start").alias("s"), F.col("char_end").alias("e")).where("block_no is not null")
    rows = rows.withColumn("embedding_model", F.coalesce("embedding_model", F.lit(""))).distinct()
    before = rows.select(*run, (F.col("i") + 1).alias("i"), F.col("s").alias("bs"), F.col("e").alias("be"))
    shared = F.least("be", "e") - F.greatest("bs", "s")
    linked = rows.join(before, [*run, "i"], "left").withColumn("linked", F.coalesce(shared.between(1, sizes.overlap), F.lit(False)))
    fine = (F.col("e") > F.col("s")) & (F.col("e") - F.col("s") <= sizes.limit)
    checked = linked.groupBy(*run).agg(
        F.count(F.lit(1)).alias("n"), F.min("i").alias("low"), F.max("i").alias("high"), F.count_if("linked").alias("links"), F.count_if(fine).alias("fine"),
        F.min(F.when(F.col("i") == 0, F.col("s"))).alias("start"), F.max(F.when(F.col("i") == F.col("subchunk_count") - 1, F.col("e"))).alias("end"),
    )
    n = F.col("subchunk_count")
    whole = checked.where((F.col("n") == n) & (F.col("low") == 0) & (F.col("high") == n - 1) & (F.col("links") == n - 1) & (F.col("fine") == n) & (F.col("start") == 0))
    return whole.select("block_no", "end").join(blocks, "block_no").where(F.col("end") == F.col("characters")).select("block_no").distinct()


def pieces_to_make(blocks: DataFrame, audit: DataFrame, sizes: Pieces = Pieces()) -> DataFrame:
    """The pieces of all blocks over the limit for which ``audit`` holds no good pieces; see ``split_texts`` and ``soundly_split``.

    Repeated blocks count once; blocks without a number are left out.
    """
    long = cut_lineage(blocks.where(F.col("block_no").isNotNull() & (F.length(stripped(F.col("text"))) > sizes.limit)).dropDuplicates(["block_no"]))
    lengths = long.select("block_no", F.length(stripped(F.col("text"))).alias("characters"))
    open_ = long.join(soundly_split(lengths, audit, sizes), "block_no", "left_anti")
    return split_texts(open_, "text", sizes)
