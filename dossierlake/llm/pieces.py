"""Oversized texts cut into pieces under a limit, at natural boundaries, with an overlap.

Every place between two characters has a boundary strength: after a paragraph, a line, a sentence, a clause, a word, or
none. A sparse table over the strengths of a text answers in constant time which is the strongest cut in the window a
piece may end in, ties to the right; the next piece begins `overlap` characters before the cut. The table is built
over the candidate boundaries of one text at a time, so memory follows the longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

LIMIT, OVERLAP = 4000, 200
#: Strengths, strongest first; a cut lies behind the match.
BOUNDARIES = (
    (5, regex.compile(r"(?:\r\n|\n|\r)[^\S\r\n]*(?:\r\n|\n|\r)\s*|\f\s*|\u2029\s*")),
    (4, regex.compile(r"(?<![.!?。]\S{0,3}[a-z]\.)[.!?…。！？]+[\"'”’»)\]]*\s+(?=[\p{Lu}\p{N}\"'“‘«¿¡(\[])|[。！？]")),
    (3, regex.compile(r"\r\n|\n|\r")),
    (2, regex.compile(r"[;:,]\s+|\s[–—-]\s+|[，；、]")),
    (1, regex.compile(r"\s+")),
)
MARKS = regex.compile(r"[\p{M}\u200d\ufe0f\U0001F3FB-\U0001F3FF]")


class RangeMax:
    """Sparse table of the index of the greatest value of a range, the rightmost of equals."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.levels = [np.arange(len(values))]
        width = 1
        while 2 * width <= len(values):
            a, b = self.levels[-1][:-width], self.levels[-1][width:]
            self.levels.append(np.where(values[b] >= values[a], b, a))
            width *= 2

    def query(self, lo: int, hi: int) -> int:
        """The index for lo <= i < hi; the range must not be empty."""
        k = (hi - lo).bit_length() - 1
        a, b = self.levels[k][lo], self.levels[k][hi - (1 << k)]
        return int(b if self.values[b] >= self.values[a] else a)


def boundaries(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places of the text where it may be cut well, ascending, and their strengths."""
    strength: dict[int, int] = {}
    for level, pattern in reversed(BOUNDARIES):
        for m in pattern.finditer(text):
            strength[m.end()] = level
    at = np.array(sorted(strength), dtype=np.int64)
    return at, np.array([strength[i] for i in at.tolist()], dtype=np.int8)


def cut(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """(begin, end) of each piece; one piece for a text within the limit, none for an empty one."""
    n = len(text)
    if n <= limit:
        return [(0, n)] if n else []
    at, strength = boundaries(text)
    best = RangeMax(strength) if len(at) else None
    spans, begin = [], 0
    while n - begin > limit:
        least, most = begin + max(overlap + 1, limit // 2), begin + limit
        lo, hi = (int(x) for x in np.searchsorted(at, (least, most + 1)))
        end = int(at[best.query(lo, hi)]) if best and lo < hi else most
        if end == most and not (lo < hi and at[hi - 1] == most):
            while end > least and MARKS.match(text, end):  # a character stays with its marks
                end -= 1
        spans.append((begin, end))
        begin = end - overlap
    return [*spans, (begin, n)]


PIECES = T.ArrayType(T.StructType([T.StructField("begin_at", T.IntegerType()), T.StructField("piece", T.StringType())]))


def cut_texts(df: DataFrame, ids: list[str], text: str, limit: int = LIMIT, overlap: int = OVERLAP, oversized_only: bool = True) -> DataFrame:
    """(ids…, piece_no, begin_at, n_chars, piece): the pieces of every text over the limit, in order, both numbers from 1.

    Lengths are code points as stored. Consecutive pieces share `overlap` characters, and the pieces without them are
    the text again. Null and empty texts give no rows; with oversized_only, neither do texts within the limit. Repeated
    ids and texts stay; a text without any boundary is cut at the limit.
    """
    if not 0 <= overlap < limit // 2:
        raise ValueError("the overlap must be less than half the limit")

    @F.pandas_udf(PIECES)
    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([[{"begin_at": a + 1, "piece": t[a:b]} for a, b in cut(t, limit, overlap)] for t in batch])

    picked = df.select(*ids, F.col(text).alias("text")).where(F.char_length("text") > (limit if oversized_only else 0))
    rows = picked.select(*ids, F.posexplode(pieces("text")).alias("no", "p"))
    return rows.select(*ids, (F.col("no") + 1).cast("int").alias("piece_no"), F.col("p.begin_at").alias("begin_at"), F.char_length("p.piece").alias("n_chars"), F.col("p.piece").alias("piece"))


def sides(df: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """(id, side, text): several text columns as rows."""
    each: Column = F.explode(F.array(*(F.struct(F.lit(c).alias("side"), F.col(c).alias("text")) for c in columns)))
    return df.select(id_col, each.alias("x")).select(id_col, "x.side", "x.text")
