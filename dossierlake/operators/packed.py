"""Cells that pack several values, split into one value per row.

A cell becomes tokens (a run of ordinary words, a number, a run of blanks, a line break, or one character of
punctuation), and its skeleton has one mask character per token. How a cell splits depends only on its skeleton, so the
rules are worked out once per distinct skeleton, in Arrow batches, and joined back; values are then cut out by token
positions with array functions. The join broadcasts the rules only while their measured size is under a bound.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from dossierlake.functions.text import squash
from dossierlake.session import cut_lineage, task_slots, write_shared

#: Cells that say there is nothing.
NOTHING = ("", "[]", "[ ]", "{}", "()", "nan", "none", "n/a", "na", "null", "-", "--", "nil", "n.a.")
ROMAN = r"(?:i{1,3}|iv|vi{0,3}|ix|xi{0,3}|xiv|xv)"
PUNCTUATION = r"\"'“”„‘’«»,;|/\[\](){}•●▪◦‣·*\-–—:.\\、，；"
WORD = rf"[^\s0-9{PUNCTUATION}]"
TOKEN = rf"(?U)(?:\\u[0-9a-fA-F]{{4}})+|\\.|\r\n|[\n\r]|\t|{WORD}+(?: {WORD}+)*|[0-9]+|[^\S\n\r\t]+|(?s:.)"
QUOTES = {'"': '"', "“": "”", "„": "“”", "«": "»", "‘": "’", "'": "'"}
BULLETS = "•●▪◦‣·*-–—"
#: Rules of up to this many bytes are broadcast; beyond it, they are joined by a shuffle.
BROADCAST_BYTES = 4 << 20
RULE = T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("size", T.IntegerType()), T.StructField("quoted", T.BooleanType())]))


def mask(token: Column) -> Column:
    return (
        F.when(token.rlike(r"^\\"), "e").when(token.rlike(r"^[\n\r]"), "n").when(token == "\t", "t")
        .when(token.rlike(r"(?U)^\s"), " ").when(token.rlike(r"^[0-9]"), "9").when(token.rlike(rf"^(?i:{ROMAN})$"), "r")
        .when(token.rlike(rf"(?U)^{WORD}"), "a").otherwise(token)
    )


MARK = re.compile(r"\((9|r|a)\)[ ]?|(9|r)\)[ ]?|9\.[ ]")
LIST_MARK = re.compile(rf"(?:{MARK.pattern})|[{re.escape(BULLETS)}] ?")


def _quoted(s: str, i: int, stop: int) -> int | None:
    """The index of the closing quote of the quoted text opened at i, if a separator, white space or the end follows."""
    close, j = QUOTES[s[i]], i + 1
    while j < stop:
        if s[j] in close:
            if s[j] == '"' and j + 1 < stop and s[j + 1] == '"':
                j += 2
                continue
            rest = s[j + 1 : stop].lstrip(" t")
            if not rest or rest[0] in ",;|n、，；/" or rest[0] in BULLETS or rest[0] == "]" or (s[j + 1] in " t" and LIST_MARK.match(rest)):
                return j
            if s[i] not in "'‘":
                return j
        j += 1
    return None


def _fields(s: str, start: int, stop: int, separators: str, slash: bool) -> list[tuple[int, int]]:
    """The spans between separators outside quotes and brackets."""
    out, i, begin, fresh, depth = [], start, start, True, 0
    last = {"(": s.rfind(")", start, stop), "[": s.rfind("]", start, stop), "{": s.rfind("}", start, stop)}
    while i < stop:
        c = s[i]
        if fresh and c in QUOTES and (close := _quoted(s, i, stop)) is not None:
            i, fresh = close + 1, False
            continue
        if c in "([{" and (depth or last[c] > i):
            depth += 1
        elif c in ")]}" and depth:
            depth -= 1
        elif (c == "n" and "n" in separators) or (not depth and (c in separators or (slash and c == "/" and i > start and s[i - 1] in " nt" and i + 1 < stop and s[i + 1] in " nt"))):
            out.append((begin, i))
            begin, fresh, depth = i + 1, True, 0
            i += 1
            continue
        if c not in " t":
            fresh = False
        i += 1
    return [*out, (begin, stop)]


def _marks(s: str, start: int, stop: int) -> list[tuple[int, int]] | None:
    """The spans behind list marks, if the cell begins with one."""
    first = LIST_MARK.match(s, start, stop)
    if not first:
        return None
    if s[start] in BULLETS:
        mark = re.compile(re.escape(s[start]) + (" " if first[0].endswith(" ") else ""))
    elif s[start] == "(":
        mark = re.compile(r"\((?:9|r|a)\)")
    else:
        mark = re.compile(r"(?:9|r)\)") if ")" in first[0] else re.compile(r"9\. ")
    spans, i, begin, fresh = [], start, None, True
    while i < stop:
        m = mark.match(s, i, stop) if fresh else None
        if m:
            if begin is not None:
                spans.append((begin, i))
            i = begin = m.end()
            fresh = False
            while i < stop and s[i] == " ":
                i += 1
            if i < stop and s[i] in QUOTES and (close := _quoted(s, i, stop)) is not None:
                i = close + 1
            continue
        if s[i] == "n" and begin is not None:
            spans.append((begin, i))
            begin = i + 1
        fresh = s[i] in " nt"
        i += 1
    return [*spans, (begin, stop)]


def resolve(s: str) -> list[tuple[int, int, bool]]:
    """(first token from 1, tokens, whether quoted) of each value of a cell with skeleton s."""
    start, stop = 0, len(s)
    while start < stop and s[start] in " nt":
        start += 1
    while stop > start and s[stop - 1] in " nt":
        stop -= 1
    if start == stop:
        return []
    if s[start] == "[" and s[stop - 1] == "]":
        spans, trailing = _fields(s, start + 1, stop - 1, ",", False), ""
    elif spans := _marks(s, start, stop):
        trailing = ",;|、，；/"
    else:
        spans, trailing = _fields(s, start, stop, ",;|nt、，；", True), ""
    out = []
    for a, b in spans:
        while a < b and s[a] in " nt":
            a += 1
        while b > a and s[b - 1] in " nt" + trailing:
            b -= 1
        if not trailing and (m := LIST_MARK.match(s, a, b)) and m[0].endswith(" "):
            a = m.end()
        quoted = b - a >= 2 and s[a] in QUOTES and _quoted(s, a, b) == b - 1
        if quoted:
            a, b = a + 1, b - 1
            while a < b and s[a] in " nt":
                a += 1
            while b > a and s[b - 1] in " nt":
                b -= 1
        if b > a:
            out.append((a + 1, b - a, bool(quoted)))
    return out


@F.pandas_udf(RULE)
def resolve_skeletons(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield pd.Series([[{"first": a, "size": n, "quoted": q} for a, n, q in resolve(s)] for s in batch])


def _unescape(tokens: Column, quoted: Column) -> Column:
    one = lambda t: (
        F.when(t.rlike(r"^\\u"), F.decode(F.unhex(F.replace(t, F.lit("\\u"), F.lit(""))), "UTF-16BE"))
        .when(t == "\\n", "\n").when(t == "\\t", "\t").when(t == "\\r", "\r").when(t.rlike(r"^\\"), F.substring(t, 2, 1)).otherwise(t)
    )
    plain = F.array_join(F.transform(tokens, one), "")
    return F.when(quoted, F.replace(plain, F.lit('""'), F.lit('"'))).otherwise(plain)


def split_packed(df: DataFrame, id_col: str, cell: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(id, pos, value): the values of each cell in order, pos from 1.

    Null, blank and placeholder cells give no rows, nor do empty places; quoted text is one value; repeated values and
    repeated ids stay as they are. Cells of any length are read whole.
    """
    named = df.select(F.col(id_col).alias("id"), F.col(cell).alias("cell")).where(F.col("cell").isNotNull() & ~F.lower(squash(F.col("cell"))).isin(*NOTHING))
    tokens = named.select("id", F.regexp_extract_all("cell", F.lit(TOKEN), F.lit(0)).alias("tokens"))
    masked = write_shared(tokens.select("id", "tokens", F.array_join(F.transform("tokens", mask), "").alias("skeleton")))
    spark = df.sparkSession
    rules = cut_lineage(masked.select("skeleton").distinct().repartition(task_slots(spark)).select("skeleton", resolve_skeletons("skeleton").alias("rule")))
    size = rules.agg(F.sum(F.length("skeleton") + F.size("rule") * 24 + 64)).first()[0] or 0
    joined = masked.join(F.broadcast(rules) if size <= broadcast_bytes else rules, "skeleton")
    parts = joined.select("id", "tokens", F.posexplode("rule").alias("at", "r"))
    value = _unescape(F.slice("tokens", F.col("r.first"), F.col("r.size")), F.col("r.quoted"))
    return parts.select("id", (F.col("at") + 1).cast("int").alias("pos"), F.regexp_replace(value, r"(?U)^\s+|\s+$", "").alias("value"))
