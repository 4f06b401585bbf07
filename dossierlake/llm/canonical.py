"""Freely typed names mapped to a reference list.

Every entry has alias paths (short and long form, code, and the ways of writing the form of state) in one trie. A name
is searched with a Levenshtein automaton run over the trie: a state is the band of edit counts along the name, dead
branches are left at once. Transposed neighbours count as one edit. All entries within a distance that depends on the
length come out; the nearest one wins and a tie between entries counts as no match unless a hint decides it.

Only distinct names are searched, in Arrow batches, and joined back.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from dossierlake.functions.text import squash
from dossierlake.session import cut_lineage, task_slots, write_shared

#: Abbreviations in names of states and places.
SHORT_FORMS = {"rep": "republic", "dem": "democratic", "fed": "federal", "st": "saint", "ste": "saint", "n": "north", "s": "south", "e": "east", "w": "west", "kgdm": "kingdom", "princ": "principality", "is": "islands", "isl": "islands", "u": "upper"}
MAX_REFERENCE = 100_000
BROADCAST_BYTES = 4 << 20


def normalize(name: str, articles: bool = False) -> str:
    """Case, accents, punctuation, footnote marks, articles and abbreviations taken away; 'X, Kingdom of' becomes 'kingdom of x'."""
    s = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c)).casefold()
    s = re.sub(r"\s+\d+/\s*$|[*†‡§]+|\s*\[\d+\]\s*$", " ", s).strip()
    s = re.sub(r"\(\s*the\s*\)", " ", s)
    if m := re.fullmatch(r"\s*([^,]+),\s*(.+?)\s*", s):
        s = f"{m[2]} {m[1]}" if re.search(r"\bof( the)?$|^the$", m[2]) else s
    s = re.sub(r"[&/+]", " and ", s)
    words = [w for w in re.sub(r"[^\w]+", " ", s).split() if articles or w != "the"]
    return " ".join(SHORT_FORMS.get(w, w) for w in words)


def alias_forms(short: str, long: str | None, code: str | None) -> set[str]:
    """The normalized ways to write one entry."""
    s = normalize(short)
    forms = {s, normalize(short, articles=True)}
    if long:
        t = normalize(long)
        bare = s.replace(" ", "")
        state = re.sub(rf"\b{re.escape(s)}\b", "", t).strip()
        forms |= {t, f"{s} {t}"}
        if state and state != t:
            forms |= {f"{s} {state}", f"{s} {re.sub(r' of$', '', state)}", f"{state} {s}"} if state.endswith(" of") else {f"{s} {state}", f"{state} of {s}"}
        forms.add(bare)
    if code:
        forms.add(code.casefold().strip())
    return {f for f in forms if f}


def allowed(length: int) -> int:
    """Edits allowed for an alias of that many characters."""
    return 0 if length <= 3 else 1 if length <= 5 else 2


class Trie:
    """Aliases with the ids of their entries. A node maps a character to its child; under '' it has the ids of the aliases that end there."""

    def __init__(self, aliases: list[tuple[str, int]]):
        self.root: dict = {}
        for alias, ref in aliases:
            node = self.root
            for c in alias:
                node = node.setdefault(c, {})
            node.setdefault("", set()).add(ref)

    def search(self, word: str, most: int = 2) -> dict[int, int]:
        """Distance of every entry within the distance its alias' length allows.

        A state of the automaton holds the edits for the 2 * most + 1 places of the word around the depth of the node, so
        its size does not depend on the word: band[k] is the distance to word[: depth + k - most].
        """
        found: dict[int, int] = {}
        n, far, width = len(word), most + 1, 2 * most + 1
        first = tuple(k - most if k >= most else far for k in range(width))
        stack = [(self.root, 0, first, None, "")]
        while stack:
            node, depth, band, before, last = stack.pop()
            at = n - depth + most
            if "" in node and 0 <= at < width and band[at] <= allowed(depth):
                for ref in node[""]:
                    found[ref] = min(found.get(ref, far), band[at])
            depth += 1
            for c, child in node.items():
                if not c:
                    continue
                new, left = [far] * width, far
                for k in range(max(0, most - depth), min(width, n - depth + most + 1)):
                    j = depth + k - most
                    if not j:
                        x = depth
                    else:
                        w = word[j - 1]
                        x = band[k] + (w != c)
                        if left < x:
                            x = left + 1
                        if k + 1 < width and band[k + 1] < x:
                            x = band[k + 1] + 1
                        if before is not None and j > 1 and w == last and word[j - 2] == c and before[k] < x:
                            x = before[k] + 1
                    new[k] = left = x if x < far else far
                if min(new) <= most:
                    stack.append((child, depth, tuple(new), band, c))
        return found


def build_trie(reference: DataFrame, id_col: str, short: str, long: str | None = None, code: str | None = None, max_reference: int = MAX_REFERENCE) -> Trie:
    """The trie of a reference list, whose size is checked: it goes to every task."""
    picked = reference.select(F.col(id_col), F.col(short), *(F.col(c) if c else F.lit(None).cast("string") for c in (long, code)))
    rows = picked.limit(max_reference + 1).collect()
    if len(rows) > max_reference:
        raise ValueError(f"a reference list of more than {max_reference} entries is not a lookup list; join it by exact keys first")
    return Trie([(a, r[0]) for r in rows if r[1] for a in sorted(alias_forms(r[1], r[2], r[3]))])


def map_names(names: DataFrame, name: str, trie: Trie) -> DataFrame:
    """(name, candidates): for each distinct name, all entries within the allowed distance, nearest first. No candidates: unmatched."""
    spark = names.sparkSession
    shared = spark.sparkContext.broadcast(trie)
    kind = T.ArrayType(T.StructType([T.StructField("ref_id", T.LongType()), T.StructField("distance", T.IntegerType())]))

    @F.pandas_udf(kind)
    def look_up(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        search = lru_cache(100_000)(shared.value.search)  # many ways of writing are one normalized name

        def candidates(name: str) -> list[dict]:
            s = normalize(name)
            hit = dict(search(s))
            for ref, d in search(s.replace(" ", "")).items() if " " in s else ():
                if not d:  # an alias written without its blanks, exactly
                    hit[ref] = 0
            return [{"ref_id": r, "distance": d} for r, d in sorted(hit.items(), key=lambda kv: (kv[1], kv[0]))]

        for batch in batches:
            yield pd.Series([candidates(x) for x in batch])

    distinct = names.select(F.col(name).alias("name")).where("name is not null").distinct()
    return distinct.repartition(task_slots(spark)).select("name", look_up("name").alias("candidates"))  # by number alone: by the same key it would be dropped, and few bytes would go to one task


def map_to_reference(df: DataFrame, id_col: str, name: str, trie: Trie, hint: str | None = None, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(id, ref_id, distance): the nearest entry for each row with a non-blank name, ref_id 0 where none fits.

    Null and blank names give no row. A tie between entries at the least distance gives 0, unless `hint` (a column with
    an entry's id) names one of them. Repeated ids and names stay; an empty table gives no rows.
    """
    rows = write_shared(df.select(F.col(id_col).alias("id"), squash(F.col(name)).alias("name"), (F.col(hint) if hint else F.lit(None).cast("long")).alias("hint")).where("name is not null and name != ''"))
    found = cut_lineage(map_names(rows, "name", trie))
    size = found.agg(F.sum(F.length("name") * 2 + F.size("candidates") * 16 + 64)).first()[0] or 0
    joined = rows.join(F.broadcast(found) if size <= broadcast_bytes else found, "name")
    best = F.filter("candidates", lambda c: c["distance"] == F.col("candidates")[0]["distance"])
    hinted = F.filter(best, lambda c: c["ref_id"] == F.col("hint"))
    pick = F.when(F.size(best) == 1, best[0]).when(F.size(hinted) == 1, hinted[0])
    return joined.select("id", pick.alias("p")).select("id", F.coalesce("p.ref_id", F.lit(0).cast("long")).alias("ref_id"), F.col("p.distance").alias("distance"))


#: Words that show that the head of a title names the kind of document, not the country.
HEADINGS = r"(?i)\b(staff report|press release|country report|article\s+iv|art\. iv|consultation|(?:report|paper|release|series|circular)\s+no)\b|(?i)\bno\.\s*[0-9]"


def title_subject(title: Column) -> Column:
    """The name of the country a title is about, as it is written there.

    The head of the title, up to the first colon, semicolon, long dash or spaced dash, unless that is a heading; of a
    heading, what follows 'with', 'on' or 'for' at its end, or else the next part of the title.
    """
    once = lambda v, body: F.get(F.transform(F.array(v), body), F.lit(0))

    def pick(parts: Column) -> Column:
        head = F.element_at(parts, 1)
        in_heading = F.regexp_extract(head, r"(?i)\b(?:consultation|discussions?|mission|report|release|no\.?\s*\S+)\s+(?:with|on|for|to)\s+(?!the\s+[0-9]{4})(.+)$", 1)
        tail = once(in_heading, lambda x: F.when(x != "", x).otherwise(F.coalesce(F.try_element_at(parts, F.lit(2)), head)))
        return F.when(~head.rlike(HEADINGS), head).otherwise(tail)

    return once(F.split(squash(title), r"\s*[:;—]\s*|\s+[-–]\s+"), pick)
