"""Lines of extracted documents: cleaning, labels, and paragraphs put together again.

A line is judged by expressions; only the merging of lines up to the end of a sentence follows an order, and that is
done within one document by an ordered fold. A document is an array of lines in one row, never pulled apart over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from dossierlake.functions.text import squash, strip

HEADERS = {"Date": r"(?i)^date\s*:", "To": r"(?i)^to\s*:", "From": r"(?i)^from\s*:", "Subject": r"(?i)^(?:subject|re)\s*:"}
#: How many lines a footnote, a reference and a paragraph may run on.
SPANS = {"footnote": 8, "reference": 5, "para": 30}
TAG = r"^<([a-z]+)>"


def usable_line(line: Column) -> Column:
    """Whether a line has words: more than four characters, not digits and punctuation only, at least half of its tokens alphabetic and no more than 40 % numeric."""
    tokens = F.filter(F.split(squash(line), " "), lambda t: t != "")
    share = lambda pattern: F.size(F.filter(tokens, lambda t: t.rlike(pattern))) / F.greatest(F.size(tokens), F.lit(1))
    return F.coalesce((F.length(squash(line)) > 4) & line.rlike(r"\p{L}") & (share(r"\p{L}") >= 0.5) & (share(r"^[\p{N}.,%()$-]+$") <= 0.4), F.lit(False))


def _once(value: Column, body) -> Column:
    """body with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def line_label(line: Column) -> Column:
    """What kind of line it is. The line is stripped once, and no pattern runs after one has matched."""

    def of(t: Column) -> Column:
        out = F.when(~usable_line(t), "drop")
        for name, pattern in HEADERS.items():
            out = out.when(t.rlike(pattern), name.lower())
        return (
            out.when(t.rlike(r"(?i)^(?:figure|table|box|chart)\s+[0-9IVX]+"), "figure").when(t.rlike(r"(?i)^(?:sources?|notes?)\s*:"), "source")
            .when(t.rlike(r"(?i)^(?:annex|appendix|attachment)\b"), "annex").when(t.rlike(r"^(?:\[?[0-9]{1,3}\]?/|[0-9]{1,2}\s+(?:See|Based|For)\b|[*†])"), "footnote")
            .when(t.rlike(r"^[\p{Lu}][\p{L}'’-]+, (?:[\p{Lu}]\.|[\p{Lu}][\p{L}]+).*\(?(?:19|20)[0-9]{2}\)?"), "reference")
            .when(t.rlike(r"^(?:[IVX]+\.|[A-Z]\.)\s+\p{Lu}") | (t.rlike(r"^[\p{Lu}0-9\s’'&,.-]+$") & (F.length(t) <= 80)), "title")
            .when((F.size(F.split(squash(t), " ")) <= 3) & ~t.rlike(r"[.!?]$"), "short").otherwise("para")
        )

    return _once(strip(line), of)


def lines_of(text: Column) -> Column:
    """The non-blank lines of a text, squashed, rules of underscores taken out; null has none."""
    cut = F.filter(F.split(F.coalesce(text, F.lit("")), r"\r\n|\n|\r"), lambda x: x.rlike(r"(?U)\S"))
    return F.transform(cut, lambda x: squash(F.regexp_replace(x, "_{3,}", " ")))


def document_lines(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, ord, line): the non-blank lines of each text."""
    return df.select(F.col(id_col).alias("id"), F.posexplode(lines_of(F.col(text))).alias("ord", "line"))


def without_contents(lines: Column, ahead: int = 50) -> Column:
    """The lines without a table of contents: its heading, and the entries within so many lines behind it. Entries end in a page number."""
    heading = lambda x: F.upper(x).rlike(r"^(?:TABLE OF )?CONTENTS?$")
    entry = lambda x: x.rlike(r"(?:\.{3,}|\s)[0-9ivx]{1,4}$") | heading(x)

    def without(at: Column) -> Column:
        near = lambda i: F.exists(at, lambda h: (h <= i) & (h >= i - ahead))
        return F.when(F.size(at) == 0, lines).otherwise(F.filter(lines, lambda x, i: ~(near(i) & entry(x))))

    marked = F.filter(F.transform(lines, lambda x, i: F.when(heading(x), i)), lambda i: i.isNotNull())
    return _once(marked, without)


def merged_lines(items: Column) -> Column:
    """Labelled lines (label, line) as (label, text): paragraphs, footnotes and references with the lines that go on to the end of their sentence.

    A line joins the one before if that may run on, is not ended by a full stop, and has not taken its number of lines.
    """
    item = "struct<label:string,text:string,n:int>"
    entry = lambda x: F.struct(x["label"].alias("label"), x["line"].alias("text"), F.lit(1).alias("n"))
    limit = lambda label: F.when(label == "footnote", SPANS["footnote"]).when(label == "reference", SPANS["reference"]).when(label == "para", SPANS["para"]).otherwise(0)

    def step(acc: Column, x: Column) -> Column:
        last = acc["last"]
        goes_on = F.coalesce((last["n"] < limit(last["label"])) & ~last["text"].rlike(r"[.!?:;][\"'”’)]*$") & x["label"].isin("para", "short", "reference"), F.lit(False))
        longer = F.struct(last["label"].alias("label"), F.concat_ws(" ", last["text"], x["line"]).alias("text"), (last["n"] + 1).alias("n"))
        opened = F.struct(F.concat(acc["done"], F.array_compact(F.array(last))).alias("done"), entry(x).alias("last"))
        return F.when(goes_on, F.struct(acc["done"].alias("done"), longer.alias("last"))).otherwise(opened)

    start = F.struct(F.array().cast(f"array<{item}>").alias("done"), F.lit(None).cast(item).alias("last"))
    return F.aggregate(items, start, step, lambda acc: F.concat(acc["done"], F.array_compact(F.array(acc["last"]))))


def process_documents(df: DataFrame, id_col: str, text: str, keep: tuple[str, ...] = ("para", "title", "footnote", "reference")) -> DataFrame:
    """(id, status, n_lines, n_kept, text): every document cleaned; 'empty' without lines, 'problem' if nothing is kept.

    A document stays one row all the way, so there is no shuffle; every line is labelled once. Null and blank texts are
    empty; repeated ids keep their rows.
    """
    labelled = lambda lines: F.transform(lines, lambda x: F.struct(line_label(x).alias("label"), x.alias("line")))
    used = lambda items: F.filter(items, lambda x: ~x["label"].isin("drop", "figure", "source"))
    kept = lambda lines: F.filter(merged_lines(used(labelled(without_contents(lines)))), lambda x: x["label"].isin(*keep))
    tagged = lambda items: F.array_join(F.transform(items, lambda x: F.concat(F.lit("<"), x["label"], F.lit("> "), x["text"])), "\n")

    def result(lines: Column) -> Column:
        found = lambda k: F.struct(F.size(lines).cast("long").alias("n_lines"), F.size(k).cast("long").alias("n_kept"), F.when(F.size(k) > 0, tagged(k)).alias("text"))
        return _once(kept(lines), found)

    rows = df.select(F.col(id_col).alias("id"), _once(lines_of(F.col(text)), result).alias("r"))
    status = F.when(F.col("r.n_lines") == 0, "empty").when(F.col("r.n_kept") == 0, "problem").otherwise("success")
    return rows.select("id", status.alias("status"), "r.n_lines", "r.n_kept", "r.text")


def tag_of(line: Column) -> Column:
    return F.nullif(F.regexp_extract(line, TAG, 1), F.lit(""))


def long_paragraphs(df: DataFrame, line: str, words: int = 15) -> DataFrame:
    """Rows tagged as paragraphs with more words than that, the tag taken off."""
    bare = strip(F.regexp_replace(line, TAG, ""))
    return df.where((tag_of(F.col(line)) == "para") & (F.size(F.split(squash(bare), " ")) > words)).withColumn(line, bare)
