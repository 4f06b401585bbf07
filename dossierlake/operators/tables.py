"""Tables taken from documents: rows of key and value text, and rules that tell data tables from layout."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from dossierlake.functions.text import count_words, pairs_to_map

CELLS = T.ArrayType(T.StructType([T.StructField("table_no", T.IntegerType()), T.StructField("row_no", T.IntegerType()), T.StructField("col_no", T.IntegerType()), T.StructField("cell", T.StringType())]))


class _Tables(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.cells: list[dict] = []
        self.open: list[list[int]] = []  # table, row and column of the open tables
        self.count = 0
        self.text: list[str] | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            self.count += 1
            self.open.append([self.count, 0, 0])
        elif self.open and tag == "tr":
            self.open[-1][1:] = [self.open[-1][1] + 1, 0]
        elif self.open and tag in ("td", "th"):
            self.open[-1][2] += 1
            self.text = []

    def handle_endtag(self, tag: str) -> None:
        if tag == "table" and self.open:
            self.open.pop()
        elif tag in ("td", "th") and self.open and self.text is not None:
            t, r, c = self.open[-1]
            self.cells.append({"table_no": t, "row_no": r, "col_no": c, "cell": " ".join("".join(self.text).split())})
            self.text = None

    def handle_data(self, data: str) -> None:
        if self.text is not None:
            self.text.append(data)


def table_cells(df: DataFrame, id_col: str, content: str) -> DataFrame:
    """(id, table_no, row_no, col_no, cell) of every table in HTML or XML text, however damaged; all numbers from 1."""

    @F.pandas_udf(CELLS)
    def cells(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for x in batch:
                p = _Tables()
                p.feed(x or "")
                p.close()
                out.append(p.cells)
            yield pd.Series(out)

    return df.select(F.col(id_col).alias("id"), F.explode(cells(content)).alias("c")).select("id", "c.*")


def standard_tables(cells: DataFrame, most_words: int = 200, long_cell: int = 30) -> DataFrame:
    """(id, table_no, n_cells, header_ok, no_repeats, short_cells, standard): whether a table is one of data.

    Its header names risks in under 30 words; no long cell is repeated in a row or column; no cell exceeds 200 words or
    has more than two blank lines.
    """
    words = count_words(F.col("cell"))
    judged = cells.withColumns({"w": words, "blank": F.regexp_count("cell", F.lit("\n\n\n"))})
    long = F.when(F.col("w") > long_cell, F.col("cell"))
    by = lambda axis: judged.groupBy("id", "table_no", axis).agg(F.count(long).alias("n"), F.count_distinct(long).alias("d")).groupBy("id", "table_no").agg(F.max(F.col("n") > F.col("d")).alias(f"repeats_{axis}"))
    head = F.array_join(F.array_sort(F.collect_list(F.when(F.col("row_no") == 1, F.concat_ws(" ", "cell")))), " ")
    base = judged.groupBy("id", "table_no").agg(F.count("*").alias("n_cells"), head.alias("head"), (F.max("w") <= most_words).alias("few_words"), (F.max("blank") <= 2).alias("few_blanks"))
    joined = base.join(by("row_no"), ["id", "table_no"]).join(by("col_no"), ["id", "table_no"])
    header = F.coalesce(F.lower("head").rlike("risk|likelihood|impact|shock"), F.lit(False)) & (count_words(F.col("head")) < 30)
    return joined.select("id", "table_no", "n_cells", header.alias("header_ok"), (~(F.col("repeats_row_no") | F.col("repeats_col_no"))).alias("no_repeats"), (F.col("few_words") & F.col("few_blanks")).alias("short_cells")).withColumn("standard", F.col("header_ok") & F.col("no_repeats") & F.col("short_cells"))


def rows_from_text(df: DataFrame, id_col: str, text: str, fields: list[str], needed: str) -> DataFrame:
    """(id, row_no, fields…): a row for each line of 'key: value || key: value'; rows whose needed field has no letter are dropped."""
    lines = df.select(F.col(id_col).alias("id"), F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("row_no", "line")).withColumn("m", pairs_to_map(F.col("line")))
    rows = lines.select("id", "row_no", *(F.try_element_at("m", F.lit(f)).alias(f) for f in fields))
    return rows.where(F.coalesce(F.col(needed), F.lit("")).rlike(r"\p{L}"))


def page_range(pages: DataFrame, doc: str, page: str, text: str, pattern: str, length: int = 4) -> DataFrame:
    """(doc, first_page, last_page): from the first page that matches to so many pages on, at most the last there is."""
    last = pages.groupBy(doc).agg(F.max(page).alias("_last"))
    first = pages.where(F.coalesce(F.lower(text).rlike(pattern), F.lit(False))).groupBy(doc).agg(F.min(page).alias("first_page"))
    return first.join(last, doc).select(doc, "first_page", F.least(F.col("first_page") + length, F.col("_last")).alias("last_page"))
